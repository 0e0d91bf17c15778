from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from qoeflow.llm import catalog, chosen_path as c, components, wordhash
from tests.llm.conftest import edge_rows


def shingles(text, k=5):
    words = [w.lower() if w.isascii() else w for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not words:
        return set()
    k = min(k, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def classes_by_hand(texts, least=0.8):
    """doc_id -> smallest doc_id of its class, over all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    having = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            having[x].append(i)
    shared = Counter()
    for ids in having.values():
        shared.update((a, b) for k, a in enumerate(ids) for b in ids[k + 1:])
    u, links = Union(), Counter()
    for (a, b), n in shared.items():
        if n >= least * (len(sets[a]) + len(sets[b]) - n):
            u.join(a, b)
            links.update((a, b))
    return {i: u.find(i) for i in texts}, links


def test_query_matches_all_pairs(spark, small):
    texts = {r["doc_id"]: r["text"] for r in small("documents", "0.01").collect()}
    want, links = classes_by_hand(texts)
    rows = catalog.op7_chosen_path(spark, "/root/testdata/sf0.01").collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == want
    assert len(set(want.values())) < len(want)
    assert {r["doc_id"]: r["n_links"] for r in rows} == {i: links[i] for i in texts}


def near_copies(seed, n, words=150, edits=4):
    r = random.Random(seed)
    def word():
        return "".join(r.choice("abcdefghijkl") for _ in range(5))
    first = [word() for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(first)
        for _ in range(r.randint(1, edits)):
            copy[r.randrange(words)] = word()
        out.append(" ".join(copy))
    return out


def test_a_large_group_of_near_copies(docs_of):
    """More sets than a leaf or a block holds: every class and every link is found."""
    texts = dict(enumerate(near_copies(1, 600, edits=9) + near_copies(2, 90) + near_copies(3, 1)))
    want, links = classes_by_hand(texts)
    got = c.link_documents(docs_of(list(texts.items()))).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert {r["doc_id"]: r["n_links"] for r in got} == {i: links[i] for i in texts}


@pytest.mark.parametrize("held, visits", [(16, 2), (200, 1), (40, 16)])
def test_groups_of_many_blocks(docs_of, held, visits):
    """A group of many blocks: no pair of blocks is left out or counted twice."""
    texts = dict(enumerate(near_copies(4, 300, edits=9) + near_copies(5, 70) + near_copies(6, 2)))
    texts[1000] = texts[3]  # equal texts count as documents
    want, links = classes_by_hand(texts)
    got = c.link_documents(docs_of(list(texts.items())), c.JoinConfig(held=held, visits=visits)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert {r["doc_id"]: r["n_links"] for r in got} == {i: links[i] for i in texts}


def test_two_blocks_meet_in_one_unit(spark):
    from pyspark.sql import functions as F
    cfg = c.JoinConfig(visits=2)
    for blocks in (1, 2, 3, 4, 7, 8, 12):
        member = spark.range(40 * blocks).select(F.col("id").alias("rid"), F.lit(1).alias("class"), F.lit(blocks).alias("blocks"))
        units = defaultdict(lambda: (set(), set()))
        for r in c._placed(member, cfg).collect():
            units[r["home"], r["part"]][r["away"]].add(r["rid"])
        met = Counter()
        for held, passing in units.values():
            met.update((min(a, b), max(a, b)) for a in held for b in passing)
        home = {rid: h for (h, part), (held, _) in units.items() for rid in held}
        assert set(met.values()) <= {1}
        assert set(met) == {(a, b) for a in home for b in home if a < b and home[a] != home[b]}
        assert all(len({home[x] for x in passing}) <= cfg.visits for _, passing in units.values())


def test_a_spanning_forest_joins_what_is_linked():
    r = np.random.default_rng(7)
    for rows, columns, share in ((30, 20, .03), (20, 30, .1), (9, 1, .5), (1, 9, .5), (12, 12, 0), (12, 12, 1)):
        found = r.random((rows, columns)) < share
        want, got = Union(), Union()
        links = list(c._spanning(found))
        for i, j in np.argwhere(found):
            want.join(int(i), 100 + int(j))
        for i, j in links:
            assert found[i, j]
            got.join(i, 100 + j)
        nodes = [*range(rows), *range(100, 100 + columns)]
        assert [want.find(x) for x in nodes] == [got.find(x) for x in nodes]
        assert len(links) == sum(want.find(x) != x for x in nodes)


def test_strays_in_a_large_leaf_are_compared(spark):
    """A leaf of one large class and two strays: every pair with a stray is looked at."""
    cfg = c.JoinConfig(block=16)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 32, cfg.tokens, dtype=np.uint32)
    other = base.copy()
    other[:10] += 1
    rows = [(i, bytearray((other if i >= 98 else base).tobytes())) for i in range(100)]
    sets = spark.createDataFrame(rows, "rid long, sig binary")
    leaves = spark.createDataFrame([(5, i, 100) for i in range(100)], "bucket long, rid long, n long")
    classes = spark.createDataFrame([(i, 0 if i < 98 else i) for i in range(100)], "node long, class long")
    got = [(r["a"], r["b"]) for r in c._cross_pairs(leaves, sets, classes, cfg).collect()]
    # In each block the two strays and the large class become one, by two links.
    u = Union()
    for a, b in got:
        assert a >= 98
        u.join(a, b if b >= 98 else 0)
    assert u.find(98) == u.find(99) == 0 and len(got) <= 2 * 7


def test_similarity_and_runs():
    a, b = wordhash.shingles("a b c d e f g", 5), wordhash.shingles("a b c d e f x", 5)
    assert c.jaccard(a, b) == pytest.approx(2 / 4) and c.jaccard(a, a) == 1
    cfg = c.JoinConfig()
    q = 1.0
    for _ in range(cfg.depth):
        q = 1 - np.exp(-q)
    assert (1 - q) ** cfg.runs <= 1 - cfg.recall < (1 - q) ** (cfg.runs - 1)
    x, y = wordhash.shingles(near_copies(5, 1)[0], 5), wordhash.shingles(near_copies(6, 1)[0], 5)
    assert c._similar([x, x[:-5], y, x[5:]], cfg).tolist() == [
        [False, True, False, True], [True, False, False, True], [False] * 4, [True, True, False, False]]
    assert c._estimate(c.signature(x, cfg), c.signature(y, cfg)) < 0.1 and c._estimate(c.signature(x, cfg), c.signature(x, cfg)) == 1


def test_components_match_union_find(spark):
    r = random.Random(3)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(500, 560)] + [(900, i) for i in range(800, 900)] + [(7, 7)]
    u = Union()
    for a, b in links:
        if a != b:
            u.join(a, b)
    got = {x["node"]: x["class"] for x in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: u.find(i) for i in {x for a, b in links if a != b for x in (a, b)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edge_rows(edge_docs, no_docs):
    rows = c.link_documents(edge_docs).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, *_ in edge_rows())
    got = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["class_id"], r["n_links"]))
    # Wordless texts are alone; equal ones are one class, also those of rows without an id.
    assert got[0] == [(0, 0)] and got[1] == [(1, 0)] and got[2] == [(2, 0)]
    assert got[6] == [(6, 2)] and got[8] == [(6, 2)] and got[4] == [(4, 2)] * 3 and got[12] == [(12, 2)] * 2 and got[13] == [(12, 2)]
    assert sorted(got[None], key=str) == [(6, 2), (None, 0)]
    kept = c.keep_one(edge_docs).collect()
    assert sorted((r["doc_id"] for r in kept), key=str) == sorted([0, 1, 2, None, 4, 5, 6, 9, 10, 11, 12, 14], key=str)
    assert kept[0].asDict().keys() == {f.name for f in edge_docs.schema}
    assert c.link_documents(no_docs).count() == 0 and c.keep_one(no_docs).count() == 0
