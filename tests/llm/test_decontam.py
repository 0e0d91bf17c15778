from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from qoeflow.llm import catalog, decontam as d
from tests.llm.conftest import edge_rows


def words_by_hand(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def judge_by_hand(text, items, window=13):
    """(words, hit words, items) by comparing every window with every place."""
    words, hit, found = words_by_hand(text), set(), set()
    index = {}
    for i in range(len(words)):
        for n in {min(window, len(w)) for w in items.values() if w}:
            index.setdefault(tuple(words[i:i + n]), set()).add(i)
    for item, w in items.items():
        n = min(window, len(w))
        for a in range(len(w) - n + 1) if w else ():
            for i in index.get(tuple(w[a:a + n]), ()):
                if i + n <= len(words):
                    hit |= set(range(i, i + n))
                    found.add(item)
    return len(words), len(hit), found


def check(rows, docs, items):
    texts = Counter()
    for doc_id, text in docs:
        n, hit, found = judge_by_hand(text, items)
        texts[doc_id, n, hit, len(found), d.items_digest(list(found)), hit > 0 and 20 * hit >= n] += 1
    assert Counter(tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in rows) == texts


def test_query_against_brute_force(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in small("documents", "0.01").collect()]
    items = {str(r["item_id"]): words_by_hand(r["text"]) for r in small("benchmark", "0.01").collect()}
    rows = catalog.op10_benchmark_automaton(spark, "/root/testdata/sf0.01").collect()
    check(rows, docs, items)
    assert any(r["contaminated"] for r in rows)


@pytest.mark.parametrize("block_words", [1, 40, 10_000])
def test_random_words_in_one_or_many_blocks(spark, docs_of, block_words):
    r = random.Random(block_words)
    def some(n):
        return [r.choice("abc") for _ in range(n)]
    items = {str(i): some(r.choice((0, 1, 2, 3, 5, 12, 13, 14, 20, 30))) for i in range(25)}
    docs = []
    for i in range(60):
        words = some(r.randint(0, 30)) + r.choice(list(items.values())) + some(r.randint(0, 10))
        docs.append((i, " ".join(words).replace("a", "A", 1)))
    bench = spark.createDataFrame([(int(k), " ".join(v)) for k, v in items.items()], "item_id long, text string")
    check(d.judged(d.find_matches(docs_of(docs), bench, block_words=block_words)).collect(), docs, items)


@pytest.mark.parametrize("n", [1, 12, 13, 14, 51, 52, 53, 64, 65, 200])
def test_long_items_are_cut_and_lose_no_window(n):
    ws = [b"%d" % i for i in range(n)]
    cut = list(d.pieces(ws, 40, 13))
    assert all(len(p) <= 40 + 12 for p in cut) and (n > 52 or cut == [ws])
    need = min(n, 13)
    assert {tuple(p[a:a + need]) for p in cut for a in range(len(p) - need + 1)} == {tuple(ws[a:a + need]) for a in range(n - need + 1)}
    assert all(len(p) >= need for p in cut)


def test_longest_match_lengths_of_the_automaton():
    a = d.SuffixAutomaton([("x", [b"a", b"b", b"c", b"b"]), ("y", [b"b", b"c", b"a"])], window=2)
    assert a.stream([b"c", b"b", b"c", b"z", b"a", b"b"]) == ([(0, 3), (4, 6)], {"x", "y"})
    assert a.stream([]) == ([], set()) and a.stream([b"z"]) == ([], set())


def test_unicode_and_case():
    assert d.words("Ünder_score ÀB c-D 4x y") == [w.encode() for w in words_by_hand("Ünder_score ÀB c-D 4x y")]


def test_clean_drops_contaminated_documents_or_their_spans(spark, docs_of):
    item = " ".join(f"q{i}" for i in range(14))
    rows = [(1, f"Start {item}. End"), (2, "clean words here"), (3, item + " " + " ".join(f"z{i}" for i in range(400))), (4, None)]
    bench = spark.createDataFrame([(7, item), (8, None)], "item_id long, text string")
    assert sorted(r["doc_id"] for r in d.clean(docs_of(rows, clash=True), bench).collect()) == [2, 3, 4]
    cut = {r["doc_id"]: r["text"] for r in d.clean(docs_of(rows), bench, spans_only=True).collect()}
    assert cut == {1: "Start . End", 2: rows[1][1], 3: rows[2][1], 4: None}


def test_edge_rows(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "two words"), (1, "little"), (None, "password"), (2, ""), (3, None), (4, "a b c d e")], "item_id long, text string")
    rows = d.judged(d.find_matches(edge_docs, bench)).collect()
    got = Counter((r["doc_id"], r["n_hit"], r["n_items"], r["contaminated"]) for r in rows)
    assert got[4, 2, 1, True] == 3 and got[5, 1, 1, True] == 1 and got[11, 1, 1, True] == 1 and got[6, 5, 1, True] == 1 and got[0, 0, 0, False] == 1
    out = d.clean(edge_docs, bench)
    assert out.columns == edge_docs.columns and out.count() < len(edge_rows())
    assert d.find_matches(no_docs, bench).count() == 0
    assert d.clean(edge_docs, bench.limit(0)).count() == len(edge_rows())
    assert d.find_matches(edge_docs, bench.limit(0)).where("size(hits) > 0").count() == 0
