from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from qoeflow.llm import toxicity as t
from tests.llm.conftest import edge_rows

CFG = t.FmConfig()


def learned(pairs, **kw):
    cfg = t.FmConfig(**kw)
    return t.fit([t.terms(x, cfg) for x, _ in pairs], np.array([y for _, y in pairs], float), cfg)


def sentences(rng, n, rule):
    """Filler with one of two tones and one of two mentions; the label is a rule of both."""
    filler = [f"w{i}" for i in range(40)]
    out = []
    for _ in range(n):
        tone, mention = rng.choice(("vermin", "welcome")), rng.choice(("martians", "neighbours"))
        words = rng.choices(filler, k=rng.randint(12, 30))
        for w in (tone, mention):
            words.insert(rng.randrange(len(words)), w)
        out.append((" ".join(words), int(rule(tone, mention))))
    return out


def hits(machine, pairs):
    return np.mean([(p >= 0.5) == bool(y) for p, (_, y) in zip(machine.scores([x for x, _ in pairs]), pairs)])


def test_pairs_of_terms_tell_what_weights_cannot():
    """Neither word tells anything alone, the two together do: a machine without factors can't learn it."""
    rng = random.Random(5)
    rule = lambda tone, mention: (tone == "vermin") == (mention == "martians")
    train, asked = sentences(rng, 3000, rule), sentences(rng, 600, rule)
    settings = dict(least_contrast=0.0, least_texts=20, epochs=30, start=0.3)
    assert hits(learned(train, **settings), asked) > 0.97
    assert hits(learned(train, factors=0, **settings), asked) < 0.65


def test_insult_with_group_mention():
    rng = random.Random(6)
    rule = lambda tone, mention: tone == "vermin" and mention == "martians"
    train, asked = sentences(rng, 2000, rule), sentences(rng, 500, rule)
    assert hits(learned(train), asked) > 0.97


def test_sums_equal_all_pairs():
    """The factor sums are the pairs' products, written out."""
    rng = np.random.default_rng(3)
    m = t.Machine(np.arange(9), 0.3, rng.normal(size=9), rng.normal(size=(9, 4)), CFG)
    at, x = np.array([0, 3, 4, 8, 1, 2]), rng.normal(size=6)
    s, _ = m.sums(at, x, np.array([0, 0, 0, 0, 2, 2]), 3)
    for k, own in ((0, range(4)), (1, ()), (2, (4, 5))):
        own = list(own)
        want = 0.3 + sum(m.weight[at[i]] * x[i] for i in own)
        want += sum(m.factor[at[i]] @ m.factor[at[j]] * x[i] * x[j] for i in own for j in own if i < j)
        assert s[k] == pytest.approx(want)


def test_terms_are_words_and_beginnings():
    wide = t.FmConfig(buckets=1 << 40)
    a, x = t.terms("Stupid, stupid idea!", wide)
    b, _ = t.terms("STUPID idea", wide)
    assert set(a.tolist()) == set(b.tolist()) and len(a) == 2 + 2  # the words, and stup and stupi: no beginning is as long as its word
    assert x.max() == pytest.approx(np.log1p(wide.sharp * 2 / 3))
    assert set(t.terms("stupider", wide)[0].tolist()) & set(a.tolist())
    for nothing in (None, "", " \n ", "... !?"):
        assert len(t.terms(nothing, wide)[0]) == 0


def test_held_out_documents_of_the_tables(spark, small):
    docs, labels = small("documents", "0.1"), small("labels", "0.1")
    machine = t.learn(docs, labels)
    rows = t.score(docs, machine).collect()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    asked = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and truth.get(r["doc_id"]) is not None]
    toxic, clean = [p for p, y in asked if y], [p for p, y in asked if not y]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.02 and len(toxic) > 50
    # The held-out labels teach nothing: turning them around changes no score.
    from pyspark.sql import functions as F
    turned = labels.withColumn("toxic", F.when(t.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = t.score(docs, t.learn(docs, turned)).collect()
    assert sorted((r["doc_id"], r["score"]) for r in again) == sorted((r["doc_id"], r["score"]) for r in rows)


def test_edge_rows(spark, edge_docs, no_docs, docs_of):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(4, 1), (5, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    machine = t.learn(edge_docs, labels, t.FmConfig(least_texts=1, least_contrast=0.0))
    rows = t.score(edge_docs, machine).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, *_ in edge_rows())
    bias = 1 / (1 + np.exp(-machine.bias))
    for r, (_, text, *_) in zip(sorted(rows, key=lambda r: str(r["doc_id"])), sorted(edge_rows(), key=lambda r: str(r[0]))):
        assert 0 <= r["score"] <= 1 and (r["doc_id"] is not None or not r["held_out"])
    assert all(r["score"] == pytest.approx(bias) for r in rows if r["doc_id"] in (0, 1, 2))
    assert t.score(no_docs, machine).count() == 0
    nothing = t.learn(no_docs, labels)
    assert {r["score"] for r in t.score(edge_docs, nothing).collect()} == {0.5}
    assert {r["score"] for r in t.score(edge_docs, t.learn(edge_docs, labels.limit(0))).collect()} == {0.5}


def test_sample_is_bounded_and_the_same_each_time(spark, small):
    docs, labels, cfg = small("documents", "0.01"), small("labels", "0.01"), t.FmConfig(most_rows=60, least_contrast=1.0)
    a, b = t.learn(docs, labels, cfg), t.learn(docs, labels, cfg)
    assert a.bias == b.bias and np.array_equal(a.factor, b.factor) and np.array_equal(a.row, b.row)
    assert len(a.weight) < len(t.learn(docs, labels, t.FmConfig(least_contrast=1.0)).weight)


def test_filter_keeps_columns(spark, edge_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    machine = t.learn(edge_docs, labels)
    kept = t.keep_civil(edge_docs, machine, 1.1)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
    assert t.keep_civil(edge_docs, machine, 0.0).count() == 0
