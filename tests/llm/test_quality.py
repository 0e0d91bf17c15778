from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from qoeflow.llm import catalog, quality as q
from tests.llm.conftest import edge_rows


def stats_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, x in enumerate(zip(words, words[1:], words[2:])):
        if windows[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_statistics_match_direct_counts(spark, small):
    docs = small("documents", "0.01")
    got = {r["doc_id"]: r for r in catalog.op6_weak_supervision(spark, "/root/testdata/sf0.01").collect()}
    for r in docs.collect():
        want = stats_by_hand(r["text"])
        assert tuple(got[r["doc_id"]][c] for c in q.STATS) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert got[r["doc_id"]]["base_failed"] == failed
        assert not (failed and got[r["doc_id"]]["kept"])


def em_by_hand(counts):
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    v = np.array([[float(int(c) == k) for c in p for k in range(3)] for p in patterns])
    share, rate = (np.array(x) for x in q.first_guess())
    for i in range(q.ROUNDS + 1):
        fit = share[None, :] + v @ rate.T
        post = np.exp(fit - fit.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        if i == q.ROUNDS:
            return dict(zip(patterns, post[:, 0]))
        w = post * n[:, None]
        share = np.log(w.sum(0) + q.SMOOTH)
        rate = np.log((w.T @ v + q.SMOOTH) / (w.sum(0)[:, None] + 3 * q.SMOOTH))


def test_expectation_maximisation_matches_arrays(spark, small):
    voted = q.with_votes(q.measured(small("documents", "0.01"))).cache()
    counts = {r["votes"]: r["n"] for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    want = em_by_hand(counts)
    got = {r["votes"]: r["good"] for r in q.posteriors(voted).collect()}
    assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_labelled_documents(spark, small):
    """Clean documents stay, and most of the poor ones go."""
    labels = {r["doc_id"]: r["quality"] for r in small("labels", "0.1").collect()}
    got = [(labels[r["doc_id"]], r["kept"], r["base_failed"]) for r in catalog.op6_weak_supervision(spark, "/root/testdata/sf0.1").collect() if r["doc_id"] in labels]
    clean = [k for good, k, failed in got if good == 1 and not failed]
    poor = [k for good, k, _ in got if good == 0]
    assert sum(clean) / len(clean) > 0.99
    assert sum(poor) / len(poor) < 0.25


def test_main_path_is_native(spark, small):
    plan = q.judge(small("documents"))._jdf.queryExecution().toString() + q.with_votes(q.measured(small("documents")))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_edge_rows(edge_docs, no_docs):
    got = Counter(tuple(r[c] for c in ("doc_id", *q.STATS)) for r in q.judge(edge_docs).collect())
    assert got == Counter((i, *stats_by_hand(t)) for i, t, *_ in edge_rows())
    assert q.judge(no_docs).count() == 0
