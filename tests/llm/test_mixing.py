from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest

from qoeflow.llm import mixing as m
from tests.llm.conftest import edge_rows


def source_rows(spark, sizes, tokens=10):
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((i, s, " ".join(["w"] * (tokens + i % 5))))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def plan_of(docs, cfg):
    return {r["source"]: r for r in m.weights(m.counted(docs), cfg).collect()}


def test_repetition_limit_sets_the_exponent(spark):
    docs = source_rows(spark, {"big": 800, "mid": 200, "small": 25})
    plan = plan_of(docs, m.MixConfig(max_passes=2.0))
    passes = {s: r["budget"] / r["total"] for s, r in plan.items()}
    assert passes["big"] == 1 and passes["small"] == pytest.approx(2, abs=0.01) and 1 < passes["mid"] < 2
    assert sum(r["weight"] for r in plan.values()) == pytest.approx(1)
    for r in plan.values():
        assert r["budget"] / sum(x["budget"] for x in plan.values()) == pytest.approx(r["weight"], abs=1e-3)


def test_entropy_sets_the_exponent(spark):
    docs = source_rows(spark, {"a": 700, "b": 200, "c": 50, "d": 50})
    for want in (1.0, 1.2, 1.38):
        p = [r["weight"] for r in plan_of(docs, m.MixConfig(entropy=want)).values()]
        assert -sum(x * math.log(x) for x in p) == pytest.approx(want, abs=1e-6)
    alike = [r["weight"] for r in plan_of(docs, m.MixConfig(entropy=9.9)).values()]
    assert alike == pytest.approx([0.25] * 4)


def test_budget_and_limit(spark):
    docs = source_rows(spark, {"a": 700, "b": 200, "c": 50})
    total = sum(r["total"] for r in plan_of(docs, m.MixConfig()).values())
    plan = plan_of(docs, m.MixConfig(budget=total, max_passes=1.5))
    assert sum(r["budget"] for r in plan.values()) == pytest.approx(total, abs=3)
    assert max(r["budget"] / r["total"] for r in plan.values()) == pytest.approx(1.5, abs=0.01)


def test_budgets_blocks_and_passes(spark):
    docs = source_rows(spark, {"big": 900, "small": 60, None: 30})
    cfg = m.MixConfig(max_passes=2.5, block_tokens=1500, slice_docs=37)
    plan = plan_of(docs, cfg)
    rows = m.with_positions(m.mix(docs, cfg), cfg).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    blocks = 1 + max(r["block"] for r in rows)
    assert blocks == -(-sum(r["budget"] for r in plan.values()) // 1500)
    for s, rs in by.items():
        taken, longest = sum(r["tokens"] for r in rs), max(r["tokens"] for r in rs)
        assert plan[s]["budget"] <= taken < plan[s]["budget"] + longest
        # Whole passes hold every document once; the last one a part of them.
        times = Counter((r["pass"], r["doc_id"]) for r in rs)
        assert set(times.values()) == {1}
        docs_of = Counter(p for p, _ in times)
        assert all(docs_of[p] == plan[s]["docs"] for p in range(plan[s]["passes"] - 1))
        # Every block has the source's share.
        per = Counter()
        for r in rs:
            per[r["block"]] += r["tokens"]
        assert all(abs(per[b] - plan[s]["budget"] / blocks) <= 2 * longest for b in range(blocks))
    for b in range(blocks):
        assert sorted(r["position"] for r in rows if r["block"] == b) == list(range(sum(r["block"] == b for r in rows)))
    assert m.with_positions(m.mix(docs, cfg), cfg).exceptAll(spark.createDataFrame(rows)).count() == 0


def test_no_document_is_lost_and_columns_stay(edge_docs):
    got = m.mixed_documents(edge_docs, m.MixConfig(max_passes=1.25))
    assert got.columns == edge_docs.columns
    have, want = Counter((r["doc_id"], r["text"]) for r in got.collect()), Counter((i, t) for i, t, *_ in edge_rows())
    assert all(have[k] >= n for k, n in want.items()) and set(have) == set(want)


def test_empty_and_wordless_tables(no_docs, docs_of):
    assert m.mix(no_docs).count() == 0 and m.mixed_documents(no_docs).count() == 0
    assert m.mix(docs_of([(1, None), (2, ""), (2, "")])).count() == 3


def test_main_path_is_native(spark, small):
    plan = m.with_positions(m.mix(small("documents")))._jdf.queryExecution().toString() + m.counted(small("documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_counts_are_words(spark, small):
    got = {r["doc_id"]: r["tokens"] for r in m.counted(small("documents")).collect()}
    assert got == {r["doc_id"]: len(re.findall(r"[^ \t\n\x0B\f\r]+", r["text"] or "")) for r in small("documents").collect()}
