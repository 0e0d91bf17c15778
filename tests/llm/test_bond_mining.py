from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from qoeflow.llm import bond_mining as b

COLUMNS = "vec_id long, embedding array<float>, label int"


def all_pairs(rows):
    """The contract by brute force over (vec_id, embedding, label)."""
    kept = []
    for place, (i, x, label) in enumerate(rows):
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        label = math.fmod(label + 1, 10) if i is not None and i % 7 == 0 else label
        kept.append((place, i, label, [math.floor(256 * float(np.float32(c))) for c in x]))
    out = []
    for place, i, label, x in kept:
        if i is None or i % 100:
            continue
        order = lambda r: (-r[0], r[1] is None, r[1] or 0, r[2])
        scored = [(sum(p * q for p, q in zip(x, y)), j, at, other) for at, j, other, y in kept if at != place]
        positives = sorted((r for r in scored if r[3] == label), key=order)[:5]
        for ps, pid, *_ in positives:
            fit = sorted((r for r in scored if r[3] != label and 30 * ps <= 100 * r[0] <= 90 * ps), key=order)[:10]
            out += [(i, pid, k + 1, r[1], ps, r[0]) for k, r in enumerate(fit)]
    return sorted(map(str, out))


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, COLUMNS).coalesce(1)
    return sorted(str(tuple(r)) for r in b.mine(df, b.MineConfig(**kw)).collect())


def test_whole_table_equals_brute_force(spark, small):
    for sf, cfg in (("0.01", b.MineConfig()), ("0.001", b.MineConfig(block_rows=(40, 60), group_anchors=2, step=3))):
        df = small("embeddings", sf)
        got = sorted(str(tuple(r)) for r in b.mine(df, cfg).collect())
        assert got == all_pairs([tuple(r) for r in df.collect()]) and len(got) > 100


def test_bounds_rule_rows_out(spark, small):
    """The bitmap shrinks before the last dimension, and what stays has exact scores."""
    rows = b.usable(small("embeddings", "0.1"), b.MineConfig()).toArrow()
    block = b.Block(rows, b.matrix(rows.column("vec").to_pylist(), rows.column("width").to_pylist()))
    exact = block.anchors.T @ block.cols
    order = np.argsort(rows.column("label").to_numpy(), kind="stable")
    seen = []
    for i in range(0, 40):
        part = block.of_label(int(rows.column("label")[i].as_py()))
        found, score = block.scan(i, part, b.top_keep(5), 8)
        assert np.array_equal(score, exact[i][found]) and len(found) < (part.stop - part.start) / 4
        top = sorted(exact[i][part])[-5:]
        assert sorted(score)[-5:] == top
        windows = [b.window_of(int(s), b.MineConfig()) for s in top]
        found, score = block.scan(i, slice(0, len(block.rid)), b.window_keep(windows, 10), 8)
        assert np.array_equal(score, exact[i][found])
        seen.append(len(found) / len(order))
    assert np.mean(seen) < 0.5


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-40, 40), min_size=6, max_size=6), min_size=2, max_size=40), st.integers(1, 7), st.integers(1, 4))
def test_scan_never_loses_an_answer(vectors, step, k):
    n = len(vectors)
    vec = [np.array(v, np.int16).tobytes() for v in vectors]
    table = pa_table(vec, [i % 3 for i in range(n)])
    block = b.Block(table, b.matrix(vec, [2] * n))
    exact = block.anchors.T @ block.cols
    for i in range(n):
        found, score = block.scan(i, slice(0, n), b.top_keep(k), step)
        assert sorted(score, reverse=True)[:k] == sorted(exact[i], reverse=True)[:k]
        windows = [b.window_of(int(s), b.MineConfig()) for s in exact[i][:3] if s >= 0]
        if windows:
            found, score = block.scan(i, slice(0, n), b.window_keep(windows, k), step)
            for lo, hi in windows:
                want = sorted((s for s in exact[i] if lo <= s <= hi), reverse=True)[:k]
                assert sorted((s for s in score if lo <= s <= hi), reverse=True)[:k] == want


def pa_table(vec, labels):
    import pyarrow as pa
    n = len(vec)
    return pa.table({"rid": pa.array(range(n), pa.int64()), "vec_id": pa.array(range(n), pa.int64()), "label": pa.array(labels, pa.int64()),
                     "width": pa.array([2] * n, pa.int32()), "vec": pa.array(vec, pa.binary())})


def test_windows_are_exact():
    cfg = b.MineConfig()
    for s in range(-30, 400):
        lo, hi = b.window_of(s, cfg)
        assert [n for n in range(-40, 400) if 30 * s <= 100 * n <= 90 * s] == list(range(lo, hi + 1))


def edge_rows():
    r = np.random.default_rng(11)
    rows = [(i, r.normal(size=6).round(2).tolist(), int(i % 3)) for i in range(0, 320)]
    rows += [(100, None, 1), (200, [1.0, None, 0.5, 0.1, 0.0, 0.2], 1), (300, [float("nan")] * 6, 2), (400, [float("inf")] * 6, 2),
             (500, [0.5] * 6, None), (None, [1.0, 1.0, 0.2, 0.1, 0.0, 0.0], 1), (None, [1.0, 1.0, 0.2, 0.1, 0.0, 0.0], 0)]
    rows += [rows[100], rows[100], rows[200], rows[7], rows[7]]  # repeated rows, anchors among them
    rows += [(1000 + i, [0.25] * 6, i % 2) for i in range(40)] + [(2000, [0.25] * 6, 0)]  # ties
    rows += [(3000, [0.1, 0.2], 5), (3001, [], 5), (3002, [0.3] * 9, 5), (4000, [0.0] * 6, 7), (4001, [0.0] * 6, 7), (5000, [0.1] * 6, 77)]
    rows += [(6000, [900.0, -300.0] + [0.0] * 4, 3), (6001, [800.0] + [0.0] * 4 + [1.0], 3), (6002, [400.0] + [0.0] * 4 + [1.0], 4)]  # wide components
    return rows


def test_edge_rows_equal_brute_force(spark):
    rows = edge_rows()
    want = all_pairs(rows)
    assert want == mined(spark, rows) == mined(spark, rows, block_rows=(16, 30), group_anchors=3, step=2)
    assert any("None" in r for r in want)


def test_empty_and_single_tables(spark):
    assert mined(spark, []) == [] and mined(spark, [(0, [1.0], 1)]) == [] and mined(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], None), (200, None, 1)]) == []


def test_extra_columns_and_clashing_names(spark):
    rows = edge_rows()[:150]
    df = spark.createDataFrame(rows, COLUMNS)
    from pyspark.sql import functions as F
    more = df.select("*", *[F.lit("own").alias(c) for c in ("rid", "block", "group", "score", "vec", "rank", "anchor", "_metadata")])
    assert sorted(str(tuple(r)) for r in b.mine(more).collect()) == all_pairs(rows)


def test_scores_beyond_doubles(spark):
    big = 1.0e7  # products up to 6.6e18: within a long, beyond exact doubles
    rows = [(100, [big, 1.0], 1), (1, [big, 2.0], 1), (2, [big / 2, 0.0], 2), (3, [big / 2, 3.0], 2)]
    assert mined(spark, rows) == all_pairs(rows) != []


def test_hot_label_is_spread(spark, small):
    """Blocks are dealt by hash of the row, so a label with most rows is in every task."""
    cfg = b.MineConfig()
    rows = b.usable(small("embeddings", "0.1"), cfg)
    plan = b._units(rows, rows.where("vec_id % 100 = 0"), 2000, 20, cfg, lambda x, y: x)._jdf.queryExecution().toString()
    assert "label" not in plan.split("hashpartitioning(", 1)[1].split(")", 1)[0]


@pytest.mark.parametrize("bad", [1, 3])
def test_sizes_do_not_change_the_result(spark, small, bad):
    df = small("embeddings")
    want = sorted(map(str, b.mine(df).collect()))
    assert sorted(map(str, b.mine(df, b.MineConfig(blocks=bad, block_rows=(7, 50 * bad), step=64)).collect())) == want
