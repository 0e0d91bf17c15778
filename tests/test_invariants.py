"""Invariants of the levels and scores, sinks' idempotence, helper contracts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from qoeflow.operators import trends
from qoeflow.plans import catalog
from qoeflow.plans.stages import KPIS, LEVEL_KEYS
from qoeflow.sources import sinks
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def st(spark):
    return catalog.stages(spark, SF_SMALL)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["accountSourceId", "deviceSourceId", "pluginSessionId", "session_score"]
    assert df.count() > 0


def test_percent_and_scores_in_range(st):
    p = st.ptbtp.agg(F.min("percentage_below_top_profile"), F.max("percentage_below_top_profile")).first()
    assert 0 <= p[0] <= p[1] <= 100
    for level, col in (("session", "session_score"), ("device", "device_score"), ("account", "account_score")):
        lo, hi = st.score(level).agg(F.min(col), F.max(col)).first()
        assert 0 <= lo <= hi <= 100


@pytest.mark.parametrize("level", ["session", "device", "account"])
@pytest.mark.parametrize("name", list(KPIS))
def test_one_row_per_key(st, name, level):
    h = st.hist(name, level)
    keys = LEVEL_KEYS[level]
    assert h.count() == h.select(*keys).distinct().count() > 0


def test_weights_sum_to_one(st):
    # a session's duration weights add up to one (up to the 1e-10 rounding of each)
    d = st.tttp.where(F.col("pluginSessionId").isNotNull())
    tot = d.groupBy("accountSourceId", "deviceSourceId", "pluginSessionId").agg(F.sum("sessionduration").alias("t"))
    w = d.join(tot, ["accountSourceId", "deviceSourceId", "pluginSessionId"]).groupBy(
        "accountSourceId", "deviceSourceId", "pluginSessionId").agg(
        F.sum(F.round(F.col("sessionduration") / F.col("t"), 10)).alias("w"))
    lo, hi = w.agg(F.min("w"), F.max("w")).first()
    assert abs(lo - 1) < 1e-8 and abs(hi - 1) < 1e-8


@pytest.mark.parametrize("level", ["session", "device", "account"])
def test_history_holds_two_different_days(spark, level):
    h = entry.queries()[f"sink_history_{level}"](spark, SF_SMALL)
    assert {r["event_date"] for r in h.select("event_date").distinct().collect()} <= set(catalog.HISTORY_DAYS)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_replace_replaces_and_a_failed_replace_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    old = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    assert _rows(sinks.replace_table(old, path)) == [(1, "a"), (2, "b")]
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("int").alias("x"), F.lit("c").alias("y"))
    with pytest.raises(Exception, match="lost"):
        sinks.replace_table(broken, path)
    assert _rows(spark.read.parquet(path)) == [(1, "a"), (2, "b")]
    again = sinks.replace_table(spark.read.parquet(path).where("x = 2"), path)  # reads what it replaces
    assert _rows(again) == [(2, "b")] and [p.name for p in tmp_path.iterdir()] == ["table"]
    assert sinks.replace_table(old.limit(0), path).count() == 0


def test_history_replaces_its_own_day_also_by_nothing(spark, tmp_path):
    path = str(tmp_path / "history")
    rows = spark.createDataFrame([(1,), (2,)], "x int")
    sinks.append_history(rows, path, "2021-09-15")
    out = sinks.append_history(rows.where("x = 1"), path, "2021-09-16")
    assert _rows(out) == [(1, "2021-09-15"), (1, "2021-09-16"), (2, "2021-09-15")]
    out = sinks.append_history(rows.limit(0), path, "2021-09-15")
    assert _rows(out) == [(1, "2021-09-16")]
    assert sinks.read_day(spark, path, "2021-09-15").count() == 0 and _rows(sinks.read_day(spark, path, "2021-09-16")) == [(1,)]
    broken = rows.select(F.raise_error(F.lit("lost")).cast("int").alias("x"))
    with pytest.raises(Exception, match="lost"):
        sinks.append_history(broken, path, "2021-09-16")
    assert _rows(sinks.read_day(spark, path, "2021-09-16")) == [(1,)]


def test_day_range_flag_is_checked():
    with pytest.raises(ValueError):
        trends.day_range_window("k", "d", 7, 1, "sideways")


def test_count_by_range_open_sides(spark):
    df = spark.createDataFrame([(1, "a"), (5, "a"), (9, "a")], "x int, g string")
    assert trends.count_by_range(df, "x", "g", 5, 1).first()["count"] == 2
    assert trends.count_by_range(df, "x", "g", "NULL", 5).first()["count"] == 2
    assert trends.count_by_range(df, "x", "g", 5, "NULL").first()["count"] == 2


@pytest.mark.parametrize("name", ["stp", "ptbtp"])
def test_multiplicity_equals_physical_copies(st, name):
    """A compact row with n_rows = k weighs exactly like k flat copies."""
    from qoeflow.operators import kpi, rollup

    details = {"stp": lambda: kpi.startup_flat(st.base), "ptbtp": st.ptbtp_flat}

    k = KPIS[name]
    compact = rollup.session_mean(st.detail(name), k.value, "v", k.keep_nonneg, k.mult)
    flat = rollup.session_mean(details[name](), k.value, "v", k.keep_nonneg, None)
    keys = LEVEL_KEYS["session"]
    j = compact.join(flat.withColumnRenamed("v", "w"), keys, "full")
    assert j.where(F.col("v").isNull() | F.col("w").isNull()).count() == 0
    assert j.agg(F.max(F.abs(F.col("v") - F.col("w")))).first()[0] < 1e-9
    assert compact.count() > 0
