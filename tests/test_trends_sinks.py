"""Trend operators on hot keys against their plain forms; sinks by path and by catalog name."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from qoeflow.operators import trends
from qoeflow.sources import sinks


def equal(a, b):
    assert a.columns == b.columns
    a, b = a.cache(), b.cache()
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count() and a.count() > 0


@pytest.fixture(scope="module")
def days(spark):
    """Two thirds of the rows in one key, days with gaps, rows without a date, ties."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 != 0, 1).otherwise(F.col("id") % 40).alias("k"),
        F.when(F.col("id") % 97 != 0, F.expr("date_add(DATE'2023-11-01', CAST((id * 7919) % 400 - 150 AS INT))")).alias("d"),
        ((F.col("id") * 37) % 64).cast("double").alias("v"), ((F.col("id") * 11) % 32).cast("double").alias("u"))
    return rows.withColumn("t", F.expr("CAST(d AS TIMESTAMP) + make_interval(0, 0, 0, 0, CAST(v AS INT) % 24)")).cache()


@pytest.mark.parametrize("span", [(7, 1, "minus"), (1, 7, "plus"), (0, 0, "minus"), (30, -2, "minus"), (-3, 5, "plus")])
@pytest.mark.parametrize("order", ["d", "t"])
def test_day_ranges_equal_the_plain_window(days, span, order):
    w = trends.day_range_window("k", order, *span, is_date=order == "d")
    plain = days.select("*", *[F.coalesce(F.avg(c).over(w), F.lit(0.0)).alias(f"a_{c}") for c in ("v", "u")])
    for width in (None, 1, 5000):
        equal(trends.moving_avg_days(days, ["v", "u"], order, "k", ["a_v", "a_u"], *span, bucket_days=width), plain)


def test_a_hot_key_is_spread_over_its_days(days):
    out = trends.moving_avg_days(days, ["v"], "d", "k", ["a"], 7, 1, "minus")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "_bucket" in plan.split("hashpartitioning(k", 1)[1].split(")", 1)[0]
    with pytest.raises(ValueError, match="flag"):
        trends.moving_avg_days(days, ["v"], "d", "k", ["a"], 7, 1, "sideways")


def test_ranges_by_rank(spark):
    """Sparse order values, a hot key, null keys: as many ranges as partitions, the mean of the plain window."""
    rows = spark.range(8000).select((F.col("id") * 1_000_003).alias("id"), F.when(F.col("id") % 4 != 0, 7).when(F.col("id") % 8 == 0, F.col("id") % 30)
                                    .alias("k"), ((F.col("id") * 37) % 512).cast("double").alias("v"))
    plain = trends.moving_avg(rows, Window.partitionBy("k").orderBy("id").rowsBetween(-9, 0), "v", "a")
    equal(trends.moving_avg_rows(rows, "k", "id", "v", "a", 10), plain)
    one = trends.moving_avg(rows, Window.partitionBy("k").orderBy("id").rowsBetween(0, 0), "v", "a")
    equal(trends.moving_avg_rows(rows, "k", "id", "v", "a", 1), one)


def test_presence_by_bits(days, spark):
    d = days.withColumnRenamed("d", "polling_date").withColumn("from_day", F.lit("1999-01-01").cast("date")).withColumn("current_date", F.lit("2024-05-01").cast("date"))
    got = trends.presence_ratio(d, "k", "from_day", "n", "pct", 10)
    want = d.where("polling_date BETWEEN from_day AND current_date").groupBy("k").agg(F.count_distinct("polling_date").alias("n")).withColumn("pct", F.col("n") / 10)
    equal(got, want)
    rows = got.collect()
    assert [(-r["n"], r["k"]) for r in rows] == sorted((-r["n"], r["k"]) for r in rows)
    as_text = d.withColumn("polling_date", F.col("polling_date").cast("string")).withColumn("from_day", F.lit("1")).withColumn("current_date", F.lit("3"))
    assert trends.presence_ratio(as_text, "k", "from_day", "n", "pct", 10).count() == got.count()


@pytest.fixture(params=["path", "name"])
def target(request, tmp_path):
    return f"{tmp_path}/t" if request.param == "path" else f"t_{uuid.uuid4().hex}"


def failing(spark):
    return spark.range(4).select(F.expr("CASE WHEN id = 3 THEN raise_error('no') ELSE id END").cast("long").alias("id"), F.lit("x").alias("s"))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_replace(spark, target):
    make = lambda *v: spark.createDataFrame([(x, "s") for x in v], "id long, s string")
    assert ids(sinks.replace_table(make(1, 2), target)) == [1, 2]
    again = lambda: spark.read.parquet(target) if sinks.is_path(target) else spark.read.table(target)
    with pytest.raises(Exception, match="no"):
        sinks.replace_table(failing(spark), target)
    assert ids(again()) == [1, 2]
    assert ids(sinks.replace_table(again().where("id > 1").union(make(9)), target)) == [2, 9]  # reads itself
    assert ids(sinks.replace_table(make().limit(0), target)) == []
    other = sinks.replace_table(make(5).withColumn("more", F.lit(1)), target)
    assert other.columns == ["id", "s", "more"] and ids(other) == [5]


def test_history(spark, target):
    day = lambda d, *v: spark.createDataFrame([(x, d) for x in v], "id long, event_date string")
    sinks.append_history(day("2024-01-01", 1, 2), target, "2024-01-01")
    out = sinks.append_history(day("2024-01-02", 3), target, "2024-01-02")
    assert ids(out) == [1, 2, 3] and out.columns == ["id", "event_date"]
    out = sinks.append_history(day("2024-01-02", 4, 5), target, "2024-01-02")  # run again
    assert ids(out) == [1, 2, 4, 5] and ids(sinks.read_day(spark, target, "2024-01-02")) == [4, 5]
    with pytest.raises(Exception, match="no"):
        sinks.append_history(failing(spark).drop("s"), target, "2024-01-01")
    assert ids(sinks.read_day(spark, target, "2024-01-01")) == [1, 2]
    assert ids(sinks.append_history(day("2024-01-01").limit(0), target, "2024-01-01")) == [4, 5]
    assert ids(sinks.read_day(spark, target, "2024-01-01")) == []
