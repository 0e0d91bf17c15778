"""Physical-plan properties: pushdown into parquet, hot-key spreading, broadcast checks."""

from __future__ import annotations

import contextlib
import io
import tempfile

from pyspark.sql import functions as F

from qoeflow.operators import prep
from qoeflow.operators.skew import SIZE, attach, attach_group_sum, group_rows
from qoeflow.sources import fixtures as fx
from tests.conftest import SF_SMALL


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_eligibility_filters_reach_the_parquet_scan(spark):
    path = tempfile.mkdtemp(prefix="qoeflow-raw-") + "/playback_raw"
    fx.playback_raw(spark, SF_SMALL).write.parquet(path)
    raw = spark.read.parquet(path)
    plan = plan_text(prep.prepared(raw))
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    for needle in ("EqualTo(eventtype,End)", "EqualTo(applicationname,STB-XI6)", "EqualTo(assetclass,Linear)",
                   "GreaterThanOrEqual(sessionduration,300000)", "IsNotNull(mediaOpenLatency)"):
        assert needle in pushed, pushed
    read_schema = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "bufferunderflow" not in read_schema  # pruned: never used


def _spread(spark, df):
    """Rows of each task of the final stage of ``df``."""
    parts = df.select(F.spark_partition_id().alias("p"), "payload", "total").groupBy("p")
    return [r["n"] for r in parts.agg(F.count(F.lit(1)).alias("n"), F.max("payload"), F.max("total")).collect()]


def test_hot_session_is_spread_by_a_broadcast_and_by_skew_splitting(spark):
    """Two thirds of all rows in one group: no task gets them all, with and without a broadcast."""
    rows = spark.range(300_000, numPartitions=8).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit(2).cast("bigint").alias("v"), F.sha2(F.col("id").cast("string"), 512).alias("payload"))
    path = tempfile.mkdtemp(prefix="qoeflow-hot-") + "/rows"
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    small = {"spark.sql.files.maxPartitionBytes": "4m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}
    skewed = {**small, "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m"}
    for conf in (small, skewed):
        old = {k: spark.conf.get(k, None) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            out = attach_group_sum(rows, ["k"], F.col("v"), "total")
            assert [r["total"] for r in out.where("k = 'hot'").select("total").distinct().collect()] == [400_000]
            sizes = _spread(spark, out)
            assert sum(sizes) == 300_000 and max(sizes) < 120_000, sizes
            one = attach(rows, rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), group_rows()), ["k"])
            assert one.count() == 300_000 and one.where("k = 'hot'").select("n").distinct().count() == 1
        finally:
            for k, v in old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_salts_follow_the_size_of_a_group(spark):
    """A group with half of all rows is dealt over as many tasks as it asks for, equal rows too; others have one."""
    rows = spark.range(40_000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 101 == 0, F.lit(None)).otherwise((F.col("id") % 97).cast("string")).alias("k"),
        F.lit(1).cast("bigint").alias("v"))  # the hot group's rows are all equal
    plain = rows.where("k IS NOT NULL").groupBy("k").count()
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for least, hot in ((1_000, range(4, 9)), (1_000_000, range(1, 2))):
            out = attach(rows, rows.groupBy("k").agg(F.sum("v").alias("t"), group_rows()), ["k"], rows_per_task=least)
            assert out.columns == ["k", "v", "t"] and SIZE not in out.columns
            assert out.groupBy("k").agg(F.count(F.lit(1)).alias("count")).exceptAll(plain).count() == 0
            assert out.where("t <> 1").join(plain, "k").where("t <> count").count() == 0
            tasks = out.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
            assert tasks in hot, (least, tasks)
            assert out.where("k = '3'").select(F.spark_partition_id().alias("p")).distinct().count() == 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_moving_average_splits_a_hot_key(spark):
    from pyspark.sql import Window

    from qoeflow.operators import trends

    rows = spark.range(20_000).select("id", F.when(F.col("id") % 4 != 0, 7).otherwise(F.col("id") % 50).alias("k"),
                                      ((F.col("id") * 37) % 1000 / 8).alias("v"))
    plain = trends.moving_avg(rows, Window.partitionBy("k").orderBy("id").rowsBetween(-9, 0), "v", "a")
    for width in (4, 100, 100_000):  # ranges shorter than the frame, longer, and one for all
        cut = trends.moving_avg_last(rows, "k", "id", "v", "a", 10, F.expr(f"id div {width}"))
        assert cut.columns == plain.columns
        assert cut.exceptAll(plain).count() == 0 == plain.exceptAll(cut).count()


def test_dimension_joins_follow_the_byte_threshold(spark):
    """No hint of our own: small sides are broadcast, and with broadcasts off the same joins shuffle."""
    def plan():
        raw = fx.playback_raw(spark, SF_SMALL)
        return plan_text(prep.playback_base(raw, fx.test_accounts(spark, SF_SMALL), fx.channel_dim(spark, SF_SMALL)))
    assert plan().count("BroadcastHashJoin") >= 2 and "LeftAnti" in plan()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan() and "LeftAnti" in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_channels_grow_with_the_supplier_table(spark):
    suppliers = fx.table(spark, SF_SMALL, "supplier").count()
    assert fx.channel_dim(spark, SF_SMALL).select("source_id").distinct().count() == suppliers - sum(
        k % 10 == 9 and k % 20 != 5 for k in range(suppliers))


def test_repeats_go_by_digest(spark, tmp_path):
    """A stored feed gives the same rows as the distinct on whole rows, with broadcasts and without, in any split, and its
    arrays are not shuffled where the repeated digests are broadcast."""
    from qoeflow.sources import tables

    feed = fx.playback_raw(spark, SF_SMALL)
    odd = feed.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in ("accountSourceId", "starttime") else F.col(f.name)
                                 for f in feed.schema.fields])
    again = feed.where("playbackId LIKE '%7'")
    late = again.withColumn("az_insert_ts", F.expr("az_insert_ts + INTERVAL 1 MICROSECOND"))  # no repeat
    hot = feed.where("eventtype = 'End'").limit(1).withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("x")
    feed.unionByName(odd).unionByName(odd).unionByName(again).unionByName(late).unionByName(hot).repartition(5).write.parquet(f"{tmp_path}/feed")
    raw = spark.read.parquet(f"{tmp_path}/feed")
    assert "_row_place" not in tables.placed(raw.where("eventtype = 'End'")).columns + tables.placed(feed).columns
    placed = tables.placed(raw)
    want = prep.with_channel_id(raw).select(*prep.RAW_KEY).distinct()
    n = want.count()
    assert n < raw.count() - 3000
    for splits, limit in ((1, "10m"), (8, "-1")):
        old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.minPartitionNum", "spark.sql.autoBroadcastJoinThreshold")}
        spark.conf.set("spark.sql.files.minPartitionNum", splits)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            got = prep.deduplicated(prep.with_channel_id(placed))
            assert got.count() == n and got.exceptAll(want).count() == 0
            assert ("hashpartitioning" in plan_text(got)) == (limit == "-1")
        finally:
            for k, v in old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_nested_feed_is_pruned_and_sliced_at_the_scan(spark):
    from qoeflow.sources import tables

    path = tempfile.mkdtemp(prefix="qoeflow-nested-") + "/feed"
    nested = fx.playback_raw_nested(spark, SF_SMALL)
    nested.withColumn("device", F.struct("device.*", F.lit("x").alias("unused"))).write.parquet(path)
    plan = plan_text(tables.playback_day(tables.get_data(path, spark=spark), "1996-03-09").select("playbackId", "deviceSourceId"))
    read = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "unused" not in read and "accountSourceId" not in read and "playbackId" in read
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "EqualTo(received_date,1996-03-09)" in pushed
