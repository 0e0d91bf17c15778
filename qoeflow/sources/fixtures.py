"""Logical inputs derived from the driver's TPC-H-style parquet.

The playback telemetry, test-device list, channel dimension and Wi-Fi feed are
not shipped as files; they are Spark plans over the given tables so their work
grows with the scale factor. Mapping: order = playback, line item = bitrate
event, customer = device, three customers = account, customer x year =
session, supplier = channel, event = Wi-Fi hour. The DuckDB twin of this module
is ``qoeflow.plans.oracle.FIXTURE_SQL``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970 of a wall-clock timestamp, independent of the session time zone."""
    return F.timestamp_diff(
        "MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz")
    )


def mac_text(num: Column, colons: bool) -> Column:
    hexed = F.lpad(F.upper(F.hex(num)), 12, "0")
    if not colons:
        return hexed
    return F.regexp_replace(hexed, "(..)(..)(..)(..)(..)(..)", "$1:$2:$3:$4:$5:$6")


def _devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    base = F.when(F.col("c_custkey") % 5 == 0, F.lit(70000000000)).otherwise(F.lit(246512345000000))
    return c.withColumn("mac_num", base + F.col("c_custkey") * 4096)


def _bitrate_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: bitrate ladder values and event offsets (ms) in line order, and the first line's supplier."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", *order)
    running = Window.partitionBy("l_orderkey").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ladder = (
        F.when(F.col("l_orderkey") % 4 == 0, 3718000)
        .when(F.col("l_orderkey") % 4 == 1, 6151600)
        .when(F.col("l_orderkey") % 4 == 2, 1701200)
        .otherwise(18597200)
    )
    ev = li.select(
        "l_orderkey",
        *order,
        ((F.sum("l_quantity").over(running) * 1000).cast("bigint") - 3000).alias("off_ms"),
        F.when(F.col("l_partkey") % 4 == 0, 313200)
        .when(F.col("l_partkey") % 4 == 1, 850000)
        .otherwise(ladder)
        .cast("bigint")
        .alias("br"),
    )
    # Same key as the window: the aggregate reuses its shuffle.
    events = F.array_sort(F.collect_list(F.struct(*order, "br", "off_ms")))
    return ev.groupBy("l_orderkey").agg(events.alias("ev")).select(
        "l_orderkey",
        F.transform("ev", lambda e: e["br"]).alias("bitrate"),
        F.transform("ev", lambda e: e["off_ms"]).alias("offs"),
        F.get("ev", F.lit(0))["l_suppkey"].alias("channel"),
    )


def _states(*values: str) -> Column:
    return F.array(*[F.struct(F.lit(v).alias("value")) for v in values])


def playback_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat playback-end telemetry, one row per order (the raw source grain)."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    dev = _devices(spark, sf_dir)
    arr = _bitrate_arrays(spark, sf_dir)
    key = F.col("o_orderkey")
    # Some rows come twice, and some again an hour later (re-ingested).
    copies = (F.when(key % 53 == 0, F.array(F.lit(0), F.lit(1))).when(key % 13 == 0, F.array(F.lit(0), F.lit(0)))
              .otherwise(F.array(F.lit(0))))
    j = (o.join(dev, o.o_custkey == dev.c_custkey).join(arr, o.o_orderkey == arr.l_orderkey)
         .withColumn("hours_late", F.explode(copies)))
    start = epoch_ms(F.col("o_orderdate"))
    # Rungs: none at all, an unknown first one, one without an event; events: one without a rung.
    rungs = (F.when(key % 31 == 0, F.lit(None))
             .when(key % 41 == 0, F.concat(F.array(F.lit(None).cast("bigint")), F.slice("bitrate", F.lit(2), F.size("bitrate") - 1)))
             .when(key % 37 == 0, F.concat("bitrate", F.array(F.lit(850000).cast("bigint"))))
             .otherwise(F.col("bitrate")))
    offs = F.when(key % 43 == 0, F.concat("offs", F.array(F.element_at("offs", -1) + 60000))).otherwise(F.col("offs"))
    return j.select(
        F.concat(F.lit("a"), F.expr("o_custkey div 3").cast("string")).alias("accountSourceId"),
        mac_text(F.col("mac_num"), colons=True).alias("deviceSourceId"),
        F.concat(F.lit("s"), F.col("o_custkey").cast("string"), F.lit("_"), F.year("o_orderdate").cast("string")).alias(
            "pluginSessionId"
        ),
        F.concat(F.lit("p"), key.cast("string")).alias("playbackId"),
        F.when(F.col("o_orderstatus") == "P", "Start").otherwise("End").alias("eventtype"),
        F.when(key % 19 == 0, "STB-OTHER").otherwise("STB-XI6").alias("applicationname"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "VOD").otherwise("Linear").alias("assetclass"),
        F.when(F.col("o_orderpriority").like("1%"), "MediaFailed").otherwise("Success").alias("completionstatus"),
        start.alias("starttime"),
        (F.lit(200000) + (key * 7919) % 7400000).alias("sessionduration"),
        rungs.alias("bitrate"),
        F.transform(offs, lambda x: x + start).alias("clientGeneratedTimestamp"),
        F.when(key % 11 == 0, F.lit(None))
        .when(key % 12 == 1, _states("playing"))
        .when(key % 12 == 2, _states("playing", "initialized"))
        .otherwise(_states("initializing", "initialized", "playing"))
        .alias("playstateChanged"),
        F.when(key % 17 != 0, F.lit(1)).alias("mediaOpenLatency"),
        F.lit(0).alias("bufferunderflow"),
        F.when(key % 23 != 0, F.lit(1)).alias("buffercount"),
        F.when(key % 29 != 0, F.lit(0.5)).alias("bufferratio"),
        F.concat(F.lit("lin:"), F.col("channel").cast("string")).alias("title"),
        F.col("o_orderdate").cast("date").alias("received_date"),
        F.timestamp_add("HOUR", ((key + F.col("hours_late")) % 24).cast("int"), F.col("o_orderdate").cast("timestamp_ntz")).alias(
            "az_insert_ts"
        ),
    )


def playback_raw_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed in its nested source layout (structs read by dotted paths)."""
    r = playback_raw(spark, sf_dir)
    return r.select(
        F.struct("accountSourceId", "deviceSourceId").alias("device"),
        F.struct("pluginSessionId", "playbackId").alias("session"),
        F.struct("assetclass", "title").alias("asset"),
        F.struct("applicationname").alias("application"),
        F.struct("bitrate", F.struct("clientGeneratedTimestamp").alias("timing")).alias("bitrateChanged"),
        F.struct("mediaOpenLatency", "bufferunderflow", "buffercount", "bufferratio").alias("metrics"),
        "eventtype",
        "starttime",
        "completionstatus",
        "sessionduration",
        "playstateChanged",
        "received_date",
        "az_insert_ts",
    )


def test_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dev = _devices(spark, sf_dir)
    return dev.where(F.col("c_custkey") % 50 == 7).select(mac_text(F.col("mac_num"), colons=True).alias("deviceSourceId"))


def channel_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")
    kind = F.when(k % 50 == 3, "4K").when(k % 4 == 0, "HD").when(k % 4 == 1, "HVQ").when(k % 4 == 2, "SD").otherwise("UHD")
    video = s.where(k % 10 != 9).select(
        k.cast("string").alias("source_id"), F.concat(F.lit("CH"), k.cast("string"), F.lit("_"), kind, F.lit("_E")).alias("ts_name")
    )
    audio = s.where(k % 10 == 5).select(
        k.cast("string").alias("source_id"),
        F.concat(F.lit("CH"), k.cast("string"), F.when(k % 20 == 5, "_Audio").otherwise("_Enh Audio")).alias("ts_name"),
    )
    return video.unionByName(audio)


def wifi_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly Wi-Fi gateway telemetry, one row per event."""
    e = table(spark, sf_dir, "events")
    dev = _devices(spark, sf_dir).select("c_custkey", "mac_num")
    j = e.join(dev, e.user_id == dev.c_custkey)
    eid = F.col("event_id")
    return j.select(
        F.concat(F.lit("a"), F.expr("user_id div 3").cast("string")).alias("HHID"),
        mac_text(F.col("mac_num") + 1, colons=False).alias("GW_MAC_ADDRESS"),
        mac_text(F.col("mac_num") + 2, colons=False).alias("DEVICE_MAC"),
        F.when(F.col("event_type") == "view", "Technicolor")
        .when(F.col("event_type") == "click", "ARRIS")
        .otherwise("Other")
        .alias("DEVICE_VENDOR"),
        F.col("event_type").alias("DEVICE_TAG"),
        (-(F.col("value") + 20.0)).alias("LAST_24H_MEDIAN_DEVICE_RSSI"),
        (-F.col("value")).alias("CURRENT_HR_DEVICE_RSSI"),
        (eid % 40).alias("CURRENT_HR_DEVICE_SNR"),
        (eid * 7 % 1000).alias("CURRENT_HR_DEVICE_RX"),
        (eid * 13 % 1000).alias("CURRENT_HR_DEVICE_TX"),
        (eid % 9).alias("CURRENT_HR_DEVICE_RET"),
        F.get_json_object("props", "$.k").cast("int").alias("WIFI_HAPPINESS_INDEX"),
        F.col("ts").alias("DATE_TIME"),
        F.col("ts").cast("date").alias("received_date"),
    )
