"""Pre-processing: raw playback telemetry -> base table.

The reference flattens every playback into (bitrate rung x event time) rows by
exploding three arrays and de-duplicating. Here a playback stays one row
(``playback_base``) carrying the distinct rungs and event times plus the number
of base rows it stands for (``n_events``); ``base_table`` explodes it only when
the flat grain is asked for. All KPIs are computed from the compact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qoeflow.config import DEFAULT, QoeConfig
from qoeflow.functions.ladder import channel_id, stream_type
from qoeflow.schema import PLACE
from qoeflow.session import handoff

KEYS4 = ["accountSourceId", "deviceSourceId", "pluginSessionId", "playbackId"]
KEYS3 = KEYS4[:3]
KEYS2 = KEYS4[:2]

# Columns of a raw row that decide its base-table rows (the reference's distinct
# key before exploding).
RAW_KEY = [
    "accountSourceId", "deviceSourceId", "starttime", "sessionduration", "gracenoteId", "bitrate",
    "pluginSessionId", "playbackId", "clientGeneratedTimestamp", "az_insert_ts",
]
BASE_COLUMNS = [
    "gracenoteId", "accountSourceId", "deviceSourceId", "starttime", "sessionduration", "bitrate",
    "pluginSessionId", "playbackId", "ff_shifts_present", "clientGeneratedTimestamp_flattened",
    "clientGeneratedTimestamp", "bitrate_flattened", "az_insert_ts", "ts_name", "stream_type",
]


def with_channel_id(df: DataFrame) -> DataFrame:
    """PRE1: ``gracenoteId`` = second ``:`` field of the title."""
    return df.withColumn("gracenoteId", channel_id("title"))


def eligible(df: DataFrame, cfg: QoeConfig = DEFAULT) -> DataFrame:
    """PRE2: finished linear playbacks on the target box with complete metrics."""
    c = F.col
    return df.where(
        (c("eventtype") == cfg.end_event)
        & (c("applicationname") == cfg.application)
        & (c("assetclass") == cfg.asset_class)
        & c("sessionduration").between(cfg.min_duration_ms, cfg.max_duration_ms)
        & c("mediaOpenLatency").isNotNull()
        & c("buffercount").isNotNull()
        & c("bufferratio").isNotNull()
        & (c("completionstatus") != cfg.failed_status)
        & c("bitrate").isNotNull()
    )


def playing(df: DataFrame, cfg: QoeConfig = DEFAULT, col: str = "playstateChanged") -> DataFrame:
    """PRE3: keep playbacks whose play-state list has a start-up state (no explode)."""
    states = list(cfg.playing_states)
    elem = df.schema[col].dataType.elementType
    value = (lambda s: s["value"]) if hasattr(elem, "fields") else (lambda s: s)
    return df.where(F.exists(col, lambda s: value(s).isin(states)))


def events_after_start(df: DataFrame) -> DataFrame:
    """PRE4: distinct event times strictly after the start (``events``)."""
    after = F.filter("clientGeneratedTimestamp", lambda t: t > F.col("starttime"))
    return df.withColumn("events", F.array_distinct(after))


def drop_fast_forward(df: DataFrame, cfg: QoeConfig = DEFAULT) -> DataFrame:
    """PRE5: distinct rungs without the fast-forward rung (``rungs``).

    Rows at the fast-forward rate are dropped, not playbacks: a playback goes
    only when every rung is fast-forward. A NULL rung is kept.
    """
    ff = cfg.fast_forward_bitrate
    kept = F.filter("bitrate", lambda b: b.isNull() | (b != ff))
    return df.withColumn("rungs", F.array_distinct(kept))


def flatten(df: DataFrame) -> DataFrame:
    """PRE6: one row per (rung, event time) of each compact row: the base-table grain."""
    return (
        df.withColumn("bitrate_flattened", F.explode("rungs"))
        .withColumn("clientGeneratedTimestamp_flattened", F.explode("events"))
        .withColumn("ff_shifts_present", F.lit(0))
    )


def row_digest(columns: list[str]) -> Column:
    """16 bytes that equal rows share: MD5 of the named columns' JSON (texts, numbers and arrays of them; times as text)."""
    plain = [F.col(c).cast("string").alias(c) if c == "az_insert_ts" else F.col(c) for c in columns]
    return F.unhex(F.md5(F.to_json(F.struct(*plain), {"ignoreNullFields": "false"})))


def deduplicated(df: DataFrame) -> DataFrame:
    """PRE6: the distinct ``RAW_KEY`` rows.

    Where the rows have a ``PLACE``, only a digest and the place of each are grouped. Digests that occur more than
    once are stored with the least place among their rows, and every row looks its digest up there: repeats
    go before their arrays are shuffled, and where the repeated digests are few enough to be broadcast (the planner
    knows their stored size; one entry for all copies of a row) no array is shuffled at all. Two different rows share
    a digest, or a repeat its first row's place, with a chance of some n / 2^64. Without a place the rows are their own key.
    """
    if PLACE not in df.columns:
        return df.select(*RAW_KEY).dropDuplicates(RAW_KEY)
    keyed = df.select(*RAW_KEY, PLACE, row_digest(RAW_KEY).alias("_digest"))
    groups = keyed.groupBy("_digest").agg(F.min(PLACE).alias("_first"), F.count(F.lit(1)).alias("_n"))
    repeated = handoff(groups.where("_n > 1").drop("_n"), "repeated-rows")
    kept = keyed.join(repeated, "_digest", "left").where(F.col("_first").isNull() | (F.col("_first") == F.col(PLACE)))
    return kept.select(*RAW_KEY)


def drop_test_devices(df: DataFrame, test_devices: DataFrame) -> DataFrame:
    """PRE7: remove lab / test set-top boxes (anti join on the device id).

    No hint: the planner's byte-based threshold and AQE choose between a broadcast and a shuffle.
    """
    return df.join(test_devices.select("deviceSourceId"), "deviceSourceId", "left_anti")


def classify_stream(dim: DataFrame, cfg: QoeConfig = DEFAULT) -> DataFrame:
    """PRE8: channel dimension keyed by ``gracenoteId`` with its ``stream_type``."""
    return dim.select(
        F.col("source_id").alias("gracenoteId"), "ts_name", stream_type("ts_name", cfg).alias("stream_type")
    )


def join_channel(df: DataFrame, channels: DataFrame) -> DataFrame:
    """PRE9: attach transport stream(s) of the channel; fans out when a channel has several."""
    return df.join(channels, "gracenoteId", "inner")


def prepared(raw: DataFrame, cfg: QoeConfig = DEFAULT) -> DataFrame:
    """PRE1-6 without the explode: eligible, de-duplicated raw rows with their rungs/events."""
    df = playing(eligible(with_channel_id(raw), cfg), cfg)
    df = drop_fast_forward(events_after_start(deduplicated(df)), cfg)
    n = F.size("rungs") * F.size("events")
    return df.withColumn("n_events", n).where(F.col("n_events") > 0)


def playback_base(raw: DataFrame, test_devices: DataFrame, channel_dim: DataFrame,
                  cfg: QoeConfig = DEFAULT) -> DataFrame:
    """Compact base table: one row per (raw playback, transport stream), ``n_events`` =
    number of flat base-table rows it stands for."""
    df = drop_test_devices(prepared(raw, cfg), test_devices)
    return join_channel(df, classify_stream(channel_dim, cfg))


def base_table(raw: DataFrame, test_devices: DataFrame, channel_dim: DataFrame,
               cfg: QoeConfig = DEFAULT) -> DataFrame:
    """PRE10: the flat base table (reference grain)."""
    return flatten(playback_base(raw, test_devices, channel_dim, cfg)).select(*BASE_COLUMNS)
