"""Playback-level KPIs, computed in-row from the compact base table.

Each KPI keeps the reference's row grain (the set of distinct input rows it reads
from the base table). Where the reference reads the flat base table without a
distinct, the compact rows carry a multiplicity column (``n_rows``) instead of
physical copies; ``startup_flat`` and the join with it give the flat grain when it is
asked for, from the base table's own arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qoeflow.config import DEFAULT, QoeConfig
from qoeflow.functions import timeline as tl
from qoeflow.functions.ladder import top_bitrate
from qoeflow.operators.prep import KEYS4

MULT = "n_rows"


def identity(*arrays: str):
    """A digest that stands for whole arrays in a distinct, so that they are not shuffled."""
    return F.sha2(F.to_json(F.struct(*arrays)), 256)


# --- KPI1: time to top profile ------------------------------------------------------------

TTTP_INPUT = [
    "accountSourceId", "deviceSourceId", "sessionduration", "stream_type", "starttime", "pluginSessionId",
    "playbackId", "clientGeneratedTimestamp", "bitrate", "az_insert_ts",
]


def time_to_top(base: DataFrame, cfg: QoeConfig = DEFAULT) -> DataFrame:
    """Seconds until the top rung per distinct (playback, stream type, ingest time)."""
    tttp = tl.time_to_top(top_bitrate("stream_type", cfg))
    cols = [*KEYS4, "starttime", "sessionduration", "stream_type", "tttp", "az_insert_ts"]
    df = base.select(*TTTP_INPUT, tttp.alias("tttp")).where(F.col("tttp").isNotNull())
    return df.select(*cols, identity("clientGeneratedTimestamp", "bitrate").alias("_arrays")).distinct().select(*cols)


# --- KPI2: session start-up time ----------------------------------------------------------

SST_INPUT = KEYS4 + ["starttime", "sessionduration", "bitrate", "clientGeneratedTimestamp"]


def startup(base: DataFrame, cfg: QoeConfig = DEFAULT) -> DataFrame:
    """Start-up gap per base row: ``stp_time`` (ms) and its share of the session.

    Like the reference, one row per flat base row (multiplicity ``n_rows``); with
    ``cfg.sst_dedupe`` one row per distinct playback instead.
    """
    if cfg.sst_dedupe:
        df = base.select(*SST_INPUT).distinct().withColumn(MULT, F.lit(1).cast("bigint"))
    else:
        df = base.select(*SST_INPUT, F.col("n_events").cast("bigint").alias(MULT))
    return _startup_values(df, MULT)


def startup_flat(base: DataFrame) -> DataFrame:
    """The same with one row per flat base row: each (rung, event time) of a playback."""
    rows = _startup_values(base.select(*SST_INPUT, "rungs", "events"), "rungs", "events")
    copies = rows.withColumn("_rung", F.explode("rungs")).withColumn("_event", F.explode("events"))
    return copies.drop("rungs", "events", "_rung", "_event")


def _startup_values(df: DataFrame, *kept: str) -> DataFrame:
    stp = tl.startup_ms()
    out = df.select(
        *KEYS4,
        "starttime",
        "sessionduration",
        F.get("bitrate", 0).alias("stp_bitrate"),
        F.get("clientGeneratedTimestamp", 0).alias("stp_clientgeneratedtimestamp"),
        stp.alias("stp_time"),
        F.try_divide(stp, F.col("sessionduration")).alias("percentage_of_stp_time"),
        *kept,
    )
    return out.where((F.col("percentage_of_stp_time") >= 0) & (F.col("stp_time") >= 0))


# --- KPI3: percentage of time below the top profile -----------------------------------------

PTBTP_INPUT = [
    "accountSourceId", "deviceSourceId", "starttime", "stream_type", "sessionduration", "bitrate",
    "pluginSessionId", "playbackId", "clientGeneratedTimestamp",
]


def ptbtp_input(base: DataFrame) -> DataFrame:
    return base.select(*PTBTP_INPUT).distinct()


def timeline(rows: DataFrame, cfg: QoeConfig = DEFAULT) -> DataFrame:
    """KPI3a/b: one row per bitrate event with its 1-based rank in the playback."""
    top = top_bitrate("stream_type", cfg)
    ev = rows.select(*KEYS4, "stream_type", "starttime", "sessionduration",
                     F.posexplode(tl.events()).alias("pos", "e"))
    t = F.col("e")[tl.EVENT_TS]
    b = F.col("e")[tl.BITRATE]
    at_top = b == top
    return ev.select(
        *KEYS4, "stream_type",
        (F.col("pos") + 1).alias("col_rank"),
        b.alias("bitrate"),
        F.when(at_top, t).otherwise(F.lit(0).cast("bigint")).alias("top_profile_timestamp"),
        F.when(~at_top, t).otherwise(F.lit(0).cast("bigint")).alias("below_top_profile_timestamp"),
        F.when(top.isNull(), F.lit(0).cast("bigint")).otherwise(t).alias("timestamp"),
    )


def segments(rows: DataFrame, cfg: QoeConfig = DEFAULT) -> DataFrame:
    """KPI3c/d: per event the gap to the previous one and whether the previous rung was top."""
    top = top_bitrate("stream_type", cfg)
    return rows.select(
        *KEYS4, "stream_type", F.posexplode(tl.event_gaps(top, tl.events())).alias("pos", "g")
    ).select(*KEYS4, "stream_type", (F.col("pos") + 1).alias("col_rank"),
             F.col("g")["diff"].alias("diff"), F.col("g")["btp_flag"].alias("btp_flag"))


def last_event(rows: DataFrame, cfg: QoeConfig = DEFAULT) -> DataFrame:
    """KPI3e: last rung and its (ladder) timestamp per playback row."""
    top = top_bitrate("stream_type", cfg)
    last = F.element_at(tl.events(), -1)
    return rows.select(
        *KEYS4, "stream_type",
        last[tl.BITRATE].alias("last_bitrate"),
        F.when(top.isNull(), F.lit(0).cast("bigint")).otherwise(last[tl.EVENT_TS]).alias("last_timestamp"),
    )


def below_top_parts(base: DataFrame, cfg: QoeConfig = DEFAULT) -> DataFrame:
    """KPI3f/g: ``time_below_top_profile`` (between events) and
    ``below_time_after_last_timestamp`` (tail to the session end), distinct per
    (playback, stream type). Computed in-row before the distinct, so only scalar
    columns are shuffled."""
    top = top_bitrate("stream_type", cfg)
    ev = tl.events()
    return base.select(
        *KEYS4, "sessionduration", "starttime", "stream_type",
        tl.below_top_between_ms(top, ev).alias("time_below_top_profile"),
        tl.below_top_tail_ms(top, ev).alias("below_time_after_last_timestamp"),
    ).distinct()


def pct_below_top(base: DataFrame, sst: DataFrame, cfg: QoeConfig = DEFAULT) -> DataFrame:
    """KPI3h/i: percentage of the watched time (after start-up) spent below the top rung.

    Joined with the start-up detail on the playback keys, like the reference, so each
    playback row is weighted by its number of start-up rows (``n_rows``), or comes as often
    when ``sst`` is flat.
    """
    parts = below_top_parts(base, cfg)
    flat = MULT not in sst.columns
    mult = [] if flat else [MULT]
    stp = sst.select(*KEYS4, "stp_time") if flat else sst.groupBy(*KEYS4, "stp_time").agg(F.sum(MULT).alias(MULT))
    j = parts.join(stp, KEYS4, "inner")
    below = F.col("time_below_top_profile") + F.col("below_time_after_last_timestamp")
    watched_s = (F.col("sessionduration") - F.col("stp_time")) / 1000
    pct = F.round(F.try_divide(below / 1000, watched_s) * 100, 3)
    out = j.select(
        *KEYS4, "sessionduration", "starttime", "stream_type", "stp_time",
        below.alias("time_below_top_profile"), pct.alias("percentage_below_top_profile"), *mult,
    ).where(F.col("percentage_below_top_profile").between(0, 100))
    at_top = F.col("sessionduration").cast("bigint") - F.abs(
        F.col("time_below_top_profile").cast("bigint") - F.col("stp_time").cast("bigint")
    )
    return out.withColumn(
        "time_at_top_profile",
        F.when(F.col("percentage_below_top_profile").cast("int") == 100, F.lit(0).cast("bigint")).otherwise(at_top),
    ).drop("stp_time")


# --- KPI4: bitrate shifts -------------------------------------------------------------------


def bitrate_shifts(base: DataFrame) -> DataFrame:
    """Number of bitrate values per distinct playback."""
    cols = [*KEYS4, "sessionduration", "total_shifts"]
    df = base.select(*KEYS4, "sessionduration", F.size("bitrate").alias("total_shifts"), identity("bitrate").alias("_array"))
    return df.distinct().select(*cols)
