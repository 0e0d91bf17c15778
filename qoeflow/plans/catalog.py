"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's parquet tables (through ``sources.fixtures``) and
runs on all of it. Outputs are made comparable with the DuckDB oracle by
``finish``: doubles rounded to 6 places, timestamps / dates as text, arrays as
comma-joined text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qoeflow.config import DEFAULT, FIXTURE_TUNING, QoeConfig
from qoeflow.operators import kpi, prep, trends, wifi
from qoeflow.operators.prep import KEYS4
from qoeflow.plans.stages import Stages
from qoeflow.session import require, shared_dir
from qoeflow.sources import fixtures as fx
from qoeflow.sources import sinks, tables

RUN_DATE = "1998-10-03"  # stamp of the level tables; also the day of ``daily_slice``
WIFI_DAY = "2024-01-10"


def round6(c):
    """Half-up to 6 decimals in decimal arithmetic, as the oracle does: the double is
    first taken to 12 decimals (Spark's double -> decimal cast, half-up on the shortest
    decimal text), which absorbs last-bit differences from summation order, then
    rounded. The reference rounds to 3 and 10 places, so exact half-way values at 6
    places are common and must be rounded by one rule on both sides."""
    dec = F.round(c.cast("decimal(38,12)"), 6).cast("double")
    return F.when(F.abs(c) < 1e12, dec).otherwise(c)


def finish(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = round6(c.cast("double"))
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), ",", "NULL")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def stages(spark: SparkSession, sf_dir: str, cfg: QoeConfig = DEFAULT, materialize: bool = True) -> Stages:
    require(spark)
    return Stages(
        fx.playback_raw(spark, sf_dir), fx.test_accounts(spark, sf_dir), fx.channel_dim(spark, sf_dir),
        fx.wifi_raw(spark, sf_dir), cfg, RUN_DATE, materialize,
    )


# --- sources and sinks ----------------------------------------------------------------------

def q_scan_project(spark, sf_dir):
    cols = ["device.accountSourceId", "device.deviceSourceId", "session.pluginSessionId", "session.playbackId",
            "asset.assetclass", "asset.title", "eventtype", "sessionduration"]
    return tables.get_data(fx.playback_raw_nested(spark, sf_dir), cols)


def q_scan_distinct(spark, sf_dir):
    return tables.get_distinct_data(fx.playback_raw_nested(spark, sf_dir),
                                    ["device.accountSourceId", "asset.assetclass", "asset.title"])


def q_daily_slice(spark, sf_dir):
    return tables.daily_slice(fx.playback_raw_nested(spark, sf_dir), RUN_DATE).drop("playstateChanged")


def _sink_root(spark) -> str:
    return f"{shared_dir(spark)}/qoeflow-sinks/{uuid.uuid4().hex}"


def q_sink_replace(spark, sf_dir):
    path = f"{_sink_root(spark)}/bitrate_shifts_detail"
    s = stages(spark, sf_dir, materialize=False)
    sinks.replace_table(s.brs.limit(0), path)  # a first run
    return sinks.replace_table(s.brs, path)  # the re-run replaces it


def q_sink_replace_named(spark, sf_dir):
    """SNK1 by catalog name: a first run, then the re-run that replaces it."""
    name = f"qoeflow_{uuid.uuid4().hex}"
    s = stages(spark, sf_dir, materialize=False)
    sinks.replace_table(s.brs.limit(0), name)
    return sinks.replace_table(s.brs, name)


def q_sink_history_named(spark, sf_dir):
    """SNK2 by catalog name: all score histories' days of the device level, and a day that is run twice."""
    name = f"qoeflow_{uuid.uuid4().hex}"
    raw = fx.playback_raw_nested(spark, sf_dir)
    for day in (*HISTORY_DAYS, HISTORY_DAYS[1]):
        s = Stages(tables.playback_day(raw, day), fx.test_accounts(spark, sf_dir), fx.channel_dim(spark, sf_dir), None, DEFAULT, day)
        out = sinks.append_history(s.score_detail("device"), name, day)
    return out


# Two received days of the fixture; the second is run twice.
HISTORY_DAYS = ("1995-07-12", "1997-02-01")


def _history_query(level: str):
    def q(spark, sf_dir):
        """SNK2: the score history of two days, each scored from its own slice of the feed."""
        path = f"{_sink_root(spark)}/score_{level}_history"
        raw = fx.playback_raw_nested(spark, sf_dir)
        for day in (*HISTORY_DAYS, HISTORY_DAYS[1]):
            s = Stages(tables.playback_day(raw, day), fx.test_accounts(spark, sf_dir), fx.channel_dim(spark, sf_dir),
                       None, DEFAULT, day)
            out = sinks.append_history(s.score_detail(level), path, day)
        return out
    return q


# --- pre-processing -------------------------------------------------------------------------

def q_prep_channel_id(spark, sf_dir):
    return prep.with_channel_id(fx.playback_raw(spark, sf_dir)).select("playbackId", "title", "gracenoteId")


def q_prep_eligible(spark, sf_dir):
    return prep.eligible(fx.playback_raw(spark, sf_dir)).select(*KEYS4, "sessionduration", "completionstatus")


def q_prep_playstate(spark, sf_dir):
    return prep.playing(fx.playback_raw(spark, sf_dir)).select("playbackId", "eventtype")


def q_prep_events_after_start(spark, sf_dir):
    df = prep.events_after_start(fx.playback_raw(spark, sf_dir))
    return df.select("playbackId", "starttime", F.explode("events").alias("clientGeneratedTimestamp_flattened"))


def q_prep_fast_forward(spark, sf_dir):
    df = prep.drop_fast_forward(fx.playback_raw(spark, sf_dir))
    return df.select("playbackId", F.explode("rungs").alias("bitrate_flattened"),
                     F.lit(0).alias("ff_shifts_present")).distinct()


FLAT13 = [c for c in prep.BASE_COLUMNS if c not in ("ts_name", "stream_type")]


def q_prep_flatten(spark, sf_dir):
    return prep.flatten(prep.prepared(fx.playback_raw(spark, sf_dir))).select(*FLAT13)


def q_prep_flatten_stored(spark, sf_dir):
    """PRE6 over a stored feed, whose rows have a place: repeats are found by digests."""
    path = f"{_sink_root(spark)}/feed"
    fx.playback_raw(spark, sf_dir).write.parquet(path)
    return prep.flatten(prep.prepared(tables.placed(spark.read.parquet(path)))).select(*FLAT13)


def q_prep_anti_test_devices(spark, sf_dir):
    df = prep.drop_test_devices(prep.prepared(fx.playback_raw(spark, sf_dir)), fx.test_accounts(spark, sf_dir))
    return prep.flatten(df).select(*FLAT13)


def q_prep_stream_type(spark, sf_dir):
    return prep.classify_stream(fx.channel_dim(spark, sf_dir))


def q_prep_channel_join(spark, sf_dir):
    df = prep.join_channel(prep.prepared(fx.playback_raw(spark, sf_dir)),
                           prep.classify_stream(fx.channel_dim(spark, sf_dir)))
    return prep.flatten(df).select(*prep.BASE_COLUMNS)


def q_base_table_day(spark, sf_dir):
    """SRC3 -> PRE1..9: one received day of the nested feed."""
    raw = tables.playback_day(fx.playback_raw_nested(spark, sf_dir), HISTORY_DAYS[0])
    return prep.base_table(raw, fx.test_accounts(spark, sf_dir), fx.channel_dim(spark, sf_dir))


def q_base_table(spark, sf_dir):
    return stages(spark, sf_dir, materialize=False).base_flat()


# --- playback KPIs --------------------------------------------------------------------------

def q_kpi_time_to_top(spark, sf_dir):
    return stages(spark, sf_dir, materialize=False).tttp


def q_kpi_startup(spark, sf_dir):
    return kpi.startup_flat(stages(spark, sf_dir, materialize=False).base)


def q_kpi_startup_dedupe(spark, sf_dir):
    """One row per playback instead of one per base row."""
    return stages(spark, sf_dir, replace(DEFAULT, sst_dedupe=True), materialize=False).stp.drop(kpi.MULT)


def q_kpi_timeline(spark, sf_dir):
    return kpi.timeline(kpi.ptbtp_input(stages(spark, sf_dir, materialize=False).base))


def q_kpi_event_rank(spark, sf_dir):
    return q_kpi_timeline(spark, sf_dir).select(*KEYS4, "stream_type", "col_rank", "bitrate")


def q_kpi_segment_diff(spark, sf_dir):
    return kpi.segments(kpi.ptbtp_input(stages(spark, sf_dir, materialize=False).base))


def q_kpi_last_event(spark, sf_dir):
    return kpi.last_event(kpi.ptbtp_input(stages(spark, sf_dir, materialize=False).base))


def q_kpi_tail_below(spark, sf_dir):
    return kpi.below_top_parts(stages(spark, sf_dir, materialize=False).base).select(
        *KEYS4, "stream_type", "sessionduration", "starttime", "below_time_after_last_timestamp")


def q_kpi_time_below(spark, sf_dir):
    return kpi.below_top_parts(stages(spark, sf_dir, materialize=False).base).select(
        *KEYS4, "stream_type", "time_below_top_profile")


def q_kpi_pct_below_top(spark, sf_dir):
    return stages(spark, sf_dir).ptbtp_flat()


def q_kpi_time_at_top(spark, sf_dir):
    return stages(spark, sf_dir).ptbtp.select(
        *KEYS4, "stream_type", "percentage_below_top_profile", "time_at_top_profile").distinct()


def q_kpi_bitrate_shifts(spark, sf_dir):
    return stages(spark, sf_dir, materialize=False).brs


# --- levels and normalization ----------------------------------------------------------------

KPI_QUERY_NAMES = {"tttp": "tttp", "sst": "stp", "ptbtp": "ptbtp", "brs": "brs"}


def _reads_base_twice(name: str) -> bool:
    """% below top joins two views of the base: worth one checkpoint. The other KPIs
    read it once, so it stays lazy."""
    return name == "ptbtp"


def _level_query(level: str, name: str):
    def q(spark, sf_dir):
        return stages(spark, sf_dir, materialize=_reads_base_twice(name)).hist(name, level)
    q.__name__ = f"q_{level}_{name}"
    return q


def _normalize_query(level: str, name: str):
    def q(spark, sf_dir):
        return stages(spark, sf_dir, FIXTURE_TUNING, _reads_base_twice(name)).normalized(name, level)
    return q


# --- scores ---------------------------------------------------------------------------------

def _combined_query(level: str):
    def q(spark, sf_dir):
        return stages(spark, sf_dir).combined(level)
    return q


def _score_query(level: str, cfg: QoeConfig = DEFAULT):
    def q(spark, sf_dir):
        return stages(spark, sf_dir, cfg).score(level)
    return q


def _score_detail_query(level: str):
    def q(spark, sf_dir):
        return stages(spark, sf_dir).score_detail(level)
    return q


# --- Wi-Fi ----------------------------------------------------------------------------------

def q_wifi_slice(spark, sf_dir):
    return wifi.wifi_slice(fx.wifi_raw(spark, sf_dir), WIFI_DAY)


def q_wifi_mac_align(spark, sf_dir):
    w = fx.wifi_raw(spark, sf_dir)
    return w.select("DEVICE_MAC", wifi.video_mac("DEVICE_MAC").alias("deviceSourceId")).distinct()


def q_wifi_session_hour(spark, sf_dir):
    return stages(spark, sf_dir).wifi_session_hour(WIFI_DAY)


def q_wifi_session_hour_account(spark, sf_dir):
    return stages(spark, sf_dir).wifi_session_hour(WIFI_DAY, with_account=True)


def q_wifi_device_max(spark, sf_dir):
    return wifi.device_max(wifi.wifi_slice(fx.wifi_raw(spark, sf_dir), WIFI_DAY))


def q_wifi_device(spark, sf_dir):
    return stages(spark, sf_dir).wifi_device(WIFI_DAY)


# --- trends ---------------------------------------------------------------------------------

def _events_daily(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    return e.select("user_id", F.col("ts").cast("date").alias("polling_date"), "value")


def q_activity_span(spark, sf_dir):
    return trends.activity_span(_events_daily(spark, sf_dir), "user_id", "polling_date", "active_days")


def q_minmax_scale(spark, sf_dir):
    p = fx.table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return trends.minmax_scale(p, "p_retailprice", 2000, 900)


def _chain_frames(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    events = fx.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("custkey")).agg(
        F.count(F.lit(1)).alias("n_events"))
    balances = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_acctbal")
    return [orders, events, balances]


def q_join_chain_inner(spark, sf_dir):
    return trends.join_frames(_chain_frames(spark, sf_dir), "inner", "custkey")


def q_join_chain_full(spark, sf_dir):
    return trends.join_frames(_chain_frames(spark, sf_dir), "full", "custkey")


def q_moving_avg_window(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return trends.moving_avg_rows(e, "user_id", "event_id", "value", "avg_value_last10", 10)


def _user_days(spark, sf_dir):
    d = _events_daily(spark, sf_dir)
    return d.groupBy("user_id", "polling_date").agg(F.avg("value").alias("day_value"))


def q_moving_avg_back(spark, sf_dir):
    return trends.moving_avg_days(_user_days(spark, sf_dir), ["day_value"], "polling_date", "user_id",
                                  ["avg_back_7d"], 7, 1, "minus")


def q_moving_avg_ahead(spark, sf_dir):
    return trends.moving_avg_days(_user_days(spark, sf_dir), ["day_value"], "polling_date", "user_id",
                                  ["avg_ahead_7d"], 1, 7, "plus")


def _lineitem(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem")


def q_count_in_range(spark, sf_dir):
    return trends.count_by_range(_lineitem(spark, sf_dir), "l_quantity", "l_returnflag", 20, 10)


def q_count_at_least(spark, sf_dir):
    return trends.count_by_range(_lineitem(spark, sf_dir), "l_quantity", "l_returnflag", "NULL", 10)


def q_count_at_most(spark, sf_dir):
    return trends.count_by_range(_lineitem(spark, sf_dir), "l_quantity", "l_returnflag", 20, "NULL")


def q_peak_usage(spark, sf_dir):
    return trends.peak_usage(_lineitem(spark, sf_dir), ["l_quantity", "l_extendedprice"], "l_suppkey")


def q_presence_ratio(spark, sf_dir):
    d = _events_daily(spark, sf_dir).withColumn("window_start", F.lit("2024-01-10").cast("date")).withColumn(
        "current_date", F.lit("2024-01-20").cast("date"))
    return trends.presence_ratio(d, "user_id", "window_start", "days_present", "presence_pct", 11)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable] = {
        "scan_project": q_scan_project,
        "scan_distinct": q_scan_distinct,
        "daily_slice": q_daily_slice,
        "sink_replace": q_sink_replace,
        "sink_replace_named": q_sink_replace_named,
        "sink_history_named": q_sink_history_named,
        "prep_channel_id": q_prep_channel_id,
        "prep_eligible": q_prep_eligible,
        "prep_playstate": q_prep_playstate,
        "prep_events_after_start": q_prep_events_after_start,
        "prep_fast_forward": q_prep_fast_forward,
        "prep_flatten": q_prep_flatten,
        "prep_flatten_stored": q_prep_flatten_stored,
        "prep_anti_test_devices": q_prep_anti_test_devices,
        "prep_stream_type": q_prep_stream_type,
        "prep_channel_join": q_prep_channel_join,
        "base_table": q_base_table,
        "base_table_day": q_base_table_day,
        "kpi_time_to_top": q_kpi_time_to_top,
        "kpi_startup": q_kpi_startup,
        "kpi_startup_dedupe": q_kpi_startup_dedupe,
        "kpi_timeline": q_kpi_timeline,
        "kpi_event_rank": q_kpi_event_rank,
        "kpi_segment_diff": q_kpi_segment_diff,
        "kpi_last_event": q_kpi_last_event,
        "kpi_tail_below": q_kpi_tail_below,
        "kpi_time_below": q_kpi_time_below,
        "kpi_pct_below_top": q_kpi_pct_below_top,
        "kpi_time_at_top": q_kpi_time_at_top,
        "kpi_bitrate_shifts": q_kpi_bitrate_shifts,
    }
    for level in ("session", "device", "account"):
        for qname, name in KPI_QUERY_NAMES.items():
            q[f"{level}_{qname}"] = _level_query(level, name)
    for qname, name in KPI_QUERY_NAMES.items():
        q[f"normalize_{qname}"] = _normalize_query("session", name)
        for level in ("device", "account"):
            q[f"normalize_{level}_{qname}"] = _normalize_query(level, name)
    for level in ("session", "device", "account"):
        q[f"combined_{level}"] = _combined_query(level)
        q[f"score_{level}"] = _score_query(level)
        q[f"score_{level}_tuned"] = _score_query(level, FIXTURE_TUNING)
        q[f"score_{level}_detail"] = _score_detail_query(level)
        q[f"sink_history_{level}"] = _history_query(level)
    q.update({
        "wifi_slice": q_wifi_slice,
        "wifi_mac_align": q_wifi_mac_align,
        "wifi_session_hour": q_wifi_session_hour,
        "wifi_session_hour_account": q_wifi_session_hour_account,
        "wifi_device_max": q_wifi_device_max,
        "wifi_device": q_wifi_device,
        "activity_span": q_activity_span,
        "minmax_scale": q_minmax_scale,
        "join_chain_inner": q_join_chain_inner,
        "join_chain_full": q_join_chain_full,
        "moving_avg_window": q_moving_avg_window,
        "moving_avg_back": q_moving_avg_back,
        "moving_avg_ahead": q_moving_avg_ahead,
        "count_in_range": q_count_in_range,
        "count_at_least": q_count_at_least,
        "count_at_most": q_count_at_most,
        "peak_usage": q_peak_usage,
        "presence_ratio": q_presence_ratio,
    })
    return {name: _finished(fn) for name, fn in q.items()}


def _finished(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(fn(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run
