"""The daily job: one received day of telemetry -> all stage tables.

Every stage is written as the day's partition of its table (re-running a day replaces that
day only, also when it is empty) and read back; the next stage is planned on what was read
back, so no stage is computed twice and a lost executor costs at most the running stage.

Tables (``out_dir/<name>/event_date=<day>``):

* ``base`` compact base table (playback x stream, with ``n_events``)
* ``{kpi}_detail`` for kpi in tttp, stp, ptbtp, brs (stp/ptbtp carry ``n_rows``)
* ``sessions``, ``devices`` the level means of the four KPIs side by side (one pass for all four)
* ``{kpi}_{level}_hist`` unclipped level means, ``{kpi}_{level}`` clipped + normalized
* ``combined_{level}`` rows of all four KPIs, ``score_{level}_detail`` with the level score
* ``wifi_session_hour``, ``wifi_device`` (when a Wi-Fi feed is given)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qoeflow import schema
from qoeflow.config import DEFAULT, QoeConfig
from qoeflow.operators import rollup
from qoeflow.plans.stages import KPIS, Stages
from qoeflow.session import require
from qoeflow.sources import sinks, tables

LEVELS = ("session", "device", "account")


def run(raw: DataFrame, test_devices: DataFrame, channel_dim: DataFrame, run_date: str, out_dir: str,
        wifi_raw: DataFrame | None = None, cfg: QoeConfig = DEFAULT) -> dict[str, str]:
    """Run every stage for ``run_date``. ``raw`` (nested as it comes, or flat) and ``wifi_raw`` may hold
    more days; only that received day is read. ``out_dir`` is a folder, or the name of a catalog database, whose
    tables other jobs read by name. Returns table name -> path or catalog name."""
    require(raw.sparkSession)
    day = run_date[:10]
    st = Stages(tables.playback_day(tables.placed(raw), day), test_devices, channel_dim, wifi_raw, cfg, day, materialize=False)
    paths: dict[str, str] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        """Write the day of a stage table; the frame to go on with is the day read back."""
        paths[name] = f"{out_dir}/{name}" if sinks.is_path(out_dir) else f"{out_dir}.{name}"
        sinks.append_history(df, paths[name], day)
        back = sinks.read_day(df.sparkSession, paths[name], day)
        return rollup.stamp(back, day) if "event_date" in df.columns else back

    st.base = keep("base", st.base)
    for name in KPIS:
        setattr(st, name, keep(f"{name}_detail", st.detail(name)))
    st.sessions = keep("sessions", st.sessions)
    st.set_devices(keep("devices", st.wide("device")))
    for name in KPIS:
        for level in LEVELS:
            st.set_hist(name, level, keep(f"{name}_{level}_hist", st.hist(name, level)))
            keep(f"{name}_{level}", st.normalized(name, level))
    for level in LEVELS:
        setattr(st, f"combined_{level}", keep(f"combined_{level}", st.combined(level)))
        st.set_score_detail(level, keep(f"score_{level}_detail", st.score_detail(level)))
    if wifi_raw is not None:
        keep("wifi_session_hour", st.wifi_session_hour(day))
        keep("wifi_device", st.wifi_device(day))
    return paths


def run_tables(spark: SparkSession, run_date: str, out_dir: str, playback_table: str, test_devices_table: str,
               channel_table: str, wifi_table: str | None = None, cfg: QoeConfig = DEFAULT) -> dict[str, str]:
    """``run`` over tables given by name or path: the nested feed, and the other inputs with their
    schemas checked first."""
    raw = tables.get_data(playback_table, spark=spark)
    test = schema.check(tables.get_data(test_devices_table, spark=spark), schema.TEST_DEVICES)
    dim = schema.check(tables.get_data(channel_table, spark=spark), schema.CHANNEL_DIM)
    wifi = schema.check(tables.get_data(wifi_table, spark=spark), schema.WIFI_RAW) if wifi_table else None
    return run(raw, test, dim, run_date, out_dir, wifi, cfg)
