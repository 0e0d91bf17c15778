"""The daily job as one lazy plan: base -> KPIs -> levels -> scores -> Wi-Fi.

``Stages`` builds each stage once from the previous ones (DataFrame -> DataFrame) and
keeps the frame of each (KPI, level). With ``materialize`` a stage that several others
read is written once as a hand-off table and read back; without, nothing runs until a
stage is written or collected. ``plans.daily.run`` writes every stage and puts the
tables it reads back in place of the frames.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qoeflow.config import DEFAULT, QoeConfig
from qoeflow.operators import kpi, prep, rollup, score, wifi
from qoeflow.operators.prep import KEYS2, KEYS3, KEYS4
from qoeflow.operators.skew import attach
from qoeflow.session import handoff


@dataclass(frozen=True)
class Kpi:
    value: str  # playback-level column
    avg: str  # level mean column
    norm: str  # normalized column
    bounds: str  # QoeConfig attribute
    keep_nonneg: bool  # drop negative session means
    mult: str | None  # row multiplicity column of the detail


KPIS = {
    "tttp": Kpi("tttp", "weighted_average_tttp", "normalized_tttp", "tttp", True, None),
    "stp": Kpi("percentage_of_stp_time", "weighted_average_stp", "normalized_stp", "sst", True, kpi.MULT),
    "ptbtp": Kpi("percentage_below_top_profile", "weighted_average_ptbtp", "normalized_weighted_average_ptbtp",
                 "ptbtp", True, kpi.MULT),
    "brs": Kpi("total_shifts", "weighted_average_bitrate", "normalized_weighted_average_bitrate", "brs", False, None),
}
LEVEL_KEYS = {"session": KEYS3, "device": KEYS2, "account": KEYS2[:1]}
SCORE_COLUMN = {"session": "session_score", "device": "device_score", "account": "account_score"}


class Stages:
    def __init__(self, raw: DataFrame, test_devices: DataFrame, channel_dim: DataFrame,
                 wifi_raw: DataFrame | None, cfg: QoeConfig, run_date: str, materialize: bool = True):
        self.raw, self.test_devices, self.channel_dim, self.wifi_raw = raw, test_devices, channel_dim, wifi_raw
        self.cfg, self.run_date, self.materialize = cfg, run_date[:10], materialize
        self._hist: dict[tuple[str, str], DataFrame] = {}
        self._score_detail: dict[str, DataFrame] = {}

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        return handoff(df, name) if self.materialize else df

    # --- pre-processing ---------------------------------------------------------------------
    @cached_property
    def base(self) -> DataFrame:
        """Compact base table (one row per playback x transport stream).

        Every KPI reads it, so with ``materialize`` it is a hand-off table.
        """
        return self._kept(prep.playback_base(self.raw, self.test_devices, self.channel_dim, self.cfg), "base")

    def base_flat(self) -> DataFrame:
        return prep.flatten(self.base).select(*prep.BASE_COLUMNS)

    # --- playback KPIs ----------------------------------------------------------------------
    @cached_property
    def tttp(self) -> DataFrame:
        return self._kept(kpi.time_to_top(self.base, self.cfg), "tttp")

    @cached_property
    def stp(self) -> DataFrame:
        return self._kept(kpi.startup(self.base, self.cfg), "stp")

    @cached_property
    def ptbtp(self) -> DataFrame:
        return self._kept(kpi.pct_below_top(self.base, self.stp, self.cfg), "ptbtp")

    def ptbtp_flat(self) -> DataFrame:
        """The same at the reference's grain: a row per start-up row of the flat base table."""
        return kpi.pct_below_top(self.base, kpi.startup_flat(self.base), self.cfg)

    @cached_property
    def brs(self) -> DataFrame:
        return self._kept(kpi.bitrate_shifts(self.base), "brs")

    def detail(self, name: str) -> DataFrame:
        return getattr(self, name)

    # --- levels -----------------------------------------------------------------------------
    def hist(self, name: str, level: str) -> DataFrame:
        """Unclipped level means: session from the detail, device from session, account from device."""
        if (name, level) not in self._hist:
            k = KPIS[name]
            if "sessions" in self.__dict__:
                wide = self.wide(level)
                df = rollup.stamp(wide.where(f"has_{name}").select(*LEVEL_KEYS[level], k.avg), self.run_date)
            elif level == "session":
                df = rollup.session_mean(self.detail(name), k.value, k.avg, k.keep_nonneg, k.mult)
                df = self._kept(rollup.stamp(df, self.run_date), f"{name}-session")
            elif level == "device":
                df = rollup.stamp(rollup.device_mean(self.hist(name, "session"), k.avg), self.run_date)
            else:
                df = rollup.stamp(rollup.account_mean(self.hist(name, "device"), k.avg), self.run_date)
            self._hist[name, level] = df
        return self._hist[name, level]

    @cached_property
    def sessions(self) -> DataFrame:
        """The four KPIs' session means side by side (``rollup.fused_session_means``). Once this is made, the
        level tables of each KPI are read from it; queries of a single KPI don't make it."""
        details = {n: (self.detail(n), k.value, k.mult) for n, k in KPIS.items()}
        wide = rollup.fused_session_means(details, {n: k.avg for n, k in KPIS.items()}, {n: k.keep_nonneg for n, k in KPIS.items()})
        return self._kept(wide, "sessions")

    def wide(self, level: str) -> DataFrame:
        """The four KPIs' level means side by side: one aggregate per level."""
        if level == "session":
            return self.sessions
        outs = {n: k.avg for n, k in KPIS.items()}
        devices = self._devices if "_devices" in self.__dict__ else rollup.level_means(self.sessions, KEYS2, outs)
        return devices if level == "device" else rollup.level_means(devices, LEVEL_KEYS["account"], outs)

    def set_devices(self, df: DataFrame) -> None:
        """Put the device table that was written and read back in place of its plan."""
        self._devices = df

    def set_hist(self, name: str, level: str, df: DataFrame) -> None:
        """Put a level table that was written and read back in place of its plan."""
        self._hist[name, level] = df

    def normalized(self, name: str, level: str) -> DataFrame:
        k = KPIS[name]
        return rollup.normalize(self.hist(name, level), k.avg, k.norm, getattr(self.cfg, k.bounds))

    def level_values(self, name: str, level: str) -> DataFrame:
        """Level table with the unclipped mean and the normalized value (device/account)."""
        k = KPIS[name]
        h = self.hist(name, level)
        norm = rollup.normalize(h.withColumn("_v", F.col(k.avg)), "_v", k.norm, getattr(self.cfg, k.bounds))
        return norm.drop("_v")

    # --- scores -----------------------------------------------------------------------------
    SESSION_SIDES = {
        "ptbtp": ["sessionduration", "stream_type", "time_below_top_profile", "time_at_top_profile",
                  "percentage_below_top_profile"],
        "tttp": ["tttp", "az_insert_ts"],
        "brs": ["total_shifts"],
        "stp": ["starttime", "stp_time", "percentage_of_stp_time"],
    }

    @cached_property
    def combined_session(self) -> DataFrame:
        """Playback rows of the four KPIs, each with its session value.

        Same result as joining every KPI's playback rows to its session table and then
        chaining the four on the playback keys, with one session join instead
        of four: the playback rows are chained first, then all session values are
        attached at once, and a KPI's columns are kept only where both its playback
        row and its session value exist (as the per-KPI inner join would).
        """
        sides = {}
        for name, cols in self.SESSION_SIDES.items():
            d = self.detail(name).select(*KEYS4, *cols).distinct()
            sides[name] = d if name == "ptbtp" else d.withColumn(f"_row_{name}", F.lit(True))
        rows = sides["ptbtp"].join(sides["tttp"], KEYS4, "left").join(sides["brs"], KEYS4, "left").join(
            sides["stp"], KEYS4, "left")
        values = self.sessions.where("has_ptbtp").drop("has_ptbtp")
        for name in self.SESSION_SIDES:
            k = KPIS[name]
            values = rollup.normalize(values, k.avg, k.norm, getattr(self.cfg, k.bounds))
        j = attach(rows, values, KEYS3)  # inner: a playback row needs its session's % below top
        for name, cols in self.SESSION_SIDES.items():
            if name == "ptbtp":
                continue
            k = KPIS[name]
            ok = F.col(f"_row_{name}").isNotNull() & F.col(f"has_{name}")
            j = j.select(*[F.when(ok, F.col(c)).alias(c) if c in (*cols, k.avg, k.norm) else F.col(c)
                           for c in j.columns])
        order = [*KEYS4]
        for name in ("tttp", "ptbtp", "brs", "stp"):
            order += [*self.SESSION_SIDES[name], KPIS[name].avg, KPIS[name].norm]
        return self._kept(score.combine_session_rows(j.select(*order), self.run_date), "combined-session")

    @cached_property
    def combined_device(self) -> DataFrame:
        return self._combined_level("device")

    @cached_property
    def combined_account(self) -> DataFrame:
        return self._combined_level("account")

    def _combined_level(self, level: str) -> DataFrame:
        values = {n: (KPIS[n].avg, KPIS[n].norm, getattr(self.cfg, KPIS[n].bounds)) for n in ("tttp", "ptbtp", "stp", "brs")}
        return score.combine_wide(self.wide(level), LEVEL_KEYS[level], values, self.run_date)

    def combined(self, level: str) -> DataFrame:
        """Rows of all four KPIs; read by the score and by its join-back."""
        return getattr(self, f"combined_{level}")

    def score(self, level: str, sizes: bool = False) -> DataFrame:
        return score.score(self.combined(level), LEVEL_KEYS[level], SCORE_COLUMN[level], self.cfg, sizes)

    def score_detail(self, level: str) -> DataFrame:
        if level not in self._score_detail:
            self._score_detail[level] = score.score_detail(self.combined(level), self.score(level, sizes=level == "session"),
                                                           LEVEL_KEYS[level], unique=level != "session")
        return self._score_detail[level]

    def set_score_detail(self, level: str, df: DataFrame) -> None:
        self._score_detail[level] = df

    # --- Wi-Fi ------------------------------------------------------------------------------
    def wifi(self, run_date: str | None = None) -> DataFrame:
        if self.wifi_raw is None:
            raise ValueError("no Wi-Fi feed given")
        return wifi.wifi_slice(self.wifi_raw, run_date, self.cfg)

    def _seen_by(self, wifi_rows: DataFrame) -> Stages:
        """The stages of the playbacks whose device has a reading in ``wifi_rows``.

        Sessions and devices lie within a device, so the scores of the devices that stay are the same, and
        what the joins below would drop is never flattened, rolled up or scored. Where the score is there
        already (the daily job), it is used as it is.
        """
        if self._score_detail:
            return self
        devices = wifi_rows.select(F.col("deviceSourceId").alias("_mac")).distinct()
        raw = self.raw.join(devices, wifi.plain_mac("deviceSourceId") == F.col("_mac"), "left_semi")
        return Stages(raw, self.test_devices, self.channel_dim, self.wifi_raw, self.cfg, self.run_date, self.materialize)

    def wifi_session_hour(self, run_date: str | None = None, with_account: bool = False) -> DataFrame:
        readings = self.wifi(run_date)
        return wifi.session_hour(self._seen_by(readings).score_detail("session"), readings, with_account)

    def wifi_device(self, run_date: str | None = None) -> DataFrame:
        readings = self.wifi(run_date)
        return wifi.device_join(self._seen_by(readings).score_detail("device"), wifi.device_max(readings))
