"""Composite 0-100 score per session, device and account."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from qoeflow.config import DEFAULT, Bounds, QoeConfig
from qoeflow.operators.prep import KEYS3
from qoeflow.operators.rollup import mean, normalize
from qoeflow.operators.skew import SIZE, attach, group_rows

NORMALIZED = {
    "tttp": "normalized_tttp",
    "stp": "normalized_stp",
    "ptbtp": "normalized_weighted_average_ptbtp",
    "brs": "normalized_weighted_average_bitrate",
}


def fill_numeric(df: DataFrame, exclude: tuple = ()) -> DataFrame:
    """SCO3: missing KPI values count as 0 (numeric columns only)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]
    return df.na.fill(0, subset=cols) if cols else df


def combine_session_rows(rows: DataFrame, run_date: str) -> DataFrame:
    """SCO3 on already-combined session rows: stamp, fill numeric gaps (not ``tttp``),
    de-duplicate, keep rows with an account and a stream type."""
    combined = fill_numeric(rows.withColumn("event_date", F.lit(run_date[:10])), exclude=("tttp",)).distinct()
    return combined.where(F.col("accountSourceId").isNotNull() & F.col("stream_type").isNotNull())


def combine_levels(tttp: DataFrame, ptbtp: DataFrame, sst: DataFrame, brs: DataFrame, keys: list[str],
                   run_date: str) -> DataFrame:
    """SCO2/3 at device or account level: full outer join of the four level tables."""
    on = keys + ["event_date"]
    combined = tttp.join(ptbtp, on, "full").join(sst, on, "full").join(brs, on, "full")
    combined = fill_numeric(combined.withColumn("event_date", F.lit(run_date[:10]))).distinct()
    return combined.where(F.col("accountSourceId").isNotNull())


def combine_wide(level: DataFrame, keys: list[str], values: dict[str, tuple[str, str, Bounds]], run_date: str) -> DataFrame:
    """SCO2/3 from a table that holds the KPIs' level means side by side (``rollup.level_means``).

    The same rows as :func:`combine_levels` over one table per KPI: a key that has any KPI is a row, a KPI it
    lacks is NULL, normalized values included, and counts as 0. Keys are unique, so nothing is joined or
    shuffled, and nothing has to be de-duplicated. ``values``: mean, normalized column and bounds of each KPI.
    """
    any_kpi = reduce(lambda a, b: a | b, [F.col(f"has_{n}") for n in values])
    rows = level.where(any_kpi & F.col("accountSourceId").isNotNull()).withColumn("event_date", F.lit(run_date[:10]))
    for avg, norm, bounds in values.values():
        rows = normalize(rows.withColumn("_v", F.col(avg)), "_v", norm, bounds).drop("_v")
    columns = [c for avg, norm, _ in values.values() for c in (avg, norm)]
    return fill_numeric(rows.select(*keys, "event_date", *columns))


def score_expr(cfg: QoeConfig = DEFAULT):
    c = F.col
    penalty = (
        F.lit(cfg.weight_ptbtp) * c(NORMALIZED["ptbtp"])
        + F.lit(cfg.weight_tttp) * c(NORMALIZED["tttp"])
        + F.lit(cfg.weight_brs) * c(NORMALIZED["brs"])
        + F.lit(cfg.weight_sst) * c(NORMALIZED["stp"])
    )
    return F.lit(100) * (F.lit(1) - penalty)


def score(combined: DataFrame, keys: list[str], out: str, cfg: QoeConfig = DEFAULT, sizes: bool = False) -> DataFrame:
    """SCO4/5: level mean of the four normalized KPIs over the combined rows -> score (``sizes``: and the number of rows)."""
    means = combined.groupBy(*keys).agg(*[mean(F.col(v)).alias(v) for v in NORMALIZED.values()], group_rows())
    return means.select(*keys, score_expr(cfg).alias(out), *[SIZE] * sizes)


def score_detail(combined: DataFrame, scores: DataFrame, keys: list[str], unique: bool = False) -> DataFrame:
    """SCO6: combined rows with their level's score. A level key may hold many rows (``scores`` has their number); where
    it is ``unique``, both sides have the keys' partitioning already and nothing is shuffled."""
    return combined.join(scores, keys) if unique else attach(combined, scores, keys)


SESSION_KEYS = KEYS3
DEVICE_KEYS = KEYS3[:2]
ACCOUNT_KEYS = KEYS3[:1]
