"""Weighting, level roll-ups and min-max normalization (generic over the four KPIs)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qoeflow.config import Bounds
from qoeflow.operators.prep import KEYS2, KEYS3
from qoeflow.operators.skew import SIZE, attach, attach_group_sum, group_rows

ACCOUNT = ["accountSourceId"]


def exact(value: Column, places: int) -> Column:
    """A double as a decimal of so many places (half-up), so that sums don't depend on their order."""
    return value.cast(f"decimal(28,{places})")


def mean(value: Column) -> Column:
    """Mean from an exact sum of the values, each taken to 15 places."""
    return F.sum(exact(value, 15)).cast("double") / F.count(value)


def session_mean(detail: DataFrame, value: str, out: str, keep_nonneg: bool = True,
                 mult: str | None = None) -> DataFrame:
    """AGG1/2: playback values -> duration-weighted session mean.

    ``w = round(duration / session total, 10)``; each row adds ``value`` when
    ``w == 1`` else ``round(value * w, 10)``. ``mult`` names a row-multiplicity
    column: a row with ``mult = k`` counts as k identical rows.

    The session total joins back as one row per session, so a hot session is spread over
    many tasks (see ``skew``); both sums are combined map-side. Terms are summed as decimals:
    the result does not depend on how the rows are partitioned.
    """
    m = F.col(mult) if mult else F.lit(1)
    d = detail.where(F.col(KEYS3[0]).isNotNull() & F.col(KEYS3[1]).isNotNull() & F.col(KEYS3[2]).isNotNull())
    j = attach_group_sum(d, KEYS3, F.col("sessionduration") * m, "total_session_duration")
    w = F.round(F.col("sessionduration") / F.col("total_session_duration"), 10)
    term = F.when(w == 1.0, F.col(value)).otherwise(F.round(F.col(value) * w, 10)).cast("double")
    res = j.groupBy(*KEYS3).agg(F.sum(exact(term, 10) * m.cast("decimal(9,0)")).cast("double").alias(out))
    return res.where(F.col(out) >= 0) if keep_nonneg else res


def stacked(details: dict[str, tuple[DataFrame, str, str | None]]) -> DataFrame:
    """The playback rows of several KPIs under one another: session keys, ``kpi`` (its name), ``value``,
    ``sessionduration`` and ``mult``. ``details`` gives frame, value column and multiplicity column of each."""
    parts = []
    for name, (detail, value, mult) in details.items():
        known = F.col(KEYS3[0]).isNotNull() & F.col(KEYS3[1]).isNotNull() & F.col(KEYS3[2]).isNotNull()
        m = F.col(mult) if mult else F.lit(1)
        parts.append(detail.where(known).select(*KEYS3, F.lit(name).alias("kpi"), F.col(value).cast("double").alias("value"),
                                                F.col("sessionduration").cast("bigint").alias("sessionduration"), m.cast("bigint").alias("mult")))
    return reduce(DataFrame.unionByName, parts)


def fused_session_means(details: dict[str, tuple[DataFrame, str, str | None]], outs: dict[str, str],
                        keep_nonneg: dict[str, bool]) -> DataFrame:
    """AGG1/2 for several KPIs at once: one row per session with the duration-weighted mean of each KPI
    (``outs`` names it), ``has_<kpi>``, whether the session has the KPI at all, and the number of its rows.

    The same values as :func:`session_mean` of each KPI, in one pass: all session totals are conditional
    sums of one aggregate over the stacked rows, they join back once, and one aggregate sums all terms.
    """
    names = list(details)
    of = lambda name: F.col("kpi") == name
    rows = stacked(details)
    totals = rows.groupBy(*KEYS3).agg(*[F.sum(F.when(of(n), F.col("sessionduration") * F.col("mult"))).alias(f"total_{n}") for n in names], group_rows())
    j = attach(rows, totals, KEYS3)
    total = F.coalesce(*[F.when(of(n), F.col(f"total_{n}")) for n in names])
    w = F.round(F.col("sessionduration") / total, 10)
    term = F.when(w == 1.0, F.col("value")).otherwise(F.round(F.col("value") * w, 10))
    weighed = j.select(*KEYS3, "kpi", (exact(term, 10) * F.col("mult").cast("decimal(9,0)")).alias("term"))
    sums = weighed.groupBy(*KEYS3).agg(
        *[F.sum(F.when(of(n), F.col("term"))).cast("double").alias(outs[n]) for n in names],
        *[F.count_if(of(n)).alias(f"_n_{n}") for n in names], group_rows())
    has = {n: (F.col(outs[n]) >= 0 if keep_nonneg[n] else F.col(f"_n_{n}") > 0) for n in names}
    has = {n: F.coalesce(h, F.lit(False)) for n, h in has.items()}
    return sums.select(*KEYS3, *[F.when(has[n], F.col(outs[n])).alias(outs[n]) for n in names],
                       *[has[n].alias(f"has_{n}") for n in names], SIZE)


def level_means(finer: DataFrame, keys: list[str], outs: dict[str, str]) -> DataFrame:
    """AGG3/4 for several KPIs at once: one row per key with the mean of each KPI's finer values, and
    ``has_<kpi>``. One conditional aggregate over the rows that hold all KPIs side by side."""
    means = [mean(F.col(v)).alias(v) for v in outs.values()]
    return finer.groupBy(*keys).agg(*means, *[F.max(f"has_{n}").alias(f"has_{n}") for n in outs])


def device_mean(session: DataFrame, value: str) -> DataFrame:
    """AGG3: plain mean of the session values of a device."""
    return session.groupBy(*KEYS2).agg(mean(F.col(value)).alias(value))


def account_mean(device: DataFrame, value: str) -> DataFrame:
    """AGG4: plain mean of the device values of an account (mean of means)."""
    return device.groupBy(*ACCOUNT).agg(mean(F.col(value)).alias(value))


def clip(value: Column, bounds: Bounds) -> Column:
    """Clip above ``hi`` (and below ``lo`` when ``clip_low``); NULL stays NULL."""
    if bounds.clip_low:
        return F.when(value <= bounds.lo, F.lit(bounds.lo)).when(value >= bounds.hi, F.lit(bounds.hi)).otherwise(value)
    return F.when(value > bounds.hi, F.lit(bounds.hi)).otherwise(value)


def normalize(df: DataFrame, value: str, out: str, bounds: Bounds) -> DataFrame:
    """NRM1/2: overwrite ``value`` with its clipped value and add ``(v - lo) / (hi - lo)``."""
    clipped = df.withColumn(value, clip(F.col(value), bounds).cast("double"))
    return clipped.withColumn(out, (F.col(value) - F.lit(bounds.lo)) / F.lit(bounds.hi - bounds.lo))


def stamp(df: DataFrame, run_date: str) -> DataFrame:
    """SNK3: the run day as ``event_date`` (``yyyy-MM-dd``)."""
    return df.withColumn("event_date", F.lit(run_date[:10]))
