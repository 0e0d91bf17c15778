"""Attachment of per-group values to the rows of the group.

Attaching a group's value (its total, its mean, its score) to each of its rows is a join with a side
that has one row per group; a group may hold a large share of all rows. The aggregate that makes the values
also counts each group's rows (``SIZE``), and is stored: the planner sees its real size, and the large groups can be
read off. The rows of a group are dealt over as many salts as its size asks for, ``ROWS_PER_TASK`` rows to each, and
the group's value is copied to each of its salts. Where no group is that large, which is the rule, rows and values
meet without salts or copies. The large groups are at most one for every ``ROWS_PER_TASK`` rows; they are counted, and
broadcast up to ``MOST_LARGE``. AQE (``session.require``) splits what is still skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qoeflow.session import handoff

SALT = "_salt"
SIZE = "_group_rows"
ROWS_PER_TASK = 1_000_000
MOST_LARGE = 100_000


def attach(rows: DataFrame, per_key: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``rows ⋈ per_key`` on ``keys``. ``per_key`` has one row per key, with the number of the key's rows (or about that) as ``SIZE``."""
    salts = F.ceil(F.col(SIZE) / rows_per_task).cast("int")
    values = handoff(per_key.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).withColumn(SALT, F.greatest(salts, F.lit(1))).drop(SIZE),
                     "group-values")
    large = values.where(F.col(SALT) > 1).select(*keys, F.col(SALT).alias("_salts"))
    groups = large.count()  # reads one narrow column of the stored values
    if not groups:
        return rows.join(values.drop(SALT), keys)
    if groups <= MOST_LARGE:
        large = F.broadcast(large)
    content = [F.col(f"`{c}`") for c in rows.columns]
    # The partition is hashed too, so that equal rows don't share a salt.
    deal = F.pmod(F.xxhash64(F.spark_partition_id(), *content), F.coalesce("_salts", F.lit(1))).cast("int")
    salted = rows.join(large, keys, "left").withColumn(SALT, deal).drop("_salts")
    copies = values.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.col(SALT) - 1)))
    return salted.join(copies, [*keys, SALT]).drop(SALT)


def group_rows() -> Column:
    """The number of a group's rows, for ``attach``."""
    return F.count(F.lit(1)).alias(SIZE)


def attach_group_sum(rows: DataFrame, keys: list[str], value: Column, out: str) -> DataFrame:
    """Every row with ``sum(value)`` over its ``keys`` group (sums are combined before their shuffle)."""
    return attach(rows, rows.groupBy(*keys).agg(F.sum(value).alias(out), group_rows()), keys)
