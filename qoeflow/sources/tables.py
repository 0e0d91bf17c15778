"""Sources: table scans with projection, distinct scans, the daily slice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qoeflow.schema import PLACE, RAW_PATHS, flat_playback

# Dotted source paths of the fields the pre-processing reads (nested raw layout).
RAW_FIELDS = list(RAW_PATHS.values())


def open_table(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table by name, or a parquet table by path (anything with a slash)."""
    return spark.read.parquet(table) if "/" in table else spark.read.table(table)


def get_data(table: DataFrame | str, columns: list[str] | str = "ALL", spark: SparkSession | None = None) -> DataFrame:
    """SRC1: the table (a frame, or with ``spark`` a name or path), or the listed (possibly dotted,
    nested) columns of it. On parquet the projection reaches the scan (nested schema pruning)."""
    df = open_table(spark, table) if isinstance(table, str) else table
    return df if columns == "ALL" else df.select(*columns)


def get_distinct_data(table: DataFrame | str, columns: list[str], spark: SparkSession | None = None) -> DataFrame:
    """SRC2: distinct values of the listed columns."""
    return get_data(table, columns, spark).distinct()


def daily_slice(raw_nested: DataFrame, run_date: str, fields: list[str] = RAW_FIELDS) -> DataFrame:
    """SRC3: one received day of the nested raw feed, flattened to the fields used."""
    return get_data(on_day(raw_nested, run_date), fields)


def on_day(df: DataFrame, run_date: str) -> DataFrame:
    return df.where(F.col("received_date") == F.lit(run_date[:10]).cast("date"))


def placed(df: DataFrame) -> DataFrame:
    """``df`` with ``PLACE``, a hash of each row's file and number in the file, where ``df`` is the scan of a Parquet
    table and nothing else; any other frame as it is, for its rows have no place that stays."""
    plan = df._jdf.queryExecution().optimizedPlan().toString().strip()
    if "\n" in plan or not (plan.startswith("Relation") and plan.endswith("parquet")) or "_metadata" in df.columns:
        return df
    return df.withColumn(PLACE, F.xxhash64("_metadata.file_path", "_metadata.row_index"))


def playback_day(raw: DataFrame, run_date: str) -> DataFrame:
    """SRC3 as the base table takes it: one received day of the raw feed (nested or flat), typed."""
    return flat_playback(on_day(raw, run_date))
