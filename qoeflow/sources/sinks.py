"""Sinks: replace a table, append a day to a history table; by path, or by name in the catalog.

Both write the new rows aside first and put them in place only when the write has succeeded; what was there
is kept until then and deleted last. So a failed run leaves the old rows, and an empty run leaves an empty
table or day.

By name (no slash in the target) the new rows come into place by one change of the catalog, the location of
the table or of the day's partition: a reader finds the old rows or the new ones, never none. By path the move
is two renames: a reader in between may find the folder missing for a moment, never half written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _swap_in(spark: SparkSession, staged: str, place: str) -> None:
    """Move the folder ``staged`` to ``place``; the folder that was there goes last."""
    fs, path = _file_system(spark, place)
    old = f"{staged}.old"
    fs.mkdirs(path(place).getParent())
    had = fs.exists(path(place))
    if had and not fs.rename(path(place), path(old)):
        raise OSError(f"{place} could not be moved aside")
    if not fs.rename(path(staged), path(place)):
        if had:
            fs.rename(path(old), path(place))
        raise OSError(f"{staged} could not be moved to {place}")
    if had:
        fs.delete(path(old), True)


def _write_and_swap(df: DataFrame, place: str, fmt: str) -> None:
    spark = df.sparkSession
    folder, _, name = place.rstrip("/").rpartition("/")
    staged = f"{folder}/.{name}-{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).save(staged)
        _swap_in(spark, staged, place.rstrip("/"))
    finally:
        fs, path = _file_system(spark, staged)
        if fs.exists(path(staged)):
            fs.delete(path(staged), True)


def is_path(target: str) -> bool:
    return "/" in target


def _aside(spark: SparkSession, target: str) -> str:
    """A fresh folder in the warehouse for rows of a table of this name."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{target}-{uuid.uuid4().hex}"


def _write_aside(df: DataFrame, folder: str, fmt: str) -> None:
    try:
        df.write.format(fmt).save(folder)
    except BaseException:
        _delete(df.sparkSession, folder)
        raise


def _delete(spark: SparkSession, folder: str) -> None:
    fs, path = _file_system(spark, folder)
    fs.delete(path(folder), True)


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _detail(spark: SparkSession, name: str, where: str = "") -> dict:
    rows = spark.sql(f"DESCRIBE FORMATTED {name} {where}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _replace_named(df: DataFrame, name: str, fmt: str) -> DataFrame:
    spark = df.sparkSession
    folder = _aside(spark, name)
    _write_aside(df, folder, fmt)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({_columns(df)}) USING {fmt} LOCATION '{folder}'")
        return spark.read.table(name)
    old = _detail(spark, name)["Location"]
    if spark.read.table(name).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    else:  # other columns: the catalog has no single change for that
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} ({_columns(df)}) USING {fmt} LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    _delete(spark, old)
    return spark.read.table(name)


def _append_named(body: DataFrame, name: str, day: str, partition: str, fmt: str) -> DataFrame:
    spark = body.sparkSession
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({_columns(body)}, `{partition}` string) USING {fmt} PARTITIONED BY (`{partition}`) "
                  f"LOCATION '{_aside(spark, name)}'")
    rows = body.select(*[c for c in spark.read.table(name).columns if c != partition])  # by name; a missing column is an error
    folder = _aside(spark, name)
    _write_aside(rows, folder, fmt)
    spec = f"PARTITION (`{partition}` = '{day}')"
    if spark.sql(f"SHOW PARTITIONS {name} {spec}").count():
        old = _detail(spark, name, spec)["Location"]
        spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
        _delete(spark, old)
    else:
        spark.sql(f"ALTER TABLE {name} ADD {spec} LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    return spark.read.table(name)


def replace_table(df: DataFrame, target: str, fmt: str = "parquet") -> DataFrame:
    """SNK1: make ``df`` the whole content of ``target``, a path or a catalog name, and return the table read
    back. ``df`` may read the target itself. By name, a table whose columns change is dropped and made anew."""
    if not is_path(target):
        return _replace_named(df, target, fmt)
    _write_and_swap(df, target, fmt)
    return df.sparkSession.read.format(fmt).schema(df.schema).load(target)


def append_history(df: DataFrame, target: str, day: str, partition: str = "event_date", fmt: str = "parquet") -> DataFrame:
    """SNK2: make ``df`` the rows of one ``day`` of a history table, a path or a catalog name, and return the
    table read back.

    Only the day's own partition is replaced, also by an empty ``df``; a column of the
    partition's name in ``df`` is dropped, for all its rows are of that day.
    """
    spark = df.sparkSession
    body = df.drop(partition)
    columns = df.columns if partition in df.columns else [*df.columns, partition]
    if not is_path(target):
        return _append_named(body, target, day, partition, fmt).select(*columns)
    _write_and_swap(body, f"{target}/{partition}={day}", fmt)
    schema = body.schema.add(partition, "string")
    return spark.read.format(fmt).schema(schema).load(target).select(*columns)


def read_day(spark: SparkSession, target: str, day: str, partition: str = "event_date", fmt: str = "parquet") -> DataFrame:
    """One day of a history table, without the partition column."""
    if not is_path(target):
        return spark.read.table(target).where(f"`{partition}` = '{day}'").drop(partition)
    return spark.read.format(fmt).load(f"{target}/{partition}={day}")
