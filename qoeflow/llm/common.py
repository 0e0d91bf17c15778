"""Helpers the operators of this subpackage share: shared scratch tables, row order, keyed permutations."""

from __future__ import annotations

import contextlib
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Modulus and multipliers of the Feistel round function (fixed: stored slots depend on them).
FEISTEL_P = 2147483647
FEISTEL_M1 = 1103515245
FEISTEL_M2 = 48271
FEISTEL_ROUNDS = 6


def shared_dir(spark: SparkSession) -> str:
    """The folder driver and executors share: ``spark.checkpoint.dir``; where that is unset (tests,
    single machine) a folder beside the session's warehouse."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    return set_dir or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh shared table and read it back: lineage ends there, and a lost executor
    costs nothing that was already written."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path`` to its end."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def is_plain_scan(df: DataFrame) -> bool:
    """Whether ``df`` is the scan of a Parquet table and nothing else, whose rows have a place in a file."""
    plan = df._jdf.queryExecution().optimizedPlan().toString().strip()
    return plan.count("\n") == 0 and plan.startswith("Relation") and plan.endswith("parquet")


def stable(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``df`` as the plain scan of a table (written to a shared one unless it is that already)."""
    if is_plain_scan(df) and "_metadata" not in df.columns:
        return df
    return stored(df.select(*[F.col(f"`{c}`") for c in columns]), name)


#: Bits of a row id for the row's place in its file.
ROW_BITS = 40


def identified(df: DataFrame, columns: list[str], rid: str, name: str) -> DataFrame:
    """``columns`` of ``df`` and ``rid``, a distinct long for each row, equal rows included.

    A row has the same id in every reading, however the scan is split: in a Parquet table it is the
    number of the row's file among the table's paths and its place in that file. Any other frame is
    written to a shared table first, the id with it. The numbers of the files, a row for each file of the
    table (which the driver lists anyway), are broadcast.
    """
    kept = [F.col(f"`{c}`") for c in columns]
    if not is_plain_scan(df) or "_metadata" in df.columns:
        return stored(df.select(*kept, F.monotonically_increasing_id().alias(rid)), name)
    file, row = free_name(df, "_file"), free_name(df, "_row")
    paths = df.select(F.col("_metadata.file_path").alias(file)).distinct()
    number = paths.select(file, (F.row_number().over(Window.orderBy(file)) - 1).cast("long").alias(rid))
    scan = df.select(*kept, F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    return scan.join(F.broadcast(number), file).select(*kept, F.shiftleft(rid, ROW_BITS).bitwiseOR(F.col(row)).alias(rid))


@contextlib.contextmanager
def same_splits(spark: SparkSession):
    """Files are cut alike by all scans inside: their number of splits doesn't follow the cores of the moment."""
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    if before is None:
        spark.conf.set(key, str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)


#: Bytes of text that a task holds as Python objects at a time.
SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``limit`` bytes of ``column``, one row at least: what a task holds as
    Python objects doesn't grow with the rows of a batch."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(narrow: DataFrame, keys: list[Column], name: str = "row_no") -> DataFrame:
    """Gapless numbers 0, 1, ... in the order of ``keys`` (ties: scan order), without a single-task sort.

    Rows are range-partitioned and sorted, stored, and each partition starts where the ones before it
    end. Only the partition totals (one row per partition) meet in one task and are broadcast. The scan
    order is the last range key, so many rows with one key still spread over partitions.
    """
    spark = narrow.sparkSession
    mid = F.monotonically_increasing_id()
    laid = stored(
        narrow.withColumn("_tie", mid)
        .repartitionByRange(partitions(spark), *keys, F.col("_tie"))
        .sortWithinPartitions(*keys, F.col("_tie"))
        .select(*narrow.columns, F.shiftright(mid, 33).alias("_part"),
                mid.bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos")),
        "numbered",
    )
    totals = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = totals.select(
        "_part", F.expr("sum(_n) OVER (ORDER BY _part ROWS UNBOUNDED PRECEDING) - _n").alias("_start"))
    return (laid.join(F.broadcast(starts), "_part")
            .select(*narrow.columns, (F.col("_start") + F.col("_pos")).alias(name)))


def feistel_keys(seed: str, rounds: int = FEISTEL_ROUNDS) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{seed}/{r}".encode()).digest()[:8], "big") % FEISTEL_P
            for r in range(rounds)]


def feistel_bits(n: int) -> int:
    """Half the block width: the smallest k with 4**k >= n."""
    k = 1
    while 4 ** k < n:
        k += 1
    return k


def _mix(half: np.ndarray, key: int, mask: int) -> np.ndarray:
    t = (half * FEISTEL_M1 + key) % FEISTEL_P
    t ^= t >> 15
    t = (t * FEISTEL_M2) % FEISTEL_P
    return (t ^ (t >> 13)) & mask


def _pass(x: np.ndarray, k: int, keys: list[int], back: bool) -> np.ndarray:
    mask = (1 << k) - 1
    left, right = x >> k, x & mask
    for key in (reversed(keys) if back else keys):
        if back:
            left, right = right ^ _mix(left, key, mask), left
        else:
            left, right = right, left ^ _mix(right, key, mask)
    return (left << k) | right


def permute(index: np.ndarray, n: int, keys: list[int], back: bool = False) -> np.ndarray:
    """The keyed permutation of 0..n-1 at ``index`` (``back``: its inverse).

    A balanced Feistel network permutes 0..4**k-1, the smallest such block that holds n; whatever falls
    outside 0..n-1 walks on along its cycle until it is inside again. Fewer than four passes on average.
    """
    x = np.asarray(index, dtype=np.int64).copy()
    if not len(x):
        return x
    k = feistel_bits(n)
    todo = np.arange(len(x))
    while len(todo):
        x[todo] = _pass(x[todo], k, keys, back)
        todo = todo[x[todo] >= n]
    return x
