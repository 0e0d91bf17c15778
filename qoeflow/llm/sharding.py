"""Sharding by a keyed permutation of global row numbers.

Rows are numbered 0..n-1 in key order; a Feistel permutation with cycle walking maps number i to p,
and p gives ``shard = p % shards`` and ``slot = p // shards``. So row counts differ by one at most, the
slots of a shard are gapless, both can be computed from the row number alone, and the row number can be
computed back from (shard, slot).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qoeflow.llm import common


def place(row_no: np.ndarray, n: int, shards: int, seed: str) -> tuple[np.ndarray, np.ndarray]:
    """(shard, slot) of each row number."""
    p = common.permute(row_no, n, common.feistel_keys(seed))
    return p % shards, p // shards


def row_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int, seed: str) -> np.ndarray:
    """The row numbers that lie at (shard, slot): the inverse of :func:`place`."""
    p = np.asarray(slot, dtype=np.int64) * shards + np.asarray(shard, dtype=np.int64)
    return common.permute(p, n, common.feistel_keys(seed), back=True)


def assign(rows: DataFrame, order: list[Column], shards: int, seed: str) -> DataFrame:
    """``rows`` with ``row_no``, ``shard`` and ``slot``. ``rows`` must not have columns of these names.

    Cases: rows with equal order keys (also wholly equal rows) keep their scan order; null keys sort
    first; an empty frame gives an empty frame. Give narrow rows: all their columns are range-shuffled.
    """
    numbered = common.numbered(rows, order)
    n = numbered.count()

    @F.pandas_udf("struct<shard int, slot long>")
    def placed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            shard, slot = place(batch.to_numpy(), n, shards, seed)
            yield pd.DataFrame({"shard": shard.astype("int32"), "slot": slot})

    return numbered.withColumn("_at", placed("row_no")).select(
        *rows.columns, "row_no", F.col("_at.shard").alias("shard"), F.col("_at.slot").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 16, seed: str = "shards-1") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard, row_no.

    size is the UTF-8 bytes of text plus 1 (null text: 1) and text_crc32 the CRC-32 of these bytes
    (null: of no bytes, 0). The law is ``rows``: counts of shards differ by one at most. So that a group
    of equal texts, which may be a third of all rows, never weighs on one shard, its rows are placed by
    their own row numbers like any others. Order: doc_id (nulls first), size, CRC, scan order; other
    columns of ``docs`` are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    placed = assign(narrow, [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32")], shards, seed)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "row_no")
