"""Rows keep their identity when a scan is split anew between two readings (an executor lost or added)."""

from __future__ import annotations

import contextlib

import pyarrow as pa
import pytest
from qoeflow.llm import chosen_path, common, mixing, passage_dedup, token_shards


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """The documents in files of several row groups, two of them of equal length, so that the splits can change."""
    place = f"{tmp_path_factory.mktemp('identity')}/documents"
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartitionByRange(3, "doc_id")
    docs = docs.unionByName(docs.where("doc_id % 7 = 0"))
    docs.coalesce(3).write.option("parquet.block.size", 40_000).parquet(place)
    return place


@contextlib.contextmanager
def splits(spark, n):
    spark.conf.set("spark.sql.files.minPartitionNum", n)
    spark.conf.set("spark.sql.files.openCostInBytes", 1024)
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_ids_do_not_follow_the_splits(spark, table):
    docs = common.identified(spark.read.parquet(table), ["doc_id", "text"], "rid", "t")
    seen = []
    for n in (1, 2, 8, 40):
        with splits(spark, n):
            fresh = common.identified(spark.read.parquet(table), ["doc_id", "text"], "rid", "t")
            assert fresh.rdd.getNumPartitions() >= (1 if n == 1 else 2)
            seen.append(rows_of(fresh))
    assert all(s == seen[0] for s in seen) and rows_of(docs) == seen[0]
    ids = [r["rid"] for r in docs.collect()]
    assert len(set(ids)) == len(ids)


def test_other_frames_carry_their_ids(spark):
    df = common.identified(spark.range(0, 50, 1, 7).selectExpr("id % 3 AS x", "'own' AS _metadata"), ["x", "_metadata"], "rid", "t")
    first = rows_of(df)
    with splits(spark, 1):
        assert rows_of(df) == first and len({r["rid"] for r in df.collect()}) == 50
    assert df.columns == ["x", "_metadata", "rid"]


@pytest.mark.parametrize("step", ["keep_one", "mixed_documents", "link_documents", "remove_repeats"])
def test_plans_made_under_one_split_and_run_under_another(spark, table, step):
    run = {"keep_one": chosen_path.keep_one, "mixed_documents": mixing.mixed_documents,
           "link_documents": lambda d: chosen_path.link_documents(d).drop("rid"),
           "remove_repeats": lambda d: passage_dedup.remove_repeats(d, within=True, whole=True)}[step]
    seen = []
    for planned, ran in ((4, 4), (1, 8), (8, 2)):
        with splits(spark, planned):
            df = run(spark.read.parquet(table))
        with splits(spark, ran):
            seen.append(rows_of(df))
    assert seen[0] == seen[1] == seen[2] and seen[0]


def test_token_shards_do_not_follow_the_splits(spark, table, tmp_path):
    seen = []
    for n in (1, 2, 8):
        with splits(spark, n):
            seen.append(rows_of(token_shards.materialise(spark.read.parquet(table), f"{tmp_path}/{n}", shard_records=64)))
    assert seen[0] == seen[1] == seen[2]


def test_slices_hold_few_bytes():
    sizes = [5, 50, 500, 1, 1, None, 59, 2]
    batch = pa.RecordBatch.from_arrays([pa.array([None if n is None else "x" * n for n in sizes]), pa.array(range(8))], ["text", "n"])
    parts = list(common.slices([batch, batch.slice(0, 0)], limit=60))
    assert [v for p in parts for v in p.column("n").to_pylist()] == list(range(8)) and len(parts) > 1
    for p in parts:  # the limit, and one row that goes over it
        size = [len(t or "") for t in p.column("text").to_pylist()]
        assert sum(size) <= 60 + max(size)
