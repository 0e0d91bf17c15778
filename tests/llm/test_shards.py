from __future__ import annotations

import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from qoeflow.llm import catalog, common, sharding, token_shards as t
from tests.llm.conftest import edge_rows


@pytest.mark.parametrize("n", [1, 2, 3, 15, 16, 17, 1000, 4097])
def test_permutation_is_one_and_has_an_inverse(n):
    keys = common.feistel_keys("k")
    p = common.permute(np.arange(n), n, keys)
    assert sorted(p.tolist()) == list(range(n))
    assert np.array_equal(common.permute(p, n, keys, back=True), np.arange(n))
    if n > 100:
        assert not np.array_equal(common.permute(np.arange(n), n, common.feistel_keys("other")), p)
        assert abs(np.corrcoef(np.arange(n), p)[0, 1]) < 0.1


def test_no_slots_of_an_empty_domain():
    assert len(common.permute(np.zeros(0, np.int64), 0, common.feistel_keys("k"))) == 0


def test_sharding_law_and_inverse(spark, small):
    got = catalog.op3_feistel_shards(spark, "/root/testdata/sf0.001").collect()
    docs = sorted(small("documents").collect(), key=lambda r: r["doc_id"])
    n = len(docs)
    counts = Counter(r["shard"] for r in got)
    assert set(counts) <= set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, k in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(k))
    by_no = {r["row_no"]: r for r in got}
    shard, slot = sharding.place(np.arange(n), n, 16, "shards-1")
    for i, d in enumerate(docs):
        r, raw = by_no[i], (d["text"] or "").encode()
        assert (r["doc_id"], r["size"], r["text_crc32"]) == (d["doc_id"], len(raw) + 1, zlib.crc32(raw))
        assert (r["shard"], r["slot"], r["law"], r["grown_shard"]) == (shard[i], slot[i], "rows", None)
    assert np.array_equal(sharding.row_at(shard, slot, n, 16, "shards-1"), np.arange(n))


def test_sharding_edge_rows(edge_docs, no_docs):
    got = sharding.shard_documents(edge_docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len((x or "").encode()) + 1) for i, x, *_ in edge_rows())
    assert sorted(r["row_no"] for r in got) == list(range(len(got)))
    assert sharding.shard_documents(no_docs).count() == 0


def test_row_numbers_of_one_repeated_key_spread(spark):
    from pyspark.sql import functions as F
    rows = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"))
    got = common.numbered(rows, [F.col("doc_id")])
    assert [r["row_no"] for r in got.orderBy("row_no").collect()] == list(range(4000))


def read_back(spark, root):
    meta = t.read_meta(spark, root)
    records = list(t.read_slots(root, meta, 0, meta["records"]))
    return meta, records


def rebuilt(manifest, records):
    """doc_id -> the texts of its rows; rows of one id are told apart by their sequence runs."""
    by = defaultdict(dict)
    for r in manifest:
        by[r["doc_id"]].setdefault(r["seq"], []).append(records[r["slot"]])
    return by


def test_shards_round_trip(spark, small):
    root = common.fresh_path(spark, "test-shards")
    docs = small("documents")
    manifest = t.materialise(docs, root, stride=64, shard_records=500).collect()
    meta, records = read_back(spark, root)
    assert meta["records"] == len(manifest) == len(records) and sorted(r["slot"] for r in manifest) == list(range(len(records)))
    texts = {d["doc_id"]: d["text"] for d in docs.collect()}
    for doc_id, seqs in rebuilt(manifest, records).items():
        assert t.payload_of([seqs[i][0] for i in range(len(seqs))]).decode() == texts[doc_id]
    for r in manifest:
        assert (r["shard"], r["byte_offset"]) == (r["slot"] // 500, r["slot"] % 500 * 64)
        assert r["record_crc32"] == zlib.crc32(records[r["slot"]].tobytes())
        assert r["n_tokens"] == int((records[r["slot"]] != t.BYTES.padding).sum())
    # Table order, not the scan's splits, sets the slots; a reader goes on from any slot.
    numbers = [r["slot"] for r in sorted(manifest, key=lambda r: (r["doc_id"], r["seq"]))]
    assert numbers == common.permute(np.arange(len(records)), len(records), common.feistel_keys("order-1")).tolist()
    again = list(t.read_slots(root, meta, 777, 60))
    assert all(np.array_equal(a, b) for a, b in zip(again, records[777:837], strict=True))


def test_ids_of_a_vocabulary_round_trip(spark, small):
    """Two-byte ids of a public byte-pair vocabulary give the texts back."""
    path = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    root = common.fresh_path(spark, "test-ids")
    docs = small("documents")
    manifest = t.materialise(docs, root, stride=64, shard_records=500, vocabulary=path).collect()
    meta, records = read_back(spark, root)
    ids = t.ids_of(path)
    assert (ids.width, ids.end, records[0].dtype) == (2, 50256, np.dtype("<u2"))
    texts = {d["doc_id"]: d["text"] for d in docs.collect()}
    got = rebuilt(manifest, records)
    assert set(got) == set(texts)
    for doc_id, seqs in got.items():
        own = np.frombuffer(t.payload_of([seqs[i][0] for i in range(len(seqs))], ids), "<u2")
        assert t._vocabulary(path).decode(own.tolist()) == texts[doc_id]
    assert all(r["byte_offset"] == r["slot"] % 500 * 128 for r in manifest)


def test_slots_do_not_depend_on_splits(spark, small):
    rows = small("documents", "0.01")
    first = {(r["doc_id"], r["seq"]): r["slot"] for r in t.materialise(rows, common.fresh_path(spark, "a")).collect()}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        again = small("documents", "0.01")
        second = {(r["doc_id"], r["seq"]): r["slot"] for r in t.materialise(again, common.fresh_path(spark, "b")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert first == second


def test_shards_of_edge_rows(spark, edge_docs, no_docs):
    root = common.fresh_path(spark, f"edge-{uuid.uuid4().hex}")
    manifest = t.materialise(edge_docs, root, stride=128, shard_records=1024).collect()
    _, records = read_back(spark, root)
    got = Counter()
    for doc_id, seqs in rebuilt(manifest, records).items():
        for i in range(max(seqs) + 1):
            got.update((doc_id, i, bytes(x)) for x in seqs[i])
    want = Counter((i, k, bytes(rec)) for i, x, *_ in edge_rows() for k, rec in enumerate(t.sequences((x or "").encode(), 128)))
    assert got == want
    assert t.materialise(no_docs, common.fresh_path(spark, "none")).count() == 0
