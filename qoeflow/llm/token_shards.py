"""Training-order materialisation of token ids as binary shards.

Every document is cut to sequences of ``stride`` token ids. The sequences are numbered 0..n-1 in table
order, and a keyed Feistel permutation with cycle walking gives each its global slot, the place in
training order. Slots are cut to ranges of ``shard_records``; each range is one shard file of records
of a fixed stride, so slot s lies in file ``s // shard_records`` at record ``s % shard_records``
and a reader can go on from any slot.

Token ids are the UTF-8 bytes of the text, one byte an id, so a table's number of sequences is known
from its text lengths without encoding it. Two byte values that UTF-8 never uses end a text and fill a
record. With the path of a byte-pair vocabulary the ids are the vocabulary's, two bytes each; texts are
then encoded to a stored table first.
"""

from __future__ import annotations

import base64
import functools
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qoeflow.llm import common


@dataclass(frozen=True)
class Ids:
    """Kind of token ids: bytes of an id, and the ids that end a text and fill a record."""

    kind: str
    end: int
    padding: int

    @property
    def width(self) -> int:
        return np.dtype(self.kind).itemsize


BYTES = Ids("<u1", 0xFF, 0xFE)

STRIDE = 512
SHARD_RECORDS = 32_768

#: What a blob holds before the records: slot, doc_id, whether doc_id is null, the sequence's number in its text, its tokens.
HEAD = np.dtype([("slot", "<i8"), ("doc_id", "<i8"), ("no_id", "?"), ("seq", "<i4"), ("tokens", "<i4")])
MANIFEST = "slot long, doc_id long, seq int, n_tokens int, shard int, byte_offset long, record_crc32 long"

#: A task passes its records on when it has gathered so many bytes of them.
FLUSH_BYTES = 32 << 20


#: Fixed value: how the byte-pair vocabulary cuts a text to pieces before it is merged.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=2)
def _vocabulary(path: str):
    """The encoding of a vocabulary file of lines ``base64(piece) rank`` (fewer than 65,535 ranks)."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def ids_of(vocabulary: str | None) -> Ids:
    """Ids of a vocabulary: the first free one ends a text, the largest fills a record."""
    return BYTES if vocabulary is None else Ids("<u2", _vocabulary(vocabulary).max_token_value + 1, 0xFFFF)


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, payload): the ids of each text as little-endian numbers. ``vocabulary`` must be there on every worker."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            ids = [np.asarray(_vocabulary(vocabulary).encode_ordinary(t or ""), "<u2").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "payload"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, "doc_id long, payload binary")


def n_sequences(payload: Column, stride: int, ids: Ids = BYTES) -> Column:
    """Sequences of a text: its ids and the end token, in records of ``stride`` ids."""
    n = F.coalesce(F.octet_length(payload), F.lit(0)) / F.lit(ids.width)
    return F.ceil((n + 1) / F.lit(stride)).cast("long")


def sequences(payload: bytes | None, stride: int, ids: Ids = BYTES) -> np.ndarray:
    """The records of a text's ids as rows."""
    own = np.frombuffer(payload or b"", ids.kind)
    n = -(-(len(own) + 1) // stride)
    out = np.full(n * stride, ids.padding, ids.kind)
    out[: len(own)] = own
    out[len(own)] = ids.end
    return out.reshape(n, stride)


def payload_of(records: list[np.ndarray], ids: Ids = BYTES) -> bytes:
    """A text's ids back from its records in order of their sequence number."""
    flat = np.concatenate(records)
    return flat[: int(np.argmax(flat == ids.end))].tobytes()


def _scan(docs: DataFrame, *columns: Column) -> DataFrame:
    place = ("file_path", "file_block_start", "file_block_length", "row_index")
    return docs.select(*[F.col(f"_metadata.{c}").alias(c) for c in place], *columns)


SPLIT = ["file_path", "file_block_start", "file_block_length"]


def _starts(scan: DataFrame) -> DataFrame:
    """For each split of the scan its first row and the number of its first sequence, in order of files
    and rows. A row per split, whatever the rows in it, so one window counts them up."""
    splits = scan.groupBy(*SPLIT).agg(F.min("row_index").alias("first"), F.sum("n").alias("n"))
    before = Window.orderBy("file_path", "first").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))


def materialise(docs: DataFrame, root: str, seed: str = "order-1", stride: int = STRIDE,
                shard_records: int = SHARD_RECORDS, vocabulary: str | None = None) -> DataFrame:
    """Write the shards of ``docs`` (doc_id, text) under ``root`` and return the manifest: a row per
    sequence with slot, doc_id, seq, n_tokens, shard, byte_offset and record_crc32.

    The order is that of the table: files by path, rows by place in the file. It does not depend on how
    the scan is split, nor on the cluster. A frame that is not a plain scan is written to a shared table
    first. Records travel once, gathered to one compressed blob per task and shard.

    Without a ``vocabulary`` ids are bytes. Cases: a null text is an empty one, and an empty text is one record that holds the end token alone;
    a null doc_id stays null; repeated rows are sequences of their own; an empty table gives no shard and
    an empty manifest; other columns are not read. A lost executor only repeats tasks: a shard file is
    written under a name of its own and then moved to its place, with the same bytes each time.
    """
    spark = docs.sparkSession
    ids = ids_of(vocabulary)
    docs = common.stable(docs, ["doc_id", "text"], "token-input")
    if vocabulary is not None:
        docs = common.stored(encoded(docs, vocabulary), "token-ids")
    payload = F.col("text" if vocabulary is None else "payload").cast("binary")
    with common.same_splits(spark):
        starts = common.stored(_starts(_scan(docs, n_sequences(payload, stride, ids).alias("n"))), "token-starts")
        n = starts.agg(F.sum("n")).first()[0] or 0
        _write_shards(_scan(docs, F.col("doc_id").cast("long").alias("doc_id"), payload.alias("payload")), starts, n, root, seed, stride,
                      shard_records, ids)
    meta = {"records": n, "stride": stride, "shard_records": shard_records, "shards": -(-n // shard_records), "seed": seed, **asdict(ids)}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{root}/meta")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def _write_shards(scan: DataFrame, starts: DataFrame, n: int, root: str, seed: str, stride: int, shard_records: int, ids: Ids) -> None:
    keys, shards = common.feistel_keys(seed), -(-n // shard_records)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, row, at = None, -1, 0
        heads: list[np.ndarray] = []
        bodies: list[np.ndarray] = []
        size = 0
        for batch in common.slices(batches, "payload"):
            for start, first, r, doc_id, own in zip(*(c.to_pylist() for c in batch.columns)):
                if start != split:
                    split, row, at = start, r - 1, start
                    if r != first:
                        raise RuntimeError(f"the scan was split anew at row {r} while it was read")
                if start is None or r != row + 1:
                    raise RuntimeError(f"the scan was split anew at row {r} while it was read")
                row = r
                body = sequences(own, stride, ids)
                head = np.zeros(len(body), HEAD)
                head["slot"] = np.arange(at, at + len(body))
                head["doc_id"], head["no_id"] = doc_id or 0, doc_id is None
                head["seq"] = np.arange(len(body))
                head["tokens"] = stride
                head["tokens"][-1] = len(own or b"") // ids.width + 1 - (len(body) - 1) * stride
                heads.append(head)
                bodies.append(body)
                at += len(body)
                size += body.nbytes
                if size >= FLUSH_BYTES:
                    yield _blobs(heads, bodies, n, keys, shard_records)
                    heads, bodies, size = [], [], 0
        if heads:
            yield _blobs(heads, bodies, n, keys, shard_records)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, heads, bodies = None, [], []
        for batch in batches:
            for s, count, blob in zip(batch["shard"], batch["records"], batch["blob"]):
                if s != shard and heads:
                    yield _write_shard(root, shard, heads, bodies, n, shard_records)
                    heads, bodies = [], []
                shard = s
                raw = zstandard.ZstdDecompressor().decompress(blob)
                cut = count * HEAD.itemsize
                heads.append(np.frombuffer(raw[:cut], HEAD))
                bodies.append(np.frombuffer(raw[cut:], ids.kind).reshape(count, stride))
        if heads:
            yield _write_shard(root, shard, heads, bodies, n, shard_records)

    # A row per split of the scan: bounded by the files and their size over the split size.
    rows = scan.join(F.broadcast(starts.select(*SPLIT, "first", "start")), SPLIT, "left").select("start", "first", "row_index", "doc_id", "payload")
    blobs = rows.mapInArrow(gather, "shard int, records int, blob binary")
    parts = max(1, min(shards, 1 << 20))
    manifest = blobs.repartition(parts, "shard").sortWithinPartitions("shard").mapInPandas(write, MANIFEST)
    manifest.write.parquet(f"{root}/manifest")


def _blobs(heads, bodies, n, keys, shard_records) -> pa.RecordBatch:
    """The gathered records as one compressed blob per shard, with their slots instead of numbers."""
    head, body = np.concatenate(heads), np.concatenate(bodies)
    head["slot"] = common.permute(head["slot"], n, keys)
    order = np.argsort(head["slot"], kind="stable")
    head, body = head[order], body[order]
    shard = head["slot"] // shard_records
    cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
    pack = zstandard.ZstdCompressor(level=3)
    blobs = [pack.compress(head[a:b].tobytes() + body[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
    return pa.RecordBatch.from_arrays(
        [pa.array([int(shard[a]) for a in cuts[:-1]], pa.int32()), pa.array([b - a for a, b in zip(cuts, cuts[1:])], pa.int32()),
         pa.array(blobs, pa.binary())], ["shard", "records", "blob"])


def _write_shard(root, shard, heads, bodies, n, shard_records) -> pd.DataFrame:
    head, body = np.concatenate(heads), np.concatenate(bodies)
    order = np.argsort(head["slot"], kind="stable")
    head, body = head[order], body[order]
    first = int(shard) * shard_records
    if not np.array_equal(head["slot"], np.arange(first, min(first + shard_records, n))):
        raise RuntimeError(f"shard {shard} does not hold each of its slots once")
    where, path = pafs.FileSystem.from_uri(shard_path(root, shard))
    where.create_dir(path.rpartition("/")[0], recursive=True)
    aside = f"{path}.{uuid.uuid4().hex}"
    with where.open_output_stream(aside) as out:
        out.write(body.tobytes())
    where.move(aside, path)
    return pd.DataFrame({
        "slot": head["slot"], "doc_id": pd.array(head["doc_id"], "Int64").copy() if not head["no_id"].any()
        else pd.array([None if no else int(d) for d, no in zip(head["doc_id"], head["no_id"])], "Int64"),
        "seq": head["seq"], "n_tokens": head["tokens"], "shard": np.int32(shard),
        "byte_offset": (head["slot"] - first) * body.itemsize * body.shape[1], "record_crc32": [zlib.crc32(r.tobytes()) for r in body]})


def shard_path(root: str, shard: int) -> str:
    uri = root if "://" in root else ("file://" + root.removeprefix("file:"))
    return f"{uri}/shards/{shard:08d}.bin"


def read_meta(spark: SparkSession, root: str) -> dict:
    return json.loads(spark.read.text(f"{root}/meta").first()["value"])


def read_slots(root: str, meta: dict, first: int, count: int) -> Iterator[np.ndarray]:
    """Records from slot ``first`` on, in training order: what a trainer that stopped there reads next."""
    slot, end = first, min(first + count, meta["records"])
    record = meta["stride"] * np.dtype(meta["kind"]).itemsize
    while slot < end:
        shard, inside = divmod(slot, meta["shard_records"])
        take = min(end - slot, meta["shard_records"] - inside)
        where, path = pafs.FileSystem.from_uri(shard_path(root, shard))
        with where.open_input_file(path) as f:
            f.seek(inside * record)
            yield from np.frombuffer(f.read(take * record), meta["kind"]).reshape(take, meta["stride"])
        slot += take
