"""Hard negatives of anchor vectors by vertical scans with bounds (branch and bound over dimensions).

Rows are dealt to blocks and anchors to groups, and a unit of work is a block with a group. A unit holds its
rows by column, one array for each dimension, with the dimension's least and greatest value. For each anchor
the dimensions are read in descending order of the anchor's magnitude there; what the dimensions ahead can add
to a row's score at least and at most follows from those two values. Rows that these bounds rule out leave the
candidate bitmap, and when fewer than half of its rows are left the arrays are narrowed to them. The rows that
stay to the end have exact scores.

Two scans: the first looks for each anchor's nearest rows of its own label (bound: the k-th best lower bound
so far), the second for the rows of other labels inside the score windows that these positives open (bounds:
the windows' edges, and the k-th best of the rows that are surely inside). A unit reports at most k rows for
each question; the best of all units are the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qoeflow.llm import common


@dataclass(frozen=True)
class MineConfig:
    """Fixed values of the contract, and sizes: a block has about 1 / ``blocks`` of the rows, within the two
    bounds of ``block_rows`` (a unit's memory), a group at most ``group_anchors`` anchors. ``step``: dimensions
    that are read between two looks at the bounds. Sizes don't change the result."""

    scale: int = 256
    anchor_every: int = 100
    relabel_every: int = 7
    labels: int = 10
    positives: int = 5
    negatives: int = 10
    low_percent: int = 30
    high_percent: int = 90
    blocks: int = 24
    block_rows: tuple[int, int] = (1024, 32_768)
    group_anchors: int = 8192
    step: int = 8


VECTORS = "rid long, vec_id long, label long, width int, vec binary"


def usable(vectors: DataFrame, cfg: MineConfig) -> DataFrame:
    """(rid, vec_id, label, width, vec): the rows that take part, labels changed by the contract's rule,
    components floor(scale * x) as integers of ``width`` bytes."""
    rows = common.identified(vectors, ["vec_id", "embedding", "label"], "rid", "mine-input")
    label = F.expr(f"CASE WHEN vec_id % {cfg.relabel_every} = 0 THEN (CAST(label AS LONG) + 1) % {cfg.labels} ELSE CAST(label AS LONG) END")
    rows = rows.where("label IS NOT NULL AND embedding IS NOT NULL").select("rid", F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"),
                                                                            F.col("embedding").cast("array<double>").alias("x"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            values = x.flatten()
            flat = values.to_numpy(zero_copy_only=False)  # null components are NaN
            size = np.diff(x.offsets.to_numpy())
            ends = np.cumsum(size)
            owner = np.repeat(np.arange(len(size)), size)
            fine = np.bincount(owner[~np.isfinite(flat)], minlength=len(size)) == 0
            whole = np.floor(np.where(np.isfinite(flat), flat, 0) * cfg.scale)
            whole = np.clip(whole, -2.0 ** 63, 2.0 ** 63 - 1024).astype(np.int64)
            wide = np.bincount(owner[(whole < -32768) | (whole > 32767)], minlength=len(size)) > 0
            out, width = [], []
            for i in np.flatnonzero(fine):
                own = whole[ends[i] - size[i]:ends[i]]
                out.append((own if wide[i] else own.astype(np.int16)).tobytes())
                width.append(8 if wide[i] else 2)
            kept = batch.filter(pa.array(fine))
            yield pa.RecordBatch.from_arrays([*kept.columns[:3], pa.array(width, pa.int32()), pa.array(out, pa.binary())],
                                             ["rid", "vec_id", "label", "width", "vec"])

    return rows.mapInArrow(pack, VECTORS)


def matrix(vec: list[bytes], width: list[int]) -> np.ndarray:
    """The vectors as columns [dimension, row]; missing last components are 0."""
    rows = [np.frombuffer(v, "<i2" if w == 2 else "<i8") for v, w in zip(vec, width)]
    dims = max((len(r) for r in rows), default=0)
    if all(len(r) == dims for r in rows) and rows:
        return np.ascontiguousarray(np.stack(rows).astype(np.int64).T)
    out = np.zeros((dims, len(rows)), np.int64)
    for i, r in enumerate(rows):
        out[:len(r), i] = r
    return out


class Block:
    """Rows by column, in order of label, with the least and greatest value of each dimension."""

    def __init__(self, table: pa.Table, other: np.ndarray):
        label = table.column("label").to_numpy()
        order = np.argsort(label, kind="stable")
        cols = matrix(table.column("vec").to_pylist(), table.column("width").to_pylist())[:, order]
        dims = max(len(cols), len(other))
        cols = np.pad(cols, ((0, dims - len(cols)), (0, 0)))
        self.anchors = np.pad(other, ((0, dims - len(other)), (0, 0)))
        ids = table.column("vec_id")
        self.no_id = ids.is_null().to_numpy()[order]
        self.vec_id = ids.fill_null(0).to_numpy()[order]
        self.rid, self.label = table.column("rid").to_numpy()[order], label[order]
        self.low, self.high = (cols.min(axis=1), cols.max(axis=1)) if dims else (np.zeros(0, np.int64),) * 2
        # Sums of integers under 2**53 are exact as doubles, which are multiplied faster.
        top = np.abs(self.anchors).max(axis=1, initial=0).astype(float) @ np.abs(cols).max(axis=1, initial=0).astype(float) if dims else 0.0
        kind = np.float64 if top < 2.0 ** 52 else np.int64
        self.cols, self.anchors = cols.astype(kind), self.anchors.astype(kind)
        self.low, self.high = self.low.astype(kind), self.high.astype(kind)

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.label, [label, label + 1]).tolist())

    def scan(self, anchor: int, rows: slice, keep, step: int, live: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, exact scores) of the rows that ``keep`` never rules out.

        keep(lower bounds, upper bounds) gives the bitmap of the rows that stay, or None to let all stay.
        """
        a = self.anchors[:, anchor]
        order = np.argsort(-np.abs(a), kind="stable")
        ends = np.stack([a * self.low, a * self.high])[:, order]
        ahead_low = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
        ahead_high = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
        cols, at = self.cols[:, rows], None
        live = np.ones(cols.shape[1], bool) if live is None else live.copy()
        score = np.zeros(cols.shape[1], cols.dtype)
        for s in range(0, len(order), step):
            dims = order[s:s + step]
            part = cols[dims] if at is None else cols[dims[:, None], at]
            score = score + a[dims] @ part
            e = min(s + step, len(order))
            stay = keep(score, ahead_low[e], ahead_high[e], live)
            if stay is None:
                continue
            live = live & stay
            n = int(live.sum())
            if 2 * n < len(live):
                at = np.flatnonzero(live) if at is None else at[live]
                score, live = score[live], np.ones(n, bool)
                if not n:
                    break
        found = np.flatnonzero(live) if at is None else at[live]
        return found + (rows.start or 0), score[live]

    def best(self, found: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The first k by score, vec_id (null last) and row."""
        if len(score) > k:
            near = score >= np.partition(score, len(score) - k)[len(score) - k]
            found, score = found[near], score[near]
        order = np.lexsort((self.rid[found], self.vec_id[found], self.no_id[found], -score))[:k]
        return found[order], score[order]


def top_keep(k: int):
    """Rows whose upper bound is not under the k-th best lower bound."""
    def keep(score, low, high, live):
        own = score[live]
        if len(own) <= k:
            return None
        return score + high >= np.partition(own, len(own) - k)[len(own) - k] + low
    return keep


def window_keep(windows: list[tuple[int, int]], k: int):
    """Rows that may be among the k best inside one of the windows [least, most]."""
    least, most = min(w[0] for w in windows), max(w[1] for w in windows)

    def keep(score, low, high, live):
        if high - low > most - least:  # the bounds are wider than all the windows
            return None
        stay = np.zeros(len(score), bool)
        lower, upper = score + low, score + high
        for a, b in windows:
            sure = lower[live & (lower >= a) & (upper <= b)]
            least_ = max(a, np.partition(sure, len(sure) - k)[len(sure) - k]) if len(sure) > k else a
            stay |= (upper >= least_) & (lower <= b)
        return stay
    return keep


def window_of(positive: int, cfg: MineConfig) -> tuple[int, int]:
    """Least and greatest integer score n with low_percent * positive <= 100 * n <= high_percent * positive."""
    return -((-cfg.low_percent * positive) // 100), (cfg.high_percent * positive) // 100


FOUND = "anchor long, positive_score long, score long, vec_id long, rid long"


def _emit(rows: list[tuple[int, int | None, Block, np.ndarray, np.ndarray]]) -> pa.Table:
    n = [len(f) for *_, f, _ in rows]
    cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    no_id = cat([b.no_id[f] for _, _, b, f, _ in rows], bool)
    return pa.Table.from_arrays(
        [pa.array(np.repeat(np.array([r[0] for r in rows], np.int64), n)),
         pa.array([r[1] for r, k in zip(rows, n) for _ in range(k)], pa.int64()),
         pa.array(cat([s for *_, s in rows], np.int64).astype(np.int64)),
         pa.array(cat([b.vec_id[f] for _, _, b, f, _ in rows], np.int64), mask=no_id),
         pa.array(cat([b.rid[f] for _, _, b, f, _ in rows], np.int64))],
        ["anchor", "positive_score", "score", "vec_id", "rid"])


def _units(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, cfg: MineConfig, work) -> DataFrame:
    """``work(block table, group table)`` of every block with every group of anchors."""
    size = min(max(n_rows // cfg.blocks, cfg.block_rows[0]), cfg.block_rows[1])
    blocks, groups = -(-n_rows // size), -(-n_anchors // cfg.group_anchors)
    own = lambda n, seed: F.pmod(F.xxhash64(F.col("rid"), F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("block", own(blocks, 1)).withColumn("group", every(groups))
    right = anchors.withColumn("group", own(groups, 2)).withColumn("block", every(blocks))
    right = right.select(*[F.col(c).alias(f"a_{c}") for c in right.columns])
    return left.groupBy("block", "group").cogroup(right.groupBy("a_block", "a_group")).applyInArrow(work, FOUND)


def _positives(rows: DataFrame, anchors: DataFrame, sizes: tuple[int, int], cfg: MineConfig) -> DataFrame:
    """(anchor, place, positive_id, positive_score) of each anchor's first rows of its label."""
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            block = Block(left, matrix(right.column("a_vec").to_pylist(), right.column("a_width").to_pylist()))
            for i, (rid, label) in enumerate(zip(right.column("a_rid").to_pylist(), right.column("a_label").to_pylist())):
                part = block.of_label(label)
                if part.stop > part.start:
                    found, score = block.scan(i, part, top_keep(cfg.positives), cfg.step, block.rid[part] != rid)
                    out.append((rid, None, block, *block.best(found, score, cfg.positives)))
        return _emit(out)

    found = _units(rows, anchors, *sizes, cfg, work)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return (found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= cfg.positives)
            .select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))


def mine(vectors: DataFrame, cfg: MineConfig = MineConfig()) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor (vec_id
    divisible by ``anchor_every``) and each of its ``positives`` nearest rows of the same label, the ``negatives``
    best rows of other labels whose score lies between the two percentages of the positive's.

    Cases: rows with a null label, a null vector or a null or non-finite component take no part; vectors may
    differ in length (missing last components are 0); repeated rows are rows of their own, each an anchor where
    its id makes it one, and may be one another's positives; equal scores go by vec_id, a null one last (never
    an anchor), then by place in the table; an anchor alone in its label, or a positive with a score under 0,
    gives no row; an empty table gives an empty result; other columns are not read. Scores are exact as far as
    they fit a long.

    Anchors are a fixed share of the rows, so the work is their product: every block meets every group, dealt
    evenly by hash over all tasks. A unit's memory is bounded by ``block_rows`` and ``group_anchors``.
    """
    rows = common.stored(usable(vectors, cfg), "mine-rows")
    anchors = rows.where(F.col("vec_id") % cfg.anchor_every == 0)
    sizes = (rows.count(), anchors.count())
    if not all(sizes):
        return rows.sparkSession.createDataFrame([], RESULT)
    positives = common.stored(_positives(rows, anchors, sizes, cfg), "mine-positives")
    asked = positives.groupBy("anchor").agg(F.collect_set("positive_score").alias("scores")).withColumnRenamed("anchor", "rid")

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            block = Block(left, matrix(right.column("a_vec").to_pylist(), right.column("a_width").to_pylist()))
            every = slice(0, len(block.rid))
            for i, (rid, label, scores) in enumerate(zip(*(right.column(c).to_pylist() for c in ("a_rid", "a_label", "a_scores")))):
                windows = {s: w for s in scores if (w := window_of(s, cfg))[0] <= w[1]}
                if not windows:
                    continue
                live = np.ones(len(block.rid), bool)
                live[block.of_label(label)] = False
                found, score = block.scan(i, every, window_keep(list(windows.values()), cfg.negatives), cfg.step, live)
                for s, (a, b) in windows.items():
                    inside = (score >= a) & (score <= b)
                    if inside.any():
                        out.append((rid, s, block, *block.best(found[inside], score[inside], cfg.negatives)))
        return _emit(out)

    found = _units(rows, anchors.join(asked, "rid"), *sizes, cfg, work)
    first = Window.partitionBy("anchor", "positive_score").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    negatives = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= cfg.negatives)
    ids = anchors.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (positives.join(ids, "anchor").join(negatives, ["anchor", "positive_score"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
