"""Chosen-path similarity join of documents by their word shingles.

Equal texts are one set. Every set is embedded to ``tokens`` min-hash tokens (place, value); the share
of tokens that two sets have in common estimates their Jaccard similarity. In each of ``runs`` repeated
runs a set walks a tree: at a node it takes on every token whose hash with the path so far falls under
1 / (similarity * tokens), so a pair at the threshold shares one of its tokens on average and ends in a
common bucket with a known probability, while unlike sets part ways. Buckets of ``small`` sets or fewer
are leaves; larger ones are split again, down to ``depth``. The number of runs follows from the recall
wanted at the full depth.

The leaves of all runs are joined to candidate groups first: sets that share a leaf and look similar by
their tokens are in one group. For this a leaf needs no list of its pairs. Every set is compared with the
leaf's smallest, and only where that leaves more than one class, strays are compared with the rest; each
task reports a spanning forest. Then every group's sets are compared exactly. A group is cut to blocks of
bounded size. A unit of work holds one block and lets the sets of up to ``visits`` other blocks stream past
it; of two blocks one visits the other. A unit reports the number of links of each set and a spanning
forest of them, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qoeflow.llm import common, wordhash
from qoeflow.llm.components import components


@dataclass(frozen=True)
class JoinConfig:
    """Parameters of the join. ``slack``: how far the estimate may fall below the similarity (four
    standard deviations of the share of 64 tokens at 0.8). ``block``: sets of a block of a leaf that meet at
    once; ``held`` and ``held_shingles``: sets, and shingles in all, of a block that a unit of exact work holds."""

    shingle: int = 5
    similarity: float = 0.8
    tokens: int = 64
    depth: int = 3
    recall: float = 0.9995
    small: int = 64
    block: int = 256
    held: int = 2048
    held_shingles: int = 1 << 20
    visits: int = 16
    slack: float = 0.2
    seed: int = 20260

    @property
    def runs(self) -> int:
        """Runs that find a pair at the threshold with the recall wanted, if every bucket goes to full depth.

        A pair shares Poisson(1) tokens at a node; q is the chance that a common path survives.
        """
        q = 1.0
        for _ in range(self.depth):
            q = 1 - math.exp(-q)
        return math.ceil(math.log(1 - self.recall) / math.log(1 - q))


def _multipliers(cfg: JoinConfig) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(cfg.seed)
    return (r.integers(1, 1 << 63, cfg.tokens, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            r.integers(0, 1 << 63, cfg.tokens, dtype=np.uint64))


def signature(shingles: np.ndarray, cfg: JoinConfig) -> np.ndarray:
    """The min-hash tokens (32 bits each) of a set of shingle hashes."""
    mul, add = _multipliers(cfg)
    best = np.full(cfg.tokens, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(shingles), 4096):
        part = (shingles[a:a + 4096, None] * mul[None, :] + add[None, :]) >> np.uint64(32)
        best = np.minimum(best, part.astype(np.uint32).min(axis=0))
    return best


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    common_ = len(np.intersect1d(a, b, assume_unique=True))
    return common_ / (len(a) + len(b) - common_)


def _sets(rows: DataFrame, cfg: JoinConfig) -> DataFrame:
    """(rid, digest, sig, size) of texts with words: digest of the whole word sequence, min-hash tokens, shingles."""

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            ids, digests, sigs, sizes = [], [], [], []
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("text").to_pylist()):
                hashes = wordhash.word_hashes(text)
                if not len(hashes):
                    continue
                grams = np.unique(wordhash.gram_hashes(hashes, min(cfg.shingle, len(hashes))))
                ids.append(rid)
                whole = wordhash.gram_hashes(hashes, len(hashes))[0]
                digests.append(int(whole).to_bytes(8, "big") + len(hashes).to_bytes(4, "big")
                               + int(np.bitwise_xor.reduce(grams)).to_bytes(8, "big"))
                sigs.append(signature(grams, cfg).tobytes())
                sizes.append(len(grams))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary()), pa.array(sizes, pa.int64())],
                ["rid", "digest", "sig", "size"])

    return rows.select("rid", "text").mapInArrow(embed, "rid long, digest binary, sig binary, size long")


def _paths(sigs: np.ndarray, parents: np.ndarray, cfg: JoinConfig) -> tuple[np.ndarray, np.ndarray]:
    """The children of nodes: (row, path) for each token that the node's path chooses."""
    place = np.arange(cfg.tokens, dtype=np.uint64) << np.uint64(32)
    child = wordhash.mix((sigs.astype(np.uint64) | place[None, :]) ^ wordhash.mix(parents)[:, None])
    chosen = wordhash.mix(child) < np.uint64(int(2.0 ** 64 / (cfg.similarity * cfg.tokens)))
    row, token = np.nonzero(chosen)
    return row, child[row, token]


def _unpack(column, cfg: JoinConfig) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, cfg.tokens)


def _first_paths(sets: DataFrame, cfg: JoinConfig) -> DataFrame:
    runs = cfg.runs

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            sigs, rids = _unpack(batch["sig"], cfg), batch["rid"].to_numpy()
            for run in range(runs):
                row, path = _paths(sigs, np.full(len(sigs), run + 1, np.uint64), cfg)
                yield pd.DataFrame({"bucket": path.view(np.int64), "rid": rids[row]})

    return sets.select("rid", "sig").mapInPandas(walk, "bucket long, rid long")


def _next_paths(nodes: DataFrame, cfg: JoinConfig) -> DataFrame:
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 4096):
                part = batch.iloc[a:a + 4096]
                row, path = _paths(_unpack(part["sig"], cfg), part["bucket"].to_numpy().view(np.uint64), cfg)
                yield pd.DataFrame({"bucket": path.view(np.int64), "rid": part["rid"].to_numpy()[row]})

    return nodes.select("bucket", "rid", "sig").mapInPandas(walk, "bucket long, rid long")


def _leaves(sets: DataFrame, cfg: JoinConfig) -> DataFrame:
    """(bucket, rid, n, pivot) of all leaves with two sets or more; pivot is the bucket's smallest set.

    Sizes are stored before they are joined, here as for the other groups: with both sides of the join
    shuffled for it, Spark can split the rows of one large bucket over tasks.
    """
    level, out = _first_paths(sets, cfg), None
    for depth in range(1, cfg.depth + 1):
        level = common.stored(level.distinct() if depth > 1 else level, "paths")
        sizes = common.stored(
            level.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("pivot")).where("n > 1"), "sizes")
        held = common.stored(level.join(sizes, "bucket"), "buckets")
        leaf = held if depth == cfg.depth else held.where(F.col("n") <= cfg.small)
        out = leaf if out is None else out.unionByName(leaf)
        if depth < cfg.depth:
            level = _next_paths(held.where(F.col("n") > cfg.small).join(sets.select("rid", "sig"), "rid"), cfg)
    return out


def _estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


def _star_pairs(leaves: DataFrame, sets: DataFrame, cfg: JoinConfig) -> DataFrame:
    """Sets and pivots of their leaves that look similar."""
    pairs = leaves.where("rid <> pivot").select("rid", "pivot").distinct()

    @F.pandas_udf("double")
    def near(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(_estimate(_unpack(a, cfg), _unpack(b, cfg)) if len(a) else [], dtype="float64")

    return (pairs.join(sets.select("rid", "sig"), "rid")
            .join(sets.select(F.col("rid").alias("pivot"), F.col("sig").alias("pivot_sig")), "pivot")
            .where(near("sig", "pivot_sig") >= cfg.similarity - cfg.slack)
            .select(F.col("rid").alias("a"), F.col("pivot").alias("b")))


def _cross_pairs(leaves: DataFrame, sets: DataFrame, classes: DataFrame, cfg: JoinConfig) -> DataFrame:
    """Pairs of different classes that share a leaf and look similar; of those found together, a spanning forest.

    A leaf is cut to blocks of ``block`` sets. The sets of its largest class stand in one block each, all
    others in every block, so each pair of different classes meets, and a leaf that is one large class
    with a few strays costs about its size.
    """
    labelled = (leaves.select("bucket", "rid", "n")
                .join(classes.select(F.col("node").alias("rid"), "class"), "rid", "left")
                .withColumn("class", F.coalesce("class", "rid")))
    per = labelled.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("k"))
    mixed = (per.groupBy("bucket").agg(F.count(F.lit(1)).alias("classes"), F.max(F.struct("k", "class")).alias("top"))
             .where("classes > 1").select("bucket", F.col("top.class").alias("top")))
    blocks = F.ceil(F.col("n") / F.lit(cfg.block)).cast("int")
    own = F.pmod(F.xxhash64("rid"), blocks).cast("int")
    placed = (labelled.join(mixed, "bucket")
              .withColumn("own", own).withColumn("stray", F.col("class") != F.col("top"))
              .withColumn("blocks", F.when(F.col("stray"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array("own")))
              .select("bucket", "rid", "class", "own", "stray", F.explode("blocks").alias("block"))
              .join(sets.select("rid", "sig"), "rid"))
    # A block is the unit of work; bucket and block go to one key, so that no large leaf lands in one task.
    dealt = (placed.withColumn("key", F.xxhash64("bucket", "block"))
             .repartition(common.partitions(leaves.sparkSession), "key").sortWithinPartitions("key", "bucket", "block"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        least = cfg.similarity - cfg.slack
        for group in _groups(batches):
            sigs, rids = _unpack(group["sig"], cfg), group["rid"].to_numpy()
            cls, home, stray = group["class"].to_numpy(), group["own"].to_numpy(), group["stray"].to_numpy()
            block, forest = int(group["block"].iloc[0]), Forest()
            for i in range(len(rids) - 1):
                rest = np.arange(i + 1, len(rids))
                # Two strays meet in every block of their leaf; the home block of the smaller one counts.
                here = np.where(rids[i] < rids[rest], home[i], home[rest]) == block
                rest = rest[(cls[rest] != cls[i]) & (here | ~(stray[i] & stray[rest]))]
                for j in rest[_estimate(sigs[i][None, :], sigs[rest]) >= least]:
                    # Sets of one class are joined already.
                    forest.join(int(cls[i]), int(cls[j]), (int(max(rids[i], rids[j])), int(min(rids[i], rids[j]))))
            if forest.links:
                yield pd.DataFrame(forest.links, columns=["a", "b"])

    return dealt.select("bucket", "block", "rid", "class", "own", "stray", "sig").mapInPandas(compare, "a long, b long").distinct()


class Forest:
    """Union-find that keeps the links that joined something."""

    def __init__(self):
        self.up: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        top = x
        while self.up.setdefault(top, top) != top:
            top = self.up[top]
        while self.up[x] != top:
            self.up[x], x = top, self.up[x]
        return top

    def join(self, a: int, b: int, link: tuple[int, int]) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.links.append(link)


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of rows with one (bucket, block), also where a run goes on in the next batch."""
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        bucket, block = batch["bucket"].to_numpy(), batch["block"].to_numpy()
        cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])) + 1
        edges = [0, *cuts.tolist()]
        for a, b in zip(edges, edges[1:]):
            if b - a > 1:
                yield batch.iloc[a:b]
        rest = batch.iloc[edges[-1]:]
    if rest is not None and len(rest) > 1:
        yield rest


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the sets, all their shingles, and the number of each shingle's set."""
    size = np.array([len(x) for x in sets])
    return size, np.concatenate(sets), np.repeat(np.arange(len(sets)), size)


#: Columns of the 0/1 matrices that are multiplied at a time.
COLUMNS = 4096


def _common(left: tuple[np.ndarray, np.ndarray, int], right: tuple[np.ndarray, np.ndarray, int], columns: int) -> np.ndarray:
    """Sizes of the intersections of two lists of sets, given as (set, column, number of sets): products of 0/1 columns."""
    out = np.zeros((left[2], right[2]), np.float32)
    sides = []
    for owner, column, n in ((left, right) if left is not right else (left,)):
        order = np.argsort(column, kind="stable")
        sides.append((owner[order], column[order], n))
    for a in range(0, columns, COLUMNS):
        parts = []
        for owner, column, n in sides:
            lo, hi = np.searchsorted(column, [a, a + COLUMNS])
            part = np.zeros((n, min(COLUMNS, columns - a)), np.float32)
            part[owner[lo:hi], column[lo:hi] - a] = 1
            parts.append(part)
        out += parts[0] @ parts[-1].T
    return out


def _enough(common_: np.ndarray, left: np.ndarray, right: np.ndarray, cfg: JoinConfig) -> np.ndarray:
    return common_ >= cfg.similarity * (left[:, None] + right[None, :] - common_) - 1e-6


def _similar(sets: list[np.ndarray], cfg: JoinConfig) -> np.ndarray:
    """Which of the sets are similar, as a matrix."""
    size, flat, owner = _flat(sets)
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    number = np.cumsum(times > 1) - 1
    side = owner[shared], number[column[shared]], len(sets)
    found = _enough(_common(side, side, int(number[-1]) + 1 if len(number) else 0), size, size, cfg)
    np.fill_diagonal(found, False)
    return found


def _spanning(found: np.ndarray) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links (row, column) of a matrix; every row and every column is looked at once."""
    new_rows, new_columns = found.any(axis=1), np.ones(found.shape[1], bool)
    for start in np.flatnonzero(new_rows):
        if not new_rows[start]:
            continue
        new_rows[start] = False
        rows = [int(start)]
        while rows:
            row = rows.pop()
            reached = np.flatnonzero(found[row] & new_columns)
            new_columns[reached] = False
            for column in reached.tolist():
                yield row, column
                below = np.flatnonzero(found[:, column] & new_rows)
                new_rows[below] = False
                for x in below.tolist():
                    yield x, column
                    rows.append(x)


class Unit:
    """One block of a group, held; the sets of other blocks stream past it."""

    #: Sets that pass by at a time.
    PASSING = 256

    def __init__(self, cfg: JoinConfig, among: bool):
        self.cfg, self.among, self.sets, self.rids, self.copies = cfg, among, [], [], []
        self.closed, self.forest, self.out = False, Forest(), []

    def hold(self, sets: list[np.ndarray], rids: np.ndarray, copies: np.ndarray) -> None:
        self.sets += sets
        self.rids.append(rids)
        self.copies.append(copies)

    def close(self) -> None:
        """All sets of the block are here: compare them with one another, once for each block."""
        self.closed = True
        if not self.sets:
            return
        self.rids, self.copies = np.concatenate(self.rids), np.concatenate(self.copies)
        self.n = np.zeros(len(self.rids), np.int64)
        if self.among and len(self.sets) > 1:
            found = _similar(self.sets, self.cfg)
            self.n += found @ self.copies
            self._link(found, self.rids, self.rids)

    def _link(self, found: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        for i, j in _spanning(found):
            a, b = int(max(left[i], right[j])), int(min(left[i], right[j]))
            self.forest.join(a, b, (a, b))

    def meet(self, sets: list[np.ndarray], rids: np.ndarray, copies: np.ndarray) -> None:
        if not self.closed:
            self.close()
            if self.sets:
                self.size, flat, self.owner = _flat(self.sets)
                self.words, self.column = np.unique(flat, return_inverse=True)
        if not self.sets:
            return
        for a in range(0, len(sets), self.PASSING):
            size, flat, owner = _flat(sets[a:a + self.PASSING])
            at = np.searchsorted(self.words, flat)
            at[at == len(self.words)] = 0
            known = self.words[at] == flat
            used = np.zeros(len(self.words), bool)
            used[at[known]] = True
            number = np.cumsum(used) - 1
            mine = used[self.column]
            found = _enough(_common((self.owner[mine], number[self.column[mine]], len(self.sets)),
                                    (owner[known], number[at[known]], len(size)), int(number[-1]) + 1), self.size, size, self.cfg)
            here = slice(a, a + self.PASSING)
            self.n += found @ copies[here]
            n = found.T @ self.copies
            self.out += [(int(r), int(k)) for r, k in zip(rids[here][n > 0], n[n > 0])]
            self._link(found, self.rids, rids[here])

    def report(self) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """Links of the forest, and the numbers of links."""
        if not self.closed:
            self.close()
        if not self.sets:
            return [], []
        return self.forest.links, self.out + [(int(r), int(k)) for r, k in zip(self.rids[self.n > 0], self.n[self.n > 0])]


def _placed(member: DataFrame, cfg: JoinConfig) -> DataFrame:
    """Members (rid, class, blocks, ...) at their units (class, home, part), ``away`` where they visit.

    Blocks stand in a ring and visit the half of the ring before them, so each two meet once. A unit takes the
    visits of ``cfg.visits`` blocks; a block is held once for each of its units.
    """
    own = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    half = F.floor(F.col("blocks") / 2).cast("int")
    parts = F.greatest(F.lit(1), F.ceil(half / F.lit(cfg.visits))).cast("int")
    homes = F.transform(F.sequence(F.lit(0), parts - 1), lambda p: F.struct(
        F.col("own").alias("home"), p.alias("part"), F.lit(False).alias("away")))
    # Blocks that face each other in the ring would both visit: the one with the larger number does.
    steps = F.filter(F.sequence(F.lit(0), half), lambda d: (d > 0) & ((d * 2 < F.col("blocks")) | (F.col("own") >= d)))
    visits = F.transform(steps, lambda d: F.struct(
        F.pmod(F.col("own") - d, F.col("blocks")).cast("int").alias("home"),
        F.floor((d - 1) / F.lit(cfg.visits)).cast("int").alias("part"), F.lit(True).alias("away")))
    return (member.withColumn("own", own).withColumn("at", F.explode(F.concat(homes, visits)))
            .select(*[c for c in member.columns if c != "blocks"], "at.home", "at.part", "at.away"))


def _compared(groups: DataFrame, sets: DataFrame, rows: DataFrame, cfg: JoinConfig) -> DataFrame:
    """Exact comparison inside candidate groups (node, class): rows (a, b, n).

    With b: a link of the forest. Without: set a has n links in this unit, counted as documents.
    """
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            found = [wordhash.shingles(t, cfg.shingle).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.binary())], [*batch.schema.names[:-1], "shingles"])

    of = groups.select(F.col("node").alias("rid"), "class").join(sets.select("rid", "copies", "size"), "rid")
    # Twice the blocks that an even deal needs, as the hash deals them unevenly; a set may be larger than a block.
    blocks = F.ceil(F.greatest(F.col("n") / F.lit(cfg.held), 2 * F.col("total") / F.lit(cfg.held_shingles))).cast("int")
    sizes = of.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total")).select(
        "class", F.when((F.col("n") <= cfg.held) & (F.col("total") <= cfg.held_shingles), 1).otherwise(blocks).alias("blocks"))
    member = (of.join(sizes, "class").join(rows.select("rid", "text"), "rid")
              .select("rid", "class", "blocks", "copies", "text")
              .mapInArrow(whole, "rid long, class long, blocks int, copies long, shingles binary"))
    dealt = (_placed(member, cfg).repartition(common.partitions(rows.sparkSession), "class", "home", "part")
             .sortWithinPartitions("class", "home", "part", "away"))
    links = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, key, forest, counted = None, None, [], []

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([a for a, _ in forest] + [a for a, _ in counted], pa.int64()),
                pa.array([b for _, b in forest] + [None] * len(counted), pa.int64()),
                pa.array([0] * len(forest) + [n for _, n in counted], pa.int64())], schema=links)

        for batch in common.slices(batches, "shingles"):
            cls, home, part, rids, copies = (batch.column(c).to_numpy() for c in ("class", "home", "part", "rid", "copies"))
            away = batch.column("away").to_numpy(zero_copy_only=False)
            found = [np.frombuffer(x, np.uint64) for x in batch.column("shingles").to_pylist()]
            edge = (cls[1:] != cls[:-1]) | (home[1:] != home[:-1]) | (part[1:] != part[:-1]) | (away[1:] != away[:-1])
            cuts = [0, *(np.flatnonzero(edge) + 1).tolist(), len(cls)]
            for a, b in zip(cuts, cuts[1:]):
                at = cls[a], home[a], part[a]
                if at != key:
                    if unit is not None:
                        for all_, new in zip((forest, counted), unit.report()):
                            all_ += new
                    unit, key = Unit(cfg, part[a] == 0), at
                (unit.meet if away[a] else unit.hold)(found[a:b], rids[a:b], copies[a:b])
            if len(forest) + len(counted) > 50_000:
                yield told()
                forest, counted = [], []
        if unit is not None:
            for all_, new in zip((forest, counted), unit.report()):
                all_ += new
        yield told()

    return dealt.select("class", "home", "part", "away", "rid", "copies", "shingles").mapInArrow(compare, "a long, b long, n long")


def link_documents(docs: DataFrame, cfg: JoinConfig = JoinConfig()) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, class_id, n_links, kept.

    class_id is the smallest doc_id of the rows that are connected by links (texts of equal words, or a
    similarity of 0.8 or more). n_links is the number of other rows that are linked with the row: rows of
    equal words, and all rows of its candidate group with a similarity of 0.8 or more. kept marks one row of
    each class: that with the smallest doc_id (null last), the first of equal ones.

    Cases: null, empty and wordless texts have no shingles, are similar to nothing (not even to one
    another) and are classes of their own; texts of fewer than five words have one shingle, all of it;
    equal rows are one set; a null doc_id counts only where no row of the class has an id, class_id is null
    then; an empty table gives an empty result; other columns are not read.
    """
    return _link(common.identified(docs, ["doc_id", "text"], "rid", "join-input"), "rid", cfg)


def _link(docs: DataFrame, rid: str, cfg: JoinConfig) -> DataFrame:
    rows = docs.select(F.col(rid).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    embedded = common.stored(_sets(rows, cfg), "sets")
    grouped = common.stored(embedded.groupBy("digest").agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("copies")), "digests")
    member = common.stored(embedded.select("rid", "digest").join(grouped, "digest").select("rid", "rep", "copies"), "members")
    sets = embedded.select("rid", "sig", "size").join(member.where("rid = rep").select("rid", "copies"), "rid")
    sets = common.stored(sets, "sets")

    leaves = common.stored(_leaves(sets, cfg), "leaves")
    stars = common.stored(_star_pairs(leaves, sets, cfg), "stars")
    crossing = _cross_pairs(leaves, sets, components(stars), cfg)
    groups = components(stars.unionByName(crossing))
    found = common.stored(_compared(groups, sets, rows, cfg), "links")

    classes = components(found.where("b IS NOT NULL").select("a", "b")).select(F.col("node").alias("rep"), "class")
    degree = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("near")).select(F.col("a").alias("rep"), "near")
    of_rep = (sets.select(F.col("rid").alias("rep")).join(classes, "rep", "left").join(degree, "rep", "left")
              .select("rep", F.coalesce("class", "rep").alias("class"), F.coalesce("near", F.lit(0)).alias("near")))
    of_row = member.join(of_rep, "rep").select("rid", "class", (F.col("copies") - 1 + F.col("near")).alias("n"))
    labelled = common.stored(
        rows.select("rid", "doc_id").join(of_row, "rid", "left")
        .select("rid", "doc_id", F.coalesce("class", "rid").alias("class"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links")),
        "labelled")
    names = common.stored(labelled.groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")).alias("first")), "classes")
    return (labelled.join(names, "class")
            .select("rid", "doc_id", "class_id", "n_links", (F.col("rid") == F.col("first.rid")).alias("kept")))


def keep_one(docs: DataFrame, cfg: JoinConfig = JoinConfig()) -> DataFrame:
    """``docs``, all columns kept, with the one row of each class that :func:`link_documents` marks."""
    rid = common.free_name(docs, "rid")
    rows = common.identified(docs, docs.columns, rid, "join-input")
    dropped = _link(rows, rid, cfg).where("NOT kept").select(F.col("rid").alias(rid))
    return rows.join(dropped, rid, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
