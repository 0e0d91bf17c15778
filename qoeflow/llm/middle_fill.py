"""Fill-in-the-middle texts, cut at token boundaries that a learned rank index finds.

A text of n tokens has n + 1 boundary offsets, from 0 to its length in code points. They are a sorted list,
and its index is a piecewise-linear model of offset by rank: segments (first rank, offset there, slope) are
fitted greedily, each as long as one line stays within ``error`` code points of every boundary it covers (the
cone of slopes that the boundaries so far allow is narrowed step by step, and a segment ends where it is
empty). What the line misses at each rank is stored in a byte. A cut asks for a few of the boundaries: its
segment is found by bisection, the line predicts, and the stored residual gives the exact offset.

The index is a table (:func:`boundary_index`) of some 1 byte a token; new cuts for a text can be drawn from it
without reading the text again (:func:`drawn`). :func:`transform` makes it on the way and cuts at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qoeflow.llm import common, wordhash

#: Marks of prefix, suffix and middle, and shares of the forms (fixed values of the contract).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42


@dataclass(frozen=True)
class FillConfig:
    """``rate``: percent of the texts that are cut; ``spm``: percent of these in the order suffix, prefix,
    middle; ``error``: what a segment may miss a boundary by, in code points (a residual is one byte)."""

    seed: int = SEED
    rate: int = 50
    spm: int = 80
    error: int = 120

    def __post_init__(self):
        if not 1 <= self.error <= 126:  # a rounded prediction may miss by one more, and has a byte then too
            raise ValueError(f"error must be 1 to 126, got {self.error}")


def boundaries(text: str | None) -> np.ndarray:
    """Offsets, in code points, of the token boundaries: 0, then the end of each token. A token is a word with
    the white space before it; white space at the end of the text is one of its own."""
    if not text:
        return np.zeros(1, np.int64)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    _, ends = wordhash.word_bounds(raw)
    if not len(ends) or ends[-1] < len(raw):
        ends = np.append(ends, len(raw))
    if len(raw) != len(text):
        ends = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[ends]
    return np.concatenate(([0], ends)).astype(np.int64)


def fit(offsets: np.ndarray, error: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first rank, offset at it, slope) of the segments over sorted offsets, by a narrowing cone of slopes.

    The ranks after a segment's start are taken in pieces of doubling length; where the greatest of the
    least slopes passes the least of the greatest ones, the segment ends.
    """
    first, at, slope = [], [], []
    start, n = 0, len(offsets)
    while start < n:
        low, high, end, size = -np.inf, np.inf, start + 1, 64
        while end < n:
            stop = min(n, end + size)
            run = np.arange(end - start, stop - start)
            rise = offsets[end:stop] - offsets[start]
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            closed = lows > highs
            if closed.any():
                k = int(closed.argmax())
                if k:
                    low, high = lows[k - 1], highs[k - 1]
                end += k
                break
            low, high, end, size = lows[-1], highs[-1], stop, 2 * size
        first.append(start)
        at.append(int(offsets[start]))
        slope.append((low + high) / 2 if np.isfinite(low) else 0.0)
        start = end
    return np.array(first, np.int64), np.array(at, np.int64), np.array(slope)


@dataclass(frozen=True)
class RankIndex:
    """Boundary offset by rank: segments, and a residual for each rank."""

    first: np.ndarray
    at: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @classmethod
    def of(cls, offsets: np.ndarray, error: int) -> RankIndex:
        bare = cls(*fit(offsets, error), np.zeros(0, np.int8))
        missed = offsets - bare.predict(np.arange(len(offsets)))
        return cls(bare.first, bare.at, bare.slope, missed.astype(np.int8))

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        piece = np.searchsorted(self.first, ranks, side="right") - 1
        return self.at[piece] + np.rint(self.slope[piece] * (ranks - self.first[piece])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets: predictions corrected by the stored residuals."""
        return self.predict(ranks) + self.residual[ranks]


def draws(doc_id: int | None, cfg: FillConfig) -> list[int]:
    """h1 to h4 of a document (of the word null, where it has no id)."""
    digest = hashlib.sha256(f"{cfg.seed}:{'null' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4)]


def markable(text: str) -> bool:
    """Whether a text may be cut: it isn't empty and has none of the marks."""
    return bool(text) and not any(m in text for m in (PREFIX, SUFFIX, MIDDLE))


def form_of(h: list[int], may: bool, cfg: FillConfig) -> str:
    if not may or h[2] % 100 >= cfg.rate:
        return "plain"
    return "spm" if h[3] % 100 < cfg.spm else "psm"


def cut_ranks(h: list[int], n: int) -> np.ndarray:
    return np.sort(np.array([h[0] % (n + 1), h[1] % (n + 1)], np.int64))


def arranged(text: str, form: str, a: int, b: int) -> str:
    if form == "plain":
        return text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def restored(output: str = "output", form: str = "form"):
    """The exact text, from an output and its form: what stands between the marks, in the text's order."""
    rest = F.expr(f"substr(`{output}`, 4)")

    def parts(second: str):
        one = F.substring_index(rest, second, 1)
        behind = F.substr(rest, F.length(one) + 4)
        two = F.substring_index(behind, MIDDLE, 1)
        return one, two, F.substr(behind, F.length(two) + 4)

    prefix, suffix, middle = parts(SUFFIX)
    suffix_, prefix_, middle_ = parts(PREFIX)
    return (F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "psm", F.concat(prefix, middle, suffix))
            .otherwise(F.concat(prefix_, middle_, suffix_)))


def transform(docs: DataFrame, cfg: FillConfig = FillConfig()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n (tokens), form, prefix_chars, middle_chars (null if
    plain), output (the text in its form), n_segments (of the text's rank index).

    A draw keyed by seed and doc_id decides form and cuts, so a document is treated alike wherever it lies.
    Cases: a null text is an empty one; empty texts and texts with one of the marks stay plain; a text of white
    space is one token; prefix, middle and suffix may be empty; rows with the same doc_id share their draw;
    a null doc_id draws as the word null; an empty table gives an empty result; other columns are not read.
    Texts are cut where they are read: nothing is shuffled, and a task holds a slice of its batch at a time.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                offsets, h = boundaries(text), draws(doc_id, cfg)
                index = RankIndex.of(offsets, cfg.error)
                n, form = len(offsets) - 1, form_of(h, markable(text), cfg)
                a, b = index.offsets(cut_ranks(h, n)).tolist()
                own = (None, None) if form == "plain" else (a, b - a)
                out.append((n, form, *own, arranged(text, form, a, b), len(index.first)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))],
                                             ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "n_segments"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, n_segments int")


INDEX = "doc_id long, n long, markable boolean, first array<long>, at array<long>, slope array<double>, residual binary"


def boundary_index(docs: DataFrame, cfg: FillConfig = FillConfig()) -> DataFrame:
    """The rank index of every text, a row per row of ``docs``: to be stored, for cuts of other seeds and rates
    (cases as in :func:`transform`)."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            out = []
            for text in batch.column("text").to_pylist():
                x = RankIndex.of(boundaries(text), cfg.error)
                out.append((len(x.residual) - 1, markable(text or ""), x.first, x.at, x.slope, x.residual.tobytes()))
            kinds = (pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))],
                                             ["doc_id", "n", "markable", "first", "at", "slope", "residual"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, INDEX)


def drawn(index: DataFrame, cfg: FillConfig = FillConfig()) -> DataFrame:
    """Form and cuts of every row of a :func:`boundary_index`: doc_id, n, form, prefix_chars, middle_chars. No
    text is read."""
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "residual"):
            out = []
            for r in batch.to_pylist():
                h = draws(r["doc_id"], cfg)
                x = RankIndex(np.array(r["first"]), np.array(r["at"]), np.array(r["slope"]), np.frombuffer(r["residual"], np.int8))
                form = form_of(h, r["markable"], cfg)
                a, b = x.offsets(cut_ranks(h, r["n"])).tolist()
                out.append((r["doc_id"], r["n"], form, *((None, None) if form == "plain" else (a, b - a))))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             ["doc_id", "n", "form", "prefix_chars", "middle_chars"])

    return index.mapInArrow(draw, "doc_id long, n long, form string, prefix_chars long, middle_chars long")


def digest_columns(filled: DataFrame) -> DataFrame:
    """The contract's columns of :func:`transform`'s rows."""
    return filled.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                         F.sha2(restored(), 256).alias("restored_sha256"), "n_segments")
