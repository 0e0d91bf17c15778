"""Removal of passages that stand earlier, in another document or the same: digests of units, grouped globally.

Lines and paragraphs are the usual units, but passages are copied from the middle of a line into the
middle of another, where no line of theirs is whole. So the units here are set by content: all runs of
``unit`` words are hashed, and of each ``unit`` consecutive runs the one with the smallest hash is a
unit. Both copies of a passage of 2 * unit - 1 words or more choose the same unit at least once, and
neighbouring units are at most ``unit`` words apart.

Units are grouped by digest; the earliest ranked occurrence stays. Later occurrences that touch and stand
alike in one earlier place form a chain, and a chain is extended word by word against that place, at most
unit - 1 words at either end, as far as both agree. What touches or overlaps then merges to a span, and
spans of ``least`` words or more are removed, offsets in the original text given. A lone unit (a licence
line, a colliding digest) is never enough. Whole lines, paragraphs and texts that are too short for this
are units beside these, and go as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qoeflow.llm import common, wordhash

UNIT = 13
LEAST = 25
#: Sets the digests of whole lines, paragraphs and texts apart from those of units set by content.
WHOLE = np.uint64(0xA0761D6478BD642F)


def units(text: str | None, unit: int = UNIT) -> tuple[np.ndarray, np.ndarray]:
    """(digest, number of the first word) of each unit of the text."""
    grams = wordhash.gram_hashes(wordhash.word_hashes(text), unit)
    if not len(grams):
        return grams, np.zeros(0, np.int64)
    if len(grams) <= unit:
        at = np.array([len(grams) - 1 - int(np.argmin(grams[::-1]))])
    else:
        windows = np.lib.stride_tricks.sliding_window_view(grams[::-1], unit)
        at = np.unique(len(grams) - 1 - (np.arange(len(windows)) + np.argmin(windows, axis=1)))
    return grams[at], at


def whole_units(text: str | None, shortest: int = UNIT, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(digest, first word, words) of the lines and paragraphs of ``shortest`` words or more and of a text of
    any length, as far as they have fewer than ``least`` words (longer ones have units set by content)."""
    raw = wordhash.encoded(text)
    starts, _ = wordhash.word_bounds(raw)
    if not len(starts):
        return []
    lines = np.concatenate(([0], np.searchsorted(starts, np.flatnonzero(raw == 10)), [len(starts)]))
    empty = lines[:-1][np.diff(lines) == 0]
    paragraphs = np.unique(np.concatenate(([0], empty, [len(starts)])))
    found = {(0, len(starts))} if len(starts) < least else set()
    for cuts in (lines, paragraphs):
        size = np.diff(cuts)
        at = np.flatnonzero((size >= shortest) & (size < least))
        found.update(zip(cuts[at].tolist(), size[at].tolist()))
    if not found:
        return []
    hashes = wordhash.word_hashes(text)
    return [(int(wordhash.gram_hashes(hashes[a:a + n], n)[0] ^ WHOLE), a, n) for a, n in sorted(found)]


def find_units(docs: DataFrame, unit: int, least: int = LEAST, whole: bool = False) -> DataFrame:
    """Rows (rid, doc_id, digest, at, whole): the units of every text; ``whole`` is the number of words of
    a whole line, paragraph or text, 0 for a unit set by content."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            ids, docs_, digests, places, sizes = [], [], [], [], []
            for rid, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                digest, at = units(text, unit)
                more = whole_units(text, unit, least) if whole else []
                n = len(at) + len(more)
                if not n:
                    continue
                ids.append(np.full(n, rid, np.int64))
                docs_ += [doc_id] * n
                digests += [digest, np.array([d for d, _, _ in more], np.uint64)]
                places += [at, np.array([a for _, a, _ in more], np.int64)]
                sizes += [np.zeros(len(at), np.int64), np.array([k for _, _, k in more], np.int64)]
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(ids)), pa.array(docs_, pa.int64()), pa.array(np.concatenate(digests).view(np.int64)),
                     pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(sizes).astype(np.int32))],
                    ["rid", "doc_id", "digest", "at", "whole"])

    return docs.select("rid", "doc_id", "text").mapInArrow(find, "rid long, doc_id long, digest long, at int, whole int")


SPANS = "array<struct<start:int,end:int>>"


def find_repeats(docs: DataFrame, unit: int = UNIT, least: int = LEAST, within: bool = False, whole: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, text, ``spans`` (words, end exclusive) that an earlier ranked
    document has as well. Rank: doc_id (null last), then scan order.

    ``within``: what a document itself has further ahead goes too; only a unit that overlaps its own first
    place stays. ``whole``: repeated lines and paragraphs of ``unit`` words or more and repeated texts of any
    length go, also under ``least`` words. The query sets both. Cases: null and empty texts have no units
    and no spans, nor have short texts without ``whole``; equal rows are ranked by scan order, so all but the
    first lose what they share; an empty table gives an empty result; other columns are not read.
    """
    rows = with_ids(docs)
    found = common.stored(find_units(rows, unit, least, whole), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid", "at")
    # Stored, so that both sides of the join are shuffled for it and Spark can split a frequent digest over tasks.
    first = common.stored(found.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
                          .where("n > 1").select("digest", F.col("first.rid").alias("first_rid"), F.col("first.at").alias("first_at")), "first-units")
    repeat = F.col("rid") != F.col("first_rid")
    if within:
        repeat |= F.col("at") >= F.col("first_at") + F.greatest("whole", F.lit(unit))
    later = found.join(first, "digest").where(repeat)
    ends = common.stored(later.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("at", "whole", "first_rid", "first_at"))).alias("units"))
                         .mapInArrow(_ends(unit), ENDS), "ends")
    # The words around the first places: only the places are asked for, each once, however many copies meet there.
    places = (ends.where("side < 2").select(F.col("first_rid").alias("rid"), "place", "side").distinct()
              .groupBy("rid").agg(F.collect_list(F.struct("place", "side")).alias("places")))
    around = common.stored(rows.select("rid", "text").join(places, "rid").mapInArrow(_around(unit), AROUND), "around")
    known = (ends.where("side < 2").join(around, ["first_rid", "place", "side"]).select("rid", "start", "end", "side", "room", "words")
             .unionByName(ends.where("side = 2").select("rid", "start", "end", "side", "room", F.lit(None).cast("binary").alias("words"))))
    matched = known.groupBy("rid").agg(F.collect_list(F.struct("start", "end", "side", "room", "words")).alias("ends"))
    return rows.join(matched, "rid", "left").select("doc_id", "text", "ends").mapInArrow(_spans(least), f"doc_id long, text string, spans {SPANS}")


ENDS = "rid long, start int, end int, side int, room int, first_rid long, place int"
AROUND = "first_rid long, place int, side int, words binary"


def _ends(unit: int):
    """Both ends of each chain of units (side 0 and 1), and whole units (side 2).

    ``place`` is where the end stands in the first document; ``room`` how many words the chain may grow
    to the left: not into its own first place.
    """
    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rid, found in zip(batch.column("rid").to_pylist(), batch.column("units").to_pylist()):
                chain: list = []  # start, end, first_rid, back
                made = []
                for u in found:
                    if u["whole"]:
                        out.append((rid, u["at"], u["at"] + u["whole"], 2, 0, -1, -1))
                        continue
                    back = u["at"] - u["first_at"]
                    if chain and u["at"] <= chain[1] and chain[2:] == [u["first_rid"], back]:
                        chain[1] = u["at"] + unit
                    else:
                        chain = [u["at"], u["at"] + unit, u["first_rid"], back]
                        made.append(chain)
                for a, b, first_rid, back in made:
                    room = unit - 1 if first_rid != rid else min(unit - 1, max(0, back - (b - a)))
                    out += [(rid, a, b, 0, room, first_rid, a - back), (rid, a, b, 1, unit - 1, first_rid, b - back)]
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 ["rid", "start", "end", "side", "room", "first_rid", "place"])
    return chains


def _beside(hashes: np.ndarray, place: int, side: int, n: int) -> np.ndarray:
    """Hashes of up to ``n`` words before (side 0, nearest first) or from (side 1) a place."""
    return (hashes[max(0, place - n):place][::-1] if side == 0 else hashes[place:place + n]).astype(np.uint32)


def _around(unit: int):
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            out = []
            for rid, text, places in zip(*(batch.column(c).to_pylist() for c in ("rid", "text", "places"))):
                hashes = wordhash.word_hashes(text)
                out += [(rid, p["place"], p["side"], _beside(hashes, p["place"], p["side"], unit - 1).tobytes()) for p in places]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                                                 ["first_rid", "place", "side", "words"])
    return words


def _spans(least: int):
    """Chains extended as far as the words beside both places agree, merged and held against ``least``."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in common.slices(batches):
            spans = [[{"start": a, "end": b} for a, b in extended(text, ends, least)] if ends else []
                     for text, ends in zip(batch.column("text").to_pylist(), batch.column("ends").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(spans, kind)], ["doc_id", "text", "spans"])
    return merge


def extended(text: str, ends: list[dict], least: int) -> list[tuple[int, int]]:
    hashes = wordhash.word_hashes(text)
    sure, found = [], []
    for e in ends:
        a, b = e["start"], e["end"]
        if e["side"] == 2:
            sure.append((a, b))
            continue
        there = np.frombuffer(e["words"], np.uint32)[:e["room"]]
        here = _beside(hashes, a if e["side"] == 0 else b, e["side"], len(there))
        same = here == there[:len(here)]
        n = len(same) if same.all() else int(np.argmin(same))
        found.append((a - n, b) if e["side"] == 0 else (a, b + n))
    return _merged([(a, b) for a, b in _merged(found + sure) if b - a >= least] + sure)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def with_ids(docs: DataFrame) -> DataFrame:
    rows = common.identified(docs, ["doc_id", "text"], "rid", "dedup-input")
    return rows.select("rid", F.col("doc_id").cast("long").alias("doc_id"), "text")


def runs(at: list[int], unit: int, least: int) -> list[tuple[int, int]]:
    """Spans of ``least`` words or more that units at these sorted places cover without a gap."""
    out: list[list[int]] = []
    for a in at:
        if out and a <= out[-1][1]:
            out[-1][1] = a + unit
        else:
            out.append([a, a + unit])
    return [(a, b) for a, b in out if b - a >= least]


def character_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as code point offsets of the original text."""
    raw = wordhash.encoded(text)
    starts, ends = wordhash.word_bounds(raw)
    points = np.cumsum((raw & 0xC0) != 0x80) - 1
    return [(int(points[starts[a]]), int(points[ends[b - 1] - 1]) + 1) for a, b in spans]


def remove_repeats(docs: DataFrame, unit: int = UNIT, least: int = LEAST, within: bool = False, whole: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, text without the repeated passages, and ``removed``, their
    code point offsets in the original text (cases as in :func:`find_repeats`; null text stays null)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in common.slices(batches):
            texts, removed = [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                at = character_spans(text, [(s["start"], s["end"]) for s in spans]) if spans else []
                texts.append(without(text, at))
                removed.append([{"start": a, "end": b} for a, b in at])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(removed, kind)],
                                             ["doc_id", "text", "removed"])

    return find_repeats(docs, unit, least, within, whole).mapInArrow(cut, f"doc_id long, text string, removed {SPANS}")


def without(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return "".join([*out, text[at:]])
