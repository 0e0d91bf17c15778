"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The automaton accepts every word sequence that occurs in some item. Training words stream through it:
after each word it knows the length of the longest sequence ending there that some item contains, at a
constant cost per word on average. Where that length reaches the window (or the whole of an item that
is shorter than a window), the words of the match are hit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qoeflow.llm import common

#: Fixed value of the contract: words of ASCII-lower-cased text, as UTF-8 bytes.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 13

#: Most item words in one automaton (some 300 bytes a word in a worker). More items take further passes.
BLOCK_WORDS = 200_000


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "replace").lower())


class SuffixAutomaton:
    """Generalised suffix automaton over item word sequences; states are integers, 0 is the root.

    ``items_at(state)`` is known for the states that matter: those that hold a window, and those that
    hold the whole of a short item.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        self.ids: dict[bytes, int] = {}
        kept = [(item, [self.ids.setdefault(w, len(self.ids)) for w in ws]) for item, ws in items if ws]
        for _, ws in kept:
            last = 0
            for w in ws:
                last = self._extend(last, w)
        self.hits: dict[int, dict[int, set[str]]] = {}
        for item, ws in kept:
            state = 0
            for i, w in enumerate(ws):
                state = self.next[state][w]
                need = window if len(ws) >= window else len(ws)
                if i + 1 < need:
                    continue
                while self.length[self.link[state]] >= need:
                    state = self.link[state]
                found = self.hits.setdefault(state, {})
                found.setdefault(need, set()).add(item)
        #: The next state up the suffix links, itself included, that has hits.
        self.above = [-1] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.above[s] = s if s in self.hits else self.above[self.link[s]]

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new = self._state(self.length[last] + 1, {})
        p = last
        while p != -1 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p == -1:
            self.link[new] = 0
        else:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def _state(self, length: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[copy] = self.link[q]
        self.link[q] = copy
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def stream(self, text_words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans [a, b) of hit words, and the items with occurring windows."""
        spans: list[list[int]] = []
        items: set[str] = set()
        ids, edges, link, length, above, hits = self.ids, self.next, self.link, self.length, self.above, self.hits
        state, matched = 0, 0
        for i, word in enumerate(text_words):
            w = ids.get(word)
            if w is None:
                state = matched = 0
                continue
            while state and w not in edges[state]:
                state = link[state]
                matched = length[state]
            state = edges[state].get(w, 0)
            matched = matched + 1 if state else 0
            s = above[state]
            longest = 0
            while s > 0:
                for need, found in hits[s].items():
                    if need <= matched:
                        longest = max(longest, need)
                        items |= found
                s = above[link[s]]
            if longest:
                a = i + 1 - longest
                while spans and a <= spans[-1][1]:
                    a = min(a, spans.pop()[0])
                spans.append([a, i + 1])
        return [(a, b) for a, b in spans], items


def pieces(ws: list[bytes], most: int, window: int) -> Iterator[list[bytes]]:
    """The words of an item in pieces of some ``most`` words that overlap by a window less one word, so that every
    window is inside one of them; an item of fewer words is one piece, so short items stay whole."""
    step = max(most, window)
    for a in range(0, max(1, len(ws) - window + 1), step):
        yield ws[a:a + step + window - 1]


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS, window: int = WINDOW) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items with words, in blocks of bounded size (longer items in pieces), one at a time on the driver."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("i"), "text").where("text IS NOT NULL").toLocalIterator():
        ws = words(row["text"])
        for piece in pieces(ws, block_words, window) if ws else ():
            block.append((row["i"] if row["i"] is not None else "", piece))
            size += len(piece)
            if size >= block_words:
                yield block
                block, size = [], 0
    if block:
        yield block


MATCHES = "array<struct<start:int,end:int>>"


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, ``hits`` (merged spans of hit word numbers) and
    ``items`` (sorted item ids, as strings, with occurring windows).

    Each block of items is one automaton of bounded size, broadcast to the tasks; documents pass through
    one automaton after the other within one stage, so nothing is shuffled and no pair is formed.
    Cases: null or wordless texts have no words, hits or items; null or wordless items never match;
    equal items all count; a null item id counts as an empty string; an empty benchmark matches nothing;
    columns besides doc_id and text are not read.
    """
    inside = Names(docs.select("doc_id", "text"))
    out = _matched(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"), inside, benchmark, window, block_words)
    return out.select("doc_id", F.col(inside.n_words).cast("long").alias("n_words"),
                      F.col(inside.hits).alias("hits"), F.col(inside.items).alias("items"))


class Names:
    """Names for the columns that carry the matches from pass to pass, free in ``docs``."""

    def __init__(self, docs: DataFrame):
        self.n_words, self.hits, self.items = (common.free_name(docs, x) for x in ("n_words", "hits", "items"))


def _matched(docs: DataFrame, inside: Names, benchmark: DataFrame, window: int, block_words: int) -> DataFrame:
    """``docs`` with the matches of every block of items, one pass of bounded memory for each block."""
    spark = docs.sparkSession
    out = docs.select("*", F.lit(0).alias(inside.n_words), F.lit(None).cast(MATCHES).alias(inside.hits),
                      F.lit(None).cast("array<string>").alias(inside.items))
    passes = 0
    for block in item_blocks(benchmark, block_words, window):
        out = out.mapInArrow(_matcher(spark.sparkContext.broadcast(SuffixAutomaton(block, window)), inside), out.schema)
        passes += 1
    if not passes:  # no item has a word: one pass still counts the words
        out = out.mapInArrow(_matcher(spark.sparkContext.broadcast(SuffixAutomaton([], window)), inside), out.schema)
    return out


def _matcher(shipped, inside: Names):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shipped.value
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in common.slices(batches):
            n, hits, items = [], [], []
            for text, old, old_items in zip(batch.column("text").to_pylist(), batch.column(inside.hits).to_pylist(),
                                            batch.column(inside.items).to_pylist()):
                ws = words(text)
                spans, found = automaton.stream(ws)
                if old:
                    spans = merged([(s["start"], s["end"]) for s in old] + spans)
                n.append(len(ws))
                hits.append([{"start": a, "end": b} for a, b in spans])
                items.append(sorted(found | set(old_items or [])))
            new = {inside.n_words: pa.array(n, pa.int32()), inside.hits: pa.array(hits, kind),
                   inside.items: pa.array(items, pa.list_(pa.string()))}
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(i)) for i, c in enumerate(names)], names)
    return match


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def judged(matches: DataFrame, coverage: int = 20) -> DataFrame:
    """The contract's columns: a document is contaminated when hit words are 1/``coverage`` of it or more."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"])
    return matches.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * coverage >= F.col("n_words"))).alias("contaminated"))


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """``text`` without the words of ``spans`` and what stands between them (for span removal)."""
    if not text or not spans:
        return text
    raw = text.encode("utf-8", "replace")
    at = [m.span() for m in WORD.finditer(raw.lower())]
    out, done = [], 0
    for a, b in spans:
        out.append(raw[done:at[a][0]])
        done = at[b - 1][1]
    return b"".join([*out, raw[done:]]).decode("utf-8")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: int = 20, spans_only: bool = False) -> DataFrame:
    """``docs``, all columns kept, without contaminated documents.

    With ``spans_only`` contaminated documents stay and lose the hit spans from their text instead.
    Documents under the coverage limit stay as they are. Other columns (also ones with the names this
    module uses inside) pass through untouched.
    """
    names, inside = docs.columns, Names(docs)
    found = _matched(docs, inside, benchmark, window, BLOCK_WORDS)
    n_hit = F.aggregate(inside.hits, F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"])
    bad = (n_hit > 0) & (n_hit * coverage >= F.col(inside.n_words))
    if not spans_only:
        return found.where(~bad).select(*[F.col(f"`{c}`") for c in names])

    @F.udf("string")
    def cut(text, spans):
        return without_spans(text, [(s["start"], s["end"]) for s in spans])

    text = F.when(bad, cut("text", inside.hits)).otherwise(F.col("text"))
    return found.withColumn("text", text).select(*[F.col(f"`{c}`") for c in names])


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
