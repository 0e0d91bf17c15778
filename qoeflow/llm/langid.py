"""Language identification: script ranges, character trigrams and Viterbi over words.

Training counts the character trigrams of each language's words (hashed to a fixed number of buckets,
so the model's size is languages * buckets, whatever the corpus) and the scripts its letters come from.
A word's script leaves only the languages written in it; the word's score for these is the sum of its
trigrams' log probabilities. Viterbi with a penalty for each switch labels every word, so texts of more
than one language come out as spans.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qoeflow.llm import common

#: Unicode blocks of scripts, by first code point (fixed values): everything up to the next entry belongs to it.
SCRIPTS = (
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0780, "Thaana"),
    (0x07C0, "Nko"), (0x0800, "Samaritan"), (0x0840, "Mandaic"), (0x0860, "Syriac"), (0x0870, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"),
    (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Cherokee"), (0x1400, "Aboriginal"),
    (0x1680, "Ogham"), (0x16A0, "Runic"), (0x1700, "other"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Aboriginal"), (0x1900, "other"), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "other"), (0x2C00, "Glagolitic"), (0x2C60, "Latin"), (0x2C80, "Coptic"), (0x2D00, "Georgian"), (0x2D30, "Tifinagh"), (0x2D80, "Ethiopic"),
    (0x2DE0, "Cyrillic"), (0x2E00, "other"), (0x3040, "Kana"), (0x3100, "Bopomofo"), (0x3130, "Hangul"), (0x3190, "other"), (0x31F0, "Kana"), (0x3200, "other"),
    (0x3400, "Han"), (0xA000, "Yi"), (0xA4D0, "Lisu"), (0xA500, "Vai"), (0xA640, "Cyrillic"), (0xA6A0, "other"), (0xA720, "Latin"), (0xA800, "other"),
    (0xA8E0, "Devanagari"), (0xA900, "other"), (0xAB00, "Ethiopic"), (0xAB30, "Latin"), (0xAB70, "Cherokee"), (0xABC0, "other"), (0xAC00, "Hangul"), (0xF900, "Han"),
    (0xFB00, "Latin"), (0xFB13, "Armenian"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "other"), (0xFE70, "Arabic"), (0xFF00, "other"), (0xFF21, "Latin"),
    (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "other"), (0x20000, "Han"),
)
NAMES = tuple(dict.fromkeys(name for _, name in SCRIPTS))
UNKNOWN = "und"


@dataclass(frozen=True)
class LangConfig:
    """``buckets``: trigram hashes; ``switch``: log penalty of a change of language between two words;
    ``script_share``: a language is written in the scripts that hold this share of its letters;
    ``rows``: texts that are labelled side by side."""

    buckets: int = 1 << 16
    switch: float = 8.0
    script_share: float = 0.02
    smooth: float = 0.5
    rows: int = 256


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point: the number of its script, -1 where it is no letter."""
    out = np.full(0x110000, -1, np.int8)
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    starts = np.array([a for a, _ in SCRIPTS])
    names = np.array([NAMES.index(n) for _, n in SCRIPTS], np.int8)
    at = np.flatnonzero(letter)
    out[at] = names[np.searchsorted(starts, at, side="right") - 1]
    return out


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


def features(code: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigram bucket of each letter, its script, first letter of each word as an index into these).

    A word is a run of letters of one script; a letter's trigram is itself with its neighbours, 0 where
    they are no letters.
    """
    script = _letters()[code]
    is_letter = script >= 0
    c = np.where(is_letter, code, 0).astype(np.uint64)
    padded = np.concatenate(([0], c, [0])).astype(np.uint64)
    with np.errstate(over="ignore"):
        h = (padded[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (c * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (padded[2:] * np.uint64(0x165667B19E3779F9))
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    at = np.flatnonzero(is_letter)
    bucket = ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)[at]
    own = script[at]
    begins = (np.diff(at) > 1) | (np.diff(own) != 0)
    first = np.flatnonzero(np.concatenate(([True], begins))) if len(at) else np.zeros(0, np.int64)
    return bucket, own, first


def train(labelled: DataFrame, cfg: LangConfig = LangConfig()) -> Model:
    """Fit the model on all rows of ``labelled`` (lang, text).

    Every task counts its own rows; counts, not texts, are shuffled, and the summed table (languages *
    buckets rows at most) comes to the driver. Rows whose lang or text is null teach nothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        size = cfg.buckets + len(NAMES)
        for batch in common.slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                bucket, script, _ = features(points(text), cfg.buckets)
                if len(bucket):
                    own = totals.setdefault(lang, np.zeros(size, np.int64))
                    slot, n = np.unique(bucket, return_counts=True)
                    own[slot] += n
                    own[cfg.buckets:] += np.bincount(script, minlength=len(NAMES))
        for lang, own in totals.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])],
                                             ["lang", "slot", "n"])

    counts = (labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
              .mapInArrow(count, "lang string, slot int, n long")
              .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas())
    return Model.fitted(counts, cfg)


class Model:
    """Languages, log probabilities [bucket, language] and which scripts each is written in."""

    def __init__(self, langs: list[str], scores: np.ndarray, written: np.ndarray, cfg: LangConfig):
        self.langs, self.scores, self.written, self.cfg = langs, scores, written, cfg

    @staticmethod
    def fitted(counts: pd.DataFrame, cfg: LangConfig) -> Model:
        langs = sorted(set(counts["lang"]))
        table = np.zeros((cfg.buckets + len(NAMES), len(langs)))
        table[counts["slot"].to_numpy(dtype=int), [langs.index(x) for x in counts["lang"]]] = counts["n"].to_numpy(dtype=float)
        grams, letters = table[: cfg.buckets] + cfg.smooth, table[cfg.buckets:]
        scores = np.log(grams / grams.sum(axis=0, keepdims=True)).astype(np.float32)
        written = letters >= cfg.script_share * np.maximum(letters.sum(axis=0, keepdims=True), 1)
        return Model(langs, scores, written, cfg)

    def word_scores(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score [word, language], letters of each word, those of words that a language is written in)."""
        bucket, script, first = features(points(text), self.cfg.buckets)
        if not len(first):
            return np.zeros((0, len(self.langs)), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        out = np.add.reduceat(self.scores[bucket], first, axis=0)
        size = np.diff(np.append(first, len(bucket)))
        fits = self.written[script[first]]
        if not fits.all():
            # Scripts narrow the candidates; a word no language is written in says nothing.
            none = ~fits.any(axis=1)
            out = np.where(fits, out, np.float32(-1e4) * size[:, None].astype(np.float32))
            out[none] = 0
        return out, size, np.where(fits.any(axis=1), size, 0)

    def labels(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(language of each word, letters of each word) of each text: Viterbi, many texts side by side."""
        return [(path, size) for path, size, _ in self.supported(texts)]

    def supported(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """As :meth:`labels`, with the letters that speak for a label: 0 for a word in a script of no language."""
        scored = [self.word_scores(t) for t in texts]
        if not self.langs:
            return [(np.zeros(len(size), np.int64), size, known) for _, size, known in scored]
        order = sorted(range(len(texts)), key=lambda i: -len(scored[i][1]))
        out: list = [None] * len(texts)
        for a in range(0, len(order), self.cfg.rows):
            group = [i for i in order[a:a + self.cfg.rows]]
            for i, path in zip(group, self._paths([scored[i][0] for i in group])):
                out[i] = (path, *scored[i][1:])
        return out

    def _paths(self, scored: list[np.ndarray]) -> list[np.ndarray]:
        """Best paths of score matrices that are sorted by length, longest first."""
        lengths = np.array([len(s) for s in scored])
        paths = [np.zeros(n, np.int64) for n in lengths]
        # Where every word agrees there is nothing to decide.
        best = [s.argmax(axis=1) if len(s) else None for s in scored]
        open_ = [i for i, b in enumerate(best) if b is not None and (b != b[0]).any()]
        for i, b in enumerate(best):
            if b is not None:
                paths[i][:] = b
        if not open_:
            return paths
        lengths = lengths[open_]
        n_langs, width = len(self.langs), int(lengths[0])
        begin = np.concatenate(([0], np.cumsum(lengths)))
        flat = np.concatenate([scored[i] for i in open_])
        came = np.zeros((len(flat), n_langs), np.int8 if n_langs < 128 else np.int32)
        at = begin[:-1]
        value = flat[at].astype(np.float64)
        own = np.arange(n_langs)
        live = len(open_)
        for step in range(1, width):
            while lengths[live - 1] <= step:
                live -= 1
            v = value[:live]
            top = v.argmax(axis=1)
            jump = v[np.arange(live), top] - self.cfg.switch
            stay = v >= jump[:, None]
            rows = at[:live] + step
            came[rows] = np.where(stay, own[None, :], top[:, None])
            value[:live] = np.where(stay, v, jump[:, None]) + flat[rows]
        last = value.argmax(axis=1)
        state = last.copy()
        flat_path = np.zeros(len(flat), np.int64)
        live = 0
        for step in range(width - 1, -1, -1):
            while live < len(open_) and lengths[live] > step:
                live += 1
            rows = at[:live] + step
            flat_path[rows] = state[:live]
            state[:live] = came[rows, state[:live]]
        for k, i in enumerate(open_):
            paths[i] = flat_path[begin[k]:begin[k + 1]]
        return paths


#: Bytes of text that are scored side by side (some 7 bytes of memory for each of them).
SLICE_BYTES = 6 << 20
OUT = "array<struct<lang:string,first:int,end:int>>"


def spans_of(path: np.ndarray, langs: list[str]) -> list[dict]:
    """Runs of words of one language: {lang, first, end} in word numbers."""
    if not len(path):
        return []
    cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
    return [{"lang": langs[path[a]], "first": a, "end": b} for a, b in zip(cuts, cuts[1:])]


def predict(docs: DataFrame, model: Model, support: float = 0.0) -> DataFrame:
    """``docs``, all columns kept, with lang_pred, score and lang_spans (free names are taken where
    ``docs`` has columns of these names: see :func:`predicted_names`).

    lang_pred is the language of most letters, score its share of the letters (0 where there are none),
    lang_spans the labelled runs of words. Only words in a script that a learned language is written in
    speak for a language; the letters of the others count against the score. Cases: a text that is null
    or has no letter, or with ``support`` has less than that share of its letters in such words, is ``und``
    with score 0 and no spans, and so is every text where nothing was learned; a text whose letters are
    all in scripts of no language has the first language with score 0 and no spans; of languages with
    equally many letters the first in alphabetical order counts; rows are independent of one another.
    """
    pred, score, spans = predicted_names(docs)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # languages * buckets * 4 bytes
    out = docs.select("*", F.lit(None).cast("string").alias(pred), F.lit(0.0).alias(score), F.lit(None).cast(OUT).alias(spans))
    text_at = docs.columns.index("text")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        kind = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("end", pa.int32())]))
        for batch in common.slices(batches, text_at, SLICE_BYTES):
            texts = [t or "" for t in batch.column(text_at).to_pylist()]
            preds, scores, found = [], [], []
            for path, size, known in m.supported(texts):
                if not size.sum() or not m.langs or known.sum() < support * size.sum():
                    preds.append(UNKNOWN)
                    scores.append(0.0)
                    found.append([])
                    continue
                per = np.bincount(path, weights=known, minlength=len(m.langs))
                best = int(per.argmax())
                preds.append(m.langs[best])
                scores.append(float(per[best] / size.sum()))
                found.append(spans_of(path, m.langs) if known.any() else [])
            columns = [*batch.columns[:-3], pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return out.mapInArrow(label, out.schema)


def predicted_names(docs: DataFrame) -> tuple[str, str, str]:
    return tuple(common.free_name(docs, n) for n in ("lang_pred", "score", "lang_spans"))


def held_out():
    """Documents that training leaves aside: crc32 of the id as text is 2 modulo 4 (a null id: never)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, cfg: LangConfig = LangConfig()) -> Model:
    return train(docs.where(~held_out()).select(F.col("lang").cast("string").alias("lang"), "text"), cfg)


def keep_identified(docs: DataFrame, cfg: LangConfig = LangConfig(), least: float = 0.0, support: float = 0.0) -> DataFrame:
    """``docs``, all columns kept, without the texts whose language can't be told (``und``: see ``support``
    of :func:`predict`), or whose score is under ``least``."""
    model = learn(docs, cfg)
    pred, score, _ = predicted_names(docs)
    return (predict(docs, model, support).where((F.col(pred) != UNKNOWN) & (F.col(score) >= least))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
