"""Toxicity by a factorization machine over hashed terms.

A text's terms are its words (runs of letters, digits and other characters beyond ASCII, lower case) and the
first few bytes of longer words, hashed to ``buckets``. A term's value grows with its share of the text's
words, so a long text isn't judged by a word it has once. The machine adds a weight for each term and, for each
pair of terms in the text, the product of their values and the inner product of their factors:

    s = w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),   score = 1 / (1 + exp(-s))

So terms that are harmless alone can tell together (an insult beside the mention of a group), which weights
that only add up can't learn. It is fitted by mini-batches of labelled texts, a bounded sample of them where
there are more than ``most_rows``; every text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qoeflow.llm import common, wordhash


@dataclass(frozen=True)
class FmConfig:
    """``prefixes``: bytes of the word beginnings that are terms; ``sharp``: how fast a value grows with the
    term's share of the words; ``factors``: length of a term's factor vector; ``most_rows``: labelled texts to
    learn from (a sample by hash of about that many, where there are more). A term is learned where
    ``least_texts`` of these have it and its mean value differs between the labels by ``least_contrast``
    standard errors; the others would let a machine learn its texts by heart. ``toxic_weight``: what a missed
    toxic text costs against a clean one that is accused."""

    buckets: int = 1 << 18
    prefixes: tuple[int, ...] = (4, 5, 6)
    sharp: float = 600.0
    factors: int = 8
    most_rows: int = 20_000
    least_texts: int = 3
    toxic_weight: float = 3.0
    least_contrast: float = 4.0
    epochs: int = 5
    batch: int = 128
    rate: float = 0.02
    decay: float = 1e-4
    start: float = 0.05
    seed: int = 17
    folds: int = 5


def terms(text: str | None, cfg: FmConfig) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, value) of each different term of a text."""
    raw = wordhash.encoded((text or "").lower())
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = (raw >= 0x80) | ((raw >= 97) & (raw <= 122)) | ((raw >= 48) & (raw <= 57))
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0)
    size = ends - starts
    cuts = [(starts, ends)] + [(starts[size > k], starts[size > k] + k) for k in cfg.prefixes]
    hashes = [wordhash.span_hashes(raw, a, b) + np.uint64(i) for i, (a, b) in enumerate(cuts)]
    bucket = (wordhash.mix(np.concatenate(hashes)) % np.uint64(cfg.buckets)).astype(np.int64)
    bucket, times = np.unique(bucket, return_counts=True)
    return bucket, np.log1p(cfg.sharp * times / len(starts))


class Machine:
    """A fitted machine: rows of weights and factors, and the row of each bucket (-1: not learned)."""

    def __init__(self, row: np.ndarray, bias: float, weight: np.ndarray, factor: np.ndarray, cfg: FmConfig):
        self.row, self.bias, self.weight, self.factor, self.cfg = row, bias, weight, factor, cfg

    def sums(self, at: np.ndarray, x: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(s, sum_i v_i x_i) of n texts whose terms stand in rows ``at`` with values x."""
        add = lambda v: np.bincount(owner, weights=v, minlength=n)
        own = self.factor[at] * x[:, None]
        inner = np.stack([add(own[:, f]) for f in range(own.shape[1])], axis=1) if own.shape[1] else np.zeros((n, 0))
        pairs = 0.5 * ((inner ** 2).sum(axis=1) - add((own ** 2).sum(axis=1)))
        return self.bias + add(self.weight[at] * x) + pairs, inner

    def scores(self, texts: list[str | None]) -> np.ndarray:
        found = [terms(t, self.cfg) for t in texts]
        rows = [self.row[b] for b, _ in found]
        known = [r >= 0 for r in rows]
        owner = np.repeat(np.arange(len(texts)), [int(k.sum()) for k in known])
        at = np.concatenate([r[k] for r, k in zip(rows, known)] or [np.zeros(0, np.int64)])
        x = np.concatenate([v[k] for (_, v), k in zip(found, known)] or [np.zeros(0)])
        s, _ = self.sums(at, x, owner, len(texts))
        return 1 / (1 + np.exp(-np.clip(s, -40, 40)))


def telling(at: np.ndarray, x: np.ndarray, own: np.ndarray, label: np.ndarray, n: int) -> np.ndarray:
    """How far the mean value of each of n terms differs between the two labels, in standard errors."""
    ones = max(float(label.sum()), 1.0)
    zeros = max(len(label) - float(label.sum()), 1.0)
    add = lambda v: np.bincount(at, weights=v, minlength=n)
    p1, p0 = add(x * own) / ones, add(x * (1 - own)) / zeros
    v1, v0 = add(x * x * own) / ones - p1 ** 2, add(x * x * (1 - own)) / zeros - p0 ** 2
    spread = np.sqrt(np.maximum(v1, 0) / ones + np.maximum(v0, 0) / zeros + 1e-12)
    return np.abs(p1 - p0) / spread


def fit(texts: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, cfg: FmConfig) -> Machine:
    """The machine of texts given by their terms and their 0/1 labels: steps of mini-batches with a
    moving mean and variance of the gradient (Adam), from small random factors."""
    buckets, at, times = np.unique(np.concatenate([b for b, _ in texts] or [np.zeros(0, np.int64)]), return_inverse=True, return_counts=True)
    x = np.concatenate([v for _, v in texts] or [np.zeros(0)])
    owner = np.repeat(np.arange(len(texts)), [len(b) for b, _ in texts])
    often = telling(at, x, label[owner], label, len(buckets)) >= cfg.least_contrast
    often &= times >= cfg.least_texts
    number = np.where(often, np.cumsum(often) - 1, -1)
    row = np.full(cfg.buckets, -1, np.int64)
    row[buckets[often]] = np.arange(int(often.sum()))
    at = number[at]
    kept = at >= 0
    at, x, owner = at[kept], x[kept], owner[kept]
    begin = np.searchsorted(owner, np.arange(len(texts) + 1))
    rng = np.random.default_rng(cfg.seed)
    n, k = int(often.sum()), cfg.factors
    share = min(max(label.mean(), 1e-3), 1 - 1e-3) if len(label) else 0.5
    m = Machine(row, float(np.log(share / (1 - share))), np.zeros(n), rng.normal(0, cfg.start, (n, k)), cfg)
    params = np.concatenate([m.weight[:, None], m.factor], axis=1)  # one table: weight, then factors
    mean, var, step = np.zeros_like(params), np.zeros_like(params), 0
    for _ in range(cfg.epochs if n else 0):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), cfg.batch):
            group = order[a:a + cfg.batch]
            place = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in group])
            who = np.repeat(np.arange(len(group)), begin[group + 1] - begin[group])
            i, v = at[place], x[place]
            m.weight, m.factor = params[:, 0], params[:, 1:]
            s, inner = m.sums(i, v, who, len(group))
            error = (1 / (1 + np.exp(-np.clip(s, -40, 40))) - label[group]) * np.where(label[group] > 0, cfg.toxic_weight, 1.0) / len(group)
            pull = (error[who] * v)[:, None] * np.concatenate(
                [np.ones((len(v), 1)), inner[who] - m.factor[i] * v[:, None]], axis=1)
            used, spot = np.unique(i, return_inverse=True)
            grad = np.stack([np.bincount(spot, weights=pull[:, f], minlength=len(used)) for f in range(k + 1)], axis=1)
            # Only the rows of this batch move; the moving means of the others wait.
            step += 1
            mean[used] = 0.9 * mean[used] + 0.1 * grad
            var[used] = 0.999 * var[used] + 0.001 * grad ** 2
            rise = mean[used] / (1 - 0.9 ** step) / (np.sqrt(var[used] / (1 - 0.999 ** step)) + 1e-8)
            params[used] -= cfg.rate * (rise + cfg.decay * params[used])
            m.bias -= cfg.rate * float(error.sum())
    m.weight, m.factor = params[:, 0].copy(), params[:, 1:].copy()
    return m


def held_out(cfg: FmConfig = FmConfig()):
    """Documents that learning leaves aside: crc32 of the id as text divisible by ``folds`` (a null id: never)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % cfg.folds == 0, F.lit(False))


SAMPLE = "rid long, label int, buckets binary, x binary"
MODEL = "bucket int, params binary"


def learn(docs: DataFrame, labels: DataFrame, cfg: FmConfig = FmConfig()) -> Machine:
    """Fit the machine on the rows of ``docs`` (doc_id, text) whose doc_id has a label (``labels``: doc_id,
    toxic) and isn't held out.

    Ids and labels are joined without the texts; about ``most_rows`` of the labelled rows, chosen by a hash of
    the row, are broadcast to the scan, and their terms meet in one task. Where a doc_id has several labels the
    largest counts; null labels and null ids teach nothing; repeated rows teach as often as they come.
    """
    rows = common.identified(docs, ["doc_id", "text"], "rid", "toxic-input").withColumn("doc_id", F.col("doc_id").cast("long"))
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(cfg)).groupBy("doc_id").agg(F.max("label").alias("label")))
    named = common.stored(rows.select("rid", "doc_id").join(known, "doc_id").select("rid", "label"), "toxic-labelled")
    n = named.count()
    if n > cfg.most_rows:
        draw = F.pmod(F.xxhash64("rid", F.lit(cfg.seed)), F.lit(1 << 32)) < F.lit(int((1 << 32) * cfg.most_rows / n))
        named = named.where(draw)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, limit=1 << 20):
            found = [terms(t, cfg) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("label"), pa.array([b.astype(np.int32).tobytes() for b, _ in found], pa.binary()),
                 pa.array([x.astype(np.float32).tobytes() for _, x in found], pa.binary())], ["rid", "label", "buckets", "x"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((rid, y, b, x) for batch in batches for rid, y, b, x in zip(*(c.to_pylist() for c in batch.columns)))
        texts = [(np.frombuffer(b, np.int32).astype(np.int64), np.frombuffer(x, np.float32).astype(float)) for _, _, b, x in got]
        m = fit(texts, np.array([y for _, y, _, _ in got], float).clip(0, 1), cfg)
        learned = np.flatnonzero(m.row >= 0)
        table = np.concatenate([m.weight[:, None], m.factor], axis=1).astype(np.float32)[m.row[learned]]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(learned, -1).astype(np.int32)),
                                          pa.array([*(t.tobytes() for t in table), np.float32(m.bias).tobytes()], pa.binary())], ["bucket", "params"])

    # The bounded sample: its terms meet in one task, which writes the model, at most ``buckets`` rows.
    picked = rows.select("rid", "text").join(F.broadcast(named), "rid").select("rid", "label", "text")
    model = common.stored(picked.mapInArrow(extract, SAMPLE).repartition(1).mapInArrow(train, MODEL), "toxic-model")
    found = sorted((r["bucket"], r["params"]) for r in model.collect())
    if not found:  # an empty sample has no task with rows, and may have none at all
        return fit([], np.zeros(0), cfg)
    row, table = np.full(cfg.buckets, -1, np.int64), np.zeros((len(found) - 1, cfg.factors + 1))
    for i, (bucket, params) in enumerate(found[1:]):
        row[bucket], table[i] = i, np.frombuffer(params, np.float32)
    return Machine(row, float(np.frombuffer(found[0][1], np.float32)[0]), table[:, 0].copy(), table[:, 1:].copy(), cfg)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Cases: null, empty and wordless texts have no terms and get the score of the bias alone; a machine that
    learned nothing gives 0.5 to every text; terms that were never learned say nothing; equal texts have equal
    scores; an empty table gives an empty result; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(machine)  # buckets * (1 + factors) numbers at most

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for batch in common.slices(batches, limit=1 << 19):
            own = m.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(own),
                                              pa.array((own >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(machine.cfg).alias("held_out"), "text")
    return narrow.mapInArrow(rate, "doc_id long, held_out boolean, score double, predicted int")


def keep_civil(docs: DataFrame, machine: Machine, most: float = 0.5) -> DataFrame:
    """``docs``, all columns kept, without the rows whose text scores ``most`` or more."""
    rid = common.free_name(docs, "rid")
    rows = common.identified(docs, docs.columns, rid, "toxic-filter")
    civil = score(rows.select(F.col(rid).alias("doc_id"), "text"), machine).where(F.col("score") < most).select(F.col("doc_id").alias(rid))
    return rows.join(civil, rid).select(*[F.col(f"`{c}`") for c in docs.columns])
