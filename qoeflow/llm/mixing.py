"""Temperature mixing of sources to target weights, in DataFrame functions only.

Source i with a share s_i of all tokens gets the weight s_i ** a / sum(s ** a). The exponent a is found by
bisection between 0 (all sources alike) and 1 (as they are): the smallest a whose most repeated source
stays within a limit of passes, or the one whose weights have a wanted entropy. The weights are realised
exactly: each source has a token budget, passes over its documents are permutations of them laid end to
end until the budget is spent, and all sources' budgets are cut to the same number of blocks, so that
every block has the target weights; inside a block a keyed permutation mixes the sources.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qoeflow.llm import common

#: Fixed value: a word, the token that is counted here.
WORD = r"[^ \t\n\x0B\f\r]+"


@dataclass(frozen=True)
class MixConfig:
    """``max_passes``: the repetition limit; or ``entropy`` (nats), which then sets the exponent.
    ``budget``: tokens in all; None: the least at which each source is read once in full at least, so
    that no document is lost. ``block_tokens``: tokens of a block. ``slice_docs``: documents that one
    task orders at a time."""

    max_passes: float = 2.0
    entropy: float | None = None
    budget: int | None = None
    block_tokens: int = 200_000
    slice_docs: int = 1000
    most_slices: int = 65_536
    salts: int = 32
    seed: str = "mix-1"


STEPS = 60


def exponent_sql(cfg: MixConfig) -> str:
    """SQL for the exponent, over ``t``: the array of the sources' token counts (doubles, above 0)."""
    total = "aggregate(transform(t, x -> pow(x / array_max(t), m)), 0D, (u, x) -> u + x)"
    if cfg.entropy is not None:
        # Entropy falls as the exponent rises.
        p = f"pow(x / array_max(t), m) / {total}"
        low = f"aggregate(transform(t, x -> -({p}) * ln({p})), 0D, (u, x) -> u + x) >= {cfg.entropy!r}D"
    elif cfg.budget is not None:
        # The smallest source is the most repeated one; its passes fall as the exponent rises.
        low = f"{float(cfg.budget)!r}D * pow(array_min(t) / array_max(t), m) / {total} / array_min(t) > {cfg.max_passes!r}D"
    else:
        low = f"pow(array_max(t) / array_min(t), 1D - m) > {cfg.max_passes!r}D"
    bisect = (f"aggregate(sequence(1, {STEPS}), named_struct('lo', 0D, 'hi', 1D), (s, i) -> "
              f"element_at(transform(array((s.lo + s.hi) / 2D), m -> if({low}, named_struct('lo', m, 'hi', s.hi), named_struct('lo', s.lo, 'hi', m))), 1), s -> s.hi)")
    return f"element_at(transform(array(0D), m -> if({low}, {bisect}, 0D)), 1)"


def counted(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, source, tokens) of each row."""
    return _counted(common.identified(docs, ["doc_id", "source", "text"], "rid", "mix-input"), "rid")


def _counted(docs: DataFrame, rid: str) -> DataFrame:
    return docs.select(F.col(rid).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "source",
                       F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("tokens"))


def weights(rows: DataFrame, cfg: MixConfig) -> DataFrame:
    """A row per source: tokens, docs, weight, budget (tokens to take), passes begun."""
    per = rows.groupBy("source").agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("docs"))
    whole = per.where("total > 0").groupBy().agg(F.sort_array(F.collect_list(F.col("total").cast("double"))).alias("t"))
    scale = (f"CAST({cfg.budget} AS DOUBLE) / norm" if cfg.budget is not None else "array_max(t)")
    found = (whole.where("size(t) > 0").select("t", F.expr(exponent_sql(cfg)).alias("a"))
             .select("t", "a", F.expr("aggregate(transform(t, x -> pow(x / array_max(t), a)), 0D, (u, x) -> u + x)").alias("norm"))
             .select("a", "norm", F.expr("array_max(t)").alias("most"), F.expr(scale).alias("scale")).first())
    a, norm, most, scale = found or (1.0, 1.0, 1.0, 0.0)
    raised = F.pow(F.col("total") / F.lit(most), F.lit(a))
    budget = F.round(F.lit(scale) * raised).cast("long")
    return per.where("total > 0").select(
        "source", "total", "docs", (raised / F.lit(norm)).alias("weight"), budget.alias("budget"),
        F.ceil(budget / F.col("total")).cast("int").alias("passes"))


def _hash(what: str, cfg: MixConfig):
    return F.md5(F.concat_ws("|", F.lit(f"{cfg.seed}/{what}"), F.col("pass").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def mix(docs: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """A row per document and pass of the mixture: rid, doc_id, source, pass, block, position, tokens.

    The documents of a pass are ordered by a keyed hash, in slices of bounded size whose totals are
    summed first, so a source of any share of the data is ordered by many tasks. Cases: a null source is
    a source; documents without words (null, empty texts) cost no tokens and come once, in the first
    block; equal rows are documents of their own; a null doc_id takes the place of the word null in the
    hash; an empty table gives an empty mixture; other columns are not read.
    """
    return _mix(common.stored(counted(docs), "mix-counts"), cfg)


def _mix(rows: DataFrame, cfg: MixConfig) -> DataFrame:
    plan = common.stored(weights(rows, cfg), "mix-weights")
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    slices = F.least(F.ceil(F.col("docs") / cfg.slice_docs), F.lit(cfg.most_slices)).cast("long")
    # The plan has a row per source; salts spread a source that holds a third of all rows.
    side = plan.select(source.alias("key"), "total", "budget", "passes", slices.alias("slices"),
                       F.explode(F.sequence(F.lit(0), F.lit(cfg.salts - 1))).alias("salt"))
    salted = rows.where("tokens > 0").select("*", source.alias("key"), F.pmod(F.xxhash64("rid"), F.lit(cfg.salts)).cast("int").alias("salt"))
    taken = (salted.join(side, ["key", "salt"])
             .withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
             .withColumn("order", _hash("order", cfg))
             .withColumn("slice", F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("double") / 4294967296.0 * F.col("slices")).cast("long"))
             .select("rid", "doc_id", "source", "key", "tokens", "total", "budget", "pass", "order", "slice"))
    blocks = -(-(plan.agg(F.sum("budget")).first()[0] or 0) // cfg.block_tokens) or 1
    sums = taken.groupBy("key", "pass", "slice").agg(F.sum("tokens").alias("sum"))
    begins = sums.select("key", "pass", "slice", F.expr(
        "sum(sum) OVER (PARTITION BY key, pass ORDER BY slice ROWS UNBOUNDED PRECEDING) - sum").alias("begin"))
    inside = F.expr("sum(tokens) OVER (PARTITION BY key, pass, slice ORDER BY order, doc_id, tokens, rid ROWS UNBOUNDED PRECEDING) - tokens")
    laid = (taken.withColumn("inside", inside).join(begins, ["key", "pass", "slice"])
            .withColumn("at", F.col("begin") + F.col("inside") + F.col("pass") * F.col("total")).where("at < budget"))
    placed = (laid.withColumn("block", F.expr(f"CAST(CAST(at AS DECIMAL(20,0)) * {blocks}BD div budget AS LONG)"))
              .select("rid", "doc_id", "source", "pass", "block", "tokens"))
    wordless = rows.where("tokens = 0").select("rid", "doc_id", "source", F.lit(0).alias("pass"), F.lit(0).cast("long").alias("block"), "tokens")
    return placed.unionByName(wordless)


def with_positions(mixture: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """``position``: the place of each document in its block's permutation (blocks are of bounded size,
    but for documents without words, which all come after the others of the first block)."""
    position = F.expr("row_number() OVER (PARTITION BY block ORDER BY place, doc_id, source, pass, tokens, rid) - 1")
    some = mixture.where("tokens > 0").withColumn("place", _hash("place", cfg)).withColumn("position", position.cast("long")).drop("place")
    none = mixture.where("tokens = 0").withColumn("position", F.lit(None).cast("long"))
    return some.unionByName(none)


def mixed_documents(docs: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """``docs``, all columns kept, each row as often as the mixture has it."""
    rid = common.free_name(docs, "rid")
    rows = common.identified(docs, docs.columns, rid, "mix-input")
    times = _mix(common.stored(_counted(rows, rid), "mix-counts"), cfg).select(F.col("rid").alias(rid))
    return rows.join(times, rid).select(*[F.col(f"`{c}`") for c in docs.columns])
