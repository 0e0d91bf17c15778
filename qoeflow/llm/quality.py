"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good, bad or abstains. The distinct vote patterns (3 ** rules at most) are counted over
all documents, expectation-maximisation over these counts estimates how often each rule votes how among
good and among bad documents, and their shares, and a document is kept when its posterior probability
of being good is high enough.

Documents are bad in different ways, and rules that see one way agree on good about the others. So there is
a class of bad documents for each family of rules; the posterior of good is that of the one good class.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qoeflow.llm import common

#: Fixed values of the contract: what parts words, and the symbols that are counted.
SPACES = " \t\n\x0b\f\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Rules as (name, SQL for a bad vote, SQL for a good vote) over the columns of :func:`measured`.
RULES = (
    ("length", "n_words < 50", "n_words >= 100"),
    ("word_length", "word_chars > 12 * n_words OR word_chars < 3 * n_words", "word_chars BETWEEN 4 * n_words AND 8 * n_words"),
    ("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    ("symbol_words", "10 * n_symbol_words > n_words", "50 * n_symbol_words <= n_words"),
    ("line_repeats", "10 * n_dup_lines > 3 * n_lines", "10 * n_dup_lines <= n_lines"),
    ("word_repeats", "100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words <= 15 * n_words"),
    ("variety", "10 * n_distinct < 3 * n_words", "10 * n_distinct >= 5 * n_words"),
    ("capitals", "10 * n_upper > 3 * word_chars", "10 * n_upper <= word_chars"),
    ("shouting", "5 * n_marks > n_words", "20 * n_marks <= n_words"),
)
ROUNDS = 40
#: Families of rules, by name: each has its class of bad documents.
FAMILIES = (("symbols", "symbol_words"), ("line_repeats", "word_repeats", "variety"), ("capitals", "shouting"))
#: First guess: nine of ten documents are good, and the rules of a family see most of what is bad in its way.
PRIOR = 0.9
FIRST = {"own": (0.8, 0.1, 0.1), "other": (0.05, 0.15, 0.8)}
SMOOTH = 1.0
KEEP = 0.5


def _pairs(a: Column, b: Column, f) -> Column:
    return F.zip_with(a, b, f)


def _rest(a: Column, skip: int, size: Column) -> Column:
    """Array ``a`` of ``size`` without its first ``skip`` elements."""
    return F.slice(a, F.lit(skip + 1), F.greatest(size - skip, F.lit(0)))


def measured(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the contract's statistics and those the rules need.

    Null text is an empty one: all counts 0. Repeated three-word windows are found by sorting the text's
    own window hashes, so a text costs n log n inside its row and nothing is shuffled. Arrays are made
    in steps of their own, so that no step is evaluated once per element of another.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, WORD_BREAK), lambda w: w != "")
    a = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), words.alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.translate(x, SPACES, "") != "")
    b = a.select(
        "doc_id",
        F.length(F.translate("text", SPACES, "")).alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).alias("n_upper"),
        (F.length("text") - F.length(F.translate("text", "!?", ""))).alias("n_marks"),
        F.transform(lines, lambda x: F.struct(F.xxhash64(x), F.hash(x))).alias("lines"),
        F.size(F.filter("words", lambda w: F.translate(w, SYMBOLS, "") != w)).alias("n_symbol_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    n = F.size("h")
    windows = _pairs(F.slice(_pairs(F.col("h"), _rest(F.col("h"), 1, n), lambda x, y: F.xxhash64(x, y)), F.lit(1), F.greatest(n - 2, F.lit(0))),
                     _rest(F.col("h"), 2, n), lambda xy, z: F.xxhash64(xy, z))
    counts = ["doc_id", "word_chars", "n_symbols", "n_symbol_words", "n_upper", "n_marks"]
    c = b.select(*counts, n.alias("n_words"), F.size("lines").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
                 F.size(F.array_distinct("h")).alias("n_distinct"),
                 F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i")))).alias("w"))
    counts += ["n_words", "n_lines", "n_dup_lines", "n_distinct"]
    m = F.size("w")
    d = c.select(*counts, "w", _pairs(F.col("w"), _rest(F.col("w"), 1, m), lambda p, q: F.coalesce(p["x"] == q["x"], F.lit(False))).alias("same"))
    repeated = _pairs(F.col("same"), F.concat(F.array(F.lit(False)), F.slice("same", F.lit(1), F.greatest(F.size("same") - 1, F.lit(0)))),
                      lambda after, before: F.coalesce(after, F.lit(False)) | F.coalesce(before, F.lit(False)))
    places = F.sort_array(F.filter(_pairs(F.col("w"), repeated, lambda p, r: F.when(r, p["i"])), lambda i: i.isNotNull()))
    e = d.select(*counts, places.alias("at"))
    covered = F.aggregate(_pairs(F.col("at"), _rest(F.col("at"), 1, F.size("at")), lambda p, q: F.coalesce(F.least(q - p, F.lit(3)), F.lit(3))),
                          F.lit(0), lambda t, x: t + x)
    out = e.select(*counts, covered.alias("n_repeat_words"))
    return out.select("doc_id", *[F.col(x).cast("long").alias(x) for x in out.columns if x != "doc_id"])


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def with_votes(stats: DataFrame, rules=RULES) -> DataFrame:
    """``votes``: per rule 0 bad, 1 abstain, 2 good, as one string."""
    vote = [F.when(F.expr(bad), "0").when(F.expr(good), "2").otherwise("1") for _, bad, good in rules]
    return stats.withColumn("votes", F.concat(*vote))


def _numbers(values) -> str:
    return "array(" + ", ".join(f"{v:.17g}D" for v in values) + ")"


def first_guess(rules=RULES, families=FAMILIES) -> tuple[list[float], list[list[float]]]:
    """(log share, log vote rates) of the good class and of each family's class of bad documents."""
    shares = [PRIOR, *[(1 - PRIOR) / len(families)] * len(families)]
    rates = [[math.log(x) for name, _, _ in rules for x in FIRST["own" if name in family else "other"]] for family in ((), *families)]
    return [math.log(x) for x in shares], rates


def posteriors(voted: DataFrame, rules=RULES, families=FAMILIES, rounds: int = ROUNDS) -> DataFrame:
    """(votes, good): each pattern's posterior probability of a good document, by expectation-maximisation.

    The patterns are one bounded array, and the rounds one fold over it: state is, per class, the log of
    its share and, per rule and vote, the log of the vote's rate.
    """
    size = 3 * len(rules)
    counts = voted.groupBy("votes").agg(F.count(F.lit(1)).cast("double").alias("n"))
    one_hot = F.transform(F.sequence(F.lit(0), F.lit(size - 1)),
                          lambda j: F.when(F.substring("votes", (F.floor(j / 3) + 1).cast("int"), F.lit(1)).cast("int") == j % 3, 1.0).otherwise(0.0))
    patterns = counts.select("votes", "n", one_hot.alias("v"))
    gathered = patterns.groupBy().agg(F.sort_array(F.collect_list(F.struct("votes", "n", "v"))).alias("p"))
    shares, rates = first_guess(rules, families)
    zeros = "array(" + ", ".join([_numbers([0.0] * size)] * len(shares)) + ")"
    # Log of share times likelihood of a pattern q, per class; then the classes' posteriors.
    fit = "zip_with(s.share, s.rate, (a, r) -> a + aggregate(zip_with(q.v, r, (x, y) -> x * y), 0D, (t, x) -> t + x))"
    post = (f"element_at(transform(array({fit}), l -> element_at(transform(array(transform(l, x -> exp(x - array_max(l)))), "
            "e -> transform(e, x -> x / aggregate(e, 0D, (t, y) -> t + y))), 1)), 1)")
    step = f"""aggregate(transform(p, q -> named_struct('v', q.v, 'w', transform({post}, x -> x * q.n))),
        named_struct('g', {zeros}, 'm', {_numbers([0.0] * len(shares))}),
        (a, q) -> named_struct('g', zip_with(a.g, q.w, (row, w) -> zip_with(row, q.v, (x, y) -> x + y * w)), 'm', zip_with(a.m, q.w, (x, w) -> x + w)),
        a -> named_struct('share', transform(a.m, x -> ln(x + {SMOOTH}D)),
                          'rate', zip_with(a.g, a.m, (row, m) -> transform(row, x -> ln((x + {SMOOTH}D) / (m + {3 * SMOOTH}D))))))"""
    start = f"named_struct('share', {_numbers(shares)}, 'rate', array({', '.join(_numbers(r) for r in rates)}))"
    fitted = gathered.select("p", F.expr(f"aggregate(sequence(1, {rounds}), {start}, (s, i) -> {step})").alias("s"))
    return (fitted.select("s", F.explode("p").alias("q"))
            .select(F.col("q.votes").alias("votes"), F.element_at(F.expr(post), 1).alias("good")))


def judge(docs: DataFrame, rules=RULES, keep: float = KEEP) -> DataFrame:
    """One row per row of ``docs``: doc_id, the statistics, base_failed, good (posterior) and kept.

    Texts are measured once; the narrow table of counts is stored and read for both steps. Cases: null
    and empty texts have no words and fail the base rule; repeated rows count and are judged each; an
    empty table gives an empty result; other columns are not read.
    """
    stats = common.stored(with_votes(measured(docs), rules), "quality-stats")
    table = posteriors(stats, rules)
    # One row per pattern: 3 ** rules at most.
    return (stats.join(F.broadcast(table), "votes")
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("good") >= keep)))
