"""DuckDB SQL for the operators of this subpackage that SQL can express.

The others have none: the entropy windows (op1), byte shards (op2), content-defined units (op4), HTML trees
(op5), sampled paths (op7) and the language model (op9) are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from qoeflow.llm import common, quality
from qoeflow.llm.bond_mining import MineConfig
from qoeflow.llm.middle_fill import FillConfig
from qoeflow.llm.mixing import STEPS, MixConfig

DOC_ORDER = "row_number() OVER () AS rid"


def _crc32() -> str:
    """CRC-32 of the UTF-8 bytes, by the usual table of 256 (polynomial 0xEDB88320)."""
    return """
    crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
    bytes AS (SELECT rid, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b FROM doc),
    sums AS (SELECT rid, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, tab[1 + (xor(c, x) & 255)])), 4294967295) AS crc
             FROM bytes, crc)"""


def op3(shards: int = 16, seed: str = "shards-1") -> str:
    keys = common.feistel_keys(seed)
    p, m1, m2 = common.FEISTEL_P, common.FEISTEL_M1, common.FEISTEL_M2
    # One pass of the network over column x of a relation, as nested subqueries; k is half its bits.
    source = "SELECT *, x >> k AS l, x & ((1::BIGINT << k) - 1) AS r FROM ({0})"
    for key in keys:
        source = f"SELECT * EXCLUDE (u, v) REPLACE (r AS l, xor(l, xor(v, v >> 13) & ((1::BIGINT << k) - 1)) AS r) FROM (" \
                 f"SELECT *, (xor(u, u >> 15) * {m2}) % {p} AS v FROM (SELECT *, (r * {m1} + {key}) % {p} AS u FROM ({source})))"
    step = lambda rel: f"SELECT row_no, n, k, (l << k) | r AS x FROM ({source.format(rel)})"
    return f"""
    WITH RECURSIVE doc AS (SELECT {DOC_ORDER}, doc_id, coalesce(text, '') AS t FROM documents),{_crc32()},
    keyed AS (SELECT doc_id, octet_length(encode(t)) + 1 AS size, crc FROM doc JOIN sums USING (rid)),
    numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, crc) - 1 AS row_no, count(*) OVER () AS n FROM keyed),
    half AS (SELECT *, (SELECT min(i) FROM range(1, 32) r(i) WHERE 4::HUGEINT ** i >= (SELECT count(*) FROM documents))::INT AS k FROM numbered),
    walk AS (
        {step("SELECT row_no, n, k, row_no AS x FROM half")}
        UNION ALL {step("SELECT row_no, n, k, x FROM walk WHERE x >= n")})
    SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, (x % {shards})::INT AS shard, (x // {shards})::BIGINT AS slot,
           NULL::INT AS grown_shard, row_no::BIGINT AS row_no
    FROM numbered JOIN (SELECT row_no, x FROM walk WHERE x < n) USING (row_no)"""


def op6() -> str:
    votes = " || ".join(f"CASE WHEN {bad} THEN '0' WHEN {good} THEN '2' ELSE '1' END" for _, bad, good in quality.RULES)
    n, s = len(quality.RULES), quality.SMOOTH
    shares, rates = quality.first_guess()
    numbers = lambda xs: "[" + ", ".join(f"{x:.17g}::DOUBLE" for x in xs) + "]"
    k = range(1, len(shares) + 1)
    fit = "[" + ", ".join(f"share[{c}] + list_dot_product(q.v, rate[{c}])" for c in k) + "]"
    shifted = f"list_transform({fit}, lambda x: exp(x - list_max({fit})))"
    post = f"list_transform({shifted}, lambda x: x / list_sum({shifted}))"
    mass = lambda c: f"list_sum(list_transform(w, lambda x: x[{c}]))"
    rate = lambda c: (f"list_transform(range(1, {3 * n + 1}), lambda j: ln((list_sum(list_transform(range(1, len(p) + 1), "  # noqa: E731
                      f"lambda i: w[i][{c}] * p[i].v[j])) + {s}) / ({mass(c)} + {3 * s})))")
    return rf"""
    WITH RECURSIVE doc AS (SELECT {DOC_ORDER}, doc_id, coalesce(text, '') AS t FROM documents),
    cut AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                   list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM doc),
    windows AS (SELECT rid, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS g
                FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM cut)),
    often AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS k FROM windows) WHERE k > 1),
    covered AS (SELECT rid, count(DISTINCT place) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS place FROM often) GROUP BY rid),
    stats AS (SELECT rid, doc_id, len(w) AS n_words, list_sum(list_transform(list_append(w, ''), lambda x: length(x)))::BIGINT AS word_chars,
                     len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                     len(list_distinct(w)) AS n_distinct, len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper, len(regexp_extract_all(t, '[!?]')) AS n_marks,
                     len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&|<>]'))) AS n_symbol_words,
                     coalesce(n_repeat_words, 0) AS n_repeat_words FROM cut LEFT JOIN covered USING (rid)),
    voted AS (SELECT *, {votes} AS votes FROM stats),
    patterns AS (SELECT votes, count(*)::DOUBLE AS n, list_transform(range(0, {3 * n}), lambda j: CASE WHEN votes[1 + j // 3]::INT = j % 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS v
                 FROM voted GROUP BY votes),
    packed AS (SELECT list({{'votes': votes, 'n': n, 'v': v}} ORDER BY votes) AS p FROM patterns),
    em AS (
        SELECT 0 AS i, p, {numbers(shares)} AS share, [{", ".join(numbers(r) for r in rates)}] AS rate FROM packed
        UNION ALL
        SELECT i + 1, p, [{", ".join(f"ln({mass(c)} + {s})" for c in k)}], [{", ".join(rate(c) for c in k)}]
        FROM (SELECT *, list_transform(p, lambda q: list_transform({post}, lambda x: x * q.n)) AS w FROM em WHERE i < {quality.ROUNDS})),
    fitted AS (SELECT unnest(p) AS q, share, rate FROM em WHERE i = {quality.ROUNDS}),
    posterior AS (SELECT q.votes AS votes, ({post})[1] AS good FROM fitted)
    SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
           n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND good >= {quality.KEEP} AS kept, votes, round(good, 6) AS good
    FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM voted JOIN posterior USING (votes))"""


def op8(cfg: MixConfig = MixConfig()) -> str:
    hashed = "md5('{0}/{1}|' || {2} || '|' || coalesce(doc_id::VARCHAR, 'null'))".format
    low = f"power(most / least, 1 - {{0}}) > {cfg.max_passes!r}".format
    return rf"""
    WITH RECURSIVE doc AS (SELECT {DOC_ORDER}, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+'))::BIGINT AS tokens FROM documents),
    per AS (SELECT source, sum(tokens)::BIGINT AS total FROM doc GROUP BY source HAVING sum(tokens) > 0),
    ends AS (SELECT max(total)::DOUBLE AS most, min(total)::DOUBLE AS least FROM per),
    bisect AS (SELECT 0 AS i, 0::DOUBLE AS lo, 1::DOUBLE AS hi
               UNION ALL SELECT i + 1, CASE WHEN {low("(lo + hi) / 2")} THEN (lo + hi) / 2 ELSE lo END, CASE WHEN {low("(lo + hi) / 2")} THEN hi ELSE (lo + hi) / 2 END
               FROM bisect, ends WHERE i < {STEPS}),
    a AS (SELECT most, CASE WHEN {low("0")} THEN hi ELSE 0 END AS a FROM bisect, ends WHERE i = {STEPS}),
    plan AS (SELECT source, total, round(most * power(total / most, a))::BIGINT AS budget FROM per, a),
    blocks AS (SELECT greatest(ceil(sum(budget) / {cfg.block_tokens}), 1)::HUGEINT AS blocks FROM plan),
    taken AS (SELECT rid, doc_id, doc.source AS source, tokens, total, budget, unnest(range(ceil(budget / total)::BIGINT)) AS pass
              FROM doc JOIN plan ON doc.source IS NOT DISTINCT FROM plan.source WHERE tokens > 0),
    laid AS (SELECT *, sum(tokens) OVER (PARTITION BY source, pass ORDER BY {hashed(cfg.seed, "order", "pass")}, doc_id NULLS FIRST, tokens, rid
                                         ROWS UNBOUNDED PRECEDING) - tokens + pass * total AS begin_at FROM taken),
    placed AS (SELECT *, (begin_at::HUGEINT * blocks // budget)::BIGINT AS block FROM laid, blocks WHERE begin_at < budget)
    SELECT doc_id, source, pass::INT AS pass_no, block,
           row_number() OVER (PARTITION BY block ORDER BY {hashed(cfg.seed, "place", "pass")}, doc_id NULLS FIRST, source NULLS FIRST, pass, tokens, rid) - 1 AS position, tokens
    FROM placed
    UNION ALL SELECT doc_id, source, 0::INT, 0::BIGINT, NULL::BIGINT, tokens FROM doc WHERE tokens = 0"""


def op10(window: int = 13, coverage: int = 20) -> str:
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
    WITH doc AS (SELECT {DOC_ORDER}, doc_id, {words} AS w FROM documents),
    item AS (SELECT coalesce(item_id::VARCHAR, '') AS item, w, least({window}, len(w)) AS n FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0),
    need AS (SELECT DISTINCT item, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM item)),
    has AS (SELECT rid, i, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS g
            FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM item) WHERE len(w) >= n)),
    found AS (SELECT rid, i, n, item FROM has JOIN need USING (n, g)),
    hit AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS place FROM found) GROUP BY rid),
    items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {coverage} * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM doc LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)"""


def op11(cfg: MineConfig = MineConfig()) -> str:
    return f"""
    WITH e AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({cfg.scale} * x::DOUBLE)) AS v,
                      CASE WHEN vec_id % {cfg.relabel_every} = 0 THEN (label::BIGINT + 1) % {cfg.labels} ELSE label END AS label FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT a.rid AS anchor, a.vec_id AS anchor_id, b.vec_id AS id, b.rid AS rid, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
               FROM e a JOIN e b ON a.vec_id % {cfg.anchor_every} = 0 AND a.rid <> b.rid),
    positive AS (SELECT anchor, anchor_id, id AS positive_id, rid AS positive, score AS positive_score FROM scored WHERE same
                 QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id NULLS LAST, rid) <= {cfg.positives})
    SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor, positive ORDER BY score DESC, id NULLS LAST, rid)::INT AS rank,
           id AS negative_id, positive_score, score AS negative_score
    FROM positive p JOIN scored s ON p.anchor = s.anchor AND NOT same
         AND {cfg.low_percent} * positive_score <= 100 * score AND 100 * score <= {cfg.high_percent} * positive_score
    QUALIFY rank <= {cfg.negatives}"""


def op12(cfg: FillConfig = FillConfig()) -> str:
    h = lambda i: f"CAST('0x' || substr(sha, {8 * i + 1}, 8) AS BIGINT)"
    return rf"""
    WITH doc AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{cfg.seed}:' || coalesce(doc_id::VARCHAR, 'null')) AS sha FROM documents),
    cut AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens FROM doc),
    draw AS (SELECT *, len(tokens) AS n, {h(0)} AS h1, {h(1)} AS h2, {h(2)} AS h3, {h(3)} AS h4 FROM cut),
    form AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {cfg.rate} THEN 'plain'
                            WHEN h4 % 100 < {cfg.spm} THEN 'spm' ELSE 'psm' END AS form,
                    least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM draw),
    parts AS (SELECT *, array_to_string(tokens[1:a], '') AS p, array_to_string(tokens[a + 1:b], '') AS m, array_to_string(tokens[b + 1:], '') AS s FROM form)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM parts"""


def queries() -> dict[str, str]:
    return {"op3_feistel_shards": op3(), "op6_weak_supervision": op6(), "op8_temperature_mix": op8(), "op10_benchmark_automaton": op10(),
            "op11_bond_negatives": op11(), "op12_middle_fill": op12()}
