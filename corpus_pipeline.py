"""A training corpus from ``documents``: the stages of ``qoeflow.llm.pipeline``, at the repository's top.

STAGES lists (name, function), each function taking (spark, docs, sf_dir) and returning a DataFrame; run(spark, sf_dir)
applies them. ORACLE_SQL is None: SQL can't express the language model, the similarity join or the byte shards.
"""

from qoeflow.llm.pipeline import (  # noqa: F401
    MIXTURE, ORACLE_SQL, STAGES, SUPPORT, benchmark_leaks, language, mixture, near_duplicates, run, tokens,
)
