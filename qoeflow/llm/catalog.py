"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from qoeflow.llm import (
    bond_mining, chosen_path, common, decontam, langid, main_text, middle_fill, mixing, passage_dedup, pipeline, quality, secret_scan, sharding, token_shards,
    toxicity,
)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark, sf_dir):
    return secret_scan.digest_columns(secret_scan.scan_documents(_table(spark, sf_dir, "documents")))


def op2_token_shards(spark, sf_dir):
    """Writes the shards to the shared folder; a row per sequence says where it lies."""
    return token_shards.materialise(_table(spark, sf_dir, "documents"), common.fresh_path(spark, "token-shards"))


def op3_feistel_shards(spark, sf_dir):
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op4_passage_dedup(spark, sf_dir):
    """Per document: the text that stays and the code point spans that went."""
    cut = passage_dedup.remove_repeats(_table(spark, sf_dir, "documents"), within=True, whole=True)
    return cut.select("doc_id", F.size("removed").alias("n_removed"),
                      F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
                      .alias("removed"), "text")


def op5_main_text(spark, sf_dir):
    return main_text.extract(_table(spark, sf_dir, "pages"))


def op6_weak_supervision(spark, sf_dir):
    return quality.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", *quality.STATS, "base_failed", "kept", "votes", F.round("good", 6).alias("good"))


def op7_chosen_path(spark, sf_dir):
    return chosen_path.link_documents(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op8_temperature_mix(spark, sf_dir):
    mixture = mixing.with_positions(mixing.mix(_table(spark, sf_dir, "documents")))
    return mixture.select("doc_id", "source", F.col("pass").alias("pass_no"), "block", "position", "tokens")


def op9_language_spans(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs.select("doc_id", "text"), langid.learn(docs)).select(
        F.col("doc_id").cast("long").alias("doc_id"), langid.held_out().alias("held_out"), "lang_pred", "score",
        F.size("lang_spans").alias("n_spans"))


def op10_benchmark_automaton(spark, sf_dir):
    return decontam.judged(decontam.find_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op11_bond_negatives(spark, sf_dir):
    return bond_mining.mine(_table(spark, sf_dir, "embeddings"))


def op12_middle_fill(spark, sf_dir):
    return middle_fill.digest_columns(middle_fill.transform(_table(spark, sf_dir, "documents"))).drop("n_segments")


def op13_factor_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


def registry():
    named = (op1_secret_scan, op2_token_shards, op3_feistel_shards, op4_passage_dedup, op5_main_text, op6_weak_supervision,
             op7_chosen_path, op8_temperature_mix, op9_language_spans, op10_benchmark_automaton, op11_bond_negatives,
             op12_middle_fill,
             op13_factor_toxicity)
    return {**{f.__name__: f for f in named}, "pipeline": pipeline.run}
