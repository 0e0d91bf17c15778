from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline as pipeline
from qoeflow.llm import common, token_shards
from tests.llm.test_chosen_path import classes_by_hand
from tests.llm.test_decontam import judge_by_hand, words_by_hand

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """(input rows, output rows) of each stage, each written before the next reads it."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for name, f in pipeline.STAGES:
        made = common.stored(f(spark, docs, SF), f"test-{name}")
        out.append((docs.collect(), made.collect(), made.columns))
        docs = made
    return out


def test_columns_of_documents_stay(stages):
    for _, _, columns in stages[:-1]:
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_keeps_what_has_letters(stages):
    before, after, _ = stages[0]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before if any(c.isalpha() for c in r["text"] or "")}


def test_one_document_of_each_group_stays(stages):
    before, after, _ = stages[1]
    classes, _ = classes_by_hand({r["doc_id"]: r["text"] for r in before})
    assert sorted(r["doc_id"] for r in after) == sorted(set(classes.values())) and len(after) < len(before)


def test_contaminated_documents_go(stages, small):
    before, after, _ = stages[2]
    items = {str(r["item_id"]): words_by_hand(r["text"]) for r in small("benchmark", "0.01").collect()}
    bad = set()
    for r in before:
        n, hit, _ = judge_by_hand(r["text"], items)
        if hit and 20 * hit >= n:
            bad.add(r["doc_id"])
    assert bad and {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - bad


def test_mixture_repeats_and_loses_nothing(stages):
    before, after, _ = stages[3]
    times = Counter(r["doc_id"] for r in after)
    assert set(times) == {r["doc_id"] for r in before} and set(times.values()) <= {1, 2} and len(after) > len(before)


def test_shards_hold_the_corpus(stages):
    before, after, _ = stages[4]
    got = Counter((r["doc_id"], r["seq"]) for r in after)
    want = Counter((r["doc_id"], i) for r in before for i in range(len(token_shards.sequences((r["text"] or "").encode(), token_shards.STRIDE))))
    assert got == want and sorted(r["slot"] for r in after) == list(range(len(after)))


def test_run_is_the_stages_in_a_row(spark, stages):
    got = Counter((r["doc_id"], r["seq"], r["record_crc32"]) for r in pipeline.run(spark, SF).collect())
    assert got == Counter((r["doc_id"], r["seq"], r["record_crc32"]) for r in stages[-1][1])
    assert pipeline.ORACLE_SQL is None
