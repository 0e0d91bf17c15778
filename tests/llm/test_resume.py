"""A pipeline run that failed is taken up at the stage that failed."""

from __future__ import annotations

import pytest

from qoeflow.llm import pipeline


def test_a_failed_run_goes_on_from_its_last_whole_stage(spark, tmp_path, monkeypatch):
    ran, broken = [], [True]

    def stage(name, keep):
        def step(spark, docs, sf_dir):
            ran.append(name)
            if name == "second" and broken[0]:
                raise RuntimeError("an executor too few")
            return docs.where(keep)
        return name, step

    monkeypatch.setattr(pipeline, "STAGES", [stage("first", "doc_id % 2 = 0"), stage("second", "doc_id % 3 = 0"), stage("last", "true")])
    sf_dir = "/root/testdata/sf0.001"
    with pytest.raises(RuntimeError, match="executor"):
        pipeline.run(spark, sf_dir, f"{tmp_path}/run")
    broken[0] = False
    got = sorted(r["doc_id"] for r in pipeline.run(spark, sf_dir, f"{tmp_path}/run").collect())
    assert ran == ["first", "second", "second", "last"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got == sorted(r["doc_id"] for r in docs.where("doc_id % 6 = 0").collect())
    pipeline.run(spark, sf_dir).collect()  # a run without a folder does all of it
    assert ran[4:] == ["first", "second", "last"]
