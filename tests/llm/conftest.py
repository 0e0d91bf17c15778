from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Columns that clash with names the operators use inside.
CLASHING = ("rid", "row", "file", "row_no", "shard", "slot", "n_words", "hits", "items", "score", "lang_pred", "class",
            "class_id", "bucket", "digest", "tokens", "pass", "block", "votes", "good", "kept", "at", "_rid", "_tie", "_metadata")

LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(40_000))

EDGE_TEXTS = [
    None, "", " \n\t ", "one", "two words", "three little words", "a b c d e", "a b c d e", "a b c d e",
    "é" * 30, "\U0001F600 \U0001F600 x", "password = abcdefghijkl", LONG, LONG, "\x1c odd   spaces   here",
]


def edge_rows():
    rows = [(i if i not in (3, 7) else None, t, None if i % 4 == 0 else "en", None if i % 3 == 0 else f"s{i % 2}", None)
            for i, t in enumerate(EDGE_TEXTS)]
    return rows + [rows[4], rows[4], rows[12]]  # wholly equal rows


@pytest.fixture
def docs_of(spark):
    def make(rows, clash=False):
        rows = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
        df = spark.createDataFrame(rows, DOCS)
        if clash:
            from pyspark.sql import functions as F
            df = df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])
        return df
    return make


@pytest.fixture
def edge_docs(docs_of):
    return docs_of(edge_rows(), clash=True)


@pytest.fixture
def no_docs(docs_of):
    return docs_of([])


@pytest.fixture(scope="session")
def small(spark):
    return lambda name, sf="0.001": spark.read.parquet(f"/root/testdata/sf{sf}/{name}.parquet")
