from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from qoeflow.llm import middle_fill as m
from tests.llm.conftest import edge_rows

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_way(doc_id, text, cfg=m.FillConfig()):
    """The contract, read literally."""
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"{cfg.seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, mid, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= cfg.rate:
        return n, "plain", None, None, text
    if h4 % 100 < cfg.spm:
        return n, "spm", len(p), len(mid), f"<S>{s}<P>{p}<M>{mid}"
    return n, "psm", len(p), len(mid), f"<P>{p}<S>{s}<M>{mid}"


TEXTS = st.text(alphabet=st.sampled_from(list("ab <>PSM \t\n\x0b\x0c\r\x1c éß漢\U0001F600")), max_size=400)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_boundaries_are_the_contract_tokens(text):
    ends = np.cumsum([0] + [len(t) for t in TOKEN.findall(text)])
    assert m.boundaries(text).tolist() == ends.tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=600), st.integers(1, 126))
def test_index_is_exact_and_bounded(steps, error):
    offsets = np.cumsum(steps)
    index = m.RankIndex.of(offsets, error)
    ranks = np.arange(len(offsets))
    assert np.array_equal(index.offsets(ranks), offsets)
    assert np.abs(offsets - index.predict(ranks)).max() <= error + 1 and index.residual.dtype == np.int8


def test_a_line_is_one_segment_and_long_lists_are_few(spark):
    assert len(m.RankIndex.of(np.arange(0, 100_000, 7), 1).first) == 1
    steps = np.random.default_rng(3).integers(1, 12, 200_000)
    assert len(m.RankIndex.of(np.cumsum(steps), 120).first) < 400


def test_error_must_fit_a_byte():
    with pytest.raises(ValueError, match="126"):
        m.FillConfig(error=127)


MARKED = [(50, "has <P> inside"), (51, "ends with <S"), (52, "<M>"), (53, "a<"), (54, "< S> P> <"), (55, "x <S <S <P <M y " * 9)]


def test_rows_equal_the_plain_way(spark, edge_docs, docs_of):
    for docs, rows in ((edge_docs, [(i, t) for i, t, *_ in edge_rows()]), (docs_of(MARKED * 1), MARKED)):
        got = m.transform(docs).collect()
        have = sorted((str(r["doc_id"]), r["n"], r["form"], r["prefix_chars"] or -1, r["middle_chars"] or -1, r["output"]) for r in got)
        want = []
        for i, t in rows:
            n, form, a, b, out = plain_way(i, t)
            want.append((str(i), n, form, a or -1, b or -1, out))
        assert have == sorted(want)


def test_texts_come_back(spark, docs_of):
    docs = docs_of([(k * 1000 + i, t) for k in range(60) for i, t in MARKED] + [(i, t) for i, t, *_ in edge_rows()])
    cfg = m.FillConfig(rate=100)
    rows = m.transform(docs, cfg).withColumn("back", m.restored()).collect()
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    assert Counter((r["doc_id"], r["back"]) for r in rows) == Counter((r["doc_id"], r["text"] or "") for r in docs.collect())


def test_whole_documents(spark, small):
    want = {r["doc_id"]: r["text"] for r in small("documents").collect()}
    forms = []
    for r in m.digest_columns(m.transform(small("documents"))).collect():
        n, form, a, b, out = plain_way(r["doc_id"], want[r["doc_id"]])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, a, b)
        assert r["output_sha256"] == hashlib.sha256(out.encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256((want[r["doc_id"]] or "").encode()).hexdigest()
        forms.append(form)
    assert set(forms) == {"plain", "psm", "spm"}


def test_cuts_from_the_stored_index(spark, edge_docs, small):
    cfg = m.FillConfig(seed=7, rate=90, spm=50)
    for docs in (edge_docs, small("documents")):
        keys = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
        a = m.drawn(m.boundary_index(docs), cfg).select(*keys)
        b = m.transform(docs, cfg).select(*keys)
        assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_empty_table(no_docs):
    assert m.transform(no_docs).count() == 0 and m.drawn(m.boundary_index(no_docs)).count() == 0
