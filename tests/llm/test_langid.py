from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline as pipeline
from qoeflow.llm import catalog, langid as g
from tests.llm.conftest import edge_rows


@pytest.fixture(scope="module")
def model(spark, small):
    return g.learn(small("documents", "0.01"))


def viterbi_by_hand(scores, switch):
    """Best path by trying every language before every word."""
    n, k = scores.shape
    value, back = scores[0].astype(float), []
    for t in range(1, n):
        options = value[None, :] - switch * (1 - np.eye(k))
        came = options.argmax(axis=1)
        # On a tie staying wins.
        stay = options[np.arange(k), np.arange(k)] >= options.max(axis=1)
        came = np.where(stay, np.arange(k), came)
        back.append(came)
        value = options[np.arange(k), came] + scores[t]
    path = [int(value.argmax())]
    for came in reversed(back):
        path.append(int(came[path[-1]]))
    return path[::-1]


def test_viterbi_matches_plain_dynamic_programming():
    rng = np.random.default_rng(2)
    model = g.Model(["a", "b", "c"], np.zeros((1, 3)), np.ones((1, 3), bool), g.LangConfig(switch=2.0, rows=7))
    scored = sorted((rng.normal(0, 2, (n, 3)).astype(np.float32) for n in rng.integers(0, 40, 50)), key=len, reverse=True)
    paths = model._paths(scored)
    for s, p in zip(scored, paths):
        assert p.tolist() == (viterbi_by_hand(s, 2.0) if len(s) else [])


def test_held_out_accuracy(spark, small):
    rows = {r["doc_id"]: r for r in catalog.op9_language_spans(spark, "/root/testdata/sf0.01").collect()}
    docs = small("documents", "0.01").collect()
    right = []
    for d in docs:
        r = rows[d["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        if r["held_out"] and len(d["text"]) > 200:
            right.append(r["lang_pred"] == d["lang"])
    assert len(right) > 100 and np.mean(right) > 0.97


def test_mixed_text_is_cut_to_spans(spark, small, model):
    by = {}
    for r in small("documents", "0.01").where("n_chars BETWEEN 1000 AND 3000").collect():
        by.setdefault(r["lang"], r["text"])
    text = " ".join(by[x] for x in ("en", "de", "fr"))
    (path, size), = model.labels([text])
    spans = g.spans_of(path, model.langs)
    main = [s["lang"] for s in spans if s["end"] - s["first"] > 60]
    assert main == ["en", "de", "fr"] and size.sum() == sum(c.isalpha() for c in text.lower())


def test_scripts_narrow_candidates():
    def counts(lang, text):
        cfg = g.LangConfig()
        bucket, script, _ = g.features(g.points(text), cfg.buckets)
        out = Counter(bucket.tolist()) + Counter((cfg.buckets + script.astype(int)).tolist())
        return [(lang, k, n) for k, n in out.items()]
    table = pd.DataFrame(counts("ru", "привет мир это просто слова") + counts("en", "hello world these are words"), columns=["lang", "slot", "n"])
    model = g.Model.fitted(table, g.LangConfig())
    (path, _), = model.labels(["hello неведомые these"])
    assert [model.langs[i] for i in path] == ["en", "ru", "en"]
    (path, _), = model.labels(["漢字"])  # a script that nothing was learned in leaves all candidates
    assert len(path) == 1


def test_labels_are_learned_from_the_training_part_alone(spark, docs_of):
    ids = range(400)
    aside = [i for i in ids if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "aaa bbb", "x" if i not in aside else "never") for i in ids] + [(None, "aaa", None)]
    assert g.learn(docs_of(rows)).langs == ["x"]


def test_edge_rows(edge_docs, no_docs, docs_of):
    model = g.learn(edge_docs)
    pred, score, spans = g.predicted_names(edge_docs)
    out = g.predict(edge_docs, model)
    assert out.columns == [*edge_docs.columns, pred, score, spans]
    rows = out.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, *_ in edge_rows())
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r[pred], r[score], bool(r[spans])) == (("en", 1.0, True) if letters else ("und", 0.0, False))
    assert g.keep_identified(edge_docs).columns == edge_docs.columns
    assert g.keep_identified(edge_docs).count() == sum(any(c.isalpha() for c in t or "") for _, t, *_ in edge_rows())
    assert g.predict(no_docs, g.learn(no_docs)).count() == 0
    nothing = g.learn(docs_of([(1, "words", None)]))
    assert g.predict(docs_of([(1, "words", None)]), nothing).first()["lang_pred"] == "und"


def test_a_script_that_no_language_is_written_in_is_no_evidence(docs_of, spark):
    learned = [(i, "the words of this text are english", "en") for i in range(40)] + [(100 + i, "die worte sind deutsch", "de") for i in range(40)]
    asked = [(1, "Ελληνικά κείμενο εδώ", None), (2, "漢字文本", None), (3, "the words γδ", None), (4, "the γράμματα κείμενο", None), (5, "these words", None)]
    model = g.learn(docs_of(learned))
    got = {r["doc_id"]: r for r in g.predict(docs_of(asked), model).collect()}
    # A text with letters gets a learned language (only null and letterless texts are und), here without any evidence.
    assert [(got[i]["lang_pred"] in model.langs, got[i]["score"], got[i]["lang_spans"]) for i in (1, 2)] == [(True, 0.0, [])] * 2
    assert got[3]["score"] == 8 / 10 and got[4]["score"] == 3 / 18 and got[5]["score"] == 1.0
    kept = pipeline.language(spark, docs_of(learned + asked), "")
    assert {r["doc_id"] for r in kept.collect()} == {i for i, *_ in learned} | {3, 5}


def test_runs_are_cut_where_the_script_changes(docs_of):
    """A run of letters of two scripts is two words, each judged by its own script."""
    learned = [(i, "the words of this text are english", "en") for i in range(40)] + [(100 + i, "слова этого текста русские", "ru") for i in range(40)]
    got = g.predict(docs_of([(1, "wordsслова", None), (2, "словаwords", None)]), g.learn(docs_of(learned))).collect()
    for r in got:
        assert sorted(s["lang"] for s in r["lang_spans"]) == ["en", "ru"] and r["score"] == 0.5


def test_scripts_are_sorted_and_named():
    starts = [a for a, _ in g.SCRIPTS]
    assert starts == sorted(set(starts)) and len(g.NAMES) > 40
    for letter, name in (("ગ", "Gujarati"), ("త", "Telugu"), ("ཀ", "Tibetan"), ("ក", "Khmer"), ("ა", "Georgian"), ("ꀀ", "Yi"), ("ﺍ", "Arabic")):
        _, script, _ = g.features(g.points(letter), 16)
        assert g.NAMES[script[0]] == name
