from __future__ import annotations

import random
from collections import Counter

from qoeflow.llm import catalog, passage_dedup as p, wordhash
from tests.llm.conftest import edge_rows


def text_words(text):
    import re
    return [m for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]


def words_of(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)]


def test_word_hashes_depend_on_the_words_alone():
    a = wordhash.word_hashes("One  two\nthree one TWO é")
    b = wordhash.word_hashes("x one two three")
    assert a[0] == a[3] == b[1] and a[1] == a[4] == b[2] and a[2] == b[3] and len(set(a.tolist())) == 4
    assert wordhash.gram_hashes(a, 2)[0] == wordhash.gram_hashes(b, 2)[1] == wordhash.gram_hashes(a, 2)[3]


def test_every_long_shared_passage_shares_units_that_cover_it():
    for seed in range(60):
        passage = words_of(f"p{seed}", 51)
        left, right = words_of(f"a{seed}", seed), words_of(f"b{seed}", 60 - seed)
        a = p.units(" ".join(left + passage + words_of(f"c{seed}", 30)))
        b = p.units(" ".join(right + passage + words_of(f"d{seed}", seed)))
        shared = set(a[0].tolist()) & set(b[0].tolist())
        at = sorted(i for d, i in zip(b[0].tolist(), b[1].tolist()) if d in shared)
        spans = p.runs(at, p.UNIT, p.LEAST)
        assert len(spans) == 1 and spans[0][0] >= len(right) and spans[0][1] <= len(right) + 51


def test_passage_in_the_middle_of_lines_goes_and_the_rest_stays(docs_of):
    passage = " ".join(words_of("passage", 80))
    own = {i: (" ".join(words_of(f"l{i}", 40)), " ".join(words_of(f"r{i}", 40))) for i in range(6)}
    licence = "this line of ten words stands in each of them"
    rows = [(i, f"{licence}\n{a} {passage} {b}" if i % 2 else f"{a}\n{licence}\n{b}") for i, (a, b) in own.items()]
    got = {r["doc_id"]: r for r in p.remove_repeats(docs_of(rows)).collect()}
    for i, text in rows:
        if i in (3, 5):
            (span,) = got[i]["removed"]
            gone = text[span["start"]:span["end"]]
            assert gone in passage and len(gone.split()) >= 80 - 24
            assert got[i]["text"] == text[:span["start"]] + text[span["end"]:]
        else:
            assert got[i]["text"] == text and not got[i]["removed"]


def test_no_long_passage_is_left_twice(small):
    """Brute force over all 51-word windows of what stays."""
    docs = {r["doc_id"]: r["text"] for r in small("documents", "0.01").collect()}
    got = {r["doc_id"]: r for r in p.remove_repeats(small("documents", "0.01")).collect()}
    assert set(got) == set(docs)
    seen, removed = {}, 0
    for doc_id in sorted(docs):
        at = text_words(docs[doc_id])
        words = [m[0].lower() for m in at]
        spans = [(s["start"], s["end"]) for s in got[doc_id]["removed"]]
        removed += len(spans)
        free = [not any(a <= m.start() < b for a, b in spans) for m in at]
        for i in range(len(words) - 50):
            if all(free[i:i + 51]):
                assert seen.setdefault(tuple(words[i:i + 51]), doc_id) == doc_id
    assert removed > 0
    # What went is in earlier documents, unit by unit.
    grams = {}
    for doc_id in sorted(docs):
        words = [m[0].lower() for m in text_words(docs[doc_id])]
        for s in got[doc_id]["removed"]:
            inside = [m[0].lower() for m in text_words(docs[doc_id][s["start"]:s["end"]])]
            assert len(inside) >= p.LEAST and any(tuple(inside[i:i + p.UNIT]) in grams for i in range(len(inside) - p.UNIT + 1))
        grams.update((tuple(words[i:i + p.UNIT]), doc_id) for i in range(len(words) - p.UNIT + 1))


def test_edge_rows(edge_docs, no_docs):
    got = p.remove_repeats(edge_docs).collect()
    # The long text is in three rows (two documents, and one of them again): only the first keeps it.
    kept = Counter((r["doc_id"], bool(r["removed"])) for r in got)
    assert sum(n for (_, gone), n in kept.items() if gone) == 2 and sum(kept.values()) == len(edge_rows())
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, *_ in edge_rows())
    assert p.remove_repeats(no_docs).count() == 0


def test_query_leaves_no_long_passage_twice_at_all(spark, small):
    """Brute force over all 51-word windows of what stays, places that overlap left aside."""
    docs = {r["doc_id"]: r["text"] for r in small("documents", "0.01").collect()}
    seen = {}
    for r in sorted(catalog.op4_passage_dedup(spark, "/root/testdata/sf0.01").collect(), key=lambda r: r["doc_id"]):
        spans = [tuple(map(int, x.split(":"))) for x in r["removed"].split(",") if x]
        at = text_words(docs[r["doc_id"]])
        free = [not any(a <= m.start() < b for a, b in spans) for m in at]
        for i in range(len(at) - 50):
            if all(free[i:i + 51]):
                doc, place = seen.setdefault(tuple(m[0].lower() for m in at[i:i + 51]), (r["doc_id"], i))
                assert doc == r["doc_id"] and i - place < 51


def test_repeats_inside_a_document_go(docs_of):
    passage, a, b, c = (" ".join(words_of(x, n)) for x, n in (("inside", 80), ("ia", 40), ("ib", 40), ("ic", 40)))
    rows = [(1, f"{a} {passage} {b} {passage} {c}"), (2, " ".join(words_of("other", 90))), (3, "same " * 200)]
    got = {r["doc_id"]: r for r in p.remove_repeats(docs_of(rows), within=True).collect()}
    (span,) = got[1]["removed"]
    gone = rows[0][1][span["start"]:span["end"]]
    assert gone in passage and len(gone.split()) >= 80 - 24 and span["start"] > len(f"{a} {passage} {b}")
    assert not got[2]["removed"] and len(got[3]["text"].split()) >= p.UNIT


def test_shared_passages_go_from_their_first_word_to_their_last(docs_of):
    """From ``LEAST`` words on, whatever units they have; what is shorter stays."""
    rows, want = [], {}
    for n in range(20, 60):
        passage = " ".join(words_of(f"s{n}", n))
        for k in (0, 1):
            before, after = " ".join(words_of(f"sb{n}{k}", 17 + n % 5)), " ".join(words_of(f"sa{n}{k}", 30))
            rows.append((2 * n + k, f"{before} {passage} {after}"))
        at = len(before) + 1
        want[2 * n + 1] = [(at, at + len(passage))] if n >= p.LEAST else []
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["removed"]] for r in p.remove_repeats(docs_of(rows)).collect()}
    assert all(got[i] == want.get(i, []) for i in got)


def test_whole_short_lines_paragraphs_and_texts_go(docs_of):
    own = [" ".join(words_of(f"w{i}", 30)) for i in range(8)]
    line, short, text, wide = (" ".join(words_of(x, n)) for x, n in (("line", 14), ("short", 12), ("text", 5), ("wide", 24)))
    rows = [(0, f"{own[0]}\n{line}\n{own[1]}"), (1, f"{own[2]}\n{line.upper()}\n{short}\n{own[3]}"), (2, text), (3, f" {text} "),
            (4, wide), (5, f"{own[4]}\n{short}\n\n{wide[:41]}\n{wide[42:]}\n\n{own[5]}"), (6, f"{own[6]} {line} {own[7]}")]
    got = {r["doc_id"]: r["text"].split() for r in p.remove_repeats(docs_of(rows), whole=True).collect()}
    assert got[0] == rows[0][1].split() and got[2] == text.split() and got[4] == wide.split()
    assert got[1] == f"{own[2]} {short} {own[3]}".split() and got[3] == [] and got[6] == rows[6][1].split()
    assert got[5] == f"{own[4]} {short} {own[5]}".split()
