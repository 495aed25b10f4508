"""Operators against the whole job where a cheaper one was done once."""

from __future__ import annotations

import random

import corpus_pipeline
from ledgerline.llm import htmltext, lines

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in zip(ids, texts, strict=True)], SCHEMA)


def invented(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def test_near_dedup_stage_against_brute_force_jaccard(spark):
    """Texts with words replaced: similarities from 0.5 to 1, of which SimHash at 3 bits finds few."""
    rng = random.Random(2)
    vocabulary, texts = invented(rng, 900), []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 200))]
        for n in (0, 0, 1, 2, 3, 5, 8):
            words = list(base)
            for i in rng.sample(range(len(words)), min(n, len(words) // 9)):
                words[i] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    rng.shuffle(texts)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    group = list(range(len(texts)))
    near = 0
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                near += sets[i] != sets[j]
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    kept = sorted(r.doc_id for r in corpus_pipeline.simhash_stage(spark, rows_of(spark, texts), "").collect())
    assert near > 20 and kept == sorted(set(group))


def test_exact_repeats_of_short_lines_go(spark):
    """Lines of one to four words, and lines of scripts without spaces, which are one word."""
    texts = ["Ietzte.\nein Wort mehr\n今天天气很好\nวันนี้อากาศดี\n--", "ietzte!\nzwei\nein wort, mehr\n--", "今天天气很好。\n今天天气很好\nวันนี้อากาศดี\nzwei"]
    found = {r.doc_id: (r.n_removed, r.text) for r in lines.without_repeated_lines(rows_of(spark, texts)).collect()}
    assert found == {0: (0, texts[0]), 1: (2, "zwei\n--"), 2: (4, "")}  # the one with a full stop is a fuzzy repeat: 18 of 21 bytes


def test_stages_judge_each_row_where_ids_are_null_or_repeat(spark):
    rng = random.Random(4)
    words = invented(rng, 400)
    good = [" ".join(rng.sample(words, 40)) for _ in range(6)]
    junk, line = "# # $ % " * 20, " ".join(rng.sample(words, 12))
    for key in (None, 7):
        docs = rows_of(spark, [good[0], junk, good[1]], [key] * 3)
        assert sorted(r.text for r in corpus_pipeline.quality_stage(spark, docs, "").collect()) == sorted(good[:2])
        docs = rows_of(spark, [f"{line}\n{good[0]}", f"{good[1]}\n{line}", good[2], f"{line}\n{line}\n{good[3]}"], [key] * 4)
        out = [r.text.split("\n") for r in corpus_pipeline.line_stage(spark, docs, "").collect()]
        assert len(out) == 4 and sorted(sum(out, [])) == sorted([*good[:4], line])
        docs = rows_of(spark, [good[0], good[1], good[0], good[0], good[1], good[2]], [key] * 6)
        assert sorted(r.text for r in corpus_pipeline.simhash_stage(spark, docs, "").collect()) == sorted(good[:3])


def test_copies_of_a_page_are_no_template(spark):
    """Three rows of one page on a host, and 25 of a page with an article beside others, keep their text."""
    page = lambda tag, own, k: f"<html><body><nav>Menu {k}</nav><{tag}><p>{own} first part</p><p>{own} second part</p></{tag}></body></html>"
    rows = [(f"http://a.example/{i}", page("div", "copied", i), "copied first part copied second part") for i in range(3)]
    rows += [(f"http://b.example/{i}", page("article", "copied", i), "copied first part copied second part") for i in range(25)]
    rows += [(f"http://b.example/x{i}", page("article", f"own{i}", i), f"own{i} first part own{i} second part") for i in range(2)]
    pages = spark.createDataFrame([(i, url, html) for i, (url, html, _) in enumerate(rows)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in htmltext.main_text(pages).collect()} == {i: text for i, (_, _, text) in enumerate(rows)}
