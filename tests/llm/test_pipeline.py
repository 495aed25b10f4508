"""run() against its stages in plain Python, where each stage's input is what the one before kept."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import public_tokenizers
from ledgerline.llm import bpe, quality


def firsts_of_near_copies(texts):
    """The smallest id of each group that five-word shingles of Jaccard similarity 0.8 or more connect, by all pairs."""
    sets = {}
    for key, text in texts.items():
        words = text.encode().lower().split()
        sets[key] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    group = {key: key for key in texts}
    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and group[a] != group[b]:
                new, old = sorted((group[a], group[b]))
                group = {k: new if g == old else g for k, g in group.items()}
    return sorted(k for k, g in group.items() if k == g)


def test_near_dedup_of_all_documents(spark, sf_dir):
    """On the whole table, in which copies have not lost their lines yet."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = firsts_of_near_copies({r.doc_id: r.text or "" for r in docs.collect()})
    found = sorted(r.doc_id for r in corpus_pipeline.simhash_stage(spark, docs, sf_dir).collect())
    assert found == expected and len(found) < docs.count()


def test_stages_are_those_that_were_dealt():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality_stage", "line_stage", "simhash_stage", "mixing_stage", "bpe_stage"]


def test_run_against_the_stages_one_by_one(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns, name
        after = docs.collect()
        assert {r.doc_id for r in after} <= set(before)
        if name == "quality rules":
            texts = {k: quality.measured((r.text or "").encode()) for k, r in before.items()}
            assert {r.doc_id for r in after} == {k for k, t in texts.items() if not quality.base_failed(t) and not any(rule.rejects(t) for rule in quality.RULES)}
        if name == "simhash near-dedup":
            assert sorted(r.doc_id for r in after) == firsts_of_near_copies({k: r.text or "" for k, r in before.items()})
        assert all(r.n_chars == len(r.text) for r in after if name in ("line dedup", "mixing sources"))
    encoder = bpe.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    expected = []
    for r in docs.collect():
        ids = [t for piece in encoder.encode(r.text) for t in piece]
        expected.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in found) == sorted(expected)


def test_stages_on_odd_rows(spark):
    """Nulls in any column, empty and long texts, repeated rows, columns that clash with names the operators use."""
    from pyspark.sql import functions as F

    words = " ".join(f"{a}o{b}" for a in "bcdfghj" for b in "lmnprstv")
    rows = [(1, words, "en", "web", 5), (1, words, "en", "web", 5), (2, None, None, None, None), (3, "", "en", "web", 0), (None, words + " more", None, None, 3), (4, " ".join(f"{a}{b}{c}{d}{e}" for a in "bcdfghjklm" for b in "aeiou" for c in "npqrstvwxz" for d in ("", *"aeiou") for e in "bcdfghjklmnpqrstvwxz"), "de", "b", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("row", "file", "at", "line", "h", "group", "set", "raw", "removed", "n_removed", "size", "target", "taken", "slot", "place", "kept", "key", "ids", "_metadata", "a.b", "c`d"):
        docs = docs.withColumn(name, F.lit("clash"))
    found = {name: stage(spark, docs, "") for name, stage in corpus_pipeline.STAGES}
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert found[name].columns == docs.columns, name
    ids = {name: sorted((r.doc_id for r in df.collect()), key=str) for name, df in found.items()}
    assert ids["quality rules"] == [1, 1, 4, None]
    assert ids["line dedup"] == [2, 3, 4, None, None]  # the null id comes first and keeps the line that both of id 1 repeat
    assert ids["simhash near-dedup"] == [1, 2, 4]
    assert set(ids["mixing sources"]) <= {1, 4, None} and ids["byte-level BPE"] == [1, 1, 2, 3, 4, None, None]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0, name
