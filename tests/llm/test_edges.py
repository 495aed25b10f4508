"""Nulls in any column, empty and very long texts, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import bpe, components, htmltext, language, lines, mixing, neighbours, quality, rans, simhash, toxicity

LONG = "alpha beta gamma delta epsilon " * 30_000
ROWS = [(1, "a b c d e f", "en", "web", 11), (1, "a b c d e f", "en", "web", 11), (2, None, None, None, None), (3, "", "en", "web", 0), (4, LONG, "de", None, len(LONG)), (None, "x y z", None, "web", 5), (5, "first line of five words\nFirst line, of five words!\nz", "en", "web", 3)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def odd(spark):
    """The rows with more columns, whose names are those that the operators give their results."""
    rows = spark.createDataFrame(ROWS, SCHEMA)
    for name in ("fp", "component_id", "ids", "n_tokens", "size", "row", "epoch", "slot", "kept", "_kept", "score", "held_out", "h", "removed", "n_removed", "target", "taken"):
        rows = rows.withColumn(name, F.lit("clash"))
    return rows


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 1), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")


def test_simhash(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ROWS) and {r.component_id for r in rows if r.doc_id in (2, 3)} == {2}
    assert {r.fingerprint for r in rows if r.doc_id in (2, 3)} == {"0" * 16}
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)[:3] == [1, 1, 2]
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_first(none).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (5, 5), (7, 9), (9, None)], "a long, b long")
    assert sorted(map(tuple, components.components(edges).collect())) == [(1, 1), (2, 1), (3, 1), (7, 7), (9, 7)]
    assert components.components(edges.limit(0)).count() == 0
    chain = spark.range(300).selectExpr("id a", "id + 1 b")
    assert components.components(chain).filter("component <> 0").count() == 0


def test_chains_of_segments_find_all_near_pairs(spark):
    import itertools
    import random

    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(12)]
    near = [x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for x in base for _ in range(6)]
    fps = sorted(set(base + near))
    rows = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    links = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in simhash.near_links(rows).collect()]
    parent = {x: x for x in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert (a ^ b).bit_count() <= 3
        parent[root(a)] = root(b)
    assert all(root(a) == root(b) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 3)


def test_neighbours(spark):
    vectors = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 2), (3, None, 1), (4, [0.0, 0.0], 1), (5, [None, 1.0], 1), (6, [float("nan"), 1.0], 1), (7, [1.0, 1e-9], 1), (None, [1.0, 1.0], 1), (0, [1.0, 0.0], 1)], "vec_id long, embedding array<float>, label int")
    found = neighbours.nearest(vectors, F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in found] == [(0, 1, 1), (0, 2, 7), (0, 3, 2)]
    assert found[0].score == 1.0
    assert neighbours.nearest(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_toxicity(odd, none, labels):
    rows = toxicity.toxicity(odd, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.toxicity(none, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(odd, labels.limit(0)).collect()} == {0.0}


def test_bpe(odd, none):
    encoded = bpe.encode_documents(odd, RANKS, public_tokenizers.PATTERN)
    decoded = bpe.decode_documents(encoded, RANKS, public_tokenizers.PATTERN)
    texts = sorted((r.doc_id or 0, bytes(r.raw).decode()) for r in decoded.collect())
    assert texts == sorted((r[0] or 0, r[1] or "") for r in ROWS)
    assert bpe.round_trip_digests(none, RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("text", ["", "a", "ﬁ \U0001f600", " " * 5000, "ab" * 4000, "aaaa" * 999, "\r\n\t x'll don't", "日本語" * 500])
def test_tree_bpe_is_what_tiktoken_gives(text):
    import tiktoken

    own = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    ids = [t for piece in own.encode(text) for t in piece]
    assert ids == encoding.encode_ordinary(text) and own.decode(ids) == text.encode()


def test_lines(odd, none):
    found = lines.without_repeated_lines(odd)
    assert found.columns == [*odd.columns, "n_removed_"]
    rows = {r.doc_id: r for r in found.filter("doc_id > 1").collect()}
    assert rows[2].text is None and rows[3].text == "" and rows[4].text == LONG
    assert rows[5].text == "first line of five words\nz" and rows[5]["n_removed_"] == 1
    assert lines.without_repeated_lines(none).count() == 0


def test_links_of_lines_connect_what_brute_force_connects(spark):
    """Families of lines with one to three words replaced: one or two leave two blocks equal, so all these pairs group."""
    import random

    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(5, 12))) for _ in range(400)]
    texts, expected = [], []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(14, 60))]
        texts.append(" ".join(base))
        for n in (1, 2, 2):
            line = list(base)
            for at in rng.sample(range(len(line)), n):
                line[at] = rng.choice(vocabulary)
            expected.append(len(texts))
            texts.append(" ".join(line))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in lines.repeated_lines(docs).collect()) == expected


def test_large_buckets_of_lines_are_compared_in_blocks(spark, monkeypatch):
    """The same groups come out where buckets are dealt over blocks, and repeated or null ids lose no line."""
    texts = [f"{w} line of some more words that are all the same but one" for w in ("first", "second", "third", "fourth", "fifth", "sixth", "seventh")]
    docs = spark.createDataFrame([(7, "\n".join(texts[:3]) + "\nunique one"), (7, "other unique\n" + "\n".join(texts[3:])), (None, "unique two\n" + texts[0])], "doc_id long, text string")
    expected = [(None, f"unique two\n{texts[0]}"), (7, "other unique"), (7, "unique one")]
    whole = sorted(((r.doc_id, r.text) for r in lines.without_repeated_lines(docs).collect()), key=str)
    monkeypatch.setattr(lines, "MEETING", 2)
    assert whole == sorted(((r.doc_id, r.text) for r in lines.without_repeated_lines(docs).collect()), key=str) == sorted(expected, key=str)


def meeting(forms):
    """Pairs of normalised lines that share a key."""
    flat, offsets = np.frombuffer(b"".join(forms), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in forms])))
    key, at = lines.line_keys(flat, offsets, lines._powers(lines._BASE, len(flat)), lines._powers(lines._BACK, len(flat)))
    held = {}
    for k, i in zip(key.tolist(), at.tolist(), strict=True):
        held.setdefault(k, set()).add(i)
    return {(i, j) for members in held.values() for i in members for j in members if i < j}


def test_all_similar_short_lines_meet():
    """Lines of up to 14 bytes over few letters, against edit similarity of all pairs."""
    draw = np.random.default_rng(5)
    forms = sorted({bytes(draw.choice(list(b"abc"), draw.integers(1, 15)).tolist()) for _ in range(500)} | {b"a b c d e f g", b"a b c d e f", b"ab cd"})
    near = {(i, j) for i in range(len(forms)) for j in range(i + 1, len(forms)) if lines.similar(forms[i], forms[j])}
    assert len(near) > 100 and near <= meeting(forms)


def test_long_lines_with_four_replaced_words_meet():
    """Four words touch eight of ten blocks at most; twelve of eighty words most often leave one."""
    draw = np.random.default_rng(6)
    word = lambda: bytes(draw.choice(list(b"abcdefghijklmnop"), 6).tolist())
    forms, four, twelve = [], [], []
    for k in range(300):
        base = [word() for _ in range(80)]
        edited = list(base)
        for i in draw.choice(80, 12 if k % 3 == 0 else 4, replace=False):
            edited[i] = word()
        (twelve if k % 3 == 0 else four).append((len(forms), len(forms) + 1))
        forms += [b" ".join(base), b" ".join(edited)]
    met = meeting(forms)
    assert met <= {*four, *twelve}
    assert sum(x in met for x in four) == len(four)
    assert sum(x in met for x in twelve) >= 0.3 * len(twelve)


def test_long_lines_of_one_word_meet():
    """Scripts without spaces: pairs of bytes are the features of lines whose words are long."""
    draw = np.random.default_rng(7)
    base = bytes(draw.integers(128, 256, 300).tolist())
    assert meeting([base, base[:150] + b"xyz" + base[153:]]) == {(0, 1)}


def test_repeated_rows_lose_their_lines(spark):
    docs = spark.createDataFrame([(1, "one line of a row\nanother line of it")] * 3, "doc_id long, text string")
    assert sorted(r.n_removed for r in lines.without_repeated_lines(docs).collect()) == [0, 2, 2]


def test_similar_is_edit_distance():
    import random

    rng = random.Random(5)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for _ in range(400):
        a = bytes(rng.choice(b"ab c") for _ in range(rng.randint(1, 40)))
        b = bytearray(a)
        for _ in range(rng.randint(0, 9)):
            b[rng.randrange(len(b))] = rng.choice(b"abc d")
        b = bytes(b[rng.randint(0, 3) :])
        if b:
            assert lines.similar(a, b) == (5 * distance(a, b) <= max(len(a), len(b)))


def test_mixing(odd, none, spark):
    rows = mixing.mixed_words(odd).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 3 * r.size for r in rows)
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    assert mixing.mixed_words(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.mixed_words(blank).collect()] == [0, 0]


def test_html(spark):
    page = "<html><body><nav>Menu</nav><article><h1>T &amp; t</h1><p>One\n two<p>Three<br>four</article><footer>F</footer><script>x</script></body></html>"
    rows = spark.createDataFrame([(1, "http://h.example/a", page), (2, None, page), (3, "http://h.example/b", None), (4, "http://h.example/c", ""), (None, "nothing", "<p>x"), (6, "u", "<p " + "a" * 100_000)], "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("constants", F.lit(2))
    found = {r.page_id: r.text for r in htmltext.main_text(rows).collect()}
    assert found[1] == found[2] == "T & t One two Three four" and found[3] == found[4] == "" and found[None] == "x"
    assert htmltext.main_text(rows.limit(0)).count() == 0


def test_constant_blocks_of_a_host_are_template(spark):
    body = lambda i: f"<html><body><div><p>Subscribe to our letter</p><p>Own text {i} of page</p></div></body></html>"
    rows = spark.createDataFrame([(i, f"http://h.example/{i}", body(i)) for i in range(40)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in htmltext.main_text(rows).collect()} == {i: f"Own text {i} of page" for i in range(40)}


def test_html_of_any_depth_and_clashing_names(spark):
    deep = "<html><body>" + "<div>" * 10_000 + "<article><p>deep text</p></article>"
    rows = spark.createDataFrame([(i, f"http://h.example/{i}", deep.replace("deep", f"deep{i}")) for i in range(4)], "page_id long, url string, html string")
    for name in ("text", "n_chars", "wrapper", "salt", "host_of_page", "tree"):
        rows = rows.withColumn(name, F.lit("clash"))
    found = htmltext.main_text(rows)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert {r.page_id: r.text for r in found.collect()} == {i: f"deep{i} text" for i in range(4)}


def test_unnamed_parts_of_a_host(spark):
    """Parts without a telling name: constant lines, a menu of links and a short varying line beside a long text."""
    def page(i):
        menu = "".join(f"<li><a href='/{j}'>Topic {i} {j}</a></li>" for j in range(5))
        prose = "".join(f"<p>Sentence {j} of page {i} which tells of something else, at some length.</p>" for j in range(6))
        return f"<html><body><div><ul>{menu}</ul></div><div><p>The same on all pages</p></div><div><h1>Title {i}</h1>{prose}<p>Written by the staff</p></div><div>Short {i}</div></body></html>"

    rows = spark.createDataFrame([(i, f"http://h.example/{i}", page(i)) for i in range(40)], "page_id long, url string, html string")
    for r in htmltext.main_text(rows).collect():
        prose = " ".join(f"Sentence {j} of page {r.page_id} which tells of something else, at some length." for j in range(6))
        assert r.text == f"Title {r.page_id} {prose}"


def test_quality(odd, none):
    rows = {r.doc_id: r for r in quality.quality_cascade(odd).collect()}
    assert rows[2].n_words == rows[3].n_words == 0 and rows[2].base_failed and not rows[2].kept
    assert rows[4].n_words == 150_000 and rows[4].n_repeat_words == 150_000 and rows[4].base_failed
    assert quality.quality_cascade(none).count() == 0


def test_quality_order_changes_work_and_no_verdict(spark):
    """On texts of which most fall to one rule, the measured order looks at fewer rules than the reverse one."""
    words = " ".join(f"word{i}" for i in range(40))
    texts = [words.replace(" ", "! ")] * 60 + ["7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22 33 44"] * 5 + [words] * 20 + ["- a b c\n- d e f g\n- h i j k l m"] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    costs = quality.rule_costs(docs, "text", quality.RULES, 2000)
    assert set(costs) == {r.name for r in quality.RULES} and costs["exclamations"][1] > 0.5 > costs["letters"][1] > 0
    order = quality.rule_order(costs)
    assert order[0].name == "exclamations"
    found = [quality.cascade(quality.measured(x.encode()), order) for x in texts]
    other = [quality.cascade(quality.measured(x.encode()), order[::-1]) for x in texts]
    assert [k for k, _ in found] == [k for k, _ in other] and sum(n for _, n in found) < sum(n for _, n in other)
    rows = {r.doc_id: (r.kept, r.rules_run) for r in quality.quality_cascade(docs).collect()}
    assert [rows[i][0] for i in range(len(texts))] == [k for k, _ in found]
    assert sum(n for _, n in rows.values()) < sum(n for _, n in other)


def test_rans(odd, none, tmp_path, spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rans.write_tokens(odd, path, str(tmp_path / "a"))
    rows = rans.read_tokens(spark, str(tmp_path / "a")).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1, 2, 3, 4, 5] and bytes(rows[3].ids) == b"\2\0\0\0"
    starts = [r.start for r in rows]
    assert starts == [sum(len(x.ids) // 4 for x in rows[:i]) for i in range(len(rows))]
    rans.write_tokens(none, path, str(tmp_path / "b"))
    assert rans.read_tokens(spark, str(tmp_path / "b")).count() == 0


def test_rans_blocks():
    import numpy as np

    rng = np.random.default_rng(4)
    ids = np.minimum(rng.geometric(0.02, 70_001), 999).astype(np.uint32)
    coder = rans.Coder(rans.frequencies(np.bincount(ids, minlength=1000)))
    body = coder.encode(ids, lanes=64, steps=16)
    assert (coder.decode(body) == ids).all() and len(body) < 2 * len(ids)
    assert (coder.stretch(body, 3) == ids[3 * 1024 : 4 * 1024]).all()
    broken = bytearray(body)
    broken[-5] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        coder.decode(bytes(broken))
    assert len(coder.decode(coder.encode(ids[:0]))) == 0


@pytest.mark.parametrize("text", ["Hi!! there. 5. $5, x's; don't.", "a<|endoftext|> B. ", "É. Ünï x.\ty.", " . ", ""])
def test_words_encode_as_the_tokenizer_does(text):
    tokens = rans.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    assert tokens.encode([text.encode(), b"x"], 2)[0].tolist() == [*tokens.tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_language(odd, none):
    rows = {r.doc_id: r for r in language.identify(odd).collect()}
    assert rows[2].lang_pred == rows[3].lang_pred == "und" and rows[4].lang_pred in ("en", "de")
    assert language.identify(none).count() == 0
