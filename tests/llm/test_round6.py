"""Keys of lines go through the shuffle in chunks, linked lines are not compared again, and words of letters need no splitting."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import public_tokenizers

from ledgerline.llm import lines, rans


def test_keys_are_shuffled_in_chunks_and_buckets_stay(spark):
    texts = [f"line {'abcdefghij'[i % 10]} of words {'klmnopqrst'[i // 10 % 10]} {i // 100 * 'x'} and of others".encode() for i in range(3000)]
    rows = spark.createDataFrame([(i, bytearray(x), True) for i, x in enumerate(texts)] * 2, "h long, text binary, fresh boolean")
    chunks = lines.keys_of_lines(rows.repartition(2)).collect()
    keyed = np.concatenate([np.frombuffer(r.rows, lines._KEYED) for r in chunks])
    assert len(keyed) > 2 * 3000 * 5 and len(chunks) <= 2 * (lines.SLOTS + len(keyed) // lines.CHUNKED + 1) and len(chunks) < len(keyed) // 3
    offsets = np.cumsum([0] + [len(x) for x in texts])
    flat = np.frombuffer(b"".join(texts), np.uint8)
    key, at = lines.line_keys(flat, offsets, lines._powers(lines._BASE, len(flat)), lines._powers(lines._BACK, len(flat)))
    assert sorted(zip(keyed["key"].tolist(), keyed["h"].tolist())) == sorted([*zip(key.tolist(), at.tolist())] * 2)
    members = defaultdict(set)
    for k, i in zip(key.tolist(), at.tolist()):
        members[k].add(i)

    def near(found):
        sizes = sorted(len(texts[i]) for i in found)
        return any(100 * a >= 80 * b for a, b in zip(sizes, sizes[1:]))

    expected = {(min(m), frozenset(m)) for m in members.values() if len(m) <= lines.MEETING and near(m)}
    expected |= {(k, frozenset(m)) for k, m in members.items() if len(m) > lines.MEETING}
    found = defaultdict(set)
    for r in lines.line_buckets(lines.keys_of_lines(rows)).collect():
        found[r.bucket, r.home].add(r.h)
    assert len(expected) > 100 and sorted((home, sorted(m)) for (_, home), m in found.items()) == sorted((home, sorted(m)) for home, m in expected)


def test_a_key_of_very_many_lines_is_not_held(spark):
    n = lines.PACKED + 3000
    keyed = np.zeros(n + 4, lines._KEYED)
    keyed["key"], keyed["h"], keyed["size"] = 7, np.arange(n + 4), 50
    keyed["key"][[5, n // 2, n + 1, n + 3]] = 8, 9, 8, 9
    rows = [(1, bytearray(keyed[i : i + 4096].tobytes())) for i in range(0, len(keyed), 4096)]
    found = lines.line_buckets(spark.createDataFrame(rows, "slot int, rows binary").coalesce(1)).persist()
    assert found.filter("bucket = 7 and home = 7").count() == n
    assert sorted((r.home, r.h) for r in found.filter("bucket <> 7").collect()) == [(5, 5), (5, n + 1), (n // 2, n // 2), (n // 2, n + 3)]
    found.unpersist()


def test_linked_lines_are_not_compared_again(monkeypatch):
    texts = [b"the same words in a line of some length %d" % i for i in range(9)] + [b"quite another text that is like none of those"]
    groups = [[0, 1, 2, 9], [1, 2], [2, 3, 9], [0, 1, 2, 3], [3, 4, 5, 6, 7, 8], [0, 8], [4, 8, 9]]
    compared = []
    told = lines._told
    monkeypatch.setattr(lines, "_told", lambda a, b: compared.append((a, b)) or told(a, b))
    linked = lines.Linked()
    found = [links for half in (groups[:3], groups[3:]) for links in lines.links_of_groups([[texts[i] for i in g] for g in half], half, linked)]
    assert len({linked.root(i) for i in range(9)}) == 1 and linked.root(9) == 9
    assert len(found) == 8 and len(compared) == 8  # one comparison for each link that a tree of nine needs


def test_words_of_letters_go_to_the_model(monkeypatch):
    tokens = rans.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    split = []
    together = tokens._together
    monkeypatch.setattr(tokens, "_together", lambda words: split.extend(words) or together(words))
    text = "Über die façade, naïve ÿþ cœur straße queasadodoñ x2 it's don't éé é ªµº ÷ İ <|endoftext|> aux <|x"
    for one in (text, "Plain words AND größere Wörter", text.upper(), "a" * 3000 + " ß" * 9):
        assert tokens.encode([one.encode()], 2)[0].tolist() == [*tokens.tokenizer.encode(one, add_special_tokens=False).ids, 2]
    assert b"x2" in split and "cœur".encode() in split and not {b"die", "façade".encode(), b"plain", "straße".encode()} & set(split)


def test_a_tokenizer_that_changes_letters_takes_all_words(tmp_path):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

    tokenizer = Tokenizer(models.BPE({"a": 0, "b": 1, "e": 2, "ab": 3, "é": 4}, [("a", "b")]))
    tokenizer.normalizer, tokenizer.pre_tokenizer = normalizers.Sequence([normalizers.NFD(), normalizers.StripAccents(), normalizers.Lowercase()]), pre_tokenizers.Whitespace()
    tokenizer.save(str(tmp_path / "t.json"))
    tokens = rans.WordTokens(str(tmp_path / "t.json"))
    assert tokens.pieces is None and tokens.encode(["abé ab".encode()], 9)[0].tolist() == [3, 2, 3, 9]
