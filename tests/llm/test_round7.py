"""Comparisons of lines that stop early or wait for one another, and places of those lines alone that matter."""

from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerline.llm import lines


def prose(rnd: random.Random, n: int) -> bytes:
    return b" ".join("".join(rnd.choices("abcdefgh", k=rnd.randint(1, 7))).encode() for _ in range(n))


def edited(rnd: random.Random, text: bytes, share: float) -> bytes:
    out = bytearray(text)
    for at in rnd.sample(range(len(out)), int(share * len(out))):
        out[at] = rnd.choice(b"xyz")
    return bytes(out)


def test_pairs_that_cannot_succeed_are_compared_no_further(monkeypatch):
    rnd = random.Random(5)
    texts = [prose(rnd, 60) for _ in range(96)]
    pairs = [t for a, b in zip(texts[::2], texts[1::2]) if not isinstance(t := lines._told(a, b), bool)]
    pairs += [t for x in texts for share in (0.1, 0.18, 0.24) if not isinstance(t := lines._told(x, edited(rnd, x, share)), bool)]
    expected = [lines._within_edits(*t) for t in pairs]
    assert lines._all_within_edits(pairs) == expected and 50 < sum(expected) < len(pairs) - 50
    least, steps = np.minimum, []
    monkeypatch.setattr(lines.np, "minimum", lambda *a, **k: steps.append(1) or least(*a, **k))
    apart = [(a, b, most) for (a, b, most), yes in zip(pairs, expected) if not yes][:40]
    lines._distances(apart)
    assert len(steps) < max(len(a) + len(b) for a, b, _ in apart)  # two for each diagonal to the end, before


def test_words_of_one_side_alone_are_replaced():
    rnd = random.Random(6)
    for _ in range(300):
        a = [rnd.choice([b"a", b"bb", b"ccc", b"dddd"]) for _ in range(rnd.randint(0, 9))]
        b = [rnd.choice([b"a", b"bb", b"eee", b"ffff"]) for _ in range(rnd.randint(0, 9))]
        assert lines._alone(a, b) <= lines._replaced(a, b)


@pytest.mark.parametrize("together", [4, 256])
def test_comparisons_within_large_groups_wait_for_one_another(monkeypatch, together):
    rnd = random.Random(7)
    texts = []
    for _ in range(25):
        base = prose(rnd, 20)
        texts += [base, *(edited(rnd, base, 0.12) for _ in range(3))]
    rnd.shuffle(texts)
    assert len(texts) > lines.WAITING
    near = [(i, j) for i in range(len(texts)) for j in range(i) if lines.similar(texts[i], texts[j])]
    monkeypatch.setattr(lines, "TOGETHER", together)
    calls, compared = [], lines._all_within_edits
    monkeypatch.setattr(lines, "_all_within_edits", lambda pairs: calls.append(len(pairs)) or compared(pairs))

    def parts(links):
        joined = lines.Linked()
        for a, b in links:
            joined.link(a, b)
        return [joined.root(k) for k in range(len(texts))]

    assert parts(lines.similar_links(texts)) == parts(near) and len(set(parts(near))) < 60
    assert len(calls) <= sum(calls) // together + 2  # one for each line before


def test_normalised_lines_against_a_plain_version():
    def plain(text: bytes) -> list[bytes]:
        out = []
        for line in text.split(b"\n"):
            form = bytes(x if x > 127 else ord("0") if chr(x).isdigit() else ord(chr(x).lower()) if chr(x).isalpha() else 32 for x in line)
            while b"00" in form:
                form = form.replace(b"00", b"0")
            out.append(b" ".join(w for w in form.split(b" ") if w))
        return out

    rnd = random.Random(8)
    texts = [bytes(rnd.choice(b"aB 0 9.\n\t\xc3\xa4\r") for _ in range(n)) for n in (0, 1, 2, 3, *(rnd.randint(4, 300) for _ in range(60)))]
    for text in [*texts, b"12", b"\n\n", b" a", b"a ", b"a\n", b"\na", "ä\n1 22 333".encode()]:
        number, h, found = lines.hashed_lines(text, lines._powers(lines._BASE, 400), lines._powers(lines._BACK, 400))
        expected = [(k, x) for k, x in enumerate(plain(text)) if x]
        assert list(zip(number.tolist(), found.to_pylist())) == expected
        assert len(set(h.tolist())) == len({x for _, x in expected})


def test_places_are_sought_of_lines_alone_that_matter(spark, monkeypatch):
    rnd = random.Random(9)
    once = [prose(rnd, 12).decode() for _ in range(300)]
    rows = [(k, f"{once[k]}\nThe same in all\n{once[k].upper()}!" if k % 3 else f"{once[k]}\n{once[k - 1]}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes, written = {}, lines.written
    monkeypatch.setattr(lines, "written", lambda df, name: (out := written(df, name), sizes.__setitem__(name, out.count()))[0])
    found = sorted((r.doc_id, r.n_removed, r.text) for r in lines.without_repeated_lines(docs).collect())
    assert sizes["light"] < sizes["lines"] and sizes["grouped"] < 500
    assert [n for _, n, _ in found] == [(k > 0) if k % 3 == 0 else 2 - (k == 1) + (k == 299) for k in range(300)]  # document 0 has the line of 299
    assert found[1][2] == f"{once[1]}\nThe same in all"
    monkeypatch.setattr(lines, "COMMON", 2)  # copies of common lines are dealt over tasks
    assert sorted((r.doc_id, r.n_removed, r.text) for r in lines.without_repeated_lines(docs).collect()) == found
