"""Comparisons of lines at once, and near copies by SimHash of blocks."""

from __future__ import annotations

import random

import numpy as np

from ledgerline.llm import lines, nearcopies


def distance(a: bytes, b: bytes) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng: random.Random, text: bytes, share: float) -> bytes:
    out = bytearray(text)
    for _ in range(int(len(text) * share)):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out.insert(at, rng.choice(b"abcdef ghij"))
        elif kind == 1 or len(out) < 2:
            out[at] = rng.choice(b"abcdef ghij")
        else:
            del out[at]
    return bytes(out)


def test_lines_compared_at_once_against_plain_distances():
    rng = random.Random(5)
    texts = [bytes(rng.choice(b"abcdef ghij") for _ in range(rng.randrange(1, 90))) for _ in range(300)]
    pairs = [(a, edited(rng, a, rng.choice((0.05, 0.15, 0.2, 0.3)))) for a in texts]
    pairs += [(a, a[len(a) // 9 :] + a[: len(a) // 9]) for a in texts[:60]] + [(b"x" * 9, b""), (b"a b c d e", b"a c d e")]
    near = [5 * distance(a, b) <= max(len(a), len(b)) for a, b in pairs]
    assert [lines.similar(a, b) for a, b in pairs] == near and 100 < sum(near) < 300
    told = [lines._told(a, b) for a, b in pairs]
    assert all(t == yes for t, yes in zip(told, near) if isinstance(t, bool))
    still = [k for k, t in enumerate(told) if not isinstance(t, bool)]
    assert len(still) > lines.TOGETHER // 8 and lines._all_within_edits([told[k] for k in still]) == [near[k] for k in still]
    assert all(lines._replaced(a.split(b" "), b.split(b" ")) >= distance(a, b) for a, b in pairs)


def test_groups_that_wait_have_the_links_of_those_that_do_not():
    rng = random.Random(8)
    groups = []
    for n in (2, 2, 3, 5, 9, 30, lines.WAITING + 9):
        first = bytes(rng.choice(b"abcdef ghij") for _ in range(60))
        groups.append([edited(rng, first, rng.choice((0.05, 0.1, 0.2))) for _ in range(n)])

    def parts(n, links):
        group = list(range(n))
        for a, b in links:
            group = [group[a] if g == group[b] else g for g in group]
        return [group.index(g) for g in group]

    found = lines.links_of_groups(groups)
    for k, texts in enumerate(groups):
        all_pairs = [(i, j) for i in range(len(texts)) for j in range(i) if 5 * distance(texts[i], texts[j]) <= max(len(texts[i]), len(texts[j]))]
        expected = parts(len(texts), all_pairs)
        assert parts(len(texts), [(a, b) for g, a, b in found if g == k]) == expected == parts(len(texts), lines.similar_links(texts)), k


def test_near_copies_meet_by_simhash_of_blocks():
    """Sets at Jaccard similarity 0.8 share a block's SimHash, whatever their sizes; unrelated ones do not."""
    rng = np.random.default_rng(3)
    for size in (5, 6, 9, 15, 16, 31, 64, 127, 250, 256, 1000, 3000):
        for _ in range(20):
            both, gone = rng.integers(0, 1 << 63, size, np.uint64) << np.uint64(1), size // 5
            cut = rng.integers(0, gone + 1)
            a, b = np.sort(np.delete(both, np.arange(cut))), np.sort(np.delete(both, np.arange(cut, gone)))
            assert np.isin(nearcopies.block_keys(a), nearcopies.block_keys(b)).any(), size
            assert not np.isin(nearcopies.block_keys(a), nearcopies.block_keys(np.sort(both * np.uint64(3)))).any(), size
    assert not len(nearcopies.block_keys(np.arange(3, dtype=np.uint64)))
