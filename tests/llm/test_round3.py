"""Class-based scores, conversation repair and the filter audit: against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from ledgerline.llm import audit, brown, repair
from ledgerline.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def frequency_scores(docs):
    seen = Counter()
    for doc_id, text in docs:
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10:
            seen.update(tokens(text))
    total, floor = sum(seen.values()), sum(seen.values()) + 0.1 * (len(seen) + 1)
    return seen, total, lambda text: sum(math.log10((seen[w] + 0.1) / floor) for w in tokens(text))


# op11


def test_exchange_against_brute_force():
    """Each move is to the class of the highest likelihood, counted anew; the likelihood never falls; planted groups are found."""
    rng = np.random.default_rng(1)
    kinds = np.arange(24) % 3
    bigrams = np.where((kinds[:, None] + 1) % 3 == kinds[None], rng.integers(20, 60, (24, 24)), rng.integers(0, 3, (24, 24)))
    bigrams = np.block([[bigrams, rng.integers(0, 9, (24, 2))], [rng.integers(0, 9, (2, 24)), rng.integers(0, 4, (2, 2))]])
    of = np.concatenate([np.arange(24) % 4, [4, 5]])
    likely = lambda of: brown.likelihood(brown.between_classes(bigrams, of, 6))
    for rounds in (1, 2, 20):
        slow = of.copy()
        for _ in range(rounds):
            before = slow.copy()
            for w in range(24):
                values = [likely(np.where(np.arange(26) == w, c, slow)) for c in range(4)]
                best = int(np.argmax(values))
                slow[w] = best if values[best] > values[slow[w]] + 1e-6 else slow[w]
            if (before == slow).all():
                break
        fast = brown.exchange(bigrams, 24, 4, rounds)
        assert (fast == slow).all() and likely(fast) >= likely(of)
    assert all(len({kinds[w] for w in range(24) if fast[w] == c}) <= 1 for c in range(4))


def small_texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words[: rng.randint(2, 60)]) for _ in range(rng.randint(0, 40))) for _ in range(80)]
    texts[3], texts[4], texts[5] = None, "", " \n\t "
    texts[20] = "never-seen Words HERE " * 3
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("settings", [brown.Settings(), brown.Settings(residents=20, leaders=8, classes=4), brown.Settings(residents=0, classes=2)])
def test_scores_against_brute_force(spark, settings):
    """Base scores by counting; scores are those of a distribution: the shares of all words add up to one in each context."""
    rows = small_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, total, base = frequency_scores(rows)
    found = {r.doc_id: r for r in brown.scored(docs, settings).collect()}
    assert len(found) == len(rows)
    for doc_id, text in rows:
        r = found[doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens(text)), sum(seen[w] > 0 for w in tokens(text)), total)
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 10 == 0) and r.base_score == pytest.approx(base(text), abs=1e-9)
        assert r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))
    counts = brown.word_counts(docs.filter(brown.learnt_from(docs["doc_id"])))
    lexicon = brown.Lexicon.of(counts, settings)
    assert len(lexicon.hashes) <= settings.residents
    model = brown.fitted(brown.numbered_texts(docs, lexicon), lexicon, settings)
    words = [w for w in seen if w != b"\n"]
    numbers = dict(zip(words, lexicon.numbers(words), strict=True))
    rare = {w: n for w, n in seen.items() if w != b"\n" and numbers[w] == lexicon.rare}
    unseen = math.log10(lexicon.unseen if lexicon.rare_total else 1.0)

    def log_p(before, w):
        number = lambda x: lexicon.end if x == b"\n" else numbers.get(x, lexicon.rare)
        own = model.emissions[number(w)]
        if number(w) == lexicon.rare:
            own = math.log10(rare[w] * (1 - lexicon.unseen) / lexicon.rare_total) if w in rare else unseen
        return model.transitions[model.of[number(before)], model.of[number(w)]] + own

    for doc_id, text in rows:
        line = [b"\n", *tokens(text)]
        assert found[doc_id].score == pytest.approx(sum(itertools.starmap(log_p, itertools.pairwise(line))), abs=1e-9)
    for before in [b"\n", b"unknown", *words[:5]]:
        assert sum(10 ** log_p(before, w) for w in [*words, b"\n", b"unknown"]) == pytest.approx(1)


def test_scores_beat_word_frequencies_on_held_out_documents(spark, sf_dir):
    rows = QUERIES["op11_brown"](spark, sf_dir).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    _, _, base = frequency_scores(docs)
    texts = dict(docs)
    assert len(rows) == len(docs) and all(r.base_score == pytest.approx(base(texts[r.doc_id])) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.3 * sum(r.n_tokens for r in held)


def test_long_texts_are_scored_in_slices(spark, monkeypatch):
    rows = small_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    whole = {r.doc_id: r.score for r in brown.scored(docs).collect()}
    text = ("ab cd\n" * 50).encode()
    monkeypatch.setattr(brown, "SLICE", 7)
    assert sum(brown.pieces(text), []) == text.split() and len(list(brown.pieces(text))) > 20
    assert sum(brown.pieces(b"x" * 40 + b" y"), []) == [b"x" * 40, b"y"]
    assert whole[4] == whole[3] == whole[5]


@pytest.mark.parametrize("rows", [[], [(None, None)], [(None, "a b"), (None, "a b"), (7, "a"), (7, "a")]])
def test_scores_of_odd_rows(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, score long, word string")
    out = brown.scored(docs).collect()
    _, total, base = frequency_scores(rows)
    assert sorted((r.doc_id or -1, r.n_tokens, round(r.base_score, 9), r.train_tokens, r.held_out) for r in out) == sorted(
        (k or -1, len(tokens(t)), round(base(t), 9), total, k is not None and zlib.crc32(str(k).encode()) % 10 == 0) for k, t in rows
    )
    assert all(math.isfinite(r.score) and r.score <= 0 for r in out)


# op12


def cheapest(signs):
    """All edits of up to two insertions before each turn, tried out: (cost, audit, roles)."""
    best = None
    for at in itertools.product(("", "u", "a", "ua", "au"), repeat=len(signs) + 1):
        if sum(map(len, at)) > 4:
            continue
        for edit in itertools.product("DKua", repeat=len(signs)):
            if any(s == "-" and e != "D" for s, e in zip(signs, edit, strict=True)):
                continue
            roles, cost, audited = "", 0, ""
            for before, s, e in zip(at, signs, edit, strict=False):
                roles += before + {"D": "", "K": s.lower()}.get(e, e)
                cost += 3 * len(before) + {"D": 4, "K": 0}.get(e, 3) + (3 if s.isupper() and e != "D" else 0)
                audited += "I" * len(before) + ("R" if e in "ua" else e)
            roles, cost, audited = roles + at[-1], cost + 3 * len(at[-1]), audited + "I" * len(at[-1])
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audited) < best[:2]):
                best = (cost, audited, roles)
    return best


def test_repair_against_all_edits():
    rng = random.Random(3)
    cases = ["", *map("".join, itertools.product("sua-Ux", repeat=2)), *("".join(rng.choice("suaxSUAX-") for _ in range(rng.randint(3, 4))) for _ in range(12))]
    for signs in cases:
        cost, edits, inserts = repair.repair(signs)
        audited = "".join("I" * len(b) + ("R" if e in "ua" else e) for e, b in zip(edits, inserts, strict=False)) + "I" * len(inserts[-1])
        roles = "".join(b + {"D": "", "K": s.lower()}.get(e, e) for b, e, s in zip(inserts, edits, signs, strict=False)) + inserts[-1]
        assert (cost, audited, roles) == cheapest(signs), signs


def test_repair_by_blocks_is_that_of_one(monkeypatch):
    rng = random.Random(8)
    for n in (1, 5, 6, 7, 23, 200):
        signs = "".join(rng.choice("suaxSUAX-") for _ in range(n))
        monkeypatch.setattr(repair, "BLOCK", 1 << 20)
        whole = repair.repair(signs)
        monkeypatch.setattr(repair, "BLOCK", 6)
        assert repair.repair(signs) == whole


def plain_audit(rows):
    """conv_id -> the contract's columns, by a plain loop over gathered rows."""
    blank = lambda x: " " if x is None else str(x)
    out, turns = {r[0]: [] for r in rows}, {}
    for conv, turn, role, text in rows:
        kind, role, text = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20, blank(role), blank(text)
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            turns.setdefault(conv, []).extend([(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1))
    for conv in out:
        own = sorted(turns.get(conv, []), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        seen, faults = set(), []
        for _, role, text in own:
            bare = re.sub("[\x20\x09-\x0d]", "", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in own]
        known = [x if x and x in "sua" else "x" for x in initials]
        signs = "".join("-" if f in ("blank", "duplicate") else x.upper() if f else x for f, x in zip(faults, known, strict=True))
        cost, edits, inserts = repair.repair(signs)
        names, said, letters = {"u": "user", "a": "assistant"}, [], ""
        for (_, role, text), e, b in zip(own, edits, inserts, strict=False):
            said += [f"{names[x]}:" for x in b] + ([] if e == "D" else [f"{names.get(e, role)}:{text}"])
            letters += "I" * len(b) + ("R" if e in names else e)
        said += [f"{names[x]}:" for x in inserts[-1]]
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        counts = tuple(faults.count(k) for k in ("blank", "duplicate", "truncated"))
        out[conv] = (gaps, *counts, illegal, cost, letters + "I" * len(inserts[-1]), hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def odd_conversations():
    rng = random.Random(2)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "Unit"], ["Yes.", "No", "", "  ", None, "é!", "long " * 50, "a\nb?", "😀"]
    rows = [(conv, rng.choice([None, 0, 1, 1, 2, 3, 9, -4, *range(12)]), rng.choice(roles), rng.choice(texts)) for conv in (None, 1, 2, 3, 4, -7) for _ in range(rng.randint(1, 40))]
    return rows + rows[:9] + [(100 + k, 0, "user", "Hello.") for k in range(60)]


@pytest.mark.parametrize("bits", [10, 2])
def test_conversations_against_a_plain_loop(spark, monkeypatch, bits):
    """Nulls, ties, repeats, unknown roles, conversations of which nothing is left; blocks of four turns too."""
    monkeypatch.setattr(repair, "BITS", bits)
    monkeypatch.setattr(repair, "BLOCK", 1 << bits)
    rows = odd_conversations()
    data = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, place int, row string, `a.b` string")
    found = {r.conv_id: tuple(r)[1:] for r in repair.audited(data).collect()}
    assert found == plain_audit(rows)
    assert any(v[6] == "" for v in found.values())


def test_no_conversations(spark):
    assert repair.audited(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_repaired_turns_are_the_conversation(spark):
    rows = [(1, 0, "user", "Hi.", "r"), (1, 1, "user", "Again.", "r"), (1, 2, "assistant", "So.", "r")]
    turns = repair.ordered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, row string"))
    blocks = repair.edited_blocks(turns)
    found = [tuple(r) for r in repair.repaired_turns(turns, blocks).orderBy("place", "sub").select("edit", "role", "text").collect()]
    assert found == [("K", "user", "Hi."), ("I", "assistant", ""), ("K", "user", "Again."), ("K", "assistant", "So.")]


# op13


def plain_filter_audit(docs, labels):
    good, toxic = ({d for d, q, t in labels if (q, t)[k] == 1} for k in (0, 1))
    least = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    failing = {}
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A"} if len(words) < 100 else set()
        fails |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        fails |= {"E"} if doc_id is not None and doc_id > least[text] else set()
        failing.setdefault(lang or "", []).append((doc_id, frozenset(fails)))
    out = {}
    for part, rows in failing.items():
        share = dict.fromkeys("ABCDE", Fraction(0))
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, x in enumerate(order, 1):
                gone, left = [r for r in left if x in r[1]], [r for r in left if x not in r[1]]
                share[x] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(x in f for _, f in rows) - len(gone), sum(f == {x} for _, f in rows), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(int(share[order[step - 1]]))
    return {k: tuple(v) for k, v in out.items()}


def test_audit_of_odd_rows_against_a_plain_loop(spark):
    rng = random.Random(6)
    words = [f"v{i}" for i in range(300)]
    texts = [None, "", "A B C", "x $ y", " ".join(words[:120]), " ".join(words[:50] * 3), " ".join(words).upper(), "#" * 5000]
    docs = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice([None, "", "en", "de"])) for _ in range(200)]
    labels = [(rng.choice([None, *range(40)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(60)]
    frame = spark.createDataFrame([(*r, 1, 2, "z") for r in docs], "doc_id long, text string, lang string, mask int, n long, digest string")
    marks = spark.createDataFrame([(*r, "p") for r in labels], "doc_id long, quality int, toxic int, part string")
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audit.filter_audit(frame, marks).collect()}
    assert found == plain_filter_audit(docs, [r for r in labels if r[0] is not None])


def test_audit_of_no_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert audit.filter_audit(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_shapley_shares_add_up(spark):
    """In all orders together, the filters remove 120 times what all of them remove; a part with one mask shares it evenly."""
    counts = spark.createDataFrame([("a", 31, 7, 0, 0), ("b", 0, 5, 0, 0), ("b", 3, 11, 1, 0)], "part string, mask int, n long, good long, toxic long")
    rows = audit.interaction_audit(counts).collect()
    assert {r.shapley for r in rows if r.part == "a"} == {7 * 24}
    b = [r for r in rows if r.part == "b" and r.filter_order == "ABCDE"]
    assert [r.shapley for r in b] == [660, 660, 0, 0, 0] and [r.kept for r in b] == [5] * 5 and [r.good_lost for r in b] == [1, 0, 0, 0, 0]
