"""Repair of a conversation's structure at least cost, by the DAG of all its cheapest edits.

The roles must spell `(s?(ua)+)?`, an automaton of four states. A node is (turns read, state); an arc keeps, reroles or deletes
the next turn, or inserts an empty one. Least costs forward from the start and backward from the end tell which arcs lie on a
cheapest path: those whose forward cost, own cost and backward cost add up to the optimum. Of the paths of that DAG the one of
the least letters is read off by a set of nodes that all have the same letters so far: each step takes the least letter that
leaves any of them. All letters but I read a turn, so the nodes of a set have read equally many turns and are four at most.

Turns are spread over tasks in the order of (conversation, turn), however long a conversation is, and texts are never gathered:
for the search a turn is one character, and a conversation the string of those, which is as long as the audit that is returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered_rows, written

BLANK, TRUNCATED = r"[^\x20\x09-\x0D]", r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
#: The role that a state lets come next, and the state after it; before the first turn `s` may come too.
WANTS, NEXT, AFTER_SYSTEM, ENDS = "uuau", (2, 2, 3, 2), 1, (0, 3)
FAR = 1 << 40
#: Turns of a block: what tasks get of a conversation's edits at a time, and how often backward costs are kept.
BITS = 10
BLOCK = 1 << BITS


def damaged(rows: DataFrame) -> DataFrame:
    """Turns with planted faults, decided by crc32 of `conv_id:turn` mod 20 (nulls: one space, in roles and texts too).

    0 drops a turn, 1 empties its text, 2 takes the sentence ends out of it, 3 repeats it, 4 makes it the user's.
    """
    name, numbered = numbered_rows(rows, "row")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    turns = numbered.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), F.col(name).alias("own"), kind.alias("kind"))
    each = turns.filter("kind != 0").select("*", F.explode(copies).alias("copy"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return each.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.struct("own", "copy").alias("row"))


def ordered_turns(rows: DataFrame, row_col: str | None = None) -> DataFrame:
    """`rows` (conv_id, turn, role, text) in the order of conversation, turn (null first), role and text, with what is wrong.

    Adds place (grows in that order), fault (`blank`, `duplicate`, `truncated` or null: the first that holds) and sign, one
    character for the search: the role's initial, or `x` if that is none of s, u and a; in capitals where the turn is
    truncated; `-` where it has to go. Written to the shared folder, as a place is one of this run. `row_col` names a column that
    tells equal rows apart, if there is one.
    """
    name, numbered = (row_col, rows) if row_col else numbered_rows(rows, "row")
    rows = numbered.select("conv_id", "turn", "role", "text", F.col(name).alias("row")).withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    said = F.unhex(F.sha2(F.concat_ws("\x00", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")), "role", "text"), 256))
    when = F.struct(F.col("turn").isNotNull(), F.col("turn"), F.col("row")).alias("when")  # null before any number
    rows = rows.withColumn("said", said).withColumn("when", when)
    firsts = rows.groupBy("said").agg(F.min("when").alias("first"))
    fault = F.when(~F.col("text").rlike(BLANK), "blank").when(F.col("when") != F.col("first"), "duplicate").when(F.col("text").rlike(TRUNCATED), "truncated")
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    sign = F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    faulty = rows.join(firsts, "said").withColumn("fault", fault).withColumn("sign", sign).withColumn("initial", initial)
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    # Ranges split a long conversation; equal starts of texts stay together, and whole texts decide within a task.
    spread = faulty.repartitionByRange(*keys, F.substring("text", 1, 64)).sortWithinPartitions(*keys, "text", "row")
    placed = spread.select("conv_id", "turn", "role", "text", "initial", "fault", "sign", F.monotonically_increasing_id().alias("place"))
    return written(placed, "turns")


def _forward(costs: list[int], sign: str) -> list[int]:
    """Least costs of the states after a turn and what may be inserted after it."""
    cut = CUT if sign.isupper() else 0
    out = [c + DELETE for c in costs]
    if sign != "-":
        for q, c in enumerate(costs):
            for to, cost in _kept(q, sign):
                out[to] = min(out[to], c + cost + cut)
    return _inserted(out)


def _kept(q: int, sign: str) -> Iterator[tuple[int, int]]:
    """Where a turn that isn't deleted leads to from a state, kept or given the role that the state wants."""
    own = sign.lower()
    if own == WANTS[q]:
        yield NEXT[q], KEEP
    if own == "s" and q == 0:
        yield AFTER_SYSTEM, KEEP
    yield NEXT[q], REROLE


def _inserted(costs: list[int]) -> list[int]:
    a, b, c, d = costs
    two = min(c, a + INSERT, b + INSERT, d + INSERT)
    return [a, b, two, min(d, two + INSERT)]


def _backward(costs: list[int], sign: str) -> list[int]:
    """Least costs from the states before a turn to the end, from those after it."""
    cut = CUT if sign.isupper() else 0
    out = [c + DELETE for c in costs]
    if sign != "-":
        for q in range(4):
            for to, cost in _kept(q, sign):
                out[q] = min(out[q], cost + cut + costs[to])
    return _before_inserts(out)


def _before_inserts(costs: list[int]) -> list[int]:
    a, b, c, d = costs
    two, three = min(c, d + INSERT), min(d, c + INSERT)
    return [min(a, two + INSERT), min(b, two + INSERT), two, three]


def repair(signs: str) -> tuple[int, list[str], list[str]]:
    """The least cost; for each turn its letter, `K`, `D`, or `u` or `a` for the role it gets; and what is inserted before
    each turn, then at the end, as a string of `u` and `a`.

    Backward costs are kept at each block's end and found again block by block, so memory is a few bytes for a turn.
    """
    n = len(signs)
    ends = [_before_inserts([0 if q in ENDS else FAR for q in range(4)])]
    for start in range((n - 1) // BLOCK * BLOCK, 0, -BLOCK):
        costs = ends[-1]
        for sign in reversed(signs[start : start + BLOCK]):
            costs = _backward(costs, sign)
        ends.append(costs)
    ends.reverse()
    edits, inserts, pending = [], [], ""
    forward, frontier, best = _inserted([0, FAR, FAR, FAR]), {0}, None
    for block, start in enumerate(range(0, max(n, 1), BLOCK)):
        piece = signs[start : start + BLOCK]
        back = [ends[block]]
        for sign in reversed(piece):
            back.append(_backward(back[-1], sign))
        back.reverse()
        if best is None:
            best = back[0][0]
        k = 0
        while k <= len(piece):
            if k == len(piece):
                if start + k < n:
                    break
                if any(q in ENDS and forward[q] == best for q in frontier):
                    break
            tight = lambda q, cost, to, costs: forward[q] + cost + costs[to] == best  # noqa: E731, B023
            sign = piece[k] if k < len(piece) else ""
            if sign and (kept := {q for q in frontier if tight(q, DELETE, q, back[k + 1])}):
                letter = "D"
            elif kept := {NEXT[q] for q in frontier if tight(q, INSERT, NEXT[q], back[k])}:
                pending += WANTS[next(q for q in frontier if tight(q, INSERT, NEXT[q], back[k]))]
                frontier = kept
                continue
            else:
                cut = CUT if sign.isupper() else 0
                for letter, price in (("K", KEEP), ("R", REROLE)):
                    kept = {to for q in frontier for to, cost in _kept(q, sign) if cost == price and tight(q, cost + cut, to, back[k + 1])}
                    if kept:
                        break
                if letter == "R":
                    letter = WANTS[next(q for q in frontier if tight(q, REROLE + cut, NEXT[q], back[k + 1]))]
            edits.append(letter)
            inserts.append(pending)
            pending, frontier = "", kept
            forward = _forward(forward, sign)
            k += 1
    return best or 0, edits, [*inserts, pending]


def edited_blocks(turns: DataFrame) -> DataFrame:
    """For each conversation and block of places the edits of its turns in order, and what is inserted before each.

    Returns conv_id, block, edits (a character each: K, D, u, a), inserts (comma-joined), trailing (the role letters inserted
    at the end, in the last block), cost and audit (the letters of this block's edits).
    """
    blocks = turns.groupBy("conv_id", F.shiftright("place", BITS).alias("block")).agg(F.sort_array(F.collect_list(F.struct("place", "sign"))).alias("turns"))
    signs = blocks.select("conv_id", F.struct("block", F.concat_ws("", "turns.sign").alias("signs")).alias("part"))
    # Signs are few bytes but much work, so the number of tasks must not follow their size.
    spread = signs.repartition(int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")), "conv_id")
    whole = spread.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts")).select("conv_id", "parts.block", "parts.signs")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                numbers, pieces = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                cost, edits, inserts = repair("".join(pieces))
                rows, at = [], 0
                for number, piece in zip(numbers, pieces, strict=True):
                    own, before = edits[at : at + len(piece)], inserts[at : at + len(piece)]
                    at += len(piece)
                    trailing = inserts[-1] if at == len(edits) else ""
                    audit = "".join("I" * len(b) + ("R" if e in "ua" else e) for e, b in zip(own, before, strict=True)) + "I" * len(trailing)
                    rows.append((number, "".join(own), ",".join(before), trailing, cost, audit))
                columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)]
                conv = pa.array([batch.column(0)[i].as_py()] * len(rows), batch.column(0).type)
                yield pa.RecordBatch.from_arrays([conv, *columns], names=["conv_id", "block", "edits", "inserts", "trailing", "cost", "audit"])

    kind = turns.schema["conv_id"].dataType.simpleString()
    return whole.mapInArrow(edit, f"conv_id {kind}, block long, edits string, inserts string, trailing string, cost long, audit string")


def repaired_turns(turns: DataFrame, blocks: DataFrame) -> DataFrame:
    """The repaired conversations, from ordered_turns and edited_blocks: conv_id, place, sub, edit, role, text.

    Rows are ordered by place and sub: what is inserted before a turn has its place and a negative sub, what is inserted at
    the end a positive one. Deleted turns are not there; edit is K, R or I.
    """
    at = F.col("place") - F.min("place").over(Window.partitionBy("conv_id", "block"))
    rows = turns.withColumn("block", F.shiftright("place", BITS)).withColumn("at", at.cast("int"))
    last = F.max("place").over(Window.partitionBy("conv_id", "block"))
    met = rows.withColumn("last", last == F.col("place")).alias("t").join(blocks.alias("b"), F.col("t.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("t.block") == F.col("b.block")))
    own, before = F.substring("b.edits", 1, BLOCK), F.split("b.inserts", ",")
    edit = F.substr(own, F.col("t.at") + 1, F.lit(1))
    name = lambda x: F.when(x == "u", "user").otherwise("assistant")
    added = lambda letters, first: F.transform(F.filter(F.split(letters, ""), lambda x: x != ""), lambda x, i: F.struct((i + first).cast("int").alias("sub"), F.lit("I").alias("edit"), name(x).alias("role"), F.lit("").alias("text")))
    itself = F.array(F.struct(F.lit(0).alias("sub"), F.when(edit == "K", "K").otherwise("R").alias("edit"), F.when(edit == "K", F.col("t.role")).otherwise(name(edit)).alias("role"), F.col("t.text").alias("text")))
    here = F.get(before, F.col("t.at"))
    parts = F.concat(
        added(here, -F.length(here)),
        F.when(edit != "D", itself).otherwise(F.slice(itself, 1, 0)),
        F.when(F.col("t.last"), added(F.col("b.trailing"), F.lit(1))).otherwise(F.slice(itself, 1, 0)),
    )
    return met.select(F.col("t.conv_id").alias("conv_id"), F.col("t.place").alias("place"), F.inline(parts))


def conversation_report(rows: DataFrame, turns: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row for each conversation of `rows`: gaps, blank, duplicate, truncated, illegal, cost, audit.

    Zeros and an empty audit where no turn is left.
    """
    count = lambda kind: F.count(F.when(F.col("fault") == kind, 1)).alias(kind)
    # Neighbours within blocks first, then each block's ends with those of the next.
    pairs = turns.groupBy("conv_id", F.shiftright("place", BITS).alias("block")).agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "initial"))), lambda x: x["initial"]).alias("roles"))
    bad = lambda a, b: ~F.concat(a, b).isin("su", "ua", "au")
    inside = F.aggregate(F.sequence(F.lit(1), F.size("roles")), F.lit(0), lambda n, i: n + F.when((i > 1) & bad(F.get("roles", i - 2), F.get("roles", i - 1)), 1).otherwise(0))
    ends = pairs.select("conv_id", F.struct("block", F.get("roles", F.lit(0)).alias("first"), F.element_at("roles", -1).alias("last")).alias("ends"), inside.alias("inside"))
    joined = ends.groupBy("conv_id").agg(F.sort_array(F.collect_list("ends")).alias("ends"), F.sum("inside").alias("inside"))
    across = F.aggregate(F.sequence(F.lit(1), F.size("ends")), F.lit(0), lambda n, i: n + F.when((i > 1) & bad(F.get("ends", i - 2)["last"], F.get("ends", i - 1)["first"]), 1).otherwise(0))
    illegal = joined.select("conv_id", (F.col("inside") + across).alias("illegal"))
    spans = turns.groupBy("conv_id", "turn").agg(count("blank"), count("duplicate"), count("truncated"))
    totals = spans.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated"))
    )
    audits = blocks.groupBy("conv_id").agg(F.max("cost").alias("cost"), F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"])).alias("audit"))
    # One row for a conversation from each: null ids meet, so no join that would lose them.
    out = rows.select("conv_id").distinct()
    for part in (totals, illegal, audits):
        part = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(part, out["conv_id"].eqNullSafe(part["_conv"]), "left").drop("_conv")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"))


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of the repaired `role:text`, joined by newlines, where any turn is left.

    A SHA-256 has no parts, so a conversation's texts pass one task, one after the other and none of them kept.
    """
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for own, role, text in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if state is None or own != conv:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = own, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role.as_py()}:{text.as_py()}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], batch.column(0).type), pa.array([x[1] for x in done], pa.string())], names=["conv_id", "repaired_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], ids), pa.array([state.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])

    ids = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    rows = repaired.select("conv_id", "role", "text", "place", "sub").repartition("conv_id").sortWithinPartitions("conv_id", "place", "sub")
    return rows.select("conv_id", "role", "text").mapInArrow(digest, f"conv_id {kind}, repaired_sha256 string")


def audited(rows: DataFrame) -> DataFrame:
    """conversation_report of `rows` (conv_id, turn, role, text) after damaged(), with repaired_sha256.

    Rows without a conversation are one conversation, whose id stays null; null turns come first and are no gaps; equal
    turns are ordered by role and text; null roles and texts are one space. A role is judged by its initial, and one
    without an initial is never legal. Repeated rows are turns of their own. Other columns are ignored.
    """
    turns = ordered_turns(damaged(rows), "row")
    blocks = written(edited_blocks(turns), "edits")
    digests = conversation_digests(repaired_turns(turns, blocks)).withColumnRenamed("conv_id", "_conv")
    report = conversation_report(rows, turns, blocks)
    out = report.join(digests, report["conv_id"].eqNullSafe(digests["_conv"]), "left")
    return out.select(*report.columns, F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
