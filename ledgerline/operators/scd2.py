"""Slowly changing dimensions of type 2: replay of an event log, application of a run, upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import islands


def periods(log: DataFrame, key: str, at: str, state: str, tie: str) -> DataFrame:
    """Periods of equal state: key, state, valid_from, valid_to (null: open), before (the state of the one before)."""
    starts = islands(log, key, [at, tie], state)
    after = F.lead(at).over(Window.partitionBy(key).orderBy(at, tie))
    return starts.select(key, state, F.col(at).alias("valid_from"), after.alias("valid_to"), F.col("_before").alias("before"))


def contiguity(spans: DataFrame, key: str) -> DataFrame:
    """For each key: periods, open ones, whether an open one isn't last, and ends that don't meet the next start."""
    w = Window.partitionBy(key).orderBy("valid_from")
    follows = F.lead("valid_from").over(w)
    marked = spans.withColumn("_next", follows)
    broken = F.col("_next").isNotNull() & ~F.col("valid_to").eqNullSafe(F.col("_next"))
    open_ = F.col("valid_to").isNull()
    total = lambda x: F.sum(x.cast("long"))
    return marked.groupBy(key).agg(F.count("*").alias("n_periods"), total(open_).alias("n_open"), total(broken).alias("n_broken"))


def apply_run(current: DataFrame, observed: DataFrame, key: str, state: str, at: str) -> DataFrame:
    """What a run does to each key: created, changed, confirmed, stale (out of order) or untouched.

    A key that the run doesn't have stays; an equal state may not be older than the last observation, and a changed one
    must be newer.
    """
    a = current.select(key, F.col(state).alias("old_state"), F.col(at).alias("last_at"))
    b = observed.select(key, F.col(state).alias("new_state"), F.col(at).alias("seen_at"))
    same = F.col("old_state").eqNullSafe(F.col("new_state"))
    action = (
        F.when(F.col("seen_at").isNull(), "untouched")
        .when(F.col("last_at").isNull(), "created")
        .when(same & (F.col("seen_at") < F.col("last_at")), "stale")
        .when(~same & (F.col("seen_at") <= F.col("last_at")), "stale")
        .when(same, "confirmed")
        .otherwise("changed")
    )
    return a.join(b, key, "full").withColumn("action", action)


def upsert(stored: DataFrame, batch: DataFrame, key: list[str], immutable: bool = False) -> DataFrame:
    """The table after a batch, with what happened to each row: created, updated, replayed, kept or (immutable) conflict."""
    values = [c for c in stored.columns if c not in key]
    a, b = stored.withColumn("_a", F.lit(True)).alias("a"), batch.withColumn("_b", F.lit(True)).alias("b")
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    action = F.when(F.col("b._b").isNull(), "kept").when(F.col("a._a").isNull(), "created").when(same, "replayed").otherwise("conflict" if immutable else "updated")
    joined = a.join(b, key, "full")
    new = F.col("b._b").isNotNull() & ((action != "conflict") if immutable else F.lit(True))
    return joined.select(*key, *(F.when(new, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in values), action.alias("action"))


def preserved(base: Column, stored: Column, when: Column) -> Column:
    """The stored value where a condition holds and it isn't null, else the base value."""
    return F.when(when & stored.isNotNull(), stored).otherwise(base)


def merge_run(history: DataFrame, run: DataFrame, key: str, state: str, at: str, gate: DataFrame | None = None) -> DataFrame:
    """The history after a run: key, state, valid_from, valid_to, last_observed and action.

    `history` has one open period (valid_to null) for each key at most, `run` one row for each key. A new key opens a
    period, an equal state refreshes last_observed, another one closes the open period and opens the next; a stale
    observation and a key that the run doesn't have change nothing. `gate`, a table of one row (rejected), keeps the
    whole run out where that is true: all or nothing. One join; closed periods don't take part in it.
    """
    columns = [key, state, "valid_from", "valid_to", "last_observed"]
    open_ = history.filter("valid_to is null").select(F.col(key), F.col(state).alias("_old"), F.col("valid_from").alias("_from"), F.col("last_observed").alias("_last"))
    seen = run.select(F.col(key), F.col(state).alias("_new"), F.col(at).alias("_at"))
    joined = open_.join(seen, key, "full")
    if gate is not None:
        # The gate is one row.
        joined = joined.crossJoin(F.broadcast(gate)).withColumn("_at", F.when(~F.col("rejected"), F.col("_at"))).filter("_last is not null or _at is not null")
    same, last, now = F.col("_old").eqNullSafe(F.col("_new")), F.col("_last"), F.col("_at")
    action = F.when(now.isNull(), "untouched").when(last.isNull(), "created").when((same & (now < last)) | (~same & (now <= last)), "stale").when(same, "confirmed").otherwise("changed")
    period = lambda state_, from_, to, seen_: F.struct(state_.alias(state), from_.alias("valid_from"), to.alias("valid_to"), seen_.alias("last_observed"))
    none = F.lit(None).cast(history.schema["valid_to"].dataType)
    before, opened = period(F.col("_old"), F.col("_from"), none, last), period(F.col("_new"), now, none, now)
    out = (
        F.when(F.col("action") == "created", F.array(opened))
        .when(F.col("action") == "changed", F.array(period(F.col("_old"), F.col("_from"), now, last), opened))
        .when(F.col("action") == "confirmed", F.array(period(F.col("_old"), F.col("_from"), none, now)))
        .otherwise(F.array(before))
    )
    merged = joined.withColumn("action", action).select(key, F.explode(out).alias("_p"), "action").select(key, "_p.*", "action")
    return merged.unionByName(history.filter("valid_to is not null").select(*columns, F.lit("closed").alias("action")))


def rule_counts(rows: DataFrame, **rules: Column) -> DataFrame:
    """rule, n: how many rows break each of the rules, in one pass over them; rules that none breaks come with 0."""
    counts = rows.agg(*(F.count_if(F.coalesce(broken, F.lit(False))).alias(name) for name, broken in rules.items()))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(x).alias("rule"), F.col(x).alias("n")) for x in rules))).alias("r")).select("r.rule", "r.n")
