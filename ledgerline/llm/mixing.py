"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks; DataFrame operations only.

Each source is a stream of words: its documents in a shuffled order, epoch after epoch, each epoch shuffled anew, and so
often as a target may exceed a source. The stream is cut into blocks of equal length. Of as many slots as blocks make up
all targets, slot k goes to the source whose share of the unit interval holds the golden-ratio point
frac((k + 1/2) / phi), and the r-th slot of a source takes its r-th block. So the schedule tells which blocks are in the
mix and in what order; a source's share is its target up to a few blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, all_columns, free_names, numbered_rows, written

GOLDEN = 0.6180339887498949
#: Words of a block: a SLOTS-th of the mix, so that a few blocks are little of any target, up to BLOCK words.
SLOTS, BLOCK = 65536, 1024
#: Parts of the targets' sum by which slots meet sources, and slots of which ranks are counted together.
CELLS, CHUNK = 4096, 65536


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Of `sizes` (source, size): source, place, source_size, target.

    Sources by code point, null last, weigh as `weights` repeats. They share all sizes by weight; a target stops at
    `most` times its source's size, and the excess goes to the others by weight. With the sources by how soon they
    stop, those that stop come first, and what the first of the others gets for a unit of weight holds for all others.
    """
    by_name, everything = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    before = Window.orderBy("soon", "place").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("place", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    shares = (
        totals.withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * most)
        .withColumn("soon", F.col("most") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
        .withColumn("level", F.max(F.when(F.col("soon") > F.col("level"), F.col("level"))).over(everything))
        .withColumn("target", F.least(F.col("most").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("most").cast("double"))))
    )
    return shares.select("source", "place", "source_size", "target")


def running(df: DataFrame, group: list[str], part: str, order: list[str], value: Column, out: str) -> DataFrame:
    """Adds `out`, the sum of `value` over the rows of `group` before the row, by `part` and then by `order`.

    No task needs a whole group: sums of the parts are added up first, then the rows of each part.
    """
    sums = df.groupBy(*group, part).agg(F.sum(value).alias("_sum"))
    ahead = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, part, F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy(*group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(sums, [*group, part]).withColumn(out, F.col("_ahead") + F.col("_inside")).drop("_ahead", "_inside")


def schedule(targets: DataFrame, words: int, block: int) -> DataFrame:
    """place, rank, slot: which slot takes the source's block of that rank; `words` is the sum of the quotas.

    Sources meet points in cells of the interval, so no task meets all sources with all points; the sums over all sources
    are windows over one row for each.
    """
    spark = targets.sparkSession
    width = words // CELLS + 1
    hi = F.sum("quota").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    spans = targets.filter("quota > 0").select("place", hi.alias("hi"), (hi - F.col("quota")).alias("lo"))
    cell = lambda x: F.floor(x / width)
    cells = spans.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1))))
    slots = (words + block // 2) // block
    point = F.floor(((F.col("id") + 0.5) * GOLDEN % 1.0) * words)
    points = spark.range(0, slots, 1, max(1, -(-slots // 1_000_000))).select(F.col("id").alias("slot"), point.alias("point"))
    met = points.withColumn("cell", cell(F.col("point"))).join(cells, "cell").filter("point >= lo and point < hi")
    ranked = running(met.select("place", "slot", F.floor(F.col("slot") / CHUNK).alias("chunk")), ["place"], "chunk", ["slot"], F.lit(1), "rank")
    return ranked.select("place", "rank", "slot")


def mix(sizes: DataFrame, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """The mix of `sizes` (row, doc_id, source, size), as two tables.

    The first has each row with source_size and target. The second has the pieces of the mix: row, epoch, slot (the mix
    is in order of slot, place, from_word), place, from_word and n_words.
    """
    targets = written(source_targets(sizes.select("source", "size"), most=most).withColumn("quota", F.round("target").cast("long")), "targets")
    words = targets.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    block = max(1, min(BLOCK, words // SLOTS))
    slots = written(schedule(targets, words, block), "slots")
    # What a source gets by its slots, at most all of its stream.
    given = targets.join(slots.groupBy("place").agg((F.count("*") * block).alias("given")), "place").withColumn("given", F.least("given", F.col("source_size") * most))
    rows = written(sizes.join(targets, sizes.source.eqNullSafe(targets.source)).select("row", "doc_id", "size", "place", "source_size", "target"), "rows")
    turns = rows.filter("size > 0").join(given.select("place", "given"), "place").filter("given > 0")
    turns = turns.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("given") / F.col("source_size")) - 1)))
    turns = turns.withColumn("shuffled", F.md5(F.concat(F.col("epoch").cast("string"), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    turns = turns.withColumn("part", F.substring("shuffled", 1, 3))
    placed = running(turns, ["place", "epoch"], "part", ["shuffled", "size", "row"], F.col("size"), "ahead")
    placed = placed.withColumn("start", F.col("epoch") * F.col("source_size") + F.col("ahead")).filter("start < given")
    placed = placed.withColumn("end", F.least(F.col("start") + F.col("size"), F.col("given")))
    pieces = placed.withColumn("rank", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))))
    first, last = F.greatest("start", F.col("rank") * block), F.least("end", (F.col("rank") + 1) * block)
    pieces = pieces.select("row", "epoch", "place", "rank", (first - F.col("start")).alias("from_word"), (last - first).alias("n_words"))
    return rows, pieces.join(slots, ["place", "rank"]).select("row", "epoch", "slot", "place", "from_word", "n_words")


def _sizes(docs: DataFrame, row: str, id_col: str, source_col: str, text_col: str) -> DataFrame:
    return written(docs.select(F.col(row).alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), "sizes")


def mixed_words(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """How many words the mix takes of each document.

    Returns one row for each row of `docs`: doc_id, size (words; null or empty text: 0), source_size, target, taken and
    first_slot (null where nothing is taken). A null source is a source. Null ids are shuffled alike; repeated rows are
    separate documents, of which equals may swap. Other columns are ignored. Reruns agree.
    """
    row, staged = numbered_rows(docs, "row_of_mix")
    rows, pieces = mix(_sizes(staged, row, id_col, source_col, text_col))
    taken = pieces.groupBy("row").agg(F.sum("n_words").alias("taken"), F.min("slot").alias("first_slot"))
    return rows.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot")


def mixed_documents(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents of the mix with the columns of `docs`: one row for each epoch in which a document is taken.

    The rows are in the order of the mix, that of the slots in which the documents begin, partition after partition. A
    document where its source's words end, of which only some words are taken, has the text of these words, separated by
    single spaces. Nulls and repeated rows are treated as in mixed_words; documents without words have no row.
    """
    row, taken, size, slot, place = free_names(docs, "row_of_mix", "taken_of_mix", "size_of_mix", "slot_of_mix", "place_of_mix")
    row, staged = numbered_rows(docs, row)
    rows, pieces = mix(_sizes(staged, row, id_col, source_col, text_col))
    begin = F.min(F.struct("slot", "place", "from_word"))
    turns = pieces.groupBy("row", "epoch").agg(F.sum("n_words").alias(taken), begin.alias("begin")).join(rows.select("row", F.col("size").alias(size)), "row")
    turns = turns.select(F.col("row").alias(row), taken, size, F.col("begin.slot").alias(slot), F.col("begin.place").alias(place))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)), F.lit(1), F.col(taken).cast("int")), " ")
    whole = staged.join(turns, row).withColumn(text_col, F.when(F.col(taken) < F.col(size), cut).otherwise(F.col(text_col)))
    ordered = whole.repartitionByRange(F.col(slot), F.col(place)).sortWithinPartitions(slot, place)
    return ordered.select(*all_columns(docs))
