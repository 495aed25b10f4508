"""From group tables to a podium: qualification, slots and rounds.

The bracket has at most 32 teams, so each round is a small join; rounds follow one another as one plan each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def seeded(table: DataFrame, order: list[str], most: int) -> DataFrame:
    """The `most` best teams of a table by the columns, highest first, then team and group, with seeds from 1.

    The limit is a top-k of each partition; only the rows it leaves are numbered in one task.
    """
    by = [*(F.desc(c) for c in order), F.col("team"), F.col("grp")]
    return table.orderBy(*by).limit(most).withColumn("seed", F.row_number().over(Window.orderBy(*by)))


def qualified(table: DataFrame, group: str, thirds: int = 8) -> DataFrame:
    """First and second of each group, and the best thirds over all groups: team, group, pos, seed and how.

    There are as many rows as groups, about; so the window over all of them is small.
    """
    order = [F.desc("pts"), F.desc("dg"), F.desc("gf"), F.col("team"), F.col(group)]
    third = table.filter("pos = 3").orderBy(*order).limit(thirds)
    both = table.filter("pos <= 2").unionByName(third)
    how = F.when(F.col("pos") == 1, "first").when(F.col("pos") == 2, "second").otherwise("best third")
    return both.withColumn("how", how).withColumn("seed", F.row_number().over(Window.orderBy("pos", *order)))


def play_round(teams: DataFrame) -> DataFrame:
    """Best against worst seed of the teams left; of each pair the one with the higher strength (then seed) wins."""
    n = Window.partitionBy()
    placed = teams.withColumn("place", F.row_number().over(Window.orderBy("seed"))).withColumn("many", F.count("*").over(n))
    placed = placed.withColumn("match", F.least("place", F.col("many") + 1 - F.col("place")))
    rank = Window.partitionBy("match").orderBy(F.desc("strength"), "seed")
    return placed.withColumn("won", F.row_number().over(rank) == 1).drop("place", "many")
