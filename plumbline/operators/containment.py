"""Pairs of keys of which one holds the other, by an inverted index of q-grams.

A key that is held in another has all of its grams there, so its rarest one is enough to find the other:
each shorter key asks the index for that one gram only, and what comes back is compared. Pairs that are
compared stay close to pairs that are found, however many keys a group has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.sources.storage import settle

#: Characters of a gram; shorter keys are grams themselves.
Q = 3


def grams(key: Column, n: Column | int) -> Column:
    """The different runs of n characters of a key that has at least so many."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(key) - n + 1), lambda i: F.substring(key, i, n)))


def held(shorter: DataFrame, longer: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, shorter, longer): each different shorter key with each different longer one of its group that holds it.

    shorter: (by, shorter); longer: (by, longer). Equal keys hold each other; empty and null keys, and keys of
    a null group, are left out.
    """
    few = shorter.where(F.length("shorter") > 0).distinct().withColumn("_size", F.least(F.lit(Q), F.length("shorter")))
    many = longer.where(F.length("longer") > 0).distinct()
    sizes = sorted(r["_size"] for r in few.select("_size").distinct().collect())  # at most Q
    index = None
    for n in sizes:
        own = many.where(F.length("longer") >= n).select(*by, "longer", F.explode(grams(F.col("longer"), n)).alias("_gram"))
        index = own if index is None else index.union(own)
    if index is None:
        return few.join(many, list(by)).select(*by, "shorter", "longer").limit(0)
    asked = few.select(*by, "shorter", F.explode(grams(F.col("shorter"), F.col("_size"))).alias("_gram"))
    counts = index.groupBy(*by, "_gram").agg(F.count(F.lit(1)).alias("_n"))
    known = asked.join(counts, [*by, "_gram"], "left")
    # A key one of whose grams no longer key has is held in none.
    rarest = known.groupBy(*by, "shorter").agg(F.min_by("_gram", F.struct("_n", "_gram")).alias("_gram"), F.count_if(F.col("_n").isNull()).alias("_absent")).where("_absent = 0").drop("_absent")
    return rarest.join(index, [*by, "_gram"]).where(F.contains("longer", "shorter")).select(*by, "shorter", "longer")


def contained(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, left, right): the different pairs of keys of a group of which one holds the other. left: (by, left); right: (by, right)."""
    inside = held(left.withColumnRenamed("left", "shorter"), right.withColumnRenamed("right", "longer"), by).select(*by, F.col("shorter").alias("left"), F.col("longer").alias("right"))
    around = held(right.withColumnRenamed("right", "shorter"), left.withColumnRenamed("left", "longer"), by).select(*by, F.col("longer").alias("left"), F.col("shorter").alias("right"))
    return settle(inside.union(around.where("left <> right")))
