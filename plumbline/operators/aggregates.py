"""Aggregates that Spark lacks, and frequency tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators import ranking


def trimmed_mean(x: Column) -> Column:
    """Mean without one smallest and one largest of more than two values."""
    n, total = F.count(x), F.sum(x)
    return F.when(n > 2, (total - F.min(x) - F.max(x)) / (n - 2)).when(n > 0, total / n)


def upper_medians(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """(by, name): the value in the middle of each group; of two, the larger. A large group is counted in buckets, as in ranking.medians()."""
    return ranking.medians(df, by, value, name, upper=True)


def effective_n(weight: Column) -> Column:
    return F.sum(weight) * F.sum(weight) / F.sum(weight * weight)


def best(value: Column, order: Column, position: Column) -> Column:
    """The value with the largest order; of equals the one with the smallest position."""
    return F.max_by(value, F.struct(order, -position))


def row_summary(years: Sequence[Column]) -> dict[str, Column]:
    """Summaries of a row's yearly values, oldest first: years, listed, latest, average (half to even), best and easiest."""
    have = F.filter(F.array(*years), lambda v: v.isNotNull())
    total = F.aggregate(have, F.lit(0.0), lambda a, v: a + v)
    return {
        "years_matched": F.size(have), "ranks": F.array_join(F.transform(have, lambda v: v.cast("string")), ";"), "latest_rank": F.coalesce(*reversed(list(years))),
        "avg_rank": F.when(F.size(have) > 0, F.bround(total / F.size(have)).cast("long")), "best_rank": F.array_min(have), "easiest_rank": F.array_max(have),
    }


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """(value, n), most frequent first, nulls as a value of their own."""
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("value"))


def tag_counts(df: DataFrame, tags: Column) -> DataFrame:
    """(tag, n) over an array column, most frequent first."""
    return df.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tag")


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[object]) -> DataFrame:
    """Counts by row and the listed column values, zero where there are none."""
    return df.groupBy(row).pivot(column, list(values)).count().na.fill(0)


def facet_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(facet, values): sorted distinct values of each column, blanks left out. Distinct before collecting."""
    out = None
    for c in columns:
        v = df.select(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")).where("value <> ''").distinct()
        out = v if out is None else out.unionByName(v)
    return out.groupBy("facet").agg(F.array_sort(F.collect_list("value")).alias("values"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def single_valued(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) of the keys that have exactly one value."""
    return df.where(F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias("value"), F.max(value).alias("_max")).where("value = _max").drop("_max")


def coverage(df: DataFrame, entries: Column, total: str = "rows") -> DataFrame:
    """(label, n, share, confidences): of an array of (label, confidence), rows that have the label and how sure they are."""
    n = df.agg(F.count(F.lit(1)).alias("all"))
    each = df.select(F.explode(entries).alias("e")).select("e.label", "e.confidence")
    by = each.groupBy("label", "confidence").agg(F.count(F.lit(1)).alias("k"))
    grouped = by.groupBy("label").agg(F.sum("k").alias("n"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("confidence", F.lit("")), "k")))).alias("confidences"))
    return grouped.join(F.broadcast(n)).select("label", "n", (F.col("n") / F.col("all")).alias("share"), "confidences")  # one row is broadcast


def windows_of(df: DataFrame, order: str, size: int, *aggregates: Column) -> DataFrame:
    """Aggregates over runs of so many consecutive positions, counted from 1."""
    return df.groupBy((F.floor((F.col(order) - 1) / size) + 1).cast("long").alias("window")).agg(*aggregates)
