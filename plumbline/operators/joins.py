"""Joins with checks: lookups by unique keys, audits, differences and references.

No side is broadcast by hint: the sizes are the caller's, and adaptive execution broadcasts what is
small at run time and splits what is skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once and has no null or empty part. One aggregation with partial results, no window."""
    kept = df
    for k in keys:
        kept = kept.where(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    rest = [c for c in df.columns if c not in keys]
    row = F.first(F.struct(*rest)).alias("_row")
    return kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), row).where("_n = 1").select(*keys, "_row.*").select(*df.columns)


def lookup_unique(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to the right rows whose key occurs once there."""
    return left.join(unique_rows(right, keys), list(keys), "left")


def lookup_last(left: DataFrame, right: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """Left join to the last right row, by the order, of each key."""
    rest = [c for c in right.columns if c not in keys]
    last = right.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*")
    return left.join(last, list(keys), "left")


def outer_difference(expected: DataFrame, actual: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, side, changed): rows on one side only, and rows whose fields differ, with the fields' names.

    side is missing, extra or both. Nulls are equal to nulls.
    """
    left = expected.select(key, F.struct(*fields).alias("l"), F.lit(True).alias("_in_l"))
    right = actual.select(key, F.struct(*fields).alias("r"), F.lit(True).alias("_in_r"))
    both = left.join(right, key, "full_outer")
    names = F.array_compact(F.array(*[F.when(~F.col(f"l.`{f}`").eqNullSafe(F.col(f"r.`{f}`")), F.lit(f)) for f in fields]))
    side = F.when(F.col("_in_r").isNull(), "missing").when(F.col("_in_l").isNull(), "extra").otherwise("both")
    out = both.select(key, side.alias("side"), F.when(side == "both", names).otherwise(F.array().cast("array<string>")).alias("changed"))
    return out.where((F.col("side") != "both") | (F.size("changed") > 0))


def dangling(rows: DataFrame, ids: Column, known: DataFrame, key: str) -> DataFrame:
    """Rows with an id, of an array column, that the known table lacks; one output row for each, column ref."""
    listed = rows.withColumn("ref", F.explode(ids))
    return listed.join(known.select(F.col(key).alias("ref")).distinct(), "ref", "left_anti")


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join that fails unless each key of left has exactly one row on each side."""
    odd = left.groupBy(key).count().withColumnRenamed("count", "l").join(right.groupBy(key).count().withColumnRenamed("count", "r"), key, "left").where("l <> 1 or r is null or r <> 1")
    first = odd.limit(1).collect()
    if first:
        raise ValueError(f"key {first[0][0]!r} has {first[0]['l']} and {first[0]['r'] or 0} rows")
    return left.join(right, key)


def fill_missing(expected: DataFrame, actual: DataFrame, key: str, defaults: dict[str, object], order: str) -> DataFrame:
    """actual plus a row of defaults for each expected key that it lacks; shared columns come from expected."""
    absent = expected.join(actual.select(key), key, "left_anti")
    filled = absent.select(*[F.col(c) if c in expected.columns else F.lit(defaults.get(c, "")).cast(t).alias(c) for c, t in actual.dtypes])
    return actual.unionByName(filled).join(expected.select(key, F.col(order).alias("_order")), key, "left").orderBy("_order", key).drop("_order")


def repair(rows: DataFrame, truth: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """rows with the fields set to those of truth where it knows the key; n_changed counts a row's changes."""
    right = truth.select(key, *[F.col(f).alias(f"_t_{f}") for f in fields], F.lit(True).alias("_known"))
    joined = rows.join(right, key, "left")
    known = F.col("_known").isNotNull()
    changed = sum((F.when(known & ~F.col(f).eqNullSafe(F.col(f"_t_{f}")), 1).otherwise(0) for f in fields), F.lit(0))
    new = {f: F.when(known, F.col(f"_t_{f}")).otherwise(F.col(f)) for f in fields}
    return joined.withColumn("n_changed", changed).select(*[new[c].alias(c) if c in new else F.col(c) for c in rows.columns], "n_changed")
