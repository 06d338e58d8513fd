"""What the operators of this package share: reading tables, cutting lineage, words and digits."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.sources.storage import settle as cut

__all__ = ["cut", "met", "repeated", "table", "unsigned", "within", "word_count"]

#: Copies of a row that one task makes.
COPIES = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def unsigned(h: str | Column) -> Column:
    """A signed 64-bit value as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(h), 16, "0"))


def repeated(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column times says, without that column; the copies of a row are dealt to tasks in parts."""
    parts = df.where(F.col(times) > 0).withColumn("_lo", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col(times) - 1, F.lit(0).cast("long")), F.lit(COPIES).cast("long"))))
    dealt = parts.repartition(F.xxhash64("_lo", times))
    return dealt.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES).cast("long"), F.col(times) - F.col("_lo"))))).drop("_lo", "_k", times)


def within(docs: DataFrame, known: DataFrame, per_class: int, features: int, bound: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, y, text): a sample of the labelled rows known (doc_id, y 0 or 1), of rows that repeat an id one.

    Of each class the first per_class rows by a hash of their id, as long as the bounds of their features, which bound
    gives for a text's size in bytes, add up to at most features. So the sample is bounded in rows and in memory, and
    the texts that are in it are there with all of their features.
    """
    place = F.xxhash64(F.lit("sample"), "doc_id")
    picked = known.where("y = 0").orderBy(place).limit(per_class).union(known.where("y = 1").orderBy(place).limit(per_class))
    # At most 2 * per_class rows of two numbers are broadcast.
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    sizes = texts.groupBy("doc_id").agg(F.max("y").alias("y"), bound(F.max(F.octet_length(F.coalesce("text", F.lit(""))))).cast("long").alias("n"))
    before = Window.partitionBy("y").orderBy(place, "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where((F.col("before") == 0) | (F.col("before") + F.col("n") <= features))
    return docs.select("doc_id", "text").join(F.broadcast(cut(first.select("doc_id", "y"))), "doc_id").groupBy("doc_id").agg(F.max("y").alias("y"), F.min("text").alias("text"))


#: Rows of a key from which it is hot, at least, and hot keys at most.
HOT_ROWS, HOT_KEYS = 10_000, 4096


def met(rows: DataFrame, table: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """rows joined to the one row of table that each has by its keys; count: a column of table, how many rows have the key.

    Keys with more than HOT_ROWS rows and a HOT_KEYSth part of all, so at most HOT_KEYS, are broadcast, and their rows
    stay where they are. The count is not returned. Keys have no nulls.
    """
    hot = max(HOT_ROWS, -(-(table.agg(F.sum(count)).first()[0] or 0) // HOT_KEYS))
    often, seldom = table.where(F.col(count) >= hot).drop(count), table.where(F.col(count) < hot).drop(count)
    if often.isEmpty():
        return rows.join(seldom, list(keys))
    return rows.join(F.broadcast(often), list(keys)).unionByName(rows.join(F.broadcast(often.select(*keys)), list(keys), "left_anti").join(seldom, list(keys)))
