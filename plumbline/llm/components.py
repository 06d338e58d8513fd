"""Connected components of a table of links, without collecting links or nodes anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut, met


#: Nodes in the middle that are broadcast; of more, each goes to as many salts, as a root may have any number of links.
MIDDLE_ROWS, SALTS = 100_000, 32


def _middle(links: DataFrame) -> DataFrame:
    """(node, low) of the nodes that have larger and smaller neighbours; links have a > b."""
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    return cut(low.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select(F.col("a").alias("node"), "low"))


def _large_star(links: DataFrame, middle: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of its neighbours and itself, which differs for nodes in the middle only."""
    if middle.limit(MIDDLE_ROWS + 1).count() <= MIDDLE_ROWS:
        joined = links.join(F.broadcast(middle), F.col("b") == F.col("node"), "left")
    else:
        spread = middle.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = links.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS))).join(spread, (F.col("b") == F.col("node")) & (F.col("salt") == F.col("_salt")), "left")
    return joined.select("a", F.coalesce("low", "b").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and itself, are linked to the smallest of them; links have a > b."""
    low = cut(links.groupBy("a").agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("n")))
    moved = met(links, low, ["a"], "n").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a long, b long); component is the smallest node reachable.

    Alternates the two star operations, each of which keeps the components, until every node is
    linked to a root that has no further link. Self-links and repeated links are allowed; nulls are
    dropped; no links give no rows. Each round is written to the checkpoint folder.
    """
    now = cut(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while True:
        middle = _middle(now)
        several = now.groupBy("a").count().where("count > 1")
        if middle.isEmpty() and several.isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        now = cut(_small_star(_large_star(now, middle)))
