"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into CELLS equal cells. Shards own virtual nodes, each at the start of a cell; a row's
home is the shard of the first virtual node at or after its cell. Shards hold at most their bound:
each admits rows of its own cells first, and the rows that overflow a full shard continue clockwise to
the next virtual node whose shard has room. Only the cells' counts, whose number is fixed, come to the
driver; where a row goes follows from its cell and its rank in it.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import COPIES, cut

#: Cells of the ring, and so the most rows of counts that the driver sees.
CELLS = 1 << 14
#: Virtual nodes of each shard.
NODES = 64


def ring(shards: int, nodes: int = NODES, cells: int = CELLS) -> np.ndarray:
    """The home shard of every cell. A further shard's nodes take cells and move none between the others."""
    owner = np.full(cells, -1, dtype=np.int64)
    for shard in range(shards):
        for node in range(nodes):
            at = xxhash.xxh64_intdigest(f"{shard}/{node}", 17) % cells
            if owner[at] < 0:  # of two nodes in a cell the smaller shard's stands
                owner[at] = shard
    for at in range(2 * cells - 1, -1, -1):
        here = at % cells
        if owner[here] < 0:
            owner[here] = owner[(here + 1) % cells]
    return owner


def assign(counts: np.ndarray, owner: np.ndarray, shards: int) -> list[tuple[int, int, int, int, int]]:
    """(cell, from rank, to rank, shard, first slot) for all rows of the cells; loads end at most one apart."""
    total = int(counts.sum())
    room = np.array([total // shards + (s < total % shards) for s in range(shards)], dtype=np.int64)
    slot = np.zeros(shards, dtype=np.int64)
    out, over = [], []

    def give(cell: int, lo: int, n: int, shard: int) -> None:
        out.append((cell, lo, lo + n, shard, int(slot[shard])))
        slot[shard] += n
        room[shard] -= n

    for cell in np.flatnonzero(counts).tolist():
        n, home = int(counts[cell]), int(owner[cell])
        own = min(n, int(room[home]))
        if own:
            give(cell, 0, own, home)
        if own < n:
            over.append((cell, own, n - own))
    stretches = np.flatnonzero(owner != np.roll(owner, 1))  # where another shard's stretch begins
    if not len(stretches):
        stretches = np.zeros(1, dtype=np.int64)
    roomy = stretches[room[owner[stretches]] > 0]
    for cell, lo, n in over:
        while n:
            at = int(np.searchsorted(roomy, cell, "right")) % len(roomy)
            shard = int(owner[roomy[at]])
            took = min(n, int(room[shard]))
            give(cell, lo, took, shard)
            lo, n = lo + took, n - took
            if not room[shard]:
                roomy = stretches[room[owner[stretches]] > 0]
    return out


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", nodes: int = NODES, cells: int = CELLS) -> DataFrame:
    """(id_col, size, text_crc32, cell, home, shard, slot) for every row of docs.

    The law is that of bounded loads with the tightest bound: the shards' row counts are at most one
    apart. A row's place on the ring is the hash of its id and text, so copies of a text spread out and
    null ids do not pile up; slots run from 0 without gaps in each shard. size: the text's UTF-8 bytes
    (null: none) plus 1; text_crc32: of these bytes (null: 0). Rows equal in id and text may trade
    places. Empty tables give empty results; other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = (
        docs.select(
            F.col(id_col).alias("id"), (F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
            F.xxhash64(F.lit("ring"), id_col, text_col).alias("place"),
        ).withColumn("cell", F.pmod("place", F.lit(cells)).cast("int"))
    )
    counts = np.zeros(cells, dtype=np.int64)
    # Rows equal in all of this are one row with their number, before they meet in their cell.
    same = cut(rows.groupBy("id", "size", "text_crc32", "place", "cell").agg(F.count(F.lit(1)).alias("n")))
    for cell, n in same.groupBy("cell").agg(F.sum("n")).collect():  # at most `cells` rows, whatever the input
        counts[cell] = n
    owner = ring(shards, nodes, cells)
    plan = assign(counts, owner, shards)
    table = spark.createDataFrame([(c, lo, hi, s, at) for c, lo, hi, s, at in plan] or [(-1, 0, 0, 0, 0)], "cell int, lo long, hi long, shard int, first long")
    homes = spark.createDataFrame([(i, int(s)) for i, s in enumerate(owner)], "cell int, home int")
    parts = table.groupBy("cell").agg(F.collect_list(F.struct("lo", "hi", "shard", "first")).alias("parts")).join(homes, "cell")
    before = Window.partitionBy("cell").orderBy("place", "id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    first = same.withColumn("rank", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # In parts, so that no array grows with the number of equal rows.
    parts_of = first.withColumn("end", F.col("rank") + F.col("n") - 1).withColumn("rank", F.explode(F.sequence(F.col("rank"), F.col("end"), F.lit(COPIES).cast("long"))))
    ranked = parts_of.withColumn("rank", F.explode(F.sequence(F.col("rank"), F.least(F.col("end"), F.col("rank") + COPIES - 1)))).drop("end")
    # One row for each cell: its size is bounded by the ring, not by the input.
    placed = ranked.join(F.broadcast(parts), "cell").withColumn("part", F.filter("parts", lambda p: (F.col("rank") >= p["lo"]) & (F.col("rank") < p["hi"]))[0])
    return placed.select(
        F.col("id").alias(id_col), "size", "text_crc32", "cell", "home", F.col("part.shard").alias("shard"), (F.col("part.first") + F.col("rank") - F.col("part.lo")).cast("long").alias("slot")
    )
