"""Mixing sources to target weights by hash-threshold histograms.

Every row gets a 64-bit hash. For each source the tokens are summed by the hash's leading bits; the
budget's threshold falls into one bucket of that histogram, and only this boundary bucket is refined,
by the hash's next bits. Rows below the final threshold are taken, so no row is ever sorted, and the
rows of a smaller budget are among the rows of a larger one. Rows that no bit tells apart are repeated
rows; of those at the threshold as many are taken as come nearest to the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import cut, repeated, word_count

#: Bits of the hash that each level of the histogram adds.
BITS = 12
#: Levels of the histogram. Five cover 60 bits: rows that still share a bucket are counted.
LEVELS = 5
#: Sources whose plan is broadcast, and salts of a longer plan.
BROADCAST_ROWS, SALTS = 10_000, 64
#: Largest multiple of its tokens that a source's target reaches.
CAP = 3.0
#: Weights by the rank of the source, repeating.
WEIGHTS = (1.0, 2.0, 3.0)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row for each source.

    Sources by code point, null last, weigh the weights in turn and share the total of all sizes by
    weight. No target exceeds cap times its source's size: the excess is shared again by weight until
    none is above, which is the water level found here from sources ordered by size over weight. Both
    orders are ranges of sources, with one row for each range where their sums meet.
    """
    places = _running(sizes, [F.col("source").asc_nulls_last()], {"place": F.lit(1)})
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place"), F.lit(len(weights))) + 1).cast("int"))
    weighed = places.select("source", "source_size", turn.alias("w")).withColumn("ratio", F.col("source_size") / F.col("w"))
    sums = _running(weighed, [F.col("ratio"), F.col("source").asc_nulls_last()], {"size_before": F.col("source_size"), "w_before": F.col("w")})
    whole = weighed.agg(F.sum("source_size").alias("total"), F.sum("w").alias("w")).first()
    total, w = whole["total"] or 0, whole["w"] or 0.0
    level = (F.lit(float(total)) - F.lit(cap) * F.col("size_before")) / (F.lit(w) - F.col("w_before"))
    fits = F.when(level * F.col("w") <= F.lit(cap) * F.col("source_size"), F.struct("ratio", F.col("source").isNull().alias("no_source"), "source", level.alias("level")))
    # The first source, from the tightest on, that stays within its cap sets the level of all from there on.
    first = sums.agg(F.min(fits).alias("first")).first()["first"]
    share = F.lit(cap) * F.col("source_size") if first is None else F.least(F.lit(cap) * F.col("source_size"), F.lit(first["level"]) * F.col("w"))
    return sums.select("source", "source_size", share.alias("target"))


def _running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """df with the sums over all rows before each by the order, which must be total: inside ranges, and of ranges."""
    parts = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range.
    ranges = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    of_ranges = parts.groupBy("_part").agg(*[F.sum(c).alias(n) for n, c in sums.items()]).select("_part", *[F.coalesce(F.sum(n).over(ranges), F.lit(0)).alias(f"_{n}") for n in sums])
    return parts.join(F.broadcast(of_ranges), "_part").select(*df.columns, *[(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_{n}")).alias(n) for n, c in sums.items()])


def _by_source(rows: DataFrame, plan: DataFrame, source: str, salt: Column) -> DataFrame:
    """rows as r joined to plan, one row for each source, as q.

    A plan of at most BROADCAST_ROWS rows is broadcast; a longer one is repeated for SALTS salts, so that
    a source with a large part of all rows meets its plan in as many tasks.
    """
    if plan.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.alias("r").join(F.broadcast(plan).alias("q"), F.col(source).eqNullSafe(F.col("q.source")))
    spread = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.alias("r").join(spread.alias("q"), F.col(source).eqNullSafe(F.col("q.source")) & (F.pmod(salt, F.lit(SALTS)) == F.col("q._salt")))


def thresholds(rows: DataFrame, budgets: DataFrame, bits: int = BITS, levels: int = LEVELS) -> DataFrame:
    """(source, below, extra): rows of a source with u < below, and extra rows with u = below, sum up as close to the budget as may be.

    rows: (source, size, u), u in [0, 2**(bits * levels)); budgets: (source, budget). The first level reads
    all rows; what falls into the boundary buckets, a small share, is added up by u, written and alone read
    by the levels after it. extra is 0 unless several rows share the u at the threshold.
    """
    now = budgets.select("source", "budget", F.lit(0).cast("long").alias("lo"), F.lit(0).cast("double").alias("had"), F.lit(0).cast("long").alias("extra"))
    inside = rows.select("source", "size", "u", F.lit(1).cast("long").alias("n"))
    for level in range(levels):
        width = 1 << (bits * (levels - 1 - level))
        hist = inside.groupBy("source", F.shiftright("u", bits * (levels - 1 - level)).alias("k")).agg(F.sum("size").alias("tokens"), F.sum("n").alias("n"))
        # Buckets of a source, at most 2**bits of them, meet its budget.
        known = hist.alias("h").join(now.alias("q"), F.col("h.source").eqNullSafe(F.col("q.source"))).select("h.source", "k", "tokens", "n", "budget", "lo", "had")
        running = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = known.withColumn("upto", F.col("had") + F.sum("tokens").over(running))
        # The boundary bucket is the first that reaches the budget; without one the whole range is taken.
        edge = sums.groupBy("source").agg(
            F.first("budget").alias("budget"), F.first("lo").alias("lo"), F.first("had").alias("had"),
            F.min_by(F.struct("k", (F.col("upto") - F.col("tokens")).alias("had"), "tokens", "n"), F.when(F.col("upto") >= F.col("budget"), F.col("k"))).alias("edge"),
            F.max("upto").alias("all"),
        )
        at, extra = F.col("edge.k") * F.lit(width), F.lit(0)
        if level == levels - 1:  # as many of the rows that still share the bucket as come nearest to the budget
            share = F.ceil((F.col("budget") - F.col("edge.had")) * F.col("edge.n") / F.col("edge.tokens") - 0.5)
            taken = F.greatest(F.lit(0).cast("long"), F.least(F.col("edge.n"), share))
            at, extra = at + F.when(taken == F.col("edge.n"), F.lit(width)).otherwise(F.lit(0)), F.when(taken < F.col("edge.n"), taken).otherwise(F.lit(0))
        now = cut(
            edge.select(
                "source", "budget",
                F.when(F.col("edge").isNull(), F.col("lo") + F.lit(width << bits)).otherwise(at).alias("lo"),
                F.when(F.col("edge").isNull(), F.col("all")).otherwise(F.col("edge.had")).alias("had"),
                F.when(F.col("edge").isNull(), F.lit(0)).otherwise(extra).cast("long").alias("extra"),
            )
        )
        if level < levels - 1:
            found = _by_source(inside, now, "r.source", F.col("u")).where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("lo") + F.lit(width)))
            inside = cut(found.groupBy("r.source", "u").agg(F.sum("size").alias("size"), F.sum("n").alias("n")))
    return now.select("source", F.col("lo").alias("below"), "extra")


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), _u(F.col(id_col), F.col(text_col), seed).alias("u")
    )


def _u(id_: Column, text: Column, seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_, text), 64 - BITS * LEVELS)


def _plan(rows: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """(source, source_size, target, whole, below, extra): copies of every row, and the threshold of one more copy."""
    wanted = cut(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    planned = wanted.withColumn("whole", whole.cast("int")).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    below = thresholds(rows.where("size > 0"), planned.where("budget > 0").select("source", "budget"))
    joined = planned.alias("p").join(below.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")), "left")
    return cut(joined.select("p.source", "source_size", "target", "whole", "below", F.coalesce("extra", F.lit(0)).alias("extra")))


def _shared(rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows (columns, source, whole, extra) at a threshold that several rows share, as often as before, with their copies.

    Rows equal in all columns are counted; each source gives one more copy to its first extra rows by a
    hash of the columns, and what is left of a count keeps its copies.
    """
    counted = rows.groupBy(*columns, "source", "whole", "extra").agg(F.count(F.lit(1)).alias("n")).withColumn("_hash", F.xxhash64(*columns))
    sums = cut(_running(counted, [F.col("source").asc_nulls_last(), F.col("_hash"), *[F.col(c).asc_nulls_last() for c in columns]], {"before": F.col("n")}))
    starts = sums.groupBy(F.col("source").alias("_of")).agg(F.min("before").alias("start"))
    placed = sums.join(starts, F.col("source").eqNullSafe(F.col("_of")))
    more = F.greatest(F.lit(0).cast("long"), F.least(F.col("n"), F.col("extra") - F.col("before") + F.col("start")))
    parts = F.explode(F.array(F.struct((F.col("whole") + 1).alias("copies"), more.alias("n")), F.struct(F.col("whole").alias("copies"), (F.col("n") - more).alias("n"))))
    return repeated(placed.select(*columns, parts.alias("_part")).select(*columns, "_part.copies", F.col("_part.n").alias("n")).where("n > 0"), "n")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, seed: int = 0) -> DataFrame:
    """(id_col, source, size, source_size, target, copies, taken) for every row of docs.

    size is the number of words; a null text has none. A target is met by whole copies of every row
    plus one more copy of the rows below the hash threshold of the remaining budget, so a row comes at
    most ceil(cap) times. The hash is of id, text and seed: reruns agree. Of rows equal in id, text and
    source at the threshold as many get the further copy as the budget wants. A null source is a source of
    its own. A source without words has target 0 and nothing is taken from it. Empty tables give empty
    results; other columns are not read.
    """
    rows = cut(_rows(docs, id_col, text_col, source_col, seed))
    plan = _plan(rows, weights, cap)
    copies = F.col("whole") + F.when(F.col("u") < F.col("below"), 1).otherwise(0)
    met = _by_source(rows, plan, "r.source", F.col("u")).select("id", F.col("r.source").alias("source"), "size", "source_size", "target", "whole", "extra", copies.alias("copies"), _at_threshold(F.col("size"), F.col("u")).alias("shared"))
    columns = ["id", "size", "source_size", "target"]
    out = met.where(~F.col("shared")).select(*columns, "source", "copies")
    if not plan.where("extra > 0").isEmpty():
        kept = met.where("shared").withColumn("own_source", F.col("source"))
        out = out.union(_shared(kept, [*columns, "own_source"]).select(*columns, "own_source", "copies"))
    return out.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", F.col("copies").cast("int").alias("copies"), (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def _at_threshold(size: Column, u: Column) -> Column:
    return F.coalesce((size > 0) & (u == F.col("below")) & (F.col("extra") > 0), F.lit(False))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, seed: int = 0) -> DataFrame:
    """docs as the mix takes them: each row as often as its copies say, columns unchanged.

    A row without words, which counts toward no target, stays once. Decisions are made from the same
    expressions as in mix(), on the row itself, so only the plan by source is joined. Of rows equal in id,
    text and source at a threshold those with the smallest hash of all columns come once more.
    """
    plan = _plan(cut(_rows(docs, id_col, text_col, source_col, seed).drop("id")), weights, cap)
    # Names of the rows' own columns cannot clash with those of the plan.
    own = docs.select(*[F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(docs.columns)])
    id_, text, source = (f"r.d{docs.columns.index(c)}" for c in (id_col, text_col, source_col))
    size, u = word_count(F.col(text)), _u(F.col(id_), F.col(text), seed)
    copies = F.when(size == 0, 1).otherwise(F.col("q.whole") + F.when(u < F.col("q.below"), 1).otherwise(0))
    joined = _by_source(own.withColumn("source", F.col(source.removeprefix("r.")).cast("string")), plan, "r.source", u)
    columns = [f"d{i}" for i in range(len(docs.columns))]
    named = [F.col(d).alias(c) for d, c in zip(columns, docs.columns, strict=True)]
    shared, times = _at_threshold(size, u), lambda n: F.explode(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: k <= n))
    out = joined.where(~shared).select(*[f"r.{d}" for d in columns], times(copies)).select(*named)
    if plan.where("extra > 0").isEmpty():
        return out
    kept = joined.where(shared).select(*[f"r.{d}" for d in columns], "r.source", "q.whole", "q.extra")
    return out.union(_shared(kept, columns).select(*columns, times(F.col("copies"))).select(*named))
