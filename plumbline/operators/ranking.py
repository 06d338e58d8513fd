"""Ordered operators: numbering, tiers, running values, quotas, shards and pages.

Numbers over a whole table come from ranges, not from one window over all rows: the table is sorted into
ranges, rows are numbered inside them, and the ranges' counts, one row each, give the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.sources.storage import settle


def numbered(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """df with positions from 1 by the order, which must be total for the same result each time."""
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    # Written once, so that a row's range is the same wherever it is read.
    parts = settle(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", at))
    # The counts of ranges are as many rows as there are partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return parts.join(F.broadcast(offsets), "_part").withColumn(name, (F.col("_at") + F.col("_before") + 1).cast("long")).select(*df.columns, name)


def placed(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """df with _place from 1 and _size of its group: a large group is sorted in as many ranges as it needs. Nulls are a group."""
    keys = [F.col(b) for b in by]
    rows = numbered(df, [*(k.asc_nulls_first() for k in keys), *order], "_place")
    groups = rows.groupBy(*[k.alias(f"_by{i}") for i, k in enumerate(keys)]).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_size"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & k.eqNullSafe(F.col(f"_by{i}"))
    joined = rows.join(groups, same) if by else rows.join(F.broadcast(groups))  # without groups one row
    return joined.withColumn("_place", F.col("_place") - F.col("_first") + 1).select(*df.columns, "_place", "_size")


#: Values of a group up to which its median is one aggregate, and buckets of each level for larger groups.
GROUP_ROWS, BUCKETS = 1 << 16, 4096


def medians(df: DataFrame, by: Sequence[str], value: str, name: str, upper: bool = False) -> DataFrame:
    """(by, name): the exact median of each group's values that are there; without groups one row, null if there is none.

    Of two values in the middle the mean, or the larger one if upper.

    NaN counts as the largest value. Small groups are one aggregate. The values of a larger group are put
    into buckets, whose counts tell in which the middle lies; only that one is read again and cut further,
    so rows are counted, never sorted.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    rows = df.where(F.col(value).isNotNull()).select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], F.col(value).cast("double").alias("_v"))
    sizes = settle(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    named = lambda t, v: t.select(*[F.col(k).alias(b) for b, k in zip(by, keys, strict=True)], v.alias(name))
    large = sizes.where(F.col("_n") > GROUP_ROWS)
    one = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY _v DESC)") if upper else F.median("_v")
    if large.isEmpty():
        return named(rows.groupBy(*keys).agg(one.alias("_m")), F.col("_m"))
    small = _meet(rows, sizes.where(F.col("_n") <= GROUP_ROWS).select(*keys), keys).groupBy(*keys).agg(one.alias("_m"))
    # _skip: values of the group below those that are still looked at; _one and _two: the places in the middle.
    asked = large.select(*keys, F.lit(0).cast("long").alias("_skip"), F.floor((F.col("_n") + (2 if upper else 1)) / 2).alias("_one"), F.floor((F.col("_n") + 2) / 2).alias("_two"), F.lit(0.0).alias("_low"), F.lit(0.0).alias("_high"))
    found, now, first = small if keys else small.limit(0), _meet(rows, asked.select(*keys), keys), True
    while True:  # a level for the power of two, and one for every twelve of a double's 52 bits
        known, asked, now = _refined(now, asked, keys, first)
        found, first = found.unionByName(known), False
        if asked.isEmpty():
            return named(found, F.col("_m"))


def _meet(rows: DataFrame, few: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows joined to one row a group; nulls are a group. Spark broadcasts the groups while they are small and splits hot keys beyond."""
    same, other = F.lit(True), few.select(*[F.col(k).alias(f"{k}_") for k in keys], *[c for c in few.columns if c not in keys])
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    joined = rows.join(other, same) if keys else rows.join(F.broadcast(other))  # without groups one row
    return joined.drop(*[f"{k}_" for k in keys])


def _refined(rows: DataFrame, asked: DataFrame, keys: Sequence[str], first: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One level: medians that are known now, what is asked of the others, and the rows of their middle buckets."""
    v, low, high = F.col("_v"), F.col("_low"), F.col("_high")
    if first:  # by sign and power of two, so that no later range is wide
        power = F.lit(1200) + F.floor(F.log2(F.abs(v)))
        finite = F.when(v > 0, power).when(v < 0, -power).otherwise(0)
        bucket = F.when(F.isnan(v), 5001).when(v == float("inf"), 5000).when(v == float("-inf"), -5000).otherwise(finite).cast("int")
    else:
        bucket = F.least(F.lit(BUCKETS - 1), F.floor((v - low) / (high - low) * F.lit(float(BUCKETS)))).cast("int")
    placed = _meet(rows, asked, keys).withColumn("_b", bucket)
    counts = placed.groupBy(*keys, "_b", "_skip", "_one", "_two").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    order = Window.partitionBy(*keys).orderBy("_b")  # some thousand rows of a group at most
    upto = counts.withColumn("_upto", F.col("_skip") + F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("_next", F.lead("_min").over(order))
    middle = settle(upto.where((F.col("_upto") >= F.col("_one")) & (F.col("_upto") - F.col("_c") < F.col("_one"))))
    done = (F.col("_upto") < F.col("_two")) | (F.col("_min") == F.col("_max"))
    # The two middle values are the last of a bucket and the first of the next, or all values of the bucket are one.
    second = F.when(F.col("_upto") < F.col("_two"), F.col("_next")).otherwise(F.col("_max"))
    known = middle.where(done).select(*keys, "_max", second.alias("_second"))
    known = known.select(*keys, F.when(F.col("_max") == F.col("_second"), F.col("_max")).otherwise((F.col("_max") + F.col("_second")) / 2).alias("_m"))
    more = middle.where(~done).select(*keys, (F.col("_upto") - F.col("_c")).alias("_skip"), "_one", "_two", F.col("_min").alias("_low"), F.col("_max").alias("_high"), "_b")
    rest = _meet(placed.drop("_skip", "_one", "_two", "_low", "_high"), more.select(*keys, F.col("_b").alias("_at")), keys).where("_b = _at").select(*keys, "_v")
    return known, more.drop("_b"), settle(rest)


def first_of(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The first row of each key by the order; an aggregation with partial results, so a hot key does not gather."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def last_of(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def carry_forward(df: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The last value that is not null, up to and with the row, of each column."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def sort_key(x: Column, descending: bool = False, missing: float | None = None, locale: str | None = None) -> Column:
    """Order of a sort that a user picks: ascending with nulls last, its mirror with nulls first, or descending with nulls as a number.

    locale orders texts as its readers expect, such as zh by pinyin; without it they go by code point.
    """
    if locale is not None:
        x = F.collate(x, locale)
    if missing is not None:
        return F.coalesce(x, F.lit(missing)).desc()
    return x.desc_nulls_first() if descending else x.asc_nulls_last()


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, order: Sequence[Column], number: int, size: int) -> DataFrame:
    """Page number (from 1) of the rows in the order."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def thirds(position: Column, n: Column, tiers: int = 3) -> Column:
    """Tier from 0 of a position from 1 of n: as many in each of the first tiers as fit a part, the rest in the last."""
    return F.least(F.lit(tiers - 1), F.floor((position - 1) / F.greatest(F.ceil(n / tiers), F.lit(1)))).cast("int")


def tiers(df: DataFrame, order: Sequence[Column], tiers: int = 3, name: str = "tier") -> DataFrame:
    """df with tiers over all its rows, so they are set before any filter."""
    n = df.agg(F.count(F.lit(1)).alias("_all"))
    return numbered(df, order, "quality_rank").join(F.broadcast(n)).withColumn(name, thirds(F.col("quality_rank"), F.col("_all"), tiers)).drop("_all")


#: Operations that can be carried over from range to range; nulls are left out, and a group's first row has nothing before it.
_RUNNING = {"sum": F.sum, "product": F.product, "max": F.max, "min": F.min}


def scan(df: DataFrame, by: Sequence[str], order: Sequence[Column], values: dict[str, tuple[Column, str]], before: bool = False) -> DataFrame:
    """df with running values by the order inside each group: of the rows up to and with each, or of those before it.

    values: name to a column and an operation, which is sum, product, max or min. Two levels: rows are sorted
    into ranges, whatever the groups' sizes; a range's totals for its groups are carried to the ranges
    after it, and added to what runs inside them. So no group needs to fit in a task. Null keys are a group.
    """
    keys = [F.col(b) for b in by]
    own = {n: c.alias(f"_v_{n}") for n, (c, _) in values.items()}
    parts = settle(df.select("*", *own.values()).repartitionByRange(*(k.asc_nulls_first() for k in keys), *order).withColumn("_part", F.spark_partition_id()))
    totals = parts.groupBy("_part", *[k.alias(f"_by{i}") for i, k in enumerate(keys)]).agg(*[_RUNNING[o](f"_v_{n}").alias(f"_t_{n}") for n, (_, o) in values.items()])
    groups = [f"_by{i}" for i in range(len(by))]
    # A row for each range of a group.
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col("_part").alias("_p"), *groups, *[_RUNNING[o](f"_t_{n}").over(earlier).alias(f"_c_{n}") for n, (_, o) in values.items()])
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & k.eqNullSafe(F.col(f"_by{i}"))
    w = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow)
    inside = parts.select("*", *[_RUNNING[o](f"_v_{n}").over(w).alias(f"_r_{n}") for n, (_, o) in values.items()])
    joined = inside.join(carried, same)
    both = {"sum": lambda a, b: a + b, "product": lambda a, b: a * b, "max": F.greatest, "min": F.least}
    return joined.select(*df.columns, *[F.coalesce(both[o](F.col(f"_c_{n}"), F.col(f"_r_{n}")), F.col(f"_c_{n}"), F.col(f"_r_{n}")).alias(n) if o in ("sum", "product") else _extreme(n, o).alias(n) for n, (_, o) in values.items()])


def _extreme(name: str, kind: str) -> Column:
    """The larger or smaller of what is carried and what runs inside, of any type that has an order."""
    a, b = F.col(f"_c_{name}"), F.col(f"_r_{name}")
    return F.when(a.isNull(), b).when(b.isNull(), a).when(a > b if kind == "max" else a < b, a).otherwise(b)


def running_chances(df: DataFrame, by: Sequence[str], order: str, chance: str) -> DataFrame:
    """reach: no choice before came off; admit: this is the first that does; total: one up to here did; none: none did."""
    out = scan(df, by, [F.col(order)], {"_reach": (1 - F.col(chance), "product")}, before=True).withColumn("reach", F.coalesce("_reach", F.lit(1.0))).drop("_reach")
    out = scan(out.withColumn("admit", F.col("reach") * F.col(chance)), by, [F.col(order)], {"total": (F.col("admit"), "sum")})
    return out.withColumn("none", F.greatest(F.lit(0.0), 1 - F.col("total")))


def cumulative_share(df: DataFrame, by: Sequence[str], order: Sequence[str], weight: str) -> DataFrame:
    """Running share of the weight in each group; the last is 1."""
    all_ = df.groupBy(*[F.col(b).alias(f"_g{i}") for i, b in enumerate(by)]).agg(F.sum(weight).alias("_all"), F.count(F.lit(1)).alias("_rows"))
    run = scan(df, by, [F.col(o) for o in order], {"_run": (F.col(weight), "sum"), "_at": (F.lit(1).cast("long"), "sum")})
    same = F.lit(True)
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_g{i}"))
    joined = run.join(all_, same) if by else run.join(F.broadcast(all_))  # without groups one row
    return joined.select(*df.columns, F.when(F.col("_at") == F.col("_rows"), 1.0).otherwise(F.col("_run") / F.col("_all")).alias("cumulative"))


def quota_top(df: DataFrame, band: str, quotas: dict[str, int], order: Sequence[Column]) -> DataFrame:
    """The first rows of each band, as many as its quota; bands without one have none."""
    w = Window.partitionBy(band).orderBy(*order)
    table = F.create_map(*[F.lit(v) for pair in quotas.items() for v in pair])
    # The largest quota as a literal, so that each task keeps no more rows of a band than that.
    first = df.where(F.col(band).isin(*quotas)).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max(quotas.values(), default=0))
    return first.where(F.col("_rn") <= F.coalesce(F.try_element_at(table, band), F.lit(0))).drop("_rn")


def fill_to(selected: DataFrame, pool: DataFrame, key: str, n: int, order: Sequence[Column]) -> DataFrame:
    """selected, and the first rows of the pool that it lacks, up to n rows."""
    missing = max(0, n - selected.count())
    return selected.unionByName(pool.join(selected.select(key), key, "left_anti").orderBy(*order).limit(missing).select(*selected.columns)) if missing else selected


def with_floor(selected: DataFrame, pool: DataFrame, key: str, member: Column, least: int, order: Sequence[Column], n: int) -> DataFrame:
    """selected with at least so many members, where the pool has them, and at most n rows.

    Members are added from the pool; if that exceeds n, the first `least` members stay and the best of the
    other rows fill the rest.
    """
    short = max(0, least - selected.where(member).count())
    if short:
        more = pool.where(member).join(selected.select(key), key, "left_anti").orderBy(*order).limit(short)
        selected = selected.unionByName(more.select(*selected.columns))
    if selected.count() <= n:
        return selected
    kept = selected.where(member).orderBy(*order).limit(least)
    rest = selected.join(kept.select(key), key, "left_anti").orderBy(*order).limit(max(0, n - kept.count()))
    return kept.unionByName(rest)


def select_by_quota(pool: DataFrame, key: str, band: str, quotas: dict[str, int], n: int, member: Column, least: int, order: Sequence[Column]) -> DataFrame:
    """Quotas by band, the remainder from the pool, a floor for members, numbered by the order as final_rank."""
    pool = settle(pool)  # counted and read several times below
    taken = fill_to(quota_top(pool, band, quotas, order), pool, key, n, order)
    return numbered(with_floor(taken, pool, key, member, least, order, n), order, "final_rank")


def select_two_parts(pool: DataFrame, key: str, parts: Sequence[tuple[Column, int]], n: int, member: Column, least: int, order: Sequence[Column], worst: Sequence[Column]) -> DataFrame:
    """So many rows of each part, the remainder from the pool; members short of the floor replace the worst others."""
    pool, taken = settle(pool), None
    for condition, size in parts:
        part = pool.where(condition).orderBy(*order).limit(size)
        taken = part if taken is None else taken.unionByName(part.join(taken.select(key), key, "left_anti").select(*part.columns))
    taken = fill_to(taken, pool, key, n, order)
    short = max(0, least - taken.where(member).count())
    if short:
        more = pool.where(member).join(taken.select(key), key, "left_anti").orderBy(*order).limit(short)
        out = taken.where(~member).orderBy(*worst).limit(more.count()).select(key)
        taken = taken.join(out, key, "left_anti").select(*taken.columns).unionByName(more.select(*taken.columns))
    return numbered(taken.orderBy(*order).limit(n), order, "final_rank")


def round_robin(df: DataFrame, order: Sequence[Column], shards: int, name: str = "shard") -> DataFrame:
    return numbered(df, order, "_rn").withColumn(name, F.pmod(F.col("_rn") - 1, F.lit(shards)).cast("int")).drop("_rn")


def halves(df: DataFrame, by: str, order: Sequence[Column], name: str = "half") -> DataFrame:
    """1 for the first half of each group, the middle row included, 2 for the rest."""
    return placed(df, [by], order).withColumn(name, F.when(F.col("_place") <= F.floor((F.col("_size") + 1) / 2), 1).otherwise(2)).drop("_place", "_size")


def balance(df: DataFrame, group: str, shards: int, name: str = "shard") -> DataFrame:
    """Whole groups dealt largest first to the shard with the fewest rows, the first of equals.

    The loads decide one after the other, so groups are taken in order; groups of one size come as their
    number, whatever that is: sizes differ in few ways, and equal ones fill the shards level by level.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    ranked = numbered(sizes, [F.desc("n"), F.asc(group)], "_at")
    load, dealt, larger = [0] * shards, [], 0
    # A row for each different size: at most as many as the square root of twice the rows.
    for row in sizes.groupBy("n").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("n")).toLocalIterator():
        dealt.append((row["n"], larger, *_levels(load, row["n"], row["k"])))
        larger += row["k"]
    plan = df.sparkSession.createDataFrame(dealt, "n long, _larger long, _order array<int>, _cycle array<int>")
    # Groups are numbered by falling size, so a group's number among those of its size is its own less the larger ones'.
    placed = ranked.join(plan, "n").withColumn("_k", F.col("_at") - 1 - F.col("_larger"))
    head = F.size("_order")
    shard = F.when(F.col("_k") < head, F.element_at("_order", (F.col("_k") + 1).cast("int"))).otherwise(F.element_at("_cycle", (F.pmod(F.col("_k") - head, F.lit(shards)) + 1).cast("int")))
    return df.join(placed.select(group, shard.cast("int").alias(name)), group, "left")


def _levels(load: list[int], size: int, count: int) -> tuple[list[int], list[int]]:
    """Where count groups of one size go, each to the first of the least loaded: the first ones, and the cycle that all later ones follow.

    Loads that differ by less than one size stay so, and then the shards take turns in one order. load is updated.
    """
    order: list[int] = []
    while len(order) < count and max(load) - min(load) >= size:
        at = load.index(min(load))
        load[at] += size
        order.append(at)
    rest = count - len(order)
    cycle: list[int] = []
    if rest:
        turns, part = divmod(rest, len(load))
        now = list(load)
        for _ in load:
            at = now.index(min(now))
            now[at] += size
            cycle.append(at)
        for i, at in enumerate(cycle):
            load[at] += size * (turns + (i < part))
    return order, cycle


def in_order(x: Column, names: Sequence[str]) -> Column:
    """Sort key of an enumeration; unknown values come last."""
    out = F.lit(len(names))
    for i, n in reversed(list(enumerate(names))):
        out = F.when(x == n, i).otherwise(out)
    return out
