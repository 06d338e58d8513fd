"""A conservative match of items to records of each year, with an audit of everything that it left out.

Levels, in order: exact (the record's key is unique), base (the item's and the record's base key are
unique), a curated choice among contained keys, and a contained key that is unique. Each is tried with the
group's code, then with its key. Ledgered rejections are logged and the search goes on; of several contained
keys none is taken; a match whose group differs is logged and not taken.

All candidates are computed once, in long form; every output is a filter of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators import containment
from plumbline.operators.joins import unique_rows

LEVELS = {"exact": 1, "base": 2, "manual_ambiguous": 3, "contains_unique": 4}


@dataclass
class Matches:
    matched: DataFrame  # item_id, year, level, and the record's columns
    ambiguous: DataFrame  # item_id, year, candidate_count, candidates, chosen, status
    mismatched: DataFrame  # like matched
    rejected: DataFrame  # like matched


def _probes(items: DataFrame, years: DataFrame) -> DataFrame:
    """Items by year with the group keys to try, the code before the key, each once."""
    groups = F.filter(F.array_distinct(F.array("group_code", "group_key")), lambda g: g.isNotNull() & (g != ""))
    return items.join(F.broadcast(years)).select("*", F.posexplode(groups).alias("probe", "group"))


def match(items: DataFrame, records: DataFrame, years: list[int], rejected: DataFrame | None = None, choices: DataFrame | None = None, group_of: Column | None = None) -> Matches:
    """Match items to records.

    items: item_id, group_code, group_key, name, key, base_key, duration. records: record_id, year,
    group_code, group_key, name, key, base_key, rank, duration. A record with a code is indexed under its
    code only, else under its group key. rejected: (level, group_code, name, record_name). choices: (item_id,
    year, chosen). group_of: canonical form of the column g for the group check, g itself by default.
    Empty keys match nothing.
    """
    spark = items.sparkSession
    # The years are a handful of numbers given by the caller.
    year_rows = spark.createDataFrame([(y,) for y in years], "year int")
    records = records.where(F.col("year").isin(years)).withColumn("group", F.when(F.coalesce("group_code", F.lit("")) != "", F.col("group_code")).otherwise(F.col("group_key")))
    row = F.struct("record_id", "name", "key", "base_key", "group_key", "rank", "duration")
    lone = items.groupBy("group_code", "base_key").agg(F.count(F.lit(1)).alias("n")).where("n = 1 and base_key <> ''").select("group_code", "base_key", F.lit(True).alias("lone"))
    probes = _probes(items, year_rows).join(lone, ["group_code", "base_key"], "left").withColumn("lone", F.coalesce("lone", F.lit(False)))

    def unique(level: str, column: str) -> DataFrame:
        index = unique_rows(records.select("year", "group", F.col(column).alias("k"), row.alias("rec")), ["year", "group", "k"])
        found = probes.where("lone") if level == "base" else probes
        return found.withColumn("k", F.col(column)).join(index, ["year", "group", "k"]).select("item_id", "group_code", F.col("group_key").alias("item_group"), F.col("name").alias("item_name"), "year", F.lit(level).alias("level"), "probe", "rec")

    hits = unique("exact", "key").unionByName(unique("base", "base_key"))
    asking = probes.where("lone").withColumnRenamed("base_key", "item_base").withColumnRenamed("duration", "item_duration")
    listed = records.where("base_key <> ''").select("year", "group", "base_key", row.alias("rec"))
    near = containment.contained(asking.select("year", "group", F.col("item_base").alias("left")), listed.select("year", "group", F.col("base_key").alias("right")), ["year", "group"])
    contained = (
        asking.join(near, (asking["year"] == near["year"]) & (asking["group"] == near["group"]) & (F.col("item_base") == F.col("left"))).drop(near["year"], near["group"])
        .withColumnRenamed("right", "base_key").join(listed, ["year", "group", "base_key"]).drop("left", "base_key")
    )
    ledger = rejected if rejected is not None else spark.createDataFrame([], "level string, group_code string, name string, record_name string")
    ledger = ledger.select("level", "group_code", F.col("name").alias("item_name"), F.col("record_name").alias("_record"), F.lit(True).alias("_bad")).distinct()
    picks = choices if choices is not None else spark.createDataFrame([], "item_id string, year int, chosen string")
    picks = picks.where("chosen <> ''").select("item_id", F.col("year").cast("int").alias("year"), "chosen")

    # Contained candidates of an item and year, reduced before any row is kept in a list.
    grouped = contained.join(picks, ["item_id", "year"], "left")
    fits = F.col("rec.name") == F.col("chosen")
    long_fits = fits & (F.col("rec.duration") == F.col("item_duration"))
    facts = grouped.groupBy("item_id", "group_code", F.col("group_key").alias("item_group"), F.col("name").alias("item_name"), "year", "chosen").agg(
        F.count(F.lit(1)).alias("candidate_count"),
        F.count_distinct("rec.key", F.coalesce(F.col("rec.rank").cast("string"), F.lit("-"))).alias("n_keys"),
        F.max_by("rec", "rec.record_id").alias("any"),
        F.count_distinct(F.when(fits, F.struct("rec.key", "rec.duration", "rec.rank"))).alias("n_fit"),
        F.max_by("rec", F.when(fits, F.col("rec.record_id"))).alias("fit"),
        F.count_distinct(F.when(long_fits, F.struct("rec.key", "rec.duration", "rec.rank"))).alias("n_long"),
        F.max_by("rec", F.when(long_fits, F.col("rec.record_id"))).alias("long"),
    )
    facts = facts.withColumn("one", F.when(F.col("n_long") > 0, F.when(F.col("n_long") == 1, F.col("long"))).when(F.col("n_fit") == 1, F.col("fit")))
    own = ["item_id", "group_code", "item_group", "item_name", "year"]
    manual = facts.where("chosen is not null and one is not null").select(*own, F.lit("manual_ambiguous").alias("level"), F.lit(0).alias("probe"), F.col("one").alias("rec"))
    single = facts.where("chosen is null and n_keys = 1").select(*own, F.lit("contains_unique").alias("level"), F.lit(0).alias("probe"), F.col("any").alias("rec"))

    order = F.create_map(*[F.lit(v) for pair in LEVELS.items() for v in pair])
    tagged = hits.unionByName(manual).unionByName(single).withColumn("_record", F.col("rec.name")).join(ledger, ["level", "group_code", "item_name", "_record"], "left")
    tagged = tagged.withColumn("ord", F.try_element_at(order, "level") * 10 + F.col("probe")).withColumn("bad", F.coalesce("_bad", F.lit(False)))
    first = Window.partitionBy("item_id", "year")
    tagged = tagged.withColumn("win", F.min(F.when(~F.col("bad"), F.col("ord"))).over(first))
    group = group_of if group_of is not None else F.col("g")
    same = _group(tagged.withColumn("g", F.col("item_group")), group, "gi").withColumn("g", F.col("rec.group_key"))
    judged = _group(same, group, "gr").withColumn("same", (F.col("gi") != "") & (F.col("gi") == F.col("gr")))
    shape = ["item_id", "year", "level", "item_name", "item_group", "rec.*"]
    winner = judged.where(~F.col("bad") & (F.col("ord") == F.col("win")))
    # Logged: rejected hits that come before the winner; a rejected curated choice is not.
    logged = judged.where(F.col("bad") & (F.col("level") != "manual_ambiguous") & (F.col("win").isNull() | (F.col("ord") < F.col("win"))))
    early = tagged.where((F.col("level").isin("exact", "base")) & ~F.col("bad")).select("item_id", "year").distinct()
    unsure = facts.where("(chosen is not null and one is null) or (chosen is null and n_keys > 1)").join(early, ["item_id", "year"], "left_anti")
    # The first ten names of each, by a window that spills, as an item may have very many candidates.
    named = contained.join(unsure.select("item_id", "year"), ["item_id", "year"], "left_semi").select("item_id", "year", F.col("rec.name").alias("n")).distinct()
    ten = named.withColumn("i", F.row_number().over(Window.partitionBy("item_id", "year").orderBy("n"))).where("i <= 10")
    lists = ten.groupBy("item_id", "year").agg(F.array_join(F.array_sort(F.collect_list("n")), "; ").alias("candidates"))
    return Matches(
        winner.where("same").select(*shape),
        unsure.join(lists, ["item_id", "year"]).select("item_id", "year", "candidate_count", "candidates", "chosen", F.when(F.col("chosen").isNotNull(), "not_unique").alias("status")),
        winner.where(~F.coalesce("same", F.lit(False))).select(*shape),
        logged.select(*shape),
    )


def _group(df: DataFrame, group: Column, name: str) -> DataFrame:
    return df.withColumn(name, group)


def back_fill(records: DataFrame, known: DataFrame, candidates: str = "candidates", key: str = "group_key") -> DataFrame:
    """records with group_code and code_source: own, identity or key.

    known: identity, group_key, group_code. A blank code is that of the first candidate identity with
    exactly one code, else that of the group key if that has exactly one. records needs record_id.
    """
    def single(column: str) -> DataFrame:
        return known.where((F.col("group_code") != "") & (F.col(column) != "")).groupBy(column).agg(F.count_distinct("group_code").alias("n"), F.min("group_code").alias("code")).where("n = 1").drop("n")

    blank = F.coalesce("group_code", F.lit("")) == ""
    tried = records.where(blank).select("record_id", F.posexplode(candidates).alias("pos", "identity"))
    by_identity = tried.join(single("identity"), "identity").groupBy("record_id").agg(F.min_by("code", "pos").alias("_identity"))
    by_key = single("group_key").select(F.col("group_key").alias(key), F.col("code").alias("_key"))
    joined = records.join(by_identity, "record_id", "left").join(by_key, key, "left")
    code = F.when(~blank, F.col("group_code")).otherwise(F.coalesce("_identity", "_key", F.lit("")))
    source = F.when(~blank, "own").when(F.col("_identity").isNotNull(), "identity").when(F.col("_key").isNotNull(), "key").otherwise("")
    return joined.withColumn("code_source", source).withColumn("group_code", code).select(*records.columns, "code_source")
