"""Readers of delimited files, extracted text lines, JSON documents and CSV blocks in Markdown."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions import text
from plumbline.operators import ranking

# Skipped lines of extracted pages.
SKIPPED = r"^\s*$|^\s*\d+\s*$|^\s*第\s*\d+\s*页"


def read_strings(spark: SparkSession, path: str | list[str], provenance: str | None = None) -> DataFrame:
    """CSV with a header, all columns strings, byte order mark dropped, blanks as empty texts; globs and lists are joined by name.

    provenance names a column for the file's name.
    """
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', encoding="UTF-8")
    columns = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c.removeprefix("﻿")) for c in df.columns]
    return df.select(*columns, *([F.col("_metadata.file_name").alias(provenance)] if provenance else []))


def read_optional(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The file's rows, or none of the schema where nothing is at the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    if not found:
        return spark.createDataFrame([], schema)
    return read_strings(spark, path)


def read_manifest(spark: SparkSession, path: str) -> list[dict]:
    """Entries of a JSON manifest, a list or an object with a list of shards."""
    whole = spark.read.text(path, wholetext=True).first()
    got = json.loads(whole[0]) if whole else []
    return got if isinstance(got, list) else got.get("shards", [])


def read_shards(spark: SparkSession, manifest: str, root: str, field: str = "rows") -> DataFrame:
    """The union of the shards that a manifest lists, with shard_id."""
    parts = [read_strings(spark, f"{root}/{entry[field]}").withColumn("shard_id", F.lit(str(entry["shard_id"]))) for entry in read_manifest(spark, manifest)]
    if not parts:
        raise ValueError(f"{manifest} lists no shards")
    while len(parts) > 1:  # pairs of pairs, so that the plan of many shards is no deeper than their logarithm
        parts = [a.unionByName(b[0], allowMissingColumns=True) if b else a for a, b in ((parts[i], parts[i + 1 : i + 2]) for i in range(0, len(parts), 2))]
    return parts[0]


def table_with_header(df: DataFrame, names: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Columns renamed by position; rows whose required columns are all there."""
    out = df.toDF(*names)
    for r in required:
        out = out.where(F.col(r).isNotNull() & (F.trim(F.col(r).cast("string")) != ""))
    return out


def read_choices(spark: SparkSession, path: str, synonyms: dict[str, str], names: Sequence[str]) -> DataFrame:
    """An ordered list: names plus order from 1, blank rows dropped.

    The first line is a header if it has a known synonym; else columns go by position.
    """
    raw = spark.read.csv(path, header=False, inferSchema=False, multiLine=True, escape='"', encoding="UTF-8")
    first = raw.limit(1).collect()
    head = [str(v or "").strip().removeprefix("﻿").lower() for v in first[0]] if first else []
    known = [synonyms.get(h) for h in head]
    place = F.monotonically_increasing_id()
    rows = raw.withColumn("_at", place)
    if any(known):  # each file of several has the header
        same = F.lit(True)
        for c, v in zip(raw.columns, first[0], strict=True):
            same = same & F.col(c).eqNullSafe(F.lit(v))
        rows = rows.where(~same)
    at = {n: known.index(n) if n in known else (i if not any(known) and i < len(raw.columns) else None) for i, n in enumerate(names)}
    columns = [F.trim(F.coalesce(F.col(raw.columns[at[n]]), F.lit(""))).alias(n) if at[n] is not None else F.lit("").alias(n) for n in names]
    kept = rows.select("_at", *columns).where(F.concat_ws("", *[n for n in names if n != "order"]) != "")
    own = F.col("order").try_cast("int") if "order" in names else F.lit(None).cast("int")
    # Choice lists have some dozens of rows, so one window over them is no burden.
    return kept.withColumn("order", F.row_number().over(Window.orderBy(F.asc_nulls_last(own), "_at"))).drop("_at")


def lines(df: DataFrame, body: str, by: Sequence[str]) -> DataFrame:
    """(by, line_no from 1, line) of a text column."""
    return df.select(*by, F.posexplode(F.split(F.coalesce(F.col(body), F.lit("")), "\r?\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)


def kept_lines(df: DataFrame, line: str = "line", skipped: str = SKIPPED) -> DataFrame:
    return df.where(~F.rlike(F.coalesce(F.col(line), F.lit("")), F.lit(skipped)))


def parse_records(df: DataFrame, places: Sequence[str], by: str, order: Sequence[str]) -> DataFrame:
    """Records of line tables: by, order, code, college, location, name, numbers.

    A line that names an institution sets it for those below; a line without numbers is the start of a name
    that goes on in the next; a short one after a record (three characters at most) ends that record's name.
    State does not cross documents. order must be total in each.

    The state is a running value: how many institutions and records came so far, the last institution, and
    the last segment between two of these that holds the start of a name. Each is a scan over ranges of
    lines, so a document of any length is read by many tasks; only the lines of one name meet in one.
    """
    heads = df.withColumn("_h", text.header(F.col("line"), places)).withColumn("_t", text.tail_numbers(F.coalesce(F.col("_h.rest"), F.col("line"))))
    rows = heads.select(
        F.col(by).alias("by"), F.struct(*order).alias("at"), F.col("_h.code").alias("code"), F.col("_h.name").alias("college"), F.col("_h.location").alias("location"),
        F.coalesce("_t.head", F.lit("")).alias("name"), F.coalesce(F.col("_t.tail"), F.array().cast("array<int>")).alias("numbers"),
    ).withColumns({"named": F.coalesce(F.col("college") != "", F.lit(False)), "record": F.size("numbers") > 0})
    once = lambda c: c.cast("long")
    place = [F.col("at")]
    seen = ranking.scan(rows, ["by"], place, {
        "n_named": (once(F.col("named")), "sum"), "n_records": (once(F.col("record")), "sum"),
        "last": (F.when(F.col("named"), F.struct("at", "college", "location")), "max"), "last_code": (F.when(F.col("named") & (F.col("code") != ""), F.struct("at", "code")), "max"),
    })
    # Lines between two institutions or records are a segment; a record is the last of its own.
    seen = seen.withColumn("before", F.col("n_records") - once(F.col("record"))).withColumn("segment", F.col("n_named") + F.col("before"))
    part = ~F.col("record") & (F.col("name") != "")
    starts = part & ((F.length("name") > 3) | (F.col("before") == 0))
    seen = ranking.scan(seen, ["by"], place, {"started": (F.when(starts, F.col("segment")), "max")})
    begun = F.coalesce(F.col("started") == F.col("segment"), F.lit(False))
    records = seen.where("record").select("by", "at", "n_records", "segment", "name", "numbers", F.col("last_code.code").alias("code"), F.col("last.college").alias("college"), F.col("last.location").alias("location"))
    spelled = lambda: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda x: x["name"]), "")
    own = records.select(F.col("by").alias("_b"), F.col("segment").alias("_s"))
    parts = seen.where(part & begun).join(own, F.col("by").eqNullSafe(F.col("_b")) & (F.col("segment") == F.col("_s")), "left_semi")
    firsts = parts.groupBy(F.col("by").alias("_by"), F.col("segment").alias("_segment")).agg(spelled().alias("first"))
    ends = seen.where(part & ~begun & (F.col("before") > 0)).groupBy(F.col("by").alias("_of"), F.col("before").alias("_record")).agg(spelled().alias("end"))
    joined = records.join(firsts, F.col("by").eqNullSafe(F.col("_by")) & (F.col("segment") == F.col("_segment")), "left")
    joined = joined.join(ends, F.col("by").eqNullSafe(F.col("_of")) & (F.col("n_records") == F.col("_record")), "left")
    name = F.regexp_replace(F.concat(F.coalesce("first", F.lit("")), "name"), r"(?U)^\s+|\s+$", "")
    return joined.select(F.col("by").alias(by), *[F.col(f"at.{o}").alias(o) for o in order], "code", "college", "location", F.concat(name, F.coalesce("end", F.lit(""))).alias("name"), "numbers")


def tail_record(numbers: Column, threshold: int = 492) -> Column:
    """struct of a record's numbers by how many there are: admitted, duration, average, scores and ranks of two segments.

    Durations are 1 to 8 and averages 100 to 750, else null. A lone score and rank belong to the first segment
    from the threshold on, to the second below. lowest is the second segment's pair where there is one.
    """
    n = F.size(numbers)
    at = lambda i: F.try_element_at(numbers, F.lit(i))
    between = lambda x, low, high: F.when((x >= low) & (x <= high), x)
    pair_score, pair_rank = F.when(n == 5, at(4)), F.when(n == 5, at(5))
    upper = pair_score >= threshold
    s1 = F.when(n >= 7, at(4)).when(upper, pair_score)
    r1 = F.when(n >= 7, at(5)).when(upper, pair_rank)
    s2 = F.when(n >= 7, at(6)).when(~upper, pair_score)
    r2 = F.when(n >= 7, at(7)).when(~upper, pair_rank)
    return F.struct(
        at(1).alias("admitted"), between(at(2), 1, 8).alias("duration"), between(at(3), 100, 750).alias("average"), s1.alias("score1"), r1.alias("rank1"), s2.alias("score2"), r2.alias("rank2"),
        F.coalesce(s2, s1).alias("lowest_score"), F.when(s2.isNotNull(), r2).otherwise(r1).alias("lowest_rank"), F.when(s2.isNotNull(), "2").when(s1.isNotNull(), "1").alias("segment"),
    )


def fenced_blocks(df: DataFrame, key: str, body: str, kinds: dict[str, Sequence[str]]) -> DataFrame:
    """(key, block, kind, header, n_rows, csv): the CSV blocks of Markdown texts, told apart by the columns that they share with each kind.

    Of several blocks of a kind the last counts: is_last.
    """
    found = F.regexp_extract_all(F.col(body), F.lit(r"(?s)```(?:csv)?[ \t]*\r?\n(.*?)\r?\n?```"), F.lit(1))
    blocks = df.select(key, F.posexplode(found).alias("block", "csv"))
    rows = F.filter(F.split("csv", r"\r?\n"), lambda line: F.trim(line) != "")
    header = F.transform(F.split(F.coalesce(F.try_element_at(rows, F.lit(1)), F.lit("")), ","), lambda c: F.trim(c))
    blocks = blocks.withColumn("header", header).withColumn("n_rows", F.greatest(F.size(rows) - 1, F.lit(0)))
    shared = {k: F.size(F.array_intersect("header", F.array(*[F.lit(c) for c in cols]))) for k, cols in kinds.items()}
    best = F.greatest(*shared.values(), F.lit(0)) if len(shared) > 1 else next(iter(shared.values()))
    kind = F.coalesce(*[F.when((best > 0) & (n == best), F.lit(k)) for k, n in shared.items()])
    last = F.max("block").over(Window.partitionBy(key, "kind"))
    return blocks.withColumn("kind", kind).withColumn("is_last", F.col("kind").isNotNull() & (F.col("block") == last))


def json_documents(df: DataFrame, column: str, schema: StructType | str, name: str = "doc") -> DataFrame:
    """df with the parsed document and whether it could not be parsed, column broken."""
    parsed = F.from_json(column, schema, {"mode": "PERMISSIVE"})
    valid = F.try_parse_json(column).isNotNull()
    return df.withColumn(name, F.when(valid, parsed)).withColumn("broken", F.col(column).isNotNull() & ~valid)
