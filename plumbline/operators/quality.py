"""Checks of tables that others produced: normalising, validating, grading."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators import aggregates, joins


@dataclass
class Contract:
    """What a table must look like."""

    columns: Sequence[str]
    key: str
    identity: Sequence[str] = ()
    enums: dict[str, Sequence[str]] = field(default_factory=dict)
    tags: dict[str, Sequence[str]] = field(default_factory=dict)
    references: Sequence[str] = ()


def issue(rows: DataFrame, code: str, severity: str, detail: Column, shard: Column) -> DataFrame:
    return rows.select(shard.cast("string").alias("shard"), F.lit(severity).alias("severity"), F.lit(code).alias("code"), detail.cast("string").alias("detail"))


def validate(rows: DataFrame, sources: DataFrame, expected: DataFrame, contract: Contract, shard: str = "shard_id", source_key: str = "source_id") -> DataFrame:
    """(shard, severity, code, detail): one row for each issue of rows, held against the expected input and the sources."""
    key, at = contract.key, F.lit("")
    have = [c for c in rows.columns if c != shard]
    out = []
    if have != list(contract.columns):
        out.append(issue(rows.sparkSession.range(1), "column_mismatch", "error", F.lit(",".join(have)), at))
    absent = [c for c in contract.columns if c not in have]
    rows = rows.withColumns({c: F.lit("") for c in absent}) if absent else rows
    both = joins.outer_difference(expected.dropDuplicates([key]), rows.dropDuplicates([key]), key, list(contract.identity))
    out.append(issue(both.where("side = 'missing'"), "missing_row", "error", F.col(key), at))
    out.append(issue(both.where("side = 'extra'"), "extra_row", "error", F.col(key), at))
    out.append(issue(both.where("side = 'both'"), "identity_changed", "error", F.concat_ws(":", key, F.array_join("changed", ",")), at))
    out.append(issue(aggregates.duplicate_keys(rows, [key]), "duplicate_row", "error", F.col(key), at))
    out.append(issue(aggregates.duplicate_keys(sources, [source_key]), "duplicate_source", "error", F.col(source_key), at))
    for column, allowed in contract.enums.items():
        bad = rows.where(~F.coalesce(F.col(column), F.lit("")).isin(*allowed))
        out.append(issue(bad, f"invalid_{column}", "error", F.concat_ws(":", key, column), F.col(shard)))
    for column, allowed in contract.tags.items():
        unknown = F.array_except(text.split_tags(F.col(column), "listed"), F.array(*[F.lit(a) for a in allowed]).cast("array<string>"))
        out.append(issue(rows.withColumn("_u", unknown).where("size(_u) > 0"), f"unknown_{column}", "warning", F.concat(F.col(key), F.lit(":"), F.array_join("_u", ",")), F.col(shard)))
    for column in contract.references:
        lost = joins.dangling(rows, text.split_sources(F.col(column)), sources, source_key)
        out.append(issue(lost, f"dangling_{column}", "error", F.concat_ws(":", key, "ref"), F.col(shard)))
    total = out[0]
    for o in out[1:]:
        total = total.unionByName(o)
    return total


def issue_totals(issues: DataFrame) -> DataFrame:
    return issues.groupBy("severity", "code").agg(F.count(F.lit(1)).alias("n"))


def accept_retries(main: DataFrame, retries: DataFrame, issues: DataFrame, shard: str = "shard_id") -> DataFrame:
    """Main rows as they are, and the rows of retry shards that have no issue."""
    clean = retries.join(issues.select(F.col("shard").alias(shard)).distinct(), shard, "left_anti")
    return main.unionByName(clean.select(*main.columns))


def normalize_tags(x: Column, synonyms: dict[str, str | None], allowed: Sequence[str]) -> Column:
    """Tags of a cell under their proper names, each once, joined by ;. A synonym of None removes; unknown tags go."""
    tags = F.transform(text.split_tags(x, "listed"), lambda t: F.lower(t))
    renamed = F.transform(tags, lambda t: text.lookup(t, {k: v or "" for k, v in synonyms.items()}))
    return F.array_join(F.array_distinct(F.filter(renamed, lambda t: t.isin(*allowed))), ";")


def normalize_enum(x: Column, synonyms: dict[str, str], allowed: Sequence[str], default: str) -> Column:
    value = text.lookup(F.lower(F.trim(F.coalesce(x, F.lit("")))), synonyms)
    return F.when(value.isin(*allowed), value).otherwise(default)


def keep_known_references(rows: DataFrame, sources: DataFrame, column: str, key: str, source_key: str = "source_id") -> DataFrame:
    """Rows with the ids of the column that sources has, joined by ;; order kept."""
    listed = rows.select(key, F.posexplode(text.split_sources(F.col(column))).alias("_pos", "_ref"))
    known = listed.join(sources.select(F.col(source_key).alias("_ref")).distinct(), "_ref", "left_semi")
    joined = known.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_pos", "_ref"))).alias("_refs"))
    refs = F.coalesce(F.array_join(F.array_distinct(F.transform("_refs", lambda r: r["_ref"])), ";"), F.lit(""))
    return rows.join(joined, key, "left").withColumn(column, refs).drop("_refs")


def shard_grades(rows: DataFrame, errors: DataFrame, shard: str = "shard_id", rerun: float = 0.5, low: float = 0.25) -> DataFrame:
    """(shard, n_rows, n_sources, share_low, n_mojibake, n_errors, grade) of flagged rows; errors: (shard, ...) issues.

    needs_repair: structural errors or garbled text; needs_rerun and low_coverage: that share of rows, or more, says little; else usable.
    """
    by = rows.groupBy(shard).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("has_source").cast("int")).alias("n_sources"), F.avg(F.col("low_information").cast("int")).alias("share_low"), F.sum(F.col("mojibake").cast("int")).alias("n_mojibake")
    )
    found = errors.groupBy(F.col("shard").alias(shard)).agg(F.count(F.lit(1)).alias("n_errors"))
    joined = by.join(found, shard, "left").na.fill(0, ["n_errors"])
    grade = F.when((F.col("n_errors") > 0) | (F.col("n_mojibake") > 0), "needs_repair").when(F.col("share_low") >= rerun, "needs_rerun").when(F.col("share_low") >= low, "low_coverage").otherwise("usable")
    return joined.withColumn("grade", grade)


def document_issues(docs: DataFrame, key: str, doc: str, broken: str, required: Sequence[str], items: str, item_fields: Sequence[str], enums: dict[str, Sequence[str]]) -> DataFrame:
    """(shard, severity, code, detail) of parsed JSON documents: not readable, keys missing, items without fields or with values out of their list."""
    out = issue(docs.where(broken), "invalid_json", "error", F.col(key), F.col(key))
    good = docs.where(~F.col(broken) & F.col(doc).isNotNull())
    for r in required:
        out = out.unionByName(issue(good.where(F.col(f"{doc}.{r}").isNull()), "missing_key", "error", F.lit(r), F.col(key)))
    each = good.select(key, F.explode(f"{doc}.{items}").alias("item"))
    for f in item_fields:
        out = out.unionByName(issue(each.where(F.coalesce(F.trim(F.col(f"item.{f}").cast("string")), F.lit("")) == ""), "missing_item_field", "error", F.lit(f), F.col(key)))
    for f, allowed in enums.items():
        out = out.unionByName(issue(each.where(~F.coalesce(F.col(f"item.{f}"), F.lit("")).isin(*allowed)), f"invalid_{f}", "error", F.col(f"item.{f}"), F.col(key)))
    return out


def extraction_score(blocks: DataFrame, key: str) -> DataFrame:
    """Of fenced blocks: blocks, those told apart, and rows of the last of each kind."""
    return blocks.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_blocks"), F.count("kind").alias("n_known"), F.coalesce(F.sum(F.when(F.col("is_last"), F.col("n_rows"))), F.lit(0)).alias("n_rows")
    )


def file_issues(files: DataFrame, shards: DataFrame, required: Sequence[str], pairs: Sequence[tuple[str, str]] = (), shard: str = "shard_id") -> DataFrame:
    """(shard, severity, code, detail): required files that a shard lacks or that are empty, and pairs of which it has one only.

    files: shard, file, size, one row for each; shards: those that must have them.
    """
    have = files.groupBy(shard).agg(F.map_from_entries(F.collect_list(F.struct("file", "size"))).alias("_files"))  # a shard has a handful of files
    own = shards.select(shard).distinct().join(have, shard, "left").withColumn("_files", F.coalesce("_files", F.create_map().cast("map<string,bigint>")))
    size = lambda f: F.try_element_at("_files", F.lit(f))
    found = [F.when(size(f).isNull(), F.struct(F.lit("error").alias("severity"), F.lit("missing_file").alias("code"), F.lit(f).alias("detail"))) for f in required]
    found += [F.when(size(f) == 0, F.struct(F.lit("error").alias("severity"), F.lit("empty_file").alias("code"), F.lit(f).alias("detail"))) for f in required]
    found += [F.when(size(a).isNull() != size(b).isNull(), F.struct(F.lit("warning").alias("severity"), F.lit("file_pair_incomplete").alias("code"), F.lit(f"{a},{b}").alias("detail"))) for a, b in pairs]
    return own.select(F.col(shard).cast("string").alias("shard"), F.explode(F.array_compact(F.array(*found))).alias("i")).select("shard", "i.*")


def count_issues(counts: DataFrame, expected: DataFrame, code: str, severity: str = "error", shard: str = "shard_id") -> DataFrame:
    """(shard, severity, code, detail): shards whose number of rows is not the expected one; both tables have the shard and n."""
    both = expected.select(shard, F.col("n").alias("_want")).join(counts.select(shard, F.col("n").alias("_got")), shard, "left")
    odd = both.where(F.col("_want") != F.coalesce("_got", F.lit(0)))
    return issue(odd, code, severity, F.concat(F.lit("expected_"), F.col("_want"), F.lit(":got_"), F.coalesce("_got", F.lit(0))), F.col(shard))
