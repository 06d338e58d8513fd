"""Projections and reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators import ranking


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Those of the columns that df has, in the given order."""
    return df.select(*[c for c in columns if c in df.columns])


def typed(df: DataFrame, columns: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """The columns, numbers parsed (texts that are none stay null) and other blanks null; absent ones are null."""
    def one(c: str) -> Column:
        if c not in df.columns:
            return F.lit(None).cast("double" if c in numeric else "string").alias(c)
        return (text.number(F.col(c), True) if c in numeric else text.blank_to_null(F.col(c).cast("string"))).alias(c)

    return df.select(*map(one, columns))


def first_columns(df: DataFrame, preferred: Sequence[str]) -> DataFrame:
    front = [c for c in preferred if c in df.columns]
    return df.select(*front, *[c for c in df.columns if c not in front])


def with_columns(df: DataFrame, columns: Sequence[str], value: str = "") -> DataFrame:
    return df.withColumns({c: F.lit(value) for c in columns if c not in df.columns})


def widen(df: DataFrame, key: str, by: str, values: Sequence[object], fields: Sequence[str]) -> DataFrame:
    """One row for each key; fields of each value as columns value_field. Values are given, so nothing is scanned for them."""
    return df.groupBy(key).agg(*[F.first(F.when(F.col(by) == v, F.col(f)), ignorenulls=True).alias(f"{v}_{f}") for v in values for f in fields])


def pairs(df: DataFrame, keep: Sequence[str], values: Sequence[str]) -> DataFrame:
    """A row for each two neighbouring values that are both there and positive: old, new."""
    structs = [F.struct(F.lit(a).alias("from"), F.col(a).alias("old"), F.col(b).alias("new")) for a, b in zip(values, values[1:], strict=False)]
    out = df.select(*keep, F.explode(F.array(*structs)).alias("p")).select(*keep, "p.*")
    return out.where("old > 0 and new > 0")


def sections(df: DataFrame, layout: dict[str, Sequence[tuple[str, str]]], name: str = "sections") -> DataFrame:
    """df with an array of sections of labelled, non-blank values; columns that no section names are under other."""
    listed = {c for cells in layout.values() for c, _ in cells}
    rest = [(c, c) for c in df.columns if c not in listed]
    parts = []
    for title, cells in [*layout.items(), ("other", rest)]:
        entries = [F.struct(F.lit(label).alias("label"), F.col(f"`{c}`").cast("string").alias("value")) for c, label in cells if c in df.columns]
        if entries:
            parts.append(F.struct(F.lit(title).alias("title"), F.filter(F.array(*entries), lambda e: F.trim(F.coalesce(e["value"], F.lit(""))) != "").alias("entries")))
    flat = F.map_from_entries(F.array(*[F.struct(F.lit(c), F.col(f"`{c}`").cast("string")) for c in df.columns]))
    return df.withColumns({name: F.filter(F.array(*parts), lambda s: F.size(s["entries"]) > 0), "flat": flat})


def expand(df: DataFrame, struct: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != struct], f"{struct}.*")


def in_parts(df: DataFrame, group: str, fields: Sequence[str], name: str, most: int) -> DataFrame:
    """(group, part from 0, name): the rows of each group as structs, in order of the fields, in as many rows as it takes with at most most each."""
    placed = ranking.placed(df.select(group, *fields), [group], [F.asc_nulls_first(f) for f in fields]).withColumn("part", F.floor((F.col("_place") - 1) / most))
    return placed.groupBy(group, "part").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def packets(df: DataFrame, group: str, name: str, fields: Sequence[str], most: int = 10_000) -> DataFrame:
    """(group, part, rows, n_rows, n_names): each group's rows in parts of at most most rows; how many rows and different names the group has."""
    sizes = df.groupBy(F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(name).alias("n_names"))
    parts = in_parts(df, group, fields, "rows", most)
    return parts.join(sizes, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")


def repair_where(df: DataFrame, known: dict[str, object], set_to: dict[str, Column | object]) -> DataFrame:
    """df with the given values in rows that have exactly the known ones: a repair of one known fault."""
    hit = F.lit(True)
    for c, v in known.items():
        hit = hit & F.col(c).eqNullSafe(F.lit(v))
    return df.withColumns({c: F.when(hit, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)) for c, v in set_to.items()})


def history_line(year: int, rank: Column, score: Column, admitted: Column, level: Column) -> Column:
    """A year's record as one line of text; null without a rank and a score."""
    parts = F.concat_ws(", ", F.concat(F.lit("score "), score.cast("string")), F.concat(F.lit("rank "), rank.cast("string")), F.concat(F.lit("admitted "), admitted.cast("string")), level)
    return F.when(rank.isNotNull() | score.isNotNull(), F.concat(F.lit(f"{year}: "), parts))


def labelled_line(parts: Sequence[tuple[str, Column, str]], separator: str = " · ", otherwise: str = "") -> Column:
    """One line of the parts that a row has, each between its label and its unit; otherwise where it has none."""
    shown = [F.when(F.coalesce(v.cast("string"), F.lit("")) != "", F.concat(F.lit(before), v.cast("string"), F.lit(after))) for before, v, after in parts]
    return F.when(F.coalesce(*shown).isNull(), F.lit(otherwise)).otherwise(F.concat_ws(separator, *shown))


def admission_summary(plan: Column, price: Column, subject: Column, rank: Column, score: Column, year: int) -> Column:
    """A row's admission at a glance: places, price, subjects, and the last year's rank and score."""
    return labelled_line([("计划 ", plan, " 人"), ("学费 ", price, " 元/年"), ("", subject, ""), (f"{year}位次 ", rank, ""), (f"{year}最低分 ", score, "")], otherwise="主表未匹配")


def evidence_lines(panels: Column, kinds: dict[str, str]) -> Column:
    """Panels (kind, status, confidence, training, summary, gaps) as one line: the kind's label, the three marks, and what was found or is missing."""
    blank = lambda c, to: F.coalesce(F.nullif(c, F.lit("")), to)
    marks = lambda p: F.concat_ws("|", *[blank(p[f], F.lit("-")) for f in ("status", "confidence", "training")])
    line = lambda p: F.concat(text.label(p["kind"], kinds), F.lit("["), marks(p), F.lit("]: "), blank(p["summary"], blank(p["gaps"], F.lit(""))))
    return F.array_join(F.transform(F.coalesce(panels, F.array().cast("array<struct<kind:string,status:string,confidence:string,training:string,summary:string,gaps:string>>")), line), " || ")


def header_counts(df: DataFrame, shown: Column, matched: Column, tagged: Column) -> DataFrame:
    """One row: all rows, those shown, matched and tagged."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(shown).alias("shown"), F.count_if(matched).alias("matched"), F.count_if(tagged).alias("tagged"))
