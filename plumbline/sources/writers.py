"""Writers: CSV, JSON payloads, shards and rendered reports."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, quote_all: bool = False) -> None:
    df.write.mode("overwrite").csv(path, header=True, quoteAll=quote_all, escape='"', emptyValue="", encoding="UTF-8")


def write_tables(tables: dict[str, DataFrame], path: str, sort: dict[str, Sequence[str]] | None = None) -> None:
    """Each table as Parquet, sorted inside files by the columns that lookups use, in place of indexes."""
    for name, df in tables.items():
        keys = [k for k in (sort or {}).get(name, ()) if k in df.columns]
        (df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df).write.mode("overwrite").parquet(f"{path}/{name}")


def write_by(df: DataFrame, path: str, column: str, format: str = "csv") -> None:
    """One folder for each value of the column; rows of a value meet in one task first, split by adaptive execution if large."""
    df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).options(header=True, escape='"', emptyValue="").format(format).save(path)


def payload(df: DataFrame) -> DataFrame:
    """One column of JSON objects, nulls kept."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def text_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Codes as strings, for writers that would guess numbers."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns})


def cell(x: Column, kind: str) -> Column:
    """A value as reports show it: share, number with two decimals, whole number, or text; null is empty."""
    shown = {"share": F.format_string("%.4f%%", F.bround(x * 100, 4)), "number": F.format_string("%.2f", F.bround(x, 2)), "whole": F.bround(x).cast("long").cast("string")}.get(kind, x.cast("string"))
    return F.when(x.isNull(), F.lit("")).otherwise(shown)


def render(title: str, rows: Sequence[dict], columns: Sequence[str]) -> str:
    """A Markdown table of some aggregated rows."""
    out = [f"## {title}", "", "| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
    return "\n".join(out + ["| " + " | ".join(str(r.get(c, "")) for c in columns) + " |" for r in rows]) + "\n"


def export_config(config: dict, version: int) -> str:
    return json.dumps({"schema_version": version, "config": config}, ensure_ascii=False, sort_keys=True, indent=2)


def import_config(text: str, version: int) -> dict:
    """The config of an export; another schema version is refused."""
    got = json.loads(text)
    if not isinstance(got, dict) or got.get("schema_version") != version or not isinstance(got.get("config"), dict):
        raise ValueError(f"not a config of schema version {version}")
    return got["config"]


def merged_config(*layers: dict | None) -> dict:
    """Layers of settings, later ones over earlier ones, nested objects key by key."""
    out: dict = {}
    for layer in layers:
        for k, v in (layer or {}).items():
            out[k] = merged_config(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out
