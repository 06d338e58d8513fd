"""Reference values: the latest year's value, else a trimmed mean of the group, with provenance and confidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.aggregates import trimmed_mean


def reference_values(df: DataFrame, years: Sequence[str], group: Sequence[str], name: str = "value_ref") -> DataFrame:
    """df with name, its source, its confidence and the group's anchor.

    years: columns, oldest first. The latest that is there is taken; without any, the trimmed mean of the
    group's latest values. Sources are the column's name, group_anchor or missing; confidence is high for the
    newest, medium for the others, low for the anchor and none without a value.
    """
    latest = F.coalesce(*[F.col(y) for y in reversed(years)])
    source = F.coalesce(*[F.when(F.col(y).isNotNull(), F.lit(y)) for y in reversed(years)])
    rows = df.withColumn("_latest", latest).withColumn("_source", source)
    anchors = rows.groupBy(*group).agg(trimmed_mean(F.col("_latest")).alias("anchor"))
    joined = rows.join(anchors, list(group), "left")
    confidence = F.when(F.col("_source") == years[-1], "high").when(F.col("_source").isNotNull(), "medium").when(F.col("anchor").isNotNull(), "low").otherwise("none")
    return joined.select(
        *df.columns, F.coalesce("_latest", "anchor").alias(name), F.coalesce("_source", F.when(F.col("anchor").isNotNull(), "group_anchor"), F.lit("missing")).alias(f"{name}_source"),
        confidence.alias(f"{name}_confidence"), "anchor",
    )
