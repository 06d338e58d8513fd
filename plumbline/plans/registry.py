"""All queries of the library over the test tables, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """Tables of a folder by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable:
    """Registers a function of Tables under its name, with the SQL that gives the same rows."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


from plumbline.plans import queries_cells, queries_domain, queries_relational, queries_text  # noqa: E402, F401
