"""Parsed files that are kept, so that a further run parses only what has changed.

A folder holds two tables: files, a manifest of what was parsed (path, length, modified, version, and the
run that did it), and rows, what the parser gave, by run. A file counts as changed when its path, length,
modification time or the parser's version is not in the manifest. Nothing is rewritten: a row is current
if its run is the last one of its file.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.storage import settle

_FILES = "path string, length long, modified timestamp, version string, run string, at long"


def parsed(spark: SparkSession, paths: str | Sequence[str], folder: str, parse: Callable[[DataFrame], DataFrame], version: str) -> tuple[DataFrame, DataFrame]:
    """The rows of all files at the paths, and the files that this run parsed.

    parse: from (path, content) to rows with a column path; it is given only files that the folder does not
    hold as they are now. Rows of files that are gone are not returned, and come back with their file.
    """
    listed = spark.read.format("binaryFile").load(paths)
    now = settle(listed.select("path", "length", F.col("modificationTime").alias("modified")).withColumn("version", F.lit(version)))
    known = _read(spark, f"{folder}/files", _FILES)
    same = ["path", "length", "modified", "version"]
    fresh = settle(now.join(known.select(*same).distinct() if known is not None else now.limit(0), same, "left_anti"))
    if not fresh.isEmpty():
        run = uuid.uuid4().hex
        number = 0 if known is None else (known.agg(F.max("at")).first()[0] or 0) + 1
        parse(listed.select("path", "content").join(fresh.select("path"), "path")).withColumn("run", F.lit(run)).write.mode("append").parquet(f"{folder}/rows")
        # The manifest comes last: a run that dies before leaves rows that nothing refers to.
        fresh.withColumns({"run": F.lit(run), "at": F.lit(number).cast("long")}).write.mode("append").parquet(f"{folder}/files")
        known = _read(spark, f"{folder}/files", _FILES)
    if known is None:
        raise ValueError("no files were ever parsed, so the rows' columns are not known")
    last = known.join(now, same).groupBy("path").agg(F.max_by("run", "at").alias("run"))
    return spark.read.parquet(f"{folder}/rows").join(last, ["path", "run"], "left_semi").drop("run"), fresh


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(schema).parquet(path) if there else None
