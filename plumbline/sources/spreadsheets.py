"""Workbooks of spreadsheets, read and written as the zipped XML parts that they are.

Files are read by Spark's own binary source, so they may lie wherever Spark reads; each is parsed as a
stream in the task that has it, and gives one row for each row of its sheets. Workbooks are made of
Arrow groups that never exceed a sheet's rows; a larger table goes on in further workbooks.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import ranking

# Names of the format's parts.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_TYPES = "application/vnd.openxmlformats-officedocument.spreadsheetml"
#: Rows of a workbook's sheet that are written, its title and header apart, and rows of a batch that are read.
SHEET_ROWS, BATCH_ROWS = 1_000_000, 4096
#: Characters that XML has no way to write.
_UNWRITABLE = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")

CELLS = "file string, sheet string, row_no int, cells array<string>"


def read_cells(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, sheet, row_no, cells) of the workbooks at a path or paths, globs allowed; see cells()."""
    return cells(spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_name").alias("file"), "content"))


def cells(files: DataFrame) -> DataFrame:
    """(file, sheet, row_no from 1, cells) of workbooks (file, content): every row that a sheet has, blank cells as null.

    Numbers are as the file writes them, formulas give their last value, booleans TRUE and FALSE. A cell
    without a place follows the one before it. Null and empty contents have no rows; others that are no
    workbook fail.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content").to_pylist(), strict=True):
                rows: list[tuple] = []
                for row in _rows(content) if content else ():
                    rows.append((file, *row))
                    if len(rows) == BATCH_ROWS:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    return files.select("file", "content").mapInArrow(run, CELLS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int32(), pa.list_(pa.string()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["file", "sheet", "row_no", "cells"])


def _rows(content: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row number, cells) of a workbook, sheets in their order, one row in memory at a time."""
    main = f"{{{_MAIN}}}"
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as part:
                for _, item in ElementTree.iterparse(part):
                    if item.tag == f"{main}si":
                        shared.append(_text(item))
                        item.clear()
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{main}sheet"):
            target = links[sheet.get(f"{{{_LINKS}}}id")]
            with book.open(target[1:] if target.startswith("/") else f"xl/{target}") as part:
                at = 0
                for _, row in ElementTree.iterparse(part):
                    if row.tag == f"{main}row":
                        at = int(row.get("r") or at + 1)
                        values: list[str | None] = []
                        for c in row.iter(f"{main}c"):
                            place = _column(c.get("r")) if c.get("r") else len(values)
                            values += [None] * (place - len(values))
                            values.append(_value(c, shared))
                        yield sheet.get("name"), at, values
                        row.clear()


def _column(place: str) -> int:
    """The number from 0 of a place such as AB12."""
    n = 0
    for c in place:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - ord("A") + 1
    return n - 1


def _text(item: ElementTree.Element) -> str:
    """The text of a string that may consist of runs; readings beside it are left out."""
    readings = {t for p in item.iter(f"{{{_MAIN}}}rPh") for t in p.iter(f"{{{_MAIN}}}t")}
    return "".join(t.text or "" for t in item.iter(f"{{{_MAIN}}}t") if t not in readings)


def _value(c: ElementTree.Element, shared: list[str]) -> str | None:
    kind, v = c.get("t"), c.find(f"{{{_MAIN}}}v")
    if kind == "inlineStr":
        got = _text(c)
    elif v is None or v.text is None:
        return None
    else:
        got = shared[int(v.text)] if kind == "s" else {"0": "FALSE", "1": "TRUE"}.get(v.text, v.text) if kind == "b" else v.text
    return got or None


def sheet_table(rows: DataFrame, names: Sequence[str], header_row: int = 1, required: Sequence[str] = (), sheet: str | None = None) -> DataFrame:
    """A table of read_cells(): columns named by position, rows below the header that are not blank and have all required cells.

    file and row_no tell where each row is from. sheet picks one sheet; without it all count.
    """
    below = rows.where((F.col("row_no") > header_row) & (F.lit(True) if sheet is None else F.col("sheet") == sheet))
    below = below.where(F.exists("cells", lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""))
    out = below.select("file", "row_no", *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)])
    for r in required:
        out = out.where(F.trim(F.coalesce(F.col(r), F.lit(""))) != "")
    return out


def listed_table(rows: DataFrame, synonyms: dict[str, str], names: Sequence[str]) -> DataFrame:
    """An ordered list from read_cells(): names plus order from 1, blank rows dropped.

    The first row of each file is a header if it has a known synonym; else its columns go by position.
    """
    table = F.create_map(*[F.lit(v) for pair in synonyms.items() for v in pair])
    heads = rows.groupBy("file").agg(F.min_by("cells", F.struct("sheet", "row_no")).alias("_head"), F.min(F.struct("sheet", "row_no")).alias("_first"))
    heads = heads.withColumn("_names", F.transform("_head", lambda c: F.try_element_at(table, F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "^﻿", ""))))))
    known = F.exists("_names", lambda n: n.isNotNull())
    joined = rows.join(heads, "file").where(~(known & (F.struct("sheet", "row_no") == F.col("_first"))))
    place = lambda n, i: F.when(known, F.array_position("_names", n)).otherwise(F.lit(i + 1).cast("long"))
    columns = [F.trim(F.coalesce(F.when(place(n, i) > 0, F.try_element_at("cells", place(n, i).cast("int"))), F.lit(""))).alias(n) for i, n in enumerate(names)]
    kept = joined.select("file", "sheet", "row_no", *columns).where(F.concat_ws("", *[n for n in names if n != "order"]) != "")
    own = F.col("order").try_cast("int") if "order" in names else F.lit(None).cast("int")
    return ranking.numbered(kept.withColumn("_own", own), [F.asc_nulls_last("_own"), F.asc("file"), F.asc("sheet"), F.asc("row_no")], "order").select(*[n for n in names if n != "order"], "order")


def workbooks(df: DataFrame, by: str, order: Sequence[Column], codes: Sequence[str] = (), title: str = "", sheet: str = "Sheet1", most: int = SHEET_ROWS) -> DataFrame:
    """(file, content): a workbook of the rows of each value of by, in order, and as many as it takes for more than most rows.

    A sheet begins with its title, if it has one, and the names of the columns. Numbers are numbers but for
    codes, which are texts as all else is; null cells are left out. Files are named by the value and a number.
    """
    kinds = dict(df.dtypes)
    shown = [c for c in df.columns if c != by]
    numeric = {c for c in shown if c not in codes and re.match(r"(tiny|small|big)?int|float|double|decimal", kinds[c])}
    rows = ranking.placed(df, [by], order).withColumn("_part", F.floor((F.col("_place") - 1) / most))
    name = F.concat(F.coalesce(F.col(by).cast("string"), F.lit("none")), F.lit("-"), F.col("_part").cast("string"), F.lit(".xlsx"))
    ready = rows.select(name.alias("file"), "_place", *[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(shown)])

    def run(table: pa.Table) -> pa.Table:
        own = table.sort_by("_place")
        lines = zip(*(own.column(f"c{i}").to_pylist() for i in range(len(shown))), strict=True)
        content = _workbook(sheet, title, shown, lines, [c in numeric for c in shown])
        return pa.table({"file": own.column("file").slice(0, 1), "content": pa.array([content], pa.binary())})

    return ready.groupBy("file").applyInArrow(run, "file string, content binary")


def _workbook(sheet: str, title: str, names: Sequence[str], rows: Iterable[tuple], numeric: Sequence[bool]) -> bytes:
    said = lambda v: f'<c t="inlineStr"><is><t xml:space="preserve">{escape(_UNWRITABLE.sub("", v))}</t></is></c>'
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        parts = {"xl/workbook.xml": "sheet.main", "xl/worksheets/sheet1.xml": "worksheet"}
        book.writestr("[Content_Types].xml", f'{head}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>' + "".join(f'<Override PartName="/{p}" ContentType="{_TYPES}.{k}+xml"/>' for p, k in parts.items()) + "</Types>")
        for place, kind, target in (("_rels/.rels", "officeDocument", "xl/workbook.xml"), ("xl/_rels/workbook.xml.rels", "worksheet", "worksheets/sheet1.xml")):
            book.writestr(place, f'{head}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_LINKS}/{kind}" Target="{target}"/></Relationships>')
        quoted = escape(sheet, {'"': "&quot;"})
        book.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{_MAIN}" xmlns:r="{_LINKS}"><sheets><sheet name="{quoted}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        with book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as part:
            part.write(f'{head}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
            at = 0
            for line in ([(title,)] if title else []) + [tuple(names)]:
                at += 1
                part.write(f'<row r="{at}">{"".join(map(said, line))}</row>'.encode())
            letters = [_letters(i) for i in range(len(names))]
            for line in rows:
                at += 1
                values = [(c, v, n) for c, v, n in zip(letters, line, numeric, strict=True) if v is not None]
                shown = [f'<c r="{c}{at}"><v>{v}</v></c>' if n and v not in ("NaN", "Infinity", "-Infinity") else said(v).replace("<c ", f'<c r="{c}{at}" ', 1) for c, v, n in values]
                part.write(f'<row r="{at}">{"".join(shown)}</row>'.encode())
            part.write(b"</sheetData></worksheet>")
    return out.getvalue()


def _letters(i: int) -> str:
    out, i = "", i + 1
    while i:
        i, rest = divmod(i - 1, 26)
        out = chr(ord("A") + rest) + out
    return out


def save(books: DataFrame, folder: str) -> int:
    """Writes workbooks (file, content) to a folder of any file system that Spark writes to, one at a time; how many there were."""
    spark, n = books.sparkSession, 0
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for row in books.toLocalIterator():
        place = hadoop(folder, row["file"].replace("/", "_").replace(":", "_"))
        stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
        try:
            stream.write(bytearray(row["content"]))
        finally:
            stream.close()
        n += 1
    return n
