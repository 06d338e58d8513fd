"""Workbooks and the parse cache on odd rows; order by a locale."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from plumbline.operators import ranking
from plumbline.sources import cache, spreadsheets

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def book(sheets, shared=None):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Target="{"/xl/" if i else ""}worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        for i, xml in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {MAIN}><sheetData>{xml}</sheetData></worksheet>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{shared}</sst>")
    return out.getvalue()


def test_cells_of_other_programs(spark):
    first = '<row r="2"><c r="B2" t="s"><v>1</v></c><c r="AB2"><v>1.50</v></c></row><row><c t="b"><v>1</v></c><c t="s"><v>0</v></c><c><f>A1</f></c><c><f>1+1</f><v>2</v></c></row>'
    shared = "<si><t>plain</t></si><si><r><t>two </t></r><r><t>runs</t></r><rPh><t>read</t></rPh></si>"
    files = spark.createDataFrame([("a", book({"x": first, "y": '<row r="1"><c t="inlineStr"><is><t>in</t></is></c></row>'}, shared)), ("none", None), ("empty", b"")], "file string, content binary")
    got = [tuple(r) for r in spreadsheets.cells(files).orderBy("file", "sheet", "row_no").collect()]
    assert got == [("a", "x", 2, [None, "two runs", *[None] * 25, "1.50"]), ("a", "x", 3, ["TRUE", "plain", None, "2"]), ("a", "y", 1, ["in"])]


def test_workbooks_come_back(spark, tmp_path):
    rows = [("g", i, f"0{i}", f'a <b> & "{i}"\n\x01é', i / 4 if i % 3 else None) for i in range(25)] + [(None, 1, "007", None, float("nan")), ("h/i", 2, " ", "", 1e300)]
    df = spark.createDataFrame(rows, "by string, k int, code string, t string, v double")
    made = spreadsheets.workbooks(df, "by", [F.asc("k")], ["code"], "title", most=10)
    assert spreadsheets.save(made, str(tmp_path)) == 5 and spreadsheets.save(made.where("false"), str(tmp_path)) == 0
    got = {(r.file, r.row_no): (r.k, r.code, r.t, r.v) for r in spreadsheets.sheet_table(spreadsheets.read_cells(spark, str(tmp_path)), ["k", "code", "t", "v"], 2).collect()}
    want = {(f"g-{i // 10}.xlsx", i % 10 + 3): (str(i), f"0{i}", f'a <b> & "{i}"\né', None if i % 3 == 0 else str(i / 4)) for i in range(25)}
    assert got == want | {("none-0.xlsx", 3): ("1", "007", None, "NaN"), ("h_i-0.xlsx", 3): ("2", " ", None, "1.0E300")}
    assert spreadsheets.sheet_table(spreadsheets.read_cells(spark, str(tmp_path)), ["k", "code", "t"], 2, ["t"]).count() == 25


def test_lists_without_a_header_go_by_position(spark):
    files = spark.createDataFrame([("a", book({"s": "".join(f'<row><c t="inlineStr"><is><t>{v}</t></is></c><c><v>{i}</v></c></row>' for i, v in enumerate(["x", "y", ""]))}))], "file string, content binary")
    got = spreadsheets.listed_table(spreadsheets.cells(files), {"school": "name"}, ["name", "order"]).orderBy("order").collect()
    assert [tuple(r) for r in got] == [("x", 1), ("y", 2)]


def test_parse_cache(spark, tmp_path):
    files, folder = tmp_path / "in", str(tmp_path / "kept")
    files.mkdir()
    for n in "abc":
        (files / n).write_text(n)
    seen = []

    def parse(df):
        out = df.select("path", F.upper(F.col("content").cast("string")).alias("t"))
        seen.append(sorted(r.t for r in out.collect()))
        return out

    def rows(version="1"):
        got, fresh = cache.parsed(spark, f"{files}/*", folder, parse, version)
        return sorted(r.t for r in got.collect()), fresh.count()

    assert rows() == (["A", "B", "C"], 3) and rows() == (["A", "B", "C"], 0)
    (files / "b").write_text("other")
    (files / "c").unlink()
    assert rows() == (["A", "OTHER"], 1) and rows() == (["A", "OTHER"], 0)
    assert rows("2") == (["A", "OTHER"], 2) and seen == [["A", "B", "C"], ["OTHER"], ["A", "OTHER"]]


@pytest.mark.parametrize("descending", [False, True])
def test_order_by_pinyin(spark, descending):
    # Schools by pinyin.
    schools = ["安徽大学", "北京大学", "重庆大学", "东南大学", "复旦大学", "贵州大学", "湖南大学", "吉林大学", "兰州大学", "南京大学", "清华大学", "山东大学", "天津大学", "武汉大学", "西安交通大学", "云南大学", "浙江大学"]
    names = [s + t for s in schools for t in ("", "甲", "乙", "丙", "丁", "戊", "己", "庚", "辛", "壬", "癸", "子")]
    df = spark.createDataFrame([(n,) for n in reversed(names)] + [(None,)], "n string")
    got = [r.n for r in df.orderBy(ranking.sort_key(F.col("n"), descending, locale="zh")).collect()]
    assert len(names) > 200 and (got[0] if descending else got[-1]) is None
    first = [n for n in got if n in schools]
    assert first == (schools[::-1] if descending else schools)
