"""Queries whose results depend on what lies behind the first characters of a text."""

import pytest

from plumbline.functions import udfs
from plumbline.plans import registry

FAR = "word " * 40


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rows = [(3, FAR + "宿舍紧张", "en", "src1"), (6, "short", "en", "src1"), (60, FAR + "。资源较弱", "de", "src2")]
    spark.createDataFrame([(i, t, lang, s, len(t)) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(3, 1, 0)], "doc_id long, quality long, toxic long").write.parquet(f"{d}/labels.parquet")
    turns = [(7, 0, "user", "hello"), (7, 1, "assistant", "one two three\nfour LAST")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{d}/conversations.parquet")
    return d


def rows(spark, folder, name):
    return registry.QUERIES[name](spark, folder).collect()


def test_evidence_is_the_whole_text(spark, folder):
    got = {(r.doc_id, r.factor) for r in rows(spark, folder, "score_factors")}
    assert (3, "dorm_risk") in got and (6, "dorm_risk") not in got


def test_notes_are_the_whole_text(spark, folder):
    from plumbline.plans import triage

    docs = spark.createDataFrame([(3, FAR + triage.WEAK_RESOURCES[0], "en", "src1", 300), (6, FAR, "en", "src1", 300)], "doc_id long, text string, lang string, source string, n_chars long")
    d = f"{folder}/triage"
    docs.write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{d}/labels.parquet")
    got = {r.doc_id: r.borderline_reasons for r in rows(spark, d, "triage_domain")}
    assert "campus_or_resource_weak_signal" in got[3] and "campus_or_resource_weak_signal" not in got[6]


def test_negation_over_the_whole_text(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: r.asserted for r in rows(spark, folder, "negation_window")}
    assert got == {i: udfs.occurs_unnegated(f"未见{t}导师", ["导师"]) for i, t in texts.items()} and set(got.values()) == {True, False}


def test_lines_and_haystacks_have_the_whole_turn(spark, folder):
    assert [r.name for r in rows(spark, folder, "line_parser")] == ["one two three four LAST"]
    assert {r.hay for r in rows(spark, folder, "row_haystack")} == {"user hello", "assistant one two three\nfour last"}


def test_split_has_every_label(spark, tmp_path):
    sides = {1: "F", 2: "O", 3: "X", 4: None, 5: "", 6: "1/2", 7: "07"}
    d = str(tmp_path)
    for name, rows in (("some", sides), ("none", {})):
        spark.createDataFrame([(k, k + 1, v) for k, v in rows.items()], "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(f"{d}/{name}/orders.parquet")
        got = registry.QUERIES["split_by_label"](spark, f"{d}/{name}").collect()
        assert len(got) == len(rows) and {r.o_orderkey: r.side for r in got} == rows


def test_split_keeps_rows_of_repeated_and_null_keys(spark, tmp_path):
    sides = [(1, "F"), (1, "F"), (1, "O"), (2, "P"), (2, "P"), (2, None), (None, "F"), (None, "F"), (None, "O"), (None, None)]
    spark.createDataFrame([(k, 1, v) for k, v in sides], "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    got = [(r.o_orderkey, r.side) for r in registry.QUERIES["split_by_label"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(sides, key=str)
