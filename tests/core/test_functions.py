"""Traps of the text and number functions, and the keyword language."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.functions import numeric, text, udfs
from plumbline.operators import keywords
from plumbline.plans import prescreen, triage
from plumbline.sources import readers, writers


def values(spark, rows, make):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r.v for r in df.select("i", make(F.col("x")).alias("v")).orderBy("i").collect()]


def test_normalising(spark):
    rows = [None, "", " a  b　c ", "（ＡＢ），、x﹣y", "①"]
    assert values(spark, rows, text.normalize_text) == ["", "", "a b c", "(AB),,x-y", "1"]
    assert values(spark, rows, text.compact) == ["", "", "abc", "(AB),,x-y", "1"]
    assert values(spark, ["a(b)(c(d)e)·f", "“a”,b"], lambda x: text.compact_key(x, True)) == ["a(ce)f", "ab"]


def test_identity(spark):
    words, aliases = ("双一流", "独立学院"), {"甲": "乙"}
    assert values(spark, ["甲(双一流建设)", "丙(北京)", "丙(独立学院)(威海)"], lambda x: text.identity_key(x, words, aliases)) == ["乙", "丙(北京)", "丙(威海)"]
    got = values(spark, ["a", "a(b)", ""], lambda x: text.identity_candidates(x, F.lit("省·市"), {"a(市)": "z"}))
    assert got == [["a", "z"], ["a(b)"], []]
    assert values(spark, ["甲(x)", "乙", "", "丙"], lambda x: text.compatible_keys(x, F.lit("乙"), aliases)) == [True, True, False, False]


def test_numbers(spark):
    rows = ["12.5", "-5", "12.0", "1,200", "", None, "abc", "１２"]
    assert values(spark, rows, text.digits) == [125, 5, 12, 1200, None, None, None, 12]
    rows = ["nan", "12d", "1_000", " 1.5 ", "1,200", None, "1e3", "inf"]
    assert values(spark, rows, lambda x: text.number(x, True)) == [None, None, None, 1.5, 1200.0, None, 1000.0, None]
    assert values(spark, ["11万", "2.5", "3.5", "免费10", "", "x1,200.5元"], text.money) == [110000, 2, 4, 0, None, 1200]
    assert values(spark, ["7", "12345", None, "x", "7.0"], lambda x: text.pad_code(x, 4)) == ["0007", "12345", "", "", "0007"]
    assert values(spark, ["7.0", "abc", "12-3", None], lambda x: text.normalize_code(x, 4)) == ["0007", "abc", "0123", ""]


def test_lines(spark):
    got = values(spark, ["name x 1 22 333", "1 2", "none", "a 1b 2"], text.tail_numbers)
    assert [(r.head, r.tail) for r in got] == [("name x", [1, 22, 333]), ("1", [2]), ("none", []), ("a 1b", [2])]
    got = values(spark, ["数学 物理&化学", "法学 不限", "哲学"], lambda x: text.subject_tail(x, ("物理", "化学"), "不限"))
    assert [(r.head, r.subject) for r in got] == [("数学", "物理&化学"), ("法学", "不限"), ("哲学", "")]
    got = values(spark, ["0012某大学(浙江·杭州)数学 1", "某大学(一)(北京)", "数学"], lambda x: text.header(x, ("浙江", "北京")))
    assert (got[0].code, got[0].name, got[0].location, got[0].rest) == ("0012", "某大学", "浙江·杭州", "数学 1") and got[1].name == "某大学(一)" and got[2] is None


def test_tags(spark):
    row = " a ; b,c；d e|f、g "
    kinds = {"spaced": ["a", "b", "c", "d", "e|f、g"], "listed": ["a", "b", "c", "d e|f、g"], "piped": ["a", "b", "c；d e", "f、g"], "marked": ["a", "b", "c；d e", "f", "g"]}
    for kind, want in kinds.items():
        assert values(spark, [row, None], lambda x, k=kind: text.split_tags(x, k)) == [want, []]
    assert values(spark, ["s1;None, not_found s2"], text.split_sources) == [["s1", "s2"]]
    assert values(spark, ["????", "???", "a�", None], text.mojibake) == [True, False, True, False]
    assert values(spark, ["评估 结果为 a+ 后", "B 之评估 A-"], lambda x: text.near_pairs(x, "评估", "[ABC][+-]")) == [["A+"], ["A-"]]


def test_negation():
    assert not udfs.occurs_unnegated("未见导师", ["导师"]) and udfs.occurs_unnegated("未见课程。有导师", ["导师"])
    assert udfs.occurs_unnegated("无" + "x" * 40 + "导师", ["导师"]) and not udfs.occurs_unnegated("无" + "x" * 39 + "导师", ["导师"])
    assert not udfs.occurs_unnegated("导师不足", ["导师"]) and udfs.occurs_unnegated("导师" + "x" * 8 + "不足", ["导师"])
    assert udfs.occurs_unnegated("无独卫", ["无独卫"]) and not udfs.occurs_unnegated("没有无独卫", ["无独卫"])
    asserted = lambda t: udfs.occurs_asserted(t, ["强制早操"], ["早操"], ["要求"])
    assert asserted("学校要求早操") and not asserted("学校未见要求早操") and not asserted("要求" + "x" * 60 + "早操") and asserted("强制早操")


def test_buckets(spark):
    df = spark.sql("select explode(array(-1, 0, 20000, 20001, 400000, 400001, null)) as x")
    assert [r.b for r in df.select(numeric.rank_bin(F.col("x")).alias("b")).collect()] == ["out", "0_20k", "0_20k", "20k_30k", "250k_400k", "out", "out"]
    row = spark.range(1).select(
        numeric.weighted_mean([F.lit(10.0), F.lit(None).cast("double"), F.lit(30.0)], (0.2, 0.3, 0.5)).alias("m"), numeric.confidence_factor(F.lit("mixed")).alias("c"),
        numeric.penalty(F.array(F.lit("small_plan"), F.lit("x"))).alias("p"), numeric.normal_cdf(F.lit(1.0)).alias("n"), numeric.normal_cdf(F.lit(-1.0)).alias("o"),
    ).first()
    assert row.m == pytest.approx(170 / 7) and row.c == 0.75 and row.p == 8 and row.n == pytest.approx(0.8413447, abs=1e-7) and row.n + row.o == pytest.approx(1)


WORDS = st.sampled_from(["a", "b", "ab", "-x", "!y", "x y", "and", "or", '"q', "非", "(z)", "0001-040", "c\\d"])
TREES = st.recursive(
    WORDS.map(keywords.Term), lambda t: st.one_of(t.map(keywords.Not), st.lists(t, min_size=2, max_size=3).map(lambda p: keywords.Both(tuple(p))), st.lists(t, min_size=2, max_size=3).map(lambda p: keywords.Either(tuple(p)))), max_leaves=8
)


@settings(max_examples=200, deadline=None)
@given(TREES, st.lists(WORDS, max_size=6))
def test_keywords_shown_and_read_mean_the_same(tree, words):
    again = keywords.parse(keywords.show(tree))
    assert keywords.holds(again, " ".join(words)) == keywords.holds(tree, " ".join(words))


def test_keywords(spark):
    texts = ["alpha beta", "alpha gamma", "0001-040 beta", "", "delta's and"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    find = lambda q: [r.x for r in keywords.search(df, q, text.haystack(F.col("x"))).collect()]
    assert find("") == texts and find(None) == texts and find("alpha OR") == [] and find("()") == [] and find('"') == [] and find("''") == []
    assert find("alpha beta") == ["alpha beta"] and find("ALPHA 或 0001-040") == texts[:3] and find("alpha -beta") == ["alpha gamma"]
    assert find("NOT NOT (alpha gamma)") == ["alpha gamma"] and find("contains delta's") == [texts[4]] and find('"and"') == [texts[4]] and find("a or b c") == find("a or (b and c)")
    for q in ("alpha !beta", "(alpha or 0001-040) beta", "not (alpha and beta) 'a'"):
        tree = keywords.parse(q)
        assert find(q) == [t for t in texts if keywords.holds(tree, t)]


def test_classify_and_triage(spark):
    rows = [("数学类", ""), ("软件工程", ""), ("计算机科学与技术", "校企"), ("理科试验班", "含统计学"), ("哲学", "含人工智能 密码"), ("哲学", ""), ("统计学", "师范")]
    df = spark.createDataFrame(rows, "n string, r string")
    got = [r.c for r in df.select(prescreen.classify(F.col("n"), F.col("r")).alias("c")).collect()]
    assert [(g.keep, g.category, g.fit) for g in got] == [
        (True, "core_math_stat", 100), (False, "excluded_major", 0), (True, "core_cs_ai", 96), (True, "trial_class", 66), (True, "target_in_remark", 58), (False, "not_target", 0), (False, "excluded_major", 0)
    ]
    assert got[4].risks == ["contains_excluded_major_in_remark", "target_only_in_remark"] and got[3].risks == ["class_diversion", "trial_or_experimental_class"]
    base = {"college_name": "双一流大学", "major_category": "core_cs_ai", "prescreen_priority": "A", "rank_band": "稳", "crawl_status": "ok", "source_ids": "a;b;c", "tuition": "5000"}
    cases = [({}, triage.KEEP, ""), ({"tuition_raw": "6万"}, triage.DROP, "tuition_over_50000_rmb"), ({"tuition_raw": "5万"}, triage.BORDERLINE, ""), ({"risk_tags": "off_target_courses"}, triage.BORDERLINE, ""),
             ({"major_category": "target_class", "risk_tags": "major_diversion_risk"}, triage.DROP, "unsafe_major_diversion"), ({"remark": "须赴英 外方学费", "tuition": "x"}, triage.DROP, "required_or_unpriced_foreign_phase_cost"),
             ({"crawl_status": "not_found", "rank_band": "远保底"}, triage.DROP, "not_found_and_low_prescreen_priority")]
    keys = sorted({k for c, _, _ in cases for k in c} | set(base))
    df = spark.createDataFrame([(i, *[{**base, **c}.get(k) for k in keys]) for i, (c, _, _) in enumerate(cases)], "i int, " + ", ".join(f"{k} string" for k in keys))
    got = {r.i: r for r in triage.triage_items(df).collect()}
    for i, (_, bucket, reason) in enumerate(cases):
        assert got[i].triage_bucket == bucket and reason in got[i].drop_reasons.split(";")


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿id,x\n1,"a ""b""\nc"\n2,\n', encoding="utf-8")
    got = readers.read_strings(spark, str(tmp_path / "a.csv"), "file")
    assert [tuple(r) for r in got.orderBy("id").collect()] == [("1", 'a "b"\nc', "a.csv"), ("2", "", "a.csv")]
    assert readers.read_optional(spark, str(tmp_path / "none.csv"), "id string").count() == 0
    (tmp_path / "m.json").write_text('{"shards": [{"shard_id": "s1", "rows": "a.csv"}]}')
    assert readers.read_shards(spark, str(tmp_path / "m.json"), str(tmp_path)).select("shard_id").distinct().first()[0] == "s1"
    (tmp_path / "c.csv").write_text("专业,院校\n数学,甲\n,\n统计,乙\n", encoding="utf-8")
    choices = readers.read_choices(spark, str(tmp_path / "c.csv"), {"专业": "major", "院校": "college"}, ["college", "major"])
    assert [(r.order, r.college, r.major) for r in choices.orderBy("order").collect()] == [(1, "甲", "数学"), (2, "乙", "统计")]
    writers.write_csv(got.drop("file"), str(tmp_path / "out"))
    assert readers.read_strings(spark, str(tmp_path / "out")).count() == 2
    docs = spark.createDataFrame([('{"a": 1}',), ("{",), (None,)], "j string")
    assert [(r.doc.a if r.doc else None, r.broken) for r in readers.json_documents(docs, "j", "a int").collect()] == [(1, False), (None, True), (None, False)]
    assert writers.import_config(writers.export_config({"a": 1}, 2), 2) == {"a": 1} and writers.merged_config({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    with pytest.raises(ValueError):
        writers.import_config("{}", 1)
