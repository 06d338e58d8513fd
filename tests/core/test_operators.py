"""Matching, ranking, landing, validation and scoring on small rows made for their traps."""

import math

import pytest
from pyspark.sql import functions as F

from plumbline.operators import aggregates, joins, matching, projection, quality, ranking
from plumbline.plans import landing, prescreen, reference_model, scoring

ITEM = "item_id string, group_code string, group_key string, name string, key string, base_key string, duration int"
RECORD = "record_id int, year int, group_code string, group_key string, name string, key string, base_key string, rank int, duration int"


def match(spark, items, records, rejected=(), choices=()):
    i = spark.createDataFrame(items, ITEM)
    r = spark.createDataFrame(records, RECORD)
    bad = spark.createDataFrame(list(rejected), "level string, group_code string, name string, record_name string")
    pick = spark.createDataFrame(list(choices), "item_id string, year int, chosen string")
    got = matching.match(i, r, [2024], bad, pick)
    rows = lambda df: sorted((x.item_id, x.level, x.record_id) for x in df.collect())
    return rows(got.matched), sorted((x.item_id, x.candidate_count, x.candidates, x.status) for x in got.ambiguous.collect()), rows(got.mismatched), rows(got.rejected)


def item(i, name, base=None, code="1", key="A", duration=4):
    return (i, code, key, name, name, name if base is None else base, duration)


def record(i, name, base=None, code="1", key="A", rank=1, duration=4):
    return (i, 2024, code, key, name, name, name if base is None else base, rank, duration)


def test_exact_before_base_and_duplicates_do_not_match(spark):
    items = [item("a", "x"), item("b", "y(1)", "y"), item("c", "z"), item("d", "w(1)", "w"), item("e", "w(2)", "w"), item("f", "n", "")]
    records = [record(1, "x"), record(2, "y(2)", "y"), record(3, "z", rank=1), record(4, "z", rank=2), record(5, "w"), record(6, "", "")]
    matched, ambiguous, mismatched, rejected = match(spark, items, records)
    assert matched == [("a", "exact", 1), ("b", "base", 2)] and not mismatched and not rejected
    assert ambiguous == [("c", 2, "z", None)]  # w is not unique among items, and an empty base key matches nothing


def test_code_goes_before_key(spark):
    items = [item("a", "x"), item("b", "q", code="2", key="B")]
    records = [record(1, "x", code="", key="A"), record(2, "q", code="2", key="B"), record(3, "q", code="", key="B")]
    assert match(spark, items, records)[0] == [("a", "exact", 1), ("b", "exact", 2)]
    assert match(spark, [item("a", "x", code="9")], [record(1, "x", code="1", key="A")])[0] == []  # a record with a code is not found by key


def test_rejected_hits_are_logged_and_the_search_goes_on(spark):
    items, records = [item("a", "x(1)", "x")], [record(1, "x(1)", "x1"), record(2, "x", "x")]
    matched, _, _, rejected = match(spark, items, records, [("exact", "1", "x(1)", "x(1)")])
    assert matched == [("a", "base", 2)] and rejected == [("a", "exact", 1)]
    matched, _, _, rejected = match(spark, items, records, [("base", "1", "x(1)", "x")])
    assert matched == [("a", "exact", 1)] and rejected == []


def test_contained_and_chosen(spark):
    items = [item("a", "math"), item("b", "phys")]
    records = [record(1, "math pure"), record(2, "phys one", duration=4), record(3, "phys two", duration=5, rank=2)]
    matched, ambiguous, _, _ = match(spark, items, records)
    assert matched == [("a", "contains_unique", 1)] and ambiguous == [("b", 2, "phys one; phys two", None)]
    assert match(spark, items, records, choices=[("b", 2024, "phys two")])[0][1] == ("b", "manual_ambiguous", 3)
    twice = [*records, record(4, "phys two", duration=4, rank=3)]
    assert match(spark, items, twice, choices=[("b", 2024, "phys two")])[0][1] == ("b", "manual_ambiguous", 4)  # of the same duration
    assert match(spark, items, [*twice, record(5, "phys two", duration=4, rank=9)], choices=[("b", 2024, "phys two")])[1] == [("b", 4, "phys one; phys two", "not_unique")]
    matched, ambiguous, _, rejected = match(spark, items, records, [("manual_ambiguous", "1", "phys", "phys two")], [("b", 2024, "phys two")])
    assert len(matched) == 1 and not ambiguous and not rejected


def test_another_group_is_a_mismatch(spark):
    matched, _, mismatched, _ = match(spark, [item("a", "x")], [record(1, "x", key="B")])
    assert not matched and mismatched == [("a", "exact", 1)]


def test_history_and_reference_values(spark):
    df = spark.createDataFrame([("g", 1, None, None), ("g", None, 5, 9), ("g", None, None, None), ("h", None, None, None)], "g string, a int, b int, c int")
    got = {(r.g, r.v): (r.v_source, r.v_confidence) for r in reference_model.reference_values(df, ["a", "b", "c"], ["g"], "v").collect()}
    assert got == {("g", 1.0): ("a", "medium"), ("g", 9.0): ("c", "high"), ("g", 5.0): ("group_anchor", "low"), ("h", None): ("missing", "none")}
    s = aggregates.row_summary([F.col("a"), F.col("b"), F.col("c")])
    rows = df.select(s["years_matched"].alias("n"), s["ranks"].alias("r"), s["latest_rank"].alias("l"), s["avg_rank"].alias("m")).collect()
    assert [tuple(r) for r in rows] == [(1, "1", 1, 1), (2, "5;9", 9, 7), (0, "", None, None), (0, "", None, None)]
    t = spark.createDataFrame([(k, float(v)) for k, vs in enumerate([[1], [1, 2], [1, 2, 9], [3, 3, 3, 3], [1, 2, 3, 4]]) for v in vs], "k int, v double")
    got = {r.k: (r.t, r.u) for r in t.groupBy("k").agg(aggregates.trimmed_mean(F.col("v")).alias("t")).join(aggregates.upper_medians(t, ["k"], "v", "u"), "k").collect()}
    assert got == {0: (1, 1), 1: (1.5, 2), 2: (2, 2), 3: (3, 3), 4: (2.5, 3)}


@pytest.mark.parametrize(("n", "sizes"), [(1, [1]), (2, [1, 1]), (3, [1, 1, 1]), (4, [2, 2]), (7, [3, 3, 1])])
def test_tiers(spark, n, sizes):
    got = ranking.tiers(spark.range(n).withColumn("s", F.lit(1)), [F.desc("s"), F.asc("id")]).groupBy("tier").count().orderBy("tier").collect()
    assert [r["count"] for r in got] == sizes


def test_numbering_is_gapless(spark):
    rows = ranking.numbered(spark.range(5000).repartition(7).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(50))), [F.desc("v"), F.asc("id")]).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, 5001)) and [(-r.v, r.id) for r in rows] == sorted((-r.v, r.id) for r in rows)


def test_quota_floor_and_trim(spark):
    pool = spark.createDataFrame([(i, "a" if i < 3 else "b", 100 - i, i % 5 == 4) for i in range(40)], "k int, band string, s int, new boolean")
    order = [F.desc("s"), F.asc("k")]
    got = ranking.select_by_quota(pool, "k", "band", {"a": 5, "b": 4}, 12, F.col("new"), 4, order).orderBy("final_rank").collect()
    assert len(got) == 12 and sum(r.new for r in got) == 4 and {0, 1, 2} <= {r.k for r in got} and [r.final_rank for r in got] == list(range(1, 13))
    got = ranking.select_two_parts(pool, "k", [(F.col("band") == "b", 6), (F.col("band") == "a", 2)], 10, F.col("new"), 4, order, [F.asc("s"), F.asc("k")]).collect()
    assert len(got) == 10 and sum(r.new for r in got) == 4


def test_balance_keeps_groups_whole(spark):
    df = spark.createDataFrame([(g, i) for g, n in (("a", 5), ("b", 4), ("c", 3), ("d", 3), ("e", 1)) for i in range(n)], "g string, i int")
    got = {r.g: r.shard for r in ranking.balance(df, "g", 2).select("g", "shard").distinct().collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


def pool_of(spark, n):
    return spark.createDataFrame([(30_000.0 + 10 * i, 0.01 * (i % 7 - 3), "cs", i % 12, i % 2 == 0) for i in range(n)], "rank_mid double, delta double, family string, plan_count int, region boolean").selectExpr(
        "rank_mid", "delta as delta_z", "family", "plan_count", "region", "delta as model_delta_z"
    ).withColumn("rank_bin", F.lit("30k_37k")).withColumn("plan_bin", F.lit("plan_3_5"))


CHOICES = [(1, 1, 30_000.0, "cs", 4, True, 3), (2, 2, 31_000.0, "cs", 4, False, 1), (3, 3, 32_500.0, "cs", 2, True, 0)]
CHOICE = "choice int, order int, rank double, family string, plan_count int, region boolean, history int"


@pytest.mark.parametrize(("n", "tier"), [(400, "rank+family"), (60, "near_rank_fallback"), (30, "near_rank_fallback+rankbin_shrink"), (10, "near_rank_fallback+rankbin_shrink")])
def test_landing(spark, n, tier):
    choices, samples = spark.createDataFrame(CHOICES, CHOICE), pool_of(spark, n)
    pool = landing.similarity_pool(choices, samples)
    sums = {r.choice: (r.w, r.tier, r.e) for r in pool.groupBy("choice").agg(F.sum("weight").alias("w"), F.first("tier").alias("tier"), F.first("effective_n").alias("e")).collect()}
    assert all(w == pytest.approx(1) and e > 1 for w, _, e in sums.values())
    got = landing.landing(choices, samples, 31_500.0).orderBy("order").collect()
    assert sum(r.admit for r in got) + got[-1].none == pytest.approx(1) and all(0 <= r.chance <= 1 for r in got)
    assert got[0].reach == 1 and got[1].reach == pytest.approx(1 - got[0].chance) and tier in {t for _, t, _ in sums.values()}
    if n == 60:
        draws = 20_000
        seen = {r.choice: r.admit for r in landing.drawn(choices, pool, 31_500.0, draws, 3).collect()}
        assert all(abs(seen.get(r.choice, 0) - r.admit) < 5 * math.sqrt(0.25 / draws) for r in got)


def test_missing_ranks(spark):
    choices = spark.createDataFrame([(1,), (2,), (3,)], "choice int")
    model = spark.createDataFrame([(1, 5.0), (2, None)], "choice int, rank double")
    own = spark.createDataFrame([(2, 7.0)], "choice int, rank double")
    assert [(r.choice, r.rank) for r in landing.with_missing(choices, model).collect()] == [(1, 5.0)]
    got = {r.choice: (r.rank, r.found) for r in landing.with_missing(choices, model, "manual", own).collect()}
    assert got == {1: (5.0, "matched"), 2: (7.0, "manual")}
    with pytest.raises(ValueError):
        landing.with_missing(choices, model, "reject")


def test_joins(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, x string")
    right = spark.createDataFrame([(1, "p"), (1, "q"), (2, "r")], "k int, y string")
    assert sorted((r.k, r.y) for r in joins.lookup_unique(left, right, ["k"]).collect()) == [(1, None), (2, "r"), (3, None)]
    assert sorted((r.k, r.y) for r in joins.lookup_last(left, right, ["k"], F.col("y")).collect() if r.y) == [(1, "q"), (2, "r")]
    with pytest.raises(ValueError):
        joins.one_to_one(left, right, "k")
    got = joins.repair(left, spark.createDataFrame([(2, "z"), (3, "c")], "k int, x string"), "k", ["x"]).orderBy("k").collect()
    assert [(r.x, r.n_changed) for r in got] == [("a", 0), ("z", 1), ("c", 0)]


def test_validation(spark):
    contract = quality.Contract(["k", "kind", "tags", "refs"], "k", ["kind"], {"kind": ["a", "b"]}, {"tags": ["t"]}, ["refs"])
    rows = spark.createDataFrame([("1", "a", "t", "s1"), ("1", "a", "t;u", "s1;s9"), ("3", "c", "", "not_found"), ("4", "a", "", "")], "k string, kind string, tags string, refs string").withColumn("shard_id", F.lit("x"))
    expected = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "a")], "k string, kind string")
    sources = spark.createDataFrame([("s1",), ("s1",)], "source_id string")
    got = {(r.code, r.n) for r in quality.issue_totals(quality.validate(rows, sources, expected, contract)).collect()}
    assert got == {("missing_row", 1), ("extra_row", 1), ("identity_changed", 1), ("duplicate_row", 1), ("duplicate_source", 1), ("invalid_kind", 1), ("unknown_tags", 1), ("dangling_refs", 1)}
    kept = quality.keep_known_references(rows.where("k = '1' and tags like '%u'"), sources, "refs", "k").first()
    assert kept.refs == "s1"
    one = rows.select(quality.normalize_tags(F.lit("T; old,gone;odd"), {"old": "u", "gone": None}, ["t", "u"]).alias("t"), quality.normalize_enum(F.lit(" X"), {"x": "a"}, ["a", "b"], "b").alias("e")).first()
    assert one.t == "t;u" and one.e == "a"


def test_profile_scores(spark):
    rows = spark.createDataFrame([(1, 100.0, 0.5), (2, 0.0, 1.0), (3, 100.0, 1.0)], "k int, alignment_score double, cap double")
    factors = spark.createDataFrame([(1, "good", "high"), (1, "bad", "low"), (2, "bad", "odd"), (3, "good", "high"), (3, "plat", "medium")], "k int, factor string, confidence string")
    weights, parts = {"good": 10.0, "bad": -20.0, "plat": 40.0}, {"good": "alignment", "bad": "alignment", "plat": "platform"}
    got = {r.k: r.quality_score for r in scoring.profile_scores(rows, factors, "k", weights, parts).collect()}
    assert got == {1: pytest.approx(22.5 + 5 - 11), 2: 0.0, 3: pytest.approx(45 + 25)}
    tags = spark.createDataFrame([(1, "x", "low", "e2", "s"), (1, "y", "high", "e1", "t"), (1, "", "high", "", "")], "k int, label string, confidence string, evidence string, source string")
    t = scoring.tag_catalog(tags, "k", {"y": "x"}).collect()
    assert len(t) == 1 and (t[0].label, t[0].confidence, t[0].evidence, t[0].sources) == ("x", "high", ["e1", "e2"], ["s", "t"])
    merged = scoring.merged_tags(spark.createDataFrame([("a", 1), ("b", 2)], "label string, w int"), spark.createDataFrame([("b", 9), ("c", 3)], "label string, w int"))
    assert sorted((r.label, r.w) for r in merged.collect()) == [("a", 1), ("b", 9), ("c", 3)]


def test_labels(spark):
    df = spark.createDataFrame([("150", "9", "高", "是"), ("x", None, "?", "")], "label_fit string, label_priority string, label_risk string, label_exclude string")
    got = [tuple(r) for r in prescreen.normalize_labels(df).collect()]
    assert got == [(100.0, 5.0, "high", "yes"), (0.0, 1.0, "medium", "no")]


def test_reshaping(spark):
    df = spark.createDataFrame([(1, "x", " ", 3)], "a int, b string, c string, d int")
    got = projection.sections(df, {"first": [("a", "A"), ("c", "C")], "none": [("c", "C")]}).first()
    assert [(s.title, [(e.label, e.value) for e in s.entries]) for s in got.sections] == [("first", [("A", "1")]), ("other", [("b", "x"), ("d", "3")])] and got.flat["c"] == " "
    assert projection.first_columns(df, ["d", "zz"]).columns == ["d", "a", "b", "c"] and projection.keep(df, ["zz", "b"]).columns == ["b"]
