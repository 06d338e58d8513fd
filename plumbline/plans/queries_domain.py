"""Queries of the composite operators: matching, reference values, prescreen, landing, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import numeric, text
from plumbline.operators import joins, matching, projection, quality
from plumbline.plans import landing, prescreen, reference_model, scoring, triage
from plumbline.plans.registry import Tables, query
from plumbline.sources import writers

_YEARLY_SQL = """y AS (SELECT l_partkey, year(l_shipdate) AS y, min(l_extendedprice) AS v FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 1998 GROUP BY ALL),
w AS (SELECT p_partkey, p_brand, p_type, max(CASE WHEN y = 1996 THEN v END) AS y1996, max(CASE WHEN y = 1997 THEN v END) AS y1997, max(CASE WHEN y = 1998 THEN v END) AS y1998 FROM part LEFT JOIN y ON l_partkey = p_partkey GROUP BY ALL)"""


def _history(t: Tables) -> DataFrame:
    rows = t.lineitem.where("year(l_shipdate) between 1996 and 1998")
    by_year = rows.groupBy("l_partkey", F.year("l_shipdate").alias("y")).agg(F.min("l_extendedprice").alias("v"))
    wide = projection.widen(by_year, "l_partkey", "y", [1996, 1997, 1998], ["v"]).toDF("l_partkey", "y1996", "y1997", "y1998")
    return t.part.join(wide, F.col("p_partkey") == F.col("l_partkey"), "left").select("p_partkey", "p_brand", "p_type", "y1996", "y1997", "y1998")


@query(f"""WITH {_YEARLY_SQL}, r AS (SELECT *, coalesce(y1998, y1997, y1996) AS latest FROM w),
a AS (SELECT p_brand, p_type, CASE WHEN count(latest) > 2 THEN (sum(latest) - min(latest) - max(latest)) / (count(latest) - 2) WHEN count(latest) > 0 THEN sum(latest) / count(latest) END AS anchor FROM r GROUP BY ALL)
SELECT p_partkey, round(coalesce(latest, anchor), 6) AS value_ref, CASE WHEN y1998 IS NOT NULL THEN 'y1998' WHEN y1997 IS NOT NULL THEN 'y1997' WHEN y1996 IS NOT NULL THEN 'y1996' WHEN anchor IS NOT NULL THEN 'group_anchor' ELSE 'missing' END AS value_ref_source,
 CASE WHEN y1998 IS NOT NULL THEN 'high' WHEN latest IS NOT NULL THEN 'medium' WHEN anchor IS NOT NULL THEN 'low' ELSE 'none' END AS value_ref_confidence FROM r LEFT JOIN a USING (p_brand, p_type)""")
def reference_value_model(t: Tables) -> DataFrame:
    got = reference_model.reference_values(_history(t), ["y1996", "y1997", "y1998"], ["p_brand", "p_type"])
    return got.select("p_partkey", F.round("value_ref", 6).alias("value_ref"), "value_ref_source", "value_ref_confidence")


_MATCH_SQL = """p AS (SELECT p_partkey, p_brand || '/' || p_type AS grp, p_name, string_split(p_name, ' ')[2] AS word, p_size, p_partkey % 2 AS side, p_partkey // 2 AS k FROM part),
i AS (SELECT p_partkey AS item_id, grp, p_name AS name, p_name AS key, coalesce(word, '') AS base FROM p WHERE side = 0),
h AS (SELECT p_partkey AS record_id, grp, CASE WHEN k % 3 = 0 THEN coalesce(word, '') ELSE p_name END AS name, CASE WHEN k % 3 = 0 THEN coalesce(word, '') ELSE p_name END AS key, coalesce(word, '') AS base, p_size AS rank FROM p WHERE side = 1),
lone AS (SELECT grp, base FROM i WHERE base <> '' GROUP BY ALL HAVING count(*) = 1),
ue AS (SELECT grp, key, min(record_id) AS record_id FROM h WHERE key <> '' GROUP BY ALL HAVING count(*) = 1), ub AS (SELECT grp, base, min(record_id) AS record_id FROM h WHERE base <> '' GROUP BY ALL HAVING count(*) = 1),
m AS (SELECT item_id, 'exact' AS level, 1 AS o, record_id FROM i JOIN ue USING (grp, key) UNION ALL SELECT item_id, 'base', 2, record_id FROM i JOIN lone USING (grp, base) JOIN ub USING (grp, base)),
c AS (SELECT item_id, h.record_id, h.key, h.rank, h.name FROM i JOIN lone USING (grp, base) JOIN h ON h.grp = i.grp AND h.base <> '' AND (contains(h.base, i.base) OR contains(i.base, h.base)) WHERE item_id NOT IN (SELECT item_id FROM m)),
g AS (SELECT item_id, count(*) AS n, count(DISTINCT (key, coalesce(rank, -1))) AS kinds, max(record_id) AS record_id, array_to_string(list_sort(list(DISTINCT name))[1:10], '; ') AS names FROM c GROUP BY item_id),
f AS (SELECT item_id, arg_min(level, o) AS level, arg_min(record_id, o) AS record_id FROM m GROUP BY item_id UNION ALL SELECT item_id, 'contains_unique', record_id FROM g WHERE kinds = 1)"""


def _matches(t: Tables, rejected: DataFrame | None = None, choices: DataFrame | None = None, group_of: Column | None = None) -> matching.Matches:
    word = F.coalesce(F.try_element_at(F.split("p_name", " "), F.lit(2)), F.lit(""))
    rows = t.part.select(
        F.col("p_partkey"), F.lit("").alias("group_code"), F.concat_ws("/", "p_brand", "p_type").alias("group_key"), "p_name", word.alias("base_key"), F.col("p_size").alias("rank"), F.lit(4).alias("duration"), F.lit(2024).alias("year")
    )
    items = rows.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("item_id"), F.col("group_key").alias("group_code"), "group_key", F.col("p_name").alias("name"), F.col("p_name").alias("key"), "base_key", "duration")
    name = F.when(F.floor(F.col("p_partkey") / 2) % 3 == 0, F.col("base_key")).otherwise(F.col("p_name"))
    records = rows.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("record_id"), "year", "group_code", "group_key", name.alias("name"), name.alias("key"), "base_key", "rank", "duration")
    return matching.match(items, records, [2024], rejected, choices, group_of)


@query(f"WITH {_MATCH_SQL} SELECT item_id, level, record_id FROM f")
def cascade_match(t: Tables) -> DataFrame:
    return _matches(t).matched.select("item_id", "level", "record_id")


@query(f"WITH {_MATCH_SQL} SELECT item_id, n::BIGINT AS candidate_count, names AS candidates FROM g WHERE kinds > 1")
def ambiguous_audit(t: Tables) -> DataFrame:
    return _matches(t).ambiguous.select("item_id", "candidate_count", "candidates")


@query(f"""WITH {_MATCH_SQL}, pick AS (SELECT item_id, min(name) AS chosen FROM c GROUP BY item_id HAVING count(DISTINCT (key, coalesce(rank, -1))) > 1),
fit AS (SELECT item_id, count(DISTINCT (c.key, c.rank)) AS n, max(record_id) AS record_id FROM c JOIN pick USING (item_id) WHERE c.name = chosen GROUP BY item_id)
SELECT item_id, 'manual_ambiguous' AS level, record_id FROM fit WHERE n = 1 UNION ALL SELECT item_id, 'not_unique', NULL FROM fit WHERE n > 1 UNION ALL SELECT item_id, level, record_id FROM f""")
def curated_choices(t: Tables) -> DataFrame:
    """Of several contained candidates the chosen one is taken, if it is one; else the audit says so."""
    unsure = _matches(t).ambiguous
    picks = unsure.select("item_id", "year", F.substring_index("candidates", "; ", 1).alias("chosen"))
    got = _matches(t, choices=picks)
    return got.matched.select("item_id", "level", "record_id").unionByName(got.ambiguous.select("item_id", F.col("status").alias("level"), F.lit(None).cast("long").alias("record_id")))


@query(f"""WITH {_MATCH_SQL}, g2 AS (SELECT p_partkey, p_brand FROM part) SELECT item_id, level, record_id, g.p_brand <> 'Brand#11' AND b.p_brand <> 'Brand#11' AS matched FROM f JOIN g2 g ON g.p_partkey = item_id JOIN g2 b ON b.p_partkey = record_id""")
def identity_guard(t: Tables) -> DataFrame:
    """Matches whose group has no canonical form, or another one, are logged and not taken, and nothing else is tried."""
    own = F.when(F.startswith(F.col("g"), F.lit("Brand#11")), F.lit("")).otherwise(F.col("g"))
    got = _matches(t, group_of=own)
    return got.matched.select("item_id", "level", "record_id", F.lit(True).alias("matched")).unionByName(got.mismatched.select("item_id", "level", "record_id", F.lit(False).alias("matched")))


def _ledger(t: Tables) -> DataFrame:
    word = F.coalesce(F.try_element_at(F.split("p_name", " "), F.lit(2)), F.lit(""))
    names = t.part.where("p_partkey % 2 = 0 and p_partkey % 5 = 0").select(F.concat_ws("/", "p_brand", "p_type").alias("group_code"), F.col("p_name").alias("name"), word.alias("record_name")).distinct()
    return names.select(F.lit("base").alias("level"), "group_code", "name", "record_name")


@query(f"""WITH {_MATCH_SQL}, l AS (SELECT DISTINCT grp, name, base FROM i WHERE item_id % 5 = 0), b AS (SELECT item_id, i.grp, i.name, record_id FROM i JOIN lone USING (grp, base) JOIN ub USING (grp, base) WHERE item_id NOT IN (SELECT item_id FROM m WHERE level = 'exact'))
SELECT item_id, record_id, h.name AS record_name FROM b JOIN h USING (record_id) JOIN l ON l.grp = b.grp AND l.name = b.name AND l.base = h.name""")
def rejected_audit(t: Tables) -> DataFrame:
    return _matches(t, _ledger(t)).rejected.select("item_id", "record_id", F.col("name").alias("record_name"))


@query("""WITH k AS (SELECT c_mktsegment || '/' || c_nationkey AS identity, (c_nationkey % 7)::VARCHAR AS group_key, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE (c_nationkey % 9)::VARCHAR END AS code FROM customer),
a AS (SELECT identity, min(code) AS code FROM k WHERE code <> '' GROUP BY identity HAVING count(DISTINCT code) = 1), b AS (SELECT group_key, min(code) AS code FROM k WHERE code <> '' GROUP BY group_key HAVING count(DISTINCT code) = 1)
SELECT s_suppkey AS record_id, coalesce(CASE WHEN s_suppkey % 4 = 0 THEN 'own' END, a.code, b.code, '') AS group_code, CASE WHEN s_suppkey % 4 = 0 THEN 'own' WHEN a.code IS NOT NULL THEN 'identity' WHEN b.code IS NOT NULL THEN 'key' ELSE '' END AS code_source
FROM supplier LEFT JOIN a ON a.identity = 'BUILDING/' || s_nationkey LEFT JOIN b ON b.group_key = (s_nationkey % 7)::VARCHAR""")
def code_backfill(t: Tables) -> DataFrame:
    known = t.customer.select(
        F.concat_ws("/", "c_mktsegment", "c_nationkey").alias("identity"), (F.col("c_nationkey") % 7).cast("string").alias("group_key"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise((F.col("c_nationkey") % 9).cast("string")).alias("group_code")
    )
    records = t.supplier.select(
        F.col("s_suppkey").alias("record_id"), F.when(F.col("s_suppkey") % 4 == 0, "own").otherwise("").alias("group_code"), (F.col("s_nationkey") % 7).cast("string").alias("group_key"),
        F.array(F.lit("nobody"), F.concat(F.lit("BUILDING/"), F.col("s_nationkey").cast("string"))).alias("candidates"),
    )
    return matching.back_fill(records, known).select("record_id", "group_code", "code_source")


@query("""WITH v AS (SELECT c_custkey, c_nationkey, c_mktsegment, CASE WHEN c_custkey % 4 = 0 OR c_nationkey = 5 THEN NULL ELSE c_acctbal END AS v FROM customer),
n AS (SELECT c_nationkey, median(v) AS near FROM v WHERE v IS NOT NULL GROUP BY ALL), s AS (SELECT c_mktsegment, median(v) AS wide FROM v WHERE v IS NOT NULL GROUP BY ALL)
SELECT c_custkey, round(coalesce(v, 0.65 * near + 0.35 * wide, near, wide), 6) AS predicted, CASE WHEN v IS NOT NULL THEN 'history' WHEN near IS NOT NULL AND wide IS NOT NULL THEN 'school_category_proxy' WHEN near IS NOT NULL THEN 'school_proxy' ELSE 'category_proxy' END AS certainty
FROM v LEFT JOIN n USING (c_nationkey) LEFT JOIN s USING (c_mktsegment)""")
def median_impute(t: Tables) -> DataFrame:
    v = F.when((F.col("c_custkey") % 4 != 0) & (F.col("c_nationkey") != 5), F.col("c_acctbal"))
    got = prescreen.impute(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", v.alias("v")), "v", "c_nationkey", "c_mktsegment")
    return got.select("c_custkey", F.round("predicted", 6).alias("predicted"), "certainty")


@query("""WITH o AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice <= 18000 THEN 8 WHEN o_totalprice <= 32000 THEN 24 WHEN o_totalprice <= 46000 THEN 35 WHEN o_totalprice <= 65000 THEN 32 WHEN o_totalprice <= 90000 THEN 22 WHEN o_totalprice <= 120000 THEN 8 ELSE -12 END AS band,
 CASE WHEN o_orderstatus = 'P' THEN 8 ELSE 0 END + CASE WHEN o_custkey % 3 = 0 THEN 12 ELSE 0 END AS pen FROM orders)
SELECT o_orderkey, (74 + band - pen)::DOUBLE AS score, CASE WHEN 74 + band - pen >= 100 THEN 'A' WHEN 74 + band - pen >= 84 THEN 'B' WHEN 74 + band - pen >= 68 THEN 'C' WHEN 74 + band - pen >= 52 THEN 'D' ELSE 'E' END AS priority FROM o""")
def prescreen_score(t: Tables) -> DataFrame:
    flags = F.array_compact(F.array(F.when(F.col("o_orderstatus") == "P", "small_plan"), F.when(F.col("o_custkey") % 3 == 0, "sino_foreign"), F.lit("unknown_flag")))
    score = (74 + numeric.scored(numeric.rank_band(F.col("o_totalprice")), numeric.BAND_SCORES) - numeric.penalty(flags)).cast("double")
    return t.orders.select("o_orderkey", score.alias("score"), numeric.priority(score).alias("priority"))


def _pool(t: Tables) -> DataFrame:
    """Customers as items of a prescreen: names from a list, ranks from their orders by year."""
    names = ("数学与应用数学", "计算机科学与技术", "计算机类", "软件工程", "理科试验班", "金融学")
    by_year = t.orders.groupBy("o_custkey", F.pmod(F.year("o_orderdate"), F.lit(3)).alias("y")).agg(F.min("o_totalprice").alias("v"))
    wide = projection.widen(by_year, "o_custkey", "y", [0, 1, 2], ["v"]).toDF("c_custkey", "rank_y1", "rank_y2", "rank_y3")
    rows = t.customer.join(wide, "c_custkey", "left")
    return rows.select(
        F.col("c_custkey").cast("string").alias("item_id"), F.col("c_nationkey").cast("string").alias("college_code"), F.concat(F.lit("大学"), F.col("c_nationkey")).alias("college_name"),
        F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("c_custkey") % 6 + 1).cast("int")).alias("major_name"), F.when(F.col("c_custkey") % 12 == 4, "含统计学").otherwise("").alias("remark"), F.lit("本科").alias("degree_level"),
        F.when(F.col("c_custkey") % 7 == 0, "历史").otherwise("物理&化学").alias("subject_key"), (F.col("c_custkey") % 13).alias("plan_count"), F.lit(5000.0).alias("tuition"),
        F.size(numeric.present(F.col("rank_y1"), F.col("rank_y2"), F.col("rank_y3"))).alias("history_years"), "rank_y1", "rank_y2", "rank_y3", F.lit(4).alias("admitted_y1"), F.lit(4).alias("admitted_y2"), F.lit(None).cast("int").alias("admitted_y3"),
    )


_POOL_SQL = f"""yv AS (SELECT o_custkey, year(o_orderdate) % 3 AS y, min(o_totalprice) AS v FROM orders GROUP BY ALL),
yw AS (SELECT o_custkey, max(CASE y WHEN 0 THEN v END) AS r1, max(CASE y WHEN 1 THEN v END) AS r2, max(CASE y WHEN 2 THEN v END) AS r3 FROM yv GROUP BY o_custkey),
it AS (SELECT c_custkey::VARCHAR AS item_id, c_nationkey::VARCHAR AS college, (['数学与应用数学', '计算机科学与技术', '计算机类', '软件工程', '理科试验班', '金融学'])[c_custkey % 6 + 1] AS major, CASE WHEN c_custkey % 12 = 4 THEN '含统计学' ELSE '' END AS remark,
 c_custkey % 13 AS plan, r1, r2, r3 FROM customer LEFT JOIN yw ON o_custkey = c_custkey WHERE c_custkey % 7 <> 0),
cl AS (SELECT *, CASE major WHEN '数学与应用数学' THEN 'core_math_stat' WHEN '计算机科学与技术' THEN 'core_cs_ai' WHEN '计算机类' THEN 'target_class' WHEN '理科试验班' THEN CASE WHEN remark <> '' THEN 'trial_class' ELSE 'not_target' END ELSE 'none' END AS category FROM it WHERE major <> '软件工程'),
ft AS (SELECT *, CASE category WHEN 'core_math_stat' THEN 100 WHEN 'core_cs_ai' THEN 96 WHEN 'target_class' THEN 74 ELSE 66 END AS fit, (r1 IS NOT NULL)::INT + (r2 IS NOT NULL)::INT + (r3 IS NOT NULL)::INT AS years,
 (coalesce(r1 * 0.2, 0) + coalesce(r2 * 0.3, 0) + coalesce(r3 * 0.5, 0)) / nullif(CASE WHEN r1 IS NULL THEN 0 ELSE 0.2 END + CASE WHEN r2 IS NULL THEN 0 ELSE 0.3 END + CASE WHEN r3 IS NULL THEN 0 ELSE 0.5 END, 0)::DOUBLE AS center FROM cl WHERE category NOT IN ('not_target', 'none')),
rk AS (SELECT *, list_sort(list_filter([CASE WHEN category IN ('target_class', 'trial_class') THEN 'class_diversion' END, CASE WHEN category = 'trial_class' THEN 'trial_or_experimental_class' END, CASE WHEN years = 0 THEN 'new_no_history' END,
 CASE WHEN years >= 2 AND greatest(r1, r2, r3) - least(r1, r2, r3) >= 30000 THEN 'high_rank_volatility' END, CASE WHEN plan <= 2 THEN 'small_plan' END], lambda x: x IS NOT NULL)) AS risks FROM ft),
md AS (SELECT *, median(center) OVER (PARTITION BY college) AS near, median(center) OVER (PARTITION BY category) AS wide, median(center) OVER () AS overall FROM rk),
im AS (SELECT *, coalesce(center, 0.65 * near + 0.35 * wide, near, wide, overall) AS predicted, CASE WHEN center IS NOT NULL THEN 'history' WHEN near IS NOT NULL AND wide IS NOT NULL THEN 'school_category_proxy' WHEN near IS NOT NULL THEN 'school_proxy' WHEN wide IS NOT NULL THEN 'category_proxy' ELSE 'global_proxy' END AS certainty FROM md),
bd AS (SELECT *, CASE WHEN predicted IS NULL THEN '无历史' WHEN predicted <= 18000 THEN '超冲' WHEN predicted <= 32000 THEN '冲' WHEN predicted <= 46000 THEN '贴合' WHEN predicted <= 65000 THEN '稳' WHEN predicted <= 90000 THEN '保' WHEN predicted <= 120000 THEN '低优先保底' ELSE '远保底' END AS band,
 list_sum(list_transform(risks, lambda x: CASE x WHEN 'class_diversion' THEN 18 WHEN 'trial_or_experimental_class' THEN 8 WHEN 'new_no_history' THEN 9 WHEN 'small_plan' THEN 8 WHEN 'high_rank_volatility' THEN 7 ELSE 0 END)) AS pen FROM im),
sc AS (SELECT *, (fit + CASE band WHEN '超冲' THEN 8 WHEN '冲' THEN 24 WHEN '贴合' THEN 35 WHEN '稳' THEN 32 WHEN '保' THEN 22 WHEN '低优先保底' THEN 8 WHEN '远保底' THEN -12 ELSE 14 END - coalesce(pen, 0)
 + CASE WHEN years >= 3 THEN 5 WHEN years = 2 THEN 3 ELSE 0 END + CASE WHEN plan >= 10 THEN 4 WHEN plan >= 5 THEN 2 ELSE 0 END + CASE WHEN plan - 4 >= 5 THEN 3 WHEN plan - 4 <= -3 THEN -4 ELSE 0 END)::DOUBLE AS score FROM bd),
pr AS (SELECT *, CASE WHEN score >= 100 THEN 'A' WHEN score >= 84 THEN 'B' WHEN score >= 68 THEN 'C' WHEN score >= 52 THEN 'D' ELSE 'E' END AS priority, row_number() OVER (ORDER BY score DESC, fit DESC, predicted ASC NULLS FIRST, plan DESC, item_id) AS pool_rank FROM sc)"""


@query(f"WITH {_POOL_SQL} SELECT pool_rank, item_id, category, fit, coalesce(array_to_string(risks, ';'), '') AS risks, round(predicted, 4) AS predicted, certainty, band, score, priority FROM pr")
def prescreen_pipeline(t: Tables) -> DataFrame:
    got = prescreen.prescreen(_pool(t), ["物理", "化学", "生物"])
    return got.select("pool_rank", "item_id", "category", "fit", F.array_join("risks", ";").alias("risks"), F.round("predicted", 4).alias("predicted"), "certainty", "band", "score", "priority")


_LABEL_SQL = f"""{_POOL_SQL}, l0 AS (SELECT *, category IN ('target_class', 'trial_class') AS loose FROM pr),
l1 AS (SELECT *, CASE WHEN loose THEN 'high' WHEN list_contains(risks, 'new_no_history') THEN 'medium' ELSE 'low' END AS label_risk FROM l0),
l2 AS (SELECT *, CASE WHEN NOT loose THEN CASE WHEN fit >= 96 AND label_risk = 'low' THEN 5 ELSE 4 END ELSE 2 END AS keep0 FROM l1),
l3 AS (SELECT *, (CASE WHEN band = '远保底' THEN least(keep0, 3) ELSE keep0 END)::DOUBLE AS label_priority FROM l2)"""

_SELECT_SQL = """f AS (SELECT *, score * 0.62 + fit * 0.28 + label_priority * 6 - CASE label_risk WHEN 'low' THEN 0 WHEN 'medium' THEN 5 ELSE 13 END + {more} AS final_score FROM l3),
o AS (SELECT *, row_number() OVER (ORDER BY final_score DESC, label_priority DESC, fit DESC, predicted ASC NULLS FIRST, item_id) AS pos FROM f)"""


@query("""WITH """ + _LABEL_SQL + """, """ + _SELECT_SQL.format(more="0") + """,
q AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY pos) <= CASE band WHEN '超冲' THEN 35 WHEN '冲' THEN 40 WHEN '贴合' THEN 60 WHEN '稳' THEN 65 WHEN '保' THEN 60 WHEN '低优先保底' THEN 30 WHEN '远保底' THEN 10 ELSE 0 END AS first FROM o),
t AS (SELECT *, first OR row_number() OVER (PARTITION BY first ORDER BY pos) <= greatest(0, 120 - (SELECT count(*) FROM q WHERE first)) AS taken FROM q),
m AS (SELECT *, taken OR (years = 0 AND row_number() OVER (PARTITION BY taken, years = 0 ORDER BY pos) <= greatest(0, 10 - (SELECT count(*) FROM t WHERE taken AND years = 0))) AS put FROM t),
k AS (SELECT *, row_number() OVER (PARTITION BY years = 0 ORDER BY pos) AS own FROM m WHERE put),
r AS (SELECT *, years = 0 AND own <= 10 AS sure FROM k),
z AS (SELECT *, (SELECT count(*) FROM k) <= 120 OR sure OR row_number() OVER (PARTITION BY sure ORDER BY pos) <= greatest(0, 120 - (SELECT count(*) FROM r WHERE sure)) AS stays FROM r)
SELECT row_number() OVER (ORDER BY pos) AS final_rank, item_id, round(final_score, 4) AS final_score, band FROM z WHERE stays""")
def quota_selection(t: Tables) -> DataFrame:
    pool = prescreen.final_score(prescreen.normalize_labels(prescreen.fallback_labels(prescreen.prescreen(_pool(t), ["物理", "化学", "生物"]))))
    return prescreen.select(pool, n=120, least=10).select("final_rank", "item_id", F.round("final_score", 4).alias("final_score"), "band")


@query("""WITH """ + _LABEL_SQL + """, """ + _SELECT_SQL.format(more="CASE WHEN category = 'core_math_stat' THEN 9 WHEN category = 'core_cs_ai' AND band IN ('保', '低优先保底', '远保底') THEN -12 WHEN category = 'core_cs_ai' THEN -6 ELSE 0 END") + """,
a AS (SELECT *, category = 'core_math_stat' AND row_number() OVER (PARTITION BY category ORDER BY pos) <= 60 OR category = 'core_cs_ai' AND row_number() OVER (PARTITION BY category ORDER BY pos) <= 30 AS first FROM o),
t AS (SELECT *, first OR row_number() OVER (PARTITION BY first ORDER BY pos) <= greatest(0, 90 - (SELECT count(*) FROM a WHERE first)) AS taken FROM a),
m AS (SELECT *, NOT taken AND years = 0 AND row_number() OVER (PARTITION BY taken, years = 0 ORDER BY pos) <= greatest(0, 10 - (SELECT count(*) FROM t WHERE taken AND years = 0)) AS more FROM t),
w AS (SELECT *, taken AND years > 0 AND row_number() OVER (PARTITION BY taken, years > 0 ORDER BY final_score, item_id) <= (SELECT count(*) FROM m WHERE more) AS out FROM m)
SELECT row_number() OVER (ORDER BY pos) AS final_rank, item_id, round(final_score, 4) AS final_score, band FROM w WHERE more OR taken AND NOT out ORDER BY pos LIMIT 90""")
def mathematics_first(t: Tables) -> DataFrame:
    pool = prescreen.final_score(prescreen.normalize_labels(prescreen.fallback_labels(prescreen.prescreen(_pool(t), ["物理", "化学", "生物"]))), "math_first")
    return prescreen.select(pool, "math_first", n=90, least=10).select("final_rank", "item_id", F.round("final_score", 4).alias("final_score"), "band")


@query(f"""WITH {_LABEL_SQL} SELECT item_id, label_risk, label_priority, 'no' AS label_exclude, fit::DOUBLE AS label_fit FROM l3""")
def fallback_labels(t: Tables) -> DataFrame:
    pool = prescreen.fallback_labels(prescreen.prescreen(_pool(t), ["物理", "化学", "生物"]))
    return pool.select("item_id", "label_risk", "label_priority", "label_exclude", "label_fit")


@query("""SELECT c_custkey, least(greatest(coalesce(try_cast(f AS DOUBLE), 0), 0), 100) AS label_fit, least(greatest(coalesce(try_cast(p AS DOUBLE), 0), 1), 5) AS label_priority, CASE lower(r) WHEN '中' THEN 'medium' WHEN '高' THEN 'high' WHEN 'low' THEN 'low' ELSE 'medium' END AS label_risk,
 CASE WHEN lower(e) IN ('是', 'true', 'yes') THEN 'yes' ELSE 'no' END AS label_exclude FROM (SELECT c_custkey, (['120', '-3', 'x', '55.5', ''])[c_custkey % 5 + 1] AS f, (['9', '0', '3', ''])[c_custkey % 4 + 1] AS p, (['中', '高', 'LOW', '?', ''])[c_nationkey % 5 + 1] AS r, (['是', 'TRUE', '否', 'maybe', 'yes'])[c_custkey % 5 + 1] AS e FROM customer)""")
def label_bounds(t: Tables) -> DataFrame:
    pick = lambda k, *cells: F.element_at(F.array(*map(F.lit, cells)), (F.col(k) % len(cells) + 1).cast("int"))
    rows = t.customer.select(
        "c_custkey", pick("c_custkey", "120", "-3", "x", "55.5", "").alias("label_fit"), pick("c_custkey", "9", "0", "3", "").alias("label_priority"), pick("c_nationkey", "中", "高", "LOW", "?", "").alias("label_risk"),
        pick("c_custkey", "是", "TRUE", "否", "maybe", "yes").alias("label_exclude"),
    )
    return prescreen.normalize_labels(rows)


_SAMPLES_SQL = """yy AS (SELECT l_partkey, year(l_shipdate) AS y, max(l_extendedprice) AS v FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 1998 GROUP BY ALL),
ww AS (SELECT p_type AS family, p_size AS plan_count, p_size % 2 = 0 AS region, max(CASE WHEN y = 1996 THEN v END) AS a, max(CASE WHEN y = 1997 THEN v END) AS b, max(CASE WHEN y = 1998 THEN v END) AS c FROM part JOIN yy ON l_partkey = p_partkey GROUP BY p_partkey, p_type, p_size),
pp AS (SELECT family, plan_count, region, a AS old, b AS new FROM ww WHERE a > 0 AND b > 0 UNION ALL SELECT family, plan_count, region, b, c FROM ww WHERE b > 0 AND c > 0),
s0 AS (SELECT *, (old + new) / 2 AS rank_mid, ln(new / 400000 / (1 - new / 400000)) - ln(old / 400000 / (1 - old / 400000)) AS delta_z FROM pp),
s1 AS (SELECT *, CASE WHEN rank_mid <= 20000 THEN '0_20k' WHEN rank_mid <= 30000 THEN '20k_30k' WHEN rank_mid <= 37000 THEN '30k_37k' WHEN rank_mid <= 40000 THEN '37k_40k' WHEN rank_mid <= 50000 THEN '40k_50k' WHEN rank_mid <= 60000 THEN '50k_60k' WHEN rank_mid <= 75000 THEN '60k_75k' WHEN rank_mid <= 100000 THEN '75k_100k' WHEN rank_mid <= 150000 THEN '100k_150k' ELSE '150k_250k' END AS rank_bin FROM s0),
s2 AS (SELECT *, delta_z - median(delta_z) OVER (PARTITION BY rank_bin) AS model_delta_z FROM s1)"""


def _samples(t: Tables, trend: str = "rankbin_centered") -> DataFrame:
    by_year = t.lineitem.where("year(l_shipdate) between 1996 and 1998").groupBy("l_partkey", F.year("l_shipdate").alias("y")).agg(F.max("l_extendedprice").alias("v"))
    wide = projection.widen(by_year, "l_partkey", "y", [1996, 1997, 1998], ["v"]).toDF("l_partkey", "r1", "r2", "r3")
    model = t.part.join(wide, F.col("p_partkey") == F.col("l_partkey")).select(F.col("p_type").alias("family"), F.col("p_size").alias("plan_count"), (F.col("p_size") % 2 == 0).alias("region"), "r1", "r2", "r3")
    return landing.transition_samples(model, ["r1", "r2", "r3"], trend)


@query(f"WITH {_SAMPLES_SQL} SELECT rank_bin, count(*)::BIGINT AS n, round(sum(delta_z), 5) AS total, round(sum(model_delta_z), 5) AS centred FROM s2 GROUP BY ALL")
def transition_samples(t: Tables) -> DataFrame:
    return _samples(t).groupBy("rank_bin").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("delta_z"), 5).alias("total"), F.round(F.sum("model_delta_z"), 5).alias("centred"))


@query(f"""WITH {_SAMPLES_SQL}, m AS (SELECT rank_bin, delta_z, delta_z - median(delta_z) OVER () AS centred FROM s1)
SELECT 'raw' AS trend, rank_bin, round(sum(delta_z), 5) AS total FROM m GROUP BY ALL UNION ALL SELECT 'global_centered', rank_bin, round(sum(centred), 5) FROM m GROUP BY ALL""")
def transition_trends(t: Tables) -> DataFrame:
    """The samples as they are, and less the median of all."""
    out = [
        _samples(t, trend).groupBy("rank_bin").agg(F.round(F.sum("model_delta_z"), 5).alias("total")).select(F.lit(trend).alias("trend"), "rank_bin", "total") for trend in ("raw", "global_centered")
    ]
    return out[0].unionByName(out[1])


def _choices(t: Tables, history: int = 3) -> DataFrame:
    """The twelve largest parts as a list of choices."""
    top = t.part.orderBy(F.desc("p_retailprice"), "p_partkey").limit(12)
    by = top.selectExpr("p_partkey as choice", "20000.0 + 2500 * (p_partkey % 17) as rank", "p_type as family", "p_size as plan_count", "p_size % 2 = 0 as region")
    return by.withColumn("history", F.lit(history)).withColumn("order", F.rank().over(Window.orderBy("choice")))


_LANDING_SQL = f"""WITH {_SAMPLES_SQL}, c AS (SELECT p_partkey AS choice, 20000.0 + 2500 * (p_partkey % 17) AS r, p_type AS cf, p_size::DOUBLE AS cp, p_size % 2 = 0 AS cr, p_size AS ps FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 12),
c2 AS (SELECT *, CASE WHEN r <= 20000 THEN '0_20k' WHEN r <= 30000 THEN '20k_30k' WHEN r <= 37000 THEN '30k_37k' WHEN r <= 40000 THEN '37k_40k' WHEN r <= 50000 THEN '40k_50k' WHEN r <= 60000 THEN '50k_60k' ELSE '60k_75k' END AS cb, CASE WHEN ps <= 2 THEN 1 WHEN ps <= 5 THEN 2 WHEN ps <= 10 THEN 3 WHEN ps <= 30 THEN 4 ELSE 5 END AS cpb FROM c),
x AS (SELECT *, rank_mid BETWEEN greatest(1, r * 0.65) AND least(399999, r * 1.45) AS near, family = cf AS fam, (CASE WHEN plan_count <= 2 THEN 1 WHEN plan_count <= 5 THEN 2 WHEN plan_count <= 10 THEN 3 WHEN plan_count <= 30 THEN 4 ELSE 5 END) = cpb AS pl, region = cr AS reg, rank_bin = cb AS bin FROM s2 CROSS JOIN c2),
n AS (SELECT choice, CASE WHEN sum((near AND fam AND pl AND reg)::INT) >= 80 THEN 0 WHEN sum((near AND fam AND pl)::INT) >= 80 THEN 1 WHEN sum((near AND fam)::INT) >= 80 THEN 2 WHEN sum((bin AND fam)::INT) >= 80 THEN 3 WHEN sum(near::INT) >= 80 THEN 4 WHEN sum(bin::INT) >= 80 THEN 5 WHEN sum(near::INT) > 0 THEN 6 ELSE 7 END AS tier FROM x GROUP BY choice),
p AS (SELECT x.*, tier FROM x JOIN n USING (choice)),
o AS (SELECT choice, tier, model_delta_z AS delta, exp(-abs(ln(rank_mid / 400000 / (1 - rank_mid / 400000)) - ln(r / 400000 / (1 - r / 400000))) / 0.22) * exp(-abs(ln(1 + plan_count) - ln(1 + cp)) / 1.2) * CASE WHEN fam THEN 0.75 ELSE 1.0 END * CASE WHEN reg THEN 0.85 ELSE 1.0 END AS w
 FROM p WHERE CASE tier WHEN 0 THEN near AND fam AND pl AND reg WHEN 1 THEN near AND fam AND pl WHEN 2 THEN near AND fam WHEN 3 THEN bin AND fam WHEN 4 THEN near WHEN 5 THEN bin WHEN 6 THEN near ELSE true END),
f AS (SELECT choice, count(*) AS k, sum(w) AS total, CASE WHEN count(*) >= 40 THEN 1.0 WHEN count(*) >= 15 THEN 0.55 ELSE 0.35 END AS share FROM o GROUP BY choice),
b AS (SELECT choice, delta, w / total * share AS weight FROM o JOIN f USING (choice) UNION ALL SELECT p.choice, model_delta_z, (1 - share) / count(*) OVER (PARTITION BY p.choice) FROM p JOIN f USING (choice) JOIN (SELECT choice, sum(bin::INT) AS nb FROM x GROUP BY choice) USING (choice) WHERE k < 40 AND (bin OR nb = 0))"""


@query(f"{_LANDING_SQL} SELECT choice, count(*)::BIGINT AS n, round(sum(weight), 6) AS total, round(1 / sum(weight * weight), 4) AS effective_n FROM b GROUP BY choice")
def similarity_pool(t: Tables) -> DataFrame:
    pool = landing.similarity_pool(_choices(t), _samples(t))
    return pool.groupBy("choice").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("weight"), 6).alias("total"), F.round(F.first("effective_n"), 4).alias("effective_n"))


def _spread_sql(history: int) -> str:
    """Chances with extra spread by history and plan; the distribution by the same rational approximation."""
    sigma = {0: 0.055, 1: 0.035}.get(history, 0.0)
    return f"""{_LANDING_SQL}, e AS (SELECT choice, weight, ln(r / 400000 / (1 - r / 400000)) + delta / sqrt(2) - ln(45000 / 400000.0 / (1 - 45000 / 400000.0)) AS gap, {sigma} + CASE WHEN ps <= 3 THEN 0.02 ELSE 0 END AS sigma FROM b JOIN c2 USING (choice)),
g AS (SELECT *, gap / nullif(sigma, 0) AS x, 1 / (1 + 0.2316419 * abs(gap / nullif(sigma, 0))) AS u FROM e),
h AS (SELECT *, exp(-x * x / 2) / sqrt(2 * pi()) * (u * (0.319381530 + u * (-0.356563782 + u * (1.781477937 + u * (-1.821255978 + u * 1.330274429))))) AS tail FROM g),
q AS (SELECT choice, least(1.0, sum(weight * CASE WHEN sigma > 0 THEN CASE WHEN x >= 0 THEN 1 - tail ELSE tail END ELSE (gap >= 0)::INT END)) AS chance, count(*) AS n, 1 / sum(weight * weight) AS eff FROM h GROUP BY choice),
z AS (SELECT *, coalesce(product(1 - chance) OVER (ORDER BY choice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1.0) AS reach FROM q)"""


@query(f"{_spread_sql(3)} SELECT choice, round(chance, 6) AS chance, round(reach, 6) AS reach, round(reach * chance, 6) AS admit FROM z")
def landing_closed_form(t: Tables) -> DataFrame:
    got = landing.landing(_choices(t), _samples(t), 45_000.0)
    return got.select("choice", F.round("chance", 6).alias("chance"), F.round("reach", 6).alias("reach"), F.round("admit", 6).alias("admit"))


@query(f"""{_spread_sql(1)} SELECT choice, round(chance, 6) AS chance, round(reach * chance, 6) AS admit, round(sum(reach * chance) OVER (ORDER BY choice), 6) AS total,
 (['rank+family+plan+region', 'rank+family+plan', 'rank+family', 'rankbin+family', 'near_rank', 'rankbin', 'near_rank_fallback', 'near_rank_fallback'])[tier + 1] || CASE WHEN k < 40 THEN '+rankbin_shrink' ELSE '' END AS tier,
 '1年历史' || CASE WHEN ps <= 3 THEN ';小计划' ELSE '' END || ';' || (['rank+family+plan+region', 'rank+family+plan', 'rank+family', 'rankbin+family', 'near_rank', 'rankbin', 'near_rank_fallback', 'near_rank_fallback'])[tier + 1] || CASE WHEN k < 40 THEN '+rankbin_shrink' ELSE '' END || ';eff_n=' || printf('%.0f', eff) AS note
FROM z JOIN n USING (choice) JOIN f USING (choice) JOIN c2 USING (choice)""")
def landing_with_spread(t: Tables) -> DataFrame:
    got = landing.landing(_choices(t, 1), _samples(t), 45_000.0)
    return got.select("choice", F.round("chance", 6).alias("chance"), F.round("admit", 6).alias("admit"), F.round("total", 6).alias("total"), "tier", "note")


@query("""SELECT doc_id, label, CASE max(o) WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS confidence, array_to_string(list_sort(list(DISTINCT ev))[1:3], '|') AS evidence, array_to_string(list_sort(list(DISTINCT src)), '|') AS sources FROM (
 SELECT doc_id, lang AS label, 3 AS o, 'lang ' || lang AS ev, 'lang' AS src FROM documents UNION ALL SELECT doc_id, source, 1, 'source ' || source, 'source' FROM documents
 UNION ALL SELECT doc_id, CASE WHEN lang = 'en' THEN 'src1' ELSE 'other' END, 2, 'derived ' || n, 'derived' FROM documents, (VALUES (1), (2), (3), (4)) AS v(n)) GROUP BY doc_id, label""")
def tag_catalog(t: Tables) -> DataFrame:
    """Tags of three kinds, the last an alias with more evidence than is kept."""
    d = t.documents
    tags = d.select("doc_id", F.col("lang").alias("label"), F.lit("high").alias("confidence"), F.concat(F.lit("lang "), F.col("lang")).alias("evidence"), F.lit("lang").alias("source"))
    tags = tags.union(d.select("doc_id", "source", F.lit("low"), F.concat(F.lit("source "), F.col("source")), F.lit("source")))
    tags = tags.union(d.select("doc_id", F.when(F.col("lang") == "en", "english").otherwise("other"), F.lit("medium"), F.explode(F.array(*[F.lit(f"derived {n}") for n in range(1, 5)])), F.lit("derived")))
    got = scoring.tag_catalog(tags, "doc_id", {"english": "src1"})
    return got.withColumns({"evidence": F.array_join("evidence", "|"), "sources": F.array_join("sources", "|")})


_SCORE_SQL = """WITH r AS (SELECT c_custkey, greatest(0, least(100, floor(c_acctbal / 100))) AS a, CASE WHEN c_custkey % 2 = 0 THEN 0.65 ELSE 1.0 END AS cap, c_nationkey, c_mktsegment FROM customer),
f AS (SELECT c_custkey, 'alignment' AS comp, 13 * 1.0 * cap AS v FROM r WHERE c_nationkey % 3 = 0 UNION ALL SELECT c_custkey, 'platform', 12 * 0.82 FROM r WHERE c_nationkey % 5 = 0 UNION ALL SELECT c_custkey, 'freedom', -12 * 0.55 FROM r WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT c_custkey, 'life', 2 * 0.75 FROM r WHERE c_mktsegment = 'MACHINERY' UNION ALL SELECT c_custkey, 'alignment', a / 100 * 45 * cap FROM r),
s AS (SELECT c_custkey, comp, sum(CASE WHEN v >= 0 THEN v ELSE 0 END) AS plus, sum(CASE WHEN v < 0 THEN v ELSE 0 END) AS minus FROM f GROUP BY ALL),
q AS (SELECT c_custkey, least(100, greatest(0, sum(least(plus, CASE comp WHEN 'alignment' THEN 45 WHEN 'platform' THEN 25 WHEN 'freedom' THEN 15 WHEN 'research' THEN 10 ELSE 5 END) + minus))) AS quality FROM s GROUP BY c_custkey)"""


def _scores(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", numeric.clip(F.floor(F.col("c_acctbal") / 100).cast("double"), 0.0, 100.0).alias("alignment_score"), F.when(F.col("c_custkey") % 2 == 0, 0.65).otherwise(1.0).alias("cap"))
    each = F.array_compact(F.array(*[
        F.when(c, F.struct(F.lit(k).alias("factor"), F.lit(conf).alias("confidence")))
        for c, k, conf in (
            (F.col("c_nationkey") % 3 == 0, "math_clean_path", "high"), (F.col("c_nationkey") % 5 == 0, "discipline_eval_a_plus", "medium"), (F.col("c_mktsegment") == "BUILDING", "large_category_risk", "low"),
            (F.col("c_mktsegment") == "MACHINERY", "good_dorm_signal", "mixed"),
        )
    ]))
    factors = t.customer.select("c_custkey", F.explode(each).alias("f")).select("c_custkey", "f.*")
    return scoring.profile_scores(rows, factors, "c_custkey", {k: float(w) for k, (_, _, w) in scoring.FACTORS.items()}, {k: c for k, (_, c, _) in scoring.FACTORS.items()})


@query(f"{_SCORE_SQL} SELECT c_custkey, round(quality, 6) AS quality_score, round(greatest(0, least(120, quality + CASE c_nationkey WHEN 3 THEN 6 WHEN 4 THEN -4 ELSE 0 END + CASE c_custkey % 50 WHEN 0 THEN 18 WHEN 1 THEN -10000 ELSE 0 END)), 6) AS score FROM q JOIN r USING (c_custkey)")
def profile_score(t: Tables) -> DataFrame:
    scores = _scores(t).join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
    preference = F.when(F.col("c_custkey") % 50 == 0, "like").when(F.col("c_custkey") % 50 == 1, "ban").otherwise("")
    got = scoring.final_scores(scores, "c_custkey", F.col("c_nationkey").cast("string"), preference, {"3": 6.0, "4": -4.0})
    return got.select("c_custkey", F.round("quality_score", 6).alias("quality_score"), F.round("score", 6).alias("score"))


@query(f"""{_SCORE_SQL}, t AS (SELECT c_custkey, round(quality, 6) AS score, row_number() OVER (ORDER BY round(quality, 6) DESC, coalesce(nullif(c_nationkey, 0), 999999), c_custkey) AS quality_rank, count(*) OVER () AS n FROM q JOIN r USING (c_custkey))
SELECT c_custkey, quality_rank::BIGINT AS quality_rank, least(2, floor((quality_rank - 1) / ceil(n / 3)))::INTEGER AS tier FROM t""")
def profile_tiers(t: Tables) -> DataFrame:
    scores = _scores(t).select("c_custkey", F.round("quality_score", 6).alias("score")).join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
    return scoring.tiers(scores, "c_custkey", "c_nationkey").select("c_custkey", "quality_rank", "tier")


_NEGATED = "(未见|未发现|未检索到|未看到|未能确认|没有|无|不含|非|暂无|未找到|没找到)[^。；;]{0,40}?"


@query("""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '本科导师；未见金融课程；' ELSE '四人间；强制早操；金融工程；' END AS e, doc_id % 4 = 0 AS robots, doc_id % 5 = 0 AS joint, doc_id % 7 = 0 AS grouped, lang FROM documents),
f AS (SELECT doc_id, 'tutor_system' AS factor, 'medium' AS confidence, '证据中出现本科导师或导师制信号。' AS shown, 'evidence_text' AS source FROM r WHERE contains(e, '本科导师')
UNION ALL SELECT doc_id, 'good_dorm_signal', 'medium', '弱证据中出现住宿正面信号。', 'weak_evidence' FROM r WHERE contains(e, '四人间')
UNION ALL SELECT doc_id, 'time_tax_risk', 'medium', '弱证据中出现时间税或管理负担风险。', 'weak_evidence' FROM r WHERE contains(e, '强制早操')
UNION ALL SELECT doc_id, 'finance_business_load', 'high', '培养方向或课程证据中出现金融/证券/投资/经济应用负担。', 'evidence_text' FROM r WHERE contains(e, '金融') AND NOT regexp_matches(e, '""" + _NEGATED + """金融')
UNION ALL SELECT doc_id, 'robotics_control_lockin', 'medium', '证据中出现机器人/控制绑定风险。', 'evidence_text' FROM r WHERE robots
UNION ALL SELECT doc_id, 'sino_foreign_risk', 'high', '专业名称显示中外合作或中澳项目。', 'major_name' FROM r WHERE joint
UNION ALL SELECT doc_id, 'math_path_bias', 'high', '数学/统计/信计路径符合数学优先策略。', 'major_group' FROM r WHERE joint OR grouped
UNION ALL SELECT doc_id, 'double_first_class', CASE WHEN lang = 'en' THEN 'high' ELSE 'low' END, 'from ' || lang, 'tags' FROM r
UNION ALL SELECT doc_id, 'project101_confirmed', 'low', 'label ' || quality, 'labels' FROM (SELECT doc_id, min(quality) AS quality FROM labels WHERE toxic = 0 AND doc_id IN (SELECT doc_id FROM documents) GROUP BY doc_id))
SELECT doc_id, factor, confidence, shown AS evidence, source AS sources FROM f""")
def score_factors(t: Tables) -> DataFrame:
    rows = t.documents.select(
        "doc_id", F.concat(F.when(F.col("doc_id") % 3 == 0, "本科导师；未见金融课程；").otherwise("四人间；强制早操；金融工程；"), F.col("text")).alias("e"), F.when(F.col("doc_id") % 4 == 0, "机器人方向").otherwise("").alias("r"),
        F.when(F.col("doc_id") % 5 == 0, "数学类(中外合作)").otherwise("").alias("m"), F.when(F.col("doc_id") % 7 == 0, "math_stat_info").otherwise("other").alias("g"),
    )
    tags = t.documents.select("doc_id", F.lit("双一流").alias("label"), F.when(F.col("lang") == "en", "high").otherwise("low").alias("confidence"), F.concat(F.lit("from "), F.col("lang")).alias("evidence"), F.lit("tags").alias("source"))
    labels = t.labels.join(t.documents.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id", "toxic").agg(F.min("quality").alias("quality"))
    panels = labels.select(
        "doc_id", F.lit("project101").alias("kind"), F.when(F.col("toxic") == 0, "confirmed_participant").otherwise("unclear").alias("status"), F.lit("low").alias("confidence"), F.concat(F.lit("label "), F.col("quality")).alias("summary"), F.lit("labels").alias("source_file")
    )
    got = scoring.score_factors(rows, tags, "doc_id", "e", "r", "m", "g", panels)
    return got.withColumns({"evidence": F.array_join("evidence", "|"), "sources": F.array_join("sources", "|")})


@query("""WITH p AS (SELECT conv_id AS k, turn, (['hard', 'weak', 'project101', 'hard_rescue'])[turn % 4 + 1] AS kind, CASE WHEN turn % 8 = 0 THEN 'course_grid' ELSE 'not_found' END AS ts, CASE WHEN turn > 3 THEN 'high' ELSE 'low' END AS conf FROM conversations),
g AS (SELECT k, count(*) FILTER (kind IN ('hard', 'hard_rescue')) AS nh, arg_max(ts, (CASE ts WHEN 'course_grid' THEN 4 ELSE 1 END, -turn)) FILTER (kind IN ('hard', 'hard_rescue')) AS ts, arg_max(conf, (CASE ts WHEN 'course_grid' THEN 4 ELSE 1 END, -turn)) FILTER (kind IN ('hard', 'hard_rescue')) AS hc,
 count(*) FILTER (kind = 'weak') AS nw, max(conf = 'high') FILTER (kind = 'weak') AS wh, count(*) FILTER (kind = 'project101') AS np FROM p GROUP BY k),
s AS (SELECT *, CASE WHEN nh > 0 THEN ts ELSE 'no_hard_panel' END AS training_status FROM g)
SELECT k, training_status, CASE training_status WHEN 'course_grid' THEN 0.96 WHEN 'not_found' THEN 0.65 ELSE 0.82 END::DOUBLE AS cap, coalesce(hc, '') AS hard_confidence, CASE WHEN nw = 0 THEN '' WHEN wh THEN 'high' ELSE 'low' END AS weak_confidence, CASE WHEN np > 0 THEN 'unclear' ELSE '' END AS project101,
 array_to_string(list_filter([CASE WHEN training_status <> 'course_grid' THEN 'training_plan' END, 'project101', CASE WHEN nw = 0 THEN 'no_weak_evidence' WHEN NOT wh THEN 'weak_confidence' END, 'category_rules'], lambda x: x IS NOT NULL), ';') AS gaps FROM s""")
def evidence_quality(t: Tables) -> DataFrame:
    c = t.conversations
    panels = c.select(
        F.col("conv_id").alias("k"), F.element_at(F.array(*[F.lit(x) for x in ("hard", "weak", "project101", "hard_rescue")]), (F.col("turn") % 4 + 1).cast("int")).alias("kind"),
        F.when(F.col("turn") % 8 == 0, "course_grid").otherwise("not_found").alias("training_status"), F.lit("unclear").alias("status"), F.when(F.col("turn") > 3, "high").otherwise("low").alias("confidence"), F.col("turn").alias("pos"),
    )
    rows = c.select(F.col("conv_id").alias("k"), F.lit("数学类").alias("major")).distinct()
    return scoring.evidence_quality(rows, panels, "k", "major").withColumn("gaps", F.array_join("gaps", ";"))


def _any(cell: str, terms: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({cell}, '{x}')" for x in terms) + ")"


def _triage_sql(source: str, key: str) -> str:
    """The domain's triage in SQL, of a query that gives the key and all columns of triage.COLUMNS as texts."""
    t = triage
    listed = lambda names: ", ".join(f"'{n}'" for n in names)
    split = lambda c: f"list_filter(regexp_split_to_array({c}, '[;,；\\s]+'), lambda x: x <> '')"
    has = lambda n: f"list_contains(tags, '{n}')"
    flag = lambda n: f"list_contains(flags, '{n}')"
    yes = lambda c: f"lower({c}) IN ('true', '1', 'yes', 'y')"
    evidence = "lower(concat_ws(' ', core_courses_summary, ai_path_fit_notes, math_foundation_notes, cs_ai_foundation_notes, research_resources_notes, next_deep_questions))"
    poor = "lower(concat_ws(' ', research_resources_notes, recommendation_policy_notes, learning_freedom_notes, dorm_campus_notes, next_deep_questions))"
    reason = lambda rules: "array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{r}' END" for c, r in rules) + "], lambda x: x IS NOT NULL))), ';')"
    drops = [
        ("price > 50000", "tuition_over_50000_rmb"), ("cost = 'required_or_unpriced'", "required_or_unpriced_foreign_phase_cost"), ("off AND NOT manual", "off_target_courses_with_weak_context"),
        ("(off OR drift) AND ceiling IN ('low', 'medium') AND (missing >= 3 OR low_band OR p IN ('B', 'C')) AND NOT (p = 'A' AND NOT low_band AND missing < 3)", "training_direction_low_alignment"),
        ("name_drift AND drift AND ceiling <> 'high'", "domain_drift_with_limited_upside"), ("unsafe", "unsafe_major_diversion"), ("(structural OR mixed) AND NOT free AND ceiling <> 'high'", "uncontrolled_diversion_risk"),
        ("barred AND mixed AND NOT free AND ceiling <> 'high'", "excluded_major_mix_without_selection_guarantee"), ("managed_out", "management_heavy_or_training_burden_signal"), ("remote_out", "weak_resource_signal_with_low_evidence"),
        ("remote AND weak_notes AND ceiling IN ('low', 'medium') AND missing >= 2", "campus_resource_obviously_weak"), ("moved AND weak_notes AND ceiling = 'low'", "campus_resource_obviously_weak"), ("lost_out", "not_found_and_low_prescreen_priority"),
        ("hopeless OR missing >= 3 AND missing < 5 AND ceiling = 'low' AND p <> 'A' AND NOT strong", "multiple_core_info_missing_low_ceiling"),
    ]
    unsure = [
        ("cost = 'possible_optional'", "possible_optional"), ("cost = 'possible_unclear'", "possible_unclear"), ("abs(price - 50000) < 1e-6", "tuition_at_limit_check_strictness"), ("off AND manual", "off_target_courses_need_manual_confirmation"),
        ("name_drift OR drift", "possible_training_direction_drift"), (f"NOT unsafe AND (diverted OR {has('major_diversion_risk')})", "major_diversion_or_department_unclear"), (f"structural OR {has('major_diversion_risk')} OR barred OR mixed", "diversion_risk_needs_manual_check"),
        ("managed AND NOT managed_out", "management_heavy_signal"), ("remote AND NOT remote_out", "remote_or_weak_resource_signal"), ("remote OR moved OR weak_notes OR sparse", "campus_or_resource_weak_signal"), (has("dorm_negative_signal"), "dorm_negative_signal"),
        ("NOT core", "non_core_major_category"), ("lost AND NOT lost_out", "crawl_not_found"), ("NOT lost AND low", "low_information_light_crawl"), ("grade = 'needs_rerun'", "shard_quality_needs_rerun"), ("grade = 'low_coverage'", "shard_quality_low_coverage"),
        ("NOT sourced", "no_referenced_source"), ("missing >= 5 AND NOT hopeless", "multiple_core_info_missing"),
    ]
    notes = [(f"{flag(n)} OR {has(n)}", n) for n in ("small_plan", "new_no_history")] + [(flag("high_rank_volatility"), "high_rank_volatility"), (f"{flag('sino_foreign')} OR {has('sino_foreign')}", "sino_foreign_not_negative_by_itself")]
    return f"""WITH x AS ({source}),
a AS (SELECT *, {split("risk_tags")} AS tags, {split("risk_flags")} AS flags, len(list_filter({split("source_ids")}, lambda x: lower(x) NOT IN ('not_found', 'none', 'nan', 'na', 'n/a', '-'))) AS listed, prescreen_priority AS p, rank_band AS band, quality_grade AS grade, crawl_status = 'not_found' AS lost,
 {_any("college_name", t.STRONG_SCHOOLS)} AS strong, major_category IN ({listed(t.CORE)}) AS core, coalesce(try_cast(replace(prescreen_score, ',', '') AS DOUBLE), 0) AS score, rank_band IN ({listed(t.LOW_BANDS)}) AS low_band, regexp_replace(tuition_raw, '\\s+', '', 'g') AS raw,
 {_any("concat_ws(' ', college_name, major_name, remark, risk_flags, risk_tags)", t.JOINT)} AS joint, try_cast(replace(tuition, ',', '') AS DOUBLE) AS n, concat_ws(' ', remark, risk_tags, next_deep_questions) AS said FROM x),
b AS (SELECT *, coalesce(try_cast(replace(source_ref_count, ',', '') AS DOUBLE)::INTEGER, listed) AS refs, CASE WHEN low_information <> '' THEN {yes("low_information")} ELSE lost OR listed = 0 END AS low, CASE WHEN has_source <> '' THEN {yes("has_source")} ELSE listed > 0 END AS sourced,
 CASE WHEN regexp_matches(raw, '[0-9]+(?:\\.[0-9]+)?万') THEN regexp_extract(raw, '([0-9]+(?:\\.[0-9]+)?)万', 1)::DOUBLE * 10000 WHEN regexp_matches(raw, '[0-9]') THEN regexp_extract(replace(raw, ',', ''), '([0-9]+(?:\\.[0-9]+)?)', 1)::DOUBLE
 WHEN joint AND n > 0 AND n <= 20 THEN n * 10000 WHEN joint AND n > 20 AND n < 300 THEN n * 1000 ELSE n END AS price,
 CASE WHEN NOT {_any("said", t.EXTERNAL_COST)} THEN 'none' WHEN {_any("said", t.OPTIONAL_COST)} THEN 'possible_optional' WHEN {_any("said", t.MANDATORY_COST)} OR {has("mandatory_abroad")} THEN 'required_or_unpriced' ELSE 'possible_unclear' END AS cost,
 {has("off_target_courses")} AS off, {has("remote_or_weak_resource")} AS remote, {has("campus_move")} AS moved, {has("management_heavy_signal")} AS managed, {flag("contains_excluded_major_in_remark")} AS barred,
 major_category IN ({listed(t.LOOSE)}) OR {flag("class_diversion")} OR {flag("target_only_in_remark")} AS structural, {_any(poor, t.WEAK_RESOURCES)} AS weak_notes, {_any("concat_ws(' ', college_name, major_name, remark)", t.DRIFT_NAMES)} AS name_drift, {_any(evidence, t.DRIFT_EVIDENCE)} AS drift,
 {_any("remark", t.TARGETS)} AND NOT {_any("remark", t.UNRELATED)} OR {_any("concat_ws(' ', remark, core_courses_summary, ai_path_fit_notes, next_deep_questions)", t.GUARANTEES)} AS free FROM a),
c AS (SELECT *, lost::INT * 2 + low::INT + (refs = 0)::INT + CASE grade WHEN 'needs_rerun' THEN 2 WHEN 'low_coverage' THEN 1 ELSE 0 END + {" + ".join(f"({c} <> '' AND NOT {yes(c)})::INT" for c in ("has_training_plan_url", "has_recommendation_source", "has_dorm_source"))} AS missing,
 CASE WHEN strong AND core AND p IN ('A', 'B') THEN 'high' WHEN band = '远保底' OR p = 'C' OR score < 88 THEN 'low' WHEN {_any("college_name", t.WEAK_SCHOOLS)} AND low_band THEN 'low' WHEN {flag("very_high_tuition")} AND p IN ('B', 'C') THEN 'low'
 WHEN band = '低优先保底' AND (p = 'B' OR remote) THEN 'low' WHEN NOT strong AND NOT core AND p <> 'A' THEN 'low' WHEN strong OR band IN ('超冲', '冲', '贴合') OR score >= 115 THEN 'high' ELSE 'medium' END AS ceiling,
 (structural OR barred) AND {_any("concat_ws(' ', major_name, remark)", t.UNRELATED)} AS mixed, refs <= 1 AND NOT {yes("has_recommendation_source")} AS sparse, structural AS diverted,
 p = 'A' AND band IN ({listed(t.STRONG_BANDS)}) AND refs >= 2 AS manual, structural AND ({has("major_diversion_risk")} OR barred) AS unsafe, low OR grade IN ('needs_rerun', 'low_coverage') OR agent_confidence = 'low' AS thin FROM b),
d AS (SELECT *, managed AND (p IN ('B', 'C') OR low_band OR remote) AS managed_out, remote AND thin AND (p IN ('B', 'C') OR low_band) AS remote_out, lost AND (p = 'C' OR low_band) AS lost_out, missing >= 5 AND ceiling = 'low' AND NOT strong AS hopeless FROM c),
r AS (SELECT *, {reason(drops)} AS drop_reasons, {reason(unsure)} AS borderline_reasons, {reason(notes)} AS audit_notes FROM d)
SELECT {key}, CASE WHEN drop_reasons <> '' THEN 'drop_by_light_crawl' WHEN borderline_reasons <> '' THEN 'borderline_review' ELSE 'keep_for_deep_crawl' END AS triage_bucket, drop_reasons, borderline_reasons, audit_notes, ceiling AS ceiling_level, missing AS core_missing_count, round_even(price, 2) AS tuition_rmb_estimate FROM r"""


def _blank(*given: str) -> str:
    return ", ".join(f"'' AS {c}" for c in triage.COLUMNS if c not in given)


_SHOWN = ("triage_bucket", "drop_reasons", "borderline_reasons", "audit_notes", "ceiling_level", "core_missing_count", "tuition_rmb_estimate")

_FROM_DOCUMENTS = """SELECT doc_id, CASE WHEN source = 'src1' THEN '双一流大学' ELSE '某学院' END AS college_name, CASE WHEN lang = 'en' THEN 'core_cs_ai' ELSE 'target_class' END AS major_category, CASE doc_id % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'C' ELSE 'B' END AS prescreen_priority, '100' AS prescreen_score,
 CASE WHEN doc_id % 7 = 0 THEN '远保底' ELSE '稳' END AS rank_band, CASE WHEN n_chars < 100 THEN 'not_found' ELSE 'ok' END AS crawl_status, CASE WHEN toxic = 1 THEN 'off_target_courses;small_plan' ELSE '' END AS risk_tags, CASE WHEN quality = 0 THEN '' ELSE 's1;s2' END AS source_ids,
 CASE WHEN doc_id % 11 = 0 THEN '6万/年' ELSE '' END AS tuition_raw, '5000' AS tuition, trim(text, ' ') AS research_resources_notes, """ + _blank("college_name", "major_category", "prescreen_priority", "prescreen_score", "rank_band", "crawl_status", "risk_tags", "source_ids", "tuition_raw", "tuition", "research_resources_notes") + " FROM documents LEFT JOIN labels USING (doc_id)"


@query(_triage_sql(_FROM_DOCUMENTS, "doc_id"))
def triage_domain(t: Tables) -> DataFrame:
    d = t.documents.join(t.labels, "doc_id", "left")
    rows = d.select(
        "doc_id", F.when(F.col("source") == "src1", "双一流大学").otherwise("某学院").alias("college_name"), F.when(F.col("lang") == "en", "core_cs_ai").otherwise("target_class").alias("major_category"),
        F.when(F.col("doc_id") % 5 == 0, "A").when(F.col("doc_id") % 5 == 1, "C").otherwise("B").alias("prescreen_priority"), F.lit("100").alias("prescreen_score"), F.when(F.col("doc_id") % 7 == 0, "远保底").otherwise("稳").alias("rank_band"),
        F.when(F.col("n_chars") < 100, "not_found").otherwise("ok").alias("crawl_status"), F.when(F.col("toxic") == 1, "off_target_courses;small_plan").otherwise("").alias("risk_tags"), F.when(F.col("quality") == 0, "").otherwise("s1;s2").alias("source_ids"),
        F.when(F.col("doc_id") % 11 == 0, "6万/年").otherwise("").alias("tuition_raw"), F.lit("5000").alias("tuition"), F.col("text").alias("research_resources_notes"),
    )
    return triage.triage_items(rows).select("doc_id", *_SHOWN)


#: Cells of each column of the triage, one of which an order takes by its key and a prime of the column's own.
_CELLS = {
    "college_name": ("某大学", "省重点建设高校", "某学院", "财经大学"), "major_name": ("数学类", "软件工程", "金融学"), "major_category": ("core_math_stat", "core_cs_ai", "target_class", "trial_class"), "remark": ("", "可任选", "含数学与应用数学", "须赴英国，外方学费另计", "可选择赴英期间学费", "国外学习阶段", "含物联网"),
    "risk_flags": ("", "class_diversion", "contains_excluded_major_in_remark", "very_high_tuition;high_rank_volatility", "sino_foreign", "new_no_history"), "risk_tags": ("", "off_target_courses", "remote_or_weak_resource", "major_diversion_risk, campus_move", "management_heavy_signal", "dorm_negative_signal;small_plan", "mandatory_abroad"),
    "prescreen_priority": ("A", "B", "C", "A", "B"), "prescreen_score": ("80", "100", "120", "", "1,00"), "rank_band": ("超冲", "贴合", "稳", "低优先保底", "远保底"), "crawl_status": ("ok", "ok", "not_found"), "agent_confidence": ("high", "low"), "quality_grade": ("usable", "needs_rerun", "low_coverage", ""),
    "source_ids": ("", "s1", "s1; s2 none", "-", "a b c"), "source_ref_count": ("", "0", "2", "", "1"), "has_source": ("", "true", "no"), "low_information": ("", "Yes", "0"), "has_training_plan_url": ("", "1", "0"), "has_recommendation_source": ("", "true", "false"), "has_dorm_source": ("", "n", "y"),
    "tuition": ("5000", "", "6", "50", "50,000", "88000"), "tuition_raw": ("", "", "5万", "7.5 万/年", "4,800元", "见简章"), "core_courses_summary": ("", "finance and law", "analysis"), "ai_path_fit_notes": ("", "自选专业"), "research_resources_notes": ("", "weak signal", "labs"), "dorm_campus_notes": ("", "Not found", "good"),
}
_PRIMES = (7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59, 61, 67, 71, 73, 79, 83, 89, 97, 101, 103, 107)
_FROM_ORDERS = "SELECT o_orderkey, " + ", ".join(f"([{', '.join(repr(v) for v in cells)}])[(o_orderkey // {prime} + o_custkey * {prime}) % {len(cells)} + 1] AS {c}" for (c, cells), prime in zip(_CELLS.items(), _PRIMES, strict=True)) + ", " + _blank(*_CELLS) + " FROM orders"


@query(_triage_sql(_FROM_ORDERS, "o_orderkey"))
def triage_rules(t: Tables) -> DataFrame:
    """All rules of the domain, on rows whose cells are dealt so that every rule meets many of them."""
    place = lambda prime, n: (F.pmod(F.floor(F.col("o_orderkey") / prime) + F.col("o_custkey") * prime, F.lit(n)) + 1).cast("int")
    cells = [F.element_at(F.array(*map(F.lit, values)), place(prime, len(values))).alias(c) for (c, values), prime in zip(_CELLS.items(), _PRIMES, strict=True)]
    return triage.triage_items(t.orders.select("o_orderkey", *cells)).select("o_orderkey", *_SHOWN)


@query("""WITH i AS (SELECT 'error' AS severity, 'identity_changed' AS code, count(*) AS n FROM documents WHERE doc_id % 6 = 0 AND lang <> 'xx'
UNION ALL SELECT 'error', 'duplicate_row', count(*) FROM (SELECT doc_id FROM documents GROUP BY doc_id HAVING count(*) > 1) UNION ALL SELECT 'error', 'duplicate_source', count(*) FROM (SELECT doc_id FROM labels GROUP BY doc_id HAVING count(*) > 1)
UNION ALL SELECT 'error', 'invalid_lang', count(*) FROM documents WHERE lang NOT IN ('en', 'de', 'fr') UNION ALL SELECT 'warning', 'unknown_tags', count(*) FROM documents WHERE doc_id % 9 = 0
UNION ALL SELECT 'error', 'missing_row', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'error', 'dangling_refs', count(*) FROM documents WHERE CASE WHEN doc_id % 10 = 0 THEN 9999999 ELSE 1 END NOT IN (SELECT doc_id FROM labels))
SELECT severity, code, n::BIGINT AS n FROM i WHERE n > 0""")
def validation_issues(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "lang", "source", F.when(F.col("doc_id") % 9 == 0, "a,zz").otherwise("a").alias("tags"), F.when(F.col("doc_id") % 10 == 0, "9999999;none").otherwise("1").alias("refs"), F.lit("s1").alias("shard_id"))
    contract = quality.Contract(["doc_id", "lang", "source", "tags", "refs"], "doc_id", ["lang"], {"lang": ["en", "de", "fr"]}, {"tags": ["a", "b"]}, ["refs"])
    expected = t.documents.select("doc_id", F.when(F.col("doc_id") % 6 == 0, "xx").otherwise(F.col("lang")).alias("lang"))
    issues = quality.validate(rows, t.labels.select(F.col("doc_id").cast("string").alias("source_id")), expected, contract)
    return quality.issue_totals(issues)


@query("""SELECT to_json(x)::VARCHAR AS value FROM (SELECT {'n_nationkey': n_nationkey, 'n_name': n_name, 'none': CASE WHEN n_nationkey % 2 = 0 THEN 'even' END} AS x FROM nation)""")
def json_payload(t: Tables) -> DataFrame:
    return writers.payload(t.nation.select("n_nationkey", "n_name", F.when(F.col("n_nationkey") % 2 == 0, "even").alias("none")))


@query("""SELECT c_custkey, c_acctbal AS balance, nullif(c_mktsegment, 'BUILDING') AS segment, NULL::DOUBLE AS absent FROM customer""")
def typed_projection(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.format_string("%s", "c_acctbal").alias("balance"), F.when(F.col("c_mktsegment") == "BUILDING", " ").otherwise(F.col("c_mktsegment")).alias("segment"))
    return projection.typed(rows.withColumn("c_custkey", F.col("c_custkey").cast("string")), ["c_custkey", "balance", "segment", "absent"], ["balance", "absent", "c_custkey"]).withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("""SELECT p_partkey, CASE WHEN contains(p_name, 'red') OR contains(p_name, 'blue') THEN 'cs' WHEN contains(p_name, 'green') THEN 'ai' ELSE 'other' END AS family FROM part""")
def first_family(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", prescreen.first_family(F.col("p_name"), (("cs", ("red", "blue")), ("ai", ("green",)))).alias("family"))


@query("""SELECT o_orderkey, c_name, coalesce(n_name, '') AS nation FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey % 2 = 0""")
def left_join_chain(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", F.col("c_nationkey").alias("n_nationkey"))
    got = joins.one_to_one(t.orders.groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("keys")), customers, "o_custkey")
    named = got.join(t.nation.where("n_nationkey % 2 = 0").select("n_nationkey", "n_name"), "n_nationkey", "left")
    return named.select(F.explode("keys").alias("o_orderkey"), "c_name", F.coalesce("n_name", F.lit("")).alias("nation"))


@query("""SELECT page_id, regexp_extract(url, '([0-9]+)', 1) AS n, upper(lang_hit) AS hit FROM (SELECT page_id, url, CASE WHEN contains(url, '/en/') THEN 'en' WHEN contains(url, '/fr/') THEN 'fr' END AS lang_hit FROM pages)""")
def listed_terms(t: Tables) -> DataFrame:
    hit = text.first_listed(F.col("url"), ["/en/", "/fr/"])
    return t.pages.select("page_id", F.regexp_extract("url", "([0-9]+)", 1).alias("n"), F.upper(F.replace(hit, F.lit("/"), F.lit(""))).alias("hit"))
