"""Queries of filters, joins, aggregates and ordered operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import numeric
from plumbline.operators import aggregates, filters, joins, projection, quality, ranking
from plumbline.plans.registry import Tables, query

_YEAR = "year(l_shipdate)"
_BY_YEAR = "SELECT l_partkey AS p, year(l_shipdate) AS y, max(l_extendedprice) AS v FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 1998 GROUP BY ALL"


def _yearly(t: Tables) -> DataFrame:
    """Parts with the largest price of three years, as columns."""
    rows = t.lineitem.where("year(l_shipdate) between 1996 and 1998").groupBy("l_partkey", F.year("l_shipdate").alias("y")).agg(F.max("l_extendedprice").alias("v"))
    return projection.widen(rows, "l_partkey", "y", [1996, 1997, 1998], ["v"])


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND contains(lower(o_orderpriority), 'urgent') AND o_totalprice BETWEEN 1000 AND 200000""")
def facet_filter(t: Tables) -> DataFrame:
    got = filters.facets(t.orders, {"o_orderstatus": "F", "o_orderpriority": ""}, {"Urgent": ["o_orderpriority", "o_orderstatus"]}, {"o_totalprice": (1000, 200000)})
    return got.select("o_orderkey", "o_totalprice")


@query("""SELECT c_mktsegment, count(*)::BIGINT AS n, sum(CASE WHEN v >= 0 THEN 1 ELSE 0 END)::BIGINT AS n_low, sum(CASE WHEN v >= 0 AND v <= 5000 THEN 1 ELSE 0 END)::BIGINT AS n_both FROM (SELECT c_mktsegment, CASE WHEN c_custkey % 7 > 0 THEN c_acctbal END AS v FROM customer) GROUP BY ALL""")
def range_pass(t: Tables) -> DataFrame:
    v = F.when(F.col("c_custkey") % 7 > 0, F.col("c_acctbal"))
    return t.customer.groupBy("c_mktsegment").agg(
        F.count_if(filters.in_range(v)).alias("n"), F.count_if(filters.in_range(v, 0)).alias("n_low"), F.count_if(filters.in_range(v, 0, 5000)).alias("n_both")
    )


@query("""SELECT facet, array_to_string(list_sort(list(v)), '|') AS values FROM (SELECT DISTINCT 'c_mktsegment' AS facet, c_mktsegment AS v FROM customer UNION SELECT 'c_nationkey', c_nationkey::VARCHAR FROM customer) GROUP BY facet""")
def facet_summary(t: Tables) -> DataFrame:
    return aggregates.facet_values(t.customer, ["c_mktsegment", "c_nationkey"]).select("facet", F.array_join("values", "|").alias("values"))


@query("""SELECT o_orderstatus, list_sort(list(o_totalprice))[count(*) // 2 + 1] AS middle, median(o_totalprice) AS exact, count(*)::BIGINT AS n FROM orders GROUP BY ALL""")
def upper_median_kpi(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return aggregates.upper_medians(t.orders, ["o_orderstatus"], "o_totalprice", "middle").join(ranking.medians(t.orders, ["o_orderstatus"], "o_totalprice", "exact"), "o_orderstatus").join(counts, "o_orderstatus")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def page_n(t: Tables) -> DataFrame:
    return ranking.page(t.orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, 50).select("o_orderkey", "o_totalprice")


@query("""SELECT c_custkey, row_number() OVER (ORDER BY CASE WHEN c_custkey % 5 > 0 THEN c_acctbal END ASC NULLS LAST, c_custkey)::BIGINT AS position FROM customer""")
def nulls_last_order(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 5 > 0, F.col("c_acctbal")).alias("v"))
    return ranking.numbered(rows, [F.asc_nulls_last("v"), F.asc("c_custkey")]).select("c_custkey", "position")


@query("""SELECT l_orderkey, l_linenumber, p_brand FROM lineitem LEFT JOIN (SELECT p_name, any_value(p_brand) AS p_brand, any_value(p_partkey) AS k FROM part GROUP BY p_name HAVING count(*) = 1) ON k = l_partkey""")
def unique_key_lookup(t: Tables) -> DataFrame:
    dim = joins.unique_rows(t.part.select("p_name", "p_brand", F.col("p_partkey").alias("l_partkey")), ["p_name"])
    return joins.lookup_unique(t.lineitem, dim.drop("p_name"), ["l_partkey"]).select("l_orderkey", "l_linenumber", "p_brand")


@query("""SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS last_order, arg_min(o_orderkey, o_orderkey) AS first_order FROM orders GROUP BY o_custkey""")
def first_last_wins(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey")
    last = ranking.last_of(rows, ["o_custkey"], F.col("o_orderkey")).withColumnRenamed("o_orderkey", "last_order")
    return last.join(ranking.first_of(rows, ["o_custkey"], F.col("o_orderkey")).withColumnRenamed("o_orderkey", "first_order"), "o_custkey")


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS head FROM conversations""")
def carry_forward(t: Tables) -> DataFrame:
    rows = t.conversations.select("conv_id", "turn", F.when(F.col("role") == "user", F.col("turn")).alias("head"))
    return ranking.carry_forward(rows, ["conv_id"], ["turn"], ["head"])


@query("""SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'extra' ELSE 'both' END AS side, CASE WHEN d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL THEN 'flag' ELSE '' END AS changed
FROM (SELECT doc_id, CASE WHEN n_chars > 500 THEN 1 ELSE 0 END AS flag FROM documents) d FULL JOIN (SELECT doc_id, quality AS flag FROM labels) l USING (doc_id) WHERE d.doc_id IS NULL OR l.doc_id IS NULL OR d.flag IS DISTINCT FROM l.flag""")
def outer_diff(t: Tables) -> DataFrame:
    left = t.documents.select("doc_id", (F.col("n_chars") > 500).cast("int").alias("flag"))
    right = t.labels.select("doc_id", F.col("quality").cast("int").alias("flag"))
    return joins.outer_difference(left, right, "doc_id", ["flag"]).select("doc_id", "side", F.array_join("changed", ",").alias("changed"))


@query("""SELECT p_partkey, ref FROM (SELECT p_partkey, unnest([p_partkey % 120, p_size]) AS ref FROM part) WHERE ref NOT IN (SELECT s_suppkey FROM supplier)""")
def ref_integrity(t: Tables) -> DataFrame:
    ids = F.array((F.col("p_partkey") % 120).cast("long"), F.col("p_size").cast("long"))
    return joins.dangling(t.part.select("p_partkey", "p_size"), ids, t.supplier, "s_suppkey").select("p_partkey", "ref")


@query("SELECT p_name, count(*)::BIGINT AS n FROM part GROUP BY p_name HAVING count(*) > 1")
def dup_keys(t: Tables) -> DataFrame:
    return aggregates.duplicate_keys(t.part, ["p_name"])


@query("SELECT o_custkey, min(o_orderpriority) AS value FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority) = 1")
def single_valued_keys(t: Tables) -> DataFrame:
    return aggregates.single_valued(t.orders, "o_custkey", "o_orderpriority")


@query("""SELECT doc_id, coalesce(quality, -1)::INTEGER AS quality, coalesce(toxic, -1)::INTEGER AS toxic FROM documents LEFT JOIN labels USING (doc_id)""")
def missing_rows_filled(t: Tables) -> DataFrame:
    actual = t.labels.selectExpr("doc_id", "cast(quality as int) as quality", "cast(toxic as int) as toxic")
    return joins.fill_missing(t.documents.select("doc_id"), actual, "doc_id", {"quality": -1, "toxic": -1}, "doc_id")


@query("""SELECT o_orderkey, c_mktsegment AS tag, (o_custkey % 2 = 0)::INTEGER AS n_changed FROM (SELECT o_orderkey, o_custkey FROM orders) JOIN customer ON c_custkey = o_custkey""")
def update_join(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.when(F.col("o_custkey") % 2 == 0, F.lit("?")).otherwise(F.col("c_mktsegment")).alias("tag"))
    truth = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_mktsegment").alias("tag"))
    return joins.repair(rows, truth, "o_orderkey", ["tag"])


@query("""WITH r AS (SELECT *, (text = '' OR length(text) < 60) AS low FROM conversations), g AS (SELECT role AS shard_id, count(*) AS n_rows, sum((conv_id % 4 > 0)::INT) AS n_sources, avg(low::INT) AS share_low FROM r GROUP BY role),
e AS (SELECT role AS shard_id, count(*) AS n FROM conversations WHERE turn > 6 GROUP BY role)
SELECT shard_id, n_rows::BIGINT AS n_rows, n_sources::BIGINT AS n_sources, round(share_low, 6) AS share_low, coalesce(n, 0)::BIGINT AS n_errors, CASE WHEN coalesce(n, 0) > 0 THEN 'needs_repair' WHEN share_low >= 0.5 THEN 'needs_rerun' WHEN share_low >= 0.25 THEN 'low_coverage' ELSE 'usable' END AS grade FROM g LEFT JOIN e USING (shard_id)""")
def quality_grade(t: Tables) -> DataFrame:
    rows = t.conversations.select(F.col("role").alias("shard_id"), (F.col("conv_id") % 4 > 0).alias("has_source"), (F.length("text") < 60).alias("low_information"), F.lit(False).alias("mojibake"))
    errors = t.conversations.where("turn > 6").select(F.col("role").alias("shard"))
    got = quality.shard_grades(rows, errors)
    return got.select("shard_id", "n_rows", "n_sources", F.round("share_low", 6).alias("share_low"), "n_errors", "grade")


@query("""SELECT o_orderpriority, sum((o_orderstatus = 'F')::INT)::BIGINT AS "F", sum((o_orderstatus = 'O')::INT)::BIGINT AS "O", sum((o_orderstatus = 'P')::INT)::BIGINT AS "P" FROM orders GROUP BY ALL""")
def status_pivot(t: Tables) -> DataFrame:
    return aggregates.crosstab(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("""SELECT quality::VARCHAR AS value, count(*)::BIGINT AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL""")
def value_counts(t: Tables) -> DataFrame:
    return aggregates.frequencies(t.documents.join(t.labels, "doc_id", "left"), "quality")


@query(f"""WITH y AS ({_BY_YEAR}), w AS (SELECT p AS l_partkey, max(CASE WHEN y = 1996 THEN v END) AS a, max(CASE WHEN y = 1997 THEN v END) AS b, max(CASE WHEN y = 1998 THEN v END) AS c FROM y GROUP BY p)
SELECT l_partkey, ((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT) AS years_matched, coalesce(c, b, a) AS latest_rank, least(a, b, c) AS best_rank, greatest(a, b, c) AS easiest_rank FROM w""")
def history_summary(t: Tables) -> DataFrame:
    got = aggregates.row_summary([F.col(f"`{y}_v`") for y in (1996, 1997, 1998)])
    return _yearly(t).select("l_partkey", *[got[c].alias(c) for c in ("years_matched", "latest_rank", "best_rank", "easiest_rank")])


@query(f"""WITH y AS ({_BY_YEAR}) SELECT p AS l_partkey, round(sum(v * CASE y WHEN 1996 THEN 0.2 WHEN 1997 THEN 0.3 ELSE 0.5 END) / sum(CASE y WHEN 1996 THEN 0.2 WHEN 1997 THEN 0.3 ELSE 0.5 END), 4) AS center,
 CASE WHEN count(*) >= 2 THEN round(max(v) - min(v), 4) ELSE 0 END::DOUBLE AS volatility FROM y GROUP BY p""")
def renormalised_weighted_mean(t: Tables) -> DataFrame:
    years = [F.col(f"`{y}_v`") for y in (1996, 1997, 1998)]
    return _yearly(t).select("l_partkey", F.round(numeric.weighted_mean(years, numeric.YEAR_WEIGHTS), 4).alias("center"), F.round(numeric.spread(numeric.present(*years)), 4).cast("double").alias("volatility"))


@query("""WITH c AS (SELECT o_custkey, o_orderkey, (o_orderkey % 2) / 2.0::DOUBLE AS p FROM orders) SELECT o_custkey, o_orderkey,
 coalesce(product(1 - p) OVER w, 1.0) AS reach, coalesce(product(1 - p) OVER w, 1.0) * p AS admit FROM c WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def running_product(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", ((F.col("o_orderkey") % 2) / 2.0).alias("chance"))
    got = ranking.running_chances(rows, ["o_custkey"], "o_orderkey", "chance")
    return got.select("o_custkey", "o_orderkey", "reach", "admit")


_BANDS = {"AUTOMOBILE": 5, "BUILDING": 8, "FURNITURE": 3}
_QUOTA_SQL = """q AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn <= CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 5 WHEN 'BUILDING' THEN 8 WHEN 'FURNITURE' THEN 3 ELSE 0 END)"""


@query(f"WITH {_QUOTA_SQL} SELECT c_custkey, c_mktsegment FROM q")
def quota_topk(t: Tables) -> DataFrame:
    return ranking.quota_top(t.customer, "c_mktsegment", _BANDS, [F.desc("c_acctbal"), F.asc("c_custkey")]).select("c_custkey", "c_mktsegment")


@query(f"WITH {_QUOTA_SQL} SELECT c_custkey FROM q UNION ALL (SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM q) ORDER BY c_acctbal DESC, c_custkey LIMIT (SELECT 40 - count(*) FROM q))")
def fill_to_n(t: Tables) -> DataFrame:
    order = [F.desc("c_acctbal"), F.asc("c_custkey")]
    return ranking.fill_to(ranking.quota_top(t.customer, "c_mktsegment", _BANDS, order), t.customer, "c_custkey", 40, order).select("c_custkey")


@query("""WITH s AS (SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 60), m AS (SELECT * FROM s WHERE c_nationkey = 3), x AS (SELECT * FROM customer WHERE c_nationkey = 3 AND c_custkey NOT IN (SELECT c_custkey FROM s) ORDER BY c_acctbal DESC, c_custkey LIMIT (SELECT greatest(0, 12 - count(*)) FROM m)),
a AS (SELECT * FROM s UNION ALL SELECT * FROM x), k AS (SELECT * FROM a WHERE c_nationkey = 3 ORDER BY c_acctbal DESC, c_custkey LIMIT 12), r AS (SELECT * FROM a WHERE c_custkey NOT IN (SELECT c_custkey FROM k) ORDER BY c_acctbal DESC, c_custkey LIMIT (SELECT 60 - count(*) FROM k))
SELECT c_custkey FROM k UNION ALL SELECT c_custkey FROM r""")
def minimum_group_floor(t: Tables) -> DataFrame:
    order = [F.desc("c_acctbal"), F.asc("c_custkey")]
    return ranking.with_floor(ranking.top_n(t.customer, 60, order), t.customer, "c_custkey", F.col("c_nationkey") == 3, 12, order, 60).select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 900) AND c_acctbal > 0")
def backup_pool(t: Tables) -> DataFrame:
    top = ranking.top_n(t.customer, 900, [F.desc("c_acctbal"), F.asc("c_custkey")])
    return t.customer.where("c_acctbal > 0").join(top.select("c_custkey"), "c_custkey", "left_anti").select("c_custkey")


@query("SELECT c_custkey, ((row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1) % 12)::INTEGER AS shard FROM customer")
def round_robin_shards(t: Tables) -> DataFrame:
    return ranking.round_robin(t.customer, [F.desc("c_acctbal"), F.asc("c_custkey")], 12).select("c_custkey", "shard")


@query("SELECT c_custkey, CASE WHEN row_number() OVER w <= (count(*) OVER (PARTITION BY c_mktsegment) + 1) // 2 THEN 1 ELSE 2 END AS half FROM customer WINDOW w AS (PARTITION BY c_mktsegment ORDER BY c_custkey)")
def midpoint_split(t: Tables) -> DataFrame:
    return ranking.halves(t.customer, "c_mktsegment", [F.asc("c_custkey")]).select("c_custkey", "half")


@query("""WITH RECURSIVE g AS (SELECT c_nationkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, c_nationkey) AS i FROM customer GROUP BY c_nationkey),
r(i, loads, s, n) AS (SELECT 0::BIGINT, [0, 0, 0, 0]::BIGINT[], 0::BIGINT, 0::BIGINT UNION ALL SELECT g.i, list_transform(loads, lambda x, k: CASE WHEN k = list_position(loads, list_min(loads)) THEN x + g.n ELSE x END), list_position(loads, list_min(loads))::BIGINT, g.n FROM r JOIN g ON g.i = r.i + 1)
SELECT (s - 1)::INTEGER AS shard, sum(n)::BIGINT AS n, count(*)::BIGINT AS groups FROM r WHERE i > 0 GROUP BY s""")
def lpt_shards(t: Tables) -> DataFrame:
    return ranking.balance(t.customer, "c_nationkey", 4).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c_nationkey").alias("groups"))


@query("SELECT c_custkey, least(2, floor((row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1) / ceil(count(*) OVER () / 3)))::INTEGER AS tier FROM customer")
def quality_tiers(t: Tables) -> DataFrame:
    return ranking.tiers(t.customer, [F.desc("c_acctbal"), F.asc("c_custkey")]).select("c_custkey", "tier")


@query("""SELECT o_custkey, CASE WHEN o_totalprice <= 20000 THEN '0_20k' WHEN o_totalprice <= 30000 THEN '20k_30k' WHEN o_totalprice <= 37000 THEN '30k_37k' WHEN o_totalprice <= 40000 THEN '37k_40k' WHEN o_totalprice <= 50000 THEN '40k_50k' WHEN o_totalprice <= 60000 THEN '50k_60k'
 WHEN o_totalprice <= 75000 THEN '60k_75k' WHEN o_totalprice <= 100000 THEN '75k_100k' WHEN o_totalprice <= 150000 THEN '100k_150k' WHEN o_totalprice <= 250000 THEN '150k_250k' WHEN o_totalprice <= 400000 THEN '250k_400k' ELSE 'out' END AS bin,
 round(ln(least(greatest(o_totalprice / 400000.0, 1e-6), 1 - 1e-6) / (1 - least(greatest(o_totalprice / 400000.0, 1e-6), 1 - 1e-6))), 8) AS z FROM orders""")
def rank_bins(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", numeric.rank_bin(F.col("o_totalprice")).alias("bin"), F.round(numeric.logit_rank(F.col("o_totalprice"), 400_000), 8).alias("z"))


@query("""SELECT l_returnflag, round(power(sum(l_quantity), 2) / sum(l_quantity * l_quantity), 6) AS effective_n, round((sum(l_quantity) - min(l_quantity) - max(l_quantity)) / (count(*) - 2), 8) AS trimmed FROM lineitem GROUP BY ALL""")
def effective_sample(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.round(aggregates.effective_n(F.col("l_quantity")), 6).alias("effective_n"), F.round(aggregates.trimmed_mean(F.col("l_quantity")), 8).alias("trimmed"))


@query("""SELECT ((turn + 1 - 1) // 3 + 1)::BIGINT AS "window", count(*)::BIGINT AS n, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY ALL""")
def report_windows(t: Tables) -> DataFrame:
    return aggregates.windows_of(t.conversations.withColumn("at", F.col("turn") + 1), "at", 3, F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query(f"""WITH y AS ({_BY_YEAR}), w AS (SELECT p, max(CASE WHEN y = 1996 THEN v END) AS a, max(CASE WHEN y = 1997 THEN v END) AS b, max(CASE WHEN y = 1998 THEN v END) AS c FROM y GROUP BY p)
SELECT p AS l_partkey, '1996_v' AS "from", a AS old, b AS new FROM w WHERE a > 0 AND b > 0 UNION ALL SELECT p, '1997_v', b, c FROM w WHERE b > 0 AND c > 0""")
def year_pairs(t: Tables) -> DataFrame:
    return projection.pairs(_yearly(t), ["l_partkey"], ["1996_v", "1997_v", "1998_v"])


@query("""SELECT n_nationkey, i // 40 AS part, c_custkey, (i % 40)::INTEGER AS place, c_name, n_rows, n_names FROM (SELECT n_nationkey, c_custkey, c_name, row_number() OVER (PARTITION BY n_nationkey ORDER BY c_custkey) - 1 AS i FROM customer JOIN nation ON n_nationkey = c_nationkey)
JOIN (SELECT c_nationkey, count(*)::BIGINT AS n_rows, count(DISTINCT c_mktsegment)::BIGINT AS n_names FROM customer GROUP BY ALL) ON c_nationkey = n_nationkey""")
def group_packets(t: Tables) -> DataFrame:
    """Customers of each nation in packets of at most 40, in order."""
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    got = projection.packets(rows, "n_nationkey", "c_mktsegment", ["c_custkey", "c_name"], 40)
    return got.select("n_nationkey", "part", "n_rows", "n_names", F.posexplode("rows").alias("place", "row")).select("n_nationkey", "part", "place", "row.c_custkey", "row.c_name", "n_rows", "n_names")


@query("""SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_size > 25 THEN 'large' END, CASE WHEN p_retailprice > 1000 THEN 'dear' END], lambda x: x IS NOT NULL), ',') AS tags FROM part WHERE p_size > 25 AND NOT p_retailprice > 1500""")
def tag_filters(t: Tables) -> DataFrame:
    rows = t.part.withColumn("tags", F.array_compact(F.array(F.when(F.col("p_size") > 25, "large"), F.when(F.col("p_retailprice") > 1000, "dear"), F.when(F.col("p_retailprice") > 1500, "banned"))))
    return rows.where(filters.tags_pass(F.col("tags"), ["large"], ["banned"])).select("p_partkey", F.array_join("tags", ",").alias("tags"))


@query("""SELECT s_suppkey, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE NOT (contains(n_name, 'A') AND contains(s_name, '7'))""")
def manual_drops(t: Tables) -> DataFrame:
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return filters.drop_listed(rows, [("A", "7")], "n_name", "s_name").select("s_suppkey", "n_name")


@query("""SELECT label, n::BIGINT AS n, round(n / (SELECT count(*) FROM documents), 8) AS share, high::BIGINT AS high FROM (SELECT label, count(*) AS n, sum((c = 'high')::INT) AS high FROM (SELECT lang AS label, CASE WHEN doc_id % 2 = 0 THEN 'high' ELSE 'low' END AS c FROM documents UNION ALL SELECT source, 'low' FROM documents) GROUP BY label)""")
def coverage_summary(t: Tables) -> DataFrame:
    entries = F.array(
        F.struct(F.col("lang").alias("label"), F.when(F.col("doc_id") % 2 == 0, "high").otherwise("low").alias("confidence")), F.struct(F.col("source").alias("label"), F.lit("low").alias("confidence"))
    )
    got = aggregates.coverage(t.documents, entries)
    return got.select("label", "n", F.round("share", 8).alias("share"), F.coalesce(F.try_element_at("confidences", F.lit("high")), F.lit(0)).cast("long").alias("high"))


@query("""SELECT p_brand, p_partkey, CASE WHEN lead(p_partkey) OVER w IS NULL THEN 1.0 ELSE sum(p_size) OVER w / sum(p_size) OVER (PARTITION BY p_brand) END::DOUBLE AS cumulative FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey)""")
def cumulative_weights(t: Tables) -> DataFrame:
    return ranking.cumulative_share(t.part.select("p_brand", "p_partkey", "p_size"), ["p_brand"], ["p_partkey"], "p_size").select("p_brand", "p_partkey", "cumulative")


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END::INTEGER AS place, CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN '2-HIGH' ELSE o_orderpriority END AS priority FROM orders""")
def enum_order_and_repair(t: Tables) -> DataFrame:
    rows = projection.repair_where(t.orders, {"o_orderstatus": "P", "o_orderpriority": "1-URGENT"}, {"o_orderpriority": "2-HIGH"})
    return rows.select("o_orderkey", ranking.in_order(F.col("o_orderstatus"), ["P", "O"]).alias("place"), F.col("o_orderpriority").alias("priority"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 > 0 THEN '1998: ' || concat_ws(', ', 'score ' || CASE WHEN p_size % 2 = 0 THEN p_size END, 'rank ' || p_partkey, p_brand) END AS line FROM part""")
def history_lines(t: Tables) -> DataFrame:
    there = F.col("p_size") % 3 > 0
    line = projection.history_line(1998, F.when(there, F.col("p_partkey")), F.when(there & (F.col("p_size") % 2 == 0), F.col("p_size")), F.lit(None).cast("int"), F.col("p_brand"))
    return t.part.select("p_partkey", line.alias("line"))


@query("""SELECT count(*)::BIGINT AS n, count(*) FILTER (c_acctbal > 0)::BIGINT AS shown, count(*) FILTER (c_nationkey IN (SELECT s_nationkey FROM supplier))::BIGINT AS matched, count(*) FILTER (c_mktsegment = 'BUILDING')::BIGINT AS tagged FROM customer""")
def header_counts(t: Tables) -> DataFrame:
    known = t.supplier.select(F.col("s_nationkey").alias("c_nationkey"), F.lit(True).alias("known")).distinct()
    rows = t.customer.join(known, "c_nationkey", "left")
    return projection.header_counts(rows, F.col("c_acctbal") > 0, F.col("known"), F.col("c_mktsegment") == "BUILDING")
