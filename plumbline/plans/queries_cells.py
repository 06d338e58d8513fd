"""Queries over cells: names, prices, codes, subjects, tags and reports; with reading and writing of files.

The tables have no such cells, so each row takes one of some by its key.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators import aggregates, filters, joins, projection, quality, ranking
from plumbline.plans import landing, scoring
from plumbline.plans.registry import Tables, query
from plumbline.sources import cache, readers, spreadsheets, writers
from plumbline.sources.storage import forget, shared_folder

SUBJECTS = ("物理,化学(2门)", "物理/化学", "不提科目要求", "思想政治科目考生均须选考方可报考", "物理，，化学", " 生物 ", "化学(1门),物理(1门)")
COLLEGES = ("浙江大学(威海)", "浙江大学（民办）", "北京 大学“本部”", "中国·海洋大学", "山东大学(威海校区)", "学院(中外合作办学)", "")
PRICES = ("免费", "5,000元/年", "1.25万", "2.5", "学费3.5元起", "", "6万/年", "12345.5")
NAMES = ("[普通类]数学类", "12 34 计算机", "软件工程", " [A] 7 化学", "[x][y]物理", "8数学")
CODES = ("12.0", "7", "A-03", "无", " 00123456 ", "", "5.5")
TAGS = ("a;b c，d", "x|y,z；w", " p、q ； r", "", "m, m ;n", "not_found; S1 none s2")
LINES = ("数学类 物理&化学", "计算机 不限", "物理 / 化学", "化学", "英语 历史", "理科试验班 物理&化学/生物")
GRADES = ("第五轮学科评估 数学为A+，物理 B-", "A- 出现在 学科评估 之前", "没有结果 A+", "学科评估 a+ 又 A+")


def _pick(key: str, cells: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in cells]), (F.pmod(F.col(key), F.lit(len(cells))) + 1).cast("int"))


def _picked(key: str, cells: Sequence[str]) -> str:
    return "([" + ", ".join("'" + c.replace("'", "''") + "'" for c in cells) + f"])[{key} % {len(cells)} + 1]"


_COMPACT = r"regexp_replace(translate({}, '（），、﹣－', '(),,--'), '\s+', '', 'g')"


@query(f"""SELECT o_orderkey, replace(translate(regexp_replace(regexp_replace(replace({_COMPACT.format(_picked("o_orderkey", SUBJECTS))}, '不提科目要求', '不限'), '科目考生(均须|必须)选考方可报考', '', 'g'), '\\([0-9]+门\\)', '', 'g'), ',/', '&|'), '&&', '&') AS subject FROM orders""")
def subject_cells(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", text.normalize_subject(_pick("o_orderkey", SUBJECTS), compose=False).alias("subject"))


_KEY_SQL = f"""c AS (SELECT o_orderkey, {_COMPACT.format(_picked("o_orderkey", COLLEGES))} AS raw, {_COMPACT.format(_picked("o_custkey", COLLEGES))} AS other FROM orders),
k AS (SELECT o_orderkey, regexp_replace(regexp_replace(raw, '\\([^()]*\\)', '', 'g'), '[·,，、“”"]', '', 'g') AS a, regexp_replace(regexp_replace(other, '\\([^()]*\\)', '', 'g'), '[·,，、“”"]', '', 'g') AS b, raw FROM c),
m AS (SELECT o_orderkey, CASE a WHEN '山东大学' THEN '山大' ELSE a END AS a, CASE b WHEN '山东大学' THEN '山大' ELSE b END AS b, regexp_replace(regexp_replace(regexp_replace(raw, '[“”"]', '', 'g'), '\\([^()]*(?:民办|合作)[^()]*\\)', '', 'g'), '[·,，、]', '', 'g') AS own FROM k)"""


@query(f"WITH {_KEY_SQL} SELECT o_orderkey, a AS canonical, CASE own WHEN '中国海洋大学' THEN '海大' ELSE own END AS identity, a <> '' AND a = b AS compatible FROM m")
def college_keys(t: Tables) -> DataFrame:
    a, b = _pick("o_orderkey", COLLEGES), _pick("o_custkey", COLLEGES)
    aliases = {"山东大学": "山大"}
    return t.orders.select(
        "o_orderkey", text.canonical_key(a, aliases, compose=False).alias("canonical"), text.identity_key(a, ("民办", "合作"), {"中国海洋大学": "海大"}, compose=False).alias("identity"),
        text.compatible_keys(a, b, aliases, compose=False).alias("compatible"),
    )


_PRICE = _picked("o_orderkey", PRICES)
_FIRST = f"try_cast(regexp_extract(replace({_PRICE}, ',', ''), '([0-9]+(?:\\.[0-9]+)?)', 1) AS DOUBLE)"


@query(f"""SELECT o_orderkey, CASE WHEN contains({_PRICE}, '免费') THEN 0 ELSE round_even(CASE WHEN contains({_PRICE}, '万') THEN {_FIRST} * 10000 ELSE {_FIRST} END, 0) END::BIGINT AS price,
 CASE WHEN {_PRICE} = '' OR regexp_matches(replace({_PRICE}, ',', ''), '^\\d+(\\.0+)?$') THEN shown WHEN shown = '-' THEN '原表：' || {_PRICE} ELSE shown || '（原表：' || {_PRICE} || '）' END AS detail
 FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN '-' ELSE format('{{:,}}', o_custkey::BIGINT) || ' 元/年' END AS shown FROM orders)""")
def price_cells(t: Tables) -> DataFrame:
    raw = _pick("o_orderkey", PRICES)
    shown = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey").cast("double"))
    return t.orders.select("o_orderkey", text.money(raw, compose=False).alias("price"), text.price_detail(shown, raw).alias("detail"))


@query(f"""SELECT c_custkey, trim(regexp_replace(regexp_replace(trim({_picked("c_custkey", NAMES)}), '^\\[[^\\]]*\\]\\s*', ''), '^(?:\\d+\\s+)+', '')) AS name,
 CASE WHEN own = '' THEN trimmed WHEN length(own) >= 4 THEN own ELSE lpad(own, 4, '0') END AS code, {_picked("c_nationkey", ("浙江", " 浙江 ", "江苏"))} IN ('浙江', ' 浙江 ') AS home,
 contains({_picked("c_custkey", ("双一流大学", "985高校", "某学院"))}, '双一流') OR contains({_picked("c_custkey", ("双一流大学", "985高校", "某学院"))}, '985') AS marked,
 CASE c_mktsegment WHEN 'BUILDING' THEN '建筑' WHEN 'MACHINERY' THEN '机械' ELSE c_mktsegment END AS label
FROM (SELECT *, regexp_replace(trimmed, '[^0-9]', '', 'g') AS own FROM (SELECT *, regexp_replace(trim({_picked("c_custkey", CODES)}), '\\.0$', '') AS trimmed FROM customer))""")
def name_and_code_cells(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", text.clean_name(_pick("c_custkey", NAMES)).alias("name"), text.normalize_code(_pick("c_custkey", CODES), 4).alias("code"), text.in_home_region(_pick("c_nationkey", ("浙江", " 浙江 ", "江苏"))).alias("home"),
        text.marked_school(_pick("c_custkey", ("双一流大学", "985高校", "某学院"))).alias("marked"), text.label(F.col("c_mktsegment"), {"BUILDING": "建筑", "MACHINERY": "机械"}).alias("label"),
    )


def _split_sql(pattern: str, cell: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array({cell}, '{pattern}'), lambda x: trim(x)), lambda x: x <> '')"


_CELL = _picked("p_partkey", TAGS)


@query(f"""SELECT p_partkey, array_to_string({_split_sql("[;,；\\s]+", _CELL)}, '+') AS spaced, array_to_string({_split_sql("[;；,，]+", _CELL)}, '+') AS listed, array_to_string({_split_sql("[|,，;]", _CELL)}, '+') AS piped, array_to_string({_split_sql("[|,，;、]", _CELL)}, '+') AS marked,
 array_to_string(list_filter({_split_sql("[;,；\\s]+", _CELL)}, lambda x: lower(x) NOT IN ('not_found', 'none', 'nan', 'na', 'n/a', '-')), '+') AS sources,
 array_to_string(list_filter([trim({_CELL}), '', trim(p_name)], lambda x: x <> ''), '; ') AS joined FROM part""")
def tag_cells(t: Tables) -> DataFrame:
    cell = _pick("p_partkey", TAGS)
    kinds = [F.array_join(text.split_tags(cell, k), "+").alias(k) for k in ("spaced", "listed", "piped", "marked")]
    return t.part.select("p_partkey", *kinds, F.array_join(text.split_sources(cell), "+").alias("sources"), text.join_parts(cell, F.lit(" "), F.col("p_name")).alias("joined"))


_TAIL = "(不限|(?:物理|化学|生物)(?:\\s*[&/]\\s*(?:物理|化学|生物))*)$"


@query(f"""SELECT p_partkey, CASE WHEN hit THEN trim(regexp_extract(line, '^(.*?)\\s*{_TAIL}', 1)) ELSE line END AS head, CASE WHEN hit THEN regexp_replace(regexp_extract(line, '^(.*?)\\s*{_TAIL}', 2), '\\s+', '', 'g') ELSE '' END AS subject
FROM (SELECT *, regexp_matches(line, '^(.*?)\\s*{_TAIL}') AS hit FROM (SELECT p_partkey, {_picked("p_partkey", LINES)} AS line FROM part))""")
def subject_tails(t: Tables) -> DataFrame:
    got = text.subject_tail(_pick("p_partkey", LINES), ("物理", "化学", "生物"), "不限")
    return t.part.select("p_partkey", got.alias("s")).select("p_partkey", "s.head", "s.subject")


@query(f"""SELECT p_partkey, array_to_string(list_transform(list_filter(l, lambda x, i: list_position(l, x) = i), lambda x: x), ',') AS grades FROM (SELECT p_partkey, list_transform(list_concat(
 regexp_extract_all(g, '(?is)(?:学科评估).{{0,80}}?([abc][+-])', 1), regexp_extract_all(g, '(?is)([abc][+-]).{{0,80}}?(?:学科评估)', 1)), lambda x: upper(x)) AS l FROM (SELECT p_partkey, {_picked("p_partkey", GRADES)} AS g FROM part))""")
def grades_near_a_marker(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.array_join(text.near_pairs(_pick("p_partkey", GRADES), "学科评估", "[ABC][+-]"), ",").alias("grades"))


@query("""SELECT l_orderkey, l_linenumber, a[1]::INTEGER AS admitted, CASE WHEN a[2] BETWEEN 1 AND 8 THEN a[2]::INTEGER END AS duration, CASE WHEN a[3] BETWEEN 100 AND 750 THEN a[3]::INTEGER END AS average, s1::INTEGER AS score1, r1::INTEGER AS rank1, s2::INTEGER AS score2, r2::INTEGER AS rank2,
 coalesce(s2, s1)::INTEGER AS lowest_score, CASE WHEN s2 IS NOT NULL THEN r2 ELSE r1 END::INTEGER AS lowest_rank, CASE WHEN s2 IS NOT NULL THEN '2' WHEN s1 IS NOT NULL THEN '1' END AS segment
FROM (SELECT *, CASE WHEN len(a) >= 7 THEN a[4] WHEN len(a) = 5 AND a[4] >= 492 THEN a[4] END AS s1, CASE WHEN len(a) >= 7 THEN a[5] WHEN len(a) = 5 AND a[4] >= 492 THEN a[5] END AS r1,
 CASE WHEN len(a) >= 7 THEN a[6] WHEN len(a) = 5 AND a[4] < 492 THEN a[4] END AS s2, CASE WHEN len(a) >= 7 THEN a[7] WHEN len(a) = 5 AND a[4] < 492 THEN a[5] END AS r2
 FROM (SELECT l_orderkey, l_linenumber, ([l_quantity::INTEGER, l_linenumber + 2, l_suppkey % 900, 450 + l_partkey % 90, l_partkey % 5000, 400 + l_partkey % 70, l_suppkey * 7])[1:([2, 3, 5, 5, 7])[l_orderkey % 5 + 1]] AS a FROM lineitem))""")
def score_tails(t: Tables) -> DataFrame:
    whole = F.array(*[x.cast("int") for x in (F.col("l_quantity"), F.col("l_linenumber") + 2, F.col("l_suppkey") % 900, 450 + F.col("l_partkey") % 90, F.col("l_partkey") % 5000, 400 + F.col("l_partkey") % 70, F.col("l_suppkey") * 7)])
    n = F.element_at(F.array(*map(F.lit, (2, 3, 5, 5, 7))), (F.col("l_orderkey") % 5 + 1).cast("int"))
    return t.lineitem.select("l_orderkey", "l_linenumber", readers.tail_record(F.slice(whole, F.lit(1), n)).alias("r")).select("l_orderkey", "l_linenumber", "r.*")


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '' ELSE printf('%.4f%%', round_even(c_custkey / 1024.0 * 100, 4)) END AS share, printf('%.2f', c_custkey / 8.0) AS number, round_even(c_custkey / 2.0, 0)::BIGINT::VARCHAR AS whole, printf('%.2f%%', round_even(c_nationkey / 64.0 * 100, 2)) AS pct,
 CASE WHEN c_acctbal < 0 THEN '无历史' WHEN c_nationkey >= 3 THEN '3年' WHEN c_nationkey = 2 THEN '2年' ELSE '1年' END AS badge FROM customer""")
def report_cells(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    return t.customer.select(
        "c_custkey", writers.cell(F.when(F.col("c_acctbal") >= 0, key / 1024.0), "share").alias("share"), writers.cell(key / 8.0, "number").alias("number"), writers.cell(key / 2.0, "whole").alias("whole"),
        text.percent(F.col("c_nationkey") / 64.0).alias("pct"), text.history_badge(F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")), F.col("c_nationkey")).alias("badge"),
    )


@query("""SELECT c_custkey, row_number() OVER (ORDER BY v ASC NULLS LAST, c_custkey) AS up, row_number() OVER (ORDER BY v DESC NULLS FIRST, c_custkey) AS down, row_number() OVER (ORDER BY coalesce(v, -1) DESC, c_custkey) AS best
FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS v FROM customer)""")
def nulls_first_order(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("v"))
    out = rows
    for name, key in (("up", ranking.sort_key(F.col("v"))), ("down", ranking.sort_key(F.col("v"), True)), ("best", ranking.sort_key(F.col("v"), missing=-1.0))):
        out = out.join(ranking.numbered(rows, [key, F.asc("c_custkey")], name).select("c_custkey", name), "c_custkey")
    return out.drop("v")


def _folder(t: Tables) -> str:
    return f"{shared_folder(t.spark)}/files-{uuid.uuid4().hex}"


@query("""SELECT c_custkey::VARCHAR AS c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'a "b", ' || c_mktsegment END AS note, c_nationkey::VARCHAR AS nation FROM customer""")
def csv_round_trip(t: Tables) -> DataFrame:
    """Written in shards by nation with quotes and blanks, and read back by a glob, all strings."""
    rows = t.customer.select(F.col("c_custkey"), "c_name", F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit('a "b", '), F.col("c_mktsegment"))).alias("note"), F.col("c_nationkey").alias("shard"), F.col("c_nationkey").alias("nation"))
    folder = _folder(t)
    writers.write_by(rows, folder, "shard")
    got = readers.read_strings(t.spark, f"{folder}/shard=*/*.csv", "file")
    return got.where("file like '%.csv'").select("c_custkey", "c_name", "note", "nation")


@query("""SELECT 's' || (n_regionkey % 3) AS shard_id, n_name, n_nationkey::VARCHAR AS n_nationkey FROM nation UNION ALL SELECT 'retry', r_name, '' FROM region""")
def manifest_shards(t: Tables) -> DataFrame:
    """Shards that a manifest lists, one of them with other columns; and an optional file that is not there."""
    folder, entries = _folder(t), []
    parts = [(f"s{k}", t.nation.where(F.col("n_regionkey") % 3 == k).select("n_name", "n_nationkey")) for k in range(3)] + [("retry", t.region.select(F.col("r_name").alias("n_name")))]
    for name, part in parts:
        writers.write_csv(part, f"{folder}/{name}", quote_all=True)
        entries.append(f'{{"shard_id": "{name}", "rows": "{name}"}}')
    t.spark.createDataFrame([("{" + f'"shards": [{", ".join(entries)}]' + "}",)], "value string").coalesce(1).write.text(f"{folder}/manifest")
    got = readers.read_shards(t.spark, f"{folder}/manifest", folder)
    none = readers.read_optional(t.spark, f"{folder}/absent*", got.schema)
    return got.unionByName(none).select("shard_id", "n_name", F.coalesce("n_nationkey", F.lit("")).alias("n_nationkey"))


@query("""WITH p AS (SELECT p_partkey, p_name, p_size FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 40)
SELECT p_name AS name, p_partkey::VARCHAR AS code, row_number() OVER (ORDER BY p_size, p_partkey)::INTEGER AS "order" FROM p WHERE p_size % 10 <> 0""")
def choice_list(t: Tables) -> DataFrame:
    """A list with a header in two languages, blank rows and an order of its own; numbered again."""
    top = t.part.orderBy(F.desc("p_retailprice"), "p_partkey").limit(40)
    blank = F.col("p_size") % 10 == 0
    cell = lambda c: F.when(blank, F.lit("")).otherwise(c.cast("string"))
    rows = top.orderBy("p_size", "p_partkey").select(cell(F.col("p_partkey")).alias("代码"), cell(F.col("p_name")).alias("Name"), cell(F.col("p_size")).alias("志愿序号")).coalesce(1)
    folder = _folder(t)
    writers.write_csv(rows, folder)
    return readers.read_choices(t.spark, folder, {"代码": "code", "name": "name", "志愿序号": "order"}, ["name", "code", "order"])


@query("""SELECT s_suppkey, s_name, s_acctbal, '' AS remark, s_acctbal > 0 AS good, upper(s_name) AS loud FROM supplier WHERE s_name IS NOT NULL AND trim(s_name) <> ''""")
def projected_table(t: Tables) -> DataFrame:
    """Renamed by position, rows without required columns dropped, those of a list that are there, preferred first, missing ones added, a struct spread out."""
    rows = readers.table_with_header(t.supplier.select("s_nationkey", "s_suppkey", "s_name", "s_acctbal"), ["nation", "s_suppkey", "s_name", "s_acctbal"], ["s_name"])
    kept = projection.keep(rows, ["s_acctbal", "s_suppkey", "s_name", "absent"])
    full = projection.with_columns(projection.first_columns(kept, ["s_suppkey", "gone", "s_name"]), ["remark", "s_name"])
    return projection.expand(full.withColumn("x", F.struct((F.col("s_acctbal") > 0).alias("good"), F.upper("s_name").alias("loud"))), "x")


@query("""SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN 'money: balance=' || printf('%.2f', s_acctbal) || '; ' ELSE '' END || 'who: name=' || s_name || '; ' || 'other: s_nationkey=' || s_nationkey || ',s_suppkey=' || s_suppkey AS shown, 4::INTEGER AS n_flat FROM supplier""")
def labelled_sections(t: Tables) -> DataFrame:
    rows = t.supplier.select("s_nationkey", "s_suppkey", "s_name", F.when(F.col("s_acctbal") >= 0, F.format_string("%.2f", "s_acctbal")).alias("s_acctbal"))
    got = projection.sections(rows, {"money": [("s_acctbal", "balance"), ("absent", "none")], "who": [("s_name", "name")]})
    entry = lambda e: F.concat(e["label"], F.lit("="), e["value"])
    shown = F.array_join(F.transform("sections", lambda s: F.concat(s["title"], F.lit(": "), F.array_join(F.transform(s["entries"], entry), ","))), "; ")
    return got.select("s_suppkey", shown.alias("shown"), F.size("flat").alias("n_flat"))


@query("""WITH s AS (SELECT c_mktsegment AS k, count(*) AS n, floor(min(c_acctbal))::BIGINT AS lo, floor(max(c_acctbal))::BIGINT AS hi FROM customer GROUP BY k)
SELECT 'labels/' || k AS name, '板块: ' || k || '|余额: ' || lo || '-' || hi || '|人数: ' || n || '--' AS shown FROM s UNION ALL SELECT 'query/' || k, 'the OR ' || lower(k) || ' AND NOT "or"' FROM s
UNION ALL SELECT 'settings/' || k, '{"columns":["n"],"limits":{"high":' || hi || ',"low":' || lo || ',"top":5}}' FROM s
UNION ALL SELECT 'report', '## Segments' || chr(10) || chr(10) || '| segment | n | low |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || k || ' | ' || n || ' | ' || lo || ' |', chr(10) ORDER BY k) || chr(10) FROM s""")
def labels_and_settings(t: Tables) -> DataFrame:
    """For each segment of the customers: labels of its filters, a query for it shown again, its settings exported and imported; and a report of all."""
    import json

    from plumbline.operators import keywords

    low, high = (F.floor(f("c_acctbal")).cast("long") for f in (F.min, F.max))
    segments = t.customer.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"), low.alias("low"), high.alias("high")).orderBy("segment").collect()  # one row each
    rows = [("report", writers.render("Segments", [r.asDict() for r in segments], ["segment", "n", "low"]))]
    for r in segments:
        labels = filters.active_labels({"板块": r.segment, "院校": ""}, {"余额": (r.low, r.high), "人数": (r.n, None), "计划": (None, "")})
        config = writers.merged_config({"limits": {"low": 0, "top": 5}, "columns": ["segment"]}, None, {"limits": {"low": r.low, "high": r.high}, "columns": ["n"]})
        again = writers.import_config(writers.export_config(config, 4), 4)
        query_ = keywords.show(keywords.parse(f'the or ({r.segment.lower()} and not "or")'))
        rows += [(f"labels/{r.segment}", "|".join(labels)), (f"settings/{r.segment}", json.dumps(again, separators=(",", ":"), sort_keys=True)), (f"query/{r.segment}", query_)]
    return t.spark.createDataFrame(rows, "name string, shown string")


@query("""SELECT doc_id, string_agg(DISTINCT tag, ';' ORDER BY tag) AS tags, status, refs FROM (SELECT d.doc_id, unnest(CASE WHEN lang = 'en' THEN ['english', 'text'] WHEN lang = 'de' THEN ['german'] ELSE ['text'] END) AS tag, CASE WHEN source IN ('src1', 'src2') THEN source ELSE 'other' END AS status,
 CASE WHEN l.doc_id IS NOT NULL THEN d.doc_id::VARCHAR ELSE '' END AS refs FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)) GROUP BY doc_id, status, refs""")
def normalized_output(t: Tables) -> DataFrame:
    """Tags under their proper names, an enumeration repaired, and references to what is there only."""
    cell = F.when(F.col("lang") == "en", "EN; text,en").when(F.col("lang") == "de", "german;gone;zz").otherwise("text;unknown")
    rows = t.documents.select(
        "doc_id", quality.normalize_tags(cell, {"en": "english", "gone": None}, ["english", "german", "text"]).alias("tags"), quality.normalize_enum(F.concat(F.lit(" "), F.upper("source")), {}, ["src1", "src2", "other"], "other").alias("status"),
        F.concat(F.col("doc_id"), F.lit("; none; 999999999")).alias("refs"),
    )
    rows = rows.withColumn("tags", F.array_join(F.array_sort(F.split("tags", ";")), ";"))
    return quality.keep_known_references(rows, t.labels.select(F.col("doc_id").cast("string").alias("source_id")), "refs", "doc_id")


@query("""SELECT o_custkey, max_by(o_orderkey, (coalesce(rank, 0), -pos)) AS best, count(*)::BIGINT AS n FROM (SELECT o_custkey, o_orderkey, o_orderkey AS pos, CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 END AS rank FROM orders) GROUP BY o_custkey""")
def best_by_confidence(t: Tables) -> DataFrame:
    """The first of the rows whose confidence is the best."""
    rank = scoring.order_of(F.when(F.col("o_orderstatus") == "F", "high").when(F.col("o_orderstatus") == "O", "medium").otherwise("none"), scoring.CONFIDENCE_ORDER)
    return t.orders.groupBy("o_custkey").agg(aggregates.best(F.col("o_orderkey"), rank, F.col("o_orderkey")).alias("best"), F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey, last_name, n FROM (SELECT o_orderkey, o_custkey FROM orders) LEFT JOIN (SELECT c_nationkey AS k, arg_max(c_name, c_custkey) AS last_name, count(*)::BIGINT AS n FROM customer GROUP BY c_nationkey) ON k = o_custkey % 30""")
def last_row_lookup(t: Tables) -> DataFrame:
    names = t.customer.select(F.col("c_nationkey").cast("long").alias("k"), F.col("c_name").alias("last_name"), "c_custkey")
    rows = t.orders.select("o_orderkey", (F.col("o_custkey") % 30).cast("long").alias("k"))
    got = joins.lookup_last(rows, names, ["k"], F.col("c_custkey"))
    sizes = t.customer.groupBy(F.col("c_nationkey").cast("long").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return got.join(sizes, "k", "left").select("o_orderkey", "last_name", "n")


@query("""SELECT i AS k, count(*)::BIGINT AS n, array_to_string(list_sort(list(DISTINCT kind)), ',') AS kinds FROM (SELECT unnest(CASE WHEN n_nationkey % 2 = 0 THEN [n_regionkey::VARCHAR, (n_regionkey + 1)::VARCHAR] ELSE [n_regionkey::VARCHAR] END) AS i, 'nation' AS kind FROM nation
UNION ALL SELECT r_regionkey::VARCHAR, 'region' FROM region) GROUP BY i""")
def exploded_panels(t: Tables) -> DataFrame:
    """Evidence of two kinds, one of which belongs to several keys at once."""
    several = F.when(F.col("n_nationkey") % 2 == 0, F.concat_ws(";", F.col("n_regionkey"), F.col("n_regionkey") + 1)).otherwise(F.col("n_regionkey").cast("string"))
    parts = {"nation": t.nation.select(several.alias("k"), F.col("n_name").alias("file")), "region": t.region.select(F.col("r_regionkey").cast("string").alias("k"), F.col("r_name").alias("file"))}
    got = scoring.evidence_panels(parts, "k", ["file", "status"], 2)
    each = got.select("k", F.explode("panels").alias("p")).groupBy("k", "p.kind").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("k").agg(F.sum("n").alias("n"), F.array_join(F.array_sort(F.collect_list("kind")), ",").alias("kinds"))


@query("""SELECT choice, round(rank, 4) AS rank, found FROM (SELECT o_custkey AS choice, coalesce(c_acctbal, CASE WHEN o_custkey % 4 = 0 THEN 5.0 END) AS rank, CASE WHEN c_custkey IS NULL AND NOT o_custkey % 4 = 0 THEN 'missing' WHEN c_acctbal IS NULL AND o_custkey % 4 = 0 THEN 'manual' WHEN c_acctbal IS NULL THEN 'no_rank' ELSE 'matched' END AS found
FROM (SELECT DISTINCT o_custkey FROM orders) LEFT JOIN (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 5 <> 0) ON c_custkey = o_custkey) WHERE rank IS NOT NULL""")
def choices_with_missing_ranks(t: Tables) -> DataFrame:
    choices = t.orders.select(F.col("o_custkey").alias("choice")).distinct()
    model = t.customer.where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("choice"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("rank"))
    own = choices.where("choice % 4 = 0").select("choice", F.lit(5.0).alias("rank"))
    return landing.with_missing(choices, model, "manual", own).select("choice", F.round("rank", 4).alias("rank"), "found")


@query("""SELECT choice, count(*)::BIGINT AS n FROM (SELECT c_custkey AS choice, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS rank FROM customer UNION ALL SELECT s_suppkey + 100000000, NULL FROM supplier) WHERE rank IS NOT NULL OR choice >= 100000000 GROUP BY choice""")
def choices_audited(t: Tables) -> DataFrame:
    choices = t.customer.select(F.col("c_custkey").cast("long").alias("choice")).union(t.supplier.select((F.col("s_suppkey") + 100_000_000).cast("long")))
    model = t.customer.select(F.col("c_custkey").cast("long").alias("choice"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("rank"))
    return landing.with_missing(choices, model, "audit").groupBy("choice").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT label, coalesce(u.v, b.v) AS v FROM (SELECT n_name AS label, n_regionkey::VARCHAR AS v FROM nation) b FULL JOIN (SELECT CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'own ' || n_name END AS label, 'mine' AS v FROM nation WHERE n_nationkey % 3 = 0) u USING (label)""")
def merged_catalog(t: Tables) -> DataFrame:
    base = t.nation.select(F.col("n_name").alias("label"), F.col("n_regionkey").cast("string").alias("v"))
    own = t.nation.where("n_nationkey % 3 = 0").select(F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(F.concat(F.lit("own "), F.col("n_name"))).alias("label"), F.lit("mine").alias("v"))
    return scoring.merged_tags(base, own)


@query("""SELECT p_partkey, p_name FROM part WHERE NOT (contains(p_name, 'red') AND contains(p_type, 'STEEL')) AND (NOT p_size < 10 OR contains(p_brand, '3'))""")
def rows_not_listed(t: Tables) -> DataFrame:
    left = filters.drop_listed(t.part, [("red", "STEEL"), ("nothing", "at all")], "p_name", "p_type")
    return filters.exclude_unless(left, F.col("p_size") < 10, F.contains("p_brand", F.lit("3"))).select("p_partkey", "p_name")


@query("""SELECT o_orderkey, o_orderstatus AS side FROM orders""")
def split_by_label(t: Tables) -> DataFrame:
    """Rows in folders by label, which are all read again, one of them twice; and a union that keeps the first of each row."""
    folder = _folder(t)
    # Rows have numbers of their own, as keys may repeat or be null. The prefix keeps empty labels apart from those that
    # are null, whose folder is Hive's default.
    rows = t.orders.select(F.monotonically_increasing_id().alias("row"), "o_orderkey", "o_custkey", F.concat(F.lit("side-"), "o_orderstatus").alias("label"))
    writers.write_by(rows, folder, "label", "parquet")
    read = t.spark.read.schema(rows.schema).parquet(folder).withColumn("label", F.expr("substring(label, 6)"))
    again = read.withColumn("part", F.lit(1)).unionByName(read.where("label = 'F'").withColumns({"label": F.lit("again"), "part": F.lit(2)}))
    return ranking.first_of(again, ["row"], F.col("part")).select("o_orderkey", F.col("label").alias("side"))


@query("""SELECT s.n_regionkey::VARCHAR AS shard, (SELECT count(*) FROM nation n WHERE n.n_regionkey = s.n_regionkey)::BIGINT AS n_rows, n_regionkey % 2 = 0 AS used FROM (SELECT DISTINCT n_regionkey FROM nation) s WHERE n_regionkey % 2 = 0 OR n_regionkey = 1""")
def retries_accepted(t: Tables) -> DataFrame:
    """The rows of retry shards that no issue names, besides the main rows."""
    rows = t.nation.select("n_nationkey", F.col("n_regionkey").cast("string").alias("shard_id"))
    issues = quality.issue(rows.where("shard_id = '3'").distinct(), "x", "error", F.col("n_nationkey"), F.col("shard_id"))
    got = quality.accept_retries(rows.where("shard_id in ('0', '2', '4')"), rows.where("shard_id in ('1', '3')"), issues)
    return got.groupBy(F.col("shard_id").alias("shard")).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("used", F.col("shard").isin("0", "2", "4"))


@query("""SELECT tier, count(*)::BIGINT AS n, round(sum(admit), 6) AS admit, NULL::BIGINT AS w FROM (SELECT *, o_orderstatus AS tier, o_orderkey % 100 / 128.0 AS admit FROM orders) GROUP BY tier
UNION ALL SELECT 'top', o_orderkey, round(admit, 6), NULL FROM (SELECT o_orderkey, o_orderkey % 100 / 128.0 AS admit FROM orders ORDER BY admit DESC, o_orderkey LIMIT 20)
UNION ALL SELECT 'window', count(*), round(sum(o_orderkey % 100 / 128.0), 6), (floor((o_orderkey - 1) / 10) + 1)::BIGINT FROM orders GROUP BY ALL""")
def landing_report(t: Tables) -> DataFrame:
    """The aggregates of a report: by source, the twenty likeliest, by ten."""
    rows = t.orders.select(F.col("o_orderstatus").alias("tier"), (F.col("o_orderkey") % 100 / 128.0).alias("admit"), F.col("o_orderkey").alias("order"), F.lit(1.0).alias("total"))
    got = landing.report(rows)
    counted = rows.groupBy((F.floor((F.col("order") - 1) / 10) + 1).cast("long").alias("window")).agg(F.count(F.lit(1)).alias("n"))
    out = got["by_tier"].select("tier", "n", F.round("admit", 6).alias("admit"), F.lit(None).cast("long").alias("w"))
    out = out.unionByName(got["likeliest"].select(F.lit("top").alias("tier"), F.col("order").alias("n"), F.round("admit", 6).alias("admit"), F.lit(None).cast("long").alias("w")))
    return out.unionByName(got["by_ten"].join(counted, "window").select(F.lit("window").alias("tier"), "n", F.round("admit", 6).alias("admit"), F.col("window").alias("w")))


@query("""SELECT CASE history WHEN 0 THEN '无历史' WHEN 1 THEN '1年历史' WHEN 2 THEN '2年历史' ELSE '3年历史' END || CASE WHEN plan <= 3 THEN ';小计划' ELSE '' END || ';' || tier || ';eff_n=' || printf('%.0f', eff) AS note, count(*)::BIGINT AS n
FROM (SELECT c_custkey % 5 AS history, c_nationkey AS plan, c_mktsegment AS tier, (c_custkey % 40)::DOUBLE AS eff FROM customer) GROUP BY note""")
def model_notes(t: Tables) -> DataFrame:
    note = landing.note(F.col("c_custkey") % 5, F.col("c_nationkey"), F.col("c_mktsegment"), (F.col("c_custkey") % 40).cast("double"))
    return t.customer.groupBy(note.alias("note")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH f AS (SELECT c_nationkey::VARCHAR AS s, (['result.json', 'sources.csv', 'log.csv', 'annex.md'])[c_custkey % 4 + 1] AS file, max(greatest(0, floor(c_acctbal / 4000)))::BIGINT AS size FROM customer GROUP BY ALL),
n AS (SELECT n_nationkey::VARCHAR AS s, n_nationkey % 5 AS k, n_regionkey FROM nation), q AS (SELECT s, k, file AS want FROM n, (VALUES ('result.json'), ('sources.csv'), ('log.csv')) AS r(file))
SELECT s AS shard, 'error' AS severity, 'missing_file' AS code, want AS detail FROM q WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.s = q.s AND file = want) UNION ALL SELECT f.s, 'error', 'empty_file', file FROM f JOIN n USING (s) WHERE size = 0 AND file <> 'annex.md'
UNION ALL SELECT s, 'warning', 'file_pair_incomplete', 'log.csv,annex.md' FROM n WHERE (SELECT count(*) FROM f WHERE f.s = n.s AND file IN ('log.csv', 'annex.md')) = 1
UNION ALL SELECT s, 'error', 'row_count_mismatch', 'expected_2:got_' || c FROM (SELECT s, CASE k WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 4 THEN 1 ELSE 0 END AS c FROM n) WHERE c <> 2
UNION ALL SELECT s, 'error', 'invalid_json', s FROM n WHERE k = 2 UNION ALL SELECT s, 'error', 'missing_key', 'status' FROM n WHERE k = 1 UNION ALL SELECT s, 'error', 'missing_item_field', 'id' FROM n WHERE k IN (1, 4) UNION ALL SELECT s, 'error', 'invalid_level', 'odd' FROM n WHERE k = 1""")
def deep_results(t: Tables) -> DataFrame:
    """Results of shards as JSON documents and files: what is missing, empty, broken, not listed or not as many as expected."""
    files = t.customer.groupBy(F.col("c_nationkey").cast("string").alias("shard_id"), F.element_at(F.array(*map(F.lit, ("result.json", "sources.csv", "log.csv", "annex.md"))), (F.col("c_custkey") % 4 + 1).cast("int")).alias("file")).agg(
        F.max(F.greatest(F.lit(0), F.floor(F.col("c_acctbal") / 4000))).cast("long").alias("size")
    )
    shards = t.nation.select(F.col("n_nationkey").cast("string").alias("shard_id"))
    cells = ('{"status":"ok","items":[{"id":"a","level":"high"}]}', '{"items":[{"id":"","level":"low"},{"id":"b","level":"odd"}]}', "{broken", '{"status":"ok","items":[]}', '{"status":"ok","items":[{"level":"medium"}]}')
    parsed = readers.json_documents(t.nation.select(F.col("n_nationkey").cast("string").alias("shard_id"), _pick("n_nationkey", cells).alias("body")), "body", "status string, items array<struct<id:string,level:string>>")
    issues = quality.file_issues(files, shards, ["result.json", "sources.csv", "log.csv"], [("log.csv", "annex.md")])
    issues = issues.unionByName(quality.document_issues(parsed, "shard_id", "doc", "broken", ["status"], "items", ["id"], {"level": ["high", "medium", "low"]}))
    counts = parsed.where("not broken").select("shard_id", F.size("doc.items").alias("n"))
    return issues.unionByName(quality.count_issues(counts, shards.withColumn("n", F.lit(2)), "row_count_mismatch"))


@query("""SELECT doc_id, (doc_id % 4 + (doc_id % 3 = 0)::INT)::BIGINT AS n_blocks, (doc_id % 4 + (doc_id % 3 = 0)::INT)::BIGINT AS n_known, ((doc_id % 4 > 0)::INT + (doc_id % 3 = 0)::INT * 2)::BIGINT AS n_rows FROM documents WHERE doc_id % 4 + (doc_id % 3 = 0)::INT > 0""")
def extraction_scorecard(t: Tables) -> DataFrame:
    """Blocks of two kinds, as many as the document's id says, before the document's text."""
    rows = F.repeat(F.lit("```csv\npool_id,source_ids\n1,a\n```\n"), (F.col("doc_id") % 4).cast("int"))
    sources = F.when(F.col("doc_id") % 3 == 0, "```\nsource_id,url\nx,y\nz,w\n```\n").otherwise("")
    blocks = readers.fenced_blocks(t.documents.select("doc_id", F.concat(rows, sources, F.replace("text", F.lit("`"), F.lit(""))).alias("body")), "doc_id", "body", {"rows": ["pool_id", "source_ids"], "sources": ["source_id", "url"]})
    return quality.extraction_score(blocks, "doc_id").withColumn("n_rows", F.col("n_rows").cast("long"))


@query("""SELECT s_suppkey, s_name, n_name AS school_key FROM supplier JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey < 3) ON n_nationkey = s_nationkey""")
def annex_rows(t: Tables) -> DataFrame:
    """The rows of known keys, with a column of the lookup."""
    known = t.nation.where("n_regionkey < 3").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("school_key"))
    return joins.lookup_unique(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), known, ["s_nationkey"]).where("school_key is not null").drop("s_nationkey")


@query("""SELECT n_name, r_name, n_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey""")
def tables_round_trip(t: Tables) -> DataFrame:
    """Two tables written by the columns that lookups use, and read again."""
    folder = _folder(t)
    writers.write_tables({"nation": t.nation, "region": t.region}, folder, {"nation": ["n_regionkey", "absent"], "region": ["r_regionkey"]})
    nation, region = (t.spark.read.parquet(f"{folder}/{n}") for n in ("nation", "region"))
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name", "n_nationkey")


@query("""SELECT c_mktsegment || '-' || (n // 500) || '.xlsx' AS file, (n % 500 + 3)::INTEGER AS row_no, lpad(c_custkey::VARCHAR, 9, '0') AS code, c_name AS name, c_nationkey::VARCHAR AS nation
FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 AS n FROM customer)""")
def spreadsheet_round_trip(t: Tables) -> DataFrame:
    """Customers as workbooks by segment, 500 rows each, codes as texts; read again below their title and header."""
    folder = _folder(t)
    rows = t.customer.select("c_mktsegment", F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("code"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    spreadsheets.save(spreadsheets.workbooks(rows, "c_mktsegment", [F.asc("code")], ["code"], "customers", most=500), folder)
    return spreadsheets.sheet_table(spreadsheets.read_cells(t.spark, folder), ["code", "name", "nation"], 2, ["code", "name"])


@query("""SELECT n_name AS name, row_number() OVER (ORDER BY n_name)::BIGINT AS "order" FROM nation""")
def choice_workbook(t: Tables) -> DataFrame:
    """A choice list from a workbook whose header is in another language and whose columns stand in another order."""
    folder = _folder(t)
    rows = t.nation.select(F.lit("list").alias("b"), F.col("n_regionkey").alias("备注"), F.col("n_name").alias("院校"))
    spreadsheets.save(spreadsheets.workbooks(rows, "b", [F.asc("院校")]), folder)
    return spreadsheets.listed_table(spreadsheets.read_cells(t.spark, folder), {"院校": "name", "school": "name"}, ["name", "order"])


@query("""SELECT 'rows' AS what, r_regionkey AS k, r_name || CASE WHEN r_regionkey = 1 THEN ' again' ELSE '' END AS v FROM region WHERE r_regionkey <> 2 UNION ALL SELECT 'first', r_regionkey, 'parsed' FROM region
UNION ALL SELECT 'second', 1, 'parsed'""")
def parse_cache(t: Tables) -> DataFrame:
    """Files parsed once: after one has changed and one has gone, a second run parses the changed one only."""
    files, folder = _folder(t), _folder(t)
    key = F.regexp_extract("path", r"r_regionkey=(\d+)", 1).cast("long")
    lines = lambda found: found.select("path", F.explode(F.split(F.col("content").cast("string"), "\n")).alias("line")).where("line <> ''").select("path", F.get_json_object("line", "$.r_name").alias("name"))
    load = lambda: cache.parsed(t.spark, f"{files}/*/*.json", folder, lines, "1")
    region = t.region.select("r_regionkey", "r_name").repartition(1, "r_regionkey")
    region.write.partitionBy("r_regionkey").json(files)
    _, first = load()
    changed = region.where("r_regionkey in (1, 2)").withColumn("r_name", F.concat("r_name", F.lit(" again"))).where("r_regionkey = 1")
    forget(t.spark, f"{files}/r_regionkey=2")
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("r_regionkey").json(files)
    rows, second = load()
    said = lambda found, what: found.select(F.lit(what).alias("what"), key.alias("k"), F.lit("parsed").alias("v"))
    return rows.select(F.lit("rows").alias("what"), key.alias("k"), F.col("name").alias("v")).unionByName(said(first, "first")).unionByName(said(second, "second"))


@query("""SELECT c_custkey, v.name FROM (SELECT c_custkey, c_custkey % 6 AS k FROM customer ORDER BY CASE k WHEN 0 THEN 4 WHEN 1 THEN 0 WHEN 2 THEN 3 WHEN 3 THEN 1 WHEN 4 THEN 5 ELSE 2 END, c_custkey LIMIT 400) c
JOIN (VALUES (0, '清华大学'), (1, '北京大学'), (2, '南京大学'), (3, '复旦大学'), (4, '浙江大学'), (5, '吉林大学')) AS v(k, name) ON v.k = c.k""")
def pinyin_order(t: Tables) -> DataFrame:
    """The first rows by a school's name as its readers sort it, not by code point."""
    names = ("清华大学", "北京大学", "南京大学", "复旦大学", "浙江大学", "吉林大学")
    rows = t.customer.select("c_custkey", F.element_at(F.array(*map(F.lit, names)), (F.col("c_custkey") % 6 + 1).cast("int")).alias("name"))
    return ranking.top_n(rows, 400, [ranking.sort_key(F.col("name"), locale="zh"), F.asc("c_custkey")])


@query("""SELECT o_orderkey, coalesce(nullif(concat_ws(' · ', CASE WHEN o_custkey % 2 = 0 AND o_orderkey % 3 > 0 THEN '计划 ' || (o_orderkey % 50) || ' 人' END, CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 3 > 0 THEN '学费 ' || (o_custkey % 90) || '00 元/年' END,
 CASE WHEN o_orderkey % 3 > 0 AND o_orderpriority <> '1-URGENT' THEN o_orderpriority END, CASE WHEN o_orderkey % 3 = 1 THEN '2025位次 ' || o_custkey END, CASE WHEN o_orderkey % 3 = 2 THEN '2025最低分 ' || (o_orderkey % 700) END), ''), '主表未匹配') AS summary,
 CASE WHEN o_orderstatus = 'F' THEN '项目[confirmed|high|-]: ' || o_custkey || ' || other[-|-|open]: no word of it' WHEN o_orderstatus = 'O' THEN '项目[confirmed|-|-]: ' ELSE '' END AS evidence FROM orders""")
def row_summaries(t: Tables) -> DataFrame:
    """Admission and evidence of a row as the lines that an export has."""
    o, known = t.orders, F.col("o_orderkey") % 3
    when = lambda c, v: F.when(c, v.cast("string"))
    summary = projection.admission_summary(
        when((F.col("o_custkey") % 2 == 0) & (known > 0), F.col("o_orderkey") % 50), when((F.col("o_orderstatus") != "P") & (known > 0), F.concat((F.col("o_custkey") % 90).cast("string"), F.lit("00"))),
        when((known > 0) & (F.col("o_orderpriority") != "1-URGENT"), F.col("o_orderpriority")), when(known == 1, F.col("o_custkey")), when(known == 2, F.col("o_orderkey") % 700), 2025,
    )
    panel = lambda *v: F.struct(*[(x if isinstance(x, Column) else F.lit(x).cast("string")).alias(n) for n, x in zip(("kind", "status", "confidence", "training", "summary", "gaps"), v, strict=True)])
    panels = F.when(F.col("o_orderstatus") == "F", F.array(panel("project", "confirmed", "high", "", F.col("o_custkey").cast("string"), "unused"), panel("other", None, None, "open", "", "no word of it")))
    panels = panels.when(F.col("o_orderstatus") == "O", F.array(panel("project", "confirmed", None, None, None, None)))
    return o.select("o_orderkey", summary.alias("summary"), projection.evidence_lines(panels, {"project": "项目"}).alias("evidence"))
