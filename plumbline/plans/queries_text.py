"""Queries over texts: normalising, tags, keywords, extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text, udfs
from plumbline.operators import aggregates, keywords
from plumbline.plans import triage
from plumbline.plans.registry import Tables, query
from plumbline.sources import readers


@query(r"""SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS squeezed_head, length(regexp_replace(text, '\s+', '', 'g'))::BIGINT AS n_compact FROM documents""")
def text_normalize(t: Tables) -> DataFrame:
    x = F.col("text")
    return t.documents.select("doc_id", text.squeeze(x).alias("squeezed_head"), F.length(text.compact(x, compose=False)).cast("long").alias("n_compact"))


@query(r"""SELECT doc_id, md5(trim(regexp_replace(translate(nfc_normalize(translate(text, '　（），：；！？', ' (),:;!?')), '（），、﹣－', '(),,--'), '[\s\x{A0}]+', ' ', 'g'), ' ')) AS digest FROM documents""")
def text_normalize_nfkc(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(text.normalize_text(F.col("text")).cast("binary")).alias("digest"))


@query("""SELECT p_partkey, regexp_replace(regexp_replace(p_name || ' (' || p_brand || ')', '\\([^()]*\\)', '', 'g'), '\\s+', '', 'g') AS name_key,
 p_brand || '(' || p_type || ')' AS second FROM part""")
def text_keys(t: Tables) -> DataFrame:
    named = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))
    pair = text.identity_candidates(F.col("p_brand"), F.concat(F.lit("x/"), F.col("p_type")), {})
    return t.part.select("p_partkey", text.compact_key(named, True, compose=False).alias("name_key"), F.element_at(pair, 2).alias("second"))


@query("""SELECT tag, count(*)::BIGINT AS n FROM (SELECT unnest(list_distinct(list_filter(list_transform(regexp_split_to_array(replace(lower(url), '://', ';'), '[;/.?#]+'), lambda x: trim(x)), lambda x: x <> ''))) AS tag FROM pages) GROUP BY tag""")
def tag_split_counts(t: Tables) -> DataFrame:
    cells = F.regexp_replace(F.replace(F.lower("url"), F.lit("://"), F.lit(";")), "[/.?#]+", ";")
    return aggregates.tag_counts(t.pages, F.array_distinct(text.split_tags(cells)))


@query("""SELECT lang, count(*)::BIGINT AS n, sum(CASE WHEN contains(text, 'License') OR contains(text, '@') OR contains(text, '***') THEN 1 ELSE 0 END)::BIGINT AS n_any,
 sum(CASE WHEN length(text) - length(replace(text, '!', '')) >= 4 THEN 1 ELSE 0 END)::BIGINT AS n_loud FROM documents GROUP BY lang""")
def has_any_classify(t: Tables) -> DataFrame:
    any_ = text.has_any(F.col("text"), ("License", "@", "***"))
    loud = F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit(""))) >= 4
    return t.documents.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(any_).alias("n_any"), F.count_if(loud).alias("n_loud"))


@query("""SELECT doc_id, (length(text) - length(replace(text, '?', '')) >= 4 OR contains(text, '�') OR contains(text, '锟斤拷') OR contains(text, 'Ã') OR contains(text, 'â€')) AS garbled FROM documents""")
def mojibake_flags(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.mojibake(F.col("text")).alias("garbled"))


@query("""SELECT event_id, try_cast(regexp_extract(props, '([0-9]+(?:\\.[0-9]+)?)', 1) AS DOUBLE) AS first_n, regexp_replace(props, '[^0-9]', '', 'g')::BIGINT AS digits,
 lpad(user_id::VARCHAR, 6, '0') AS code, (event_type IN ('true', 'yes', 'y', '1')) AS flag FROM events""")
def number_coercion(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", text.first_number(F.col("props")).alias("first_n"), text.digits(F.col("props"), compose=False).alias("digits"), text.pad_code(F.col("user_id"), 6).alias("code"), text.flag(F.col("event_type")).alias("flag")
    )


@query("""SELECT doc_id FROM documents WHERE contains(lower(text), 'the') AND (contains(lower(text), 'license') OR contains(lower(text), 'idiot')) AND NOT contains(lower(text), 'scum')""")
def keyword_bool_and_or_not(t: Tables) -> DataFrame:
    return keywords.search(t.documents, "the (license OR idiot) -scum", text.haystack(F.col("text"))).select("doc_id")


@query("""SELECT doc_id, source FROM documents WHERE contains(lower(text), 'of the') AND NOT (contains(lower(text), 'with that') OR contains(lower(text), 'for the'))""")
def keyword_phrase(t: Tables) -> DataFrame:
    return keywords.search(t.documents, """包含 "of the" 且 not ('with that' || "for the")""", text.haystack(F.col("text"))).select("doc_id", "source")


@query("""SELECT doc_id, 'closed' AS query FROM documents WHERE contains(lower(text), 'the') AND contains(lower(text), 'of') UNION ALL SELECT doc_id, 'blank' FROM documents""")
def keyword_broken_query(t: Tables) -> DataFrame:
    """A query that cannot be read finds nothing, the same with its parenthesis closed finds rows, and a blank one all."""
    out = None
    for name, query in (("broken", "the AND (of"), ("closed", "the AND (of)"), ("blank", " ")):
        found = keywords.search(t.documents, query, text.haystack(F.col("text"))).select("doc_id", F.lit(name).alias("query"))
        out = found if out is None else out.unionByName(found)
    return out


@query("""SELECT conv_id, turn, lower(concat_ws(' ', nullif(role, ''), nullif(text, ''))) AS hay FROM conversations""")
def row_haystack(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", text.haystack(F.col("role"), F.col("text")).alias("hay"))


def _unnegated_sql(cell: str, token: str) -> str:
    """Whether some occurrence has no negator before it, in its sentence and 40 characters, and no weakener in it or 8 characters after."""
    denied = " OR ".join(f"contains(h, '{n}')" for n in udfs.NEGATORS)
    weak = " OR ".join(f"contains(t, '{n}')" for n in udfs.WEAKENERS)
    parts = f"string_split({cell}, '{token}')"
    head = f"regexp_extract(right(array_to_string(parts[1:i], '{token}'), 40), '[^。；;\\n\\r]*$')"
    tail = f"'{token}' || left(array_to_string(parts[i + 1:], '{token}'), 8)"
    return f"(SELECT coalesce(bool_or(NOT ({denied}) AND NOT ({weak})), false) FROM (SELECT {head} AS h, {tail} AS t FROM (SELECT {parts} AS parts) AS a, unnest(range(1, len(parts))) AS u(i)))"


@query(f"""SELECT doc_id, {_unnegated_sql("'未见' || text || '导师'", "导师")} AS asserted, {_unnegated_sql("text", "License")} OR {_unnegated_sql("text", "idiot")} AS word FROM documents""")
def negation_window(t: Tables) -> DataFrame:
    x = F.concat(F.lit("未见"), F.col("text"), F.lit("导师"))
    return t.documents.select("doc_id", udfs.contains_unnegated(x, ["导师"]).alias("asserted"), udfs.contains_unnegated(F.col("text"), ["License", "idiot"]).alias("word"))


@query(f"""SELECT o_orderkey, {_unnegated_sql("cell", "宿舍")} AS one FROM (SELECT o_orderkey, o_clerk, (['未见宿舍。宿舍新', '没有说明宿舍', '无。宿舍好', '宿舍较少', '宿舍旁的条件不足', '非常好的宿舍', '宿舍很好', '宿舍离校一二三四五六七不足', ''])[o_orderkey % 9 + 1] || (['', '；宿舍', '暂无
宿舍'])[o_custkey % 3 + 1] AS cell FROM (SELECT *, '' AS o_clerk FROM orders))""")
def negated_cells(t: Tables) -> DataFrame:
    pick = lambda k, *cells: F.element_at(F.array(*map(F.lit, cells)), (F.col(k) % len(cells) + 1).cast("int"))
    cell = F.concat(pick("o_orderkey", "未见宿舍。宿舍新", "没有说明宿舍", "无。宿舍好", "宿舍较少", "宿舍旁的条件不足", "非常好的宿舍", "宿舍很好", "宿舍离校一二三四五六七不足", ""), pick("o_custkey", "", "；宿舍", "暂无\n宿舍"))
    return t.orders.select("o_orderkey", udfs.contains_unnegated(cell, ["宿舍"]).alias("one"))


@query(r"""SELECT doc_id, count(*)::BIGINT AS n_lines, sum(CASE WHEN trim(line) <> '' THEN 1 ELSE 0 END)::BIGINT AS n_full FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id""")
def line_scan(t: Tables) -> DataFrame:
    rows = readers.lines(t.documents, "text", ["doc_id"])
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.trim("line") != "").alias("n_full"))


@query(r"""WITH l AS (SELECT conv_id, turn, regexp_replace(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')) || ' ' || length(text) || ' 4 600 590 12345', '[()]', ' ', 'g'), '[\r\n]', ' ', 'g') AS line FROM conversations WHERE turn > 0),
t AS (SELECT conv_id, turn, trim(regexp_extract(line, '^(.*?)((?:\s\d+)*)$', 1)) AS name, list_transform(list_filter(regexp_split_to_array(trim(regexp_extract(line, '^(.*?)((?:\s\d+)*)$', 2)), '\s+'), lambda x: x <> ''), lambda x: x::INTEGER) AS a FROM l)
SELECT conv_id, turn, CASE WHEN conv_id IN (SELECT conv_id FROM conversations WHERE turn = 0) THEN 'name' || conv_id END AS college, name, a[1] AS admitted, CASE WHEN a[2] BETWEEN 1 AND 8 THEN a[2] END AS duration, CASE WHEN a[3] BETWEEN 100 AND 750 THEN a[3] END AS average,
 CASE WHEN len(a) >= 7 THEN a[4] WHEN len(a) = 5 AND a[4] >= 492 THEN a[4] END AS score1, CASE WHEN len(a) >= 7 THEN a[5] WHEN len(a) = 5 AND a[4] >= 492 THEN a[5] END AS rank1, CASE WHEN len(a) >= 7 THEN a[6] END AS score2, CASE WHEN len(a) >= 7 THEN a[7] END AS rank2,
 CASE WHEN len(a) >= 7 THEN a[6] WHEN len(a) = 5 THEN a[4] END AS lowest_score, CASE WHEN len(a) >= 7 THEN a[7] WHEN len(a) = 5 THEN a[5] END AS lowest_rank, CASE WHEN len(a) >= 7 THEN '2' WHEN len(a) = 5 THEN '1' END AS segment FROM t""")
def line_parser(t: Tables) -> DataFrame:
    """Conversations as printed pages: first turns are headers, later ones rows with numbers at the end."""
    line = F.when(F.col("turn") == 0, F.concat(F.lpad(F.pmod("conv_id", F.lit(9000)).cast("string"), 4, "0"), F.lit("name"), F.col("conv_id"), F.lit("(浙江·杭州)"))).otherwise(
        F.concat(text.squeeze(F.col("text")), F.lit(" "), F.length("text"), F.lit(" 4 600 590 12345"))
    )
    pages = t.conversations.select("conv_id", "turn", F.regexp_replace(line, r"[()\r\n](?=.*\d$)", " ").alias("line"))
    got = readers.parse_records(readers.kept_lines(pages), ["浙江", "北京"], "conv_id", ["turn"])
    return got.select("conv_id", "turn", "college", "name", readers.tail_record(F.col("numbers")).alias("r")).select("conv_id", "turn", "college", "name", "r.*")


@query(r"""SELECT orders.o_orderkey, trim(regexp_extract(line, '^(.*?)((?:\s\d+)*)$', 1)) AS head, len(string_split(trim(regexp_extract(line, '^(.*?)((?:\s\d+)*)$', 2)), ' '))::INTEGER AS n
FROM (SELECT o_orderkey, o_orderpriority || ' ' || o_custkey || ' ' || o_orderkey AS line FROM orders) AS orders""")
def tail_numbers(t: Tables) -> DataFrame:
    got = text.tail_numbers(F.concat_ws(" ", "o_orderpriority", "o_custkey", "o_orderkey"))
    return t.orders.select("o_orderkey", got.alias("s")).select("o_orderkey", "s.head", F.size("s.tail").alias("n"))


@query("""SELECT event_type, (props->>'$.k')::BIGINT AS k, count(*)::BIGINT AS n FROM events GROUP BY ALL""")
def json_props_extract(t: Tables) -> DataFrame:
    got = readers.json_documents(t.events, "props", "k bigint")
    return got.where("not broken").groupBy("event_type", F.col("doc.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT conv_id, (count(*) + 1)::INTEGER AS n_blocks, (count(*) FILTER (turn = m))::INTEGER AS last_rows, count(*) FILTER (role = 'user')::INTEGER AS n_users FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS m FROM conversations) GROUP BY conv_id""")
def fenced_blocks(t: Tables) -> DataFrame:
    """Conversations as Markdown: a block of one row for each turn, and one of sources; the last of a kind counts."""
    block = F.concat(F.lit("note\n```csv\npool_id,source_ids\n"), F.col("turn"), F.lit(","), F.col("role"), F.lit("\n```\n"))
    turns = t.conversations.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", block.alias("b")))), lambda x: x["b"]), "").alias("blocks"))
    body = F.concat("blocks", F.lit("again\n```\nsource_id,url\n1,x\n2,y\n```\n"))
    got = readers.fenced_blocks(turns.select("conv_id", body.alias("body")), "conv_id", "body", {"rows": ["pool_id", "source_ids"], "sources": ["source_id", "url"]})
    last = F.max(F.when(F.col("is_last") & (F.col("kind") == "rows"), F.col("n_rows")))
    return got.groupBy("conv_id").agg(F.count(F.lit(1)).cast("int").alias("n_blocks"), last.alias("last_rows"), F.count_if(F.contains("csv", F.lit(",user"))).cast("int").alias("n_users"))


@query("""WITH f AS (SELECT d.doc_id, n_chars, lang, contains(text, '%%%') AS symbols, contains(text, 'License') AS licensed, l.toxic, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)),
r AS (SELECT *, list_filter([CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN n_chars < 100 THEN 'too_short' END, CASE WHEN quality = 0 AND symbols THEN 'junk' END], lambda x: x IS NOT NULL) AS d,
 list_filter([CASE WHEN quality IS NULL THEN 'unlabelled' END, CASE WHEN licensed THEN 'licence_notice' END, CASE WHEN lang <> 'en' THEN 'not_english' END], lambda x: x IS NOT NULL) AS b FROM f)
SELECT doc_id, CASE WHEN len(d) > 0 THEN 'drop' WHEN len(b) > 0 THEN 'borderline' ELSE 'keep' END AS triage_bucket, coalesce(array_to_string(list_sort(d), ';'), '') AS drop_reasons, coalesce(array_to_string(list_sort(b), ';'), '') AS borderline_reasons FROM r""")
def triage_buckets(t: Tables) -> DataFrame:
    return _triaged(t).select("doc_id", "triage_bucket", "drop_reasons", "borderline_reasons")


def _triaged(t: Tables) -> DataFrame:
    rows = t.documents.join(t.labels, "doc_id", "left")
    c = F.col
    drop = [(c("toxic") == 1, "toxic"), (c("n_chars") < 100, "too_short"), ((c("quality") == 0) & F.contains(c("text"), F.lit("%%%")), "junk")]
    borderline = [(c("quality").isNull(), "unlabelled"), (F.contains(c("text"), F.lit("License")), "licence_notice"), (c("lang") != "en", "not_english")]
    return triage.triage(rows, drop, borderline, names=("keep", "borderline", "drop"))


@query("""SELECT reason, count(*)::BIGINT AS n FROM (SELECT unnest(list_filter([CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN n_chars < 100 THEN 'too_short' END, CASE WHEN quality = 0 AND contains(text, '%%%') THEN 'junk' END], lambda x: x IS NOT NULL)) AS reason
 FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY reason""")
def triage_reason_counts(t: Tables) -> DataFrame:
    return triage.reason_counts(_triaged(t), "drop_reasons")
