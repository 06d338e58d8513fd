"""Queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bpe, collocations, licences, media, mixing, packing, quality, sharding, simhash, substring, toxicity, urls, whitening
from plumbline.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.grade(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = licences.scan(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "digest", "licence", F.array_join("notices", ",").alias("notices"), "n_notice_lines")


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substring.drop_repeats(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = sharding.shard(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return got.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media.encode_texts(table(spark, sf_dir, "documents"))
    got = media.decode(stored)
    tail = F.substring("payload", -16, 16)
    return got.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(tail).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature",
        F.octet_length("pcm").cast("long").alias("pcm_bytes"), F.crc32("pcm").alias("pcm_crc32"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("probability", 6).alias("probability"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path(), decoded="decoded")
    return got.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_simhash, op3_licences, op4_urls, op5_substrings, op6_sharding, op7_packing, op8_media, op9_quality, op10_mixing, op11_bpe, op12_collocations, op13_whitening)
}


def _licence_sql() -> str:
    low = "regexp_replace(regexp_replace(regexp_replace(lower(text), '" + licences._OWNER + r"', '\1' || chr(10), 'g'), '" + licences._COPYRIGHT + "', '', 'g'), '" + licences._PUNCTUATION + "', ' ', 'g')"
    for old in licences._ORDER:
        low = f"regexp_replace({low}, '\\b{old}\\b', '{licences.SPELLINGS[old]}', 'g')"
    squeeze = "sha256(trim(regexp_replace({}, '[ \\n]+', ' ', 'g'), ' '))"
    held = parted = "trim(regexp_replace(t, '[ \\n]+', ' ', 'g'), ' ')"
    for old in licences.PAIRS:
        parted = f"regexp_replace({parted}, '\\b{old}\\b', '{licences.SPELLINGS[old]}', 'g')"
    for clause, form in licences.HOLDERS.items():
        held, parted = (f"regexp_replace({x}, '{clause}', '{form}', 'g')" for x in (held, parted))
    whole = licences.whole_digests()
    lines = licences.known_digests(licences.NOTICES)
    listed = lambda known: ", ".join(f"('{d}', '{n}')" for d, n in known.items())
    return f"""WITH c AS (SELECT row_number() OVER () AS r, doc_id, {low} AS t FROM documents),
d AS (SELECT r, doc_id, t, sha256({held}) AS digest, sha256({parted}) AS joined FROM c),
w(digest, name) AS (VALUES {listed(whole)}),
l AS (SELECT r, n.name FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM c) JOIN (VALUES {listed(lines)}) AS n(digest, name) ON n.digest = {squeeze.format("line")}),
g AS (SELECT r, string_agg(DISTINCT name, ',' ORDER BY name) AS notices, count(*) AS n FROM l GROUP BY r)
SELECT doc_id, d.digest, coalesce(w.name, j.name) AS licence, coalesce(notices, '') AS notices, coalesce(n, 0)::BIGINT AS n_notice_lines
FROM d LEFT JOIN w ON w.digest = d.digest LEFT JOIN w AS j ON j.digest = d.joined LEFT JOIN g USING (r)"""


_URL_SQL = """WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(action, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (SELECT page_id, max_by(action, length(h || p)) AS action, max_by(h || p, length(h || p)) AS rule FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(action, 'allow') AS verdict FROM u LEFT JOIN m USING (page_id)"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_SUBSTRING_SQL = rf"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, s, list_aggregate(w[s:s + 49], 'string_agg', ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d)),
f AS (SELECT g, min(doc_id) AS lo FROM g GROUP BY g),
h AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM g JOIN f USING (g) WHERE doc_id > lo),
x AS (SELECT doc_id, list(i) AS gone FROM h GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
 sha256(coalesce(list_aggregate(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda y, i: NOT list_contains(gone, i)) END, 'string_agg', ' '), '')) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)"""

_COLLOCATION_SQL = r"""WITH p AS (SELECT row_number() OVER () AS id, * FROM (SELECT coalesce(lang, 'und') AS lang,
 unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
w AS (SELECT id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
o AS (SELECT lang, size, list_aggregate(w[i:i + size - 1], 'string_agg', ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w), range(1, 5) AS s(size) WHERE i + size - 1 <= len(w)),
f AS (SELECT lang, phrase, any_value(size) AS size, count(*)::HUGEINT AS f FROM o GROUP BY lang, phrase HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
k AS (SELECT lang, phrase, f AS a, size, k, list_aggregate(w[1:k], 'string_agg', ' ') AS first, list_aggregate(w[k + 1:size], 'string_agg', ' ') AS rest FROM c, range(1, 4) AS s(k) WHERE k < size),
s AS (SELECT k.lang, k.phrase, a, k, x.f AS l, y.f AS r, 2000000 * a // (x.f + y.f) AS score FROM k JOIN f x ON x.lang = k.lang AND x.phrase = first JOIN f y ON y.lang = k.lang AND y.phrase = rest),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
z AS (SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.lang = b.lang AND g.size > 2 AND g.phrase <> b.phrase AND contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * g.f >= 80 * b.a)),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM z)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM t JOIN n USING (lang) WHERE rank <= 2000"""

ORACLE_SQL: dict[str, str] = {"op3_licences": _licence_sql(), "op4_urls": _URL_SQL, "op5_substrings": _SUBSTRING_SQL, "op12_collocations": _COLLOCATION_SQL}
