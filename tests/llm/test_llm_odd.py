"""Every operator and stage on rows that are odd in other ways: clashing names, repeated rows, very long texts, empty tables."""

import hashlib
from collections import Counter

import pytest
from llm_brute import WORD, brute_base, brute_fingerprint, check_stage
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import bpe, collocations, licences, media, mixing, packing, quality, queries, sharding, simhash, substring, toxicity, urls, whitening

#: Names that the operators use inside, or return.
CLASHING = ("id", "y", "words", "times", "place", "g", "shard", "slot", "size", "cell", "rank", "codec", "fingerprint", "component_id", "rep", "role", "prefix", "key", "node", "spans", "_key", "_hash", "_spans", "whole", "below", "copies", "taken", "target", "kept", "probability", "length", "start", "drop_id", "c0", "d0")
LONG = " ".join(f"word{i % 40000}" for i in range(600_000))  # some 6 MB
ROWS = [(1, LONG, "a"), (2, "short text of a few words", "a"), (2, "short text of a few words", "a"), (None, None, None), (3, "other words " * 40, "b"), (3, "other words " * 40, "b"), (3, "again, the same id", "b"), (4, "\n\n", None)]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string").withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long")})
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 0), (3, 0, 1), (9, 1, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_operators(odd, labels):
    every = Counter(i for i, _, _ in ROWS)
    tox, good = toxicity.train(odd, labels), quality.train(odd, labels)
    path = queries.tokenizer_path()
    for table, want in ((odd, every), (odd.where("false"), Counter())):
        assert ids(toxicity.grade(table, tox)) == want
        prints = simhash.near_duplicates(table).collect()
        assert Counter(r.doc_id for r in prints) == want and all(r.fingerprint == f"{brute_fingerprint(t):016x}" for r in prints for i, t, _ in ROWS if i == r.doc_id and i in (1, 2, 4))
        assert ids(licences.scan(table)) == want
        assert ids(substring.drop_repeats(table)) == want
        assert ids(sharding.shard(table)) == want
        packed = packing.pack(table, path).groupBy("doc_id").agg(F.sum("length").alias("n"), F.sum(F.when(F.col("start") == 0, F.col("doc_tokens"))).alias("all")).collect()
        assert {r.doc_id for r in packed} == set(want) and all(r.n == r["all"] for r in packed)
        assert ids(media.decode(media.encode_texts(table))) == want
        judged = quality.judge(table, good).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in judged) == (Counter((i, *brute_base(t)) for i, t, _ in ROWS) if want else Counter())
        coded = bpe.encode(table, path, decoded="decoded").collect()
        assert Counter(r.doc_id for r in coded) == want and all(len(r.ids) // 4 == len(r.decoded.split(" ")) for r in coded if r.ids)
        assert {tuple(r)[2] for r in collocations.mine(table).collect()} == ({"other words other words", "words other words other"} if want else set())
        judged_urls = urls.filter_urls(table.withColumn("page_id", F.col("doc_id")).withColumn("url", F.col("text")))
        assert Counter(r.page_id for r in judged_urls.collect()) == want
        vectors = table.withColumns({"vec_id": F.col("doc_id"), "embedding": F.array(F.length("text").cast("float"), F.col("doc_id").cast("float"))})
        assert set(r.vec_id for r in whitening.whiten(vectors).collect()) == set(want) - {None}
        mixed = mixing.mix(table).collect()
        assert Counter(r.doc_id for r in mixed) == want and all(r["size"] in {len(WORD.findall(t or "")) for i, t, _ in ROWS if i == r.doc_id} for r in mixed)


def test_models_do_not_depend_on_partitions(odd, labels):
    one, other = ((quality.train(odd.repartition(n, "text"), labels.repartition(n)), toxicity.train(odd.repartition(n, "text"), labels.repartition(n))) for n in (1, 7))
    assert (one[0].words == other[0].words).all() and (one[0].chars == other[0].chars).all() and (one[1].weights == other[1].weights).all()


def test_long_text_comes_back(odd):
    text = LONG.encode()
    row = media.decode(media.encode_texts(odd.where("doc_id = 1"))).first()
    assert bytes(row.payload).rstrip(b" ") == text and row.n_bytes == len(text)
    kept = substring.drop_repeats(odd).where("doc_id = 1").first()
    assert (kept.n_words, kept.n_removed) == (600_000, 0) and hashlib.sha256(kept.kept.encode()).digest() == hashlib.sha256(text).digest()


def test_keeping_operators_keep_columns_and_rows(odd):
    whole = sorted(map(str, odd.drop("text").collect()))
    assert simhash.keep_representatives(odd).columns == odd.columns
    stripped = substring.strip_repeats(odd)
    assert stripped.schema == odd.schema and sorted(map(str, stripped.drop("text").collect())) == whole
    assert mixing.apply_mix(odd).schema == odd.schema
    assert quality.keep_good(odd, quality.train(odd, odd.sparkSession.createDataFrame([], "doc_id long, quality int, toxic int"))).schema == odd.schema


def test_stages(spark, odd, tmp_path, labels):
    from tokenizers import Tokenizer

    folder, tokenizer = str(tmp_path), Tokenizer.from_file(queries.tokenizer_path())
    encode = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    odd.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, odd, folder)
        check_stage(name, ROWS, got.collect(), {1, 2, 3, 4, None}, encode)
        assert stage(spark, odd.where("false"), folder).count() == 0
        if name != "packed_sequences":
            assert got.columns == odd.columns
    # Of these rows only the long one can pass the base rules; then it is alone, and its source takes it once.
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} <= {1} and sum(r.length for r in rows) in (0, len(encode(LONG)) + 1)


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    for name, query in queries.QUERIES.items():
        assert query(spark, folder).count() == 0, name
    assert corpus_pipeline.run(spark, folder).count() == 0
