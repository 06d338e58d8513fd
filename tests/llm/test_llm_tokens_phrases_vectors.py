"""Tokens, phrases and whitened vectors against the tokenizers library, brute force and numpy."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_brute import ODD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm import bpe, collocations, packing, queries, whitening

PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("alphabet", ["a", "ab", "thentionaréè", "日本語漢字", ".,!?-", "हीक", "0a.é", "ʼn'sİß"])
def test_parts_joined_are_what_the_whole_run_gives(tokenizer, alphabet):
    own, draw = bpe.codec(PATH), random.Random(alphabet)
    for size in (1, 2, 7, 60, 400):
        for leaf in (1, 2, 5, 33):
            word = "".join(draw.choice(alphabet) for _ in range(size))
            ids = []
            for run in own.runs(word):
                parts = bpe.halves(run, leaf)
                assert "".join(parts) == run and max(map(len, parts)) <= leaf
                ids += own.tree([own.part(p, i + 1 == len(parts)) for i, p in enumerate(parts)]).tolist()
            assert ids == tokenizer.encode(word, add_special_tokens=False).ids


def test_words_in_use_stay_known_while_others_are_forgotten(tokenizer):
    own, draw = packing.WordIds(PATH, 8), random.Random(0)
    encode, asked = own.model, Counter()

    class Model:
        def tokenize(self, part):
            asked[part] += 1
            return encode.tokenize(part)

    own.model = Model()
    for _ in range(200):
        word = "".join(draw.choice("theaioLÉß0'!<s") for _ in range(draw.randint(1, 9)))
        text = f"often {word} often"
        assert own.text(text.encode()) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert sum(len(x) for x in vars(own).values() if isinstance(x, dict)) <= 2 * 8
    assert asked["often"] == 1


@pytest.mark.parametrize("word", ["don't", "I'LL", "''s's", "a'", "x1'23ÀÉß", "<|endoftext|>", "<|", "ÿÐ÷", "×", "it're'velm", "İß"])
def test_plain_words_are_split_as_the_vocabulary_splits_them(tokenizer, word):
    assert packing.WordIds(PATH).text(word.encode()) == np.array(tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()


def coded(tokenizer, rows):
    out = Counter()
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        out[i, np.array(ids, dtype="<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)] += 1
    return out


def test_whole_texts(spark, sf, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.op11_bpe(spark, sf).collect()
    want = coded(tokenizer, [(r.doc_id, r.text) for r in docs.collect()])
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == Counter(
        {(i, len(b) // 4, hashlib.sha256(b).hexdigest(), hashlib.sha256(t.encode()).hexdigest()): n for (i, b, t), n in want.items()}
    )


def test_long_runs_special_tokens_and_repeated_rows(spark, tokenizer):
    long = "théré" * 4000
    texts = [*(t for _, t, _ in ODD), long, long, f"a {long} b<|endoftext|>{'xyz' * 900} {'é' * 300} end", "<|startoftext|>" * 60, "ab" * 50_000, "é" * 400, "İ" * 500]
    rows = [(i % 7 or None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("own"), "key": F.lit(1), "decoded": F.lit(2)})
    got = bpe.decode(bpe.encode(df, PATH, leaf=100), PATH)
    assert got.columns == ["doc_id", "ids", "decoded"]
    assert Counter((r.doc_id, bytes(r.ids), r.decoded) for r in got.collect()) == coded(tokenizer, rows)
    at_once = bpe.encode(df, PATH, leaf=100, decoded="decoded")
    assert at_once.columns == got.columns and Counter(map(tuple, at_once.collect())) == Counter(map(tuple, got.collect()))
    none = bpe.decode(bpe.encode(df.where("false"), PATH), PATH)
    assert none.count() == 0 and none.columns == got.columns


def test_other_vocabularies_go_through_their_tokenizer(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    other = Tokenizer.from_file(path)
    rows = [(1, "Some text, twice  spaced\n"), (2, None), (3, "é" * 200)]
    got = bpe.decode(bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), path, leaf=50), path).collect()
    assert Counter((r.doc_id, bytes(r.ids), r.decoded) for r in got) == coded(other, rows)


def brute_phrases(rows, least, longest=4, first=2000, inside=80):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    often = {k: a for k, a in f.items() if a >= least}
    best = {}
    for (lang, p), a in often.items():
        if len(p) > 1:
            cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            best[lang, p] = (score, a, f[lang, p[:k]], f[lang, p[k:]])
    dropped = {(lang, p[i : i + s]) for (lang, p), a in often.items() for s in range(2, len(p)) for i in range(len(p) - s + 1) if 100 * a >= inside * often[lang, p[i : i + s]]}
    out = set()
    for lang in n:
        own = sorted(((-v[0], -v[1], " ".join(p).encode(), v) for (x, p), v in best.items() if x == lang and (x, p) not in dropped))[:first]
        out |= {(lang, i + 1, p.decode(), v[1], v[2], v[3], n[lang], v[0]) for i, (_, _, p, v) in enumerate(own)}
    return out


def mined(df, **options):
    rows = [tuple(r) for r in collocations.mine(df, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    words = ["The", "of", "naïve", "x", "日本", "and", " odd", "q"]
    rows = [("en", " ".join(draw.choice(words) + draw.choice(["", "", "", ",", "\n", "\t", "."]) for _ in range(draw.randrange(200)))) for _ in range(30)]
    rows += [(None, "No language here. " * 40), ("", "a b c d e " * 30), ("fr", None), ("fr", ""), ("de", "!?.. \n\t"), ("en", "the of the of the of " * 300), *[("es", "same row " * 5)] * 20]
    return rows


@pytest.mark.parametrize("least", [2, 5, 30])
def test_phrases_match_brute_force(spark, texts, monkeypatch, least):
    df = spark.createDataFrame(texts, "lang string, text string").withColumns({"phrase": F.lit("own"), "n": F.lit(1), "prefix": F.lit(2)})
    want = brute_phrases(texts, least)
    assert mined(df, least=least) == want and len(want) > 10
    monkeypatch.setattr(collocations, "_hot", lambda total: 3)  # prefixes are lengthened, and most parts are broadcast
    assert mined(df.repartition(5), least=least) == want


def test_phrases_of_fewer_words_first_ones_and_no_rows(spark, texts):
    df = spark.createDataFrame(texts, "lang string, text string")
    for longest in (2, 3):
        assert mined(df, least=3, longest=longest) == brute_phrases(texts, 3, longest)
    assert mined(df, least=2, first=3, inside=50) == brute_phrases(texts, 2, first=3, inside=50)
    assert mined(df.where("false")) == set() == mined(df.where("text is null"))
    with pytest.raises(ValueError):
        collocations.mine(df, longest=5)


def test_chunks_of_text_are_cut_between_pieces():
    import pyarrow as pa

    draw = random.Random(4)
    text = "".join(draw.choice("ab ,.\n\té") for _ in range(3000)) + "longer than a chunk " * 20
    batch = pa.RecordBatch.from_pydict({"lang": ["en", None, "en"], "text": [text, None, "x, y"]}).set_column(0, "lang", pa.array(["en", "und", "en"]))

    def grams(limit):
        out = Counter()
        for c in collocations._chunked([batch], limit):
            names = [b.decode() for b in c.names.to_pylist()]
            for i, on in enumerate(c.goes_on.tolist()):
                out[c.lang, names[c.ids[i]], names[c.ids[i + 1]] if on else None] += 1
        return out

    assert grams(1) == grams(50) == grams(1 << 20)


def test_equal_pointers_of_many_chunks_become_one():
    import pyarrow as pa

    own = pa.RecordBatch.from_pydict({"lang": ["en"] * 4, "prefix": ["a b"] * 4, "third": ["c", "c", "d", "c"], "fourth": ["e", "e", None, None], "deal": pa.array([None] * 4, pa.string()), "n": [1, 2, 3, 4]})
    once = collocations._merged([own, own])
    assert once.num_rows == 3 and once.schema == own.schema
    key = ("en", "a b", None)
    assert sorted(collocations._extended(key, [once], 6, 4)) == sorted(collocations._extended(key, [own, own], 6, 4)) == [("en", "a b c", 14), ("en", "a b c e", 6), ("en", "a b d", 6)]


def brute_whitened(vectors, components=4):
    x = np.floor(256 * np.array(vectors, dtype=np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    c = (n * fit - sums) / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return n, ((n * x - sums) ** 2).sum(axis=1), (n * x - sums) / n @ axes / np.sqrt(values), values / np.trace(c.T @ c / n)


def compared(got, ids, vectors, components=4):
    n, deviation, whitened, explained = brute_whitened(vectors, components)
    rows = {(r.vec_id, r.component): r for r in got.collect()}
    assert set(rows) == {(i, k + 1) for i in ids for k in range(components)}
    own = np.array([[rows[i, k + 1].whitened for k in range(components)] for i in ids])
    assert np.allclose(own * np.sign((own * whitened).sum(axis=0)), whitened, rtol=0, atol=1e-8)
    assert [rows[i, 1].deviation for i in ids] == deviation.tolist()
    assert {r.n for r in rows.values()} == {n} and len({r.identity_error for r in rows.values()}) == 1 and max(r.identity_error for r in rows.values()) < 1e-9
    assert np.allclose([rows[ids[0], k + 1].explained for k in range(components)], explained, rtol=1e-10)


def test_whitening_matches_numpy(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = table.collect()
    compared(queries.op13_whitening(spark, sf), [r.vec_id for r in rows], [r.embedding for r in rows])
    compared(whitening.whiten(table.union(table).repartition(7), components=2).distinct(), [r.vec_id for r in rows], [r.embedding for r in rows], 2)


def test_whitening_of_wide_vectors_cuts_the_basis_back():
    rng = np.random.default_rng(2)
    for gap in (1.3, 1.01):
        axes = np.linalg.qr(rng.standard_normal((700, 700)))[0]
        spread = np.concatenate((gap ** -np.arange(5.0), np.linspace(0.9 * gap**-5, 0.01, 695)))
        matrix = axes * spread @ axes.T
        calls = []

        def times(block, matrix=matrix, calls=calls):
            calls.append(block.shape[1])
            return matrix @ block

        values, vectors = whitening.leading(times, 700, 4, most=64)
        assert np.allclose(values, spread[:4], rtol=1e-12) and np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-12
        assert np.abs(np.abs(axes[:, :4].T @ vectors) - np.eye(4)).max() < 1e-9 and set(calls) == {16}


def test_whitening_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 2.0]), (2, [None, 1.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, [-inf, 0.0]), (7, [1.0]), (8, []), (None, [0.0, -0.001]), (9, [-0.0, 5.0]), (9, [-0.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"x": F.lit(1), "id": F.lit(2), "component": F.lit(3)})
    got = whitening.whiten(df)
    kept = [[1.0, 2.0], [0.0, -0.001], [-0.0, 5.0]]
    compared(got.distinct(), [1, None, 9], kept, 2)
    assert got.count() == 8
    huge = {(r.vec_id, r.component): r for r in whitening.whiten(spark.createDataFrame([*rows, (10, [1e300, -1e300])], df.select("vec_id", "embedding").schema)).collect()}
    assert {i for i, _ in huge} == {1, None, 9, 10} and all(r.deviation is None and np.isfinite(r.whitened) for r in huge.values())
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(one).count() == 0 == whitening.whiten(df.where("vec_id = 3")).count() == whitening.whiten(df.where("vec_id = 8")).count()
    assert whitening.whiten(df.where("false")).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_sums_of_entries_near_the_ends_of_a_long(spark):
    ends = np.array([[2**63 - 1, -(2**63)], [2**63 - 1, -(2**63)], [-1, 0], [5, 7]], dtype=np.int64)
    fit = spark.createDataFrame([(r.tolist(),) for r in ends] * 3, "x array<long>").repartition(3)
    got = whitening.centre(fit, 2)
    assert got.n == 12 and got.sums == [3 * sum(int(v) for v in column) for column in ends.T]
    assert got.deviations(np.array([[5, 7]])) == [None] and whitening.Centre(2, [10, 4]).deviations(np.array([[5, 7]])) == [100]
