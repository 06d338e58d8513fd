"""Medians, running values, term scans and negation against brute force, on rows that one task need not hold."""

import random
import re
import statistics
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text, udfs
from plumbline.operators import aggregates, ranking

INF, NAN = float("inf"), float("nan")


@pytest.fixture(scope="module")
def values():
    draw = random.Random(1)
    kinds = {
        "spread": [draw.uniform(-1e6, 1e6) for _ in range(401)], "skewed": [10 ** draw.uniform(-300, 300) for _ in range(400)], "same": [7.5] * 300, "two": [1.0] * 150 + [2.0] * 150,
        "ends": [-1.7e308, 1.7e308, 0.0, 1.0, 2e-308, 3e-308] * 40, "infinite": [-INF] * 50 + [INF] * 120 + [1.0, 2.0] * 30, "one": [3.0], None: [draw.gauss(0, 1) for _ in range(333)], "missing": [None] * 40, "some": [None, 4.0, 8.0],
    }
    rows = [(k, v) for k, own in kinds.items() for v in own]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("most", "buckets"), [(1 << 16, 4096), (5, 4096), (2, 256)])
def test_medians(spark, values, monkeypatch, most, buckets):
    monkeypatch.setattr(ranking, "GROUP_ROWS", most)
    monkeypatch.setattr(ranking, "BUCKETS", buckets)
    df = spark.createDataFrame(values, "g string, v double")
    have = defaultdict(list)
    for g, v in values:
        if v is not None:
            have[g].append(v)
    rows = ranking.medians(df, ["g"], "v", "m").collect()
    assert {r.g: r.m for r in rows} == {g: statistics.median(own) for g, own in have.items()} and len(rows) == len(have)
    assert [r.m for r in ranking.medians(df, [], "v", "m").collect()] == [statistics.median(v for own in have.values() for v in own)]
    assert [r.m for r in ranking.medians(df.where("v is null"), [], "v", "m").collect()] == [None]
    nan = spark.createDataFrame([(NAN,)] * 30 + [(1.0,)] * 31, "v double")
    assert ranking.medians(nan, [], "v", "m").first().m == 1.0
    assert "Sort [_v" not in ranking.medians(df, ["g"], "v", "m")._jdf.queryExecution().executedPlan().toString()


def test_upper_medians(spark, values, monkeypatch):
    monkeypatch.setattr(ranking, "GROUP_ROWS", 5)
    df = spark.createDataFrame(values, "g string, v double")
    have = defaultdict(list)
    for g, v in values:
        if v is not None:
            have[g].append(v)
    assert {r.g: r.m for r in aggregates.upper_medians(df, ["g"], "v", "m").collect()} == {g: statistics.median_high(own) for g, own in have.items()}


def test_scan(spark):
    draw = random.Random(2)
    rows = [(draw.choice(["hot"] * 8 + ["a", "b", None]), i, draw.choice([None, draw.uniform(0.9, 1.1)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, i long, v double").repartition(5)
    kinds = {"s": (F.col("v"), "sum"), "p": (F.col("v"), "product"), "hi": (F.col("v"), "max"), "lo": (F.col("v"), "min"), "last": (F.when(F.col("v") > 1, F.struct("i", "v")), "max")}
    for before in (False, True):
        got = {r.i: r for r in ranking.scan(df, ["g"], [F.col("i")], kinds, before).collect()}
        state = defaultdict(list)
        for g, i, v in rows:
            own = state[g]
            if not before and v is not None:
                own.append((i, v))
            r, seen = got[i], [x for _, x in own]
            product = 1.0
            for x in seen:
                product *= x
            assert (r.s, r.p, r.hi, r.lo) == ((pytest.approx(sum(seen)), pytest.approx(product), max(seen), min(seen)) if seen else (None,) * 4)
            high = [t for t in own if t[1] > 1]
            assert (tuple(r["last"]) if r["last"] else None) == (high[-1] if high else None)
            if before and v is not None:
                own.append((i, v))
    whole = ranking.scan(df, [], [F.col("i")], {"n": (F.lit(1), "sum")}).orderBy("i")
    assert [r.n for r in whole.collect()] == list(range(1, 3001))
    assert ranking.scan(df.where("false"), ["g"], [F.col("i")], kinds).count() == 0
    share = {r.i: r.cumulative for r in ranking.cumulative_share(df.na.fill(1.0), ["g"], ["i"], "v").collect()}
    lasts = {g: i for g, i, _ in rows}
    assert len(share) == 3000 and all(share[i] == 1.0 for i in lasts.values())


def test_terms(spark):
    draw = random.Random(3)
    terms = ["ab", "abc", "b", "not found", "学院", "科技学院", "科", "a.c", "3+1", "(x", "é", "financ", "finance", "financial"]
    bits = [*terms, "a", "c", " ", "\n", "学", "院", "x", "financi"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(12))) for _ in range(500)] + [None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r for r in df.select("i", text.terms_in(F.col("t"), terms).alias("found"), text.has_any(F.col("t"), terms[3:9]).alias("any"), text.has_any(F.col("t"), terms[:1]).alias("one")).collect()}
    for i, t in enumerate(texts):
        assert sorted(got[i].found) == sorted(x for x in terms if x in (t or "")) and got[i].any == any(x in (t or "") for x in terms[3:9]) and got[i].one == ("ab" in (t or ""))


def test_unnegated_matches_brute_force():
    def brute(t, tokens):
        for token in filter(None, tokens):
            for m in re.finditer(f"(?={re.escape(token)})", t):
                head = re.split("[。；;\n\r]", t[max(0, m.start() - 40) : m.start()])[-1]
                if not any(n in head for n in udfs.NEGATORS) and not any(w in t[m.start() : m.start() + len(token) + 8] for w in udfs.WEAKENERS):
                    return True
        return False

    draw = random.Random(5)
    bits = ["无", "未见", "早操", "早", "操", "强制", "不足", "较少", "。", "x" * 9, " ", "ab", "aba", "\n"]
    lists = [["早操", "强制"], ["早", "aba"], ["ab", ""], [], ["没有的"]]
    for _ in range(3000):
        t = "".join(draw.choice(bits) for _ in range(draw.randrange(12)))
        assert udfs.occurs_in_each(t, lists) == [brute(t, own) for own in lists]


def test_asserted_matches_brute_force_and_is_linear():
    def brute(t, phrases, tokens, markers, near):
        if udfs.occurs_unnegated(t, phrases):
            return True
        for sentence in re.split("[。；;\n\r]", t):
            for token in tokens:
                for m in re.finditer(re.escape(token), sentence):
                    head = sentence[: m.start()]
                    if not any(n in head for n in udfs.NEGATORS) and any(k in head[-(near - 1) :] for k in markers):
                        return True
        return False

    draw = random.Random(4)
    bits = ["无", "没有", "未见", "早操", "早", "操", "强制", "要求", "求", "。", "；", "x", " ", "ab", "\n", "必须要求"]
    for _ in range(4000):
        t = "".join(draw.choice(bits) for _ in range(draw.randrange(14)))
        for near in (3, 6, 50):
            for tokens, markers in ((["早操"], ["要求", "必须要求"]), (["早", "操", "ab", "要求"], ["强制", "早", "要求"])):
                assert udfs.occurs_asserted(t, ["强制早操"], tokens, markers, near) == brute(t, ["强制早操"], tokens, markers, near)
    began = time.perf_counter()
    assert not udfs.occurs_asserted("早操x要" * 250_000, ["强制早操"], ["早操"], ["要求"])
    assert time.perf_counter() - began < 5
