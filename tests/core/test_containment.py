"""Contained keys against brute force, and how many pairs are compared."""

import random

from pyspark.sql import functions as F

from plumbline.operators import containment


def frame(spark, rows, name):
    return spark.createDataFrame(rows, f"year int, grp string, {name} string")


def test_contained_matches_brute_force(spark):
    draw = random.Random(1)
    word = lambda: "".join(draw.choice("abc学é ") for _ in range(draw.randrange(7)))
    left = [(draw.choice([1, 2]), draw.choice(["g", "h", None]), draw.choice([word(), None, word()])) for _ in range(200)]
    right = [(draw.choice([1, 2]), draw.choice(["g", "h", None]), draw.choice([word(), None, word()])) for _ in range(200)]
    want = {(y, g, a, b) for y, g, a in left for z, h, b in right if y == z and g == h and g is not None and a and b and (a in b or b in a)}
    got = [tuple(r) for r in containment.contained(frame(spark, left, "left"), frame(spark, right, "right"), ["year", "grp"]).collect()]
    assert set(got) == want and len(got) == len(want)
    none = frame(spark, [], "left")
    assert containment.contained(none, frame(spark, right, "right"), ["year", "grp"]).count() == 0
    assert containment.contained(frame(spark, left, "left"), frame(spark, [], "right"), ["year", "grp"]).count() == 0


def test_one_group_of_many_keys(spark):
    """100,000 records in one group, and 2000 items: what is compared is close to what is found."""
    records = spark.range(100_000).select(F.lit(1).alias("year"), F.lit("g").alias("grp"), F.concat(F.lit("school of "), F.sha2(F.col("id").cast("string"), 256)).alias("longer"))
    items = spark.range(0, 100_000, 50).select(F.lit(1).alias("year"), F.lit("g").alias("grp"), F.substring(F.sha2(F.col("id").cast("string"), 256), 5, 12).alias("shorter"))
    found = containment.held(items, records, ["year", "grp"])
    assert found.count() == 2000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
