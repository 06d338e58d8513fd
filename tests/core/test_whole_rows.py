"""Queries that leave no rows of their tables out."""

import math

import pytest

from plumbline.plans import landing, queries_domain, registry


def test_lookup_has_every_line(spark, sf):
    got = registry.QUERIES["unique_key_lookup"](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/lineitem.parquet").count() > got.where("l_linenumber = 1").count()


def test_difference_compares_every_document(spark, sf):
    docs = {r.doc_id: int(r.n_chars > 500) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    want = {i: "missing" if i not in labels else "extra" if i not in docs else "both" for i in docs.keys() | labels.keys() if docs.get(i) != labels.get(i)}
    assert {r.doc_id: r.side for r in registry.QUERIES["outer_diff"](spark, sf).collect()} == want and any(i % 3 == 0 for i in want)


def test_validation_expects_every_document(spark, tmp_path):
    docs = [(60, "a", "en", "s", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(60, 1, 0)], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    codes = {r.code for r in registry.QUERIES["validation_issues"](spark, str(tmp_path)).collect()}
    assert "extra_row" not in codes and any("lang" in c or "mismatch" in c or "changed" in c for c in codes), codes


def test_landing_has_small_plans(spark, sf):
    """All twelve choices against a plain sum over their pools."""
    t = registry.Tables(spark, sf)
    choices = queries_domain._choices(t).orderBy("order").collect()
    pool = landing.similarity_pool(queries_domain._choices(t), queries_domain._samples(t)).select("choice", "delta", "weight").collect()
    z = lambda r: math.log(r / 400_000 / (1 - r / 400_000))
    want, reach = {}, 1.0
    for c in choices:
        chance = 0.0
        for p in pool:
            if p.choice == c.choice:
                gap = z(float(c.rank)) + p.delta / math.sqrt(2) - z(45_000)
                chance += p.weight * (0.5 * math.erfc(-gap / 0.02 / math.sqrt(2)) if c.plan_count <= 3 else gap >= 0)
        want[c.choice] = (min(1.0, chance), reach, reach * min(1.0, chance))
        reach *= 1 - min(1.0, chance)
    got = {r.choice: (r.chance, r.reach, r.admit) for r in registry.QUERIES["landing_closed_form"](spark, sf).collect()}
    assert len(got) == 12 == len(want) and all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)
