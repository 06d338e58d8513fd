"""The pipeline's stages against brute force, and the entry point without the operators of this package."""

import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from llm_brute import ODD, brute_base, brute_kept, brute_repeats, brute_targets, check_stage
from tokenizers import Tokenizer

import corpus_pipeline
from plumbline.llm import quality, queries, substring

ROOT = Path(corpus_pipeline.__file__).parent


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def stages():
    return dict(corpus_pipeline.STAGES)


def test_order_and_columns(spark, sf, docs, stages):
    assert list(stages) == ["quality_rules", "near_duplicates", "repeated_passages", "source_weights", "packed_sequences"]
    for name in list(stages)[:-1]:
        assert stages[name](spark, docs.limit(40), sf).columns == docs.columns


def test_quality_stage(spark, sf, docs, stages):
    model = quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    # Base rules by hand; probabilities, which other tests hold against plain loops, against the threshold.
    texts = {r.doc_id: r.text for r in docs.collect()}
    p = {i: float(quality.probabilities(model, [t.encode()])[0]) for i, t in texts.items()}
    want = {i for i, t in texts.items() if not brute_base(t)[-1] and p[i] >= 0.5}
    assert {r.doc_id for r in stages["quality_rules"](spark, docs, sf).collect()} == want and 0 < len(want) < len(texts)


def test_near_duplicate_stage(spark, sf, docs, stages):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_kept(rows)
    assert {r.doc_id for r in stages["near_duplicates"](spark, docs, sf).collect()} == want and len(want) < len(rows)


def test_passage_stage(spark, sf, docs, stages):
    rows = stages["repeated_passages"](spark, docs, sf).collect()
    before = {r.doc_id: r.text for r in docs.collect()}
    removed = {i: n for i, _, n, _ in brute_repeats(before.items())}
    for r in rows:
        assert len(before[r.doc_id].split()) - len(r.text.split()) == removed[r.doc_id] and r.n_chars == len(r.text)
        assert removed[r.doc_id] or r.text == before[r.doc_id]
    assert sum(removed.values())


def test_mixing_stage(spark, sf, docs, stages):
    rows = stages["source_weights"](spark, docs, sf).collect()
    size = lambda t: len(substring_words(t))
    sizes, taken, biggest = Counter(), Counter(), Counter()
    for r in docs.collect():
        sizes[r.source] += size(r.text)
        biggest[r.source] = max(biggest[r.source], size(r.text))
    for r in rows:
        taken[r.source] += size(r.text)
    want = brute_targets(sizes)
    assert all(abs(taken[s] - want[s]) <= biggest[s] for s in sizes)


def substring_words(text):
    return text.encode().split()


def test_run(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    load = Counter()
    for r in rows:
        assert len(np.frombuffer(r.ids, "<u4")) == r.length
        load[r.sequence_id] += r.length
    assert rows and max(load.values()) <= 2048


def test_odd_rows_pass_every_stage(spark, sf, stages, docs):
    odd = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in ODD], docs.schema)
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    for name, stage in stages.items():
        check_stage(name, ODD, stage(spark, odd, sf).collect(), {None, 1, 3, 7, 8, 9}, lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
        assert stage(spark, odd.limit(0), sf).count() == 0
    assert substring.strip_repeats(odd).count() == len(ODD)


def test_entry_without_this_package(tmp_path):
    for name in ("plumbline", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / name).is_dir() else shutil.copy)(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "plumbline/llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'reference_value_model' in q and not any(k.startswith('op') or k == 'pipeline' for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
