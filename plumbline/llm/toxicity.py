"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade > k) = logistic(score - threshold_k): all thresholds share the weights of the score, so every
graded row informs all grades. Features are words, known by 64-bit hashes of their own instead of by
hash buckets, so a clean word never takes the weight of another; an L1 penalty leaves few of them.

Labels say toxic or not. Toxic rows are graded by the evidence in them, as words tell it that were weighed
on other rows: the sample is dealt into folds, and a row's evidence never comes from its own fold.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import within
from plumbline.llm.textcore import CHUNK, chunks, mix, pieces, span_hashes, word_spans

#: Labelled rows of each class that the model is fitted to, at most, by the hash of their id.
PER_CLASS = 2000
#: Grades: 0 for rows not labelled toxic, 1 to GRADES - 1 for toxic rows by the weight of their evidence.
GRADES = 4
#: Rows of the sample that a word must occur in.
LEAST_ROWS = 3
#: Bytes of a longer word that are a feature of their own, so that inflected and compound forms count together.
PREFIXES = (6,)
#: Weight of toxic rows in the fit, its L1 penalty, and the ridge on the words that it leaves.
SHARE, PENALTY, RIDGE = 0.2, 2e-3, 1e-3
#: Features that the labelled rows of a class give to the fit, at most, by an upper bound of each text's: further rows are not in the sample.
CLASS_FEATURES = 8 << 20
#: Folds by which the sample is graded, and the log-odds from which a word tells.
FOLDS, TELLING = 5, 2.0
#: Smallest P(grade > 0) that is called toxic.
FLAG = 0.5

#: A-Z to lower case; other ASCII but digits and letters to space, so a word is free of punctuation.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


@dataclass(frozen=True)
class Model:
    keys: np.ndarray  # hashes of words, ascending
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than grades


def _pairs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Position of the text and hash of the feature, for all features of the texts: words, and the first letters of longer ones."""
    docs, features = [], []
    for i, part in _parts(texts):
        joined = b"\n".join(part).translate(_FOLD)
        data = np.frombuffer(joined, dtype=np.uint8)
        starts, ends = word_spans(data)
        offsets = np.cumsum([0] + [len(t) + 1 for t in part])
        doc = i + np.searchsorted(offsets, starts, "right") - 1
        docs.append(doc)
        features.append(span_hashes(data, starts, ends))
        for n in PREFIXES:
            longer = np.flatnonzero(ends - starts > n)
            docs.append(doc[longer])
            features.append(mix(span_hashes(data, starts[longer], starts[longer] + n) + np.uint64(n)))
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *docs]), np.concatenate([none.astype(np.uint64), *features])


def _parts(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of whole texts with the position of the first, or pieces of one text that is too long for one run."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size + len(t) > 2 * CHUNK and i > lo:
            yield lo, texts[lo:i]
            lo, size = i, 0
        if len(t) > 2 * CHUNK:
            yield from ((i, [p]) for p in pieces(t))
            lo, size = i + 1, 0
        else:
            size += len(t)
    if lo < len(texts):
        yield lo, texts[lo:]


def scores(model: Model, texts: list[bytes]) -> np.ndarray:
    """Sum over the known words of weight times log(1 + count)."""
    doc, words = _pairs(texts)
    if not len(model.keys) or not len(words):
        return np.zeros(len(texts))
    at = np.minimum(np.searchsorted(model.keys, words), len(model.keys) - 1)
    hit = model.keys[at] == words
    pair, times = np.unique(doc[hit] * len(model.keys) + at[hit], return_counts=True)
    return np.bincount(pair // len(model.keys), model.weights[pair % len(model.keys)] * np.log1p(times), len(texts))


def above(thresholds: np.ndarray, score: np.ndarray) -> np.ndarray:
    """P(grade > k) for each row and threshold."""
    return 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds[None, :], -500, 500)))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> list:
    """Rows (doc_id, y, words, counts) of the sample, from whole texts."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    # A word and its prefix take three bytes at least.
    texts = within(docs, known, per_class, CLASS_FEATURES, lambda size: F.ceil(size * 2 / 3))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text", CHUNK):
            words, times = [], []
            for t in texts:
                got, n = np.unique(_pairs([t])[1], return_counts=True)
                words.append(got.tobytes())
                times.append(n.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(words, pa.binary()), pa.array(times, pa.binary())], names=["doc_id", "y", "words", "times"])

    got = texts.mapInArrow(run, "doc_id long, y int, words binary, times binary").collect()
    return sorted(got, key=lambda r: r["doc_id"])


def _odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """By how much more often, as a logarithm, toxic rows have a feature."""
    return np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))


def grades_of(y: np.ndarray, row: np.ndarray, column: np.ndarray, value: np.ndarray, size: int, grades: int) -> np.ndarray:
    """Grade 0 for rows with y 0; 1 to grades - 1, in even shares, for the others by the weight of telling features of other folds."""
    fold = np.arange(len(y)) % FOLDS
    evidence = np.zeros(len(y))
    for k in range(FOLDS):
        other, own = fold[row] != k, fold[row] == k
        toxic = np.bincount(column[other], y[row[other]], size)
        clean = np.bincount(column[other], 1 - y[row[other]], size)
        telling = _odds(toxic, clean, int(y[fold != k].sum()), int((1 - y[fold != k]).sum())) > TELLING
        evidence += np.bincount(row[own], telling[column[own]] * value[own], len(y))
    shown = np.sort(evidence[(y == 1) & (evidence > 0)])
    edges = [shown[len(shown) * k // (grades - 1)] for k in range(1, grades - 1)] if len(shown) else []
    return np.where(y == 1, 1 + np.searchsorted(np.array(edges), evidence, "right"), 0)


def fit(rows: list, share: float = SHARE, grades: int = GRADES, least_rows: int = LEAST_ROWS, penalty: float = PENALTY, ridge: float = RIDGE, steps: int = 400) -> Model:
    """The model of a sample; share: the weight of toxic rows among all, so that few of them count enough. Without rows of both classes nothing can be told: all rows get grade 0."""
    y = np.array([r["y"] for r in rows], dtype=np.int64)
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(grades - 1, 30.0) + np.arange(grades - 1))
    words = [np.frombuffer(r["words"], np.uint64) for r in rows]
    value = np.log1p(np.concatenate([np.frombuffer(r["times"], "<i4") for r in rows]).astype(np.float64))
    row = np.repeat(np.arange(len(rows)), [len(w) for w in words])
    vocabulary, column = np.unique(np.concatenate(words), return_inverse=True)
    toxic = np.bincount(column, y[row], len(vocabulary))
    clean = np.bincount(column, 1 - y[row], len(vocabulary))
    odds = _odds(toxic, clean, int(y.sum()), int((1 - y).sum()))
    chosen = np.flatnonzero((toxic + clean >= least_rows) & (odds != 0))
    number = np.full(len(vocabulary), -1)
    number[chosen] = np.arange(len(chosen))
    inside = number[column] >= 0
    row, column, value = row[inside], number[column[inside]], value[inside]
    grade = grades_of(y, row, column, value, len(chosen), grades)
    even = np.where(y == 1, share / (y == 1).sum(), (1 - share) / (y == 0).sum())
    w = np.zeros(len(chosen))
    base = np.array([np.log(((even * (grade > k)).sum() + 1e-3) / ((even * (grade <= k)).sum() + 1e-3)) for k in range(grades - 1)])
    t = np.maximum.accumulate(-base + 1e-3 * np.arange(grades - 1))
    target = grade[:, None] > np.arange(grades - 1)[None, :]
    open_ = np.ones(len(w), dtype=bool)
    # First with the L1 penalty, which picks the words; then these alone with a little ridge, which frees their weights.
    for l1, l2 in ((penalty, 0.0), (0.0, ridge)):
        squares, t_squares = np.full(len(w), 1e-8), np.full(grades - 1, 1e-8)
        for _ in range(steps):  # proximal steps, scaled by feature
            p = above(t, np.bincount(row, w[column] * value, len(rows)))
            g = (p - target) * even[:, None]
            slope = (np.bincount(column, g.sum(axis=1)[row] * value, len(w)) + l2 * w) * open_
            squares += slope**2
            t_squares += g.sum(axis=0) ** 2
            pace = 0.2 / np.sqrt(squares)
            w -= pace * slope
            w = np.sign(w) * np.maximum(np.abs(w) - pace * l1, 0)
            t = np.maximum.accumulate(t + 0.2 * g.sum(axis=0) / np.sqrt(t_squares))
        open_ = w != 0
    used = np.flatnonzero(w)
    return Model(vocabulary[chosen][used], w[used], t)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """The model from at most per_class labelled rows of each class; labels has doc_id and toxic 0 or 1."""
    return fit(sample(docs, labels, per_class))


def grade(docs: DataFrame, model: Model, flag: float = FLAG, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, severity, expected_severity, p_toxic, toxic) for every row of docs.

    severity: the most probable grade; expected_severity: the mean grade; p_toxic: P(grade > 0); toxic:
    p_toxic >= flag. A null or empty text has no features, and so the grade of the prior. Ids may be null or
    repeated; other columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the words that the L1 penalty left of a bounded sample

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text"):
            more = above(shared.value.thresholds, scores(shared.value, texts))
            each = -np.diff(np.concatenate((np.ones((len(texts), 1)), more, np.zeros((len(texts), 1))), axis=1), axis=1)
            columns = [batch.column("id"), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(more.sum(axis=1).round(6)), pa.array(more[:, 0].round(6)), pa.array(more[:, 0] >= flag)]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "severity", "expected_severity", "p_toxic", "toxic"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, severity int, expected_severity double, p_toxic double, toxic boolean")
