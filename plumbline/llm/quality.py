"""Quality rules: hashed word and character n-gram logistic regression with calibrated probabilities.

The model is fitted on the driver to a bounded sample of labelled rows; its features, from whole texts,
come from the executors. Probabilities are calibrated on a part of the sample that the fit does not see.
Scoring runs in Arrow batches, with fixed thresholds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import within
from plumbline.llm.textcore import _SPACE, CHUNK, char_grams, chunks, code_points, mix, pieces, ragged_sum, word_hashes

#: Each of the two families of features has 2**BITS weights.
BITS = 16
#: Labelled rows of each class that the model is fitted to, at most, by the hash of their id.
PER_CLASS = 600
#: Features that the labelled rows of a class give to the fit, at most, by an upper bound of each text's: further rows are not in the sample.
CLASS_FEATURES = 10 << 20
#: Characters of the character n-grams.
CHARS = (3, 4)
#: Feature values are shares of a text, so they are scaled for the fit.
SCALE = 30.0
#: Smallest calibrated probability of good quality that is kept.
KEEP = 0.5

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True


@dataclass(frozen=True)
class Model:
    words: np.ndarray
    chars: np.ndarray
    bias: float
    slope: float  # of the calibration
    shift: float


def _features(texts: list[bytes]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Feature numbers of words and of characters of the texts, one text after the other, and how many each text has."""
    hashes, counts = word_hashes(texts)
    pairs = mix(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) else hashes
    doc = np.repeat(np.arange(len(counts)), counts)
    inside = doc[1:] == doc[:-1]
    order = np.argsort(np.concatenate((doc, doc[1:][inside])), kind="stable")
    words = (np.concatenate((hashes, pairs[inside])) >> np.uint64(64 - BITS)).astype(np.int32)[order]
    n_words = counts + np.maximum(counts - 1, 0)
    parts, n_chars = [], np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        data = code_points(t)
        for n in CHARS:
            got = char_grams(data, n, BITS)
            parts.append(got)
            n_chars[i] += len(got)
    return (words, n_words), (np.concatenate(parts) if parts else np.zeros(0, np.int32), n_chars)


def _blocks(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The feature numbers of one text, words and characters, in blocks of bounded size; together they are those of _features()."""
    last = np.zeros(0, dtype=np.uint64)
    for part in pieces(text):
        own = np.concatenate((last, word_hashes([part])[0]))
        pairs = mix(own[:-1] * np.uint64(3) + own[1:]) if len(own) else own
        yield (np.concatenate((own[len(last) :], pairs)) >> np.uint64(64 - BITS)).astype(np.int32), np.zeros(0, dtype=np.int32)
        last = own[-1:]
    last = np.zeros(0, dtype=np.uint32)
    for lo in range(0, len(text), CHUNK):
        data = np.concatenate((last, code_points(text, lo, lo + CHUNK)))
        for n in CHARS:  # those that end in this part
            yield np.zeros(0, dtype=np.int32), char_grams(data[max(0, len(last) - n + 1) :], n, BITS)
        last = data[max(0, len(data) - max(CHARS) + 1) :]


def raw_scores(model: Model, texts: list[bytes]) -> np.ndarray:
    """The model's score before calibration; a text without features scores the bias."""
    out = np.full(len(texts), model.bias)
    if sum(map(len, texts)) > 2 * CHUNK:
        for i, t in enumerate(texts):
            sums, counts = np.zeros(2), np.zeros(2)
            for block in _blocks(t):
                for k, (weights, at) in enumerate(zip((model.words, model.chars), block, strict=True)):
                    sums[k] += weights[at].sum(dtype=np.float64)
                    counts[k] += len(at)
            out[i] += SCALE * (sums / np.maximum(counts, 1)).sum()
        return out
    for weights, (at, counts) in zip((model.words, model.chars), _features(texts), strict=True):
        out += SCALE * ragged_sum(weights[at].astype(np.float64), counts) / np.maximum(counts, 1)
    return out


def probabilities(model: Model, texts: list[bytes]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.slope * raw_scores(model, texts) + model.shift, -500, 500)))


def sample_features(docs: DataFrame, labels: DataFrame, label: str, per_class: int = PER_CLASS) -> list:
    """Rows (y, words, chars) of the sample: feature numbers with counts, from whole texts."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    rows = within(docs, known, per_class, CLASS_FEATURES, lambda size: F.least(3 * size, F.lit(2 << BITS)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text"):
            columns = [[], [], [], []]
            for t in texts:
                every = np.zeros((2, 1 << BITS), dtype=np.int64)
                for block in _blocks(t):
                    for k, at in enumerate(block):
                        every[k] += np.bincount(at, minlength=1 << BITS)
                for k in (0, 1):
                    numbers = np.flatnonzero(every[k])
                    times = every[k][numbers]
                    columns[2 * k].append(numbers.astype("<i4").tobytes())
                    columns[2 * k + 1].append(times.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), *(pa.array(c, pa.binary()) for c in columns)], names=["doc_id", "y", "w", "wn", "c", "cn"])

    got = rows.mapInArrow(run, "doc_id long, y int, w binary, wn binary, c binary, cn binary").collect()
    return sorted(got, key=lambda r: r["doc_id"])


def fit(rows: list, share: float, steps: int = 80) -> Model:
    """The model of a sample in which the classes are evened out; share: of class 1 among all labels. Empties rows, to save memory."""
    y = np.array([r["y"] for r in rows], dtype=np.float64)
    size = 1 << BITS
    if len(set(y.tolist())) < 2:  # nothing to tell apart: keep or drop all alike
        bias = 0.0 if not len(y) else 20.0 * (2 * y[0] - 1)
        return Model(np.zeros(size, np.float32), np.zeros(size, np.float32), bias if len(y) else 20.0, 1.0, 0.0)
    # The rows that calibrate come last, so that those that fit are the front of every array.
    order = np.argsort(np.arange(len(y)) % 4 == 3, kind="stable")
    y, front = y[order], int((np.arange(len(y)) % 4 != 3).sum())
    counts = [len(rows[i]["w"]) // 4 + len(rows[i]["c"]) // 4 for i in order]
    column, value = np.empty(sum(counts), dtype=np.int32), np.empty(sum(counts), dtype=np.float32)
    at = 0
    for i in order:
        for k, (where, n) in enumerate((("w", "wn"), ("c", "cn"))):
            times = np.frombuffer(rows[i][n], "<i4").astype(np.float32)
            column[at : at + len(times)] = np.frombuffer(rows[i][where], "<i4") + k * size
            value[at : at + len(times)] = SCALE * times / max(1.0, float(times.sum()))
            at += len(times)
    row = np.repeat(np.arange(len(y), dtype=np.int32), counts)
    rows.clear()
    fitted = slice(0, sum(counts[:front]))
    y_fit = y[:front]
    even = np.where(y_fit == 1, 0.5 / max(1, y_fit.sum()), 0.5 / max(1, (1 - y_fit).sum()))
    w, bias = np.zeros(2 * size, dtype=np.float32), 0.0
    squares, bias_squares = np.full(2 * size, 1e-6), 1e-6
    for _ in range(steps):  # full batches with steps scaled by feature
        z = np.bincount(row[fitted], w[column[fitted]] * value[fitted], front) + bias
        g = ((1 / (1 + np.exp(-np.clip(z, -500, 500))) - y_fit) * even).astype(np.float32)
        slope = np.bincount(column[fitted], g[row[fitted]] * value[fitted], 2 * size) + 1e-5 * w
        squares += slope**2
        bias_squares += float(g.sum()) ** 2
        w -= (0.3 * slope / np.sqrt(squares)).astype(np.float32)
        bias -= 0.3 * float(g.sum()) / np.sqrt(bias_squares)
    z = np.bincount(row, w[column] * value, len(y)) + bias
    on = np.arange(len(y)) >= front if len(set(y[front:].tolist())) == 2 else np.ones(len(y), dtype=bool)
    weight = np.where(y == 1, share / max(1, y[on].sum()), (1 - share) / max(1, (1 - y[on]).sum())) * on
    a, b = calibrate(z, y, weight)
    return Model(w[:size].copy(), w[size:].copy(), float(bias), a, b)


def calibrate(z: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (z, y) by Newton's method, with steps that never raise the loss.

    Rows of weight 0 take no part. Targets are those of Platt, (n + 1) / (n + 2) and 1 / (n + 2), so that classes
    which the scores tell apart wholly get probabilities as sure as their numbers of rows allow.
    """
    on = weight > 0
    z, y, weight = z[on], y[on], weight[on] / weight[on].sum()
    ones, zeros = int((y == 1).sum()), int((y == 0).sum())
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    size = float(np.abs(z).max()) or 1.0
    z = z / size

    def loss(at: np.ndarray) -> float:
        t = at[0] * z + at[1]
        return float((weight * (np.logaddexp(0, t) - target * t)).sum())

    at = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(at[0] * z + at[1], -500, 500)))
        r, h = weight * (p - target), weight * p * (1 - p) + 1e-12
        hess = np.array([[(h * z * z).sum() + 1e-9, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-9]])
        step = np.linalg.solve(hess, np.array([(r * z).sum(), r.sum()]))
        now, share = loss(at), 1.0
        while share > 1e-6 and loss(at - share * step) > now:
            share /= 2
        at = at - share * step
        if np.abs(share * step).max() < 1e-9 or share <= 1e-6:
            break
    return max(1e-3, float(at[0]) / size), float(at[1])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """The model of P(label = 1), from at most per_class labelled rows of each class."""
    ones = labels.where(F.col(label).isNotNull()).agg(F.avg(F.col(label)).alias("share")).first()["share"]
    return fit(sample_features(docs, labels, label, per_class), 0.5 if ones is None else float(ones))


def base_features(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Counts of each text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    n = len(texts)
    known: dict[bytes, int] = {}
    give = known.setdefault
    ids, counts = [np.zeros(0, dtype=np.int64)], np.zeros(n, dtype=np.int64)
    chars, symbols, lines = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for i, t in enumerate(texts):
        for part in pieces(t):
            data = np.frombuffer(part, dtype=np.uint8)
            chars[i] += np.count_nonzero(~_SPACE[data] & ((data & 0xC0) != 0x80))
            symbols[i] += np.count_nonzero(_SYMBOL[data])
            words = part.split()
            counts[i] += len(words)
            ids.append(np.fromiter([give(w, len(known)) for w in words], np.int64, len(words)))
        own = [x for x in t.split(b"\n") if x.strip()]
        lines[i] = len(own) - len(set(own))
    # Words are known by numbers of their own, so windows are equal only if their words are.
    words, doc = np.concatenate(ids), np.repeat(np.arange(n), counts)
    at = np.flatnonzero(doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, dtype=np.int64)
    window = _numbered([(doc[at], n), *((words[at + k], len(known)) for k in range(3))])
    by = np.argsort(window, kind="stable")
    same = window[by][1:] == window[by][:-1]
    twice = np.zeros(len(by), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[at[by[twice]] + k] = True
    return {"n_words": counts, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines, "n_repeat_words": ragged_sum(covered.astype(np.int64), counts)}


def _numbered(columns: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """One number for each row of the columns, the same for the same values; with each column the bound of its values."""
    out, most = columns[0]
    for values, bound in columns[1:]:
        if most * bound >= 1 << 62:
            out = np.unique(out, return_inverse=True)[1]
            most = len(out)
        out, most = out * bound + values, most * max(1, bound)
    return out


def judge(docs: DataFrame, model: Model, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability, kept) for every row.

    base_failed: under 50 words, or over half of the words in three-word windows found twice. kept: not
    base_failed and a calibrated probability of at least keep. A null text counts as empty, and fails. Ids
    may be null or repeated; other columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 * 2**BITS weights, whatever the input
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text"):
            base = base_features(texts)
            failed = (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
            p = probabilities(shared.value, texts)
            columns = [batch.column("id"), *(pa.array(base[c], pa.int64()) for c in counts), pa.array(failed), pa.array(p), pa.array(~failed & (p >= keep))]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, *counts, "base_failed", "probability", "kept"])

    schema = f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in counts) + ", base_failed boolean, probability double, kept boolean"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Model, keep: float = KEEP, text_col: str = "text") -> DataFrame:
    """The rows of docs that judge() keeps, all columns unchanged, whatever their names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = pa.RecordBatch.from_arrays(batch.columns, names=[f"c{i}" for i in range(len(batch.columns))])
            for part, texts in chunks([named], f"c{place}"):
                base = base_features(texts)
                failed = (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
                kept = part.filter(pa.array(~failed & (probabilities(shared.value, texts) >= keep)))
                yield pa.RecordBatch.from_arrays(kept.columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
