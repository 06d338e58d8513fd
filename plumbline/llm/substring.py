"""Exact substring deduplication by prefix-partitioned suffix trees over words.

The suffixes of a document start at its words and are read to depth ``window``. They are dealt by a
prefix: the ``gram`` words at the anchor of their window, which is the run of that many words with the
smallest hash. Neighbouring suffixes mostly have one anchor, so they travel as one row of words; equal
suffixes have equal anchors at equal places. Prefixes of one document only lead to no deep internal node,
and their suffixes never leave it.

Prefixes vary in length. One whose suffixes fit a group of GROUP_BYTES gets a subtree: its suffixes are
ordered by prefix doubling over the words themselves, exactly, and those of one rank at depth ``window``
hang below one internal node. A prefix of more suffixes is lengthened to all ``window`` words, told by a
128-bit BLAKE2 digest of them: such a group is a deep node itself, of which only the smallest document
matters, so the suffixes of one node are merged where they are read, before they are dealt. The smallest
document below a node keeps its words, all others lose them. Runs of deep suffixes are maximal repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.textcore import _SPACE, binary, chunks, gram_hashes, sliding_min, span_hashes, word_spans

GRAM = 10
#: Bytes of words below a prefix from which it is lengthened.
GROUP_BYTES = 1 << 18
#: Bytes of text within which suffixes of one node are merged before they are sent on.
LOCAL = 4 << 20
#: Bytes of words that are ordered at once; groups stay whole.
SORTED = 4 << 20


def _normal(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of the texts, each followed by one space, as bytes; the words' starts and ends there; number of words by text."""
    data = np.frombuffer(b"".join([x for t in texts for x in (t, b"\n")]), dtype=np.uint8)
    inside = ~_SPACE[data]
    first, _ = word_spans(data)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    counts = np.diff(np.searchsorted(first, offsets))
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    data = np.where(inside, data, np.uint8(32))[keep]
    starts, ends = word_spans(data)
    return data, starts, ends, counts


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Positions where any of the columns changes, 0 included."""
    change = np.zeros(len(columns[0]), dtype=bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


class _Suffixes:
    """The suffixes of some texts, in runs of neighbours with one prefix: doc, start, n and prefix of each run."""

    def __init__(self, texts: list[bytes], window: int, gram: int) -> None:
        self.data, self.starts, self.ends, counts = _normal(texts)
        self.window = window
        each = np.maximum(counts - window + 1, 0)
        doc = np.repeat(np.arange(len(counts)), each)
        self.offsets = np.cumsum(counts) - counts
        start = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
        hashes = span_hashes(self.data, self.starts, self.ends)
        prefix = sliding_min(gram_hashes(hashes, gram), window - gram + 1)[start + self.offsets[doc]] if len(doc) else np.zeros(0, np.uint64)
        at = _runs(doc, prefix)
        self.doc, self.start, self.prefix = doc[at], start[at], prefix[at].view(np.int64)
        self.n = np.diff(np.append(at, len(doc)))
        first = self.start + self.offsets[self.doc]
        self.lo = self.starts[first] if len(first) else first
        self.hi = self.ends[first + self.n + window - 2] if len(first) else first

    def words(self, run: int) -> bytes:
        """The words of a run, by single spaces."""
        return self.data[self.lo[run] : self.hi[run]].tobytes()

    def nodes(self, run: int) -> list[bytes]:
        """A digest of the window words of each suffix of a run."""
        first = int(self.start[run] + self.offsets[self.doc[run]])
        own, n, w = self.words(run), int(self.n[run]), self.window
        lo = (self.starts[first : first + n] - self.lo[run]).tolist()
        hi = (self.ends[first + w - 1 : first + w - 1 + n] - self.lo[run]).tolist()
        return [hashlib.blake2b(own[a:b], digest_size=16).digest() for a, b in zip(lo, hi, strict=True)]


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = GRAM, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(id_col, text_hash, spans array<struct<start int, length int>>): the maximal repeats of each document with some.

    A span covers the words of runs of window words that also start in a document with a smaller id.
    Rows with a null id take no part. text_hash (xxhash64 of the text) tells rows with one id apart;
    rows equal in both share one result. Nulls and texts shorter than the window have no spans.
    """
    rows = docs.select(*_keys(F.col(id_col), F.col(text_col)), F.col(text_col).alias("text"))
    found = _repeats(rows, docs.where(F.col(id_col).isNotNull()).select(*_keys(F.col(id_col), F.col(text_col)), F.col(text_col).alias("text")), "text", window, gram, group_bytes)
    return found.select(F.col("_key").alias(id_col), F.col("_hash").alias("text_hash"), F.col("_spans").alias("spans"))


def _keys(id_: Column, text: Column) -> list[Column]:
    """What tells rows apart, without nulls; a row with a null id has a hash that no other row's text gives it."""
    key = id_.cast("long")
    return [F.coalesce(key, F.lit(0)).alias("_key"), F.when(key.isNull(), F.xxhash64(F.lit("no id"), text)).otherwise(F.xxhash64(text)).alias("_hash")]


def _repeats(rows: DataFrame, known: DataFrame, text: str, window: int, gram: int, group_bytes: int) -> DataFrame:
    """(_key, _hash, _spans) of the rows; known: _key, _hash and text of those that have an id.

    rows are read with all their columns, so that a later join of them by the same keys shares the shuffle.
    """

    def prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text", LOCAL):
            found = _Suffixes(texts, window, gram)
            doc = pa.array(found.doc)
            columns = [pa.array(found.prefix), batch.column("_key").take(doc), batch.column("_hash").take(doc), pa.array((found.hi - found.lo).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["prefix", "_key", "_hash", "bytes"])

    seen = known.select("_key", "_hash", F.col(text).alias("text")).mapInArrow(prefixes, "prefix long, _key long, _hash long, bytes long")
    shared = seen.groupBy("prefix").agg(F.min("_key").alias("lo"), F.max("_key").alias("hi"), F.sum("bytes").alias("bytes")).where("lo < hi").select("prefix", (F.col("bytes") > group_bytes).alias("long"))
    # A set of each text's own prefixes, however often its row is repeated.
    own = seen.join(shared, "prefix").groupBy("_key", "_hash").agg(F.collect_set(F.struct("prefix", "long")).alias("_prefixes"))
    place = rows.columns.index(text)

    def suffixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = (pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2 + place), b.column(len(b.columns) - 1)], names=["_key", "_hash", "text", "_prefixes"]) for b in batches)
        last = None
        for batch, texts in chunks(named, "text", LOCAL):
            keys = list(zip(batch.column("_key").to_pylist(), batch.column("_hash").to_pylist(), strict=True))
            fresh = [i for i, k in enumerate(keys) if k != (keys[i - 1] if i else last)]  # repeated rows stand together
            last = keys[-1]
            if fresh:
                yield _candidates(batch.take(pa.array(fresh)), [texts[i] for i in fresh], window, gram)

    joined = rows.join(own, ["_key", "_hash"]).select("_key", "_hash", *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rows.columns)], "_prefixes")
    sent = joined.mapInArrow(suffixes, "key long, node binary, id long, text_hash long, start int, n int, which binary, words binary")

    def subtrees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _subtrees(batches, window)

    deep = sent.repartition("key").sortWithinPartitions("key", "node", "id").mapInArrow(subtrees, "id long, text_hash long, start int, n int, which binary")
    found = deep.groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", "n", "which")).alias("parts"))

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [_spans(parts, window) for parts in batch.column("parts").to_pylist()]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), pa.array(spans, kind)], names=["_key", "_hash", "_spans"])

    return found.mapInArrow(merge, "_key long, _hash long, _spans array<struct<start:int,length:int>>")


_SENT = [("key", pa.int64()), ("node", pa.binary()), ("id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("which", pa.binary()), ("words", pa.binary())]
_ALL = b""  # which: all of a row's suffixes


def _candidates(batch: pa.RecordBatch, texts: list[bytes], window: int, gram: int) -> pa.RecordBatch:
    """The suffixes of the texts whose prefix is shared, ready to be dealt.

    A row is a run of neighbours with its words; or a suffix of a lengthened prefix with its node, and the text's
    places of it for words. What is settled here, as a document of this chunk with a smaller id has the same, goes
    on as rows with neither.
    """
    found = _Suffixes(texts, window, gram)
    ids, hashes = batch.column("_key").to_pylist(), batch.column("_hash").to_pylist()
    shared, lengthen = np.zeros(len(found.doc), dtype=bool), np.zeros(len(found.doc), dtype=bool)
    edges = np.searchsorted(found.doc, np.arange(len(texts) + 1))
    lists = batch.column("_prefixes")
    for i in range(len(texts)):
        own = slice(edges[i], edges[i + 1])
        if own.start == own.stop:
            continue
        values = lists[i].values
        prefix = values.field("prefix").to_numpy()
        order = np.argsort(prefix)
        at = np.minimum(np.searchsorted(prefix[order], found.prefix[own]), len(order) - 1)
        shared[own] = prefix[order[at]] == found.prefix[own]
        lengthen[own] = values.field("long").to_numpy(zero_copy_only=False)[order[at]]
    doc, start, n, prefix = (x.tolist() for x in (found.doc, found.start, found.n, found.prefix))
    out: list[tuple] = []
    low: dict[bytes, int] = {}
    runs, suffixes = [], []
    for r in np.flatnonzero(shared).tolist():
        id_ = ids[doc[r]]
        if lengthen[r]:
            nodes = found.nodes(r)
            suffixes.append((r, nodes))
            for node in nodes:
                if low.get(node, id_) >= id_:
                    low[node] = id_
        else:
            words = found.words(r)
            runs.append((r, words))
            if low.get(words, id_) >= id_:
                low[words] = id_
    for r, words in runs:
        head = (ids[doc[r]], hashes[doc[r]], start[r], n[r], _ALL)
        out.append((prefix[r], b"", *head, words) if low[words] == head[0] else (head[0] ^ head[1], b"", *head, b""))
    places: dict[tuple[int, bytes], list[int]] = {}
    for r, nodes in suffixes:
        id_ = ids[doc[r]]
        settled = np.array([low[node] < id_ for node in nodes])
        if settled.any():
            out.append((id_ ^ hashes[doc[r]], b"", id_, hashes[doc[r]], start[r], n[r], np.packbits(settled).tobytes(), b""))
        for k in np.flatnonzero(~settled).tolist():
            places.setdefault((doc[r], nodes[k]), []).append(start[r] + k)
    for (i, node), starts in places.items():  # once for each text, however often it has the suffix
        out.append((int.from_bytes(node[:8], "little", signed=True), node, ids[i], hashes[i], starts[0], 1, _ALL, np.array(starts, dtype="<i4").tobytes()))
    columns = list(zip(*out, strict=True)) or [[]] * len(_SENT)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, _SENT, strict=True)], names=[k for k, _ in _SENT])


def _rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The rank of each pair among the different pairs, in order."""
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def _order(words: np.ndarray, depth: int) -> np.ndarray:
    """The rank of every suffix by its first words to the depth, by prefix doubling; the last ones have none."""
    have, width = words, 1
    while 2 * width <= depth:
        have = _rank(have[:-width], have[width:])
        width *= 2
    rest = depth - width
    return _rank(have[: len(have) - rest], have[rest:]) if rest else have


_FOUND = ["id", "text_hash", "start", "n", "which"]


def _subtrees(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The deep suffixes of each group that do not belong to the smallest document below their node."""
    held: list[pa.RecordBatch] = []
    size, node, least = 0, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes, words = batch.column("node").to_pylist(), batch.column("words")
        alone = np.array([len(x) > 0 for x in nodes])
        ids = batch.column("id").to_numpy()
        bare = pa.compute.equal(pa.compute.binary_length(words), 0).to_numpy(zero_copy_only=False) & ~alone
        settled = bare.copy()
        # Suffixes of one node come in order of id: the first has the smallest, whatever their number.
        for i in np.flatnonzero(alone).tolist():
            if nodes[i] != node:
                node, least = nodes[i], ids[i]
            settled[i] = ids[i] > least
        if (settled & bare).any():
            yield _all_bits(batch.filter(pa.array(settled & bare)).select(_FOUND))
        if (settled & alone).any():
            yield _each_place(batch.filter(pa.array(settled & alone)))
        runs = batch.filter(pa.array(~alone & ~bare))
        if runs.num_rows:
            held.append(runs)
            size += runs.nbytes
        if size > SORTED:
            whole = pa.Table.from_batches(held).combine_chunks()
            key = whole.column("key").to_numpy()
            cut = int(np.searchsorted(key != key[-1], False)) if key[0] != key[-1] else 0
            if cut:
                yield _subtree(whole.slice(0, cut).combine_chunks(), window)
                held = whole.slice(cut).combine_chunks().to_batches()
                size = sum(b.nbytes for b in held)
    if held:
        yield _subtree(pa.Table.from_batches(held).combine_chunks(), window)


def _all_bits(found: pa.RecordBatch) -> pa.RecordBatch:
    which = [w or np.packbits(np.ones(n, dtype=bool)).tobytes() for w, n in zip(found.column("which").to_pylist(), found.column("n").to_pylist(), strict=True)]
    return pa.RecordBatch.from_arrays([*found.columns[:4], pa.array(which, pa.binary())], names=_FOUND)


def _each_place(found: pa.RecordBatch) -> pa.RecordBatch:
    places = binary(found.column("words"))
    row = pa.array(np.repeat(np.arange(len(places)), [len(p) // 4 for p in places]))
    starts = np.frombuffer(b"".join(places), dtype="<i4")
    columns = [found.column("id").take(row), found.column("text_hash").take(row), pa.array(starts), pa.array(np.ones(len(starts), dtype=np.int32)), pa.array([b"\x80"] * len(starts), pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=_FOUND)


def _subtree(table: pa.Table, window: int) -> pa.RecordBatch:
    """The suffixes of whole groups in order: those of one rank to the depth of the window hang below one node."""
    ids, n = table.column("id").to_numpy(), table.column("n").to_numpy()
    words = pa.array(b" ".join(binary(table.column("words").chunk(0))).split(b" "), pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    rank = _order(words, window)
    first = np.cumsum(n + window - 1) - (n + window - 1)
    row = np.repeat(np.arange(len(n)), n)
    node = rank[np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]
    least = np.full(int(rank.max(initial=0)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, node, ids[row])
    deep = ids[row] > least[node]
    ends = np.cumsum(n)
    kept = np.flatnonzero(np.bincount(row[deep], minlength=len(n)))
    bits = [np.packbits(deep[ends[i] - n[i] : ends[i]]).tobytes() for i in kept.tolist()]
    got = table.select(_FOUND[:4]).take(pa.array(kept, pa.int64())).combine_chunks()
    columns = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in got.columns]
    return pa.RecordBatch.from_arrays([*columns, pa.array(bits, pa.binary())], names=_FOUND)


def _spans(parts: list[dict], window: int) -> list[dict]:
    at = np.unique(np.concatenate([np.flatnonzero(np.unpackbits(np.frombuffer(p["which"], np.uint8), count=p["n"])) + p["start"] for p in parts]))
    if not len(at):
        return []
    edge = np.flatnonzero(np.concatenate(([True], np.diff(at) > window)))
    last = np.concatenate((edge[1:], [len(at)])) - 1
    return [{"start": a, "length": b - a + window} for a, b in zip(at[edge].tolist(), at[last].tolist(), strict=True)]


def _with_spans(docs: DataFrame, id_col: str, text_col: str, window: int, gram: int, group_bytes: int) -> DataFrame:
    """docs, its columns named c0, c1, ... whatever they were, with _spans.

    Texts are dealt by their keys once, for the search and for this join.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*_keys(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    known = rows.where(F.col(names[id_col]).isNotNull())
    spans = _repeats(rows, known, names[text_col], window, gram, group_bytes)
    return rows.join(spans, ["_key", "_hash"], "left").select(*names.values(), "_spans")


def _cut(text: bytes, spans: list[dict]) -> tuple[list[bytes], list[bytes]]:
    """All words of the text, and those that no span covers."""
    words = text.split()
    kept, at = [], 0
    for s in spans:
        kept += words[at : s["start"]]
        at = s["start"] + s["length"]
    return words, kept + words[at:]


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = GRAM, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row for each row of docs: id_col, n_words, n_removed, kept string (the words left, joined by one space).

    See repeated_words(); a row with a null id loses nothing, and a null text counts as no words.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = _with_spans(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text", window, gram, group_bytes).toDF("id", "text", "_spans")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text", LOCAL):
            words, removed, left = [], [], []
            for text, spans in zip(texts, batch.column("_spans").to_pylist(), strict=True):
                have, kept = _cut(text, spans or [])
                words.append(len(have))
                removed.append(len(have) - len(kept))
                left.append(b" ".join(kept))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(left, pa.binary()).cast(pa.string())], names=[id_col, "n_words", "n_removed", "kept"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_removed long, kept string")


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = GRAM, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """docs with the words of repeats cut from the texts that have some; other texts stay as they are, to the byte.

    All rows and columns stay; a text that consists of repeats becomes empty.
    """
    rows = _with_spans(docs, id_col, text_col, window, gram, group_bytes)
    docs_columns = list(docs.columns)
    texts = docs_columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, spans = batch.column(texts).to_pylist(), batch.column(len(batch.columns) - 1).to_pylist()
            got = [b" ".join(_cut(t.encode(), s)[1]).decode() if s else t for t, s in zip(column, spans, strict=True)]
            columns = list(batch.columns[:-1])
            columns[texts] = pa.array(got, batch.column(texts).type)
            yield pa.RecordBatch.from_arrays(columns, names=docs_columns)

    return rows.mapInArrow(run, docs.schema)
