"""Mining collocations by contiguous pattern growth over projected occurrence pointers.

Phrases are grown to the right, prefix by prefix, as PrefixSpan does, but without gaps. The first two
levels are counted where the texts are read and summed by key. Every frequent pair of words is then a
prefix: each of its occurrences that goes on with frequent pairs is projected to the words that follow,
equal ones of a chunk of text as one pointer with its number. The pointers of a prefix meet in one task,
which extends it word by word, depth first, and follows only extensions that are frequent themselves. A
prefix with many occurrences is lengthened by its next word first, so its pointers are dealt to many tasks.

Bitmaps of fixed size say in every task which words and pairs may be frequent. Pairs are first counted by a
hash, and by their words only where that count is high enough. A bit that is set by chance costs a few
rows and changes no count, as counts are of the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import cut
from plumbline.llm.textcore import _join, binary, mix, ragged_sum, span_hashes, word_spans

#: Words of a phrase at most, and occurrences at least.
LONGEST, LEAST = 4, 30
#: Phrases of each language that are returned.
FIRST = 2000
#: Percentage of a phrase's occurrences inside one longer phrase from which it goes.
INSIDE = 80
#: Bytes of text whose equal words, pairs and pointers are counted together before they are sent on.
CHUNK = 4 << 20
#: Bits of a bitmap of frequent words or pairs, whatever their number.
BITS = 27
#: Bits of the hashes by which pairs are counted first.
FINE = 40
#: A key is hot from this part of all words on, so at most as many words, pairs or triples are.
PARTS = 1 << 14
#: Parts in which the best phrases of a language are looked for first.
SALTS = 64
#: Words of the texts for each task that extends prefixes.
TASK_WORDS = 16 << 20
#: Language of texts without one.
UNKNOWN = "und"

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SCALE = 2_000_000
#: What a task's pointers are grouped by.
_KEY = ("lang", "prefix", "deal")


class _Chunk:
    """Words of texts of one language: their numbers in the order of the text, and the names of the numbers."""

    def __init__(self, lang: str, texts: list[bytes]) -> None:
        self.lang = lang
        data = _LOWER[np.frombuffer(b"\n".join(texts), dtype=np.uint8)]
        kind = _KIND[data]
        inside = kind == 0
        edge = np.diff(np.concatenate(([False], inside, [False])).view(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.zeros(len(starts) + 1, dtype=np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))])
        coded = words.dictionary_encode()
        self.ids, self.names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        #: For each word, whether the next one stands in the same piece.
        breaks = np.concatenate(([0], np.cumsum(kind == 2)))
        self.goes_on = np.zeros(len(starts), dtype=bool)
        if len(starts):
            self.goes_on[:-1] = breaks[starts[1:]] == breaks[starts[:-1]]

    def hashes(self) -> np.ndarray:
        offsets = np.frombuffer(self.names.buffers()[1], dtype=np.int64)[: len(self.names) + 1]
        data = np.frombuffer(self.names.buffers()[2] or b"", dtype=np.uint8)
        return _keyed(span_hashes(data, offsets[:-1], offsets[1:]), self.lang)

    def strings(self, ids: np.ndarray) -> pa.Array:
        return self.names.take(pa.array(ids)).cast(pa.binary()).cast(pa.string())


def _keyed(hashes: np.ndarray, lang: str) -> np.ndarray:
    own = np.frombuffer(lang.encode(), dtype=np.uint8)
    return mix(hashes ^ span_hashes(own, np.zeros(1, dtype=np.int64), np.array([len(own)]))[0])


def _chunked(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[_Chunk]:
    """The texts by language, in chunks of about limit bytes; a longer text is cut where a piece ends."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), binary(batch.column("text")), strict=True):
            at, text = 0, text or b""
            while at < len(text):
                end = at + limit
                if end < len(text):
                    end = max((text.rfind(c, at, end) + 1 for c in (b"\n", b".", b",", b";", b":", b"!", b"?", b"\r", b"\x0b", b"\x0c")))
                    if end <= at:
                        later = [x + 1 for c in b"\n.,;:!?\r\x0b\x0c" if (x := text.find(c, at + limit)) >= 0]
                        end = min(later, default=len(text))
                held.setdefault(lang, []).append(text[at:end])
                size += min(end, len(text)) - at
                at = end
                if size >= limit:
                    yield from (_Chunk(k, v) for k, v in held.items())
                    held, size = {}, 0
    yield from (_Chunk(k, v) for k, v in held.items())


def _batch(lang: str, columns: dict[str, pa.Array], n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), *columns.values(), pa.array(n, pa.int64())], names=["lang", *columns, "n"])


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of the hashes of (lang, phrase): set in tasks, and 64 of them a row here, so at most 2**(BITS - 6) rows."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [_place(k, p.encode()) for k, p in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64())], names=["at"])

    return _bits(keys.select("lang", "phrase").mapInArrow(places, "at long"))


def _bits(places: DataFrame) -> np.ndarray:
    words = places.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), dtype=np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def _hash(lang: str, phrase: bytes) -> int:
    """The hash of one word, or of a pair of words."""
    data = np.frombuffer(phrase, dtype=np.uint8)
    at = np.concatenate(([0], np.flatnonzero(data == 0x20) + 1))
    own = _keyed(span_hashes(data, at, np.concatenate((at[1:] - 1, [len(data)]))), lang)
    for h in own[1:]:
        own[:1] = _join(own[:1], h)
    return int(own[0])


def _place(lang: str, phrase: bytes) -> int:
    return _hash(lang, phrase) >> (64 - BITS)


def _set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - BITS)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, and how often each is there, or the sum of its weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
    counts = np.diff(np.concatenate((first, [len(keys)])))
    return keys[first], counts if weights is None else ragged_sum(weights[order], counts)


def words_of(texts: DataFrame) -> DataFrame:
    """(lang, phrase, f): occurrences of every word of (lang, text), and under a null phrase those of all words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _chunked(batches, CHUNK):
            n = np.bincount(c.ids, minlength=len(c.names))
            yield _batch(c.lang, {"phrase": pa.concat_arrays([c.strings(np.arange(len(c.names))), pa.array([None], pa.string())])}, np.append(n, len(c.ids)))

    return texts.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def _neighbours(c: _Chunk, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers and hashes of the different pairs of neighbours that both may be frequent, and how often each is there."""
    own = c.hashes()
    often = _set(words, own)[c.ids]
    at = np.flatnonzero(c.goes_on & often & np.append(often[1:], False))
    pair, n = _counted(c.ids[at] * len(c.names) + c.ids[np.minimum(at + 1, len(c.ids) - 1)])
    return pair, _join(own[pair // max(1, len(c.names))], own[pair % max(1, len(c.names))]), n


def _pairs(texts: DataFrame, words, least: int) -> DataFrame:  # noqa: ANN001  a broadcast bitmap
    """(lang, phrase, f) of the frequent pairs of neighbours."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _chunked(batches, CHUNK):
            _, hashes, n = _neighbours(c, words.value)
            yield pa.RecordBatch.from_arrays([pa.array((hashes >> np.uint64(64 - FINE)).astype(np.int64)), pa.array(n, pa.int64())], names=["at", "n"])

    fine = texts.mapInArrow(hashed, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    likely = texts.sparkSession.sparkContext.broadcast(_bits(fine.select(F.shiftright("at", FINE - BITS).alias("at"))))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _chunked(batches, CHUNK):
            pair, hashes, n = _neighbours(c, words.value)
            there = _set(likely.value, hashes)
            pair, n = pair[there], n[there]
            for lo in range(0, len(pair), 1 << 16):
                own = pair[lo : lo + (1 << 16)]
                yield _batch(c.lang, {"phrase": _spaced(c.strings(own // len(c.names)), c.strings(own % len(c.names)))}, n[lo : lo + (1 << 16)])

    counted = texts.mapInArrow(named, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    return counted.where(F.col("f") >= least)


def _spaced(*parts: pa.Array) -> pa.Array:
    import pyarrow.compute as pc

    return pc.binary_join_element_wise(*parts, " ")


def _pointers(texts: DataFrame, pairs, hot) -> DataFrame:  # noqa: ANN001  a broadcast bitmap, and the hashes of hot pairs
    """(lang, prefix, third, fourth, n, deal): what follows the frequent pairs, as far as it is made of frequent pairs.

    fourth is null where the run of frequent pairs ends; deal is the third word where the prefix is hot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _chunked(batches, CHUNK):
            if len(c.ids) < 3:
                continue
            own = c.hashes()[c.ids]
            pair = _join(own[:-1], own[1:])
            often = np.append(c.goes_on[:-1] & _set(pairs.value, pair), [False] * 3)  # a pair starts here
            at = np.flatnonzero(often[:-1] & often[1:])
            ids = np.append(c.ids, [0, 0, 0])
            full = often[at + 2]
            size = len(c.names) + 1
            # Two numbers of two words each; 0 stands for no fourth word.
            first, second = ids[at] * size + ids[at + 1], ids[at + 2] * size + np.where(full, ids[at + 3] + 1, 0)
            prefixes, inverse = np.unique(first, return_inverse=True)
            seconds, back = np.unique(second, return_inverse=True)
            key, n = _counted(inverse * max(1, len(seconds)) + back)
            which, end = prefixes[key // max(1, len(seconds))], seconds[key % max(1, len(seconds))]
            numbers = c.hashes()
            for lo in range(0, len(key), 1 << 16):
                w, e = which[lo : lo + (1 << 16)], end[lo : lo + (1 << 16)]
                third = c.strings(e // size)
                fourth = pa.array(np.maximum(e % size - 1, 0), mask=e % size == 0)
                dealt = np.isin(_join(numbers[w // size], numbers[w % size]), hot.value)
                columns = {"prefix": _spaced(c.strings(w // size), c.strings(w % size)), "third": third, "fourth": c.names.take(fourth).cast(pa.binary()).cast(pa.string())}
                columns["deal"] = third if dealt.all() else pa.array(np.where(dealt, third.to_numpy(zero_copy_only=False), None), pa.string())
                yield _batch(c.lang, columns, n[lo : lo + (1 << 16)])

    return texts.mapInArrow(run, "lang string, prefix string, third string, fourth string, deal string, n long")


def _grown(pointers: DataFrame, least: int, longest: int, tasks: int) -> DataFrame:
    """(lang, phrase, f) of the frequent phrases of three words and more, each prefix extended in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key: tuple | None = None
        out: list[tuple[str, str, int]] = []
        for batch in batches:
            for part, own in _runs(batch):
                if own != key:
                    out += _extended(key, held, least, longest)
                    held, key = [], own
                held.append(part)
            if sum(b.num_rows for b in held) > 1 << 20:  # equal pointers of many chunks become one
                held = [_merged(held)]
            if len(out) > 10_000:
                yield _phrases(out)
                out = []
        out += _extended(key, held, least, longest)
        if out:
            yield _phrases(out)

    return pointers.repartition(tasks, *_KEY).sortWithinPartitions(*_KEY).mapInArrow(run, "lang string, phrase string, f long")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, tuple]]:
    """Slices of a sorted batch with one prefix each, and that prefix."""
    codes = [batch.column(c).dictionary_encode().indices.fill_null(-1).to_numpy() for c in _KEY]
    changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in codes], axis=0)) + 1
    for lo, hi in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows], strict=True):
        if hi > lo:
            yield batch.slice(lo, hi - lo), tuple(batch.column(c)[lo].as_py() for c in _KEY)


def _phrases(found: list[tuple[str, str, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.string(), pa.string(), pa.int64()), strict=True)], names=["lang", "phrase", "f"])


def _merged(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    names = ["lang", "prefix", "third", "fourth", "deal"]
    table = pa.Table.from_batches(held).group_by(names).aggregate([("n", "sum")]).rename_columns([*names, "n"])
    return table.select(held[0].schema.names).combine_chunks().to_batches()[0]


def _extended(key: tuple | None, held: list[pa.RecordBatch], least: int, longest: int) -> list[tuple[str, str, int]]:
    """The frequent extensions of one prefix, depth first: a phrase, then those that it begins."""
    if not held:
        return []
    table = pa.Table.from_batches(held)
    n = table.column("n").to_numpy()
    if int(n.sum()) < least:
        return []
    columns = [table.column(c).combine_chunks().dictionary_encode() for c in ("third", "fourth")]
    names = [c.dictionary.to_pylist() for c in columns]
    ids = [c.indices.fill_null(-1).to_numpy() for c in columns]
    found: list[tuple[str, str, int]] = []

    def extend(phrase: str, rows: np.ndarray, depth: int) -> None:
        if depth == len(ids) or depth + 3 > longest:
            return
        own = ids[depth][rows]
        there = own >= 0
        totals = np.bincount(own[there], weights=n[rows][there]) if there.any() else np.zeros(0)
        for i in np.flatnonzero(totals >= least).tolist():
            longer = f"{phrase} {names[depth][i]}"
            below = rows[own == i]
            found.append((key[0], longer, int(n[below].sum())))
            extend(longer, below, depth + 1)

    extend(key[1], np.arange(len(n)), 0)
    return found


def _level(phrase: str) -> Column:
    return F.regexp_count(F.col(phrase), F.lit(" ")) + 1


def frequent(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, int]:
    """(lang, phrase, f) of all phrases of up to longest words (at most 4) with f >= least; (lang, n) of the languages; words in all."""
    if longest > LONGEST:
        raise ValueError(f"phrases have at most {LONGEST} words")
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    words = cut(words_of(texts).where(F.col("phrase").isNull() | (F.col("f") >= least)))
    totals, singles = words.where("phrase is null").select("lang", F.col("f").alias("n")), words.where("phrase is not null")
    total = totals.agg(F.sum("n")).first()[0] or 0
    pairs = cut(_pairs(texts, spark.sparkContext.broadcast(_bitmap(singles)), least))
    # At most PARTS pairs are as hot as that.
    hot = np.array([_hash(r.lang, r.phrase.encode()) for r in pairs.where(F.col("f") >= _hot(total)).select("lang", "phrase").collect()], dtype=np.uint64)
    found = singles.union(pairs)
    if longest > 2:
        pointers = _pointers(texts, spark.sparkContext.broadcast(_bitmap(pairs)), spark.sparkContext.broadcast(hot))
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_WORDS))
        found = found.union(cut(_grown(pointers, least, longest, tasks)))
    return found, totals, total


def _hot(total: int) -> int:
    return max(1024, -(-total // PARTS))


def _with_counts(rows: DataFrame, part: str, name: str, counts: DataFrame, hot: int) -> DataFrame:
    """rows with the occurrences of a part of their phrase as name.

    A phrase with f occurrences begins or ends at most f / least candidates. Those from hot occurrences on,
    of which there are at most PARTS for each number of words, are broadcast; the others meet by key.
    """
    keys = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias(name))
    on = (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_phrase"))
    tried = rows.join(F.broadcast(keys.where(F.col(name) >= hot)), on, "left").drop("_lang", "_phrase")
    rest = tried.where(F.col(name).isNull()).drop(name).join(keys.where(F.col(name) < hot), on).drop("_lang", "_phrase")
    return tried.where(F.col(name).isNotNull()).unionByName(rest)


def _cuts(longest: int) -> Column:
    """The ways to cut a phrase in two: k, its first k words, and the rest."""
    words = F.split("phrase", " ")
    one = lambda k: F.struct(F.lit(k).alias("k"), F.array_join(F.slice(words, 1, k), " ").alias("first"), F.array_join(F.slice(words, k + 1, longest), " ").alias("rest"))
    return F.explode(F.slice(F.array(*[one(k) for k in range(1, longest)]), F.lit(1), _level("phrase") - 1))


def _shorter(longest: int) -> Column:
    """The phrases of two words and more that a longer one holds, once each."""
    words, level = F.split("phrase", " "), _level("phrase")
    spans = [(at, size) for size in range(2, longest) for at in range(1, longest - size + 2)]
    own = [F.when((level > size) & (at + size - 1 <= level), F.array_join(F.slice(words, at, size), " ")) for at, size in spans]
    return F.explode(F.array_distinct(F.array_compact(F.array(*own))))


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, first: int = FIRST, inside: int = INSIDE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first phrases of every language by score.

    Texts are lower-cased (A-Z), cut into pieces at `.,;:!?` and line ends, and pieces into words at
    spaces and tabs. A candidate is a phrase of 2 to longest words with a >= least occurrences; of its
    cuts in two the lowest score floor(2000000 * a / (l + r)) counts, ties to the smallest first part.
    Candidates of which a longer one has inside percent of the occurrences are dropped. rank is by score
    and a, falling, then by phrase. A null language is UNKNOWN, a null text empty; other columns are not
    read; languages without candidates, and empty tables, give no rows.
    """
    counts, totals, total = frequent(docs, lang_col, text_col, least, longest)
    hot = _hot(total)
    candidates = counts.where(_level("phrase") > 1).withColumnRenamed("f", "a")
    cuts = candidates.select("lang", "phrase", "a", _cuts(longest).alias("c")).select("lang", "phrase", "a", "c.k", "c.first", "c.rest")
    known = _with_counts(_with_counts(cuts, "first", "l", counts, hot), "rest", "r", counts, hot)
    scored = known.withColumn("score", F.expr(f"cast(a as decimal(38, 0)) * {_SCALE} div (cast(l as decimal(38, 0)) + r)").cast("long"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
    longer = candidates.where(_level("phrase") > 2).select("lang", _shorter(longest).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").where(F.col("most").isNull() | (F.expr(f"cast(most as decimal(38, 0)) * 100 < cast(a as decimal(38, 0)) * {inside}")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = kept.select("lang", "phrase", "a", "low.l", "low.r", "low.score", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    best = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= first)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
