"""SimHash near-duplicate groups by tiled exact comparison.

Fingerprints are compared exactly: numpy exclusive-or and bit counts over tiles of fingerprints that
are ordered by population count; a tile pair whose population counts differ beyond the radius is
skipped, as no pair in it can be within the radius. To keep the work from growing with the square of
the input, tiles are formed inside partitions: the 64 bits are cut into radius + 2 blocks, and two
fingerprints within the radius agree in at least two whole blocks, so comparing inside the partitions
of every pair of blocks finds every link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import cut, met, unsigned
from plumbline.llm.components import components
from plumbline.llm.textcore import CHUNK, binary, chunks, gram_hashes, mix, pieces, ragged_sum, word_hashes

#: Rows of a partition that are compared in one task; larger partitions are dealt out as pairs of tiles.
PARTITION_ROWS = 8192
TILE = 1024


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint of one text; see fingerprints()."""
    return int(_fingerprints([text], shingle, seed)[0])


def _shingle_hashes(text: bytes, shingle: int, seed: int) -> list[int]:
    words = text.lower().split()
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), seed)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)]


def _fingerprints(texts: list[bytes], shingle: int, seed: int) -> np.ndarray:
    out, group, size = [], [], 0
    for i, text in enumerate(texts):
        if len(text) > CHUNK:
            out += [_majority(group), _long_fingerprint(text, shingle, seed)]
            group, size = [], 0
            continue
        group.append(_shingle_hashes(text, shingle, seed))
        size += len(group[-1])
        if size > 100_000:
            out.append(_majority(group))
            group, size = [], 0
    out.append(_majority(group))
    return np.concatenate(out)


def _long_fingerprint(text: bytes, shingle: int, seed: int) -> np.ndarray:
    """The fingerprint of one text, read in blocks."""
    total, ones, carried = 0, np.zeros((1, 64), dtype=np.int64), b""
    for part in pieces(text):
        words = (carried + b" " + part).split()
        if len(words) >= shingle:
            hashes = _shingle_hashes(b" ".join(words), shingle, seed)
            total += len(hashes)
            ones += _ones([hashes], np.array([len(hashes)]))
            words = words[len(words) - shingle + 1 :]
        carried = b" ".join(words)
    if not total:
        return _majority([_shingle_hashes(carried, shingle, seed)])
    return np.packbits(ones * 2 > total, axis=1, bitorder="little").view("<u8").ravel()


def _majority(group: list[list[int]]) -> np.ndarray:
    """Bits that are set in over half of the hashes of each list; 0 for an empty list."""
    counts = np.array([len(g) for g in group], dtype=np.int64)
    return np.packbits(_ones(group, counts) * 2 > counts[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _ones(group: list[list[int]], counts: np.ndarray) -> np.ndarray:
    """How many hashes of each list have each bit."""
    ones = np.zeros((len(group), 64), dtype=np.int64)
    rows = np.array([h for g in group for h in g], dtype="<u8")
    block = 1 << 17  # hashes whose bits are unpacked at once
    for lo in range(0, len(rows), block):
        part = rows[lo : lo + block]
        ends = np.cumsum(counts)
        own = np.clip(ends, lo, lo + len(part)) - np.clip(ends - counts, lo, lo + len(part))
        ones += ragged_sum(np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), own)
    return ones


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(id_col, fingerprint long) for every row of docs.

    A-Z are lower-cased; the text's words are taken in shingles, repeats included, joined by one space
    (fewer words: the whole sequence). A bit is set if it is set in over half of the XXH64 hashes of
    the shingles. A null, empty or blank text has fingerprint 0. Ids may be null or repeated.
    """
    schema = docs.select(id_col).schema.add("fingerprint", "long")
    arrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = _fingerprints([t or b"" for t in binary(batch.column("text"))], shingle, seed)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(got.view(np.int64))], names=[id_col, "fingerprint"])

    return arrow.mapInArrow(run, schema)


def _block_masks(radius: int) -> list[int]:
    """Masks of every two of radius + 2 blocks of the 64 bits, as signed values."""
    n = radius + 2
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [int(np.uint64(a | b).astype(np.int64)) for a, b in combinations(blocks, 2)]


def near(fps: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of all fingerprints of one group that are within the radius, tile by tile; rows come sorted by group, then population count."""
    edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True]))) if len(group) else np.zeros(1, dtype=np.int64)
    sizes = np.diff(edges)
    small = np.repeat(sizes <= 32, sizes)
    for step in range(1, int(min(32, sizes.max(initial=0)))):  # small groups: all of them at once, by distance of rows
        a = np.flatnonzero((group[step:] == group[:-step]) & small[step:])
        if not len(a):
            break
        hit = a[np.bitwise_count(fps[a] ^ fps[a + step]) <= radius]
        yield hit, hit + step
    for lo, hi in zip(edges[:-1][sizes > 32].tolist(), edges[1:][sizes > 32].tolist(), strict=True):
        pop = np.bitwise_count(fps[lo:hi]).astype(np.int16)
        for i in range(lo, hi, TILE):
            a = fps[i : min(i + TILE, hi)]
            for j in range(i, hi, TILE):
                if pop[j - lo] - pop[min(i + TILE, hi) - 1 - lo] > radius:
                    break
                b = fps[j : min(j + TILE, hi)]
                x, y = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
                keep = x + i < y + j
                yield x[keep] + i, y[keep] + j


def forest(n: int, links: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest position that each of n positions reaches by the links, which come in parts."""
    root = np.arange(n)
    for left, right in links:
        while len(left):
            a, b = root[left], root[right]
            open_ = a != b
            left, right, low = left[open_], right[open_], np.minimum(a, b)[open_]
            np.minimum.at(root, a[open_], low)
            np.minimum.at(root, b[open_], low)
            while not np.array_equal(root, root[root]):
                root = root[root]
    return root


def links(fps: DataFrame, radius: int = 2, partition_rows: int = PARTITION_ROWS) -> DataFrame:
    """Links (a, b) that join all fingerprints within the radius, as a forest for each task.

    fps has one row for each different fingerprint: (fingerprint long, rep long). A partition of more than
    partition_rows rows is dealt out as pairs of tiles by population count, so that no task grows with it.
    """
    masks = F.array(*[F.lit(m) for m in _block_masks(radius)])
    rows = fps.select(
        "fingerprint", "rep", F.posexplode(F.transform(masks, lambda m: F.col("fingerprint").bitwiseAND(m))).alias("which", "part")
    )
    return compared(rows, radius, partition_rows)


def compared(rows: DataFrame, radius: int, partition_rows: int = PARTITION_ROWS) -> DataFrame:
    """Links (a, b) that join the fingerprints of each partition that are within the radius.

    rows: (which, part, fingerprint, rep), where which and part name a partition; different ones each time.
    """
    # A partition of one row holds no pair.
    sizes = cut(rows.groupBy("which", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).withColumn("rows", F.col("n")))
    rows = met(rows, sizes, ["which", "part"], "rows")
    # A tile is a population count and a salt; tile pairs within the radius get a task of their own.
    spread = F.greatest(F.lit(1), F.ceil(F.col("n") / (4 * partition_rows))).cast("int")
    rows = rows.withColumn("large", F.col("n") > partition_rows).withColumn("pop", F.bit_count("fingerprint")).withColumn("salts", spread).withColumn(
        "salt", F.pmod(F.xxhash64("fingerprint"), F.col("salts")).cast("int")
    )
    tile = F.col("pop") * 65536 + F.col("salt")
    others = F.flatten(
        F.transform(
            F.sequence(F.lit(-radius), F.lit(radius)),
            lambda d: F.transform(F.sequence(F.lit(0), F.col("salts") - 1), lambda s: (F.col("pop") + d) * 65536 + s),
        )
    )
    dealt = rows.select(
        "which", "part", "fingerprint", "rep", F.when(F.col("large"), tile).otherwise(-1).alias("tile"),
        F.explode(F.when(F.col("large"), others).otherwise(F.array(F.lit(-1)))).alias("other"),
    ).select("which", "part", "fingerprint", "rep", F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"))
    task = ["which", "part", "t1", "t2"]

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, task):
            fp = table.column("fingerprint").to_numpy().view(np.uint64)
            rep = table.column("rep").to_numpy()
            order = [table.column(c).to_numpy() for c in task]
            change = np.zeros(len(fp), dtype=bool)
            for c in order:
                change[1:] |= c[1:] != c[:-1]
            group = np.cumsum(change)
            by = np.lexsort((np.bitwise_count(fp), group))
            fp, rep, group = fp[by], rep[by], group[by]
            nodes, at = np.unique(rep, return_inverse=True)
            root = forest(len(nodes), ((at[i], at[j]) for i, j in near(fp, group, radius)))
            linked = np.flatnonzero(root != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[root[linked]])], names=["a", "b"])

    return dealt.repartition(*task).sortWithinPartitions(*task).mapInArrow(compare, "a long, b long")


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 1 << 16) -> Iterator[pa.Table]:
    """Tables of about the given number of rows that hold whole groups; the batches come sorted by the keys, which have no nulls."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            same = np.ones(count, dtype=bool)
            for k in keys:
                column = table.column(k).to_numpy()
                same &= column == column[-1]
            cut_at = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut_at:
                yield table.slice(0, cut_at)
                held, count = table.slice(cut_at).to_batches(), count - cut_at
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """(id_col, fingerprint string, component_id) for every row of docs; ids are whole numbers.

    Rows whose fingerprints differ in at most radius bits are linked; component_id is the smallest id
    that a row reaches by links, its own included. Exact copies share a fingerprint and are compared
    once. A row with a null id keeps its place; it takes the component of its fingerprint, or null if
    no row with that fingerprint has an id. Repeated rows stay repeated. Empty tables give empty results.
    Other columns of docs are neither read nor returned, whatever their names.
    """
    marked = cut(fingerprints(docs, id_col, text_col, shingle, seed).select(F.col(id_col).cast("long").alias("id"), "fingerprint"))
    distinct = cut(marked.groupBy("fingerprint").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")))
    found = components(links(distinct.where("rep is not null").select("fingerprint", "rep"), radius))
    reps = cut(distinct.join(found, distinct["rep"] == found["node"], "left").select("fingerprint", F.coalesce("component", "rep").alias("component"), "n"))
    return met(marked, reps, ["fingerprint"], "n").select(F.col("id").alias(id_col), unsigned("fingerprint").alias("fingerprint"), F.col("component").alias("component_id"))


#: Partitions of the candidate search that a text belongs to, and smallest shingles that name each.
BANDS, BAND_SHINGLES = 8, 4
#: Bits in which the fingerprints of two candidates differ at most.
CANDIDATE_RADIUS = 20
_SEEDS = np.array([2 * xxhash.xxh64_intdigest(str(i), 5) + 1 & 0xFFFFFFFFFFFFFFFF for i in range(BANDS * BAND_SHINGLES)], dtype=np.uint64)


def _smallest(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The smallest of each run of grams under each permutation; runs begin at starts."""
    return np.stack([np.minimum.reduceat(grams * seed, starts) for seed in _SEEDS], axis=1)


def _band_keys(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """The names of the partitions of each text: each from the shingles that are smallest under some permutations; none for a text without words."""
    least = np.full((len(texts), len(_SEEDS)), np.iinfo(np.uint64).max, dtype=np.uint64)
    counts = np.zeros(len(texts), dtype=np.int64)
    if sum(map(len, texts)) <= 2 * CHUNK:
        words, counts = word_hashes([t.lower() for t in texts])
        first, n = np.cumsum(counts) - counts, counts - shingle + 1
        full = np.flatnonzero(n > 0)
        if len(full):
            at = np.repeat(first[full] - (np.cumsum(n[full]) - n[full]), n[full]) + np.arange(n[full].sum())
            least[full] = _smallest(gram_hashes(words, shingle)[at], np.cumsum(n[full]) - n[full])
        for i in np.flatnonzero((counts > 0) & (n <= 0)).tolist():  # fewer words than a shingle
            least[i] = gram_hashes(words[first[i] : first[i] + counts[i]], int(counts[i])) * _SEEDS
    else:
        for i, text in enumerate(texts):
            last = np.zeros(0, dtype=np.uint64)
            for part in pieces(text.lower()):
                own = word_hashes([part])[0]
                counts[i] += len(own)
                own = np.concatenate((last, own))
                if len(own) >= shingle:
                    least[i] = np.minimum(least[i], _smallest(gram_hashes(own, shingle), np.zeros(1, dtype=np.int64))[0])
                    own = own[len(own) - shingle + 1 :]
                last = own
            if 0 < counts[i] < shingle:
                least[i] = gram_hashes(last, len(last)) * _SEEDS
    bands = least.reshape(len(texts), BANDS, BAND_SHINGLES)
    keys = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64)), (len(texts), BANDS))
    for k in range(BAND_SHINGLES):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
    return [k if n else k[:0] for k, n in zip(keys, counts.tolist(), strict=True)]


def candidate_groups(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, seed: int) -> DataFrame:
    """(id, rep) of the rows with an id: rep is the smallest id of the group of candidates.

    Fingerprints within the radius are linked if they meet in a partition. Partitions are named by sets of
    smallest shingles, which texts with a similarity of s have in common with probability s**BAND_SHINGLES for
    each of BANDS partitions; equal fingerprints are always linked.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text"):
            prints = _fingerprints(texts, shingle, seed).view(np.int64)
            keys = _band_keys(texts, shingle)
            offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints), bands], names=["id", "fingerprint", "bands"])

    marked = cut(rows.mapInArrow(run, "id long, fingerprint long, bands array<long>"))
    distinct = cut(marked.groupBy("fingerprint").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")))
    # Copies have partitions and fingerprint in common: they are one row before anything is dealt.
    parts = marked.select("fingerprint", F.posexplode("bands").alias("which", "part")).distinct()
    found = components(compared(parts.join(distinct.drop("n"), "fingerprint").select("which", "part", "fingerprint", "rep"), radius))
    reps = cut(distinct.join(found, distinct["rep"] == found["node"], "left").select("fingerprint", F.coalesce("component", "rep").alias("rep"), "n"))
    return met(marked.select("id", "fingerprint"), reps, ["fingerprint"], "n").select("id", "rep")


#: Members of a group that are held against those that stay in one task, on average.
GROUP_ROWS = 1024
#: Members of a group that make up a block, and bytes of their shingles: a task compares a block in itself or with another.
BLOCK_ROWS, BLOCK_BYTES = 2048, 4 << 20


def _shingle_set(text: bytes, shingle: int) -> np.ndarray:
    words = word_hashes([text.lower()])[0]
    return np.unique(gram_hashes(words, min(shingle, len(words)))) if len(words) else words


class _Sets:
    """Sets of shingles, indexed by shingle."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        values = np.concatenate([np.zeros(0, dtype=np.uint64), *sets])
        by = np.argsort(values, kind="stable")
        self.values, self.owner = values[by], np.repeat(np.arange(len(sets)), self.sizes)[by]

    def similarity(self, own: np.ndarray) -> np.ndarray:
        """For each set, the share of the distinct shingles of both that it has in common with own; two texts without words are the same."""
        lo, hi = np.searchsorted(self.values, own, "left"), np.searchsorted(self.values, own, "right")
        n = hi - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(self.owner[at], minlength=len(self.sizes))
        union = self.sizes + len(own) - both
        return np.where(union > 0, both / np.maximum(union, 1), 1.0)


_LEFT = "id long, rep long, shingles binary"


def _left(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    ids, reps, sets = zip(*found, strict=True) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(reps, pa.int64()), pa.array(sets, pa.binary())], names=["id", "rep", "shingles"])


def _held(roles: DataFrame, similarity: float, read: Callable[[bytes], np.ndarray]) -> DataFrame:
    """(id, rep, shingles) of the rows of role 1 that are similar to none of role 0 with the same rep and salt.

    roles: id, rep, salt, role, cell; read gives the shingles of a cell. Rows that repeat an id go if one of them does.
    """

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kept, index, last = None, [], None, None  # last: id, rep and shingles of the member at hand; no shingles if it goes
        for batch in batches:
            out = []
            reps, salts, roles_, ids = (batch.column(c).to_pylist() for c in ("rep", "salt", "role", "id"))
            for rep, salt, role, id_, cell in zip(reps, salts, roles_, ids, binary(batch.column("cell")), strict=True):
                own = read(cell or b"")
                if key != (rep, salt):
                    key, kept, index = (rep, salt), [], None
                if role == 0:
                    kept.append(own)
                    continue
                index = index or _Sets(kept)
                left = own.tobytes() if (index.similarity(own) < similarity).all() else None
                if last and last[:2] == (id_, rep):
                    left = None if left is None or last[2] is None else min(left, last[2])
                elif last and last[2] is not None:
                    out.append(last)
                    if len(out) >= BLOCK_ROWS:
                        yield _left(out)
                        out = []
                last = (id_, rep, left)
            yield _left(out)
        if last and last[2] is not None:
            yield _left([last])

    return roles.repartition("rep", "salt").sortWithinPartitions("rep", "salt", "role", "id").mapInArrow(compare, _LEFT)


def _first_of_each(block: DataFrame, similarity: float) -> DataFrame:
    """The rows (id, rep, shingles) of block that are similar to none with the same rep and a smaller id that stays."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["rep"], BLOCK_ROWS):
            ids, reps = table.column("id").to_pylist(), table.column("rep").to_numpy()
            sets = [np.frombuffer(c or b"", np.uint64) for c in binary(table.column("shingles").combine_chunks())]
            edges = np.flatnonzero(np.concatenate(([True], reps[1:] != reps[:-1], [True])))
            out = []
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                index, stays = _Sets(sets[lo:hi]), np.ones(hi - lo, dtype=bool)
                for i in range(hi - lo):
                    if stays[i]:
                        out.append((ids[lo + i], int(reps[lo]), sets[lo + i].tobytes()))
                        stays[i + 1 :] &= (index.similarity(sets[lo + i]) < similarity)[i + 1 :]
            yield _left(out)

    return block.repartition("rep").sortWithinPartitions("rep", "id").mapInArrow(compare, _LEFT)


def _dealt(members: DataFrame, leaders: DataFrame) -> DataFrame:
    """members (id, rep, ...) as role 1, a large group under as many salts as it needs, and leaders (id, rep, ...) as role 0 under each salt."""
    cells = members.columns[2:]
    sizes = members.groupBy("rep").agg(F.count(F.lit(1)).alias("n")).select("rep", F.ceil(F.col("n") / GROUP_ROWS).cast("int").alias("salts"))
    roles = members.join(sizes, "rep").select("id", "rep", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("role"), *cells)
    each = leaders.join(sizes, "rep").select("id", "rep", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), *cells)
    return roles.union(each)


def _blocks(rows: DataFrame) -> DataFrame:
    """(rep, n, blocks) of each group of rows: its size, and the blocks of BLOCK_ROWS and BLOCK_BYTES that it takes."""
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum(F.octet_length("shingles")) / BLOCK_BYTES), F.lit(1)).cast("int")
    return cut(rows.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), blocks.alias("blocks")))


def _alike(tiles: DataFrame, similarity: float) -> DataFrame:
    """(id, rep) of the rows that are similar to one with a smaller id in the other half of their tile, in a tile of one half to any there.

    tiles: id, rep, lo, hi, half, shingles; a tile is what has rep, lo and hi in common.
    """

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["rep", "lo", "hi"], BLOCK_ROWS):
            ids, half, keys = table.column("id").to_numpy(), table.column("half").to_numpy(), np.stack([table.column(c).to_numpy() for c in ("rep", "lo", "hi")])
            sets = [np.frombuffer(c or b"", np.uint64) for c in binary(table.column("shingles").combine_chunks())]
            edges = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0), [True])))
            found = []
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                sides = [lo + np.flatnonzero(half[lo:hi] == k) for k in (0, 1)]
                for own, other in [(sides[0], sides[0])] if not len(sides[1]) else [sides, sides[::-1]]:
                    index = _Sets([sets[i] for i in other.tolist()])
                    found += [i for i in own.tolist() if ((index.similarity(sets[i]) >= similarity) & (ids[other] < ids[i])).any()]
            got = np.array(found, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids[got]), pa.array(keys[0][got])], names=["id", "rep"])

    return tiles.repartition("rep", "lo", "hi").sortWithinPartitions("rep", "lo", "hi", "half").mapInArrow(compare, "id long, rep long").distinct()


def _block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("id"), F.col(blocks)).cast("int")


def _each(blocks: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))


def _among(rows: DataFrame) -> DataFrame:
    """Tiles in which every two rows (id, rep, shingles, blocks) of a group meet: one for each two of its blocks."""
    paired = rows.withColumn("block", _block("blocks")).withColumn("other", _each("blocks"))
    return paired.select("id", "rep", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), (F.col("block") > F.col("other")).cast("int").alias("half"), "shingles")


def _between(stay: DataFrame, later: DataFrame) -> DataFrame:
    """Tiles in which every row of later meets all rows of stay (both id, rep, shingles) in its group."""
    counts = _blocks(stay).select("rep", F.col("blocks").alias("of_stay"), F.col("n").alias("n_stay")).join(_blocks(later).select("rep", F.col("blocks").alias("of_later"), F.col("n").alias("n_later")), "rep")
    first = met(stay, counts.drop("n_later"), ["rep"], "n_stay").select("id", "rep", _block("of_stay").alias("lo"), _each("of_later").alias("hi"), F.lit(0).alias("half"), "shingles")
    second = met(later, counts.drop("n_stay"), ["rep"], "n_later").select("id", "rep", _each("of_stay").alias("lo"), _block("of_later").alias("hi"), F.lit(1).alias("half"), "shingles")
    return first.union(second)


def _leading(rows: DataFrame) -> DataFrame:
    """(id, rep) of the first block of each group in order of id."""
    order = Window.partitionBy("rep").orderBy("id")
    # Of ids alone, and no more than BLOCK_ROWS of a group from each task.
    first = rows.select("id", "rep", F.octet_length("shingles").alias("bytes")).withColumn("place", F.row_number().over(order)).where(F.col("place") <= BLOCK_ROWS)
    before = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return first.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < BLOCK_BYTES).select("id", "rep")


def _settled(rest: DataFrame, similarity: float) -> DataFrame:
    """(id, rep) of the rows (id, rep, shingles) that are similar to none with the same rep and a smaller id that stays.

    A group of one block is settled in one task. In a larger one all pairs of blocks are compared at once: a row that no
    row of a smaller id is similar to stays, and what is similar to one that stays goes. Only rows that are similar
    to rows which went themselves are left for another round; the first block is settled in each round besides,
    so that rows which are each similar to the last come to an end.
    """
    stay = cut(rest.select("id", "rep").limit(0))
    while not rest.isEmpty():
        sizes = _blocks(rest)
        counted = met(rest, sizes, ["rep"], "n").select("id", "rep", "shingles", "blocks")
        stay = stay.union(cut(_first_of_each(counted.where("blocks = 1"), similarity).select("id", "rep")))
        if sizes.where("blocks > 1").isEmpty():
            break
        large = cut(counted.where("blocks > 1"))
        after = cut(_alike(_among(large), similarity))
        block = cut(_leading(large))
        first = _first_of_each(large.join(block, ["id", "rep"]), similarity)
        free = large.join(after, ["id", "rep"], "left_anti").join(block, ["id", "rep"], "left_anti")
        chosen = cut(free.select("id", "rep", "shingles").union(first.select("id", "rep", "shingles")))
        stay = stay.union(chosen.select("id", "rep"))
        later = cut(large.join(after, ["id", "rep"], "left_semi").join(block, ["id", "rep"], "left_anti").select("id", "rep", "shingles"))
        rest = later if later.isEmpty() else cut(later.join(_alike(_between(chosen, later), similarity), ["id", "rep"], "left_anti"))
    return stay


def verified(docs: DataFrame, groups: DataFrame, shingle: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(drop_id): members of groups (id, rep) whose shingles are similar enough to those of a member with a smaller id that stays.

    All are held against the group's smallest id first, texts of group members only. Of those left, equal sets of
    shingles become one, and _settled() tells which stay. A large group goes to as many tasks as it needs.
    """
    members = cut(groups.where("rep <> id").distinct())
    roles = _dealt(members, members.select(F.col("rep").alias("id"), "rep").distinct())
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("cell")).join(roles, "id")
    left = cut(_held(texts, similarity, lambda text: _shingle_set(text, shingle)))
    rest = cut(left.groupBy("rep", F.sha2("shingles", 256).alias("digest")).agg(F.min("id").alias("id"), F.any_value("shingles").alias("shingles")).select("id", "rep", "shingles"))
    stay = _settled(rest, similarity)
    return members.join(stay, ["id", "rep"], "left_anti").select(F.col("id").alias("drop_id")).distinct()


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, radius: int = CANDIDATE_RADIUS, seed: int = 42, similarity: float = 0.8) -> DataFrame:
    """The rows of docs without those that are near-duplicates of a kept row, all columns kept.

    Of each group of candidates the row with the smallest id stays, and so do, in order of id, members whose
    shingles have a similarity (share of distinct shingles in common) below the given one to every member
    that stays before them: fingerprints find the candidates, and an exact comparison decides. Rows with a
    null id all stay. Rows that repeat an id are told apart by nothing: all rows with a kept id stay, and all
    with a dropped one go.
    """
    # Written, so that both joins below see one result.
    groups = cut(candidate_groups(docs, id_col, text_col, shingle, radius, seed))
    drop = verified(docs, groups, shingle, similarity, id_col, text_col)
    # Names of the rows' own columns cannot clash with drop_id.
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    kept = own.join(drop, F.col(f"c{docs.columns.index(id_col)}").cast("long") == F.col("drop_id"), "left_anti")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
