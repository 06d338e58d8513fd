"""Vectorised word splitting and hashing over Arrow batches of whole texts.

Words are runs of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text, which is the same as the
pattern ``[^\\x20\\x09-\\x0D]+`` on characters. Texts are handled in chunks of bounded size, so the
numpy temporaries do not grow with a batch; one text larger than a chunk is split at white space.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text handled at once.
CHUNK = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of an array of bytes."""
    inside = ~_SPACE[data]
    edge = np.empty(len(data) + 1, dtype=bool)
    edge[0] = len(data) > 0 and inside[0]
    edge[-1] = len(data) > 0 and inside[-1]
    edge[1:-1] = inside[1:] != inside[:-1]
    at = np.flatnonzero(edge)
    return at[0::2], at[1::2]


#: The low bytes of a lane of eight, by their number.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_ODD, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes have equal hashes wherever they stand.

    Spans are read in lanes of eight bytes, each mixed into what the ones before gave; those of over 64
    bytes are given to XXH64. Spans of one length of up to eight bytes never share a hash.
    """
    size = ends - starts
    lanes = np.ndarray((len(data) + 1,), "<u8", np.concatenate((data, np.zeros(8, dtype=np.uint8))), strides=(1,))
    out = mix((lanes[starts] & _LOW[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * _STEP))
    more, at = np.flatnonzero((size > 8) & (size <= 64)), 8
    while len(more):
        out[more] = mix(out[more] * _ODD + (lanes[starts[more] + at] & _LOW[np.minimum(size[more] - at, 8)]))
        at += 8
        more = more[size[more] > at]
    for i in np.flatnonzero(size > 64).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return out


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _ODD + b)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of n consecutive entries of an array of word hashes.

    Runs of 1, 2, 4, ... are mixed from two of half the length, and a run of n from those that make it up.
    """
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, block = np.empty(count, dtype=np.uint64), 1 << 16  # blocks keep the temporaries small
    for lo in range(0, count, block):
        part = words[lo : min(lo + block, count) + n - 1]
        size, width, at, have, got = len(part) - n + 1, 1, 0, part, None
        while True:
            if n & width:
                own = have[at : at + size]
                got = own if got is None else _join(got, own)
                at += width
            if at == n:
                break
            have = _join(have[:-width], have[width:])
            width *= 2
        out[lo : lo + size] = got
    return out


def code_points(text: bytes, lo: int = 0, hi: int | None = None) -> np.ndarray:
    """The code points of a UTF-8 text that begin in its bytes from lo to hi."""
    hi = len(text) if hi is None else min(hi, len(text))
    while 0 < lo < len(text) and text[lo] & 0xC0 == 0x80:
        lo += 1
    while hi < len(text) and text[hi] & 0xC0 == 0x80:
        hi += 1
    return np.frombuffer(text[lo:hi].decode("utf-8").encode("utf-32-le"), dtype="<u4")


def char_grams(points: np.ndarray, n: int, bits: int) -> np.ndarray:
    """A number of the given bits for every run of n code points, by multiplying and shifting."""
    count = len(points) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.int32)
    out, block = np.empty(count, dtype=np.int32), 1 << 15
    for lo in range(0, count, block):
        wide = points[lo : min(lo + block, count) + n - 1].astype(np.uint64)
        packed = np.full(len(wide) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            packed *= _STEP
            packed += wide[k : k + len(packed)]
        packed *= _ODD
        out[lo : lo + len(packed)] = packed >> np.uint64(64 - bits)
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of width consecutive values."""
    if len(values) < width:
        return values[:0]
    low, have = values, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    rest = width - have
    return low if not rest else np.minimum(low[: len(low) - rest], low[rest:])


def pieces(text: bytes, limit: int = CHUNK) -> Iterator[bytes]:
    """The text cut at white space into parts of about limit bytes; a longer word stays whole."""
    at, n = 0, len(text)
    while n - at > limit:
        cut = max((text.rfind(c, at + 1, at + limit) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")), default=-1)
        if cut < 0:
            later = [x for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (x := text.find(c, at + limit)) >= 0]
            if not later:
                break
            cut = min(later)
        yield text[at:cut]
        at = cut
    yield text[at:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts, one after the other, and the number of words of each text."""
    if sum(map(len, texts)) <= 2 * CHUNK:
        joined = b"\n".join(texts)
        data = np.frombuffer(joined, dtype=np.uint8)
        starts, ends = word_spans(data)
        offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
        counts = np.diff(np.searchsorted(starts, offsets))
        return span_hashes(data, starts, ends), counts
    parts, counts = [], []
    for text in texts:
        own = [word_hashes([p])[0] if len(p) <= 2 * CHUNK else _long_word(p) for p in pieces(text)]
        parts += own
        counts.append(sum(map(len, own)))
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64), np.array(counts, dtype=np.int64)


def _long_word(part: bytes) -> np.ndarray:
    data = np.frombuffer(part, dtype=np.uint8)
    return span_hashes(data, *word_spans(data))


def binary(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a column of strings."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about limit bytes of text each, and their texts (null: empty)."""
    for batch in batches:
        texts = [t or b"" for t in binary(batch.column(text))]
        lo = size = 0
        for i, t in enumerate(texts):
            if size and size + len(t) > limit:
                yield batch.slice(lo, i - lo), texts[lo:i]
                lo, size = i, 0
            size += len(t)
        if lo < len(texts):
            yield batch.slice(lo), texts[lo:]


def ragged_sum(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the values; counts has the runs' lengths, zeros included."""
    out = np.zeros((len(counts), *values.shape[1:]), dtype=np.result_type(values.dtype, np.int64) if values.dtype.kind in "bui" else values.dtype)
    if len(values):
        full = np.flatnonzero(counts)
        at = np.zeros(len(full), dtype=np.int64)
        np.cumsum(counts[full][:-1], out=at[1:])
        out[full] = np.add.reduceat(values, at, axis=0, dtype=out.dtype)
    return out
