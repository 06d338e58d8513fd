"""Media columns: telephony audio in WAV containers.

Mu-law and A-law samples are expanded by lookup tables; IMA ADPCM blocks are decoded with numpy across
blocks, one step of all blocks at a time; PCM is resampled by linear interpolation in whole numbers.
"""

from __future__ import annotations

import itertools
import math
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from plumbline.llm.textcore import chunks

RATE = 8000
#: Bytes of ADPCM codes in a block, after its header of 4 bytes; payloads are padded to whole blocks.
BLOCK = 192
#: Bytes of media that are decoded at once.
AT_ONCE = 1 << 20
FORMATS = {"alaw": 6, "mulaw": 7, "ima_adpcm": 17}

# IMA ADPCM step sizes and index changes.
STEPS = np.array([7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767])
MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8])


def _mulaw_table() -> np.ndarray:
    code = ~np.arange(256) & 0xFF
    size = (((code & 15) << 3) + 132 << ((code >> 4) & 7)) - 132
    return np.where(code & 128, -size, size).astype("<i2")


def _alaw_table() -> np.ndarray:
    code = np.arange(256) ^ 0x55
    power, low = (code >> 4) & 7, ((code & 15) << 4) + 8
    size = np.where(power == 0, low, (low + 256) << np.maximum(power - 1, 0))
    return np.where(code & 128, size, -size).astype("<i2")


TABLES = {"mulaw": _mulaw_table(), "alaw": _alaw_table()}
_code = np.arange(16)
#: Change of the prediction, and the next index, by index and code.
_DELTA = (STEPS[:, None] >> 3) + (STEPS[:, None] * ((_code >> 2) & 1)) + ((STEPS[:, None] >> 1) * ((_code >> 1) & 1)) + ((STEPS[:, None] >> 2) * (_code & 1))
_DELTA = np.where(_code & 8, -_DELTA, _DELTA).astype(np.int32).ravel()
_NEXT = (np.clip(np.arange(89)[:, None] + MOVES[_code & 7], 0, 88) * 16).astype(np.int32).ravel()


def decode_blocks(blocks: np.ndarray) -> np.ndarray:
    """Samples of IMA ADPCM blocks of one size (a row each: 4 bytes of header, then codes, low half first)."""
    value = blocks[:, :2].copy().view("<i2").ravel().astype(np.int32)
    state = np.clip(blocks[:, 2].astype(np.int32), 0, 88) * 16
    codes = blocks[:, 4:].T.copy()
    out = np.empty((1 + 2 * len(codes), len(blocks)), dtype="<i2")
    out[0] = value
    for i, pair in enumerate(codes):
        for half in (0, 1):
            at = state + ((pair >> (4 * half)) & 15)
            value = np.clip(value + _DELTA[at], -32768, 32767)
            state = _NEXT[at]
            out[1 + 2 * i + half] = value
    return out.T


def wav(codec: str, payload: bytes) -> bytes:
    """A WAV file with the payload as its samples' codes; ADPCM blocks start from prediction 0 and index 0."""
    if codec == "ima_adpcm":
        blocks = np.zeros((len(payload) // BLOCK, BLOCK + 4), dtype=np.uint8)
        blocks[:, 4:] = np.frombuffer(payload, dtype=np.uint8).reshape(-1, BLOCK)
        data, per = blocks.tobytes(), 1 + 2 * BLOCK
        form = struct.pack("<HHIIHHHH", FORMATS[codec], 1, RATE, RATE * (BLOCK + 4) // per, BLOCK + 4, 4, 2, per)
        samples = len(blocks) * per
    else:
        data, samples = payload, len(payload)
        form = struct.pack("<HHIIHHH", FORMATS[codec], 1, RATE, RATE, 1, 8, 0)
    body = b"WAVE" + b"".join(name + struct.pack("<I", len(x)) + x + b"\0" * (len(x) % 2) for name, x in ((b"fmt ", form), (b"fact", struct.pack("<I", samples)), (b"data", data)))
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wav(media: bytes) -> tuple[str, int, int, bytes]:
    """Codec, rate, block size and data of a WAV file; chunks that are not known are passed over."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, form, data = 12, b"", None
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            form = media[at + 8 : at + 8 + size]
        elif name == b"data":
            data = media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    kinds = {v: k for k, v in FORMATS.items()}
    if len(form) < 16 or data is None or struct.unpack_from("<H", form)[0] not in kinds:
        raise ValueError("not a telephony WAV file")
    return kinds[struct.unpack_from("<H", form)[0]], struct.unpack_from("<I", form, 4)[0], struct.unpack_from("<H", form, 12)[0], data


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation; the last sample is held. Whole numbers throughout, so results are the same everywhere."""
    return np.concatenate([np.zeros(0, "<i2"), *resampled([pcm], rate, to)])


def resampled(parts: Iterable[np.ndarray], rate: int, to: int) -> Iterator[np.ndarray]:
    """resample() of the parts' samples, one after the other, part by part."""
    step = math.gcd(rate, to)
    up, down = to // step, rate // step
    held, before, put = np.zeros(0, dtype=np.int64), 0, 0  # samples at hand, the number of those before them, and of samples given
    for part in itertools.chain(parts, [None]):
        last = part is None
        held = np.append(held, held[-1:]) if last else np.append(held, part)
        # A sample needs the one after it, so the last at hand waits for more.
        end = -(-(before + max(0, len(held) - 1)) * up // down)
        if last:
            end = (before + max(0, len(held) - 1)) * up // down
        place = np.arange(put, max(put, end), dtype=np.int64) * down
        at, share = place // up - before, place % up
        yield ((held[at] * (up - share) + held[np.minimum(at + 1, len(held) - 1)] * share) // up).astype("<i2")
        put = max(put, end)
        drop = max(0, len(held) - 1)
        held, before = held[drop:], before + drop


class Summary:
    """Peak, root mean square, zero crossings and CRC-32 of PCM that comes in parts."""

    def __init__(self, codec: str, rate: int) -> None:
        self.codec, self.rate = codec, rate
        self.samples = self.peak = self.squares = self.crossings = self.crc = 0
        self.last: bool | None = None

    def add(self, pcm: np.ndarray) -> None:
        if not len(pcm):
            return
        wide = pcm.astype(np.int64)
        below = wide < 0
        self.samples += len(pcm)
        self.peak = max(self.peak, int(np.abs(wide).max()))
        self.squares += int((wide * wide).sum())
        self.crossings += int(np.count_nonzero(below[1:] != below[:-1])) + (self.last is not None and self.last != bool(below[0]))
        self.last = bool(below[-1])
        self.crc = zlib.crc32(pcm.tobytes(), self.crc)

    def __str__(self) -> str:
        rms = math.isqrt(self.squares // max(1, self.samples))
        return f"{self.codec};rate={self.rate};samples={self.samples};peak={self.peak};rms={rms};crossings={self.crossings};crc={self.crc:08x}"


def encode_texts(docs: DataFrame, codec: str = "auto", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, media binary): each whole text as the samples of a WAV file.

    The UTF-8 bytes, padded by bytes 32 to a positive multiple of BLOCK, are the codes of mu-law or A-law
    samples or of ADPCM blocks. auto: the text's CRC-32 picks the codec, so equal texts have equal media.
    A null text counts as empty. Ids may be null or repeated; other columns are not read.
    """
    names = sorted(FORMATS)
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text"):
            media = [wav(names[zlib.crc32(t) % 3] if codec == "auto" else codec, t.ljust(max(BLOCK, -(-len(t) // BLOCK) * BLOCK))) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], names=[id_col, "n_bytes", "media"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, media binary")


def decode(media: DataFrame, media_col: str = "media", to_rate: int = 16000, keep_pcm: bool = True) -> DataFrame:
    """media with codec, payload (codes without block headers), feature and, if kept, pcm (16-bit, little-endian, at to_rate).

    All columns of media stay; it must not have columns of these names. Null media give nulls; anything
    that is not a telephony WAV file fails with a message.
    """
    added = ["codec", "payload", "feature", *(["pcm"] if keep_pcm else [])]
    clash = {c.lower() for c in media.columns} & set(added)
    if clash:
        raise ValueError(f"columns in the way: {sorted(clash)}")
    kinds = dict(zip(added, ("string", "binary", "string", "binary"), strict=False))
    schema = StructType([*media.schema.fields, *(StructField(c, StringType() if k == "string" else BinaryType()) for c, k in kinds.items())])
    place = media.columns.index(media_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            lo = 0
            while lo < batch.num_rows:  # parts of bounded size, as PCM takes several times the media's bytes
                hi, size = lo, 0
                while hi < batch.num_rows and (hi == lo or size < AT_ONCE):
                    size += len(column[hi].as_buffer() or b"") if column[hi].is_valid else 0
                    hi += 1
                got = _decode(column.slice(lo, hi - lo).to_pylist(), to_rate, keep_pcm)
                kinds = [pa.string(), pa.binary(), pa.string(), pa.binary()]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c, k) for c, k in zip(got, kinds, strict=False))], names=[*batch.schema.names, *added])
                lo = hi

    return media.mapInArrow(run, schema)


def _blocks_of(data: bytes, align: int) -> np.ndarray:
    """The whole ADPCM blocks of the data, a row each."""
    if align <= 4:
        raise ValueError(f"ADPCM blocks of {align} bytes have no samples")
    codes = np.frombuffer(data, dtype=np.uint8)
    return codes[: len(codes) // align * align].reshape(-1, align)


def _samples(codec: str, align: int, data: bytes) -> Iterator[np.ndarray]:
    """The samples of one file, by AT_ONCE bytes of it."""
    if codec == "ima_adpcm":
        blocks = _blocks_of(data, align)
        step = max(1, AT_ONCE // align)
        for lo in range(0, len(blocks), step):
            yield decode_blocks(blocks[lo : lo + step]).ravel()
    else:
        for lo in range(0, len(data), AT_ONCE):
            yield TABLES[codec][np.frombuffer(data[lo : lo + AT_ONCE], dtype=np.uint8)]


def _decode(files: list[bytes | None], to_rate: int, keep_pcm: bool) -> list[list]:
    n = len(files)
    codec, payload, feature, pcm = [None] * n, [None] * n, [None] * n, [None] * n
    blocks: dict[int, list[tuple[int, np.ndarray]]] = {}
    rates, samples = {}, {}
    for i, media in enumerate(files):
        if media is None:
            continue
        codec[i], rates[i], align, data = read_wav(media)
        payload[i] = _blocks_of(data, align)[:, 4:].tobytes() if codec[i] == "ima_adpcm" else data
        if len(data) > AT_ONCE:
            samples[i] = _samples(codec[i], align, data)
        elif codec[i] == "ima_adpcm":
            blocks.setdefault(align, []).append((i, _blocks_of(data, align)))
        else:
            samples[i] = [TABLES[codec[i]][np.frombuffer(data, dtype=np.uint8)]]
    for own in blocks.values():  # the blocks of all short files of one size at a time
        decoded = decode_blocks(np.concatenate([b for _, b in own]))
        at = 0
        for i, b in own:
            samples[i] = [decoded[at : at + len(b)].ravel()]
            at += len(b)
    for i, parts in samples.items():
        seen, kept = Summary(codec[i], to_rate), bytearray()
        for sound in resampled(parts, rates[i], to_rate):
            seen.add(sound)
            if keep_pcm:
                kept += sound.tobytes()
        feature[i] = str(seen)
        pcm[i] = bytes(kept)
    return [codec, payload, feature, *([pcm] if keep_pcm else [])]
