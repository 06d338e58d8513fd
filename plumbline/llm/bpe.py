"""Encoding and decoding of whole texts by a BPE vocabulary, long unsplit text by tree concatenation.

Most words are short and go through the vocabulary's model one by one. A long run that the vocabulary
does not split is halved until its parts are short; the parts are encoded in parallel, each a row of its
own. Two neighbours are then joined: the tokens around the join are encoded again, in windows that
double, until the window begins and ends with the tokens that stood there before. As every pair of
neighbouring tokens is then one that the model itself would leave apart, the whole is exactly what the
model gives for the undivided run.
"""

from __future__ import annotations

import array
import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import packing
from plumbline.llm.textcore import WORD, binary, chunks

#: Characters of an unsplit part that is encoded at once.
LEAF = 4096
#: Tokens of a row of ids, and bytes of ids that are decoded at once.
ROW_IDS, DECODED = 1 << 18, 4 << 20
#: Words, and parts of words, whose ids a worker remembers.
REMEMBERED = 200_000
#: Rows of one long text that meet its ids in as many tasks.
SALTS = 16


class Vocabulary:
    """A vocabulary file's tokens by id, its special tokens, and whether its words can be taken one by one."""

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model, added = rules["model"], rules["added_tokens"]
        self.end = model.get("end_of_word_suffix") or ""
        names = {i: t for t, i in model["vocab"].items()} | {a["id"]: a["content"] for a in added}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.special = {a["content"]: a["id"] for a in added}
        plain = not any(a["normalized"] or a["single_word"] or a["lstrip"] or a["rstrip"] for a in added) and not model.get("ignore_merges") and not model.get("byte_fallback")
        self.by_word = packing.by_word(rules) and plain and rules.get("decoder") is None


class Codec(Vocabulary):
    """A vocabulary with its model, for words and for parts of words that are not their end."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.words = packing.WordIds(path, REMEMBERED)
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")

    @functools.cached_property
    def inside(self):  # noqa: ANN201
        from tokenizers.models import BPE

        with open(self.path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        return BPE(vocab=model["vocab"], merges=[tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]])

    def part(self, text: str, last: bool) -> np.ndarray:
        """Ids of a part of a run; last: it is the run's end."""
        return np.array([t.id for t in (self.words.model if last else self.inside).tokenize(text)], dtype="<u4")

    def shown(self, ids: np.ndarray) -> str:
        return "".join([self.names[i] for i in ids.tolist()])

    def runs(self, word: str) -> Iterator[str | int]:
        """The runs that the vocabulary splits a word into, in its own characters, and the ids of special tokens."""
        at = 0
        for m in [*self.marks.finditer(word), None]:
            part = word[at : m.start() if m else len(word)]
            if part:
                for run, _ in self.words.tokenizer.pre_tokenizer.pre_tokenize_str(self.words.tokenizer.normalizer.normalize_str(part)):
                    yield run
            if m:
                yield self.special[m[0]]
                at = m.end()

    def joined(self, left: np.ndarray, right: np.ndarray, last: bool) -> np.ndarray:
        """The ids of two neighbouring parts together; last: the right one is the run's end."""
        if not len(left) or not len(right):
            return right if not len(left) else left
        size = 1
        while True:
            a, b = left[-size:], right[:size]
            ends = last and len(b) == len(right)
            text = self.shown(a) + self.shown(b)
            window = self.part(text.removesuffix(self.end) if ends else text, ends)
            if (len(a) == len(left) or window[0] == a[0]) and (len(b) == len(right) or window[-1] == b[-1]):
                return np.concatenate([left[: len(left) - len(a)], window, right[len(b) :]])
            size *= 2

    def tree(self, parts: list[np.ndarray], last: bool = True) -> np.ndarray:
        """The parts of a run in order, joined in pairs of neighbours until one is left."""
        while len(parts) > 1:
            pairs = [self.joined(parts[i], parts[i + 1], last and i + 2 >= len(parts)) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
            parts = pairs
        return parts[0]


def halves(text: str, leaf: int) -> list[str]:
    """The text halved until no part is longer than leaf."""
    if len(text) <= leaf:
        return [text]
    return halves(text[: len(text) // 2], leaf) + halves(text[len(text) // 2 :], leaf)


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _carried(df: DataFrame, id_col: str) -> str:
    return f"`{id_col}` {dict(df.dtypes)[id_col]}"


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF, decoded: str | None = None) -> DataFrame:
    """(id_col, ids) for every row: the ids of the whole text, little-endian unsigned 32-bit, without special tokens added.

    decoded names a further column, which has what decode() makes of the ids, in the same tasks.

    Null and empty texts have no ids. Texts with a run of over leaf characters without white space are
    taken apart, each different text once, and their parts encoded in tasks of their own; if the
    vocabulary has rules of which words cannot be taken one by one, whole texts go through the tokenizer.
    Ids of rows may be null or repeated; other columns are not read; no rows give no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = [id_col, "ids", *([decoded] if decoded else [])]
    schema = f"{_carried(docs, id_col)}, ids binary" + (f", `{decoded}` string" if decoded else "")

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        tokens = pa.array(own.names)
        for part, texts in chunks(batches, "text"):
            ids = [own.words.text(t) for t in texts]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(ids, pa.binary()), *([_texts(own, tokens, ids)] if decoded else [])], names=names)

    if not vocabulary(tokenizer).by_word:
        return rows.mapInArrow(short, schema)
    long = F.coalesce(F.col("text").rlike(f"{WORD[:-1]}{{{leaf + 1},}}"), F.lit(False))
    apart = rows.where(long).withColumn("key", F.sha2("text", 256))
    whole = _long_ids(apart.select("key", "text").dropDuplicates(["key", "text"]), tokenizer, leaf)
    spread = whole.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = apart.select("id", "key", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt")).alias("r")
    met = salted.join(spread.alias("w"), (F.col("r.key") == F.col("w.key")) & (F.col("salt") == F.col("_salt")))
    found = met.select(F.col("id").alias(id_col), "ids")
    return rows.where(~long).mapInArrow(short, schema).union(decode(found, tokenizer, out_col=decoded) if decoded else found)


def _long_ids(texts: DataFrame, tokenizer: str, leaf: int) -> DataFrame:
    """(key, ids) of texts with long runs: cut into rows, the rows encoded wherever they land, and joined by text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), binary(batch.column("text")), strict=True):
                number, held, room = 0, [], 0
                rows: list[tuple[str, int, bytes | None, str | None, bool]] = []
                for word in text.split():
                    shown = word.decode() if len(word) > leaf else ""
                    if len(shown) <= leaf:
                        held.append(own.words.text(word))
                    else:
                        for run in own.runs(shown):
                            if isinstance(run, int):
                                held.append(np.array([run], dtype="<u4").tobytes())
                            elif len(run) <= leaf:
                                held.append(own.part(run, True).tobytes())
                            else:
                                parts = halves(run, leaf)
                                rows.append((key, number, b"".join(held), None, False))
                                rows += [(key, number + 1 + i, None, p, i + 1 == len(parts)) for i, p in enumerate(parts)]
                                number, held, room = number + 1 + len(parts), [], 0
                    room += 1
                    if room >= ROW_IDS:
                        rows.append((key, number, b"".join(held), None, False))
                        number, held, room = number + 1, [], 0
                rows.append((key, number, b"".join(held), None, False))
                for lo in range(0, len(rows), 1024):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[lo : lo + 1024], strict=True), (pa.string(), pa.int64(), pa.binary(), pa.string(), pa.bool_()), strict=True)], names=["key", "number", "ids", "part", "last"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            found = [own.part(p, z).tobytes() if p is not None else b for b, p, z in zip(*(batch.column(c).to_pylist() for c in ("ids", "part", "last")), strict=True)]
            inside = [p is not None for p in batch.column("part").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("number"), pa.array(found, pa.binary()), pa.array(inside, pa.bool_()), batch.column("last")], names=["key", "number", "ids", "inside", "last"])

    def joined(table: pa.Table) -> pa.Table:
        own, out, run = codec(tokenizer), [], []
        for row in table.sort_by("number").select(["ids", "inside", "last"]).to_pylist():
            ids = np.frombuffer(row["ids"], dtype="<u4")
            if not row["inside"]:
                out.append(ids)
                continue
            run.append(ids)
            if row["last"]:
                out.append(own.tree(run))
                run = []
        return pa.table({"key": table.column("key").slice(0, 1), "ids": pa.array([np.concatenate(out).tobytes()], pa.binary())})

    rows = texts.mapInArrow(cut, "key string, number long, ids binary, part string, last boolean").repartition("key", "number")
    return rows.mapInArrow(parts, "key string, number long, ids binary, inside boolean, last boolean").groupBy("key").applyInArrow(joined, "key string, ids binary")


def decode(coded: DataFrame, tokenizer: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """coded with a column out_col: the text that the tokenizers library decodes the ids to, special tokens included.

    Null ids are decoded as none. A column of the name out_col is replaced.
    """
    kept = [c for c in coded.columns if c != out_col]
    schema = coded.select(*[F.col(f"`{c}`") for c in kept]).withColumn(out_col, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(tokenizer)
        tokens = pa.array(own.names)
        for part, ids in chunks(batches, ids_col, DECODED):
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], _texts(own, tokens, ids)], names=[*kept, out_col])

    return coded.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def _texts(own: Vocabulary, tokens: pa.Array, ids: list[bytes]) -> pa.Array:
    """What the tokenizers library decodes each text's ids to: without a decoder, the tokens with a space between them."""
    if not own.by_word:
        tokenizer = codec(own.path).words.tokenizer
        return pa.array([tokenizer.decode(array.array("I", b).tolist(), skip_special_tokens=False) for b in ids], pa.string())
    offsets = np.zeros(len(ids) + 1, dtype=np.int32)
    np.cumsum([len(b) // 4 for b in ids], out=offsets[1:])
    own_tokens = tokens.take(pa.array(np.frombuffer(b"".join(ids), dtype="<u4")))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), own_tokens), " ")
