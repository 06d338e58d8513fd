"""Packing token sequences by first-fit decreasing in randomised groups of documents.

Documents are dealt by hash into groups of bounded size; each group is tokenised and packed in one
task, apart from all others. A document longer than a sequence is cut into full sequences and a rest;
the rests are packed first-fit decreasing: a tournament tree over the bins' free capacities gives the
first bin with room in a logarithm of their number.
"""

from __future__ import annotations

import array
import json
import os
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut
from plumbline.llm.textcore import binary

CAPACITY = 2048
#: Documents of a group, and bytes of their texts, on average.
GROUP_DOCS, GROUP_BYTES = 1024, 8 << 20
#: Bytes of texts that a task reads, on average, at most.
TASK_BYTES = 64 << 20
#: Rows equal in id and text from which they are dealt apart.
REPEATED = 1024
#: Words, and parts of words, whose ids a worker remembers.
REMEMBERED = 300_000


class Tournament:
    """The free capacities of bins, with the most of any bin below each inner node."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(0, (bins - 1)).bit_length()
        self.most = [capacity] * (2 * self.leaves)

    def first_fit(self, need: int) -> int:
        """Takes need from the first bin that has it, and returns the bin."""
        most, at = self.most, 1
        while at < self.leaves:
            at *= 2
            if most[at] < need:
                at += 1
        most[at] -= need
        found = at - self.leaves
        while at > 1:
            at //= 2
            best = max(most[2 * at], most[2 * at + 1])
            if most[at] == best:
                break
            most[at] = best
        return found


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece and its offset there; equal lengths keep their order."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    tree, used = Tournament(max(1, len(lengths)), capacity), [0] * max(1, len(lengths))
    for i in order.tolist():
        need = int(lengths[i])
        at = tree.first_fit(need)
        bins[i], offsets[i] = at, used[at]
        used[at] += need
    return bins, offsets


#: Characters that need no composition and have a plain lower case: ASCII but controls, and Latin letters.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: The vocabulary's split of a word.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Plain words of letters alone, and what _SPLIT finds in the lower case of other plain words.
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
_SPLIT_PLAIN = re.compile(r"[a-zß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it prints, else one from 256 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


_CHARACTERS = _byte_characters()


# The rules of a tokenizer file under which words can be taken one by one.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": _SPLIT.pattern}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def by_word(rules: dict) -> bool:
    """Whether a tokenizer file has RULES, so that its words can be taken one by one."""
    return {k: rules.get(k) for k in RULES} == RULES and rules["model"]["type"] == "BPE" and not rules["model"].get("dropout")


class WordIds:
    """Token ids of whole texts, from ids of their words, which a worker remembers.

    White space neither gives tokens nor joins words in the vocabulary's rules that RULES states, so a text's
    ids are its words' ids, one after the other. Plain words are lower-cased and split here, and their parts
    given to the vocabulary's model; all others go through the whole tokenizer, and so do whole texts where
    the file has other rules.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.by_word = by_word(rules)
        # What is remembered is in two halves; if the new one is full, the old one goes, but for what was asked for since.
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.old_known: dict[bytes, bytes] = {}
        self.old_parts: dict[str, bytes] = {}

    def part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            found = self.old_parts.get(part)
            if found is None:
                shown = part if part.isascii() else "".join([_CHARACTERS[b] for b in part.encode()])
                found = array.array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            if len(part) <= 64:
                if len(self.parts) >= self.remembered // 2:
                    self.old_parts, self.parts = self.parts, {}
                self.parts[part] = found
        return found

    def word(self, word: bytes) -> bytes:
        ids = self.old_known.get(word)
        if ids is None:
            text = word.decode()
            if _LETTERS.fullmatch(text):
                ids = self.part(text.lower())
            elif _PLAIN.fullmatch(text) and "<|" not in text:
                ids = b"".join([self.part(p) for p in _SPLIT_PLAIN.findall(text.lower())])
            else:
                ids = array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(word) <= 64:
            if len(self.known) >= self.remembered // 2:
                self.old_known = self.known.copy()
                self.known.clear()  # text() holds on to it
            self.known[word] = ids
        return ids

    def text(self, text: bytes) -> bytes:
        """The text's ids, little-endian unsigned 32-bit."""
        if not self.by_word:
            return array.array("I", self.tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()
        get = self.known.get
        return b"".join([get(w) or self.word(w) for w in text.split()])


_tokenizers: dict[str, WordIds] = {}


def tokens_of(path: str) -> WordIds:
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", group_docs: int = GROUP_DOCS, seed: int = 0) -> DataFrame:
    """One row for each piece: id_col, start, length, doc_tokens, sequence_id, offset, ids (binary, little-endian unsigned 32-bit).

    A document's ids are those of its text, then end_id, so a null or empty text is one piece of one id.
    start counts its document's ids before the piece; sequence_id is unique over all groups, and offset is
    the place in the sequence, without gaps from 0. Groups are dealt by a hash of id, text and seed; rows
    equal in both are packed one by one like any others, and if many, in as many groups as they need. Ids may
    be null or repeated; other columns are not read; no rows give no pieces.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.lit(seed), id_col, text_col).alias("place"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    groups = max(1, -(-size["n"] // group_docs), -(-(size["bytes"] or 0) // GROUP_BYTES))
    schema = f"`{id_col}` {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

    def run(table: pa.Table) -> pa.Table:
        return _pack_group(table, tokenizer, end_id, capacity, id_col)

    dealt = _dealt_apart(rows).select(F.pmod("place", F.lit(groups)).alias("g"), "id", "text")
    tasks = -(-(size["bytes"] or 0) // TASK_BYTES)
    if tasks > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")):  # more than the setting, lest tasks grow with the input
        dealt = dealt.repartition(tasks, "g")
    return dealt.groupBy("g").applyInArrow(run, schema)


def _dealt_apart(rows: DataFrame) -> DataFrame:
    """rows (id, text, place), with places of their own for every REPEATED of those that are equal in id and text."""
    many = cut(rows.groupBy("place").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > REPEATED).select("place"))
    if many.isEmpty():
        return rows
    # Equal rows are counted where they lie, so few come together; each count gives its rows back in parts.
    counted = rows.join(many, "place", "left_semi").groupBy("id", "text", "place").agg(F.count(F.lit(1)).alias("n"))
    parts = counted.select("id", "text", "place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(REPEATED))).alias("lo"), "n")
    apart = parts.select("id", "text", F.xxhash64("place", "lo").alias("place"), F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(REPEATED).cast("long"), F.col("n") - F.col("lo")))))
    return rows.join(many, "place", "left_anti").select("id", "text", "place").union(apart.select("id", "text", "place"))


def _pack_group(table: pa.Table, path: str, end_id: int, capacity: int, id_col: str) -> pa.Table:
    encoder = tokens_of(path)
    group = table.column("g")[0].as_py()
    texts = [t or b"" for t in binary(table.column("text").combine_chunks())]
    # The order of a group's rows may differ from run to run; the hash of the text does not.
    keys = table.column("id").to_pylist()
    order = sorted(range(len(texts)), key=lambda i: (keys[i] is None, 0 if keys[i] is None else keys[i], texts[i]))
    doc, start, length, total, ids = [], [], [], [], []
    end = np.array([end_id], dtype="<u4").tobytes()
    for i in order:
        own = encoder.text(texts[i]) + end
        for lo in range(0, len(own), 4 * capacity):
            doc.append(i)
            ids.append(own[lo : lo + 4 * capacity])
            start.append(lo // 4)
            length.append(len(ids[-1]) // 4)
            total.append(len(own) // 4)
    bins, offset = first_fit_decreasing(np.array(length, dtype=np.int64), capacity)
    columns = [table.column("id").combine_chunks().take(pa.array(doc, pa.int64()))]
    columns += [pa.array(x, pa.int64()) for x in (start, length, total, (group << 32) + bins, offset)]
    return pa.Table.from_arrays([*columns, pa.array(ids, pa.binary())], names=[id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
