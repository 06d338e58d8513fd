"""The functions that need Python: Unicode composition and tests around occurrences of words. All run in Arrow batches."""

from __future__ import annotations

import functools
import heapq
import re
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType

# Words that deny what follows, and words that weaken what they follow.
NEGATORS = ("未见", "未发现", "未检索到", "未看到", "未能确认", "没有", "无", "不含", "非", "暂无", "未找到", "没找到")
WEAKENERS = ("不足", "较少")
_END = re.compile("[。；;\n\r]")


@F.pandas_udf(StringType())
def nfkc(x: pd.Series) -> pd.Series:
    return x.map(lambda t: None if t is None else t if t.isascii() else unicodedata.normalize("NFKC", t))


def occurs_in_each(text: str, lists: Sequence[Sequence[str]], negators: Sequence[str] = NEGATORS, weakeners: Sequence[str] = WEAKENERS, before: int = 40, after: int = 8) -> list[bool]:
    """For each list, whether some token occurs with no negator in its sentence's last 40 characters before it, and no weakener in it or 8 after.

    One scan finds the places where any token begins; what stands before a place is looked at once.
    """
    found, owners = [False] * len(lists), _owners(tuple(map(tuple, lists)))
    if not owners:
        return found
    for m in _starts(tuple(owners)).finditer(text):
        at, denied = m.start(), None
        for token, own in owners.items():
            if not text.startswith(token, at) or all(found[i] for i in own):
                continue
            if denied is None:
                head = _END.split(text[max(0, at - before) : at])[-1]
                denied = any(n in head for n in negators)
            if not denied and not any(w in text[at : at + len(token) + after] for w in weakeners):
                for i in own:
                    found[i] = True
        if all(found):
            break
    return found


@functools.cache
def _owners(lists: tuple[tuple[str, ...], ...]) -> dict[str, list[int]]:
    """The lists that each token is in."""
    out: dict[str, list[int]] = {}
    for i, tokens in enumerate(lists):
        for t in filter(None, tokens):
            out.setdefault(t, []).append(i)
    return out


@functools.cache
def _starts(words: tuple[str, ...]) -> re.Pattern:
    return re.compile(f"(?={'|'.join(map(re.escape, words))})")


def occurs_unnegated(text: str, tokens: Sequence[str], negators: Sequence[str] = NEGATORS, weakeners: Sequence[str] = WEAKENERS, before: int = 40, after: int = 8) -> bool:
    """occurs_in_each() of one list."""
    return occurs_in_each(text, [tokens], negators, weakeners, before, after)[0]


def contains_unnegated(x: Column, tokens: Sequence[str]) -> Column:
    """occurs_unnegated() of a text column; null is false."""
    listed = list(tokens)

    @F.pandas_udf(BooleanType())
    def test(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: bool(t) and occurs_unnegated(t, listed))

    return test(x)


def contains_each(x: Column, lists: Sequence[Sequence[str]]) -> Column:
    """array<boolean>: occurs_unnegated() of a text for each list of tokens, in one pass over Arrow; null is false."""
    listed = [list(tokens) for tokens in lists]

    @F.pandas_udf(ArrayType(BooleanType()))
    def test(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: occurs_in_each(t or "", listed))

    return test(x)


def occurs_asserted(text: str, phrases: Sequence[str], tokens: Sequence[str], markers: Sequence[str], near: int = 50) -> bool:
    """A phrase that is not negated, or a token with a marker shortly before it and no negator before it in the sentence.

    One scan from left to right: marks that end a sentence, negators, markers and tokens are met in order,
    and what is known of the sentence so far is the end of its first negator and the start of its last marker.
    """
    if occurs_unnegated(text, phrases):
        return True
    listed = tuple(filter(None, tokens))
    if not listed or not markers:
        return False
    denied, marked = None, -1
    starts: list[tuple[int, int]] = []  # markers that end behind where the scan is: (end, start)
    for m in _scan(listed, tuple(markers), NEGATORS).finditer(text):
        at = m.start()
        while starts and starts[0][0] <= at:
            marked = max(marked, heapq.heappop(starts)[1])
        if m["end"]:
            denied, marked, starts = None, -1, []
            continue
        for word in NEGATORS:
            if (denied is None or at + len(word) < denied) and text.startswith(word, at):
                denied = at + len(word)
        if (denied is None or denied > at) and marked >= max(0, at - near + 1) and any(text.startswith(t, at) for t in listed):
            return True
        for word in markers:
            if text.startswith(word, at):
                heapq.heappush(starts, (at + len(word), at))
                if not word:
                    marked = at
    return False


@functools.cache
def _scan(tokens: Sequence[str], markers: Sequence[str], negators: Sequence[str]) -> re.Pattern:
    """Places where a sentence ends, or where one of the words begins."""
    words = "|".join(map(re.escape, sorted({*tokens, *markers, *negators}, key=len, reverse=True)))
    return re.compile(f"(?P<end>{_END.pattern})|(?={words})")


def contains_asserted(x: Column, phrases: Sequence[str], tokens: Sequence[str], markers: Sequence[str]) -> Column:
    listed = (list(phrases), list(tokens), list(markers))

    @F.pandas_udf(BooleanType())
    def test(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: bool(t) and occurs_asserted(t, *listed))

    return test(x)
