"""Row filters: facets, ranges, subjects, tags and manual rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_range(x: Column, low: float | None = None, high: float | None = None) -> Column:
    """No bounds: all pass. Else null fails, and bounds belong to the range."""
    out = F.lit(True)
    if low is not None:
        out = out & (x >= low)
    if high is not None:
        out = out & (x <= high)
    return F.coalesce(out, F.lit(False))


def facets(df: DataFrame, equal: dict[str, object] | None = None, contains: dict[str, Sequence[str]] | None = None, ranges: dict[str, tuple[float | None, float | None]] | None = None) -> DataFrame:
    """Rows that meet all facets; blank ones are not set.

    equal: column -> value, compared as strings. contains: text -> columns, any of which has it, in lower
    case. ranges: column -> bounds.
    """
    for column, value in (equal or {}).items():
        if value not in (None, ""):
            df = df.where(F.col(column).cast("string") == str(value))
    for text, columns in (contains or {}).items():
        if text.strip():
            hit = F.lit(False)
            for c in columns:
                hit = hit | F.coalesce(F.contains(F.lower(c), F.lit(text.strip().lower())), F.lit(False))
            df = df.where(hit)
    for column, (low, high) in (ranges or {}).items():
        df = df.where(in_range(F.col(column), low, high))
    return df


def requirement_met(required: Column, have: Sequence[str], any_term: str = "不限") -> Column:
    """Whether all subjects of a requirement, joined by &, are had; blank and the term for any are met."""
    parts = F.filter(F.split(required, "&"), lambda p: p != "")
    listed = F.array(*[F.lit(h) for h in have]).cast("array<string>")
    return F.coalesce(F.trim(required).isin("", any_term) | (F.size(F.array_except(parts, listed)) == 0), F.lit(True))


def tags_pass(tags: Column, include: Sequence[str] = (), exclude: Sequence[str] = (), every: bool = True) -> Column:
    """Tag filter: all (or any) of include, none of exclude; a null array has no tags."""
    have = F.coalesce(tags, F.array().cast("array<string>"))
    out = F.lit(True)
    if include:
        wanted = F.array(*[F.lit(t) for t in include])
        out = F.size(F.array_except(wanted, have)) == 0 if every else F.arrays_overlap(have, wanted)
    if exclude:
        out = out & ~F.coalesce(F.arrays_overlap(have, F.array(*[F.lit(t) for t in exclude])), F.lit(False))
    return out


def drop_listed(df: DataFrame, rules: Sequence[tuple[str, str]], first: str, second: str) -> DataFrame:
    """Rows that no rule meets; a rule is a pair of texts that the two columns contain."""
    hit = F.lit(False)
    for a, b in rules:
        hit = hit | (F.contains(F.col(first), F.lit(a)) & F.contains(F.col(second), F.lit(b)))
    return df.where(~F.coalesce(hit, F.lit(False)))


def exclude_unless(df: DataFrame, excluded: Column, exception: Column) -> DataFrame:
    return df.where(~F.coalesce(excluded, F.lit(False)) | F.coalesce(exception, F.lit(False)))


def active_labels(values: dict[str, object], ranges: dict[str, tuple[object, object]]) -> list[str]:
    """The filters that are set, as labels: name: value, and name: low-high with - for an open end."""
    out = [f"{name}: {value}" for name, value in values.items() if value not in (None, "")]
    shown = lambda x: "-" if x in (None, "") else str(x)
    return out + [f"{name}: {shown(low)}-{shown(high)}" for name, (low, high) in ranges.items() if (low, high) not in ((None, None), ("", ""), (None, ""), ("", None))]
