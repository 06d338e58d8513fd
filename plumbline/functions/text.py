"""Text functions as Column expressions; only NFKC and two negation tests run in Python (functions.udfs).

Java's ``\\s`` is ASCII, so patterns that must see every white space carry ``(?U)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.udfs import nfkc

_SPACES = r"(?U)\s+"
#: A number as Python's float() reads it, without exponents of other forms, infinities or suffixes.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Tokens that stand for no source.
IGNORED_SOURCES = ("not_found", "none", "nan", "na", "n/a", "-")
# Separators of the four kinds of tag cells.
TAG_SEPARATORS = {"spaced": r"(?U)[;,；\s]+", "listed": r"[;；,，]+", "piped": r"[|,，;]", "marked": r"[|,，;、]"}


def blank_to_null(x: Column) -> Column:
    return F.when(F.trim(x) != "", x)


def squeeze(x: Column) -> Column:
    """White space of any kind to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(x, _SPACES, " "))


def normalize_text(x: Column, compose: bool = True) -> Column:
    """Null to empty, NFKC, one kind of parenthesis, comma and dash, white space squeezed.

    compose=False leaves out NFKC, which no SQL engine here has, and keeps the whole on the JVM.
    """
    text = F.coalesce(x.cast("string"), F.lit(""))
    text = nfkc(text) if compose else text
    return squeeze(F.translate(text, "（），、﹣－", "(),,--"))


def compact(x: Column, compose: bool = True) -> Column:
    return F.regexp_replace(normalize_text(x, compose), _SPACES, "")


def compact_key(x: Column, strip_parens: bool = False, compose: bool = True) -> Column:
    """compact() without separators and quotes; strip_parens also drops innermost parentheses, in one pass."""
    text = compact(x, compose)
    if strip_parens:
        text = F.regexp_replace(text, r"\([^()]*\)", "")
    return F.regexp_replace(text, r'[·,，、“”"]', "")


def lookup(key: Column, aliases: dict[str, str]) -> Column:
    """The alias of a key, or the key itself. The map is a constant of the plan: for dictionaries written by hand."""
    if not aliases:
        return key
    table = F.create_map(*[F.lit(v) for pair in aliases.items() for v in pair])
    return F.coalesce(F.try_element_at(table, key), key)


def canonical_key(x: Column, aliases: dict[str, str], compose: bool = True) -> Column:
    return lookup(compact_key(x, True, compose), aliases)


def identity_key(x: Column, descriptive: Sequence[str], aliases: dict[str, str], compose: bool = True) -> Column:
    """A key that keeps parentheses unless they hold one of the descriptive terms."""
    text = F.regexp_replace(compact(x, compose), r'[“”"]', "")
    if descriptive:
        text = F.regexp_replace(text, r"\([^()]*(?:" + "|".join(map(_literal, descriptive)) + r")[^()]*\)", "")
    return lookup(F.regexp_replace(text, r"[·,，、]", ""), aliases)


def identity_candidates(base: Column, location: Column, aliases: dict[str, str]) -> Column:
    """The identity key, then the key with the location's last part in parentheses, each once."""
    tail = F.element_at(F.split(location, "[·,，、/]"), -1)
    second = F.when((base != "") & (tail != "") & ~F.contains(base, F.lit("(")), F.concat(base, F.lit("("), tail, F.lit(")")))
    keys = F.array(base, lookup(second, aliases))
    return F.array_distinct(F.filter(keys, lambda k: k.isNotNull() & (k != "")))


def compatible_keys(a: Column, b: Column, aliases: dict[str, str], compose: bool = True) -> Column:
    left, right = canonical_key(a, aliases, compose), canonical_key(b, aliases, compose)
    return (left != "") & (left == right)


def normalize_subject(x: Column, compose: bool = True) -> Column:
    text = F.replace(compact(x, compose), F.lit("不提科目要求"), F.lit("不限"))
    text = F.regexp_replace(text, r"科目考生(均须|必须)选考方可报考", "")
    text = F.translate(F.regexp_replace(text, r"\([0-9]+门\)", ""), ",/", "&|")
    return F.replace(text, F.lit("&&"), F.lit("&"))


def digits(x: Column, compose: bool = True) -> Column:
    """Whole number of a cell: n.0 is n, else all that is not a digit is dropped ("12.5" gives 125)."""
    text = compact(x, compose)
    whole = F.when(F.rlike(text, F.lit(r"^[0-9]+\.0$")), F.regexp_extract(text, r"^([0-9]+)", 1)).otherwise(F.regexp_replace(text, r"[^0-9]", ""))
    return whole.try_cast("long")


def number(x: Column, thousands: bool = False) -> Column:
    """The number of a cell, or null; NaN, infinities and Java suffixes such as 12d are no numbers."""
    text = F.trim(x.cast("string"))
    text = F.replace(text, F.lit(","), F.lit("")) if thousands else text
    return F.when(F.rlike(text, F.lit(_NUMBER)), text.try_cast("double"))


def first_number(x: Column) -> Column:
    return F.regexp_extract(F.replace(x, F.lit(","), F.lit("")), r"([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")


def flag(x: Column) -> Column:
    """Whether a cell says true, 1, yes or y."""
    return F.coalesce(F.lower(F.trim(x.cast("string"))).isin("true", "1", "yes", "y"), F.lit(False))


def money(x: Column, free: str = "免费", ten_thousands: str = "万", compose: bool = True) -> Column:
    """First number of a price, times 10,000 if the text has that sign anywhere, rounded half to even; 0 if free."""
    text = normalize_text(x, compose)
    n = first_number(text)
    return F.when(F.contains(text, F.lit(free)), F.lit(0)).otherwise(F.bround(F.when(F.contains(text, F.lit(ten_thousands)), n * 10000).otherwise(n)).cast("long")).cast("long")


def pad_code(x: Column, width: int) -> Column:
    """A whole number padded with zeros; longer ones stay whole, and null gives an empty text."""
    n = digits(x, compose=False)
    return F.when(n.isNull(), F.lit("")).otherwise(F.format_string(f"%0{width}d", n))


def normalize_code(x: Column, width: int) -> Column:
    """Digits of a code without a trailing .0, padded; a text without digits stays."""
    text = F.regexp_replace(F.trim(F.coalesce(x.cast("string"), F.lit(""))), r"\.0$", "")
    own = F.regexp_replace(text, "[^0-9]", "")
    return F.when(own == "", text).when(F.length(own) >= width, own).otherwise(F.lpad(own, width, "0"))


def tail_numbers(x: Column) -> Column:
    """struct<head string, tail array<int>>: whole-number tokens at the end of a line."""
    found = F.regexp_extract(x, r"^(.*?)((?:\s\d+)*)$", 2)
    tail = F.transform(F.filter(F.split(F.trim(found), r"\s+"), lambda t: t != ""), lambda t: t.try_cast("int"))
    return F.struct(F.trim(F.regexp_extract(x, r"^(.*?)((?:\s\d+)*)$", 1)).alias("head"), tail.alias("tail"))


def subject_tail(x: Column, terms: Sequence[str], any_term: str) -> Column:
    """struct<head, subject>: a trailing list of subjects joined by & or /, or the term for any."""
    one = "(?:" + "|".join(map(_literal, terms)) + ")"
    pattern = rf"^(.*?)\s*({_literal(any_term)}|{one}(?:\s*[&/]\s*{one})*)$"
    matched = F.rlike(x, F.lit(pattern))
    return F.struct(
        F.when(matched, F.trim(F.regexp_extract(x, pattern, 1))).otherwise(x).alias("head"), F.when(matched, F.regexp_replace(F.regexp_extract(x, pattern, 2), r"\s+", "")).otherwise("").alias("subject")
    )


def header(x: Column, places: Sequence[str]) -> Column:
    """struct<code, name, location, rest> of a line that names an institution, else null.

    The first parenthesised group that begins with one of the places ends the header; four leading digits are its code.
    """
    one = "|".join(map(_literal, places))
    pattern = rf"^\s*(\d{{4}})?\s*(.*?)\(((?:{one})[^()]*)\)(.*)$"
    name = F.trim(F.regexp_extract(x, pattern, 2))
    return F.when(
        F.rlike(x, F.lit(pattern)) & (name != ""),
        F.struct(F.regexp_extract(x, pattern, 1).alias("code"), name.alias("name"), F.regexp_extract(x, pattern, 3).alias("location"), F.trim(F.regexp_extract(x, pattern, 4)).alias("rest")),
    )


def clean_name(x: Column) -> Column:
    """A name without bracketed prefixes and stray numbers before it."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(x), r"^\[[^\]]*\]\s*", ""), r"^(?:\d+\s+)+", ""))


def split_tags(x: Column, kind: str = "spaced") -> Column:
    """The parts of a cell of tags, trimmed, none empty; kind picks the separators. A null cell has none."""
    parts = F.transform(F.split(F.coalesce(x, F.lit("")), TAG_SEPARATORS[kind]), lambda t: F.trim(t))
    return F.filter(parts, lambda t: t != "")


def tag_set(x: Column, kind: str = "spaced") -> Column:
    return F.array_sort(F.array_distinct(split_tags(x, kind)))


def split_sources(x: Column, ignored: Sequence[str] = IGNORED_SOURCES) -> Column:
    """Source ids of a cell, without the tokens that stand for none."""
    return F.filter(split_tags(x), lambda t: ~F.lower(t).isin(*ignored))


def join_parts(*parts: Column, separator: str = "; ") -> Column:
    """The non-blank parts, joined."""
    return F.concat_ws(separator, *[blank_to_null(F.trim(p)) for p in parts])


def has_any(text: Column, terms: Sequence[str]) -> Column:
    """Whether any term occurs literally; null counts as empty. Several terms are one scan of the text."""
    if len(terms) > 2 and all(terms):
        out = F.rlike(text, F.lit(any_of(terms)))
    else:
        out = F.lit(False)
        for t in terms:
            out = out | F.contains(text, F.lit(t))
    return F.coalesce(out, F.lit(False))


def terms_in(text: Column, terms: Sequence[str]) -> Column:
    """The set of the terms that occur literally, as an array, from one scan of the text; null has none.

    The scan gives the longest term that begins at each place; shorter ones that begin there are its beginnings.
    """
    longest = sorted(set(filter(None, terms)), key=lambda t: (-len(t), t))
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?=({any_of(longest, True)}))"), F.lit(1)))
    begun = {t: [s for s in longest if t.startswith(s)] for t in longest}
    if any(len(s) > 1 for s in begun.values()):
        table = F.create_map(*[c for t, s in begun.items() for c in (F.lit(t), F.array(*map(F.lit, s)))])
        found = F.array_distinct(F.flatten(F.transform(found, lambda t: F.element_at(table, t))))
    return found


def any_of(terms: Sequence[str], longest: bool = False) -> str:
    """A pattern for any of the terms, with common beginnings written once; longest: it takes the longest that fits."""
    tree: dict = {}
    for t in terms:
        node = tree
        for c in t:
            node = node.setdefault(c, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        ends = "" in node
        if ends and not longest:
            return ""
        parts = [_literal(c) + pattern(below) for c, below in node.items() if c]
        if not parts:
            return ""
        single = all(len(p.removeprefix("\\")) == 1 for p in parts)
        body = "[" + "".join(parts) + "]" if single and len(parts) > 1 else parts[0] if len(parts) == 1 and not ends else "(?:" + "|".join(parts) + ")"
        return body + "?" if ends else body

    return pattern(tree)


def haystack(*columns: Column) -> Column:
    """Lower-cased text of a row's fields: empty ones leave no gap."""
    return F.lower(F.concat_ws(" ", *[F.nullif(c.cast("string"), F.lit("")) for c in columns]))


def mojibake(x: Column, markers: Sequence[str] = ("�", "锟斤拷", "Ã", "â€"), marks: int = 4) -> Column:
    """Whether a text shows signs of a wrong decoding: several question marks or any marker."""
    text = F.coalesce(x, F.lit(""))
    return (F.length(text) - F.length(F.replace(text, F.lit("?"), F.lit(""))) >= marks) | has_any(text, markers)


def first_listed(x: Column, terms: Sequence[str]) -> Column:
    """The first of the terms, in their order, that the text has."""
    return F.coalesce(*[F.when(F.contains(x, F.lit(t)), F.lit(t)) for t in terms]) if terms else F.lit(None).cast("string")


def near_pairs(x: Column, marker: str, value: str, within: int = 80) -> Column:
    """Distinct matches of value within so many characters after or before the marker, in order; both are patterns."""
    after = F.regexp_extract_all(x, F.lit(rf"(?is)(?:{marker}).{{0,{within}}}?({value})"), F.lit(1))
    before = F.regexp_extract_all(x, F.lit(rf"(?is)({value}).{{0,{within}}}?(?:{marker})"), F.lit(1))
    return F.array_distinct(F.transform(F.concat(after, before), lambda s: F.upper(s)))


def label(x: Column, names: dict[str, str]) -> Column:
    return lookup(x, names)


def percent(x: Column, places: int = 2) -> Column:
    return F.format_string(f"%.{places}f%%", F.bround(x * 100, places))


def _literal(term: str) -> str:
    return "".join(c if c.isalnum() else "\\" + c for c in term)


# The home region, and marks in a school's name that raise its standing.
HOME_REGION = "浙江"
SCHOOL_MARKS = ("双一流", "985", "211")


def in_home_region(province: Column, home: str = HOME_REGION) -> Column:
    return F.trim(F.coalesce(province, F.lit(""))) == home


def marked_school(college: Column, marks: Sequence[str] = SCHOOL_MARKS) -> Column:
    return has_any(F.trim(F.coalesce(college, F.lit(""))), marks)


def price_detail(price: Column, raw: Column) -> Column:
    """A price by year as shown, with the original cell where that says more than the number."""
    shown = F.when(price.isNull(), F.lit("-")).otherwise(F.concat(F.regexp_replace(F.format_number(price, 0), r"\.$", ""), F.lit(" 元/年")))
    cell = F.trim(F.coalesce(raw, F.lit("")))
    plain = (cell == "") | F.rlike(F.replace(cell, F.lit(","), F.lit("")), F.lit(r"^\d+(\.0+)?$"))
    return F.when(plain, shown).when(price.isNull(), F.concat(F.lit("原表："), cell)).otherwise(F.concat(shown, F.lit("（原表："), cell, F.lit("）")))


def history_badge(latest: Column, years: Column) -> Column:
    """How many years of history a row has, as a badge says it."""
    n = F.coalesce(years, F.lit(0))
    return F.when(latest.isNull(), "无历史").when(n >= 3, "3年").when(n == 2, "2年").otherwise("1年")
