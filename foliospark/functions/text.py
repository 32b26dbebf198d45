"""Text, citation and date expressions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters replaced one for one, and those dropped as scanning junk.
CONFUSABLES = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", " ": " ", "ſ": "s"}
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl"}
JUNK = "■□¶•†‡"


def normalise(text: Column) -> Column:
    """Words split by a hyphen at a line's end joined, confusable characters made one, junk dropped, white space collapsed, lower case, trimmed; null stays null."""
    joined = F.regexp_replace(text, r"(?U)(?<=[a-z])-\s+(?=[a-z])", "")
    plain = F.translate(joined, "".join(CONFUSABLES) + JUNK, "".join(CONFUSABLES.values()))
    for old, new in LIGATURES.items():
        plain = F.replace(plain, F.lit(old), F.lit(new))
    return F.trim(F.lower(F.regexp_replace(plain, r"(?U)\s+", " ")))


def cite_key(cite: Column) -> Column:
    """The key under which citations are equal: no periods, lower case, single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.replace(cite, F.lit("."), F.lit(" "))), r"\s+", " "))


def leading_year(date: Column) -> Column:
    """The year that a date text begins with; 0 where there is none."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(date, r"^(\d{4})", 1), F.lit("")), F.lit("9999")).cast("int"), F.lit(0))


def era_label(year: Column, bounds: list[tuple[str, int]]) -> Column:
    """The first label whose exclusive upper bound is above the year, the last label beyond all, 'unknown' for null."""
    out = F.when(year.isNull(), "unknown")
    for label, end in bounds:
        out = out.when(year < end, label)
    return out.otherwise(bounds[-1][0])


def primary_cite(citations: Column) -> Column:
    """The first official citation of an array<struct<cite,type>>, else the first, else ''."""
    official = F.filter(citations, lambda c: c["type"] == "official")
    return F.coalesce(F.get(official, F.lit(0))["cite"], F.get(citations, F.lit(0))["cite"], F.lit(""))


def tokens(text: Column) -> Column:
    """Lower-case words of letters and digits, without accents' marks being lost: the unit of the full-text operators."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


def plain_words(text: Column) -> Column:
    """Lower-case words of a-z and 0-9."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), 0)


def dates_compatible(a: Column, b: Column) -> Column:
    """True if both date texts are non-empty and one begins with the other."""
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    return (a != "") & (b != "") & (F.startswith(a, b) | F.startswith(b, a))


def group_name(name: Column) -> Column:
    """Lower-case words and digits of a name with single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9 ]+", " "), " +", " "))
