"""Matching by token positions: phrases, prefixes, stems, NEAR, AND, OR and NOT over the positional index.

A query is a nest of Phrase, Near, All, Any and Without. Its terms are read from the index in one scan, one aggregate by case gathers
each term's positions (no more than one text has), and the nest becomes one column expression on them: phrases are intersections of shifted
positions, NEAR is one pass over the sorted beginnings and ends of both sides. So a query has one shuffle, however many phrases it has.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.fold import fold_places, folded, folded_word
from foliospark.functions.offsets import offset_map
from foliospark.functions.stem import porter
from foliospark.functions.text import tokens
from foliospark.operators.postings import Term, is_term, term_postings, words_of_stem


@dataclass(frozen=True)
class Phrase:
    """Words in a row; a final '*' lets the last word go on. stem: words count by their Porter stem."""

    text: str
    stem: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(r"[^\W_]+", folded_word(self.text.lower()))

    @property
    def open(self) -> bool:
        return self.text.rstrip().endswith("*")


@dataclass(frozen=True)
class Near:
    """At most `distance` tokens between an occurrence of one phrase and one of the other, in either order; overlapping ones don't count."""

    a: Phrase
    b: Phrase
    distance: int = 10


@dataclass(frozen=True)
class All:
    parts: tuple


@dataclass(frozen=True)
class Any:
    parts: tuple


@dataclass(frozen=True)
class Without:
    """Cases of the first that aren't of the second."""

    a: object
    b: object


def any_of(phrases: list[str]) -> Any:
    return Any(tuple(Phrase(p) for p in phrases))


def _phrases(query) -> list[Phrase]:
    if isinstance(query, Phrase):
        return [query]
    parts = query.parts if isinstance(query, All | Any) else (query.a, query.b)
    return [p for part in parts for p in _phrases(part)]


def _slots(spark: SparkSession, root: str, query) -> dict[tuple[str, str], list[Term]]:
    """(kind, word) -> the terms that stand for it."""
    out: dict[tuple[str, str], list[Term]] = {}
    for p in _phrases(query):
        for i, w in enumerate(p.words):
            if p.stem:
                out[("stem", porter(w))] = [(x, False) for x in words_of_stem(spark, root, porter(w))]
            elif p.open and i == len(p.words) - 1:
                out[("prefix", w)] = [(w, True)]
            else:
                out[("word", w)] = [(w, False)]
    return out


def _slot(p: Phrase, i: int) -> tuple[str, str]:
    w = p.words[i]
    return ("stem", porter(w)) if p.stem else ("prefix", w) if p.open and i == len(p.words) - 1 else ("word", w)


def starts(p: Phrase, at: dict[tuple[str, str], Column]) -> Column:
    """Positions where the phrase begins, in ascending order. A phrase without words is nowhere."""
    if not p.words:
        return F.array().cast("array<int>")
    return F.array_sort(reduce(F.array_intersect, (_back(at[_slot(p, i)], i) for i in range(len(p.words)))))


def _back(positions: Column, i: int) -> Column:
    return F.transform(positions, lambda x: x - i) if i else positions


def _is_near(q: Near, at: dict[tuple[str, str], Column]) -> Column:
    """One pass over beginnings and ends in order: each beginning looks at the last end of the other side before it."""
    sides = [(starts(p, at), len(p.words)) for p in (q.a, q.b)]

    def marked(at_: Column, off: int, ends: int, side: int) -> Column:
        return F.transform(at_, lambda x: F.struct((x + off).alias("at"), F.lit(ends).alias("ends"), F.lit(side).alias("side")))

    events = F.concat(*(marked(s, (n - 1) * ends, ends, k) for k, (s, n) in enumerate(sides) for ends in (0, 1)))
    never = F.lit(None).cast("int")

    def step(acc: Column, e: Column) -> Column:
        other = F.when(e["side"] == 0, acc["end1"]).otherwise(acc["end0"])
        hit = (e["ends"] == 0) & F.coalesce(e["at"] - other - 1 <= q.distance, F.lit(False))
        end = lambda k: F.when((e["ends"] == 1) & (e["side"] == k), e["at"]).otherwise(acc[f"end{k}"])
        return F.struct(end(0).alias("end0"), end(1).alias("end1"), (acc["found"] | hit).alias("found"))

    first = F.struct(never.alias("end0"), never.alias("end1"), F.lit(False).alias("found"))
    return F.aggregate(F.array_sort(events), first, step, lambda acc: acc["found"])


def _holds(query, at: dict[tuple[str, str], Column]) -> Column:
    if isinstance(query, Phrase):
        return F.size(starts(query, at)) > 0 if len(query.words) != 1 else F.size(at[_slot(query, 0)]) > 0
    if isinstance(query, Near):
        both = reduce(Column.__and__, (F.size(at[_slot(p, i)]) > 0 for p in (query.a, query.b) for i in range(len(p.words))), F.lit(bool(query.a.words and query.b.words)))
        return F.when(both, _is_near(query, at)).otherwise(False)
    if isinstance(query, Without):
        return _holds(query.a, at) & ~_holds(query.b, at)
    tests = [_holds(p, at) for p in query.parts]
    return reduce(Column.__and__ if isinstance(query, All) else Column.__or__, tests, F.lit(isinstance(query, All)))


def gathered(spark: SparkSession, root: str, query) -> tuple[DataFrame, dict[tuple[str, str], Column]]:
    """(a row of each case that holds any of the query's words, the column of positions of each word)."""
    slots = _slots(spark, root, query)
    terms = [t for ts in slots.values() for t in ts]
    rows = term_postings(spark, root, terms or [("", False)])
    names = {slot: f"s{i}" for i, slot in enumerate(slots)}
    test = lambda ts: reduce(Column.__or__, (is_term(F.col("token"), t) for t in ts if t[1]), F.col("token").isin([t for t, more in ts if not more]))
    aggs = [F.collect_list(F.when(test(ts), F.col("pos"))).alias(names[slot]) for slot, ts in slots.items()]
    found = rows.groupBy("case_id").agg(*aggs) if aggs else rows.select("case_id").distinct()
    return found, {slot: F.col(n) for slot, n in names.items()}


def matching_ids(spark: SparkSession, root: str, query) -> DataFrame:
    """case_id of the cases that the query holds for. A query that asks for no word at all finds none."""
    rows, at = gathered(spark, root, query)
    return rows.filter(_holds(query, at)).select("case_id")


def matching_labels(spark: SparkSession, root: str, queries: dict) -> DataFrame:
    """(label, case_id) of every query of the dict, all answered from one scan and one shuffle."""
    rows, at = gathered(spark, root, Any(tuple(queries.values())))
    held = F.array_compact(F.array(*(F.when(_holds(q, at), F.lit(k)) for k, q in queries.items())))
    return rows.select(F.explode(held).alias("label"), "case_id")


def phrase_spans(spark: SparkSession, root: str, phrase: Phrase) -> DataFrame:
    """(case_id, first, last) token positions of each occurrence."""
    rows, at = gathered(spark, root, phrase)
    return rows.select("case_id", F.explode(starts(phrase, at)).alias("first")).select("case_id", "first", (F.col("first") + len(phrase.words) - 1).alias("last"))


def character_spans(cases: DataFrame, spans: DataFrame, raw: bool = True) -> DataFrame:
    """spans (case_id, first, last) with start and end (from 0, exclusive) in the raw text: token -> folded -> normalised -> raw places; raw false: in the normalised text.

    cases: case_id, raw_text (for raw), norm_text. Only cases with a span are looked at, each text once for all its spans.
    """
    wanted = spans.groupBy("case_id").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    d = cases.select("case_id", *(["raw_text"] if raw else []), "norm_text").join(wanted, "case_id")
    text = folded(F.col("norm_text"))
    places = offset_map(F.col("raw_text")) if raw else F.lit(None)
    d = d.select("case_id", "spans", F.split(text, r"[\p{L}\p{N}]+").alias("gaps"), tokens(text).alias("words"), fold_places(F.col("norm_text")).alias("kept"), places.alias("places"))
    d = d.select("case_id", F.explode("spans").alias("s"), "gaps", "words", "kept", "places")
    length = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + F.length(x))
    begin = lambda p: length(F.slice("gaps", 1, p + 1)) + length(F.slice("words", 1, p))
    start, last = begin(F.col("s.first")), begin(F.col("s.last")) + F.length(F.get("words", F.col("s.last"))) - 1
    plain = lambda i: F.coalesce(F.get("kept", i), i)
    place = lambda i: F.get("places", plain(i)) if raw else plain(i)
    return d.select("case_id", "s.first", "s.last", place(start).alias("start"), (place(last) + 1).alias("end"))
