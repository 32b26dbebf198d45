"""Full-text search and concordance over cases (case_id, jurisdiction, era, year, norm_text)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.fold import folded, folded_word
from foliospark.operators.positions import character_spans

#: Words that collocations leave out.
STOPWORDS = (
    "the of and to in a is that it was for on as be by at or which with from this his her he she they them their are were an "
    "not no so if but had have has been would will may can such said its any all one upon"
).split()


def phrase_pattern(phrase: str) -> str:
    """A regular expression for the phrase's tokens in order, anything but letters and digits between them; a final '*' lets the last token go on."""
    words = re.findall(r"[^\W_]+", folded_word(phrase.lower()))
    end = r"[\p{L}\p{N}]*" if phrase.rstrip().endswith("*") else ""
    return r"(?<![\p{L}\p{N}])" + r"[^\p{L}\p{N}]+".join(words) + end + r"(?![\p{L}\p{N}])"


def has_phrase(text: Column, phrase: str) -> Column:
    """Whether the text, without its accents, holds the phrase. The first token's plain containment is tested before the pattern, as it is cheap."""
    plain = folded(text)
    return F.contains(plain, F.lit(re.findall(r"[^\W_]+", folded_word(phrase.lower()))[0])) & plain.rlike(phrase_pattern(phrase))


def matching(cases: DataFrame, phrases: list[str]) -> DataFrame:
    """Cases that hold any of the phrases, by a scan of their texts: for few cases, or where there is no index (operators.positions)."""
    return cases.filter(reduce(lambda a, b: a | b, (has_phrase(F.col("norm_text"), p) for p in phrases)))


def phrase_evidence(hits: DataFrame, phrases: list[str], width: int = 200) -> DataFrame:
    """For matching cases (hits, with their texts): case_id, span_start, span_end (from 0) and matched_text: the first phrase (in the given order) found as text, with `width` characters around it; else the first 2 * width characters and span (0, 0)."""
    at = F.coalesce(*(F.when(F.locate(p.lower(), F.col("norm_text")) > 0, F.struct(F.locate(p.lower(), F.col("norm_text")).alias("i"), F.lit(len(p)).alias("n"))) for p in phrases))
    d = hits.withColumn("at", at)
    first = F.greatest(F.col("at.i") - width, F.lit(1))
    text = F.when(F.col("at").isNotNull(), F.substr("norm_text", first, F.col("at.i") + F.col("at.n") + width - first)).otherwise(F.substring("norm_text", 1, 2 * width))
    zero = F.lit(0)
    return d.select("case_id", F.coalesce(F.col("at.i") - 1, zero).alias("span_start"), F.coalesce(F.col("at.i") - 1 + F.col("at.n"), zero).alias("span_end"), text.alias("matched_text"))


def regex_hits(cases: DataFrame, pattern: str, width: int = 200) -> DataFrame:
    """case_id, span_start, span_end and matched_text of the first match of a case-insensitive pattern."""
    test = f"(?i){pattern}"
    d = cases.filter(F.col("norm_text").rlike(test)).withColumn("m", F.regexp_extract("norm_text", f"(?i)({pattern})", 1)).withColumn("i", F.regexp_instr("norm_text", F.lit(test)))
    first = F.greatest(F.col("i") - width, F.lit(1))
    return d.select("case_id", (F.col("i") - 1).alias("span_start"), (F.col("i") - 1 + F.length("m")).alias("span_end"), F.substr("norm_text", first, F.col("i") + F.length("m") + width - first).alias("matched_text"))


def cell_counts(cases: DataFrame) -> DataFrame:
    return cases.groupBy("era", "jurisdiction").agg(F.count("*").alias("n"))


def rate_per_thousand(matches: Column, docs: Column) -> Column:
    return F.when(docs > 0, F.round(1000 * matches / docs, 3))


def concordance(cases: DataFrame, hits: DataFrame) -> DataFrame:
    """era, jurisdiction, docs, matches and rate per 1,000 for every cell of cases, in one pass; hits: case_id, each once. No text is read."""
    d = cases.select("case_id", "era", "jurisdiction").join(hits.select("case_id", F.lit(True).alias("hit")), "case_id", "left")
    out = d.groupBy("era", "jurisdiction").agg(F.count("*").alias("docs"), F.count("hit").alias("matches"))
    return out.withColumn("rate", rate_per_thousand(F.col("matches"), F.col("docs")))


def era_table(cells: DataFrame, eras: list[str]) -> DataFrame:
    """era_order, era, docs, matches and rate of the given eras in order, zero-filled; cells has docs and matches."""
    dim = cells.sparkSession.createDataFrame(list(enumerate(eras)), "era_order int, era string")
    sums = cells.groupBy("era").agg(F.sum("docs").alias("docs"), F.sum("matches").alias("matches"))
    out = F.broadcast(dim).join(sums, "era", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("docs", "matches")})
    return out.withColumn("rate", rate_per_thousand(F.col("matches"), F.col("docs")))


def earliest(cases: DataFrame, phrases: list[str], n: int, width: int = 40) -> DataFrame:
    """The n earliest dated matches by (year, case_id), with the first match in brackets and `width` characters around it."""
    d = matching(cases, phrases).filter("year is not null")
    pattern = "|".join(phrase_pattern(p) for p in phrases)
    m = F.regexp_extract("norm_text", f"({pattern})", 1)
    top = d.select("case_id", "year", "jurisdiction", "norm_text").orderBy("year", "case_id").limit(n)
    top = top.withColumn("m", m).withColumn("i", F.regexp_instr("norm_text", F.lit(pattern)))
    first = F.greatest(F.col("i") - width, F.lit(1))
    shown = F.concat(F.substr("norm_text", first, F.col("i") - first), F.lit("["), "m", F.lit("]"), F.substr("norm_text", F.col("i") + F.length("m"), F.lit(width)))
    return top.select("case_id", "year", "jurisdiction", shown.alias("snippet"))


def kwic(cases: DataFrame, term: str, n: int, width: int = 60) -> DataFrame:
    """The first hit of each of the first n cases (by case_id) that hold the term as text: what stands left and right of it."""
    d = cases.filter(F.contains("norm_text", F.lit(term))).select("case_id", "norm_text").orderBy("case_id").limit(n).withColumn("i", F.locate(term, F.col("norm_text")))
    first = F.greatest(F.col("i") - width, F.lit(1))
    return d.select("case_id", F.substr("norm_text", first, F.col("i") - first).alias("left"), F.lit(term).alias("term"), F.substr("norm_text", F.col("i") + len(term), F.lit(width)).alias("right"))


def kwic_of_hits(cases: DataFrame, spans: DataFrame, n: int, width: int = 60, eras: list[str] | None = None, jurisdictions: list[str] | None = None) -> DataFrame:
    """kwic of token hits (spans: case_id, first, last): the first span of each of the first n cases (by case_id) of the given eras and jurisdictions. Texts are read for those n only."""
    wanted = cases.select("case_id", "era", "jurisdiction")
    for column, values in (("era", eras), ("jurisdiction", jurisdictions)):
        wanted = wanted.filter(F.col(column).isin(values)) if values is not None else wanted
    first = spans.groupBy("case_id").agg(F.min(F.struct("first", "last")).alias("s")).join(wanted, "case_id", "left_semi").orderBy("case_id").limit(n)
    at = character_spans(cases, first.select("case_id", "s.first", "s.last"), raw=False)
    d = cases.select("case_id", "norm_text").join(F.broadcast(at), "case_id")  # n rows
    begin = F.greatest(F.col("start") - width, F.lit(0))
    return d.select("case_id", F.substr("norm_text", begin + 1, F.col("start") - begin).alias("left"), F.substr("norm_text", F.col("start") + 1, F.col("end") - F.col("start")).alias("term"), F.substr("norm_text", F.col("end") + 1, F.lit(width)).alias("right"))


def collocates(cases: DataFrame, term: str, n: int, width: int = 80, docs: int | None = None) -> DataFrame:
    """word and n: the n commonest words of more than two letters a-z within `width` characters of any occurrence of the term.

    Stop words and the term are left out; docs, where given, is the number of cases (lowest ids first) that are looked at.
    Occurrences are found by splitting at the term, so each piece but the last gives its end and each but the first its beginning.
    """
    d = cases.filter(F.contains("norm_text", F.lit(term))).select("case_id", "norm_text")
    d = d.orderBy("case_id").limit(docs) if docs else d
    place = F.aggregate("parts", F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("all")), lambda acc, p: F.struct((acc["at"] + F.length(p) + len(term)).alias("at"), F.concat(acc["all"], F.array(acc["at"] + F.length(p))).alias("all")))
    places = d.withColumn("parts", F.split("norm_text", re.escape(term))).withColumn("i", F.explode(F.slice(place["all"], 1, F.size("parts") - 1)))
    first = F.greatest(F.col("i") - width, F.lit(1))
    span = F.substr("norm_text", first, F.col("i") + len(term) + width - first)
    words = places.select(F.explode(F.regexp_extract_all(span, F.lit("[a-z]+"), 0)).alias("word"))
    words = words.filter((F.length("word") > 2) & (F.col("word") != term) & ~F.col("word").isin(STOPWORDS))
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(n)


def frequency_pivot(cases: DataFrame, hits: DataFrame, eras: list[str]) -> DataFrame:
    """Matches of each jurisdiction by era, one column an era; hits: case_id."""
    d = cases.select("case_id", "era", "jurisdiction").join(hits, "case_id", "left_semi")
    return d.groupBy("jurisdiction").pivot("era", eras).agg(F.count("case_id")).fillna(0)


def first_per_case(rows: DataFrame, *order: Column) -> DataFrame:
    """One row a case: the first in the order."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy("case_id").orderBy(*order))).filter("_r = 1").drop("_r")
