"""Checking quotes against texts: verbatim by substring, else by the most similar window, with the place in the raw text and its page."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from foliospark.functions import text as T
from foliospark.functions.offsets import normalised_places

FUZZY = 92.0  # least score of a quote that isn't verbatim


def page_for_offset(page_map: Column, offset: Column) -> Column:
    """The label of the last page that starts at or before the offset, the first page's for earlier ones."""
    before = F.filter(page_map, lambda p: p["offset"] <= offset)
    return F.coalesce(F.try_element_at(before, F.lit(-1))["label"], F.try_element_at(page_map, F.lit(1))["label"])


def _commons(masks: dict[str, int], n: int, other: str) -> list[int]:
    """Lengths of the longest common subsequences of a text, given as the bits of its letters' places, and each beginning of another; one addition a letter."""
    full = (1 << n) - 1
    state = full
    out = []
    for c in other:
        hit = state & masks.get(c, 0)
        state = ((state + hit) | (state - hit)) & full
        out.append(n - state.bit_count())
    return out


def _masks(text: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(text):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def similarity(quote: str, window: str, least: float = 0.0) -> float:
    """100 * the best indel similarity of the shorter text with a part of its length of the longer, or a shorter part at its ends; where that isn't above `least`, `least`.

    From one part of full length to the next the common subsequence grows by one at most, so parts that can't be better are passed over.
    A shorter part at an end has no more in common than the full one there.
    """
    short, long = sorted((quote, window), key=len)
    n, best = len(short), least
    if not n:
        return best
    masks, full = _masks(short), len(long) - n
    i, first, last = 0, n, n
    while i <= full:
        common = _commons(masks, n, long[i : i + n])[-1]
        first, last = common if i == 0 else first, min(n, common + full - i)
        best = max(best, 100.0 * common / n)
        i += max(1, int(best * n / 100) - common)
    for most, ends, text in ((first, masks, long), (last, None, long[::-1])):
        if 200.0 * most / (n + most) > best:
            for k, common in enumerate(_commons(ends or _masks(short[::-1]), n, text[: n - 1]), 1):
                best = max(best, 200.0 * common / (n + k))
    return best


def _spoiled(n: int) -> int:
    """How many runs of three letters of a text of n letters can be missing from one that reaches FUZZY with it.

    a letters lost spoil three each, b <= a added two each, where a + b is at most 1 - FUZZY / 100 of the letters of both.
    """
    share = 1 - FUZZY / 100
    lost = range(int(2 * n * share / (1 + share) + 1e-9) + 1)
    return max((3 * a + 2 * min(a, int((2 * n * share - (1 + share) * a) / (1 - share) + 1e-9)) for a in lost), default=0)


_KINDS = 1 << 16


def _runs(text: str) -> np.ndarray:
    """A number below _KINDS for each three letters in a row: equal runs have equal ones."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return (((c[:-2] << 42 | c[1:-1] << 21 | c[2:]) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)


def best_window(quote: str, text: str, runs: np.ndarray) -> tuple[int, float] | None:
    """Place (from 0) and score of the first best window that reaches FUZZY, if any does. runs: those of the text.

    Windows begin every quarter of the quote (20 characters at least) and are a step longer than it. One that holds too few of the quote's
    runs of three letters for FUZZY isn't scored; of a text shorter than the quote, its own runs are looked for in the quote.
    """
    n, step = len(quote), max(20, len(quote) // 4)
    starts = np.arange(0, max(0, len(text) - n) + 1, step)
    short = min(n, len(text))
    need = short - 2 - _spoiled(short)
    if need > 0:
        own = np.zeros(_KINDS, bool)
        own[_runs(quote)] = True
        held = np.concatenate(([0], np.cumsum(own[runs])))
        ends = np.minimum(starts + n + step - 2, len(runs))
        starts = starts[held[ends] - held[starts] >= need]
    found, best = None, math.nextafter(FUZZY, 0)
    for at in starts.tolist():
        score = similarity(quote, text[at : at + n + step], best)
        if score > best:
            found, best = (at, score), score
            if score == 100:
                break
    return found


@F.pandas_udf(StructType([StructField("at", IntegerType()), StructField("score", DoubleType())]))
def _best_windows(quote: pd.Series, text: pd.Series) -> pd.DataFrame:
    out, last, runs = [], None, None
    for q, t in zip(quote, text, strict=True):
        if t and q and t != last:  # a case's quotes come one after another
            last, runs = t, _runs(t) if len(t) > 2 else np.zeros(0, np.int64)
        out.append((t and q and best_window(q, t, runs)) or (None, None))
    return pd.DataFrame(out, columns=["at", "score"]).astype({"at": "Int32", "score": "float64"})


@F.pandas_udf(StructType([StructField("raw_start", IntegerType()), StructField("raw_end", IntegerType())]))
def _raw_spans(raw: pd.Series, place: pd.Series, length: pd.Series, verbatim: pd.Series) -> pd.DataFrame:
    out, last, places = [], None, None
    for text, at, n, exact in zip(raw, place, length, verbatim, strict=True):
        if text is not None and text != last:
            last, places = text, normalised_places(text)
        if text is None or not len(places):
            out.append((None, None))
            continue
        start = int(places[min(int(at), len(places) - 1)])
        out.append((start, int(places[min(int(at + n), len(places)) - 1]) + 1 if exact else start + int(n)))
    return pd.DataFrame(out, columns=["raw_start", "raw_end"]).astype("Int32")


def checked_quotes(quotes: DataFrame, cases: DataFrame) -> DataFrame:
    """quotes (case_id, quote_id, text) with status (verified, verified-fuzzy, failed), place (from 0, in the normalised text), score, raw_start, raw_end and page.

    cases: case_id, raw_text, norm_text and page_map (array of offset and label). The span of a verbatim quote ends with its last character, that of a fuzzy one after
    as many characters as the quote has. Texts meet their quotes in one join; only quotes that aren't verbatim are looked for in windows, and only texts of verified quotes get their offsets.
    """
    d = quotes.select("case_id", "quote_id", F.coalesce(T.normalise(F.col("text")), F.lit("")).alias("q")).join(cases.select("case_id", "norm_text", "raw_text", "page_map"), "case_id", "left")
    d = d.withColumn("place", F.when(F.col("q") != "", F.coalesce(F.expr("locate(q, norm_text)"), F.lit(0))).otherwise(0) - 1)
    verbatim = F.col("place") >= 0
    d = d.withColumn("best", _best_windows("q", F.when(~verbatim & (F.col("q") != ""), F.col("norm_text")))).drop("norm_text")
    d = d.withColumn("status", F.when(verbatim, "verified").when(F.col("best.score").isNotNull(), "verified-fuzzy").otherwise("failed"))
    d = d.withColumn("score", F.when(verbatim, 100.0).otherwise(F.col("best.score"))).withColumn("place", F.when(verbatim, F.col("place")).otherwise(F.col("best.at")))
    d = d.withColumn("span", _raw_spans(F.when(F.col("place").isNotNull(), F.col("raw_text")), F.coalesce("place", F.lit(0)), F.length("q"), F.col("status") == "verified"))
    start = F.col("span.raw_start")
    return d.select("case_id", "quote_id", "status", "place", "score", start.alias("raw_start"), F.col("span.raw_end").alias("raw_end"), F.when(start.isNotNull(), page_for_offset(F.col("page_map"), start)).alias("page"))
