"""Review: why records are asked about, the queue, sheets and decisions."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: The reasons in order of priority, with the sections of their cards; cards of re-read conflicts come before all.
REASONS = {"favorable_under_thirty": "A", "householder_nights": "B", "checker_disagreement": "C", "polarity_mixed": "D", "gate_erased": "E", "fuzzy_quote": "F"}
CONFLICT, CONFLICT_SECTION = "reread_conflict", "G"
FLAG = "needs-review:"
CAP = 150


def queue_reasons() -> Column:
    """Why a record is asked about, in order of priority; none if it isn't relevant or is a parallel copy.

    Reads relevant, duplicate_of, polarity, under_thirty_days, who_was_letting, duration_of_occupancy, checker_field (the first field that the checker contradicts), nulled (the first field that the gate emptied) and fuzzy_needs_human.
    """
    tests = (
        (F.col("polarity") == "favorable") & (F.col("under_thirty_days") == "yes"), (F.col("who_was_letting") == "householder") & (F.col("duration_of_occupancy") == "nights"),
        F.col("checker_field").isNotNull(), F.col("polarity") == "mixed", F.coalesce("nulled", F.lit("")) != "", F.col("fuzzy_needs_human"),
    )
    found = F.array_compact(F.array(*(F.when(t, k) for k, t in zip(REASONS, tests, strict=True))))
    return F.when(F.col("relevant") & F.col("duplicate_of").isNull(), found).otherwise(F.array().cast("array<string>"))


def decide_field(reason: Column) -> Column:
    """The field that a card of this reason decides."""
    return F.when(reason == "householder_nights", "who_was_letting").when(reason == "checker_disagreement", F.col("checker_field")).when(reason == "gate_erased", F.col("nulled")).when(reason == "fuzzy_quote", "quotes").otherwise("polarity")


def review_queue(records: DataFrame, conflicts: DataFrame, cap: int = CAP) -> DataFrame:
    """case_id, section, reason, other_reasons, decide_field and deferred of all cards: the first `cap` by (section, case_id, field) are shown, conflicts first.

    records: the columns of queue_reasons, reviewed and flags (text). A record without review has one card, of its first reason. conflicts: case_id, field; each has a card while its flag stands on a record that is neither withdrawn nor a copy.
    """
    d = records.withColumn("reasons", queue_reasons()).filter(~F.col("reviewed") & (F.size("reasons") > 0)).withColumn("reason", F.col("reasons")[0])
    section = F.element_at(F.create_map(*(F.lit(x) for kv in REASONS.items() for x in kv)), F.col("reason"))
    cards = d.select("case_id", section.alias("section"), "reason", F.slice("reasons", 2, 9).alias("other_reasons"), decide_field(F.col("reason")).alias("decide_field"))
    asked = conflicts.select("case_id", "field").distinct().join(records.select("case_id", "flags", "relevant", "duplicate_of"), "case_id")
    asked = asked.filter(F.contains("flags", F.concat(F.lit(FLAG), "field")) & F.coalesce("relevant", F.lit(True)) & F.col("duplicate_of").isNull())
    cards = cards.unionByName(asked.select("case_id", F.lit(CONFLICT_SECTION).alias("section"), F.lit(CONFLICT).alias("reason"), F.array().cast("array<string>").alias("other_reasons"), F.col("field").alias("decide_field")))
    order = [(F.col("section") != CONFLICT_SECTION), F.col("section"), F.col("case_id"), F.col("decide_field")]
    shown = cards.orderBy(*order).limit(cap).select("case_id", "reason", "decide_field", F.lit(False).alias("deferred"))
    return cards.join(shown, ["case_id", "reason", "decide_field"], "left").withColumn("deferred", F.coalesce("deferred", F.lit(True)))


def empty_cells(grid: DataFrame, tier: str, least: int) -> DataFrame:
    """Cells whose count of a tier is below the least."""
    return grid.filter(F.col(tier) < least)


COVERAGE, LONGEST_MISS = 0.92, 4  # of a quote that differs from its source as scanning does


@F.pandas_udf(StringType())
def _fuzzy_class(quote: pd.Series, source: pd.Series) -> pd.Series:
    def one(q: str | None, s: str | None) -> str:
        a, b = (" ".join(re.findall("[a-z0-9]+", (x or "").lower())) for x in (q, s))
        found = difflib.SequenceMatcher(a=a, b=b, autojunk=True).get_opcodes()
        lost = [i2 - i1 for op, i1, i2, _, _ in found if op in ("replace", "delete")]
        return "trivial-ocr" if 1 - sum(lost) / max(1, len(a)) >= COVERAGE and max(lost, default=0) <= LONGEST_MISS else "needs-human"

    return pd.Series([one(q, s) for q, s in zip(quote, source, strict=True)])


def fuzzy_classes(quotes: DataFrame) -> DataFrame:
    """quotes (case_id, quote, source) with classification: trivial-ocr if nearly all of the quote is in the source and no run of more than LONGEST_MISS characters is missing, else needs-human."""
    return quotes.withColumn("classification", _fuzzy_class("quote", "source"))


def source_windows(quotes: DataFrame, pad: int = 140) -> DataFrame:
    """quotes (case_id, quote, text, clean) with source: the quote's place in the text with `pad` characters on both sides, or the text's beginning without a quote. A quote that isn't verbatim has the window that quotes.fuzzy_windows finds, which the caller joins."""
    at = F.expr("locate(quote, text)")
    first = F.greatest(F.lit(1), at - pad)
    window = F.substr("text", first, at + F.length("quote") + pad - first)
    return quotes.withColumn("source", F.when(F.coalesce("quote", F.lit("")) == "", F.substring(F.coalesce("text", F.lit("")), 1, 1200)).when(at > 0, window))


def auto_accepted(classified: DataFrame) -> DataFrame:
    """classified (classification, clean) with auto_accepted: a trivial difference on a record that the gate left whole."""
    return classified.withColumn("auto_accepted", F.col("clean") & (F.col("classification") == "trivial-ocr"))


def legacy_lists(records: DataFrame, disagreements: DataFrame, fuzzy: DataFrame, earlier: DataFrame) -> DataFrame:
    """list, case_id, detail and verdict: fuzzy quotes with their earlier verdicts (case_id, quote, verdict), each disagreement once, relevant records whose polarity was emptied, and favorable householders by the night."""
    old = earlier.groupBy("case_id", "quote").agg(F.min("verdict").alias("verdict"))
    row = lambda df, name, detail, verdict: df.select(F.lit(name).alias("list"), "case_id", detail.cast("string").alias("detail"), verdict.cast("string").alias("verdict"))
    none = F.lit(None)
    out = row(fuzzy.join(old, ["case_id", "quote"], "left"), "fuzzy", F.col("quote"), F.col("verdict"))
    out = out.unionByName(row(disagreements.dropDuplicates(["case_id", "field", "batch_id"]), "disagreement", F.col("field"), none))
    out = out.unionByName(row(records.filter("relevant and polarity_nulled"), "nulled", F.lit("polarity"), none))
    return out.unionByName(row(records.filter("relevant and polarity = 'favorable' and who_was_letting = 'householder' and duration_of_occupancy = 'nights'"), "householder-nights", none, none))


def threeway(cards: DataFrame, a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cards with both readers' labels and whether they agree, agree and disagree counts by section), of cards (case_id, section, field) and labels (case_id, field, label); a reader without one reads MISSING."""
    side = lambda df, k: df.groupBy("case_id", "field").agg(F.min("label").alias(k))
    d = cards.join(side(a, "a"), ["case_id", "field"], "left").join(side(b, "b"), ["case_id", "field"], "left").fillna("MISSING", ["a", "b"])
    d = d.withColumn("agree", (F.col("a") == F.col("b")) & (F.col("a") != "MISSING"))
    return d, d.groupBy("section").agg(F.count_if("agree").alias("agree"), F.count_if(~F.col("agree")).alias("disagree"))


def erased_values(records: DataFrame, raw: DataFrame) -> DataFrame:
    """(case_id, field, value) of emptied fields (nulled_fields) whose value the raw response (case_id, record as JSON) still has."""
    d = records.select("case_id", F.explode("nulled_fields").alias("field")).join(raw, "case_id")
    return d.withColumn("value", F.try_element_at(F.from_json("record", "map<string,string>"), F.col("field"))).filter("value is not null").select("case_id", "field", "value")


#: Words by which a later court treats a decision negatively.
NEGATIVE = r"(?i)overrul\w+|abrogat\w+|disapprov\w+|superseded|no longer good law|declined? to follow|reject\w+ the (reasoning|analysis|holding) of|reversed"


def negative_treatment(passages: DataFrame) -> DataFrame:
    return passages.filter(F.col("passage").rlike(NEGATIVE))


def prescreen_targets(records: DataFrame) -> DataFrame:
    """Distinct cases that are favorable householders by the night, or bear a flag of abrogation risk."""
    night = (F.col("polarity") == "favorable") & (F.col("who_was_letting") == "householder") & (F.col("duration_of_occupancy") == "nights")
    return records.filter(F.coalesce(night, F.lit(False)) | F.exists("flags", lambda x: x.startswith("abrogation-risk"))).select("case_id").distinct()


def contested(votes: DataFrame) -> DataFrame:
    """case_id, field, majority (ties by text), majority_n, non_null_n and candidates (reader, value, sorted) of fields on which readers (case_id, field, reader, value) gave more than one value."""
    counts = votes.filter("value is not null").groupBy("case_id", "field", "value").agg(F.count("*").alias("k"))
    best = counts.groupBy("case_id", "field").agg(F.min(F.struct(-F.col("k"), F.col("value"), F.col("k").alias("n"))).alias("b"), F.count("*").alias("kinds")).filter("kinds > 1")
    listed = votes.groupBy("case_id", "field").agg(F.array_sort(F.collect_list(F.struct("reader", "value"))).alias("candidates"), F.count("value").alias("non_null_n"))
    return listed.join(best, ["case_id", "field"]).select("case_id", "field", F.col("b.value").alias("majority"), F.col("b.n").alias("majority_n"), "non_null_n", "candidates")
