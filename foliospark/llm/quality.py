"""Quality rules with risk-controlled thresholds.

Every rule is an integer per-mille statistic of a whole text ("high is bad") and a fixed grid of cutoffs from lenient to
strict. Labelled good documents are the holdout. In each stratum a cutoff is accepted while an exact binomial
(Clopper-Pearson) bound shows that it rejects at most `alpha / rules` of the good documents; tests inside a grid run in
fixed order and stop at the first failure, and the level `delta` is split over strata and rules (Bonferroni). So with
probability 1 - delta, in every stratum at once, at most `alpha` of the good documents are rejected by any rule. A stratum
with too few labels to show that gets no cutoff and loses nothing to these rules.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.textbytes import IS_SEPARATOR, Texts, freed, slices, windows
from foliospark.session import spread, table, written

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True

STATS = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_upper n_bang n_adjacent".split()
#: rule: (numerator, denominator); the statistic is 1000 * numerator div denominator.
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "repeats": ("n_repeat_words", "n_words"),
    "adjacent": ("n_adjacent", "n_words"),
    "upper": ("n_upper", "word_chars"),
    "bangs": ("n_bang", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
}
#: Cutoffs in per mille, lenient first. A document fails a rule when its statistic is above the cutoff.
GRID = (900, 800, 700, 600, 500, 400, 350, 300, 250, 200, 150, 100, 75, 50)


def _run_lengths(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each element, true if an equal value of the same text comes before it."""
    order = np.lexsort((value, doc))
    same = (doc[order][1:] == doc[order][:-1]) & (value[order][1:] == value[order][:-1])
    out = np.zeros(len(doc), bool)
    out[order[1:]] = same
    return out


def _stats(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    t = Texts(data, offsets)
    h = t.word_hashes()
    per = lambda flags: np.bincount(t.doc[flags], minlength=t.n)
    codepoint = (data & 0xC0) != 0x80
    out = {
        "n_words": t.n_words,
        "word_chars": t.counts(codepoint & ~IS_SEPARATOR[data]),
        "n_symbols": t.counts(IS_SYMBOL[data]),
        "n_upper": t.counts((data >= 65) & (data <= 90)),
        "n_bang": t.counts(data == 33),
    }
    repeated = np.zeros(len(h) + 1, np.int64)  # difference array over words
    w = windows(h, 8)
    if len(w):
        at = np.flatnonzero(t.doc[: len(w)] == t.doc[7:])
        later = _run_lengths(t.doc[at], w[at])
        earlier = _run_lengths(t.doc[at][::-1], w[at][::-1])[::-1]
        hits = at[later | earlier]
        np.add.at(repeated, hits, 1)
        np.add.at(repeated, hits + 8, -1)
    out["n_repeat_words"] = per(np.cumsum(repeated[:-1]) > 0)
    adjacent = np.zeros(len(h), bool)
    if len(h):
        adjacent[1:] = (h[1:] == h[:-1]) & (t.doc[1:] == t.doc[:-1])
    out["n_adjacent"] = per(adjacent)
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(offsets[:-1], breaks + 1)
    starts = starts[starts < len(data)]
    ends = np.minimum(np.r_[starts[1:], len(data)], np.r_[breaks, len(data)][np.searchsorted(breaks, starts)])
    worded = np.searchsorted(t.start, ends) > np.searchsorted(t.start, starts)
    starts, ends = starts[worded], ends[worded]
    line_doc = np.searchsorted(offsets, starts, "right") - 1
    out["n_lines"] = np.bincount(line_doc, minlength=t.n)
    out["n_dup_lines"] = np.bincount(line_doc[_run_lengths(line_doc, t.hashes(starts, ends))], minlength=t.n)
    return out


def text_statistics(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text, lang): doc_id, stratum and the counts in STATS, of whole texts.

    A null or empty text counts zero everywhere; a null lang is the stratum ''. Repeated rows stay repeated. Other columns
    of docs are ignored, whatever their names. Words are compared by 64-bit hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text")):
                s = _stats(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[lo:hi], batch.column("stratum")[lo:hi], *(pa.array(s[k].astype(np.int64)) for k in STATS)],
                    ["doc_id", "stratum", *STATS],
                )

    schema = "doc_id long, stratum string, " + ", ".join(f"{k} long" for k in STATS)
    return docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("stratum")).mapInArrow(freed(run), schema)


def with_rules(stats: DataFrame) -> DataFrame:
    """Adds a column r_<rule> with each per-mille statistic; 0 where the denominator is 0."""
    return stats.withColumns(
        {f"r_{k}": F.when(F.col(d) > 0, F.floor(F.col(n) * 1000 / F.col(d))).otherwise(0).cast("long") for k, (n, d) in RULES.items()}
    )


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed exactly in logarithms. The Clopper-Pearson bound of k of n at level d is at most p if and only if this is at most d."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def risk_controlled_cutoffs(
    good: DataFrame, rules: list[str], grid: tuple[int, ...] = GRID, alpha: float = 0.1, delta: float = 0.1
) -> DataFrame:
    """(stratum, rule, cutoff, n, k): the strictest cutoff of each rule and stratum that holds the risk; no row where none does.

    good: labelled good rows with `stratum` and a column r_<rule> for each rule. Every stratum is tested by itself. One whose
    bound would fail with no rejection at all, by its number of rows, isn't tested and takes no share of delta; so only counts of strata
    of some hundred rows reach the driver. An empty holdout gives no cutoffs: nothing may be rejected then.
    """
    spark, p = good.sparkSession, alpha / len(rules)
    counts = good.groupBy("stratum").agg(
        F.count("*").alias("n"), *(F.count_if(F.col(f"r_{r}") > c).alias(f"{r}:{c}") for r in rules for c in grid)
    )
    can_pass = lambda n, strata: binomial_tail(0, n, p) <= delta / (strata * len(rules))
    rows = counts.filter(F.col("n") >= math.floor(math.log(delta / len(rules)) / math.log1p(-p))).collect()
    rows.sort(key=lambda r: (-r["n"], r["stratum"]))
    rows = rows[: max((i for i, r in enumerate(rows, 1) if can_pass(r["n"], i)), default=0)]
    level = delta / max(1, len(rows) * len(rules))
    found = []
    for row in rows:
        for rule in rules:
            best = None
            for c in grid:
                k = row[f"{rule}:{c}"]
                if binomial_tail(k, row["n"], p) > level:
                    break
                best = (row["stratum"], rule, c, row["n"], k)
            if best:
                found.append(best)
    return spark.createDataFrame(found, "stratum string, rule string, cutoff int, n long, k long")


def quality_verdicts(docs: DataFrame, labels: DataFrame, alpha: float = 0.1, delta: float = 0.1) -> DataFrame:
    """doc_id, stratum, the counts, base_failed, failed (rules above their cutoff) and kept, for every row of docs.

    base_failed: fewer than 20 words, or more than 30 % of the words in repeated 8-word windows. kept is false if base_failed,
    else the verdict of the risk-controlled rules. Label rows of unknown documents, null labels and repeated label rows change
    nothing (a document is good if all its non-null labels are 1). The holdout is every labelled good document that passes the base rules.
    """
    stats = written(with_rules(text_statistics(docs)), "quality-stats")
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    stats = stats.withColumn("base_failed", base)
    good = labels.filter("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1").select("doc_id")
    cutoffs = risk_controlled_cutoffs(stats.filter(~F.col("base_failed")).join(good, "doc_id", "left_semi"), list(RULES), alpha=alpha, delta=delta)
    by_stratum = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts"))
    joined = stats.join(F.broadcast(by_stratum), "stratum", "left")  # one row a stratum that was tested; others have no cutoff
    failed = F.array_compact(F.array(*(F.when(F.col(f"r_{r}") > F.col("cuts")[r], F.lit(r)) for r in RULES)))
    joined = joined.withColumn("failed", failed)
    return joined.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)).select("doc_id", "stratum", *STATS, "base_failed", "failed", "kept")


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = quality_verdicts(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.concat_ws(",", "failed").alias("failed"))
