"""Evaluation: labels of decisions, what was missed and where, tails, audits, candidate readers, reference sets, gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators.evidence import score_band
from foliospark.operators.numbering import numbered

#: Labels of decisions that name no value; the tail yield observed once; reads that a band needs.
WITHDRAWN, UNSURE = "withdrawn", "unsure"
OBSERVED_TAIL_YIELD, BAND_READS = 0.11, 200
AUDIT_FIELDS = ("relevant", "polarity", "who_was_letting")
FIRST_LATE_YEAR = 1990  # from which gold isn't used


def effective_label(field: Column, decision: Column, value: Column, card_value: Column, checker_value: Column) -> Column:
    """What a decision makes of its field: withdrawn, unsure, the card's value (keep), the checker's (adopt) or its own. All are texts; an absent value reads None.

    Adopting a contradiction of relevance withdraws, unless the checker has another value; so does setting it to false.
    """
    no = lambda c: F.lower(c) == "false"
    told = lambda c: F.coalesce(c, F.lit("None"))
    relevant = field == "relevant"
    return (
        F.when(relevant & (decision == "adopt"), F.when(checker_value.isNull() | no(checker_value), WITHDRAWN).otherwise(checker_value))
        .when(relevant & (decision == "set") & F.coalesce(no(value), F.lit(False)), WITHDRAWN)
        .when(decision == "unsure", UNSURE)
        .when(decision == "keep", told(card_value))
        .when(decision == "adopt", told(checker_value))
        .otherwise(told(value))
    )


def labels_by_field(decisions: DataFrame, fields: list[str]) -> DataFrame:
    """(case_id, field, label) of decisions (case_id, field, label): a withdrawal of relevance labels every field of its case."""
    gone = decisions.filter((F.col("field") == "relevant") & (F.col("label") == WITHDRAWN)).select("case_id").distinct()
    spread = gone.select("case_id", F.explode(F.array(*map(F.lit, fields))).alias("field"), F.lit(WITHDRAWN).alias("label"))
    return decisions.join(gone, "case_id", "left_anti").select("case_id", "field", "label").unionByName(spread)


def lost_at(signaled: Column, read: Column, withdrawn: Column) -> Column:
    """The stage at which a gold case was lost: read is null (never read), 'failed' or the unit that read it."""
    return F.when(~F.coalesce(signaled, F.lit(False)), "unsignaled").when(read.isNull(), "unread").when(read == "failed", "read-failed").when(withdrawn, WITHDRAWN).otherwise("reader-negative")


def bands_table(batches: DataFrame, units: DataFrame) -> DataFrame:
    """batch_id, cell, score (mean, 6 places), cases, read and relevant of batches (batch_id, era, jurisdiction, scores: array), by the units (unit_id, status, relevant_accepted) that are ok."""
    n = F.size("scores")
    score = F.when(n > 0, F.aggregate("scores", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))) / n).otherwise(0.0)
    ok = units.filter("status = 'ok'").groupBy(F.col("unit_id").alias("batch_id")).agg(F.max("relevant_accepted").alias("relevant"))
    d = batches.select("batch_id", F.concat_ws("|", "era", "jurisdiction").alias("cell"), F.round(score, 6).alias("score"), n.alias("cases")).join(ok.withColumn("read", F.lit(True)), "batch_id", "left")
    return d.select("batch_id", "cell", "score", "cases", F.coalesce("read", F.lit(False)).alias("read"), "relevant")


def band_counts(bands: DataFrame) -> DataFrame:
    """band, read_cases, relevant and unread_cases of a bands table."""
    return bands.groupBy(score_band(F.col("score")).alias("band")).agg(
        F.sum(F.when(F.col("read"), F.col("cases")).otherwise(0)).alias("read_cases"), F.sum(F.when(F.col("read"), F.coalesce("relevant", F.lit(0))).otherwise(0)).alias("relevant"), F.sum(F.when(F.col("read"), 0).otherwise(F.col("cases"))).alias("unread_cases")
    )


def tail_scenarios(counts: DataFrame) -> DataFrame:
    """scenario and the relevant cases it expects among the unread: at the rate of the lowest band with BAND_READS reads, at half of it, and at the yield observed once. No rows without such a band."""
    total = counts.agg(F.sum("unread_cases").alias("unread"), F.min(F.when(F.col("read_cases") >= BAND_READS, F.struct("band", "relevant", "read_cases"))).alias("low")).filter("low is not null")
    rate = F.col("low.relevant") / F.col("low.read_cases")
    rows = F.array(*(F.struct(F.lit(k).alias("scenario"), F.bround(F.col("unread") * x).cast("long").alias("expected")) for k, x in (("lowest-read-band", rate), ("half-lowest-read-band", rate / 2), ("observed", F.lit(OBSERVED_TAIL_YIELD)))))
    return total.select(F.explode(rows).alias("s")).select("s.*")


def audit_draw(frame: DataFrame, n: int, seed: str) -> DataFrame:
    """n cases of the frame (case_id and what the record holds) in keyed order, with draw (their place). A frame of fewer cases fails the job."""
    size = frame.agg(F.count("*").alias("frame_size"))
    drawn = frame.orderBy(F.md5(F.concat_ws("|", F.lit(seed), "case_id")), "case_id").limit(n)
    ok = F.when(F.col("frame_size") >= n, F.col("frame_size")).otherwise(F.raise_error(F.lit("the frame is smaller than the sample")).cast("long"))
    drawn = drawn.crossJoin(F.broadcast(size)).withColumn("frame_size", ok)
    return drawn.withColumn("draw", F.row_number().over(Window.orderBy(F.md5(F.concat_ws("|", F.lit(seed), "case_id")), "case_id")))  # n rows


def audit_outcomes(sample: DataFrame, decisions: DataFrame, fields: tuple[str, ...] = AUDIT_FIELDS) -> DataFrame:
    """Per sampled case its draw-time fields, and from decisions (case_id, reader, field, decision, value, initial_value) each reader's values, the user's first and final ones, and status: decided if the user set relevance."""
    value = lambda reader, f, column: F.max(F.when((F.col("reader") == reader) & (F.col("field") == f), F.col(column)))
    first = F.coalesce("initial_value", "value")
    d = decisions.withColumn("first", first).groupBy("case_id").agg(
        *(value(r, f, "value").alias(f"{r}_{f}") for r in ("a", "b") for f in fields), *(value("user", f, "first").alias(f"initial_{f}") for f in fields), *(value("user", f, "value").alias(f"final_{f}") for f in fields),
        F.coalesce(F.bool_or((F.col("reader") == "user") & (F.col("field") == "relevant") & (F.col("decision") == "set")), F.lit(False)).alias("decided"),
    )
    d = sample.select("case_id", *(F.col(f).alias(f"drawn_{f}") for f in fields)).join(d, "case_id", "left")
    decided = F.coalesce("decided", F.lit(False))
    users = {f"{k}_{f}": F.when(decided, F.col(f"{k}_{f}")) for k in ("initial", "final") for f in fields}
    return d.withColumns(users).withColumn("status", F.when(decided, "decided").otherwise("unresolved")).drop("decided")


def composite(measures: dict[str, DataFrame]) -> DataFrame:
    """measure, n_rows and digest of each table of measures: the SHA-256 of the sorted digests of its rows' JSON, in 256 buckets."""
    out = None
    for name, df in sorted(measures.items()):
        rows = df.select(F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256).alias("h"))
        buckets = rows.groupBy(F.substring("h", 1, 2).alias("b")).agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ","), 256).alias("h"))
        one = buckets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "h"))), lambda x: x["h"]), ","), 256).alias("digest")).select(F.lit(name).alias("measure"), "n_rows", "digest")
        out = one if out is None else out.unionByName(one)
    return out


def candidate_score(records: DataFrame, reference: DataFrame, units: DataFrame) -> DataFrame:
    """One row about a reader: fidelity (kept of all quotes of relevant records), agreement_machine_irrelevant, compliance, accepted, accepted_full, missing and cost_per_accepted (null without a price or an accepted record).

    records: case_id, extraction_status, relevant, n_kept, n_dropped. reference: case_id, source. units: cost (null where unpriced).
    """
    there = F.col("extraction_status") != "missing"
    r = records.agg(
        F.sum(F.when(F.col("relevant"), F.col("n_kept")).otherwise(0)).alias("kept"), F.sum(F.when(F.col("relevant"), F.col("n_dropped")).otherwise(0)).alias("dropped"), F.count("*").alias("n"), F.count_if(there).alias("answered"),
        F.count_if(F.col("extraction_status").isin("ok", "partial") & F.col("relevant").isNotNull()).alias("accepted"), F.count_if((F.col("extraction_status") == "ok") & F.col("relevant").isNotNull()).alias("accepted_full"),
    )
    machine = reference.filter("source = 'machine'").join(records.filter(there).select("case_id", "relevant"), "case_id", "left").agg(F.avg((~F.coalesce("relevant", F.lit(True))).cast("double")).alias("agreement_machine_irrelevant"))
    cost = units.agg(F.sum("cost").alias("cost"))
    d = r.crossJoin(machine).crossJoin(cost)  # one row each
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return d.select(
        share(F.col("kept"), F.col("kept") + F.col("dropped")).alias("fidelity"), "agreement_machine_irrelevant", share(F.col("answered"), F.col("n")).alias("compliance"), "accepted", "accepted_full", (F.col("n") - F.col("answered")).alias("missing"),
        F.when(F.col("accepted") > 0, F.col("cost") / F.col("accepted")).alias("cost_per_accepted"),
    )


def stability(a: DataFrame, b: DataFrame, fields: list[str]) -> DataFrame:
    """field, n and the share of cases of both reads on which the values are equal (nulls being values)."""
    d = a.select("case_id", *(F.col(f).cast("string").alias(f"a_{f}") for f in fields)).join(b.select("case_id", *(F.col(f).cast("string").alias(f"b_{f}") for f in fields)), "case_id")
    long = d.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")).alias("same")) for f in fields))).alias("x")).select("x.*")
    return long.groupBy("field").agg(F.count("*").alias("n"), F.avg(F.col("same").cast("double")).alias("agreement"))


def reference_batches(cases: DataFrame, signals: DataFrame, size: int = 18, most: int = 6) -> DataFrame:
    """case_id, batch (from 1 in the stratum), place and signals (the first `most` by selector): reference cases (case_id, era, jurisdiction) packed by stratum in order of id."""
    listed = signals.groupBy("case_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("selector_id", "version"))), 1, most).alias("signals"))
    d = numbered(cases.select("case_id", "era", "jurisdiction"), ["era", "jurisdiction"], [F.col("case_id")], "rn").join(listed, "case_id", "left")
    return d.select("case_id", "era", "jurisdiction", (F.floor((F.col("rn") - 1) / size) + 1).alias("batch"), ((F.col("rn") - 1) % size).cast("int").alias("place"), F.coalesce("signals", F.array().cast("array<struct<selector_id:string,version:int>>")).alias("signals"))


def reference_set(reviewed: DataFrame, negatives: DataFrame, most: int, seed: str) -> DataFrame:
    """case_id and source: all reviewed cases, and at most `most` machine negatives (case_id, era, jurisdiction), an even share of each stratum in keyed order."""
    stratum = ["era", "jurisdiction"]
    strata = negatives.select(*stratum).distinct().agg(F.ceil(F.lit(most) / F.count("*")).alias("quota"))
    key = F.md5(F.concat_ws("|", F.lit(seed), "case_id"))
    d = numbered(negatives.withColumn("key", key), stratum, [F.col("key"), F.col("case_id")], "rn").crossJoin(F.broadcast(strata)).filter("rn <= quota")
    chosen = d.orderBy("rn", "key", "case_id").limit(most)
    return reviewed.select("case_id", F.lit("human").alias("source")).unionByName(chosen.select("case_id", F.lit("machine").alias("source")))


def subset_batches(batches: DataFrame, size: int, only: DataFrame | None = None) -> DataFrame:
    """batch_id, part (from 1), case_id: batches (batch_id, case_id, place) split again into parts of `size`, of the cases in `only` where given."""
    d = batches.join(only.select("case_id"), "case_id", "left_semi") if only is not None else batches
    d = numbered(d.select("batch_id", "case_id", "place"), ["batch_id"], [F.col("place"), F.col("case_id")], "rn")
    return d.select("batch_id", (F.floor((F.col("rn") - 1) / size) + 1).alias("part"), "case_id")


def gold_rows(mentions: DataFrame, cases: DataFrame, classes: dict[str, str], override: DataFrame | None = None, contexts: int = 3) -> DataFrame:
    """One row a cited decision of mentions (cite, year, source, context, ord): cite_norm, year, sources (sorted, distinct), contexts (the last few), domain and case_id.

    domain: the first of `classes` (name -> pattern) that a context matches, else 'other', unless override (cite_norm, domain) says so. Decisions from FIRST_LATE_YEAR on are left out. case_id: of the case with that citation.
    """
    g = mentions.withColumn("cite_norm", T.cite_key(F.col("cite"))).groupBy("cite_norm").agg(
        F.max("year").alias("year"), F.array_sort(F.collect_set("source")).alias("sources"), F.transform(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("ord", "context")))), 1, contexts), lambda x: x["context"]).alias("contexts")
    )
    g = g.filter(F.col("year").isNull() | (F.col("year") < FIRST_LATE_YEAR))
    matches = lambda pattern: F.exists("contexts", lambda x: x.rlike(f"(?i){pattern}"))
    domain = F.lit("other")
    for name, pattern in reversed(classes.items()):
        domain = F.when(matches(pattern), name).otherwise(domain)
    g = g.withColumn("domain", domain)
    if override is not None:
        g = g.join(override.select("cite_norm", F.col("domain").alias("told")), "cite_norm", "left").withColumn("domain", F.coalesce("told", "domain")).drop("told")
    found = cases.select("case_id", T.cite_key(F.col("cite")).alias("cite_norm")).groupBy("cite_norm").agg(F.min("case_id").alias("case_id"))
    return g.join(found, "cite_norm", "left")


def anchors(entries: DataFrame, citations: DataFrame) -> DataFrame:
    """entries (entry_id, cites: parallel citations split at ';') with case_id: that of the first of them that a case has."""
    parts = entries.select("entry_id", F.posexplode(F.split("cites", ";")).alias("pos", "cite")).withColumn("cite_norm", T.cite_key(F.trim("cite")))
    found = citations.select("cite_norm", "case_id").groupBy("cite_norm").agg(F.min("case_id").alias("case_id"))
    first = parts.join(found, "cite_norm").groupBy("entry_id").agg(F.min(F.struct("pos", "case_id")).alias("f"))
    return entries.join(first, "entry_id", "left").select("entry_id", "cites", F.col("f.case_id").alias("case_id"))
