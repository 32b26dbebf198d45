"""Records and patches: filters, snapshots, admissions, applying, re-reads, what quotes leave unsupported, decisions and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.operators import folding
from foliospark.operators.ledger import numbered_patches, patch_id
from foliospark.operators.numbering import numbered

#: The fields that an admission sets, in order, those of its body, and how grave an outcome of the gate is.
SET_FIELDS = (
    "relevance_score", "polarity", "who_was_letting", "duration_of_occupancy", "characterization", "under_thirty_days",
    "owner_freedom_characterization", "restriction_nature", "holding_summary", "doctrinal_concepts", "new_terms_observed",
)
SEVERITY = ("ok", "partial", "extraction-invalid")
FLAG = "needs-review:"


def records_where(records: DataFrame, equal: dict[str, object]) -> DataFrame:
    """Records whose fields have the given values; None asks for nulls."""
    for k, v in equal.items():
        records = records.filter(F.col(k).eqNullSafe(F.lit(v)))
    return records


def histories(log: DataFrame, ids: DataFrame) -> DataFrame:
    """All patches of the given cases."""
    return log.join(ids.select("case_id"), "case_id", "left_semi")


def favorable_seed(records: DataFrame, reviewed: DataFrame, head: int) -> DataFrame:
    """One row: n and digest of the reviewed favorable records (case_id, polarity, in_file); the digest covers the log's head, and ids by sorted hashes of 4,096 buckets."""
    ids = records.filter("in_file and polarity = 'favorable'").join(reviewed.select("case_id"), "case_id", "left_semi").select("case_id").distinct()
    buckets = ids.groupBy((F.col("case_id") % 4096).alias("b")).agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.col("case_id"))).cast("array<string>"), ","), 256).alias("h"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "h"))), lambda x: x["h"]), ",")
    return buckets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.substring(F.sha2(F.concat(F.lit(f"{head}|"), joined), 256), 1, 16).alias("digest"))


def snapshot(records: DataFrame) -> DataFrame:
    """records (cycle, case_id, year, admit_seq and others) with their line in their cycle's file: by year (none first), then admission."""
    return numbered(records, ["cycle"], [F.coalesce("year", F.lit(0)), F.col("admit_seq")], "line")


def applied(log: DataFrame, patches: DataFrame, head: int, protect_from: int, *order: str) -> DataFrame:
    """patches (the log's columns but seq, and `order`) with seq and outcome: 'skipped' (in the log already, or earlier among them), 'rejected' (can't apply, or a person's value stands) or 'applied'. Nothing is written.

    Only the histories of the cases that new patches touch are folded.
    """
    d = patches.withColumn("patch_id", patch_id())
    known = log.join(d.select("case_id").distinct(), "case_id", "left_semi").select(patch_id().alias("patch_id")).distinct()
    first = d.groupBy("patch_id").agg(F.min(F.struct(*order)).alias("first"))
    d = d.join(first, "patch_id").join(known.withColumn("known", F.lit(True)), "patch_id", "left").withColumn("new", F.col("new"))
    d = d.withColumn("fresh", F.col("known").isNull() & (F.struct(*order) == F.col("first"))).drop("first", "known")
    fresh = numbered_patches(d.filter("fresh"), head, *order)
    old = histories(log, fresh)
    columns = [c for c in log.columns]
    state = folding.fold(old.select(columns).unionByName(fresh.select(columns)), protect_from)
    refused = state.errors.select("case_id", "seq").unionByName(state.conflicts.filter("not historical").select("case_id", "seq")).distinct().withColumn("refused", F.lit(True))
    done = fresh.join(refused, ["case_id", "seq"], "left").withColumn("outcome", F.when(F.col("refused"), "rejected").otherwise("applied"))
    skipped = d.filter("not fresh").withColumn("seq", F.lit(None).cast("long")).withColumn("outcome", F.lit("skipped"))
    return done.select("case_id", *order, "seq", "outcome").unionByName(skipped.select("case_id", *order, "seq", "outcome"))


def admission_patches(records: DataFrame, identity: list[str], fields: list[str]) -> DataFrame:
    """case_id, place (from 0), op, field and new (JSON text) of admissions of records: the body of identity fields, and, of relevant ones, a set of each field that isn't null or empty, then the reader's and the checker's notes."""
    body = F.to_json(F.struct("case_id", *(F.col(c) for c in identity if c != "case_id")))
    value = lambda f: F.to_json(F.struct(F.col(f).alias("v")))
    told = lambda f: F.col(f).isNotNull() & ~F.col(f).cast("string").isin("", "[]")
    patch = lambda op, field, new: F.struct(F.lit(op).alias("op"), F.lit(field).alias("field"), new.alias("new"))
    inner = lambda j: F.regexp_extract(j, r"(?s)^\{\"v\":(.*)\}$", 1)
    quoted = lambda c: inner(F.to_json(F.struct(c.alias("v"))))
    relevant = F.coalesce("relevant", F.lit(False))
    note = lambda c, prefix: F.when(relevant & (F.trim(F.coalesce(F.col(c), F.lit(""))) != ""), patch("append", "review.notes", quoted(F.concat(F.lit(prefix), F.trim(c)))))
    rows = F.array_compact(F.array(patch("admit", "", body), *(F.when(relevant & told(f), patch("set", f, inner(value(f)))) for f in fields), note("notes", "reader: "), note("checker_note", "")))
    return records.select("case_id", F.posexplode(rows).alias("place", "p")).select("case_id", "place", "p.*")


def rebuilt_records(unit_records: DataFrame, gate: DataFrame, identity: DataFrame) -> DataFrame:
    """case_id, cite, jurisdiction, relevant, polarity and extraction_status of records rebuilt from responses: unit_records (case_id, record), the gate's result (case_id, extraction_status, polarity), and the cases' identity."""
    d = unit_records.filter("record is not null").select("case_id", (F.get_json_object("record", "$.relevant") == "true").alias("relevant"))
    d = d.join(gate.select("case_id", "extraction_status", "polarity"), "case_id", "left").join(identity, "case_id")
    return d.select("case_id", "cite", "jurisdiction", "relevant", "polarity", F.coalesce("extraction_status", F.lit("ok")).alias("extraction_status"))


def reread_fields(old: DataFrame, new: DataFrame, fields: list[str], human: DataFrame) -> DataFrame:
    """case_id, field and outcome of reading again, old and new having case_id, relevant, extraction_status and fields; human: (case_id, field) that a person decided.

    A case without a readable new record is 'unreadable' (field null), one that reads irrelevant is 'carded' if a person decided its relevance, else 'withdrawn'. Otherwise, of each field: 'skipped' (the new read has none), 'fill' (only it has one), 'agree', 'conflict' (a person's value differs) or 'replace'.
    """
    side = lambda df, k: df.select("case_id", F.col("relevant").alias(f"{k}_relevant"), F.col("extraction_status").alias(f"{k}_status"), *(F.col(f).cast("string").alias(f"{k}_{f}") for f in fields))
    decided = human.groupBy("case_id").agg(F.collect_set("field").alias("decided"))
    d = side(old, "old").join(side(new, "new"), "case_id", "left").join(decided, "case_id", "left").withColumn("decided", F.coalesce("decided", F.array().cast("array<string>")))
    unreadable = F.col("new_status").isNull() | F.col("new_status").isin("missing", "extraction-invalid")
    whole = F.when(unreadable, "unreadable").when(~F.coalesce("new_relevant", F.lit(False)), F.when(F.array_contains("decided", F.lit("relevant")), "carded").otherwise("withdrawn"))

    def outcome(f: str) -> Column:
        a, b = F.col(f"old_{f}"), F.col(f"new_{f}")
        return F.when(b.isNull(), "skipped").when(a.isNull(), "fill").when(a == b, "agree").when(F.array_contains("decided", F.lit(f)), "conflict").otherwise("replace")

    rows = F.when(whole.isNotNull(), F.array(F.struct(F.lit(None).cast("string").alias("field"), whole.alias("outcome")))).otherwise(F.array(*(F.struct(F.lit(f).alias("field"), outcome(f).alias("outcome")) for f in fields)))
    return d.select("case_id", F.explode(rows).alias("r")).select("case_id", "r.*")


def merged_evidence(pairs: DataFrame) -> DataFrame:
    """case_id, nulled_fields, extraction_status and quotes of old and new reads (old_/new_ nulled: arrays, status, quotes: arrays of struct text, page; filled: array).

    Emptied fields are both reads' but those filled; the status is the worse, or ok when nothing is left empty and neither read was invalid; new quotes of other texts come after the old.
    """
    rank = lambda c: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, SEVERITY)), F.col(c)), F.lit(0)), F.lit(len(SEVERITY) + 1))
    nulled = F.array_except(F.array_distinct(F.concat("old_nulled", "new_nulled")), "filled")
    valid = (F.coalesce("old_status", F.lit("")) != SEVERITY[-1]) & (F.coalesce("new_status", F.lit("")) != SEVERITY[-1])
    status = F.when((F.size(nulled) == 0) & valid, "ok").when(rank("old_status") >= rank("new_status"), F.col("old_status")).otherwise(F.col("new_status"))
    fresh = F.filter("new_quotes", lambda q: ~F.exists("old_quotes", lambda o: o["text"] == q["text"]))
    return pairs.select("case_id", nulled.alias("nulled_fields"), status.alias("extraction_status"), F.concat("old_quotes", fresh).alias("quotes"))


def checker_notes(disagreements: DataFrame, sampled: DataFrame, pin: str, fields: tuple[str, ...]) -> DataFrame:
    """case_id and note: the disagreements (case_id, ord, field, reader_value, checker_value) of each case, and for other cases of units whose checker's response parsed (case_id) that none was recorded."""
    line = F.format_string("%s '%s' vs '%s'", "field", "reader_value", "checker_value")
    told = disagreements.groupBy("case_id").agg(F.concat(F.lit(f"checker:{pin}: "), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", line.alias("line")))), lambda x: x["line"]), "; ")).alias("note"))
    quiet = sampled.select("case_id").distinct().join(told, "case_id", "left_anti").withColumn("note", F.lit(f"checker:{pin}: unit sampled, no disagreement recorded on {', '.join(fields)}"))
    return told.unionByName(quiet)


def unsupported_fields(records: DataFrame, drops: DataFrame, quotes: DataFrame, supported: dict[str, tuple[str, ...]]) -> DataFrame:
    """(case_id, field): set fields of relevant records in the file (case_id, in_file, relevant, prompt_version and fields) that no quote (case_id, supports) supports, though the prompt wants it, of cases that lost a quote (drops)."""
    fields = sorted({f for v in supported.values() for f in v if f in records.columns})
    wanted = F.try_element_at(F.create_map(*(x for k, v in supported.items() for x in (F.lit(k), F.array(*map(F.lit, v))))), F.split_part(F.coalesce("prompt_version", F.lit("")), F.lit(":"), F.lit(1)))
    d = records.filter("in_file and relevant").join(drops.select("case_id").distinct(), "case_id", "left_semi")
    held = F.array_compact(F.array(*(F.when(F.col(f).isNotNull() & F.array_contains(wanted, F.lit(f)), F.lit(f)) for f in fields)))
    rows = d.select("case_id", F.explode(held).alias("field"))
    return rows.join(quotes.select("case_id", F.explode("supports").alias("field")).distinct(), ["case_id", "field"], "left_anti")


def superseded_flags(decisions: DataFrame, records: DataFrame, field: str) -> DataFrame:
    """Cases whose flag of a field still stands though a decision (case_id, field, decision) has given it a value."""
    decided = decisions.filter((F.col("field") == field) & F.col("decision").isin("adopt", "set")).select("case_id").distinct()
    return records.filter(F.array_contains("flags", F.lit(FLAG + field))).join(decided, "case_id", "left_semi").select("case_id")


def outdated_values(records: DataFrame, vocabulary: dict[str, list[str]]) -> DataFrame:
    """(case_id, field, value) of values that the vocabulary no longer has."""
    rows = F.array_compact(F.array(*(F.when(F.col(f).isNotNull() & ~F.col(f).isin(v), F.struct(F.lit(f).alias("field"), F.col(f).alias("value"))) for f, v in vocabulary.items())))
    return records.select("case_id", F.explode(rows).alias("r")).select("case_id", "r.*")


def decision_patches(decisions: DataFrame, flags: DataFrame) -> DataFrame:
    """case_id, op, field and new (JSON text) of review decisions (case_id, field, decision, value, checker_value): a kept, adopted or set value ends the field's standing flag (flags: case_id, field); adopt and set write the value, relevance withdrawn as false; unsure raises the flag again."""
    d = decisions.join(flags.select("case_id", "field", F.lit(True).alias("flagged")).distinct(), ["case_id", "field"], "left")
    value = F.when(F.col("decision") == "adopt", F.col("checker_value")).otherwise(F.col("value"))
    json = F.when(F.lower(value).isin("true", "false"), F.lower(value)).when(value.isNull(), "null").otherwise(F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1))
    row = lambda op, field, new: F.struct(F.lit(op).alias("op"), field.alias("field"), new.alias("new"))
    flag = F.concat(F.lit(f'"{FLAG}'), "field", F.lit('"'))
    writes = F.when(F.col("decision").isin("adopt", "set"), row("set", F.col("field"), json))
    ends = F.when((F.col("decision") != "unsure") & F.col("flagged"), row("unflag", F.lit("review.flags"), flag))
    raises = F.when((F.col("decision") == "unsure") & F.col("flagged").isNull(), row("append", F.lit("review.flags"), flag))
    status = F.when(F.col("decision") != "unsure", row("set", F.lit("review.status"), F.lit('"reviewed"')))
    return d.select("case_id", F.explode(F.array_compact(F.array(writes, ends, raises, status))).alias("p")).select("case_id", "p.*")


def mirrored(patches: DataFrame, merges: DataFrame) -> DataFrame:
    """patches, and those of losers again for their winners (loser, winner)."""
    copies = patches.join(merges.select(F.col("loser").alias("case_id"), "winner"), "case_id").drop("case_id").withColumnRenamed("winner", "case_id")
    return patches.unionByName(copies.select(patches.columns))


def decision_errors(decisions: DataFrame, cards: DataFrame) -> DataFrame:
    """(case_id, field, error) of decisions that the round didn't ask for: no card of the case, or only for other fields. Relevance may be decided on any card."""
    asked = cards.groupBy("case_id").agg(F.array_sort(F.collect_set("decide_field")).alias("fields"))
    d = decisions.join(asked, "case_id", "left")
    error = F.when(F.col("fields").isNull(), "not a card of the round").when(~F.array_contains("fields", F.col("field")) & (F.col("field") != "relevant"), F.concat(F.lit("the card decides "), F.array_join("fields", ", ")))
    return d.withColumn("error", error).filter("error is not null").select("case_id", "field", "error")


def drifted(drawn: DataFrame, records: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Cases whose fields aren't what they were when drawn; a record that is gone has none."""
    d = drawn.select("case_id", *(F.col(f).alias(f"was_{f}") for f in fields)).join(records.select("case_id", *fields), "case_id", "left")
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f).eqNullSafe(F.col(f"was_{f}"))
    return d.filter(~same).select("case_id")


def projected_counts(log: DataFrame, patches: DataFrame, protect_from: int, field: str) -> DataFrame:
    """value of a field, n_before and n_after: records of the file by it, as the log folds and as it would with the (numbered) patches. Nothing is written."""
    count = lambda df, name: df.filter("in_file").groupBy(F.try_element_at("fields", F.lit(field)).alias("value")).agg(F.count("*").alias(name))
    before, after = count(folding.fold(log, protect_from).records, "n_before"), count(folding.fold(log.unionByName(patches.select(log.columns)), protect_from).records, "n_after")
    joined = before.withColumnRenamed("value", "v").join(after, F.col("v").eqNullSafe(F.col("value")), "full")
    return joined.select(F.coalesce("v", "value").alias("value"), F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"))
