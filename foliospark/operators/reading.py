"""Reading units: prompts out, responses in, the unit gate, what a walk leaves over and what is read again."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.operators.numbering import numbered

SIGNAL_CHARS = 160
UNIT = 18


def units_of(batches: DataFrame) -> DataFrame:
    """unit_id, era, jurisdiction, case_ids and question of batches (batch_id, era, jurisdiction, case_ids)."""
    return batches.select(F.col("batch_id").alias("unit_id"), "era", "jurisdiction", "case_ids", F.lit(None).cast("string").alias("question"))


def single_units(cases: DataFrame, question: str | None = None) -> DataFrame:
    """Units of one case (case_id, era, jurisdiction): to read again, or to answer a question."""
    prefix, cell = ("reread-", ["era", "jurisdiction"]) if question is None else ("judge-", [])
    known = [F.coalesce(c, F.lit("?")).alias(c) if c in cell else F.lit("?").alias(c) for c in ("era", "jurisdiction")]
    return cases.select(F.concat(F.lit(prefix), "case_id").alias("unit_id"), *known, F.array("case_id").alias("case_ids"), F.lit(question).cast("string").alias("question"))


def prompts(units: DataFrame, cases: DataFrame, signals: DataFrame, codebook: str, worker: str) -> DataFrame:
    """unit_id and prompt: the codebook (without a leading comment line), the unit's header, its question, and each case in order with its signals and text."""
    text = codebook.split("\n", 1)[-1] if codebook.startswith("<!--") and "\n" in codebook else "" if codebook.startswith("<!--") else codebook
    sig = signals.select("case_id", F.struct("ord", F.format_string("  - %s v%d: ...%s...", "selector_id", "version", F.substring(F.coalesce("matched_text", F.lit("")), 1, SIGNAL_CHARS)).alias("line")).alias("s"))
    lines = sig.groupBy("case_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["line"]), "\n").alias("lines"))
    d = units.select("unit_id", F.posexplode("case_ids").alias("place", "case_id")).join(cases, "case_id").join(lines, "case_id", "left")
    part = F.format_string("\n## case_id %d — %s, %s (%s, %s %s)\nRetrieval provenance:\n%s\n\n### Opinion text\n%s\n", "case_id", "name", "cite", "court", "jurisdiction", F.coalesce(F.col("year").cast("string"), F.lit("None")), F.coalesce("lines", F.lit("")), "raw_text")
    parts = d.groupBy("unit_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", part.alias("part")))), lambda x: x["part"]), "").alias("cases"))
    head = F.format_string(f'%s\n\n# Batch %s (%s x %s)\nSet "worker": "%s" and "batch_id": "%s" on every record.\n', F.lit(text), "unit_id", "era", "jurisdiction", F.lit(worker), "unit_id")
    ask = F.when(F.coalesce("question", F.lit("")) != "", F.concat(F.lit("\n## Question\n"), "question", F.lit("\n"))).otherwise("")
    return units.join(parts, "unit_id", "left").select("unit_id", F.concat(head, ask, F.coalesce("cases", F.lit(""))).alias("prompt"))


def _case_id(value: object) -> int | None:
    try:
        return None if value is None or isinstance(value, bool) else int(str(value).strip())
    except ValueError:
        return None


def response_records(text: str | None, case_ids: list[int], required: list[str]) -> list[dict] | None:
    """The records of a response, or None: an object's own `records`, else the first array in the text that answers for every case with all required keys."""
    text = (text or "").strip()
    if text.startswith("```"):
        text = text.strip("`")
        text = text[min((i for i in (text.find("["), text.find("{")) if i >= 0), default=0) :].strip()
    decoder = json.JSONDecoder()

    def decoded(at: int) -> object:
        try:
            return decoder.raw_decode(text, at)[0]
        except json.JSONDecodeError:
            return None

    def whole(found: object) -> bool:
        rows = isinstance(found, list) and all(isinstance(r, dict) for r in found)
        return rows and set(case_ids) <= {_case_id(r.get("case_id")) for r in found} and all(set(required) <= set(r) for r in found)

    top = decoded(0) if text else None
    tries = [top.get("records")] if isinstance(top, dict) else (decoded(i) for i, c in enumerate(text) if c == "[")
    return next((found for found in tries if whole(found)), None)


def parsed_responses(responses: DataFrame, required: list[str]) -> DataFrame:
    """unit_id, part, parsed and records (array of JSON texts) of responses (unit_id, part, case_ids, text); part: '' for the whole unit, 'a' and 'b' for its halves."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [response_records(t, [int(c) for c in ids], required) for t, ids in zip(pdf["text"], pdf["case_ids"], strict=True)]
            yield pdf[["unit_id", "part"]].assign(parsed=[x is not None for x in found], records=[[json.dumps(r) for r in x or ()] for x in found])

    return responses.select("unit_id", "part", "case_ids", "text").mapInPandas(run, "unit_id string, part string, parsed boolean, records array<string>")


#: Fixed value: what a record says when its case came more than once.
REPEATED = "duplicate records for this case_id in the response; the last one was kept"


def unit_records(units: DataFrame, parsed: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """unit_id, case_id, record (JSON text, null if missing) and note of every case of units: from the unit's response, else from its halves (the first with one more case). The last record of a case wins; repeats are noted.

    texts: the cases (case_id) whose texts there are, where that isn't all: a record of another case can't be checked and counts as missing.
    """
    whole = parsed.filter("part = '' and parsed").select("unit_id").distinct()
    used = parsed.filter("parsed").join(whole.withColumn("whole", F.lit(True)), "unit_id", "left").filter("(part = '') = coalesce(whole, false)")
    rows = used.select("unit_id", "part", F.posexplode("records").alias("at", "record")).withColumn("case_id", F.expr("try_cast(trim(get_json_object(record, '$.case_id')) as bigint)"))
    last = rows.groupBy("unit_id", "case_id").agg(F.max_by("record", F.struct("part", "at")).alias("record"), F.count("*").alias("n"))
    asked = units.select("unit_id", F.explode("case_ids").alias("case_id"))
    if texts is not None:
        last = last.join(texts.select("case_id").distinct(), "case_id", "left_semi")
    note = F.when(F.col("record").isNull(), "missing from response").when(F.col("n") > 1, REPEATED)
    return asked.join(last, ["unit_id", "case_id"], "left").select("unit_id", "case_id", "record", note.alias("note"))


def halves(units: DataFrame) -> DataFrame:
    """unit_id, part and case_ids of both halves of units."""
    k = F.ceil(F.size("case_ids") / 2).cast("int")
    parts = F.array(F.struct(F.lit("a").alias("part"), F.slice("case_ids", F.lit(1), k).alias("case_ids")), F.struct(F.lit("b").alias("part"), F.slice("case_ids", k + 1, F.size("case_ids")).alias("case_ids")))
    return units.select("unit_id", F.explode(parts).alias("p")).select("unit_id", "p.*")


def cell_aggregates(units: DataFrame) -> DataFrame:
    """Per cell, from its unit rows (cell, unit_id, status, cases_lost, cases_answered: arrays, cases_read, relevant, retried, sampled): cases_lost less those answered, sums, failures and sampled units, sorted."""
    rows = units.filter("unit_id is not null")
    lost = rows.select("cell", F.explode("cases_lost").alias("case_id")).distinct().join(rows.select("cell", F.explode("cases_answered").alias("case_id")).distinct(), ["cell", "case_id"], "left_anti")
    lost = lost.groupBy("cell").agg(F.array_sort(F.collect_list("case_id")).alias("cases_lost"))
    sums = rows.groupBy("cell").agg(
        F.sum(F.coalesce("cases_read", F.lit(0))).alias("cases_read"), F.sum(F.coalesce("relevant", F.lit(0))).alias("relevant"), F.count_if("retried").alias("retried"),
        F.array_sort(F.collect_list(F.when(F.col("status") != "ok", F.col("unit_id")))).alias("failures"), F.array_sort(F.collect_list(F.when(F.col("sampled"), F.col("unit_id")))).alias("checker_sampled"),
    )
    return sums.join(lost, "cell", "left").withColumn("cases_lost", F.coalesce("cases_lost", F.array().cast("array<long>")))


def screen_remainder(ranked: DataFrame, attempted: DataFrame) -> DataFrame:
    """Batches of ranked (cell, batch_id, rank, cap) that the cap allowed and the cell (cell, attempted) didn't reach."""
    return ranked.join(attempted, "cell", "left").filter((F.col("rank") <= F.col("cap")) & (F.col("rank") > F.coalesce("attempted", F.lit(0)))).select("cell", "batch_id", "rank")


def rebatched(hits: DataFrame, prefix: str, size: int = UNIT) -> DataFrame:
    """case_id, batch_id and place: hits (cell, case_id) in order of id in new batches of their cell, numbered with three digits or, beyond 999, as many as there are."""
    d = numbered(hits.select("cell", "case_id"), ["cell"], [F.col("case_id")], "rn")
    number = (F.floor((F.col("rn") - 1) / size) + 1).cast("string")
    return d.select("case_id", F.concat(F.lit(prefix), F.lit("-"), "cell", F.lit("-"), F.lpad(number, F.greatest(F.length(number), F.lit(3)), F.lit("0"))).alias("batch_id"), ((F.col("rn") - 1) % size).cast("int").alias("place"))


def reread_plan(cases: DataFrame, run: str, size: int = UNIT) -> DataFrame:
    """case_id, era, jurisdiction, batch_id and place of cases to read again: batches of one cell, in order of id, numbered through the cells in order."""
    d = numbered(cases.select("case_id", "era", "jurisdiction"), ["era", "jurisdiction"], [F.col("case_id")], "rn").withColumn("chunk", F.floor((F.col("rn") - 1) / size))
    ids = numbered(d.select("era", "jurisdiction", "chunk").distinct(), [], [F.col("era"), F.col("jurisdiction"), F.col("chunk")], "n")
    return d.join(ids, ["era", "jurisdiction", "chunk"]).select("case_id", "era", "jurisdiction", F.concat(F.lit(f"{run}-batch-"), F.lpad(F.col("n").cast("string"), 3, "0")).alias("batch_id"), ((F.col("rn") - 1) % size).cast("int").alias("place"))


def pool_duplicates(pool: DataFrame, marks: DataFrame) -> DataFrame:
    """Cases of the pool that have been marked duplicates since: batch_id, case_id."""
    return pool.join(marks.select(F.col("loser").alias("case_id")), "case_id", "left_semi").select("batch_id", "case_id")


def verification_stats(gated: DataFrame) -> DataFrame:
    """One row: records by status, and quotes verified, fuzzy and dropped, of gated (case_id, extraction_status, n_verified, n_fuzzy, n_dropped)."""
    status = F.col("extraction_status")
    return gated.agg(
        F.count("*").alias("records"), F.count_if(status == "ok").alias("ok"), F.count_if(status == "partial").alias("partial"), F.count_if(~status.isin("ok", "partial")).alias("invalid"),
        F.sum("n_verified").alias("quotes_verified"), F.sum("n_fuzzy").alias("quotes_fuzzy"), F.sum("n_dropped").alias("quotes_dropped"),
    )


def remap_queue(gated: DataFrame) -> DataFrame:
    return gated.filter("extraction_status = 'extraction-invalid'").select("case_id")


def legacy_verified(records: DataFrame, quotes: DataFrame, supported: dict[str, tuple[str, ...]], known: DataFrame) -> DataFrame:
    """case_id, nulled_fields and extraction_status of records (case_id, relevant, prompt_version and fields) by checked quotes (case_id, status, supports).

    The fields that a quote must support follow the prompt's version before any colon ('' for none). A case that isn't known is invalid; an irrelevant record is ok. A lost quote or field makes it partial while a quote stands, else invalid.
    """
    q = quotes.groupBy("case_id").agg(
        F.count_if(F.col("status") == "failed").alias("n_failed"), F.count_if(F.col("status") != "failed").alias("n_kept"), F.array_distinct(F.flatten(F.collect_list(F.when(F.col("status") != "failed", F.col("supports"))))).alias("by")
    )
    d = records.join(q, "case_id", "left").join(known.select("case_id", F.lit(True).alias("known")).distinct(), "case_id", "left").fillna(0, ["n_failed", "n_kept"])
    by, version = F.coalesce("by", F.array().cast("array<string>")), F.split_part(F.coalesce("prompt_version", F.lit("")), F.lit(":"), F.lit(1))
    wanted = F.try_element_at(F.create_map(*(x for k, v in supported.items() for x in (F.lit(k), F.array(*map(F.lit, v))))), version)
    fields = sorted({f for v in supported.values() for f in v if f in records.columns})
    lost = F.array_compact(F.array(*(F.when(F.col(f).isNotNull() & F.array_contains(wanted, F.lit(f)) & ~F.array_contains(by, F.lit(f)), F.lit(f)) for f in fields)))
    d = d.withColumn("nulled_fields", F.when(F.coalesce("relevant", F.lit(True)) & F.col("known"), lost).otherwise(F.array().cast("array<string>")))
    failed = (F.col("n_failed") > 0) | (F.size("nulled_fields") > 0)
    status = F.when(F.col("known").isNull(), "extraction-invalid").when(~F.coalesce("relevant", F.lit(True)) | ~failed, "ok").when(F.col("n_kept") > 0, "partial").otherwise("extraction-invalid")
    return d.select("case_id", "nulled_fields", status.alias("extraction_status"))


#: What a reviewer may decide.
DECISIONS = ("keep", "adopt", "set", "unsure")


def reviewer_decisions(replies: DataFrame, cards: DataFrame, vocabulary: dict[str, list[str]]) -> DataFrame:
    """reply_id, case_id, field, decision, value and error of replies (reply_id, case_id, text): the last JSON object in the text that has a decision, checked against cards (case_id, field) and the vocabulary."""
    found = F.regexp_extract_all("text", F.lit(r"(\{[^{}]*\"decision\"[^{}]*\})"), 1)
    last = F.try_element_at(found, F.lit(-1))
    d = replies.select("reply_id", "case_id", last.alias("j"))
    d = d.select("reply_id", "case_id", *(F.get_json_object("j", f"$.{k}").alias(k) for k in ("field", "decision", "value")), F.col("j").isNull().alias("none"))
    d = d.join(cards.select("case_id", "field", F.lit(True).alias("card")).distinct(), ["case_id", "field"], "left")
    words = F.try_element_at(F.create_map(*(x for k, v in vocabulary.items() for x in (F.lit(k), F.array(*map(F.lit, v))))), F.col("field"))
    error = (
        F.when(F.col("none"), "no decision").when(~F.col("decision").isin(*DECISIONS), "unknown decision").when(F.col("card").isNull(), "no such card")
        .when((F.col("decision") == "set") & F.col("value").isNull(), "set without a value").when((F.col("decision") == "set") & ~F.coalesce(F.array_contains(words, F.col("value")), F.lit(True)), "value outside the vocabulary")
    )
    return d.select("reply_id", "case_id", "field", "decision", "value", error.alias("error"))

