"""Gating records, agreement and accuracy measures, answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.operators.search import matching

Z95 = 1.959963984540054


def gated(records: DataFrame, quotes: DataFrame, fields: list[str]) -> DataFrame:
    """records (case_id, relevant and fields) with nulled_fields, n_dropped and extraction_status, from checked quotes (case_id, status, supports).

    An irrelevant record is ok and keeps no quotes. Fields that no quote that stands supports become null; the status is ok if nothing was lost, else partial while a quote stands, else extraction-invalid.
    """
    q = quotes.groupBy("case_id").agg(
        F.count_if(F.col("status") == "failed").alias("n_dropped"),
        F.count_if(F.col("status") != "failed").alias("n_kept"),
        F.array_distinct(F.flatten(F.collect_list(F.when(F.col("status") != "failed", F.col("supports"))))).alias("supported"),
    )
    d = records.join(q, "case_id", "left").fillna(0, ["n_dropped", "n_kept"]).withColumn("supported", F.coalesce("supported", F.array().cast("array<string>")))
    applies = F.coalesce(F.col("relevant"), F.lit(True))
    lost = F.array_compact(F.array(*(F.when(applies & F.col(f).isNotNull() & ~F.array_contains("supported", F.lit(f)), F.lit(f)) for f in fields)))
    d = d.withColumn("nulled_fields", lost).withColumn("n_dropped", F.when(applies, F.col("n_dropped")).otherwise(0))
    d = d.withColumns({f: F.when(~F.array_contains("nulled_fields", F.lit(f)), F.col(f)) for f in fields})
    status = F.when(~applies | ((F.col("n_dropped") == 0) & (F.size("nulled_fields") == 0)), "ok").when(F.col("n_kept") > 0, "partial").otherwise("extraction-invalid")
    return d.withColumn("extraction_status", status).drop("supported", "n_kept")


def hash_sample(units: DataFrame, percent: int) -> DataFrame:
    """Units whose SHA-256's first 8 digits modulo 100 are below percent."""
    return units.filter(F.conv(F.substring(F.sha2("unit_id", 256), 1, 8), 16, 10).cast("long") % 100 < percent)


def disagreements(a: DataFrame, b: DataFrame, fields: list[str]) -> DataFrame:
    """(case_id, field, a, b) of fields that differ, nulls being values, where both tables have the case."""
    d = a.select("case_id", *(F.col(f).cast("string").alias(f"a_{f}") for f in fields)).join(b.select("case_id", *(F.col(f).cast("string").alias(f"b_{f}") for f in fields)), "case_id")
    long = d.select("case_id", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").alias("a"), F.col(f"b_{f}").alias("b")) for f in fields))).alias("x")).select("case_id", "x.*")
    return long.filter(~F.col("a").eqNullSafe(F.col("b")))


def wilson(k: Column, n: Column) -> Column:
    """(lo, hi) of the 95 % Wilson interval; null where n is 0."""
    p, z = k / n, Z95
    centre, half = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.when(n > 0, F.struct(((centre - half) / (1 + z * z / n)).alias("lo"), ((centre + half) / (1 + z * z / n)).alias("hi")))


def kappa(pairs: DataFrame, by: list[str]) -> DataFrame:
    """n, agreement and Cohen's kappa of columns a and b for each group; kappa is null where chance agreement is 1."""
    n = pairs.groupBy(*by).agg(F.count("*").alias("n"), F.avg((F.col("a") == F.col("b")).cast("double")).alias("agreement"))
    side = lambda c: pairs.groupBy(*by, F.col(c).alias("v")).agg(F.count("*").alias(f"n_{c}"))
    chance = side("a").join(side("b"), [*by, "v"]).groupBy(*by).agg(F.sum(F.col("n_a") * F.col("n_b")).alias("s"))
    d = n.join(chance, by, "left").withColumn("e", F.coalesce("s", F.lit(0)) / (F.col("n") * F.col("n")))
    return d.select(*by, "n", "agreement", F.when(F.col("e") < 1, (F.col("agreement") - F.col("e")) / (1 - F.col("e"))).alias("kappa"))


def gold_funnel(gold: DataFrame) -> DataFrame:
    """tier ('union' for all) and how many gold rows are entries, resolved, signaled, read, relevant and human; each stage needs those before it. Rows count once by case or citation."""
    key = F.coalesce(F.col("case_id").cast("string"), F.col("cite_norm"))
    flags, reached = {}, F.col("case_id").isNotNull()
    for stage in ("resolved", "signaled", "read", "relevant", "human"):
        reached = reached if stage == "resolved" else reached & F.coalesce(F.col(stage), F.lit(False))
        flags[f"is_{stage}"] = reached
    d = gold.withColumns(flags).withColumn("key", key)
    d = d.unionByName(d.withColumn("tier", F.lit("union")))
    d = d.groupBy("tier", "key").agg(*(F.max(c).alias(c) for c in flags))
    return d.groupBy("tier").agg(F.count("*").alias("entries"), *(F.count_if(F.col(c)).alias(c[3:]) for c in flags))


def score_band(score: Column) -> Column:
    """The lower end of the score's band of 0.05."""
    return F.round(F.floor(score / 0.05 + 1e-9) * 0.05, 2)


def field_scores(pairs: DataFrame) -> DataFrame:
    """field, decided (share of reference rows on which the candidate decided) and agreement where both decided; pairs has field, ref and got."""
    both = F.col("ref").isNotNull() & F.col("got").isNotNull()
    return pairs.filter("ref is not null").groupBy("field").agg(F.count("*").alias("n"), F.avg(both.cast("double")).alias("decided"), F.avg(F.when(both, (F.col("ref") == F.col("got")).cast("double"))).alias("agreement"))


def answer_records(records: DataFrame, population: dict[str, list], any_of: list[dict[str, list]]) -> DataFrame:
    """Records that meet all of population and all of one of any_of (values listed by field)."""
    every = lambda spec: [F.col(k).isin(v) for k, v in spec.items()]
    conj = lambda tests: F.expr("true") if not tests else tests[0] if len(tests) == 1 else tests[0] & conj(tests[1:])
    test = conj(every(population))
    if any_of:
        alt = conj(every(any_of[0]))
        for spec in any_of[1:]:
            alt = alt | conj(every(spec))
        test = test & alt
    return records.filter(test)


def two_tier_summary(records: DataFrame, by: list[str]) -> DataFrame:
    """view, key1, key2, human_reviewed and machine_only: the total, jurisdiction by era, and each of `by`, in one pass of grouping sets."""
    sets = [[], ["jurisdiction", "era"], *([b] for b in by)]
    columns = list(dict.fromkeys(["jurisdiction", "era", *by]))
    d = records.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(F.count_if(F.col("reviewed")).alias("human_reviewed"), F.count_if(~F.col("reviewed")).alias("machine_only"), F.grouping_id().alias("g"))
    return d.withColumn("g", F.col("g").cast("long"))


def earliest_by_jurisdiction(records: DataFrame) -> DataFrame:
    """The earliest case of each jurisdiction: by year (none last), then id."""
    key = F.struct(F.col("year").isNull(), F.col("year"), F.col("case_id"))
    return records.groupBy("jurisdiction").agg(F.min(key).alias("k")).select("jurisdiction", F.col("k.case_id").alias("case_id"), F.col("k.year").alias("year"))


def all_citations(citations: DataFrame, preference: dict[str, int]) -> DataFrame:
    """case_id and its citations across merged copies (winner, cites split at ';', kind): parts without digits left out, distinct, official before unknown before reprints, then by text."""
    rank = F.coalesce(F.element_at(F.create_map(*(x for k, v in preference.items() for x in (F.lit(k), F.lit(v)))), F.col("kind")), F.lit(1))
    d = citations.select(F.col("winner").alias("case_id"), rank.alias("rank"), F.explode(F.split("cites", ";")).alias("c")).withColumn("c", F.trim("c")).filter(F.col("c").rlike(r"\d"))
    d = d.groupBy("case_id", "c").agg(F.min("rank").alias("rank"))
    return d.groupBy("case_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "c"))), lambda x: x["c"]).alias("cites"))



def text_matches(records: DataFrame, cases: DataFrame, phrases: list[str]) -> DataFrame:
    """case_id of the records whose opinion text holds any of the phrases as words."""
    return matching(cases.join(records.select("case_id").distinct(), "case_id", "left_semi"), phrases).select("case_id")


def case_rows(records: DataFrame, names: DataFrame, citations: DataFrame, quotes: DataFrame, reviewed: DataFrame, fields: list[str]) -> DataFrame:
    """One row a record for people: case_name, court, citations (joined by '; ', else the record's own), year, era, jurisdiction, fields, quote and quote_page (the first verified), review_tier and case_id."""
    first = quotes.filter("status = 'verified'").groupBy("case_id").agg(F.min(F.struct("ord", "text", "page")).alias("q"))
    d = records.join(names.select("case_id", "name", "court"), "case_id", "left").join(citations.select("case_id", "cites"), "case_id", "left").join(first, "case_id", "left").join(reviewed.select("case_id", F.lit(True).alias("r")).distinct(), "case_id", "left")
    text = lambda c: F.coalesce(c, F.lit(""))
    listed = F.when(F.size(F.coalesce("cites", F.array().cast("array<string>"))) > 0, F.array_join("cites", "; ")).otherwise(text(F.col("cite")))
    return d.select(
        text(F.col("name")).alias("case_name"), text(F.col("court")).alias("court"), listed.alias("citations"), "year", "era", "jurisdiction", *fields, text(F.col("q.text")).alias("quote"), text(F.col("q.page")).alias("quote_page"),
        F.when(F.col("r"), "human-reviewed").otherwise("machine-only").alias("review_tier"), "case_id",
    )


def answer(rows: DataFrame, groups: list[str]) -> dict[str, DataFrame]:
    """The parts of an answer from its case rows: rows, summary (two-tier counts by each grouping) and earliest (each jurisdiction's first case)."""
    counted = rows.withColumn("reviewed", F.col("review_tier") == "human-reviewed")
    return {"rows": rows, "summary": two_tier_summary(counted, groups), "earliest": earliest_by_jurisdiction(rows)}
