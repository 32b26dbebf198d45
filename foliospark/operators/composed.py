"""Figures put together from several tables: merged maps of reading units, where gold cases were lost, and the published snapshot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.session import written

# Maps of reading units, merged in any order

COUNTERS = ("records", "cases_read", "relevant_accepted", "irrelevant_accepted")
PURCHASES = ("calls", "tokens", "cost")


def map_state(units: DataFrame, walks: DataFrame, runs: DataFrame) -> dict[str, DataFrame]:
    """The mergeable state of the maps of any number of processes.

    units: run, at, cell, unit_id, status, COUNTERS, retried, sampled, cases_lost and cases_answered (arrays). walks: run, at, cell, position, batches, stop.
    runs: run, at and PURCHASES. at tells how fresh a run is. The state keeps the freshest row of a unit, the longest walk of a cell (the freshest of equal ones), the first
    place that any run gave a cell, and each run's purchases once; merge() of states is the same reduction, so order and repeats don't matter.
    """
    return _reduced({"units": units, "walks": walks.withColumns({"first_at": F.col("at"), "first": F.col("position")}), "runs": runs})


def _reduced(s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    unit = [c for c in s["units"].columns if c not in ("cell", "unit_id")]
    units = s["units"].groupBy("cell", "unit_id").agg(F.max_by(F.struct(*unit), F.struct("at", "run")).alias("u")).select("cell", "unit_id", "u.*")
    walk = [c for c in s["walks"].columns if c not in ("cell", "first_at", "first")]
    walks = s["walks"].groupBy("cell").agg(F.max_by(F.struct(*walk), F.struct("batches", "at", "run")).alias("w"), F.min(F.struct("first_at", "first")).alias("f")).select("cell", "w.*", "f.*")
    return {"units": units, "walks": walks, "runs": s["runs"].dropDuplicates(["run"])}


def merge_maps(*states: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return _reduced({k: reduce(DataFrame.unionByName, (s[k] for s in states)) for k in states[0]})


def map_cells(state: dict[str, DataFrame]) -> DataFrame:
    """One row a cell: its place, its walk, and counters worked out from its unit rows: sums, retried, sampled and failed units, and how many of the lost cases no unit has answered."""
    sums = state["units"].groupBy("cell").agg(
        F.count("*").alias("units"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS),
        F.count_if("retried").alias("units_retried"), F.count_if("sampled").alias("checker_units"), F.count_if(F.col("status") != "ok").alias("failures"),
    )
    each = lambda c: state["units"].select("cell", F.explode(c).alias("case_id")).distinct()
    lost = each("cases_lost").join(each("cases_answered"), ["cell", "case_id"], "left_anti").groupBy("cell").agg(F.count("*").alias("cases_lost"))
    # places in the order of the runs that saw a cell first, then of its place there; cells are eras times jurisdictions, whatever the number of cases
    place = F.row_number().over(Window.orderBy("first_at", "first", "cell")).alias("place")
    walks = state["walks"].select("cell", "batches", "stop", place)
    out = walks.join(sums, "cell", "left").join(lost, "cell", "left")
    return out.fillna(0, ["units", *COUNTERS, "units_retried", "checker_units", "failures", "cases_lost"])


def map_totals(state: dict[str, DataFrame]) -> DataFrame:
    """One row: purchases of all runs, and the sums of the merged cells."""
    cells = map_cells(state).agg(*(F.sum(c).alias(c) for c in (*COUNTERS, "cases_lost")))
    return state["runs"].agg(*(F.sum(c).alias(c) for c in PURCHASES)).crossJoin(cells)  # one row each


# Where gold cases were lost


def gold_lineage(gold: DataFrame, signals: DataFrame, packed: DataFrame, reads: DataFrame, kept: DataFrame, cases: DataFrame, scopes: DataFrame) -> DataFrame:
    """gold (id, tier, case_id or null) with the selectors that found each entry, the step at which it was lost, and who could have found a miss.

    signals: case_id, selector_id, version. packed, kept: case_id. reads: case_id, relevant. cases: case_id, era, jurisdiction. scopes: selector_id, era,
    jurisdiction. lost_at: unresolved, unsignaled, unpacked, unread, reader-negative, withdrawn, or null for what was kept. could_find: selectors whose scope holds the case but that gave no signal
    for it, for unsignaled entries. Every step is one join by case, on ids alone.
    """
    wanted = gold.filter("case_id is not null").select("case_id").distinct()
    found = signals.join(wanted, "case_id", "left_semi").groupBy("case_id").agg(F.array_sort(F.collect_set(F.concat("selector_id", F.lit("@v"), "version"))).alias("selectors"))
    mark = lambda df, name: df.select("case_id").distinct().withColumn(name, F.lit(True))
    read = reads.join(wanted, "case_id", "left_semi").groupBy("case_id").agg(F.max("relevant").alias("relevant"))
    could = cases.join(wanted, "case_id", "left_semi").join(F.broadcast(scopes), ["era", "jurisdiction"]).groupBy("case_id").agg(F.array_sort(F.collect_set("selector_id")).alias("in_scope"))  # a selector's cells: a short list
    d = gold.join(found, "case_id", "left").join(mark(packed, "packed"), "case_id", "left").join(read, "case_id", "left").join(mark(kept, "kept"), "case_id", "left").join(could, "case_id", "left")
    lost = (
        F.when(F.col("case_id").isNull(), "unresolved").when(F.col("kept"), None).when(F.col("selectors").isNull(), "unsignaled").when(F.col("packed").isNull(), "unpacked")
        .when(F.col("relevant").isNull(), "unread").when(~F.col("relevant"), "reader-negative").otherwise("withdrawn")
    )
    none = F.array().cast("array<string>")
    return d.select("id", "tier", "case_id", F.coalesce("selectors", none).alias("selectors"), lost.alias("lost_at"), F.when(lost == "unsignaled", F.coalesce("in_scope", none)).otherwise(none).alias("could_find"))


def lineage_recall(lineage: DataFrame) -> DataFrame:
    """tier, total, resolved, signaled, kept, shard_recall and end_to_end (3 places; null without resolved entries)."""
    d = lineage.groupBy("tier").agg(
        F.count("*").alias("total"), F.count_if(F.col("case_id").isNotNull()).alias("resolved"), F.count_if(F.col("case_id").isNotNull() & (F.size("selectors") > 0)).alias("signaled"), F.count_if(F.col("lost_at").isNull()).alias("kept")
    )
    share = lambda c: F.when(F.col("resolved") > 0, F.round(F.col(c) / F.col("resolved"), 3))
    return d.withColumns({"shard_recall": share("signaled"), "end_to_end": share("kept")})


# The published snapshot

FIGURES = {
    "relevant": "true",
    "favorable": "polarity = 'favorable'",
    "adverse": "polarity = 'adverse'",
    "mixed": "polarity = 'mixed'",
    "favorable_householder": "polarity = 'favorable' and who = 'householder'",
}


def snapshot_figures(records: DataFrame, library: DataFrame, lineage: DataFrame, bands: DataFrame, sample: DataFrame, as_of: int, axes: dict[str, list[str]]) -> DataFrame:
    """(section, name, human, machine): every published figure, each input scanned once and reduced to its few groups first.

    records: seq, case_id, relevant, polarity, who, era, region, tier, duration, reviewed; library: case_id, jurisdiction, year, in_scope, flagged; lineage: as gold_lineage gives it;
    bands: unread, estimate; sample: case_id, drawn_seq. axes: the known values of region, era, tier and duration. What isn't counted by tiers has machine null. The job fails if the ledger's head isn't
    as_of, if a favorable record of a listed region lies outside the other axes, if the grid's favorable records aren't the ledger's, or if losses aren't resolved minus kept.
    """
    said = lambda c: F.coalesce(c, F.lit(False))
    grid_keys = ["era", "region", "tier", "duration"]
    groups = written(records.groupBy("relevant", "polarity", "who", "reviewed", *grid_keys).agg(F.count("*").alias("n"), F.max("seq").alias("seq")), "snapshot-groups")  # the only look at the records
    counted = lambda test, human: F.coalesce(F.sum(F.when(said(F.col("relevant")) & said(F.expr(test)) & (said(F.col("reviewed")) == human), F.col("n"))), F.lit(0))
    favorable = said(F.col("relevant")) & said(F.expr(FIGURES["favorable"]))
    listed = said(F.col("region").isin(axes["region"]))
    inside = listed & reduce(Column.__and__, (said(F.col(k).isin(axes[k])) for k in ("era", "tier", "duration")))
    one = groups.agg(
        F.max("seq").alias("head"), F.coalesce(F.sum("n"), F.lit(0)).alias("read"),
        *(counted(t, h).alias(f"{k}_{h}") for k, t in FIGURES.items() for h in (True, False)),
        F.coalesce(F.sum(F.when(favorable & listed & ~inside, F.col("n"))), F.lit(0)).alias("stray"), F.coalesce(F.sum(F.when(favorable & inside, F.col("n"))), F.lit(0)).alias("in_grid"),
    )
    total = F.col("favorable_True") + F.col("favorable_False")
    wrong = (
        F.when(~F.coalesce(F.col("head") == as_of, F.lit(False)), F.concat(F.lit("the ledger's head is "), F.coalesce(F.col("head").cast("string"), F.lit("none")), F.lit(f", not {as_of}")))
        .when(F.col("stray") > 0, F.concat("stray", F.lit(" favorable records lie outside the grid's axes")))
        .when(F.col("in_grid") != total, F.concat(F.lit("the grid holds "), "in_grid", F.lit(" favorable records, the ledger "), total))
    )
    row = lambda section, name, human, machine=None: F.struct(F.lit(section).alias("section"), F.lit(name).alias("name"), human.cast("long").alias("human"), (machine.cast("long") if machine is not None else F.lit(None).cast("long")).alias("machine"))
    checked = lambda df, message: df.select(F.explode(F.when(message.isNotNull(), F.raise_error(message).cast(df.schema["rows"].dataType)).otherwise(F.col("rows"))).alias("r")).select("r.*")
    ledger = checked(one.withColumn("rows", F.array(row("ledger", "read", F.col("read")), *(row("ledger", k, F.col(f"{k}_True"), F.col(f"{k}_False")) for k in FIGURES))), wrong)
    cells = groups.filter(favorable & inside).groupBy(*grid_keys).agg(F.sum(F.when(said(F.col("reviewed")), F.col("n")).otherwise(0)).alias("h"), F.sum(F.when(said(F.col("reviewed")), 0).otherwise(F.col("n"))).alias("m"))
    grid = cells.select(F.lit("grid").alias("section"), F.concat_ws("|", *grid_keys).alias("name"), F.col("h").alias("human"), F.col("m").alias("machine"))
    lib = library.agg(F.count("*").alias("total"), F.count_if("in_scope").alias("scope"), F.count_if(said(F.col("in_scope")) & said(F.col("flagged"))).alias("flagged"), F.min(F.when(F.col("in_scope"), F.col("year"))).alias("lo"), F.max(F.when(F.col("in_scope"), F.col("year"))).alias("hi"), F.count_distinct(F.when(F.col("in_scope"), F.col("jurisdiction"))).alias("js"))
    shelves = lib.select(F.explode(F.array(row("library", "total", F.col("total")), row("library", "in_scope", F.col("scope")), row("library", "outside", F.col("total") - F.col("scope")), row("library", "flagged", F.col("flagged")), row("library", "jurisdictions", F.col("js")), row("library", "first_year", F.col("lo")), row("library", "last_year", F.col("hi")))).alias("r")).select("r.*")
    steps = ("unsignaled", "unpacked", "unread", "reader-negative", "withdrawn")
    lost = lineage.agg(F.count("*").alias("entries"), F.count_if(F.col("case_id").isNotNull()).alias("resolved"), F.count_if(F.col("lost_at").isNull()).alias("kept"), *(F.count_if(F.col("lost_at") == s).alias(s) for s in steps))
    losses = reduce(Column.__add__, (F.col(f"`{s}`") for s in steps))
    unequal = F.when(losses != F.col("resolved") - F.col("kept"), F.concat(F.lit("losses are "), losses, F.lit(", resolved less kept "), F.col("resolved") - F.col("kept")))
    gold = checked(lost.withColumn("rows", F.array(*(row("gold", k, F.col(k)) for k in ("entries", "resolved", "kept")), *(row("gold", f"lost {s}", F.col(f"`{s}`")) for s in steps))), unequal)
    tail = bands.agg(F.sum("unread").alias("u"), F.min("estimate").alias("lo"), F.max("estimate").alias("hi")).select(F.explode(F.array(row("tail", "unread", F.col("u")), row("tail", "low", F.col("lo")), row("tail", "high", F.col("hi")))).alias("r")).select("r.*")
    audit = sample.agg(F.count("*").alias("n"), F.max("drawn_seq").alias("s")).select(F.explode(F.array(row("audit", "n", F.col("n")), row("audit", "drawn_seq", F.col("s")), row("audit", "not_yet_read", (F.col("s") == as_of).cast("int")))).alias("r")).select("r.*")
    return reduce(DataFrame.unionByName, (ledger, grid, shelves, gold, tail, audit))
