"""Selector planning, coverage, signals, packing into batches, ranking measures, reading budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.operators.numbering import numbered, running_sums

# Planning


def expanded_scope(selectors: DataFrame, universe: DataFrame) -> DataFrame:
    """One row for each active selector and partition: eras x jurisdictions, where 'all' stands for those of the universe (era, jurisdiction)."""
    every = universe.agg(F.array_sort(F.collect_set("era")).alias("eras"), F.array_sort(F.collect_set("jurisdiction")).alias("jurs"))
    d = selectors.filter("status = 'active'").crossJoin(F.broadcast(every))  # one row
    of = lambda scope, known: F.when(F.array_contains(scope, "all"), F.col(known)).otherwise(F.col(scope))
    return d.withColumn("era", F.explode(of("era_scope", "eras"))).withColumn("jurisdiction", F.explode(of("jurisdiction_scope", "jurs"))).select("selector_id", "version", "era", "jurisdiction").distinct()


def seed_set(ids: DataFrame) -> DataFrame:
    """One row: the sorted distinct ids and the first 16 digits of their SHA-256. The set is a configuration of seeds, not a corpus."""
    return ids.agg(F.array_sort(F.collect_set("case_id")).alias("ids")).select("ids", F.substring(F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256), 1, 16).alias("digest"))


def plan(scope: DataFrame, cells: DataFrame, covered: DataFrame) -> DataFrame:
    """scope rows with the cell's n and what to do: 'run', 'covered', or 'partition_empty' where no live case is."""
    key = ["selector_id", "version", "era", "jurisdiction"]
    d = scope.join(F.broadcast(cells.select("era", "jurisdiction", "n")), ["era", "jurisdiction"], "left").join(covered.select(*key, F.lit(True).alias("done")).distinct(), key, "left")
    todo = F.when(F.col("n").isNull(), "partition_empty").when(F.col("done"), "covered").otherwise("run")
    return d.select(*key, F.coalesce("n", F.lit(0)).alias("n"), todo.alias("action"))


def skip_reason(selectors: DataFrame) -> DataFrame:
    """selectors (kind, n_seeds, missing_cells, n_runs) with the reason not to run, or null."""
    vector = F.col("kind").isin("vector", "feedback")
    reason = F.when(F.col("kind").isin("graph", "feedback") & (F.col("n_seeds") == 0), "seed_unavailable").when(vector & (F.col("missing_cells") > 0), "index_incomplete").when(vector & (F.col("n_runs") > 1), "mixed_embedding_model")
    return selectors.withColumn("skip", reason)


def already_read(extractions: DataFrame, manifests: DataFrame) -> DataFrame:
    """Distinct case ids (text to number where it is one) of both tables; rows that are no number are left out."""
    return extractions.select("case_id").unionByName(manifests.select("case_id")).select(F.expr("try_cast(case_id as bigint)").alias("case_id")).filter("case_id is not null").distinct()


def attribution(cases: DataFrame, signals: DataFrame) -> DataFrame:
    """case_id and its distinct (selector, run, cosine), sorted; cases without signals are kept."""
    found = signals.groupBy("case_id").agg(F.array_sort(F.collect_set(F.struct("selector_id", "run_id", "cosine"))).alias("hits"))
    return cases.select("case_id").join(found, "case_id", "left")


# Packing


def packed(signals: DataFrame, gold: DataFrame, size: int, scores: DataFrame | None = None, restrict: DataFrame | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """case_id, batch_id (from 1) and place: cases of one cell in batches of `size`.

    signals: case_id, era, jurisdiction, selector_id. Without scores, a cell's cases go by distinct selectors (most first), then id, and batches by gold cases
    and the densest case (most first), then cell order; with scores (case_id, score) by score, then id, and batches by gold, mean score, cell key.
    restrict applies before exclude.
    """
    d = signals.join(restrict, "case_id", "left_semi") if restrict is not None else signals
    d = d.join(exclude, "case_id", "left_anti") if exclude is not None else d
    cases = d.groupBy("era", "jurisdiction", "case_id").agg(F.count_distinct("selector_id").alias("density"))
    cases = cases.join(gold.select("case_id", F.lit(1).alias("gold")).distinct(), "case_id", "left")
    cases = cases.join(scores.select("case_id", "score"), "case_id", "left") if scores is not None else cases.withColumn("score", F.col("density").cast("double"))
    cell = ["era", "jurisdiction"]
    rows = numbered(cases, cell, [F.desc("score"), F.col("case_id")], "rn").withColumn("rn", F.col("rn") - 1).withColumn("chunk", F.floor(F.col("rn") / size).cast("int"))
    batches = rows.groupBy(*cell, "chunk").agg(F.count("gold").alias("g"), (F.avg("score") if scores is not None else F.max("score")).alias("m"))
    order = [F.desc("g"), F.desc("m"), *(F.col(c).asc_nulls_last() for c in (*cell, "chunk"))]
    ids = numbered(batches, [], order, "batch_id").select(*cell, "chunk", "batch_id")
    return rows.join(ids, [*cell, "chunk"]).select("case_id", "batch_id", (F.col("rn") % size).cast("int").alias("place"))


# Ranking


def round6(x: Column) -> Column:
    """Six places of the value as a single-precision number."""
    return F.round(x.cast("float").cast("double"), 6)


def signal_summary(signals: DataFrame) -> DataFrame:
    """case_id, labels (id@vN, sorted), n_selectors (versions merged) and the best chunk by (cosine, lowest id)."""
    label = F.concat("selector_id", F.lit("@v"), "version")
    best = F.min_by("chunk_id", F.struct(-F.col("cosine"), "chunk_id"))
    return signals.groupBy("case_id").agg(F.array_sort(F.collect_set(label)).alias("labels"), F.count_distinct("selector_id").alias("n_selectors"), best.alias("best_chunk"), F.max("cosine").alias("best_cosine"))


def fusion(summary: DataFrame, lexical: list[str], w_lexical: float, w_cosine: float) -> DataFrame:
    """case_id and score: the share of lexical labels hit and the best cosine (0 at least), weighted."""
    hit = F.size(F.array_intersect("labels", F.array(*map(F.lit, lexical)))) / len(lexical)
    return summary.select("case_id", round6(w_lexical * hit + w_cosine * F.greatest(F.coalesce("best_cosine", F.lit(0.0)), F.lit(0.0))).alias("score"))


def logistic_score(features: DataFrame, layout: list[str], model_layout: list[str], coef: list[float], intercept: float, mean: list[float], scale: list[float]) -> DataFrame:
    """case_id and probability of a stored logistic model; a layout that differs from the model's is refused by its first difference."""
    for i, (a, b) in enumerate(zip([*layout, None], [*model_layout, None], strict=False)):
        if a != b:
            raise ValueError(f"feature {i} is {a!r}, the model has {b!r}")
    z = sum(((F.col(c) - m) / s * w for c, m, s, w in zip(layout, mean, scale, coef, strict=True)), F.lit(intercept))
    return features.select("case_id", (1 / (1 + F.exp(-z))).alias("probability"))


def average_precision(rows: DataFrame, by: list[str]) -> DataFrame:
    """ap of score, label, weight and idx (which breaks ties) for each group; 0 without positives."""
    d = running_sums(rows, by, [F.desc("score"), F.col("idx")], {"tp": F.col("label") * F.col("weight"), "seen": F.col("weight")})
    total = F.sum(F.col("label") * F.col("weight"))
    ap = F.sum(F.col("label") * F.col("weight") * F.col("tp") / F.col("seen")) / total
    return d.groupBy(*by).agg(F.when(total > 0, ap).otherwise(0.0).alias("ap"))


def precision_at(rows: DataFrame, k: int) -> DataFrame:
    """One row: the share of positives among the k best by (score, idx)."""
    return rows.orderBy(F.desc("score"), "idx").limit(k).agg(F.avg("label").alias("precision"))


def labelled_reads(positives: DataFrame, negatives: DataFrame) -> DataFrame:
    """case_id, label, weight: positives (3 if reviewed, else 1) win over negatives."""
    d = positives.select("case_id", F.lit(1).alias("p"), "reviewed").join(negatives.select("case_id").distinct(), "case_id", "full")
    label = F.coalesce("p", F.lit(0))
    return d.select("case_id", label.alias("label"), F.when(F.col("reviewed"), 3.0).otherwise(1.0).alias("weight"))


def held_out(rows: DataFrame, share: float, seed: str) -> DataFrame:
    """The rows held out: of each (era, jurisdiction, label) ceil(n * share) in keyed md5 order, none where n < 2."""
    stratum = ["era", "jurisdiction", "label"]
    d = numbered(rows, stratum, [F.md5(F.concat_ws("|", F.lit(seed), "case_id")), F.col("case_id")], "r").join(rows.groupBy(*stratum).agg(F.count("*").alias("n")), stratum)
    return d.filter((F.col("n") >= 2) & (F.col("r") <= F.ceil(F.col("n") * share))).select(rows.columns)


def strata_report(frame: DataFrame, held: DataFrame) -> DataFrame:
    key = ["era", "jurisdiction", "label"]
    return frame.groupBy(*key).agg(F.count("*").alias("n")).join(held.groupBy(*key).agg(F.count("*").alias("held")), key, "left").fillna(0, ["held"])


# Budgets


def capped_cells(batches: DataFrame, depth: dict[str, float]) -> DataFrame:
    """batches (cell, era, batch_id, score) with rank in the cell, cap = max(1, ceil(depth of the era * n of the cell / n of the era)) and the mean of the capped head; an era without depth fails the job."""
    known = F.create_map(*(x for k, v in depth.items() for x in (F.lit(k), F.lit(v))))
    d = batches.withColumn("score", F.coalesce("score", F.lit(0.0))).join(batches.groupBy("cell").agg(F.count("*").alias("n_cell")), "cell")
    d = d.join(batches.groupBy("era").agg(F.count("*").alias("n_era")), "era")
    deep = F.coalesce(F.element_at(known, F.col("era")), F.raise_error(F.concat(F.lit("no depth for era "), "era")).cast("double"))
    d = d.withColumn("cap", F.greatest(F.lit(1), F.ceil(deep * F.col("n_cell") / F.col("n_era"))).cast("int"))
    d = numbered(d, ["cell"], [F.desc("score"), F.col("batch_id")], "rank")
    heads = d.groupBy("cell").agg(F.avg(F.when(F.col("rank") <= F.col("cap"), F.col("score"))).alias("head_mean"))
    return d.join(heads, "cell")


def walk_order(batches: DataFrame, floor: int) -> DataFrame:
    """batch_id, class (0 read, 1 floor, 2 rest) and position of batches (cell, batch_id, score, read).

    Floor picks are a cell's best unread batches until it has `floor` read.
    """
    d = batches.join(batches.groupBy("cell").agg(F.count_if(F.col("read")).alias("n_read")), "cell")
    d = numbered(d, ["cell", "read"], [F.desc("score"), F.col("batch_id")], "r")
    d = d.withColumn("class", F.when(F.col("read"), 0).when(F.col("r") <= floor - F.col("n_read"), 1).otherwise(2))
    return numbered(d.select("batch_id", "class", "score"), [], [F.col("class"), F.desc("score"), F.col("batch_id")], "position").drop("score")


def completed_batches(units: DataFrame) -> DataFrame:
    """Distinct batch ids of units that are ok or read cases; '-partN' endings are folded."""
    return units.filter("status = 'ok' or cases_read > 0").select(F.regexp_replace("unit_id", r"-part\d+$", "").alias("batch_id")).distinct()


def yield_stops(units: DataFrame, cap: int, window: int = 3, least: int = 2) -> DataFrame:
    """cell, stop_at (number of the completed unit at which reading stops) and reason, where it stops: 'cap', else 'yield' once the last `window` completed units gave at most `least`."""
    done = numbered(units.filter("completed").select("cell", "seq", "relevant"), ["cell"], [F.col("seq")], "rn")
    # each unit gives its own number and the `window` - 1 after it what it gained
    gains = done.select("cell", F.explode(F.sequence(F.col("rn"), F.col("rn") + window - 1)).alias("rn"), "relevant", F.col("rn").alias("own"))
    d = gains.groupBy("cell", "rn").agg(F.sum("relevant").alias("gain"), F.max("own").alias("last")).filter(F.col("rn") == F.col("last"))
    reason = F.when(F.col("rn") >= cap, "cap").when((F.col("rn") >= window) & (F.col("gain") <= least), "yield")
    return d.withColumn("reason", reason).filter("reason is not null").groupBy("cell").agg(F.min(F.struct("rn", "reason")).alias("s")).select("cell", F.col("s.rn").alias("stop_at"), F.col("s.reason").alias("reason"))


def budget_walk(walk: DataFrame, budget: int, stops: DataFrame) -> DataFrame:
    """Batches of walk (batch_id, cell, position, cases) that are read: of a cell that stops (cell, stop_at) the first so many, and those before which fewer than `budget` cases have been."""
    d = numbered(walk, ["cell"], [F.col("position")], "rn").join(stops.select("cell", "stop_at"), "cell", "left")
    d = running_sums(d.filter("stop_at is null or rn <= stop_at"), [], [F.col("position")], {"upto": F.col("cases")})
    return d.filter(F.col("upto") - F.col("cases") < budget).select(walk.columns)


def retry_units(lost: DataFrame, size: int = 18) -> DataFrame:
    """Lost cases (cell, case_id) in new units of one cell: unit_id and case_id."""
    d = numbered(lost, ["cell"], [F.col("case_id")], "rn")
    return d.select(F.concat("cell", F.lit("-retry-"), (F.floor((F.col("rn") - 1) / size) + 1).cast("string")).alias("unit_id"), "case_id")
