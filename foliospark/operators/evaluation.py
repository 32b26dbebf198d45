"""How well readers and audits do: field scores with their macro, audit precision with its parts, reads with their fallback, agreement without bulk-adopted rounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.operators.evidence import wilson
from foliospark.operators.reports import agreement


def reader_scores(predictions: DataFrame, reference: DataFrame, fields: dict[str, list[str] | None], excluded: DataFrame | None = None) -> DataFrame:
    """field, n_reference_decided, n_both_decided, n_prediction_irrelevant, decided_rate and agreement_decided of every field, and a row 'macro' with the mean agreement.

    predictions, reference: case_id and a text column for each field; `relevant` is 'true' or 'false'. fields: the values that count as decided, or None for any. excluded: (case_id, field) that
    don't count. A field other than relevant counts only where both sides call the case relevant; n_prediction_irrelevant says how many cases that takes away. Without cases a rate is 0.
    """
    known = lambda c, values: c.isNotNull() if values is None else F.coalesce(c.isin(values), F.lit(False))
    both = reference.select("case_id", *(F.col(f).alias(f"r_{f}") for f in fields)).join(predictions.select("case_id", *(F.col(f).alias(f"p_{f}") for f in fields)), "case_id")
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), known(F.col(f"r_{f}"), v).alias("r"), known(F.col(f"p_{f}"), v).alias("p"), F.col(f"r_{f}").eqNullSafe(F.col(f"p_{f}")).alias("same")) for f, v in fields.items())))
    gate = (F.col("r_relevant") == "true") & (F.col("p_relevant") == "true")
    d = both.select("case_id", F.coalesce(gate, F.lit(False)).alias("gate"), each.alias("e")).select("case_id", "gate", "e.*").filter("r")
    if excluded is not None:
        d = d.join(excluded.select("case_id", "field").distinct(), ["case_id", "field"], "left_anti")
    d = d.withColumn("counts", F.col("gate") | (F.col("field") == "relevant"))
    sums = d.groupBy("field").agg(F.count_if("counts").alias("n"), F.count_if(F.col("counts") & F.col("p")).alias("m"), F.count_if(F.col("counts") & F.col("p") & F.col("same")).alias("a"), F.count_if(~F.col("counts")).alias("gone"))
    every = predictions.sparkSession.createDataFrame([(f,) for f in fields], "field string")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    out = every.join(sums, "field", "left").fillna(0).select("field", F.col("n").alias("n_reference_decided"), F.col("m").alias("n_both_decided"), F.col("gone").alias("n_prediction_irrelevant"), share("m", "n").alias("decided_rate"), share("a", "m").alias("agreement_decided"))
    none = F.lit(None)
    macro = out.agg(F.avg("agreement_decided").alias("agreement_decided")).select(F.lit("macro").alias("field"), *(none.cast("long").alias(c) for c in ("n_reference_decided", "n_both_decided", "n_prediction_irrelevant")), none.cast("double").alias("decided_rate"), "agreement_decided")
    return out.unionByName(macro)


def audit_precision(sample: DataFrame, outcomes: DataFrame, fields: list[str], subgroup: str) -> DataFrame:
    """measure, scope, k, n, rate, lo and hi: what a blind reading says of a sample of records.

    sample: case_id and each field at the time of the draw. outcomes: case_id, status, final_relevant and, for each field, initial_<field> and final_<field>; initial_relevant. Only decided records
    count. precision: kept as relevant; accuracy:<field>: unchanged among the relevant; joint: relevant with all fields unchanged, of all decided; revised:<field> (and relevant): final unlike initial. scope is 'all' or 'subgroup',
    a condition on the draw's fields. decided and unresolved are counts of all sampled records; sampled records without an outcome are unresolved. An outcome of no sampled record fails the job.
    """
    d = sample.withColumn("__in", F.lit(True)).join(outcomes, "case_id", "full")
    stray = F.raise_error(F.concat(F.lit("not in the sample: case "), F.col("case_id").cast("string"))).cast("boolean")
    d = d.withColumn("__in", F.coalesce("__in", stray)).withColumn("decided", F.col("__in") & (F.coalesce("status", F.lit("missing")) == "decided"))
    relevant = F.coalesce("final_relevant", F.lit(False))
    same = {f: F.col(f).eqNullSafe(F.col(f"final_{f}")) for f in fields}
    whole = reduce(Column.__and__, same.values(), relevant)
    revised = {f: ~F.col(f"initial_{f}").eqNullSafe(F.col(f"final_{f}")) for f in ("relevant", *fields)}
    yes = F.lit(True)
    measures = [("precision", relevant, yes), *((f"accuracy:{f}", relevant & t, relevant) for f, t in same.items()), ("joint", whole, yes), *((f"revised:{f}", t, yes) for f, t in revised.items())]
    of = {"all": yes, "subgroup": F.coalesce(F.expr(subgroup), F.lit(False))}
    aggs = [F.count_if(F.col("decided") & s & t).alias(f"{scope}|{name}|{k}") for scope, s in of.items() for name, hit, base in measures for k, t in (("k", hit & base), ("n", base))]
    one = d.agg(*aggs, F.count_if("decided").alias("__d"), F.count_if(~F.col("decided")).alias("__u"))
    rows = [F.struct(F.lit(name).alias("measure"), F.lit(scope).alias("scope"), F.col(f"`{scope}|{name}|k`").alias("k"), F.col(f"`{scope}|{name}|n`").alias("n")) for scope in of for name, *_ in measures]
    rows += [F.struct(F.lit(name).alias("measure"), F.lit("all").alias("scope"), F.col(c).alias("k"), (F.col("__d") + F.col("__u")).alias("n")) for name, c in (("decided", "__d"), ("unresolved", "__u"))]
    out = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    w = wilson(F.col("k"), F.col("n"))
    return out.withColumn("rate", F.when(F.col("n") > 0, F.col("k") / F.col("n"))).withColumn("lo", F.when(F.col("n") > 0, w["lo"])).withColumn("hi", F.when(F.col("n") > 0, w["hi"]))


def read_by(units: DataFrame, admits: DataFrame) -> DataFrame:
    """case_id and run: the run that read each case.

    units: run, place (the order in which units are looked at), ok, case_ids. The first unit that read a case has it; one that failed only until another read it ('read-failed' else).
    admits: case_id, seq, run_id of admissions: a case that no unit names was read by the run of its first admission, or by 'unknown-run'.
    """
    named = units.select("run", "place", "ok", F.explode("case_ids").alias("case_id"))
    best = named.groupBy("case_id").agg(F.min_by(F.when(F.col("ok"), F.col("run")).otherwise("read-failed"), F.struct(~F.col("ok"), "place")).alias("run"))
    rest = admits.join(best.select("case_id"), "case_id", "left_anti").groupBy("case_id").agg(F.min_by(F.struct("run_id"), "seq")["run_id"].alias("run_id"))
    return best.unionByName(rest.select("case_id", F.coalesce("run_id", F.lit("unknown-run")).alias("run")))


def agreement_by_round(decisions: DataFrame, rounds: DataFrame, user: str = "user") -> tuple[DataFrame, DataFrame]:
    """(agreement of each pair of readers, rounds excluded) with rounds (round, kind, user_mode) taken into account.

    A round whose user adopted one reader's view in bulk has no user pairs and is listed as excluded with its number of cards; the other pairs stay. exposure is 'blind' for audit rounds.
    """
    bulk = F.coalesce(F.col("user_mode") == "bulk", F.lit(False))
    d = decisions.join(F.broadcast(rounds), "round")  # a registry of rounds
    kept = agreement(d.filter(~(bulk & (F.col("reader") == user))).select("round", "case_id", "reader", "field", "value"))
    exposure = F.when(F.col("kind") == "audit", "blind").otherwise("exposure-affected")
    excluded = d.filter(bulk).groupBy("round").agg(F.count_distinct("case_id").alias("cards"))
    return kept.join(F.broadcast(rounds.select("round", exposure.alias("exposure"))), "round"), excluded
