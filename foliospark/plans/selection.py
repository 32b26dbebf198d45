"""Queries of planning, packing, ranking and budgets. Line items are signals: a case is an order, its parts' residues are selectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.operators import selection as S
from foliospark.session import table

SIGNALS = """sig AS (SELECT l_orderkey AS case_id, l_returnflag AS era, l_linestatus AS jurisdiction, 's' || l_partkey % 5 AS selector_id, l_linenumber % 2 + 1 AS version,
  l_discount * 10 AS cosine, l_suppkey AS chunk_id, 'r' || l_suppkey % 3 AS run_id FROM lineitem)"""


def _signals(s, d):
    li = table(s, d, "lineitem")
    return li.selectExpr("l_orderkey as case_id", "l_returnflag as era", "l_linestatus as jurisdiction", "concat('s', l_partkey % 5) as selector_id", "l_linenumber % 2 + 1 as version", "l_discount * 10 as cosine", "l_suppkey as chunk_id", "concat('r', l_suppkey % 3) as run_id")


def _ids(s, d, where):
    return table(s, d, "orders").filter(where).select(F.col("o_orderkey").alias("case_id"))


def _batches(s, d):
    """The score is rounded as SQL does it, in binary: 0.285 is below 0.285 there and gives 0.28, where round(x, 2) reads it as a decimal and gives 0.29."""
    return table(s, d, "orders").selectExpr("o_orderpriority as cell", "o_orderstatus as era", "o_orderkey as batch_id", "round(o_totalprice / 1000 * 100) / 100 as score", "o_custkey % 4 = 0 as read", "o_custkey % 19 as cases")


BATCHES = "b AS (SELECT o_orderpriority AS cell, o_orderstatus AS era, o_orderkey AS batch_id, round(o_totalprice / 1000, 2) AS score, o_custkey % 4 = 0 AS read, o_custkey % 19 AS cases FROM orders)"


def _units(s, d):
    return table(s, d, "lineitem").selectExpr("concat(l_returnflag, l_linestatus, l_suppkey % 40) as cell", "l_orderkey * 10 + l_linenumber as seq", "l_partkey as seq2", "l_quantity > 5 as completed", "cast(l_tax * 100 as int) % 4 as relevant").groupBy("cell", "seq").agg(F.min("completed").alias("completed"), F.max("relevant").alias("relevant"))


def _walk_units(s, d):
    return table(s, d, "orders").selectExpr("o_orderpriority as cell", "o_orderkey as seq", "true as completed", "o_custkey % 3 as relevant")


UNITS = "u AS (SELECT l_returnflag || l_linestatus || l_suppkey % 40 AS cell, l_orderkey * 10 + l_linenumber AS seq, bool_and(l_quantity > 5) AS completed, max(trunc(l_tax * 100)::INT % 4) AS relevant FROM lineitem GROUP BY 1, 2)"


def _selectors(s, d):
    rows = [("a", 1, "active", ["all"], ["F"]), ("b", 2, "active", ["A", "X"], ["all"]), ("c", 1, "retired", ["all"], ["all"])]
    return s.createDataFrame(rows, "selector_id string, version int, status string, era_scope array<string>, jurisdiction_scope array<string>")


SCOPE = """uni AS (SELECT DISTINCT l_returnflag AS era, l_linestatus AS jurisdiction FROM lineitem), scope AS (
  SELECT DISTINCT 'a' AS selector_id, 1 AS version, era, 'F' AS jurisdiction FROM uni UNION SELECT DISTINCT 'b', 2, e.era, jurisdiction FROM uni, (VALUES ('A'), ('X')) e(era))"""


def _cells(s, d):
    return table(s, d, "lineitem").groupBy(F.col("l_returnflag").alias("era"), F.col("l_linestatus").alias("jurisdiction")).agg(F.count("*").alias("n"))


def _scored(s, d):
    return table(s, d, "orders").selectExpr("o_orderkey as idx", "o_orderkey as case_id", "o_orderstatus as era", "o_orderpriority as jurisdiction", "round(o_totalprice / 5000) as score", "int(o_custkey % 5 = 0) as label", "if(o_custkey % 2 = 0, 3.0D, 1.0D) as weight")


SCORED = "r AS (SELECT o_orderkey AS idx, o_orderkey AS case_id, o_orderstatus AS era, o_orderpriority AS jurisdiction, round(o_totalprice / 5000) AS score, (o_custkey % 5 = 0)::INT AS label, CASE WHEN o_custkey % 2 = 0 THEN 3.0 ELSE 1.0 END::DOUBLE AS weight FROM orders)"
HELD = "h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY era, jurisdiction, label ORDER BY md5('s|' || case_id), case_id) AS q, count(*) OVER (PARTITION BY era, jurisdiction, label) AS n FROM r) WHERE n >= 2 AND q <= ceil(n * 0.25))"


def _pack_sql(score: str, order: str, cell: str, joins: str = "", where: str = "") -> str:
    return f"""WITH {SIGNALS}, c AS (SELECT era, jurisdiction, sig.case_id, count(DISTINCT selector_id) AS density FROM sig {where} GROUP BY ALL),
    k AS (SELECT c.*, {score} AS score, CASE WHEN c.case_id % 3 = 0 THEN 1 END AS gold FROM c {joins}),
    p AS (SELECT *, row_number() OVER (PARTITION BY era, jurisdiction ORDER BY score DESC, case_id) - 1 AS rn FROM k), q AS (SELECT *, rn // 18 AS chunk FROM p),
    b AS (SELECT era, jurisdiction, chunk, row_number() OVER (ORDER BY count(gold) DESC, {order} DESC, {cell}) AS batch_id FROM q GROUP BY era, jurisdiction, chunk)
    SELECT case_id, batch_id, (rn % 18)::INT AS place FROM q JOIN b USING (era, jurisdiction, chunk)"""


QUERIES = {
    "f1_expanded_scope": (lambda s, d: S.expanded_scope(_selectors(s, d), _cells(s, d)), f"WITH {SCOPE} SELECT * FROM scope"),
    "f4_seed_set": (lambda s, d: S.seed_set(_ids(s, d, "o_custkey = 7")).select(F.size("ids").alias("n"), "digest"), "WITH i AS (SELECT array_to_string(list_sort(list(DISTINCT o_orderkey)), ',') AS t, count(DISTINCT o_orderkey)::INT AS n FROM orders WHERE o_custkey = 7) SELECT n, substr(sha256(t), 1, 16) AS digest FROM i"),
    "f5_skip_reason": (
        lambda s, d: S.skip_reason(table(s, d, "part").selectExpr("p_partkey", "element_at(array('phrase','vector','graph','feedback'), int(p_partkey % 4) + 1) as kind", "p_size % 3 as n_seeds", "p_partkey % 5 as missing_cells", "p_size % 4 as n_runs")).select("p_partkey", "skip"),
        """SELECT p_partkey, CASE WHEN p_partkey % 4 IN (2, 3) AND p_size % 3 = 0 THEN 'seed_unavailable' WHEN p_partkey % 4 IN (1, 3) AND p_partkey % 5 > 0 THEN 'index_incomplete' WHEN p_partkey % 4 IN (1, 3) AND p_size % 4 > 1 THEN 'mixed_embedding_model' END AS skip FROM part""",
    ),
    "f6_plan": (
        lambda s, d: S.plan(S.expanded_scope(_selectors(s, d), _cells(s, d)), _cells(s, d), s.createDataFrame([("a", 1, "R", "F")], "selector_id string, version int, era string, jurisdiction string")),
        f"WITH {SCOPE}, n AS (SELECT l_returnflag AS era, l_linestatus AS jurisdiction, count(*) AS n FROM lineitem GROUP BY ALL) SELECT selector_id, version, era, jurisdiction, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'partition_empty' WHEN selector_id = 'a' AND era = 'R' AND jurisdiction = 'F' THEN 'covered' ELSE 'run' END AS action FROM scope LEFT JOIN n USING (era, jurisdiction)",
    ),
    "f10_already_read": (
        lambda s, d: S.already_read(table(s, d, "orders").selectExpr("if(o_orderkey % 9 = 0, 'x', string(o_orderkey)) as case_id"), table(s, d, "customer").selectExpr("string(c_custkey + 20000) as case_id")),
        "SELECT DISTINCT o_orderkey AS case_id FROM orders WHERE o_orderkey % 9 <> 0 UNION SELECT c_custkey + 20000 FROM customer",
    ),
    "f11_attribution": (
        lambda s, d: S.attribution(_ids(s, d, "true"), _signals(s, d)).select("case_id", F.size(F.coalesce("hits", F.array())).alias("n")),
        f"WITH {SIGNALS}, n AS (SELECT case_id, count(DISTINCT (selector_id, run_id, cosine))::INT AS n FROM sig GROUP BY 1) SELECT o_orderkey AS case_id, coalesce(n, 0) AS n FROM orders LEFT JOIN n ON case_id = o_orderkey",
    ),
    "f13_packed": (lambda s, d: S.packed(_signals(s, d), _ids(s, d, "o_orderkey % 3 = 0"), 18), _pack_sql("density", "max(score)", "era, jurisdiction, chunk")),
    "f14_packed_ranked": (
        lambda s, d: S.packed(_signals(s, d), _ids(s, d, "o_orderkey % 3 = 0"), 18, scores=table(s, d, "orders").selectExpr("o_orderkey as case_id", "round(o_totalprice) as score")),
        _pack_sql("round(o_totalprice)", "avg(score)", "era, jurisdiction, chunk", "JOIN orders ON o_orderkey = c.case_id"),
    ),
    "f15_packed_restricted": (
        lambda s, d: S.packed(_signals(s, d), _ids(s, d, "o_orderkey % 3 = 0"), 18, restrict=_ids(s, d, "o_custkey % 2 = 0"), exclude=_ids(s, d, "o_custkey % 5 = 0")),
        _pack_sql("density", "max(score)", "era, jurisdiction, chunk", where="JOIN orders ON o_orderkey = sig.case_id WHERE o_custkey % 2 = 0 AND o_custkey % 5 <> 0"),
    ),
    "g1_g2_signal_summary": (
        lambda s, d: S.signal_summary(_signals(s, d)).select("case_id", F.array_join("labels", ",").alias("labels"), "n_selectors", "best_chunk", F.round("best_cosine", 6).alias("best_cosine")),
        f"WITH {SIGNALS} SELECT case_id, string_agg(DISTINCT selector_id || '@v' || version, ',' ORDER BY selector_id || '@v' || version) AS labels, count(DISTINCT selector_id) AS n_selectors, arg_min(chunk_id, (-cosine, chunk_id)) AS best_chunk, round(max(cosine), 6) AS best_cosine FROM sig GROUP BY case_id",
    ),
    "g3_fusion": (
        lambda s, d: S.fusion(S.signal_summary(_signals(s, d)), ["s1@v1", "s2@v2", "s3@v1"], 0.6, 0.4),
        f"""WITH {SIGNALS}, m AS (SELECT case_id, count(DISTINCT CASE WHEN (selector_id, version) IN (('s1', 1), ('s2', 2), ('s3', 1)) THEN selector_id END) / 3.0::DOUBLE AS h, max(cosine) AS c FROM sig GROUP BY case_id)
        SELECT case_id, round((0.6::DOUBLE * h + 0.4::DOUBLE * greatest(c, 0))::FLOAT::DOUBLE, 6) AS score FROM m""",
    ),
    "g5_logistic_score": (
        lambda s, d: S.logistic_score(table(s, d, "orders").selectExpr("o_orderkey as case_id", "o_totalprice as a", "double(o_custkey) as b"), ["a", "b"], ["a", "b"], [0.5, -0.25], 0.1, [100000.0, 700.0], [50000.0, 400.0]).select("case_id", F.round("probability", 8).alias("probability")),
        "SELECT o_orderkey AS case_id, round(1 / (1 + exp(-(0.1 + (o_totalprice - 100000) / 50000 * 0.5 - (o_custkey - 700) / 400 * 0.25))), 8) AS probability FROM orders",
    ),
    "g7_average_precision": (
        lambda s, d: S.average_precision(_scored(s, d), ["era"]).select("era", F.round("ap", 8).alias("ap")),
        f"""WITH {SCORED}, c AS (SELECT *, sum(label * weight) OVER w AS tp, sum(weight) OVER w AS seen FROM r WINDOW w AS (PARTITION BY era ORDER BY score DESC, idx ROWS UNBOUNDED PRECEDING))
        SELECT era, round(CASE WHEN sum(label * weight) > 0 THEN sum(label * weight * tp / seen) / sum(label * weight) ELSE 0 END, 8) AS ap FROM c GROUP BY era""",
    ),
    "g8_precision_at": (lambda s, d: S.precision_at(_scored(s, d), 200), f"WITH {SCORED} SELECT avg(label) AS precision FROM (SELECT label FROM r ORDER BY score DESC, idx LIMIT 200)"),
    "g11_labelled_reads": (
        lambda s, d: S.labelled_reads(table(s, d, "orders").filter("o_custkey % 3 = 0").selectExpr("o_orderkey as case_id", "o_custkey % 2 = 0 as reviewed"), _ids(s, d, "o_custkey % 5 = 0")),
        "SELECT o_orderkey AS case_id, (o_custkey % 3 = 0)::INT AS label, CASE WHEN o_custkey % 6 = 0 THEN 3.0 ELSE 1.0 END::DOUBLE AS weight FROM orders WHERE o_custkey % 3 = 0 OR o_custkey % 5 = 0",
    ),
    "g13_held_out": (lambda s, d: S.held_out(_scored(s, d), 0.25, "s").select("case_id"), f"WITH {SCORED}, {HELD} SELECT case_id FROM h"),
    "g15_strata_report": (lambda s, d: S.strata_report(_scored(s, d), S.held_out(_scored(s, d), 0.25, "s")), f"WITH {SCORED}, {HELD} SELECT era, jurisdiction, label, count(*) AS n, count(*) FILTER (WHERE case_id IN (SELECT case_id FROM h)) AS held FROM r GROUP BY ALL"),
    "h2_capped_cells": (
        lambda s, d: S.capped_cells(_batches(s, d), {"F": 90.0, "O": 60.0, "P": 20.0}).select("batch_id", "cap", "rank", F.round("head_mean", 6).alias("head_mean")),
        f"""WITH {BATCHES}, e AS (SELECT era, count(*) AS n_era FROM b GROUP BY era), c AS (SELECT b.*, greatest(1, ceil(CASE era WHEN 'F' THEN 90 WHEN 'O' THEN 60 ELSE 20 END * count(*) OVER (PARTITION BY cell) / n_era))::INT AS cap,
          row_number() OVER (PARTITION BY cell ORDER BY score DESC, batch_id) AS rank FROM b JOIN e USING (era))
        SELECT batch_id, cap, rank, round(avg(CASE WHEN rank <= cap THEN score END) OVER (PARTITION BY cell), 6) AS head_mean FROM c""",
    ),
    "h4_h6_walk_order": (
        lambda s, d: S.walk_order(_batches(s, d), 60),
        f"""WITH {BATCHES}, k AS (SELECT *, CASE WHEN read THEN 0 WHEN row_number() OVER (PARTITION BY cell, read ORDER BY score DESC, batch_id) <= 60 - count(*) FILTER (WHERE read) OVER (PARTITION BY cell) THEN 1 ELSE 2 END AS class FROM b)
        SELECT batch_id, class, row_number() OVER (ORDER BY class, score DESC, batch_id) AS position FROM k""",
    ),
    "h7_completed": (
        lambda s, d: S.completed_batches(table(s, d, "orders").selectExpr("concat('b', o_custkey, if(o_orderkey % 2 = 0, concat('-part', o_orderkey % 3), '')) as unit_id", "if(o_orderstatus = 'F', 'ok', 'failed') as status", "o_orderkey % 2 as cases_read")),
        "SELECT DISTINCT 'b' || o_custkey AS batch_id FROM orders WHERE o_orderstatus = 'F' OR o_orderkey % 2 > 0",
    ),
    "h9_yield_stops": (
        lambda s, d: S.yield_stops(_units(s, d), 12),
        f"""WITH {UNITS}, c AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY seq) AS rn, sum(relevant) OVER (PARTITION BY cell ORDER BY seq ROWS 2 PRECEDING) AS gain FROM u WHERE completed),
        x AS (SELECT *, CASE WHEN rn >= 12 THEN 'cap' WHEN rn >= 3 AND gain <= 2 THEN 'yield' END AS reason FROM c)
        SELECT cell, min(rn) AS stop_at, arg_min(reason, rn) AS reason FROM x WHERE reason IS NOT NULL GROUP BY cell""",
    ),
    "h10_budget_walk": (
        lambda s, d: S.budget_walk(S.walk_order(_batches(s, d), 60).join(_batches(s, d).select("batch_id", "cell", "cases"), "batch_id"), 20000, S.yield_stops(_walk_units(s, d), 900, least=0)).select("batch_id", "position"),
        f"""WITH {BATCHES}, k AS (SELECT *, CASE WHEN read THEN 0 WHEN row_number() OVER (PARTITION BY cell, read ORDER BY score DESC, batch_id) <= 60 - count(*) FILTER (WHERE read) OVER (PARTITION BY cell) THEN 1 ELSE 2 END AS class FROM b),
        w AS (SELECT batch_id, cell, cases, row_number() OVER (ORDER BY class, score DESC, batch_id) AS position FROM k), n AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY position) AS rn FROM w),
        y AS (SELECT o_orderpriority AS cell, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn, sum(o_custkey % 3) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS 2 PRECEDING) AS gain FROM orders),
        t AS (SELECT cell, min(rn) AS stop_at FROM y WHERE rn >= 900 OR (rn >= 3 AND gain <= 0) GROUP BY cell),
        q AS (SELECT n.*, coalesce(sum(cases) OVER (ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n LEFT JOIN t USING (cell) WHERE stop_at IS NULL OR rn <= stop_at)
        SELECT batch_id, position FROM q WHERE before < 20000""",
    ),
    "h15_retry_units": (
        lambda s, d: S.retry_units(table(s, d, "orders").selectExpr("o_orderstatus as cell", "o_orderkey as case_id")),
        "SELECT o_orderstatus || '-retry-' || ((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 18 + 1) AS unit_id, o_orderkey AS case_id FROM orders",
    ),
}
