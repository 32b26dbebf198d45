"""Queries of manifests, tallies, review lists and evaluation reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.operators import positions as P
from foliospark.operators import reports as R
from foliospark.plans.base import CASES, cases, index
from foliospark.plans.search import ANY, PHRASES, _match
from foliospark.session import table

GOLD = "g AS (SELECT o_orderstatus AS tier, o_custkey AS case_id FROM orders)"

TERMS = {"one": P.any_of(PHRASES), "two": P.Phrase("with"), "three": P.All((P.Phrase("of"), P.Phrase("and th*")))}
TERMS_SQL = f"l AS (SELECT 'one' AS label, *, {ANY} AS hit FROM cases UNION ALL SELECT 'two', *, {_match('with')} FROM cases UNION ALL SELECT 'three', *, {_match('of')} AND {_match('and th*')} FROM cases)"


def _orders(s, d, *columns):
    return table(s, d, "orders").selectExpr(*columns)


def _decisions(s, d):
    return _orders(s, d, "concat('r', o_orderkey % 2) as round", "o_custkey as case_id", "o_orderstatus as reader", "'relevant' as field", "if(o_totalprice > 150000, 'y', 'n') as value").groupBy("round", "case_id", "reader", "field").agg(F.min("value").alias("value"))


QUERIES = {
    "f18_run_manifest": (
        lambda s, d: R.run_manifest(_orders(s, d, "o_custkey as case_id", "o_orderstatus as era", "o_orderpriority as jurisdiction")).withColumn("partitions", F.array_join("partitions", ",")),
        """WITH b AS (SELECT o_custkey % 4096 AS b, sha256(string_agg(DISTINCT o_custkey::VARCHAR, ',' ORDER BY o_custkey::VARCHAR)) AS h FROM orders GROUP BY 1)
        SELECT (SELECT count(*) FROM orders) AS n, (SELECT count(DISTINCT o_custkey) FROM orders) AS n_cases, (SELECT string_agg(DISTINCT o_orderstatus || '|' || o_orderpriority, ',' ORDER BY o_orderstatus || '|' || o_orderpriority) FROM orders) AS partitions, sha256(string_agg(h, ',' ORDER BY b)) AS digest FROM b""",
    ),
    "f19_gold_ids": (lambda s, d: R.gold_ids(_orders(s, d, "if(o_orderkey % 2 = 0, o_custkey, null) as case_id")), "SELECT DISTINCT o_custkey AS case_id FROM orders WHERE o_orderkey % 2 = 0"),
    "h1_mean_scores": (
        lambda s, d: R.mean_scores(table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("batch_id")).agg(F.collect_list(F.expr("if(l_linenumber = 2, 0.0D, l_quantity)")).alias("scores"))).select("batch_id", F.round("mean", 6).alias("mean")),
        "SELECT l_orderkey AS batch_id, round(avg(CASE WHEN l_linenumber = 2 THEN 0 ELSE l_quantity END), 6) AS mean FROM lineitem GROUP BY l_orderkey",
    ),
    "h3_pooled_cells": (lambda s, d: R.pooled_cells(_orders(s, d, "o_orderpriority as cell", "if(o_custkey % 3 = 0, null, o_totalprice) as score")).select("cell", "n", F.round("mean", 4).alias("mean")), "SELECT o_orderpriority AS cell, count(*) AS n, round(avg(CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_totalprice END), 4) AS mean FROM orders GROUP BY 1"),
    "h8_chosen_cells": (lambda s, d: R.chosen_cells(_orders(s, d, "o_orderstatus as cell", "o_orderkey as batch_id"), ["F", "P"]), "SELECT o_orderstatus AS cell, o_orderkey AS batch_id FROM orders WHERE o_orderstatus IN ('F', 'P')"),
    "h11_unit_tallies": (
        lambda s, d: R.unit_tallies(table(s, d, "lineitem").selectExpr("l_orderkey as unit_id", "l_partkey as case_id", "l_quantity > 25 as relevant", "element_at(array('ok','partial','missing','failed'), int(l_suppkey % 4) + 1) as status")),
        """SELECT l_orderkey AS unit_id, count(*) FILTER (WHERE l_suppkey % 4 < 2) AS answered, count(*) FILTER (WHERE l_suppkey % 4 < 2 AND l_quantity > 25) AS relevant, count(*) FILTER (WHERE l_suppkey % 4 < 2 AND l_quantity <= 25) AS irrelevant,
        count(*) FILTER (WHERE l_suppkey % 4 < 2) AS accepted, count(*) FILTER (WHERE l_suppkey % 4 >= 2) AS lost, count(*) FILTER (WHERE l_suppkey % 4 < 2) > 0 AS completed FROM lineitem GROUP BY 1""",
    ),
    "h13_merged_manifests": (
        lambda s, d: R.merged_manifests(_orders(s, d, "o_orderkey as unit_id", "1 as at", "o_custkey as cases_read"), _orders(s, d, "o_orderkey + 7000 as unit_id", "2 as at", "o_custkey + 1 as cases_read")),
        "WITH u AS (SELECT o_orderkey AS unit_id, 1 AS t, o_custkey AS cases_read FROM orders UNION ALL SELECT o_orderkey + 7000, 2, o_custkey + 1 FROM orders) SELECT unit_id, arg_max(cases_read, t) AS cases_read, max(t) AS \"at\" FROM u GROUP BY unit_id",
    ),
    "h14_lost_cases": (lambda s, d: R.lost_cases(_orders(s, d, "o_orderkey as case_id"), table(s, d, "lineitem").filter("l_linenumber = 3").selectExpr("l_orderkey as case_id")), "SELECT o_orderkey AS case_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 3)"),
    "j14_counted": (lambda s, d: R.counted(_orders(s, d, "o_orderkey as case_id", "o_custkey % 2 = 0 as in_file", "o_custkey % 3 = 0 as relevant", "if(o_orderkey % 5 = 0, 1, null) as duplicate_of")).select("case_id"), "SELECT o_orderkey AS case_id FROM orders WHERE o_custkey % 6 = 0 AND o_orderkey % 5 <> 0"),
    "j18_cycle_manifest": (
        lambda s, d: R.cycle_manifest(_orders(s, d, "o_custkey as case_id", "o_orderkey as seq", "o_orderstatus as cycle", "o_totalprice > 100000 as relevant")),
        "SELECT o_custkey AS case_id, arg_max(o_orderstatus, o_orderkey) AS cycle, CASE WHEN arg_max(o_totalprice > 100000, o_orderkey) THEN 'relevant' ELSE 'irrelevant' END AS outcome FROM orders GROUP BY 1",
    ),
    "j22_admitted_by_cell": (lambda s, d: R.admitted_by_cell(_orders(s, d, "o_orderstatus as era", "o_orderpriority as jurisdiction", "o_custkey % 3 = 0 as relevant")), "SELECT o_orderstatus AS era, o_orderpriority AS jurisdiction, count(*) FILTER (WHERE o_custkey % 3 = 0) AS relevant, count(*) FILTER (WHERE o_custkey % 3 <> 0) AS irrelevant FROM orders GROUP BY ALL"),
    "k5_last_human_decision": (
        lambda s, d: R.last_human_decision(_orders(s, d, "o_custkey as case_id", "o_orderstatus as field", "o_orderkey as seq").filter("seq % 3 = 0"), _orders(s, d, "o_custkey as case_id", "o_orderstatus as field", "o_orderkey as seq", "o_orderpriority as value").filter("seq % 3 = 1")),
        """WITH c AS (SELECT o_custkey AS k, o_orderstatus AS f, o_orderkey AS s, o_orderpriority AS v FROM orders), j AS (SELECT a.k, a.f, a.s AS seq, b.f AS bf, b.s, b.v FROM c a LEFT JOIN c b ON a.k = b.k AND b.s % 3 = 1 AND b.s < a.s WHERE a.s % 3 = 0)
        SELECT k AS case_id, f AS field, seq, coalesce(arg_max(v, s) FILTER (WHERE bf = f), arg_max(v, s)) AS value FROM j GROUP BY k, f, seq""",
    ),
    "k6_admitted_in_order": (lambda s, d: R.admitted_in_order(_orders(s, d, "o_custkey as case_id", "o_orderkey as seq", "o_orderstatus as run_id"), "F"), "SELECT o_custkey AS case_id, min(o_orderkey) AS seq FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"),
    "k7_checker_status": (
        lambda s, d: R.checker_status(table(s, d, "customer").selectExpr("c_custkey as case_id"), _orders(s, d, "o_custkey as case_id", "element_at(array('ok','unparsed','failed'), int(o_orderkey % 3) + 1) as status").filter("case_id % 4 <> 0")),
        "SELECT c_custkey AS case_id, CASE min(o_orderkey % 3) WHEN 0 THEN 'ok' WHEN 1 THEN 'unparsed' WHEN 2 THEN 'failed' ELSE 'missing' END AS status FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_custkey % 4 <> 0 GROUP BY 1",
    ),
    "k11_suspects": (lambda s, d: R.suspects(table(s, d, "part").selectExpr("p_partkey as case_id", "p_type as summary", "p_name as notes"), "steel|blue").select("case_id"), "SELECT p_partkey AS case_id FROM part WHERE regexp_matches(p_type || ' ' || p_name, '(?i)steel|blue')"),
    "k14_balanced_parts": (
        lambda s, d: R.balanced_parts(table(s, d, "part").selectExpr("p_partkey as card_id", "p_size as size"), 7).select("card_id", "part"),
        "SELECT p_partkey AS card_id, floor(coalesce(sum(p_size) OVER (ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 7 / (sum(p_size) OVER ())::DOUBLE)::INT AS part FROM part",
    ),
    "l4_agreement": (
        lambda s, d: R.agreement(_decisions(s, d)).select("round", "reader_a", "reader_b", "field", "n", *(F.round(c, 6).alias(c) for c in ("agreement", "kappa"))),
        """WITH x AS (SELECT 'r' || o_orderkey % 2 AS round, o_custkey AS c, o_orderstatus AS r, min(CASE WHEN o_totalprice > 150000 THEN 'y' ELSE 'n' END) AS v FROM orders GROUP BY ALL), p AS (SELECT a.round, a.r AS reader_a, b.r AS reader_b, (a.v = 'y')::INT AS a, (b.v = 'y')::INT AS b FROM x a JOIN x b ON a.round = b.round AND a.c = b.c AND a.r < b.r),
        g AS (SELECT round, reader_a, reader_b, count(*) AS n, avg((a = b)::INT) AS o, avg(a) * avg(b) + (1 - avg(a)) * (1 - avg(b)) AS e FROM p GROUP BY ALL)
        SELECT round, reader_a, reader_b, 'relevant' AS field, n, round(o, 6) AS agreement, CASE WHEN e < 1 THEN round((o - e) / (1 - e), 6) END AS kappa FROM g""",
    ),
    "l7_confusion": (lambda s, d: R.confusion(_orders(s, d, "o_orderstatus as drawn", "o_orderpriority as final", "o_custkey % 9 = 0 as withdrawn")), "SELECT o_orderstatus AS drawn, CASE WHEN o_custkey % 9 = 0 THEN 'withdrawn' ELSE o_orderpriority END AS final, count(*) AS n FROM orders GROUP BY ALL"),
    "l11_first_success": (
        lambda s, d: R.first_success(_orders(s, d, "o_custkey as case_id", "o_orderkey as run_id", "to_date(o_orderdate) as started", "if(o_orderstatus = 'F', 'ok', 'failed') as status")),
        "SELECT case_id, run_id, status FROM (SELECT o_custkey AS case_id, o_orderkey AS run_id, CASE WHEN o_orderstatus = 'F' THEN 'ok' ELSE 'failed' END AS status, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus <> 'F', CAST(o_orderdate AS DATE), o_orderkey) AS r FROM orders) WHERE r = 1",
    ),
    "l21_recall_by_tier": (lambda s, d: R.recall_by_tier(_orders(s, d, "o_orderstatus as tier", "o_custkey as case_id"), table(s, d, "customer").filter("c_acctbal > 3000").selectExpr("c_custkey as case_id")), f"WITH {GOLD} SELECT tier, count(*) AS n, count(c_custkey) AS found, round(count(c_custkey) / count(*)::DOUBLE, 3) AS recall FROM g LEFT JOIN customer ON c_custkey = case_id AND c_acctbal > 3000 GROUP BY tier"),
    "g9_ranking_views": (
        lambda s, d: R.ranking_views(_orders(s, d, "o_orderkey as idx", "o_totalprice as score", "int(o_custkey % 5 = 0) as label", "1.0D as weight", "o_custkey % 2 = 0 as reviewed")).select("view", F.round("ap", 8).alias("ap")),
        """WITH r AS (SELECT o_orderkey AS idx, o_totalprice AS score, (o_custkey % 5 = 0)::INT AS label, o_custkey % 2 = 0 AS reviewed FROM orders), v AS (SELECT 'all' AS view, * FROM r UNION ALL SELECT 'reviewed', * FROM r WHERE reviewed OR label = 0),
        c AS (SELECT *, sum(label) OVER w AS tp, row_number() OVER w AS k FROM v WINDOW w AS (PARTITION BY view ORDER BY score DESC, idx)) SELECT view, round(sum(label * tp / k::DOUBLE) / sum(label), 8) AS ap FROM c GROUP BY view""",
    ),
    "m3_quote_matches": (lambda s, d: R.quote_matches(table(s, d, "part").selectExpr("p_partkey as case_id", "array(p_name, p_type) as quotes"), ["promo*", "small brass"]).select("case_id"), "SELECT p_partkey AS case_id FROM part WHERE regexp_matches(p_name || ' | ' || p_type, '(?i)\\b(promo|small\\s+brass\\b)')"),
    "m9_concordance_answer": (
        lambda s, d: R.concordance_answer(cases(s, d), P.matching_labels(s, index(s, d), TERMS), [*TERMS]),
        f"WITH {CASES}, {TERMS_SQL}, t AS (SELECT label, era, jurisdiction, count(*) AS docs, count(*) FILTER (WHERE hit) AS matches FROM l GROUP BY ALL) SELECT *, round(1000 * matches / docs::DOUBLE, 3) AS rate FROM t",
    ),
    "m9_concordance_earliest": (
        lambda s, d: R.concordance_earliest(cases(s, d), P.matching_labels(s, index(s, d), TERMS)),
        f"WITH {CASES}, {TERMS_SQL} SELECT label, row_number() OVER (PARTITION BY label ORDER BY year, case_id)::INT AS rank, case_id, year, jurisdiction, cite FROM l WHERE hit AND year IS NOT NULL QUALIFY row_number() OVER (PARTITION BY label ORDER BY year, case_id) <= 5",
    ),
    "i15_spend": (lambda s, d: R.spend(_orders(s, d, "if(o_custkey % 7 = 0, null, round(o_totalprice)) as cost", "o_custkey as tokens")), "SELECT sum(CASE WHEN o_custkey % 7 <> 0 THEN round(o_totalprice) END) AS cost, sum(o_custkey)::BIGINT AS tokens, count(*) FILTER (WHERE o_custkey % 7 = 0) AS unpriced FROM orders"),
    "i16_vocabulary": (lambda s, d: R.outside_vocabulary(_orders(s, d, "o_orderkey as case_id", "o_orderstatus as polarity"), {"polarity": ["F", "O"]}), "SELECT o_orderkey AS case_id, 'polarity' AS field, o_orderstatus AS value FROM orders WHERE o_orderstatus NOT IN ('F', 'O')"),
}
