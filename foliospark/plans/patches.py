"""Queries of records and patches: events are the log (as in `ledger`), orders and documents are records and decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.operators import patches as P
from foliospark.operators import review as RV
from foliospark.operators.folding import SUPPORTED
from foliospark.plans.ledger import FOLD_SQL, LOG, PROTECT, _folded, _log
from foliospark.session import table

NEW = (
    "user_id AS case_id", "event_id AS ord", "'c1' AS cycle", "'set' AS op", "CASE WHEN event_id % 2 = 0 THEN 'polarity' ELSE 'characterization' END AS field", "concat('\"n', CAST(event_id % 3 AS STRING), '\"') AS new", "CASE WHEN event_id % 5 = 0 THEN 'bob' END AS reviewer",
    "CASE WHEN event_id % 5 > 0 AND event_id % 7 > 0 THEN 'm2' END AS model", "'mapper-v3' AS prompt_version", "'r2' AS run_id",
)


def _new(s, d):
    return table(s, d, "events").filter("event_type = 'view'").selectExpr(*NEW).withColumn("rule_id", F.lit(None).cast("string"))


RECORDS = (
    "doc_id AS case_id", "lang AS cite", "source AS jurisdiction", "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE doc_id % 3 > 0 END AS relevant", "CASE WHEN doc_id % 4 > 0 THEN 'favorable' END AS polarity", "CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'owner' END AS who_was_letting",
    "CASE WHEN doc_id % 7 = 0 THEN ' seen ' END AS notes", "CASE WHEN doc_id % 9 = 0 THEN 'c' END AS checker_note",
)
SNAP = ("o_orderkey AS case_id", "o_orderstatus AS cycle", "CASE WHEN o_custkey % 4 > 0 THEN 1990 + o_custkey % 9 END AS year", "o_orderkey * 2 AS admit_seq")
READS = [tuple(x.format(k=k) for x in ("o_orderkey AS case_id", "o_custkey % {k} > 0 AS relevant", "CASE WHEN o_custkey % {k} = 1 THEN 'missing' ELSE 'ok' END AS extraction_status", "CASE WHEN o_orderkey % {k} > 1 THEN concat('p', CAST(o_custkey % {k} AS STRING)) END AS polarity", "CASE WHEN o_custkey % 2 = 0 THEN 'x' END AS era")) for k in (5, 6)]
PAIRS_OLD = ("o_orderkey AS case_id", "CASE o_custkey % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'partial' WHEN 2 THEN 'extraction-invalid' ELSE 'other' END AS old_status", "CASE o_orderkey % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'partial' ELSE 'extraction-invalid' END AS new_status")
DECISIONS = ("o_orderkey AS case_id", "CASE WHEN o_custkey % 3 = 0 THEN 'relevant' ELSE 'polarity' END AS field", "CASE o_custkey % 4 WHEN 0 THEN 'keep' WHEN 1 THEN 'adopt' WHEN 2 THEN 'set' ELSE 'unsure' END AS decision", "CASE WHEN o_custkey % 3 = 0 THEN 'False' ELSE o_orderstatus END AS value", "CASE WHEN o_custkey % 5 > 0 THEN 'chk' END AS checker_value")
J25 = ("CASE WHEN o_orderkey % 2 = 0 THEN array('a', 'b') ELSE array('b') END AS old_nulled", "CASE WHEN o_custkey % 3 = 0 THEN array('c', 'a') ELSE array('b') END AS new_nulled", "CASE WHEN o_custkey % 5 = 0 THEN array('b', 'c') ELSE array('b') END AS filled")


def _orders(s, d, columns):
    return table(s, d, "orders").selectExpr(*columns)


def _evidence(s, d):
    quote = lambda *texts: F.array(*(F.struct(t.alias("text"), F.lit("1").alias("page")) for t in texts))
    rows = _orders(s, d, (*PAIRS_OLD, *J25, "o_orderstatus", "o_orderpriority"))
    return rows.withColumn("old_quotes", quote(F.lit("q"), F.col("o_orderstatus"))).withColumn("new_quotes", quote(F.col("o_orderpriority"), F.lit("F")))


CARDS = ("o_orderkey AS case_id", "CASE o_custkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS section", "CASE WHEN o_custkey % 2 = 0 THEN 'polarity' ELSE 'era' END AS field")
SHEET = "CASE WHEN o_custkey % {k} = 0 THEN NULL ELSE o_orderstatus END AS label"

QUERIES = {
    "j12_records_where": (
        lambda s, d: P.records_where(_orders(s, d, ("o_orderkey AS case_id", "o_orderstatus AS era", "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 'x' END AS polarity")), {"era": "F", "polarity": None}).select("case_id"),
        "SELECT o_orderkey AS case_id FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 3 = 0",
    ),
    "j12_histories": (lambda s, d: P.histories(_log(s, d), table(s, d, "customer").selectExpr("c_custkey AS case_id").filter("case_id % 2 = 0")).select("case_id", "seq", "op"), f"WITH {LOG} SELECT case_id, seq, op FROM lg WHERE case_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)"),
    "j13_favorable_seed": (
        lambda s, d: P.favorable_seed(_orders(s, d, ("o_orderkey AS case_id", "o_custkey % 2 = 0 AS in_file", "CASE WHEN o_custkey % 3 = 0 THEN 'favorable' ELSE 'mixed' END AS polarity")), _orders(s, d, ("o_orderkey AS case_id", "o_orderstatus")).filter("o_orderstatus = 'F'"), 77),
        "WITH i AS (SELECT o_orderkey AS c FROM orders WHERE o_custkey % 6 = 0 AND o_orderstatus = 'F'), b AS (SELECT c % 4096 AS b, count(*) AS n, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS h FROM i GROUP BY 1) SELECT sum(n)::BIGINT AS n, substr(sha256('77|' || string_agg(h, ',' ORDER BY b)), 1, 16) AS digest FROM b",
    ),
    "j19_snapshot": (lambda s, d: P.snapshot(_orders(s, d, SNAP)).select("case_id", "cycle", "line"), f"WITH r AS (SELECT {', '.join(SNAP)} FROM orders) SELECT case_id, cycle, row_number() OVER (PARTITION BY cycle ORDER BY coalesce(year, 0), admit_seq) AS line FROM r"),
    "j20_applied": (
        lambda s, d: P.applied(_log(s, d), _new(s, d), 1_000_000, PROTECT, "ord").groupBy("outcome").agg(F.count("*").alias("n")),
        None,
    ),
    "j21_admission_patches": (
        lambda s, d: P.admission_patches(table(s, d, "documents").selectExpr(*RECORDS), ["cite", "jurisdiction"], ["polarity", "who_was_letting"]),
        f"""WITH r AS (SELECT {', '.join(RECORDS)} FROM documents), p AS (SELECT case_id, 0 AS o, 'admit' AS op, '' AS field, '{{"case_id":' || case_id || ',"cite":"' || cite || '","jurisdiction":"' || jurisdiction || '"}}' AS new FROM r
        UNION ALL SELECT case_id, 1, 'set', 'polarity', '"' || polarity || '"' FROM r WHERE relevant AND polarity IS NOT NULL UNION ALL SELECT case_id, 2, 'set', 'who_was_letting', '"' || who_was_letting || '"' FROM r WHERE relevant AND who_was_letting <> ''
        UNION ALL SELECT case_id, 3, 'append', 'review.notes', '"reader: ' || trim(notes) || '"' FROM r WHERE relevant AND notes IS NOT NULL UNION ALL SELECT case_id, 4, 'append', 'review.notes', '"' || checker_note || '"' FROM r WHERE relevant AND checker_note IS NOT NULL)
        SELECT case_id, (row_number() OVER (PARTITION BY case_id ORDER BY o) - 1)::INT AS place, op, field, new FROM p""",
    ),
    "j24_reread_fields": (
        lambda s, d: P.reread_fields(_orders(s, d, READS[0]), _orders(s, d, READS[1]).filter("case_id % 11 > 0"), ["polarity", "era"], _orders(s, d, ("o_orderkey AS case_id", "CASE WHEN o_custkey % 2 = 0 THEN 'relevant' ELSE 'polarity' END AS field"))),
        f"""WITH a AS (SELECT {', '.join(READS[0]).replace('STRING', 'VARCHAR')} FROM orders), b AS (SELECT {', '.join(READS[1]).replace('STRING', 'VARCHAR')} FROM orders WHERE o_orderkey % 11 > 0),
        j AS (SELECT a.case_id, a.polarity AS ap, b.polarity AS bp, a.era AS ae, b.era AS be, o_custkey % 2 = 0 AS hr, CASE WHEN b.extraction_status IS NULL OR b.extraction_status = 'missing' THEN 'unreadable' WHEN NOT b.relevant THEN CASE WHEN o_custkey % 2 = 0 THEN 'carded' ELSE 'withdrawn' END END AS w FROM a LEFT JOIN b USING (case_id) JOIN orders ON o_orderkey = a.case_id)
        SELECT case_id, NULL AS field, w AS outcome FROM j WHERE w IS NOT NULL UNION ALL SELECT case_id, 'polarity', CASE WHEN bp IS NULL THEN 'skipped' WHEN ap IS NULL THEN 'fill' WHEN ap = bp THEN 'agree' WHEN NOT hr THEN 'conflict' ELSE 'replace' END FROM j WHERE w IS NULL
        UNION ALL SELECT case_id, 'era', CASE WHEN be IS NULL THEN 'skipped' WHEN ae IS NULL THEN 'fill' WHEN ae = be THEN 'agree' ELSE 'replace' END FROM j WHERE w IS NULL""",
    ),
    "j25_merged_evidence": (
        lambda s, d: P.merged_evidence(_evidence(s, d)).select("case_id", F.array_join("nulled_fields", ",").alias("nulled"), "extraction_status", F.array_join(F.transform("quotes", lambda q: q["text"]), "|").alias("quotes")),
        f"""WITH r AS (SELECT {', '.join(PAIRS_OLD)}, {', '.join(J25).replace('array(', 'list_value(')}, o_orderstatus, o_orderpriority FROM orders), u AS (SELECT *, list_concat(old_nulled, list_filter(new_nulled, lambda x: NOT list_contains(old_nulled, x))) AS al FROM r), n AS (SELECT *, list_filter(al, lambda x: NOT list_contains(filled, x)) AS nulled FROM u),
        k AS (SELECT *, CASE old_status WHEN 'ok' THEN 1 WHEN 'partial' THEN 2 WHEN 'extraction-invalid' THEN 3 ELSE 4 END AS a, CASE new_status WHEN 'ok' THEN 1 WHEN 'partial' THEN 2 ELSE 3 END AS b FROM n)
        SELECT case_id, array_to_string(nulled, ',') AS nulled, CASE WHEN len(nulled) = 0 AND a <> 3 AND b <> 3 THEN 'ok' WHEN a >= b THEN old_status ELSE new_status END AS extraction_status,
          array_to_string(list_concat(['q', o_orderstatus], list_filter([o_orderpriority, 'F'], lambda x: NOT list_contains(['q', o_orderstatus], x))), '|') AS quotes FROM k""",
    ),
    "j26_checker_notes": (
        lambda s, d: P.checker_notes(_orders(s, d, ("o_custkey AS case_id", "o_orderkey AS ord", "o_orderstatus AS field", "'a' AS reader_value", "o_orderpriority AS checker_value")).filter("ord % 3 = 0"), table(s, d, "customer").selectExpr("c_custkey AS case_id"), "m", ("polarity", "era")),
        """WITH t AS (SELECT o_custkey AS case_id, 'checker:m: ' || string_agg(o_orderstatus || ' ''a'' vs ''' || o_orderpriority || '''', '; ' ORDER BY o_orderkey) AS note FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1)
        SELECT * FROM t UNION ALL SELECT c_custkey, 'checker:m: unit sampled, no disagreement recorded on polarity, era' FROM customer WHERE c_custkey NOT IN (SELECT case_id FROM t)""",
    ),
    "j27_unsupported_fields": (
        lambda s, d: P.unsupported_fields(_orders(s, d, ("o_orderkey AS case_id", "o_custkey % 5 > 0 AS in_file", "o_custkey % 3 > 0 AS relevant", "CASE WHEN o_custkey % 2 = 0 THEN 'mapper-v3:x' END AS prompt_version", "'p' AS polarity", "CASE WHEN o_custkey % 4 = 0 THEN 'r' END AS restriction_nature")), _orders(s, d, ("o_orderkey AS case_id",)).filter("case_id % 7 > 0"), table(s, d, "lineitem").filter("l_linenumber = 1").selectExpr("l_orderkey AS case_id", "array('polarity') AS supports"), SUPPORTED),
        """WITH r AS (SELECT * FROM orders WHERE o_custkey % 5 > 0 AND o_custkey % 3 > 0 AND o_orderkey % 7 > 0) SELECT o_orderkey AS case_id, 'polarity' AS field FROM r WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1) UNION ALL SELECT o_orderkey, 'restriction_nature' FROM r WHERE o_custkey % 4 = 0""",
    ),
    "j28_superseded_flags": (
        lambda s, d: P.superseded_flags(_orders(s, d, DECISIONS), _orders(s, d, ("o_orderkey AS case_id", "CASE WHEN o_orderkey % 2 = 0 THEN array('needs-review:polarity') ELSE array('x') END AS flags")), "polarity"),
        "SELECT o_orderkey AS case_id FROM orders WHERE o_custkey % 3 > 0 AND o_custkey % 4 IN (1, 2) AND o_orderkey % 2 = 0",
    ),
    "j28_outdated_values": (lambda s, d: P.outdated_values(_orders(s, d, ("o_orderkey AS case_id", "o_orderstatus AS polarity")), {"polarity": ["F", "O"]}), "SELECT o_orderkey AS case_id, 'polarity' AS field, o_orderstatus AS value FROM orders WHERE o_orderstatus NOT IN ('F', 'O')"),
    "j30_decision_patches": (
        lambda s, d: P.mirrored(P.decision_patches(_orders(s, d, DECISIONS), _orders(s, d, ("o_orderkey AS case_id", "'polarity' AS field")).filter("case_id % 2 = 0")), _orders(s, d, ("o_orderkey AS loser", "o_orderkey + 1000000 AS winner")).filter("loser % 10 = 0")),
        f"""WITH d AS (SELECT {', '.join(DECISIONS)} FROM orders), f AS (SELECT *, case_id % 2 = 0 AND field = 'polarity' AS flagged, CASE WHEN decision = 'adopt' THEN checker_value ELSE value END AS v FROM d),
        p AS (SELECT case_id, 'set' AS op, field, CASE WHEN lower(v) IN ('true', 'false') THEN lower(v) WHEN v IS NULL THEN 'null' ELSE '"' || v || '"' END AS new FROM f WHERE decision IN ('adopt', 'set') UNION ALL SELECT case_id, 'unflag', 'review.flags', '"needs-review:' || field || '"' FROM f WHERE decision <> 'unsure' AND flagged
          UNION ALL SELECT case_id, 'append', 'review.flags', '"needs-review:' || field || '"' FROM f WHERE decision = 'unsure' AND NOT flagged UNION ALL SELECT case_id, 'set', 'review.status', '"reviewed"' FROM f WHERE decision <> 'unsure')
        SELECT * FROM p UNION ALL SELECT case_id + 1000000, op, field, new FROM p WHERE case_id % 10 = 0""",
    ),
    "j31_decision_errors": (
        lambda s, d: P.decision_errors(_orders(s, d, DECISIONS), _orders(s, d, ("o_orderkey AS case_id", "CASE WHEN o_orderkey % 3 = 0 THEN 'era' ELSE 'polarity' END AS decide_field")).filter("case_id % 5 > 0")),
        "SELECT o_orderkey AS case_id, CASE WHEN o_custkey % 3 = 0 THEN 'relevant' ELSE 'polarity' END AS field, CASE WHEN o_orderkey % 5 = 0 THEN 'not a card of the round' ELSE 'the card decides era' END AS error FROM orders WHERE o_orderkey % 5 = 0 OR (o_custkey % 3 > 0 AND o_orderkey % 3 = 0)",
    ),
    "j31_drifted": (
        lambda s, d: P.drifted(_orders(s, d, ("o_orderkey AS case_id", "o_orderstatus AS polarity")), _orders(s, d, ("o_orderkey AS case_id", "CASE WHEN o_custkey % 6 = 0 THEN NULL ELSE o_orderstatus END AS polarity")).filter("case_id % 8 > 0"), ("polarity",)),
        "SELECT o_orderkey AS case_id FROM orders WHERE o_custkey % 6 = 0 OR o_orderkey % 8 = 0",
    ),
    "j33_projected_counts": (
        lambda s, d: P.projected_counts(_log(s, d).filter("seq % 2 = 0"), _log(s, d).filter("seq % 2 = 1"), 10**9, "polarity").filter("n_after > 0").select("value", "n_after"),
        f"WITH {FOLD_SQL.replace(f'seq <= {PROTECT}', 'true')}, inf AS (SELECT case_id FROM d2 JOIN cs USING (case_id) WHERE field = 'relevant' AND applied AND seq <= opened GROUP BY case_id HAVING arg_max(value, seq) = 'true'), v AS (SELECT c.case_id, max(value) FILTER (WHERE field = 'polarity') AS value FROM cs c LEFT JOIN ends USING (case_id) WHERE c.case_id IN (FROM inf) GROUP BY 1) SELECT value, count(*) AS n_after FROM v GROUP BY 1",
    ),
    "j17_empty_cells": (
        lambda s, d: table(s, d, "orders").groupBy(F.col("o_orderstatus").alias("era"), F.col("o_orderpriority").alias("jurisdiction")).agg(F.count("*").alias("human_reviewed")).transform(lambda g: RV.empty_cells(g, "human_reviewed", 100)),
        "SELECT o_orderstatus AS era, o_orderpriority AS jurisdiction, count(*) AS human_reviewed FROM orders GROUP BY 1, 2 HAVING count(*) < 100",
    ),
    "k3_fuzzy_classes": (lambda s, d: RV.fuzzy_classes(table(s, d, "part").selectExpr("p_partkey AS case_id", "concat(p_name, ' ', p_type) AS quote", "concat('x ', replace(p_name, 'a', CASE WHEN p_size % 2 = 0 THEN 'o' ELSE 'abcdef' END), ' ', p_type) AS source")).select("case_id", "classification"), None),
    "k4_source_windows": (
        lambda s, d: RV.source_windows(table(s, d, "documents").selectExpr("doc_id AS case_id", "trim(substring(text, 30, 60)) AS quote", "text", "doc_id % 2 = 0 AS clean")).select("case_id", F.md5("source").alias("source")),
        "SELECT doc_id AS case_id, md5(CASE WHEN coalesce(trim(substr(text, 30, 60)), '') = '' THEN substr(coalesce(text, ''), 1, 1200) ELSE substr(text, greatest(1, strpos(text, trim(substr(text, 30, 60))) - 140), strpos(text, trim(substr(text, 30, 60))) + length(trim(substr(text, 30, 60))) + 140 - greatest(1, strpos(text, trim(substr(text, 30, 60))) - 140)) END) AS source FROM documents",
    ),
    "k8_legacy_lists": (
        lambda s, d: RV.legacy_lists(_orders(s, d, ("o_orderkey AS case_id", "o_custkey % 2 = 0 AS relevant", "CASE WHEN o_custkey % 4 = 0 THEN 'favorable' ELSE 'mixed' END AS polarity", "CASE WHEN o_custkey % 3 = 0 THEN 'householder' END AS who_was_letting", "'nights' AS duration_of_occupancy", "o_custkey % 5 = 0 AS polarity_nulled")), _orders(s, d, ("o_custkey AS case_id", "o_orderstatus AS field", "'b' AS batch_id")), table(s, d, "part").selectExpr("p_partkey AS case_id", "p_name AS quote"), table(s, d, "part").filter("p_size > 20").selectExpr("p_partkey AS case_id", "p_name AS quote", "p_brand AS verdict")),
        """SELECT 'fuzzy' AS list, p_partkey AS case_id, p_name AS detail, CASE WHEN p_size > 20 THEN p_brand END AS verdict FROM part UNION ALL SELECT DISTINCT 'disagreement', o_custkey, o_orderstatus, NULL FROM orders UNION ALL SELECT 'nulled', o_orderkey, 'polarity', NULL FROM orders WHERE o_custkey % 10 = 0
        UNION ALL SELECT 'householder-nights', o_orderkey, NULL, NULL FROM orders WHERE o_custkey % 12 = 0""",
    ),
    "k9_threeway_tally": (
        lambda s, d: RV.threeway(_orders(s, d, CARDS), *(_orders(s, d, ("o_orderkey AS case_id", CARDS[2], SHEET.format(k=k))).filter("label is not null") for k in (3, 5)))[1],
        """SELECT CASE o_custkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS section, count(*) FILTER (WHERE o_custkey % 3 > 0 AND o_custkey % 5 > 0) AS agree, count(*) FILTER (WHERE NOT (o_custkey % 3 > 0 AND o_custkey % 5 > 0)) AS disagree FROM orders GROUP BY 1""",
    ),
    "k10_erased_values": (
        lambda s, d: RV.erased_values(_orders(s, d, ("o_orderkey AS case_id", "CASE WHEN o_custkey % 2 = 0 THEN array('polarity', 'era') ELSE array('era') END AS nulled_fields")), _orders(s, d, ("o_orderkey AS case_id", "concat('{\"polarity\": \"', o_orderstatus, '\"}') AS record"))),
        "SELECT o_orderkey AS case_id, 'polarity' AS field, o_orderstatus AS value FROM orders WHERE o_custkey % 2 = 0",
    ),
    "k12_negative_treatment": (lambda s, d: RV.negative_treatment(table(s, d, "part").selectExpr("p_partkey AS case_id", "concat(p_name, CASE WHEN p_size % 3 = 0 THEN ' was Overruled by' WHEN p_size % 3 = 1 THEN ' declines' ELSE ' declined to follow' END) AS passage")).select("case_id"), "SELECT p_partkey AS case_id FROM part WHERE p_size % 3 <> 1"),
    "k12_targets": (
        lambda s, d: RV.prescreen_targets(_orders(s, d, ("o_custkey AS case_id", "CASE WHEN o_orderkey % 2 = 0 THEN 'favorable' END AS polarity", "'householder' AS who_was_letting", "CASE WHEN o_orderkey % 3 = 0 THEN 'nights' END AS duration_of_occupancy", "CASE WHEN o_orderkey % 7 = 0 THEN array('abrogation-risk:x') ELSE array('y') END AS flags"))),
        "SELECT DISTINCT o_custkey AS case_id FROM orders WHERE o_orderkey % 6 = 0 OR o_orderkey % 7 = 0",
    ),
    "k13_contested": (
        lambda s, d: RV.contested(_orders(s, d, ("o_custkey AS case_id", "o_orderstatus AS field", "o_orderkey AS reader", "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS value"))).select("case_id", "field", "majority", "majority_n", "non_null_n", F.size("candidates").alias("n")),
        """WITH v AS (SELECT o_custkey AS case_id, o_orderstatus AS field, CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END AS value FROM orders), c AS (SELECT case_id, field, value, count(*) AS k FROM v WHERE value IS NOT NULL GROUP BY ALL), m AS (SELECT *, row_number() OVER (PARTITION BY case_id, field ORDER BY k DESC, value) AS r FROM c),
        g AS (SELECT case_id, field, count(*)::INT AS n, count(value) AS non_null_n FROM v GROUP BY ALL HAVING count(DISTINCT value) > 1) SELECT case_id, field, value AS majority, k AS majority_n, non_null_n, n FROM g JOIN m USING (case_id, field) WHERE r = 1""",
    ),
}
