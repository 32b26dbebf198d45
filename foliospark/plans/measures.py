"""Queries of evaluation: orders are decisions, batches and gold; line items are signals and records."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.operators import measures as M
from foliospark.session import table

DECISION = (
    "o_orderkey AS decision_id", "o_custkey AS case_id", "CASE o_orderkey % 3 WHEN 0 THEN 'relevant' WHEN 1 THEN 'polarity' ELSE 'who_was_letting' END AS field", "CASE o_custkey % 4 WHEN 0 THEN 'keep' WHEN 1 THEN 'adopt' WHEN 2 THEN 'set' ELSE 'unsure' END AS decision",
    "CASE o_orderkey % 5 WHEN 0 THEN 'false' WHEN 1 THEN NULL ELSE o_orderstatus END AS value", "CASE WHEN o_orderkey % 7 > 0 THEN 'card' END AS card_value", "CASE o_orderkey % 4 WHEN 0 THEN 'False' WHEN 1 THEN NULL ELSE 'other' END AS checker_value",
)
LABEL = """CASE WHEN field = 'relevant' AND decision = 'adopt' THEN CASE WHEN checker_value IS NULL OR lower(checker_value) = 'false' THEN 'withdrawn' ELSE checker_value END WHEN field = 'relevant' AND decision = 'set' AND lower(value) = 'false' THEN 'withdrawn'
  WHEN decision = 'unsure' THEN 'unsure' WHEN decision = 'keep' THEN coalesce(card_value, 'None') WHEN decision = 'adopt' THEN coalesce(checker_value, 'None') ELSE coalesce(value, 'None') END"""
DEC = f"dec AS (SELECT {', '.join(DECISION)} FROM orders), lab AS (SELECT decision_id, case_id, field, {LABEL} AS label FROM dec)"


def _decisions(s, d):
    return table(s, d, "orders").selectExpr(*DECISION)


def _labels(s, d):
    c = [F.col(k) for k in ("field", "decision", "value", "card_value", "checker_value")]
    return _decisions(s, d).select("decision_id", "case_id", "field", M.effective_label(*c).alias("label"))


UNITS = ("o_orderkey AS unit_id", "CASE WHEN o_custkey % 3 > 0 THEN 'ok' ELSE 'failed' END AS status", "o_custkey % 5 AS relevant_accepted")


def _bands(s, d):
    batches = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("batch_id")).agg(F.min("l_returnflag").alias("era"), F.max("l_linestatus").alias("jurisdiction"), F.collect_list(F.col("l_discount") * 8).alias("scores"))
    return M.bands_table(batches, table(s, d, "orders").selectExpr(*UNITS))


BANDS = """bt AS (SELECT l_orderkey AS batch_id, min(l_returnflag) || '|' || max(l_linestatus) AS cell, round(avg(l_discount * 8), 6) AS score, count(*)::INT AS cases FROM lineitem GROUP BY 1),
bands AS (SELECT bt.*, coalesce(o_custkey % 3 > 0, false) AS read, CASE WHEN o_custkey % 3 > 0 THEN o_custkey % 5 END AS relevant FROM bt LEFT JOIN orders ON o_orderkey = batch_id),
bc AS (SELECT round(floor(score / 0.05 + 1e-9) * 0.05, 2) AS band, sum(CASE WHEN read THEN cases ELSE 0 END)::BIGINT AS read_cases, sum(CASE WHEN read THEN relevant ELSE 0 END)::BIGINT AS relevant, sum(CASE WHEN read THEN 0 ELSE cases END)::BIGINT AS unread_cases FROM bands GROUP BY 1)"""
RECORDS = (
    "o_orderkey AS case_id", "CASE o_custkey % 5 WHEN 0 THEN 'missing' WHEN 1 THEN 'partial' WHEN 2 THEN 'extraction-invalid' ELSE 'ok' END AS extraction_status", "CASE WHEN o_custkey % 5 > 0 THEN o_orderkey % 3 > 0 END AS relevant", "o_custkey % 4 AS n_kept", "o_custkey % 2 AS n_dropped",
)
REFERENCE = ("o_orderkey AS case_id", "CASE WHEN o_orderkey % 2 = 0 THEN 'machine' ELSE 'human' END AS source")
READS = tuple((f"o_orderkey AS case_id", f"CASE WHEN o_custkey % {k} = 0 THEN NULL ELSE o_orderstatus END AS polarity", f"o_orderkey % {k} AS era_code") for k in (5, 10))
CASES = ("o_orderkey AS case_id", "o_orderstatus AS era", "o_orderpriority AS jurisdiction")
MENTIONS = ("concat(l_partkey % 300, ' Rep. ', l_suppkey % 10) AS cite", "CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE 1960 + l_partkey % 40 END AS year", "l_returnflag AS source", "concat('see ', l_linestatus, ' ', l_linenumber) AS context", "l_orderkey * 10 + l_linenumber AS ord")


def _orders(s, d, columns):
    return table(s, d, "orders").selectExpr(*columns)


def _draw(s, d):
    return M.audit_draw(_orders(s, d, (*CASES, "o_custkey % 2 = 0 AS relevant", "o_orderstatus AS polarity", "o_orderpriority AS who_was_letting")), 50, "audit")


AUDITED = (
    "o_orderkey AS case_id", "CASE o_custkey % 3 WHEN 0 THEN 'user' WHEN 1 THEN 'a' ELSE 'b' END AS reader", "CASE WHEN o_custkey % 2 = 0 THEN 'relevant' ELSE 'polarity' END AS field", "CASE WHEN o_custkey % 5 = 0 THEN 'unsure' ELSE 'set' END AS decision",
    "o_orderstatus AS value", "CASE WHEN o_custkey % 4 = 0 THEN 'first' END AS initial_value",
)

QUERIES = {
    "l3_effective_labels": (_labels, f"WITH {DEC} SELECT decision_id, case_id, field, label FROM lab"),
    "l3_labels_by_field": (
        lambda s, d: M.labels_by_field(_labels(s, d), ["relevant", "polarity"]),
        f"WITH {DEC}, w AS (SELECT DISTINCT case_id FROM lab WHERE field = 'relevant' AND label = 'withdrawn') SELECT case_id, field, label FROM lab WHERE case_id NOT IN (SELECT case_id FROM w) UNION ALL SELECT case_id, f.field, 'withdrawn' FROM w, (VALUES ('relevant'), ('polarity')) f(field)",
    ),
    "l6_lost_at": (
        lambda s, d: table(s, d, "orders").select("o_orderkey", M.lost_at(F.expr("o_custkey % 4 > 0"), F.expr("CASE o_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'failed' ELSE 'u1' END"), F.expr("o_orderkey % 2 = 0")).alias("stage")),
        "SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN 'unsignaled' WHEN o_custkey % 3 = 0 THEN 'unread' WHEN o_custkey % 3 = 1 THEN 'read-failed' WHEN o_orderkey % 2 = 0 THEN 'withdrawn' ELSE 'reader-negative' END AS stage FROM orders",
    ),
    "l9_band_counts": (lambda s, d: M.band_counts(_bands(s, d)), f"WITH {BANDS} SELECT * FROM bc"),
    "l9_tail_scenarios": (
        lambda s, d: M.tail_scenarios(M.band_counts(_bands(s, d))),
        f"""WITH {BANDS}, l AS (SELECT relevant / read_cases::DOUBLE AS rate FROM bc WHERE read_cases >= 200 ORDER BY band LIMIT 1), u AS (SELECT sum(unread_cases) AS unread FROM bc)
        SELECT scenario, round_even(unread * r, 0)::BIGINT AS expected FROM u, (SELECT 'lowest-read-band' AS scenario, rate AS r FROM l UNION ALL SELECT 'half-lowest-read-band', rate / 2 FROM l UNION ALL SELECT 'observed', 0.11::DOUBLE FROM l)""",
    ),
    "l10_bands_table": (_bands, f"WITH {BANDS} SELECT * FROM bands"),
    "l12_audit_draw": (lambda s, d: _draw(s, d).select("case_id", "draw", "frame_size"), "SELECT o_orderkey AS case_id, row_number() OVER (ORDER BY md5('audit|' || o_orderkey), o_orderkey) AS draw, (SELECT count(*) FROM orders) AS frame_size FROM orders ORDER BY draw LIMIT 50"),
    "l13_audit_outcomes": (
        lambda s, d: M.audit_outcomes(_draw(s, d), _orders(s, d, AUDITED)).select("case_id", "status", "a_polarity", "b_polarity", "initial_relevant", "final_relevant", "drawn_polarity"),
        f"""WITH w AS (SELECT o_orderkey AS case_id, o_orderstatus AS drawn_polarity FROM orders ORDER BY md5('audit|' || o_orderkey), o_orderkey LIMIT 50), x AS (SELECT {', '.join(AUDITED)} FROM orders)
        SELECT case_id, CASE WHEN reader = 'user' AND field = 'relevant' AND decision = 'set' THEN 'decided' ELSE 'unresolved' END AS status, CASE WHEN reader = 'a' AND field = 'polarity' THEN value END AS a_polarity, CASE WHEN reader = 'b' AND field = 'polarity' THEN value END AS b_polarity,
        CASE WHEN reader = 'user' AND field = 'relevant' AND decision = 'set' THEN coalesce(initial_value, value) END AS initial_relevant, CASE WHEN reader = 'user' AND field = 'relevant' AND decision = 'set' THEN value END AS final_relevant, drawn_polarity FROM w JOIN x USING (case_id)""",
    ),
    "l14_composite": (
        lambda s, d: M.composite({"bands": M.band_counts(_bands(s, d)), "labels": _labels(s, d)}).select("measure", "n_rows"),
        f"WITH {BANDS}, {DEC} SELECT 'bands' AS measure, count(*) AS n_rows FROM bc UNION ALL SELECT 'labels', count(*) FROM lab",
    ),
    "l17_candidate_score": (
        lambda s, d: M.candidate_score(_orders(s, d, RECORDS), _orders(s, d, REFERENCE), table(s, d, "customer").selectExpr("CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE round(c_acctbal) END AS cost")).select(*(F.round(c, 6).alias(c) for c in ("fidelity", "agreement_machine_irrelevant", "compliance", "cost_per_accepted")), "accepted", "accepted_full", "missing"),
        f"""WITH r AS (SELECT {', '.join(RECORDS)} FROM orders), m AS (SELECT avg((NOT coalesce(relevant, true))::INT) AS a FROM r WHERE case_id % 2 = 0), c AS (SELECT sum(CASE WHEN c_custkey % 3 > 0 THEN round(c_acctbal) END) AS cost FROM customer),
        k AS (SELECT sum(n_kept) FILTER (WHERE relevant) AS kept, sum(n_dropped) FILTER (WHERE relevant) AS dropped, count(*) AS n, count(*) FILTER (WHERE extraction_status <> 'missing') AS answered, count(*) FILTER (WHERE extraction_status IN ('ok', 'partial') AND relevant IS NOT NULL) AS accepted, count(*) FILTER (WHERE extraction_status = 'ok' AND relevant IS NOT NULL) AS accepted_full FROM r)
        SELECT round(kept / (kept + dropped)::DOUBLE, 6) AS fidelity, round(a, 6) AS agreement_machine_irrelevant, round(answered / n::DOUBLE, 6) AS compliance, round(cost / accepted, 6) AS cost_per_accepted, accepted, accepted_full, n - answered AS missing FROM k, m, c""",
    ),
    "l19_stability": (
        lambda s, d: M.stability(_orders(s, d, READS[0]), _orders(s, d, READS[1]), ["polarity", "era_code"]).select("field", "n", F.round("agreement", 8).alias("agreement")),
        f"""WITH a AS (SELECT {', '.join(READS[0])} FROM orders), b AS (SELECT {', '.join(READS[1])} FROM orders), j AS (SELECT a.polarity IS NOT DISTINCT FROM b.polarity AS p, a.era_code IS NOT DISTINCT FROM b.era_code AS e FROM a JOIN b USING (case_id))
        SELECT 'polarity' AS field, count(*) AS n, round(avg(p::INT), 8) AS agreement FROM j UNION ALL SELECT 'era_code', count(*), round(avg(e::INT), 8) FROM j""",
    ),
    "l20_reference_batches": (
        lambda s, d: M.reference_batches(_orders(s, d, CASES), table(s, d, "lineitem").selectExpr("l_orderkey AS case_id", "concat('s', l_partkey) AS selector_id", "l_linenumber AS version")).select("case_id", "batch", "place", F.array_join(F.transform("signals", lambda x: x["selector_id"]), ",").alias("signals")),
        """WITH c AS (SELECT o_orderkey AS case_id, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS rn FROM orders),
        q AS (SELECT l_orderkey AS case_id, 's' || l_partkey AS s, row_number() OVER (PARTITION BY l_orderkey ORDER BY 's' || l_partkey, l_linenumber) AS r FROM lineitem), g AS (SELECT case_id, string_agg(s, ',' ORDER BY r) AS signals FROM q WHERE r <= 6 GROUP BY 1)
        SELECT c.case_id, (rn - 1) // 18 + 1 AS batch, ((rn - 1) % 18)::INT AS place, coalesce(signals, '') AS signals FROM c LEFT JOIN g USING (case_id)""",
    ),
    "l22_gold_rows": (
        lambda s, d: M.gold_rows(table(s, d, "lineitem").selectExpr(*MENTIONS), table(s, d, "part").selectExpr("p_partkey AS case_id", "concat(p_partkey, ' rep ', p_partkey % 10) AS cite"), {"letting": " o [12]$", "doctrine": " f 3"}).select("cite_norm", "year", F.array_join("sources", ",").alias("sources"), F.array_join("contexts", "|").alias("contexts"), "domain", "case_id"),
        f"""WITH m AS (SELECT {', '.join(MENTIONS)} FROM lineitem), k AS (SELECT *, trim(regexp_replace(lower(replace(cite, '.', ' ')), '\\s+', ' ', 'g')) AS cite_norm FROM m), r AS (SELECT *, row_number() OVER (PARTITION BY cite_norm ORDER BY ord DESC, context DESC) AS n FROM k),
        g AS (SELECT cite_norm, max(year) AS year, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, string_agg(context, '|' ORDER BY n) FILTER (WHERE n <= 3) AS contexts, bool_or(n <= 3 AND regexp_matches(context, '(?i) o [12]$')) AS l, bool_or(n <= 3 AND regexp_matches(context, '(?i) f 3')) AS f FROM r GROUP BY 1)
        SELECT cite_norm, year, sources, contexts, CASE WHEN l THEN 'letting' WHEN f THEN 'doctrine' ELSE 'other' END AS domain, p_partkey AS case_id FROM g LEFT JOIN part ON p_partkey || ' rep ' || p_partkey % 10 = cite_norm WHERE year IS NULL OR year < 1990""",
    ),
    "l23_anchors": (
        lambda s, d: M.anchors(table(s, d, "orders").selectExpr("o_orderkey AS entry_id", "concat('none 1; ', o_custkey, ' Rep.; ', o_orderkey, ' Rep') AS cites"), table(s, d, "part").selectExpr("concat(p_partkey, ' rep') AS cite_norm", "p_partkey AS case_id")).select("entry_id", "case_id"),
        "SELECT o_orderkey AS entry_id, coalesce(a.p_partkey, b.p_partkey) AS case_id FROM orders LEFT JOIN part a ON a.p_partkey = o_custkey LEFT JOIN part b ON b.p_partkey = o_orderkey",
    ),
    "l25_reference_set": (
        lambda s, d: M.reference_set(table(s, d, "customer").selectExpr("c_custkey + 1000000 AS case_id"), _orders(s, d, CASES), 45, "ref"),
        """WITH r AS (SELECT *, md5('ref|' || o_orderkey) AS k, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY md5('ref|' || o_orderkey), o_orderkey) AS rn FROM orders), q AS (SELECT ceil(45.0 / count(DISTINCT (o_orderstatus, o_orderpriority))) AS quota FROM orders)
        SELECT c_custkey + 1000000 AS case_id, 'human' AS source FROM customer UNION ALL SELECT * FROM (SELECT o_orderkey, 'machine' FROM r, q WHERE rn <= quota ORDER BY rn, k, o_orderkey LIMIT 45)""",
    ),
    "l26_subset_batches": (
        lambda s, d: M.subset_batches(table(s, d, "lineitem").selectExpr("l_suppkey AS batch_id", "l_orderkey * 10 + l_linenumber AS case_id", "l_partkey AS place"), 7, table(s, d, "lineitem").filter("l_quantity > 20").selectExpr("l_orderkey * 10 + l_linenumber AS case_id")),
        "SELECT l_suppkey AS batch_id, (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey, l_orderkey * 10 + l_linenumber) - 1) // 7 + 1 AS part, l_orderkey * 10 + l_linenumber AS case_id FROM lineitem WHERE l_orderkey * 10 + l_linenumber IN (SELECT l_orderkey * 10 + l_linenumber FROM lineitem WHERE l_quantity > 20)",
    ),
}
