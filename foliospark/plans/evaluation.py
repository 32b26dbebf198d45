"""Queries of readers' scores, audits, reads and agreement by round, and of lines around hits."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.operators import evaluation as V
from foliospark.operators import positions as P
from foliospark.operators import search as S
from foliospark.plans.base import CASES, cases, index
from foliospark.plans.search import WHOLE
from foliospark.session import table


def _orders(s, d, *columns):
    return table(s, d, "orders").selectExpr(*columns)


REF = ("o_orderkey AS case_id", "CASE WHEN o_custkey % 5 > 0 THEN 'true' ELSE 'false' END AS relevant", "CASE o_orderstatus WHEN 'F' THEN 'favorable' WHEN 'O' THEN 'adverse' ELSE 'irrelevant' END AS polarity", "CASE WHEN o_custkey % 4 > 0 THEN o_orderpriority END AS who")
PRED = ("o_orderkey AS case_id", "CASE WHEN o_orderkey % 7 > 0 THEN 'true' WHEN o_orderkey % 14 = 0 THEN NULL ELSE 'false' END AS relevant", "CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN 'adverse' WHEN o_orderstatus = 'F' THEN 'favorable' ELSE 'adverse' END AS polarity", "CASE WHEN o_orderkey % 9 = 0 THEN '5-LOW' ELSE o_orderpriority END AS who")
SAMPLE = ("o_orderkey AS case_id", "o_orderstatus AS polarity", "o_orderpriority AS who")
OUT = ("o_orderkey AS case_id", "CASE WHEN o_custkey % 11 = 0 THEN 'unreadable' ELSE 'decided' END AS status", "o_custkey % 6 > 0 AS final_relevant", "o_custkey % 5 > 0 AS initial_relevant", "CASE WHEN o_orderkey % 3 = 0 THEN 'F' ELSE o_orderstatus END AS final_polarity", "o_orderstatus AS initial_polarity", "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS final_who", "o_orderpriority AS initial_who")
Z = 1.959963984540054


def _reads(s, d):
    units = table(s, d, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.collect_set("l_orderkey").alias("case_ids"))
    units = units.select(F.concat(F.lit("run"), F.col("l_linenumber")).alias("run"), (F.col("l_linenumber") * 100000 + F.col("l_suppkey")).alias("place"), (F.col("l_suppkey") % 3 > 0).alias("ok"), "case_ids").filter("place % 5 <> 0")
    return V.read_by(units, _orders(s, d, "o_orderkey + 3 AS case_id", "o_custkey AS seq", "if(o_custkey % 3 = 0, null, concat('adm', o_custkey)) AS run_id"))


def _rounds(s, d):
    decisions = _orders(s, d, "concat('r', o_orderkey % 3) AS round", "o_custkey AS case_id", "element_at(array('claude', 'astra', 'user'), int(o_orderkey % 7 % 3) + 1) AS reader", "'relevant' AS field", "if(o_totalprice > 150000, 'y', 'n') AS value").groupBy("round", "case_id", "reader", "field").agg(F.min("value").alias("value"))
    rounds = decisions.select("round").distinct().selectExpr("round", "if(round = 'r2', 'audit', 'historical') AS kind", "if(round = 'r1', 'bulk', 'cards') AS user_mode")
    return V.agreement_by_round(decisions, rounds)


ROUNDS = """x AS (SELECT 'r' || o_orderkey % 3 AS round, o_custkey AS c, ['claude', 'astra', 'user'][o_orderkey % 7 % 3 + 1] AS r, min(CASE WHEN o_totalprice > 150000 THEN 'y' ELSE 'n' END) AS v FROM orders GROUP BY ALL)"""
HIT = f"{WHOLE}(in[^\\p{{L}}\\p{{N}}]+the)($|[^\\p{{L}}\\p{{N}}])"

QUERIES = {
    "l16_reader_scores": (
        lambda s, d: V.reader_scores(_orders(s, d, *PRED), _orders(s, d, *REF), {"relevant": None, "polarity": ["favorable", "adverse", "mixed"], "who": None}, _orders(s, d, "o_orderkey AS case_id", "'who' AS field").filter("case_id % 8 = 0")).withColumns({c: F.round(c, 8) for c in ("decided_rate", "agreement_decided")}),
        f"""WITH r AS (SELECT {", ".join(REF)} FROM orders), p AS (SELECT {", ".join(PRED)} FROM orders), b AS (SELECT r.case_id, r.relevant AS rr, p.relevant AS pr, r.polarity AS rp, p.polarity AS pp, r.who AS rw, p.who AS pw FROM r JOIN p USING (case_id)),
        e AS (SELECT 'relevant' AS field, true AS c, rr IS NOT NULL AS r, pr IS NOT NULL AS p, rr = pr AS same FROM b UNION ALL SELECT 'polarity', coalesce(rr = 'true' AND pr = 'true', false), rp IN ('favorable', 'adverse', 'mixed'), coalesce(pp IN ('favorable', 'adverse', 'mixed'), false), rp = pp FROM b
          UNION ALL SELECT 'who', coalesce(rr = 'true' AND pr = 'true', false), rw IS NOT NULL, pw IS NOT NULL, rw = pw FROM b WHERE case_id % 8 <> 0),
        g AS (SELECT field, count(*) FILTER (WHERE c) AS n, count(*) FILTER (WHERE c AND p) AS m, count(*) FILTER (WHERE c AND p AND same) AS a, count(*) FILTER (WHERE NOT c) AS gone FROM e WHERE r GROUP BY field)
        SELECT field, n AS n_reference_decided, m AS n_both_decided, gone AS n_prediction_irrelevant, round(m / n, 8) AS decided_rate, round(a / m, 8) AS agreement_decided FROM g UNION ALL SELECT 'macro', NULL, NULL, NULL, NULL, round(avg(a / m), 8) FROM g""",
    ),
    "l7_audit_precision": (
        lambda s, d: V.audit_precision(_orders(s, d, *SAMPLE), _orders(s, d, *OUT).filter("case_id % 13 > 0"), ["polarity", "who"], "polarity = 'F' and who = '1-URGENT'").withColumns({c: F.round(c, 8) for c in ("rate", "lo", "hi")}),
        f"""WITH x AS (SELECT a.polarity, a.who, o.*, coalesce(status, 'missing') = 'decided' AS dec FROM (SELECT {", ".join(SAMPLE)} FROM orders) a LEFT JOIN (SELECT {", ".join(OUT)} FROM orders WHERE o_orderkey % 13 > 0) o USING (case_id)),
        y AS (SELECT *, coalesce(final_relevant, false) AS rel, polarity IS NOT DISTINCT FROM final_polarity AS p, who IS NOT DISTINCT FROM final_who AS w FROM x WHERE dec),
        s AS (SELECT 'all' AS scope, * FROM y UNION ALL SELECT 'subgroup', * FROM y WHERE polarity = 'F' AND who = '1-URGENT'),
        m AS (SELECT scope, unnest(['precision', 'accuracy:polarity', 'accuracy:who', 'joint', 'revised:relevant', 'revised:polarity', 'revised:who']) AS measure,
          unnest([rel, rel AND p, rel AND w, rel AND p AND w, initial_relevant IS DISTINCT FROM final_relevant, initial_polarity IS DISTINCT FROM final_polarity, initial_who IS DISTINCT FROM final_who]) AS hit, unnest([true, rel, rel, true, true, true, true]) AS base FROM s),
        k AS (SELECT measure, scope, count(*) FILTER (WHERE hit AND base) AS k, count(*) FILTER (WHERE base) AS n FROM m GROUP BY ALL UNION ALL SELECT 'decided', 'all', count(*) FILTER (WHERE dec), count(*) FROM x UNION ALL SELECT 'unresolved', 'all', count(*) FILTER (WHERE NOT dec), count(*) FROM x)
        SELECT *, round(k / n, 8) AS rate, round((k / n + {Z} * {Z} / (2 * n) - {Z} * sqrt(k / n * (1 - k / n) / n + {Z} * {Z} / (4.0 * n * n))) / (1 + {Z} * {Z} / n), 8) AS lo, round((k / n + {Z} * {Z} / (2 * n) + {Z} * sqrt(k / n * (1 - k / n) / n + {Z} * {Z} / (4.0 * n * n))) / (1 + {Z} * {Z} / n), 8) AS hi FROM k""",
    ),
    "l11_read_by": (
        _reads,
        """WITH n AS (SELECT DISTINCT 'run' || l_linenumber AS run, l_linenumber * 100000 + l_suppkey AS place, l_suppkey % 3 > 0 AS ok, l_orderkey AS case_id FROM lineitem WHERE (l_linenumber * 100000 + l_suppkey) % 5 <> 0),
        b AS (SELECT case_id, CASE WHEN ok THEN run ELSE 'read-failed' END AS run FROM n QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY NOT ok, place) = 1),
        a AS (SELECT o_orderkey + 3 AS case_id, CASE WHEN o_custkey % 3 > 0 THEN 'adm' || o_custkey END AS r FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_custkey) = 1)
        SELECT * FROM b UNION ALL SELECT case_id, coalesce(r, 'unknown-run') FROM a WHERE case_id NOT IN (SELECT case_id FROM b)""",
    ),
    "l4_agreement_by_round": (
        lambda s, d: _rounds(s, d)[0].select("round", "reader_a", "reader_b", "field", "n", F.round("agreement", 6).alias("agreement"), "exposure"),
        f"""WITH {ROUNDS}, y AS (SELECT * FROM x WHERE NOT (round = 'r1' AND r = 'user')) SELECT a.round, a.r AS reader_a, b.r AS reader_b, 'relevant' AS field, count(*) AS n, round(avg((a.v = b.v)::INT), 6) AS agreement, CASE WHEN a.round = 'r2' THEN 'blind' ELSE 'exposure-affected' END AS exposure
        FROM y a JOIN y b ON a.round = b.round AND a.c = b.c AND a.r < b.r GROUP BY ALL""",
    ),
    "l4_excluded_rounds": (lambda s, d: _rounds(s, d)[1], f"WITH {ROUNDS} SELECT round, count(DISTINCT c) AS cards FROM x WHERE round = 'r1' GROUP BY round"),
    "c12_kwic_of_hits": (
        lambda s, d: S.kwic_of_hits(cases(s, d), P.phrase_spans(s, index(s, d), P.Phrase("in the")), 60, 50, eras=["late"], jurisdictions=[f"src{i}" for i in range(0, 20, 2)]),
        f"""WITH {CASES}, m AS (SELECT *, strip_accents(norm_text) AS f FROM cases WHERE era = 'late' AND jurisdiction IN ({", ".join(f"'src{i}'" for i in range(0, 20, 2))}) AND regexp_matches(strip_accents(norm_text), '{HIT}') ORDER BY case_id LIMIT 60),
        p AS (SELECT *, length(regexp_extract(f, '^(.*?){HIT}', 1)) + length(regexp_extract(f, '^(.*?){HIT}', 2)) AS b, length(regexp_extract(f, '^(.*?){HIT}', 3)) AS n FROM m)
        SELECT case_id, substr(norm_text, greatest(b - 50, 0) + 1, b - greatest(b - 50, 0)) AS "left", substr(norm_text, b + 1, n) AS term, substr(norm_text, b + n + 1, 50) AS "right" FROM p""",
    ),
}
