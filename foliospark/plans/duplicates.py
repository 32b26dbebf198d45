"""Queries of duplicates and parallel reports.

Names that copies share are their first words, so near copies group; a document's reporter goes by its id, and reporter 0 is official.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators import duplicates as D
from foliospark.plans.base import CASES, cases
from foliospark.session import table

OFFICIAL = "(case_id % 3 = 0)"


def _cases(s, d):
    c = cases(s, d).withColumn("official", F.expr(OFFICIAL))
    return c.withColumn("year", F.lit(None).cast("int")).withColumn("jurisdiction", F.lit("all"))


def _citations(s, d):
    c = cases(s, d)
    return c.select("case_id", T.cite_key(F.concat(F.col("name"), F.lit(". "), F.length("norm_text").cast("string"))).alias("cite_norm"))


def _pairs(s, d):
    return D.scored_pairs(D.candidate_groups(_cases(s, d)))


SHINGLE = "list_distinct(CASE WHEN len(w) >= {n} THEN list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(list_slice(w, i, i + {n} - 1), ' ')) ELSE [] END)"
PAIRS = f"""{CASES}, g0 AS (SELECT *, {OFFICIAL} AS official, trim(regexp_replace(regexp_replace(lower(name), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')) AS name_key FROM cases),
g AS (SELECT court, name_key, arg_min(case_id, (CASE WHEN official THEN 0 ELSE 1 END) * 1000000000 + case_id) AS winner FROM g0 WHERE length(name_key) >= 6 GROUP BY court, name_key HAVING count(DISTINCT reporter) > 1),
mem AS MATERIALIZED (SELECT g0.*, g.winner, regexp_extract_all(norm_text, '[a-z0-9]+') AS w FROM g0 JOIN g USING (court, name_key)),
sh AS MATERIALIZED (SELECT case_id, winner, decision_date, {SHINGLE.format(n=3)} AS s3, {SHINGLE.format(n=5)} AS s5 FROM mem),
pairs AS MATERIALIZED (SELECT a.winner, a.case_id AS loser,
  CASE WHEN least(len(a.s3), len(b.s3)) > 0 THEN round_even(len(list_intersect(a.s3, b.s3)) / least(len(a.s3), len(b.s3)), 4) ELSE 0 END AS c3,
  CASE WHEN least(len(a.s5), len(b.s5)) > 0 THEN round_even(len(list_intersect(a.s5, b.s5)) / least(len(a.s5), len(b.s5)), 4) ELSE 0 END AS c5,
  coalesce(a.decision_date <> '' AND b.decision_date <> '' AND (starts_with(a.decision_date, b.decision_date) OR starts_with(b.decision_date, a.decision_date)), false) AS date_ok,
  (len(a.s5) > 0 AND len(b.s5) > 0 AND len(b.s5) >= 0.5 * len(a.s5) AND len(b.s5) <= 2 * len(a.s5)) AS size_ok, least(len(a.s5), len(b.s5)) >= 50 AS long_enough
  FROM sh a JOIN sh b ON b.case_id = a.winner WHERE a.case_id <> a.winner)"""
LABEL = "CASE WHEN c5 >= 0.9 THEN 'same' WHEN (winner + loser) % 7 = 0 THEN 'unsure' WHEN c5 >= 0.55 THEN 'same' ELSE 'different' END"
MARKS = "marks AS (SELECT loser, winner, CASE WHEN loser % 2 = 0 THEN 'even' ELSE 'odd' END AS method FROM pairs WHERE c5 >= 0.5)"


def _labelled(s, d):
    return _pairs(s, d).withColumn("label", F.expr(LABEL))


def _marked(pairs):
    return pairs.filter("c5 >= 0.5").select("loser", "winner", F.expr("case when loser % 2 = 0 then 'even' else 'odd' end").alias("method"))


def _marks(s, d):
    return _marked(_pairs(s, d))


def _applied(pairs):
    return D.apply_merges(pairs.filter("c3 >= 0.3"), _marked(pairs).filter("method = 'even'"))


def _ledger(s, d):
    
    return table(s, d, "labels").select(F.col("doc_id").alias("case_id"), (F.col("quality") == 1).alias("relevant"), (F.col("doc_id") % 5 != 0).alias("in_file"), (F.col("toxic") == 1).alias("reviewed"), (F.col("doc_id") % 4).alias("quotes"))


B16_LEDGER = ("doc_id AS case_id", "CASE WHEN doc_id % 6 = 0 THEN NULL ELSE doc_id % 4 < 3 END AS relevant", "CASE WHEN doc_id % 9 = 0 THEN doc_id - 1 END AS duplicate_of")
B16_VALUES = ("doc_id AS case_id", "'polarity' AS field", "CASE WHEN doc_id % 7 = 0 THEN 'against' ELSE 'for' END AS value", "doc_id % 2 = 0 AS human")


def _merged(s, d):
    return D.candidate_groups(_cases(s, d)).select("case_id", "winner")


LEDGER = "ledger AS (SELECT doc_id AS case_id, quality = 1 AS relevant, doc_id % 5 <> 0 AS in_file, toxic = 1 AS reviewed, doc_id % 4 AS quotes FROM labels)"

QUERIES = {
    "b1_citation_duplicates": (
        lambda s, d: D.citation_duplicates(_citations(s, d), cases(s, d).filter(OFFICIAL).select("case_id")),
        f"""WITH {CASES}, c AS (SELECT DISTINCT case_id, trim(regexp_replace(lower(replace(name || '. ' || length(norm_text), '.', ' ')), '\\s+', ' ', 'g')) AS k, {OFFICIAL} AS off FROM cases),
        p AS (SELECT DISTINCT x.case_id AS a, y.case_id AS b, x.off AS ao, y.off AS bo FROM c x JOIN c y ON x.k = y.k AND x.case_id < y.case_id),
        m AS (SELECT a, b, CASE WHEN ao OR NOT bo THEN b ELSE a END AS loser, CASE WHEN ao OR NOT bo THEN a ELSE b END AS winner FROM p)
        SELECT loser, winner FROM (SELECT *, row_number() OVER (PARTITION BY loser ORDER BY a, b) AS r FROM m) WHERE r = 1""",
    ),
    "b2_candidate_groups": (lambda s, d: D.candidate_groups(_cases(s, d)).select("case_id", "court", "name_key", "winner"), f"WITH {PAIRS} SELECT case_id, court, name_key, winner FROM mem"),
    "b3_b7_scored_pairs": (_pairs, f"WITH {PAIRS} SELECT * FROM pairs"),
    "b6_guarded_pairs": (lambda s, d: _pairs(s, d).filter("size_ok and long_enough"), f"WITH {PAIRS} SELECT * FROM pairs WHERE size_ok AND long_enough"),
    "b9_ledger_winner": (
        lambda s, d: D.ledger_winner(D.candidate_groups(_cases(s, d)).select(F.concat_ws("|", "court", "name_key").alias("group"), "case_id", "official"), _ledger(s, d)),
        f"""WITH {PAIRS}, {LEDGER}, o AS (SELECT court || '|' || name_key AS "group", case_id, row_number() OVER (PARTITION BY court, name_key ORDER BY
          CASE WHEN relevant THEN 0 WHEN relevant IS NOT NULL THEN 1 ELSE 2 END, CASE WHEN reviewed THEN 0 ELSE 1 END, -coalesce(quotes, 0), CASE WHEN official THEN 0 ELSE 1 END, case_id) AS r
          FROM mem LEFT JOIN ledger USING (case_id)) SELECT "group", case_id AS winner FROM o WHERE r = 1""",
    ),
    "b10_banded_sample": (
        lambda s, d: D.banded_sample(_pairs(s, d).withColumn("date_ok", F.lit(True)), 5, "seed").select("winner", "loser", "band"),
        f"""WITH {PAIRS}, b AS (SELECT winner, loser, floor(c5 * 10 + 1e-9)::INT AS band FROM pairs WHERE size_ok AND long_enough AND c5 >= 0.2)
        SELECT winner, loser, band FROM (SELECT *, row_number() OVER (PARTITION BY band ORDER BY md5('seed|' || winner || '|' || loser)) AS r FROM b) WHERE r <= 5""",
    ),
    "b11_choose_threshold": (
        lambda s, d: D.choose_threshold(_labelled(s, d)),
        f"""WITH {PAIRS}, l AS (SELECT *, {LABEL} AS label FROM pairs), m AS (SELECT label, 'c3' AS measure, c3 AS x FROM l UNION ALL SELECT label, 'c5', c5 FROM l),
        w AS (SELECT measure, max(CASE WHEN label <> 'same' THEN x END) AS worst FROM m GROUP BY measure)
        SELECT measure, min(x) AS bound, count(*) AS merged FROM m JOIN w USING (measure) WHERE worst IS NULL OR x > worst GROUP BY measure ORDER BY merged DESC, measure DESC LIMIT 1""",
    ),
    "b12_apply_merges": (
        lambda s, d: _applied(_pairs(s, d)),
        f"""WITH {PAIRS}, {MARKS}, m AS (SELECT * FROM marks WHERE method = 'even'), p AS (SELECT DISTINCT loser, winner FROM pairs WHERE c3 >= 0.3), t AS (SELECT winner FROM p UNION SELECT winner FROM m)
        SELECT p.loser, p.winner, CASE WHEN m.winner = p.winner THEN 'recorded' WHEN m.winner IS NOT NULL OR p.winner IN (SELECT loser FROM m) THEN 'stale'
          WHEN p.loser IN (SELECT winner FROM t) THEN 'target' ELSE 'merged' END AS outcome FROM p LEFT JOIN m ON m.loser = p.loser""",
    ),
    "b13_undo_merges": (lambda s, d: D.undo_merges(_marks(s, d), "odd"), f"WITH {PAIRS}, {MARKS} SELECT * FROM marks WHERE method <> 'odd'"),
    "b14_redirect": (
        lambda s, d: D.redirect(cases(s, d).select("case_id", "era"), _marks(s, d)),
        f"WITH {PAIRS}, {MARKS} SELECT coalesce(m.winner, c.case_id) AS case_id, c.era, CASE WHEN m.winner IS NOT NULL THEN c.case_id END AS merged_from FROM cases c LEFT JOIN marks m ON m.loser = c.case_id",
    ),
    "b15_duplicate_ids": (
        lambda s, d: cases(s, d).select("case_id").join(_marks(s, d).select(F.col("loser").alias("case_id")), "case_id", "left_semi"),
        f"WITH {PAIRS}, {MARKS} SELECT case_id FROM cases WHERE case_id IN (SELECT loser FROM marks)",
    ),
    "b16_reconcile": (
        lambda s, d: D.reconcile(_merged(s, d), table(s, d, "labels").selectExpr(*B16_LEDGER), table(s, d, "labels").selectExpr(*B16_VALUES)),
        f"""WITH {PAIRS}, mm AS (SELECT case_id, winner FROM mem), ll AS (SELECT {", ".join(B16_LEDGER)} FROM labels), vv AS (SELECT {", ".join(B16_VALUES)} FROM labels),
        dd AS (SELECT m.case_id, m.winner, relevant, duplicate_of, m.case_id <> m.winner AND a.human AND a.value IS DISTINCT FROM b.value AS differs FROM mm m JOIN ll l USING (case_id) LEFT JOIN vv a ON a.case_id = m.case_id LEFT JOIN vv b ON b.case_id = m.winner),
        gg AS (SELECT winner, count(*) AS n, bool_or(relevant) AND bool_or(NOT relevant) AS dis, coalesce(bool_or(case_id = winner AND relevant), false) AS counted, count(*) FILTER (WHERE relevant) AS k, coalesce(bool_or(case_id <> winner AND relevant AND differs), false) AS dif FROM dd GROUP BY winner HAVING count(*) > 1),
        rr AS (SELECT *, CASE WHEN dis THEN 'relevant' WHEN k >= 2 AND NOT counted THEN 'winner-not-counted' WHEN k >= 2 AND dif THEN 'human-value' END AS reason, (NOT dis OR counted) AND k >= 2 AND counted AND (dis OR NOT dif) AS patched FROM gg)
        SELECT winner, NULL::BIGINT AS case_id, 'for-user' AS action, reason FROM rr WHERE reason IS NOT NULL UNION ALL
        SELECT d.winner, d.case_id, 'patch', NULL FROM dd d JOIN rr USING (winner) WHERE patched AND d.case_id <> d.winner AND relevant AND NOT coalesce(differs, false) AND duplicate_of IS DISTINCT FROM d.winner""",
    ),
    "b17_calibration_crosstab": (
        lambda s, d: D.calibration_crosstab(_labelled(s, d), ["same", "different", "unsure"]),
        f"""WITH {PAIRS}, l AS (SELECT *, {LABEL} AS label FROM pairs)
        SELECT floor(c5 * 10 + 1e-9)::INT AS band, count(*) FILTER (WHERE label = 'same') AS same, count(*) FILTER (WHERE label = 'different') AS different, count(*) FILTER (WHERE label = 'unsure') AS unsure FROM l GROUP BY 1""",
    ),
}
