"""Queries of the patch log, evidence, agreement and answers. Events are patches: a case is a user, the kind of event the operation."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.operators import evidence as E
from foliospark.operators import folding, quotes as Q
from foliospark.operators import ledger as L
from foliospark.operators import review as RV
from foliospark.plans.base import CASES, cases, norm_sql
from foliospark.session import table

FIELD = "CASE WHEN k % 11 = 7 THEN 'relevant' ELSE CASE k % 3 WHEN 0 THEN 'polarity' WHEN 1 THEN 'characterization' ELSE 'restriction_nature' END END"
YES = "CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END"


def _log(s, d):
    e = table(s, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    value = F.concat(F.lit('"v'), F.col("k") % 4, F.lit('"'))
    quote = F.concat(F.lit('{"text": "q'), F.col("k") % 5, F.lit('", "supports": ["polarity"]}'))
    said = F.expr(f"CASE WHEN {FIELD} = 'relevant' THEN {YES} END")
    body = F.concat(F.lit('{"relevant": '), F.expr(YES), F.lit(', "polarity": '), value, F.lit(', "quotes": [{"text": "q1", "supports": "polarity"}]}'))
    op = F.when(F.col("event_type") == "signup", "admit").when(F.col("event_type") == "purchase", "append").when(F.col("event_type") == "error", "drop_quote").otherwise("set")
    return e.select(
        (F.col("event_id") + 1).alias("seq"),
        F.col("user_id").alias("case_id"),
        F.lit("c1").alias("cycle"),
        op.alias("op"),
        F.when(op == "append", "quotes").when(op == "set", F.expr(FIELD)).alias("field"),
        F.when(op == "admit", body).when(op == "append", quote).when(op == "drop_quote", F.concat(F.lit('"q'), F.col("k") % 5, F.lit('"'))).otherwise(F.coalesce(said, value)).alias("new"),
        F.when(F.col("event_id") % 7 == 0, "ann").alias("reviewer"),
        F.when(F.col("event_id") % 7 != 0, "m").alias("model"),
        F.lit("mapper-v3").alias("prompt_version"),
        F.lit("r1").alias("run_id"),
        F.lit(None).cast("string").alias("rule_id"),
    )


LOG = f"""lg AS (SELECT event_id + 1 AS seq, user_id AS case_id, event_id, event_type, k, CASE WHEN event_id % 7 = 0 THEN 'ann' END AS reviewer,
  CASE event_type WHEN 'signup' THEN 'admit' WHEN 'purchase' THEN 'append' WHEN 'error' THEN 'drop_quote' ELSE 'set' END AS op, {FIELD} AS f, {YES} AS yes, CASE WHEN event_type NOT IN ('signup', 'purchase', 'error') AND {FIELD} = 'relevant' THEN {YES} ELSE '"v' || k % 4 || '"' END AS v
  FROM (SELECT *, (props::JSON ->> '$.k')::INT AS k FROM events))"""


PROTECT = 500


def _folded(s, d):
    return folding.fold(_log(s, d), PROTECT)


def _cascaded(s, d):
    patches = folding.judged_patches(_log(s, d)).filter("error is null")
    return folding.cascades(patches, folding.quote_lives(patches))


SIX = "('characterization'), ('polarity'), ('holding_summary'), ('owner_freedom_characterization'), ('restriction_nature'), ('under_thirty_days')"
FOLD_SQL = f"""{LOG}, cs AS (SELECT case_id, min(seq) AS admit_seq, max(seq) AS opened FROM lg WHERE op = 'admit' GROUP BY case_id), p AS (SELECT lg.* FROM lg JOIN cs USING (case_id) WHERE seq >= admit_seq),
quote AS (SELECT case_id, seq AS added, 'q1' AS t, '{{"supports":"polarity","text":"q1"}}' AS q FROM p WHERE op = 'admit' UNION ALL SELECT case_id, seq, 'q' || k % 5, '{{"text": "q' || k % 5 || '", "supports": ["polarity"]}}' FROM p WHERE op = 'append'),
lives AS (SELECT x.*, (SELECT min(seq) FROM p WHERE p.case_id = x.case_id AND seq > added AND (op = 'admit' OR (op = 'drop_quote' AND 'q' || k % 5 = t))) AS removed FROM quote x),
casc AS (SELECT p.case_id, f.field, p.seq FROM p, (VALUES {SIX}) f(field) WHERE op = 'drop_quote' AND NOT (f.field = 'polarity' AND EXISTS (SELECT 1 FROM lives l WHERE l.case_id = p.case_id AND added <= p.seq AND (removed IS NULL OR removed > p.seq)))),
tries AS (SELECT case_id, f AS field, seq, 'write' AS how, v AS value, reviewer IS NOT NULL AS human FROM p WHERE op = 'set' UNION ALL SELECT case_id, 'polarity', seq, 'write', v, reviewer IS NOT NULL FROM p WHERE op = 'admit' UNION ALL SELECT case_id, 'relevant', seq, 'write', yes, reviewer IS NOT NULL FROM p WHERE op = 'admit'
  UNION ALL SELECT case_id, g.field, seq, 'replace', NULL, reviewer IS NOT NULL FROM p JOIN cs USING (case_id), (VALUES ('characterization'), ('restriction_nature')) g(field) WHERE op = 'admit' AND seq > admit_seq UNION ALL SELECT case_id, field, seq, 'cascade', NULL, false FROM casc),
d1 AS (SELECT *, coalesce(bool_or(human AND how = 'write') OVER (PARTITION BY case_id, field ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS decided FROM tries),
d2 AS (SELECT *, how = 'cascade' OR human OR NOT decided OR seq <= {PROTECT} AS applied FROM d1),
hist AS (SELECT *, last_value(CASE WHEN applied THEN coalesce(value, '-') END IGNORE NULLS) OVER (PARTITION BY case_id, field ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s0 FROM d2),
hist2 AS (SELECT * EXCLUDE s0, nullif(s0, '-') AS standing FROM hist), conf AS (SELECT * FROM hist2 WHERE how = 'write' AND NOT human AND decided AND standing IS DISTINCT FROM value),
ends AS (SELECT case_id, field, nullif(arg_max(coalesce(value, '-'), seq) FILTER (WHERE applied), '-') AS value, bool_or(human AND how = 'write') AS by_human, bool_or(how = 'write') AS written FROM hist2 GROUP BY ALL)""".replace("FROM hist h", "FROM hist2 h")


def _records(s, d):
    lab = table(s, d, "labels").withColumnRenamed("doc_id", "case_id")
    return cases(s, d).select("case_id", "jurisdiction", "era", "court", "year").join(lab, "case_id").withColumn("reviewed", F.col("case_id") % 3 == 0)


RECORDS = f"{CASES}, rec AS (SELECT case_id, jurisdiction, era, court, year, quality, toxic, case_id % 3 = 0 AS reviewed FROM cases JOIN labels ON doc_id = case_id)"


def _paged(s, d):
    return cases(s, d).withColumn("page_map", F.expr("transform(sequence(0, 9), i -> struct(int(i * 500) as offset, concat('p', i) as label))"))


def _quotes(s, d):
    """Of every case a verbatim quote, one with a letter changed, and one that stands nowhere."""
    cut = F.substring("raw_text", 20, 90)
    texts = F.array(cut, F.regexp_replace(cut, "^(.{30}).", "$1#"), F.lit("no such words anywhere at all"))
    return cases(s, d).select("case_id", F.posexplode(texts).alias("quote_id", "text")).withColumn("quote_id", F.col("quote_id").cast("long"))


def _gated(s, d):
    rec = _records(s, d).select("case_id", F.when(F.col("quality") == 1, True).otherwise(False).alias("relevant"), F.lit("x").alias("polarity"), F.when(F.col("toxic") == 1, "y").alias("who_was_letting"))
    q = table(s, d, "documents").selectExpr("doc_id as case_id", "if(doc_id % 4 = 0, 'failed', 'verified') as status", "if(doc_id % 3 = 0, array('polarity'), array('who_was_letting', 'polarity')) as supports")
    return E.gated(rec, q, ["polarity", "who_was_letting"])


K_RECORDS = (
    "doc_id AS case_id", "CASE WHEN doc_id % 5 = 0 THEN false ELSE true END AS relevant", "CASE WHEN doc_id % 13 = 0 THEN doc_id - 1 END AS duplicate_of", "CASE doc_id % 4 WHEN 0 THEN 'favorable' WHEN 1 THEN 'mixed' ELSE 'against' END AS polarity",
    "CASE WHEN doc_id % 3 = 0 THEN 'yes' ELSE 'no' END AS under_thirty_days", "CASE WHEN doc_id % 2 = 0 THEN 'householder' ELSE 'owner' END AS who_was_letting", "CASE WHEN doc_id % 7 < 3 THEN 'nights' ELSE 'months' END AS duration_of_occupancy",
    "CASE WHEN doc_id % 11 = 0 THEN 'characterization' END AS checker_field", "CASE WHEN doc_id % 17 = 0 THEN 'polarity' ELSE '' END AS nulled", "doc_id % 19 = 0 AS fuzzy_needs_human", "doc_id % 6 = 0 AS reviewed", "CASE WHEN doc_id % 3 = 0 THEN 'needs-review:polarity' ELSE '' END AS flags",
)
K_CONFLICTS = ("doc_id AS case_id", "CASE WHEN doc_id % 4 < 3 THEN 'polarity' ELSE 'relevant' END AS field", "doc_id % 9 = 0 AS asked")


def _two(s, d):
    r = _records(s, d)
    a = r.select("case_id", "quality", F.when(F.col("case_id") % 9 != 0, F.col("toxic")).alias("toxic"))
    return a, r.select("case_id", F.when(F.col("case_id") % 11 == 0, 1 - F.col("quality")).otherwise(F.col("quality")).alias("quality"), "toxic")


TWO = "a AS (SELECT case_id, quality, CASE WHEN case_id % 9 <> 0 THEN toxic END AS toxic FROM rec), b AS (SELECT case_id, CASE WHEN case_id % 11 = 0 THEN 1 - quality ELSE quality END AS quality, toxic FROM rec)"
Z = 1.959963984540054

QUERIES = {
    "j1_log_faults": (lambda s, d: L.log_faults(_log(s, d).filter("seq % 50 <> 0")), f"WITH {LOG} SELECT max(seq) AS head, count(*) AS n, max(seq) - count(DISTINCT seq) AS missing, count(*) - count(DISTINCT seq) AS repeated FROM lg WHERE seq % 50 <> 0"),
    "j2_new_patches": (
        lambda s, d: L.new_patches(_log(s, d), _log(s, d).filter("seq <= 5000")).agg(F.count("*").alias("n")),
        f"WITH {LOG}, c AS (SELECT seq, (case_id, op, CASE WHEN op = 'set' THEN f END, CASE WHEN op = 'set' OR op = 'admit' THEN v ELSE 'q' || k % 5 END, reviewer) AS c FROM lg) SELECT count(DISTINCT c) AS n FROM c WHERE c NOT IN (SELECT c FROM c WHERE seq <= 5000)",
    ),
    "j3_numbered": (lambda s, d: L.numbered_patches(_log(s, d).select("case_id", F.col("seq").alias("old")), 100, "old"), f"WITH {LOG} SELECT case_id, seq AS old, 100 + row_number() OVER (ORDER BY seq) AS seq FROM lg"),
    "j4_fold": (
        lambda s, d: _folded(s, d).records.select("case_id", "cycle", "admit_seq", "in_file", *(F.try_element_at("fields", F.lit(f)).alias(f) for f in ("polarity", "characterization", "restriction_nature")), F.array_join("quotes", "|").alias("quotes"), F.array_join("nulled_fields", ",").alias("nulled"), F.array_join("flags", ",").alias("flags"), F.try_element_at("provenance", F.lit("polarity")).alias("polarity_by")),
        f"""WITH {FOLD_SQL}
        SELECT c.case_id, 'c1' AS cycle, c.admit_seq, coalesce((SELECT arg_max(value, seq) FROM d2 WHERE d2.case_id = c.case_id AND field = 'relevant' AND applied AND seq <= c.opened), '') = 'true' AS in_file, max(value) FILTER (WHERE field = 'polarity') AS polarity, max(value) FILTER (WHERE field = 'characterization') AS characterization, max(value) FILTER (WHERE field = 'restriction_nature') AS restriction_nature,
          coalesce((SELECT string_agg(q, '|' ORDER BY added) FROM lives l WHERE l.case_id = c.case_id AND removed IS NULL), '') AS quotes,
          coalesce((SELECT string_agg(field, ',' ORDER BY seq, field) FROM hist2 h WHERE h.case_id = c.case_id AND how = 'cascade' AND standing IS NOT NULL AND seq > c.opened), '') AS nulled,
          coalesce((SELECT string_agg(DISTINCT 'needs-review:' || field, ',' ORDER BY 'needs-review:' || field) FROM conf f WHERE f.case_id = c.case_id AND seq > {PROTECT} AND seq >= c.opened), '') AS flags,
          CASE WHEN bool_or(by_human) FILTER (WHERE field = 'polarity') THEN 'human' ELSE 'reader' END AS polarity_by
        FROM cs c LEFT JOIN ends e USING (case_id) GROUP BY c.case_id, c.admit_seq, c.opened""",
    ),
    "j7_provenance": (
        lambda s, d: _folded(s, d).records.select("case_id", F.explode("provenance").alias("field", "who")),
        f"WITH {FOLD_SQL} SELECT case_id, field, CASE WHEN by_human THEN 'human' ELSE 'reader' END AS who FROM ends WHERE written",
    ),
    "j9_cascades": (
        lambda s, d: _cascaded(s, d),
        f"WITH {FOLD_SQL} SELECT case_id, field, seq FROM casc",
    ),
    "j5_last_values": (lambda s, d: L.last_values(_log(s, d)), f"WITH {LOG} SELECT case_id, f AS field, arg_max(v, seq) AS value FROM lg WHERE op = 'set' GROUP BY case_id, f"),
    "j6_as_of": (lambda s, d: L.last_values(L.as_of(_log(s, d), 4000)), f"WITH {LOG} SELECT case_id, f AS field, arg_max(v, seq) AS value FROM lg WHERE op = 'set' AND seq <= 4000 GROUP BY case_id, f"),
    "j8_protection_applies": (
        lambda s, d: L.protection_applies(_log(s, d)),
        f"WITH {LOG} SELECT DISTINCT x.case_id, x.f AS field FROM lg x WHERE op = 'set' AND reviewer IS NULL AND EXISTS (SELECT 1 FROM lg y WHERE y.op = 'set' AND y.case_id = x.case_id AND y.f = x.f AND y.seq < x.seq AND y.reviewer IS NOT NULL)",
    ),
    "j10_conflicts": (lambda s, d: L.conflict_rows(_folded(s, d).conflicts).drop("historical"), f"WITH {FOLD_SQL} SELECT case_id, field, value AS attempted, standing, seq FROM conf WHERE seq > {PROTECT}"),
    "j4_errors": (lambda s, d: _folded(s, d).errors.groupBy("error").agg(F.count("*").alias("n")), f"WITH {LOG}, o AS (SELECT case_id, min(seq) FILTER (WHERE op = 'admit') AS a FROM lg GROUP BY 1) SELECT 'unknown case' AS error, count(*) AS n FROM lg JOIN o USING (case_id) WHERE a IS NULL OR seq < a HAVING count(*) > 0"),
    "j11_reviewed_ids": (lambda s, d: L.reviewed_ids(_log(s, d)), f"WITH {LOG} SELECT DISTINCT case_id FROM lg WHERE op = 'set' AND reviewer IS NOT NULL"),
    "j15_tally_with_total": (
        lambda s, d: L.tally_with_total(_records(s, d).filter("quality = 1").withColumn("court", F.expr("if(court = 'fr', null, court)")), L.reviewed_ids(_log(s, d)), ["court", "era"]),
        f"WITH {RECORDS}, {LOG}, h AS (SELECT DISTINCT case_id FROM lg WHERE op = 'set' AND reviewer IS NOT NULL), x AS (SELECT nullif(court, 'fr') AS court, era, h.case_id AS r FROM rec LEFT JOIN h USING (case_id) WHERE quality = 1) SELECT court, era, grouping(court) = 1 AS is_total, count(r) AS human_reviewed, count(*) - count(r) AS machine_only FROM x GROUP BY GROUPING SETS ((court, era), ())",
    ),
    "j15_tally": (
        lambda s, d: L.tally(_records(s, d).filter("quality = 1"), L.reviewed_ids(_log(s, d)), ["jurisdiction", "era"]),
        f"WITH {RECORDS}, {LOG}, h AS (SELECT DISTINCT case_id FROM lg WHERE op = 'set' AND reviewer IS NOT NULL) SELECT jurisdiction, era, count(h.case_id) AS human_reviewed, count(*) - count(h.case_id) AS machine_only FROM rec LEFT JOIN h USING (case_id) WHERE quality = 1 GROUP BY ALL",
    ),
    "j16_grid": (
        lambda s, d: L.grid(_records(s, d), L.reviewed_ids(_log(s, d)), {"era": ["early", "middle", "late", "never"], "court": ["en", "fr", "xx"]}),
        f"""WITH {RECORDS}, {LOG}, h AS (SELECT DISTINCT case_id FROM lg WHERE op = 'set' AND reviewer IS NOT NULL), t AS (SELECT era, court, count(h.case_id) AS human_reviewed, count(*) - count(h.case_id) AS machine_only FROM rec LEFT JOIN h USING (case_id) GROUP BY ALL),
        g AS (SELECT era, court FROM (VALUES ('early'), ('middle'), ('late'), ('never')) a(era), (VALUES ('en'), ('fr'), ('xx')) b(court))
        SELECT era, court, coalesce(human_reviewed, 0) AS human_reviewed, coalesce(machine_only, 0) AS machine_only FROM g FULL JOIN t USING (era, court)""",
    ),
    "j29_consensus": (
        lambda s, d: L.consensus(_log(s, d).filter("op = 'set'").select("case_id", "field", F.expr("if(seq % 5 = 0, null, new)").alias("value")), 6, ['"v0"', '"v1"', '"v2"']),
        f"""WITH {LOG}, n AS (SELECT case_id, f AS field, v, count(*) AS n FROM lg WHERE op = 'set' AND seq % 5 <> 0 GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY case_id, field ORDER BY n DESC, v) AS r FROM n)
        SELECT case_id, field, CASE WHEN n >= 6 AND v IN ('"v0"', '"v1"', '"v2"') THEN v END AS value FROM b WHERE r = 1""",
    ),
    "i5_exact_quotes": (
        lambda s, d: Q.checked_quotes(_quotes(s, d).filter("quote_id = 0"), _paged(s, d)).select("case_id", "quote_id", "status", "place"),
        f"""WITH {CASES}, q AS (SELECT case_id, norm_text, {norm_sql("substr(raw_text, 20, 90)")} AS q FROM cases)
        SELECT case_id, 0 AS quote_id, CASE WHEN q <> '' AND strpos(norm_text, q) > 0 THEN 'verified' ELSE 'failed' END AS status, CASE WHEN q <> '' AND strpos(norm_text, q) > 0 THEN strpos(norm_text, q) - 1 END AS place FROM q""",
    ),
    "i6_checked_quotes": (lambda s, d: Q.checked_quotes(_quotes(s, d), _paged(s, d)), None),
    "i7_pages": (
        lambda s, d: table(s, d, "orders").select("o_orderkey", Q.page_for_offset(F.expr("transform(sequence(0, 4), i -> struct(i * 100 as offset, concat('p', i) as label))"), F.col("o_custkey") % 600 - 50).alias("page")),
        "SELECT o_orderkey, 'p' || greatest(0, least(4, floor((o_custkey % 600 - 50) / 100)))::INT AS page FROM orders",
    ),
    "i8_gated": (
        lambda s, d: _gated(s, d).withColumn("nulled_fields", F.array_join("nulled_fields", ",")),
        f"""WITH {RECORDS}, q AS (SELECT doc_id AS case_id, doc_id % 4 = 0 AS failed, doc_id % 3 = 0 AS one FROM documents),
        j AS (SELECT rec.*, quality = 1 AS relevant, coalesce(failed, false) AS failed, q.case_id IS NOT NULL AND NOT failed AS kept, one FROM rec LEFT JOIN q USING (case_id)),
        n AS (SELECT *, relevant AND NOT kept AS np, relevant AND toxic = 1 AND NOT (kept AND NOT one) AS nw FROM j)
        SELECT case_id, relevant, CASE WHEN NOT np THEN 'x' END AS polarity, CASE WHEN toxic = 1 AND NOT nw THEN 'y' END AS who_was_letting, concat_ws(',', CASE WHEN np THEN 'polarity' END, CASE WHEN nw THEN 'who_was_letting' END) AS nulled_fields,
        CASE WHEN relevant AND failed THEN 1 ELSE 0 END AS n_dropped, CASE WHEN NOT relevant OR NOT (failed OR np OR nw) THEN 'ok' WHEN kept THEN 'partial' ELSE 'extraction-invalid' END AS extraction_status FROM n""",
    ),
    "i12_hash_sample": (lambda s, d: E.hash_sample(table(s, d, "orders").selectExpr("concat('u', o_orderkey) as unit_id"), 20), "SELECT 'u' || o_orderkey AS unit_id FROM orders WHERE ('0x' || substr(sha256('u' || o_orderkey), 1, 8))::BIGINT % 100 < 20"),
    "i13_disagreements": (
        lambda s, d: E.disagreements(*_two(s, d), ["quality", "toxic"]),
        f"WITH {RECORDS}, {TWO} SELECT a.case_id, 'quality' AS field, a.quality::VARCHAR AS a, b.quality::VARCHAR AS b FROM a JOIN b USING (case_id) WHERE a.quality IS DISTINCT FROM b.quality UNION ALL SELECT a.case_id, 'toxic', a.toxic::VARCHAR, b.toxic::VARCHAR FROM a JOIN b USING (case_id) WHERE a.toxic IS DISTINCT FROM b.toxic",
    ),
    "k1_k2_review_queue": (
        lambda s, d: RV.review_queue(table(s, d, "documents").selectExpr(*K_RECORDS), table(s, d, "documents").selectExpr(*K_CONFLICTS).filter("asked").drop("asked"), 150).drop("other_reasons"),
        f"""WITH r AS (SELECT {", ".join(K_RECORDS)} FROM documents), x AS (SELECT {", ".join(K_CONFLICTS)} FROM documents),
        g AS (SELECT DISTINCT r.case_id, 'G' AS section, 'reread_conflict' AS reason, x.field AS decide_field FROM x JOIN r USING (case_id) WHERE asked AND flags LIKE '%needs-review:' || x.field || '%' AND relevant IS DISTINCT FROM false AND duplicate_of IS NULL),
        k AS (SELECT *, CASE WHEN polarity = 'favorable' AND under_thirty_days = 'yes' THEN 1 WHEN who_was_letting = 'householder' AND duration_of_occupancy = 'nights' THEN 2 WHEN checker_field IS NOT NULL THEN 3 WHEN polarity = 'mixed' THEN 4 WHEN nulled <> '' THEN 5 WHEN fuzzy_needs_human THEN 6 END AS n FROM r WHERE relevant AND duplicate_of IS NULL AND NOT reviewed),
        c AS (SELECT 0 AS o, * FROM g UNION ALL SELECT n, case_id, ['A', 'B', 'C', 'D', 'E', 'F'][n], ['favorable_under_thirty', 'householder_nights', 'checker_disagreement', 'polarity_mixed', 'gate_erased', 'fuzzy_quote'][n],
          CASE n WHEN 1 THEN 'polarity' WHEN 2 THEN 'who_was_letting' WHEN 3 THEN checker_field WHEN 4 THEN 'polarity' WHEN 5 THEN nulled ELSE 'quotes' END FROM k WHERE n IS NOT NULL)
        SELECT case_id, section, reason, decide_field, row_number() OVER (ORDER BY o, case_id, decide_field) > 150 AS deferred FROM c""",
    ),
    "l1_wilson": (
        lambda s, d: _records(s, d).groupBy("jurisdiction").agg(F.sum("quality").alias("k"), F.count("*").alias("n")).select("jurisdiction", F.round(E.wilson(F.col("k"), F.col("n"))["lo"], 8).alias("lo"), F.round(E.wilson(F.col("k"), F.col("n"))["hi"], 8).alias("hi")),
        f"""WITH {RECORDS}, c AS (SELECT jurisdiction, avg(quality) AS p, count(*) AS n FROM rec GROUP BY jurisdiction), w AS (SELECT *, p + {Z} * {Z} / (2 * n) AS c, {Z} * sqrt(p * (1 - p) / n + {Z} * {Z} / (4.0 * n * n)) AS h, 1 + {Z} * {Z} / n AS q FROM c)
        SELECT jurisdiction, round((c - h) / q, 8) AS lo, round((c + h) / q, 8) AS hi FROM w""",
    ),
    "l2_kappa": (
        lambda s, d: E.kappa(_records(s, d).select("court", F.col("quality").alias("a"), F.when(F.col("case_id") % 6 == 0, 1 - F.col("quality")).otherwise(F.col("quality")).alias("b")), ["court"]).select("court", "n", F.round("agreement", 8).alias("agreement"), F.round("kappa", 8).alias("kappa")),
        f"""WITH {RECORDS}, p AS (SELECT court, quality AS a, CASE WHEN case_id % 6 = 0 THEN 1 - quality ELSE quality END AS b FROM rec), g AS (SELECT court, count(*) AS n, avg((a = b)::INT) AS o, avg(a) * avg(b) + (1 - avg(a)) * (1 - avg(b)) AS e FROM p GROUP BY court)
        SELECT court, n, round(o, 8) AS agreement, CASE WHEN e < 1 THEN round((o - e) / (1 - e), 8) END AS kappa FROM g""",
    ),
    "l5_gold_funnel": (
        lambda s, d: E.gold_funnel(table(s, d, "orders").selectExpr("o_orderstatus as tier", "if(o_orderkey % 3 = 0, null, o_custkey) as case_id", "concat('c', o_orderkey % 200) as cite_norm", "o_custkey % 2 = 0 as signaled", "o_custkey % 3 = 0 as read", "o_custkey % 5 = 0 as relevant", "o_custkey % 7 = 0 as human")),
        """WITH g AS (SELECT o_orderstatus AS tier, coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey::VARCHAR END, 'c' || o_orderkey % 200) AS key, o_orderkey % 3 <> 0 AS r, o_custkey AS c FROM orders), u AS (SELECT * FROM g UNION ALL SELECT 'union', key, r, c FROM g)
        SELECT tier, count(DISTINCT key) AS entries, count(DISTINCT key) FILTER (WHERE r) AS resolved, count(DISTINCT key) FILTER (WHERE r AND c % 2 = 0) AS signaled, count(DISTINCT key) FILTER (WHERE r AND c % 6 = 0) AS read,
        count(DISTINCT key) FILTER (WHERE r AND c % 30 = 0) AS relevant, count(DISTINCT key) FILTER (WHERE r AND c % 210 = 0) AS human FROM u GROUP BY tier""",
    ),
    "l8_score_bands": (lambda s, d: table(s, d, "lineitem").groupBy(E.score_band(F.col("l_discount") * 7).alias("band")).agg(F.count("*").alias("n")), "SELECT round(floor(l_discount * 7 / 0.05 + 1e-9) * 0.05, 2) AS band, count(*) AS n FROM lineitem GROUP BY 1"),
    "l16_field_scores": (
        lambda s, d: E.field_scores(_records(s, d).select(F.expr("stack(2, 'quality', quality, if(case_id % 4 = 0, null, quality), 'toxic', toxic, if(case_id % 5 = 0, 1, toxic)) as (field, ref, got)"))).select("field", "n", F.round("decided", 8).alias("decided"), F.round("agreement", 8).alias("agreement")),
        f"""WITH {RECORDS}, p AS (SELECT 'quality' AS field, quality AS ref, CASE WHEN case_id % 4 <> 0 THEN quality END AS got FROM rec UNION ALL SELECT 'toxic', toxic, CASE WHEN case_id % 5 = 0 THEN 1 ELSE toxic END FROM rec)
        SELECT field, count(*) AS n, round(avg((got IS NOT NULL)::INT), 8) AS decided, round(avg((ref = got)::INT), 8) AS agreement FROM p WHERE ref IS NOT NULL GROUP BY field""",
    ),
    "m2_answer_records": (
        lambda s, d: E.answer_records(_records(s, d), {"quality": [1]}, [{"era": ["early"], "court": ["en", "fr"]}, {"toxic": [1]}]).select("case_id", "year"),
        f"WITH {RECORDS} SELECT case_id, year FROM rec WHERE quality = 1 AND ((era = 'early' AND court IN ('en', 'fr')) OR toxic = 1)",
    ),
    "m6_two_tier_summary": (
        lambda s, d: E.two_tier_summary(_records(s, d), ["court"]),
        f"WITH {RECORDS} SELECT jurisdiction, era, court, count(*) FILTER (WHERE reviewed) AS human_reviewed, count(*) FILTER (WHERE NOT reviewed) AS machine_only, grouping(jurisdiction, era, court) AS g FROM rec GROUP BY GROUPING SETS ((), (jurisdiction, era), (court))",
    ),
    "m7_earliest_by_jurisdiction": (lambda s, d: E.earliest_by_jurisdiction(_records(s, d)), f"WITH {RECORDS} SELECT jurisdiction, case_id, year FROM (SELECT *, row_number() OVER (PARTITION BY jurisdiction ORDER BY year NULLS LAST, case_id) AS r FROM rec) WHERE r = 1"),
    "m8_all_citations": (
        lambda s, d: E.all_citations(table(s, d, "part").selectExpr("p_partkey % 300 as winner", "concat(p_size, ' Rep; ', p_brand, ';none') as cites", "element_at(array('official', 'reprint', 'x'), int(p_partkey % 3) + 1) as kind"), {"official": 0, "reprint": 2}).withColumn("cites", F.array_join("cites", "|")),
        """WITH c AS (SELECT p_partkey % 300 AS case_id, CASE p_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS rank, trim(unnest(string_split(p_size || ' Rep; ' || p_brand || ';none', ';'))) AS c FROM part),
        g AS (SELECT case_id, c, min(rank) AS rank FROM c WHERE regexp_matches(c, '[0-9]') GROUP BY ALL) SELECT case_id, string_agg(c, '|' ORDER BY rank, c) AS cites FROM g GROUP BY case_id""",
    ),
}
