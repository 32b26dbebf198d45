"""Queries of stored chunks, integer scores, merged maps, lineages, the snapshot and batch files."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from foliospark.operators import composed as C
from foliospark.operators import vectors as V
from foliospark.plans.base import CASES, cases
from foliospark.session import exists, shared_dir, table
from foliospark.sources import chunks, records


def _root(s, d, name):
    return f"{shared_dir(s)}/{name}-{hashlib.md5(d.encode()).hexdigest()}"


def _query(s, d):
    return [float(x) for x in table(s, d, "embeddings").filter("vec_id = 0").first()["embedding"]]


def _codes(s, d):
    q = table(s, d, "embeddings").select("vec_id", V.quantised(F.col("embedding")).alias("z"))
    return q.select(F.col("vec_id").alias("chunk_id"), V.packed_codes(F.col("z.q")).alias("code"), F.col("z.scale").alias("scale"))


CODES = """n AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS l FROM embeddings), u AS (SELECT vec_id, list_transform(v, lambda x: x / l) AS u FROM n),
s AS (SELECT vec_id, u, list_max(list_transform(u, lambda x: abs(x))) / 127 AS s FROM u), z AS (SELECT vec_id, s AS scale, list_transform(u, lambda x: round_even(x / s, 0)) AS q FROM s), q0 AS (SELECT embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id = 0)"""


def _chunk_rows(s, d):
    """Chunks of run r0, a third of the cases embedded again by r1 with other chunks, some of them left without any."""
    root = _root(s, d, "chunks")
    if not exists(s, f"{root}/commits"):
        e = table(s, d, "embeddings").select((F.col("vec_id") % 200).alias("case_id"), F.col("vec_id").alias("seq"), "label")
        chunks.replace_cases(e.select("case_id", "seq", F.lit("r0").alias("run")), root)
        again = e.filter("case_id % 3 = 0")
        chunks.replace_cases(again.filter("label < 7").select("case_id", (F.col("seq") + 100000).alias("seq"), F.lit("r1").alias("run")), root, again.select("case_id"))
    return chunks.current_rows(s, root)


CHUNKS = "ch AS (SELECT vec_id % 200 AS case_id, vec_id AS seq, 'r0' AS run FROM embeddings WHERE vec_id % 200 % 3 <> 0 UNION ALL SELECT vec_id % 200, vec_id + 100000, 'r1' FROM embeddings WHERE vec_id % 200 % 3 = 0 AND label < 7)"
CELLS = [("late", f"src{i}") for i in range(0, 20, 2)] + [("middle", f"src{i}") for i in range(20)]


def _map(s, d, run):
    """What one of three processes has read: overlapping cells and units, later runs the fresher."""
    li = table(s, d, "lineitem").filter(F.col("l_linenumber") % 3 != (run + 1) % 3 if run < 2 else F.lit(True)).filter(F.col("l_linenumber") <= 5 + run)
    units = li.selectExpr(
        f"'run{run}' AS run", f"{run} AS at", "concat('cell', l_suppkey % 40) AS cell", "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS unit_id", f"if((l_orderkey + {run}) % 11 = 0, 'failed', 'ok') AS status",
        "1 AS records", f"l_linenumber + {run} AS cases_read", f"(l_orderkey + {run}) % 3 AS relevant_accepted", "2 AS irrelevant_accepted", f"(l_partkey + {run}) % 7 = 0 AS retried", "l_partkey % 5 = 0 AS sampled",
        f"if((l_orderkey + {run}) % 11 = 0, array(l_partkey), array()) AS cases_lost", f"if((l_orderkey + {run}) % 4 = 0, array(l_partkey), array()) AS cases_answered",
    )
    walks = li.groupBy(F.concat(F.lit("cell"), F.col("l_suppkey") % 40).alias("cell")).agg((F.count("*") % 50).alias("batches"), F.min("l_suppkey").alias("position"))
    walks = walks.selectExpr(f"'run{run}' AS run", f"{run} AS at", "cell", "position", "batches", f"if(batches % 2 = 0, 'stop{run}', null) AS stop")
    runs = li.selectExpr(f"'run{run}' AS run", f"{run} AS at").limit(1).selectExpr("run", "at", f"{run + 3} AS calls", f"{100 * run} AS tokens", f"{run} * 0.5D AS cost")
    return C.map_state(units, walks, runs)


def _merged(s, d):
    a, b, c = (_map(s, d, r) for r in range(3))
    return C.merge_maps(C.merge_maps(c, a), b)


MAPS = """lr AS (SELECT l.*, r.run FROM lineitem l, (VALUES (0), (1), (2)) r(run) WHERE l_linenumber <= 5 + run AND (run = 2 OR l_linenumber % 3 <> (run + 1) % 3)),
un AS (SELECT *, 'cell' || l_suppkey % 40 AS cell, l_orderkey AS unit_id FROM lr QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice ORDER BY run DESC) = 1),
wk AS (SELECT 'cell' || l_suppkey % 40 AS cell, run, count(*) % 50 AS batches, min(l_suppkey) AS position FROM lr GROUP BY ALL),
fr AS (SELECT cell, min((run, position)) AS f FROM wk GROUP BY cell),
wb AS (SELECT cell, batches, CASE WHEN batches % 2 = 0 THEN 'stop' || run END AS stop FROM wk QUALIFY row_number() OVER (PARTITION BY cell ORDER BY batches DESC, run DESC) = 1),
lo AS (SELECT cell, count(DISTINCT l_partkey) AS cases_lost FROM un x WHERE (l_orderkey + run) % 11 = 0 AND NOT EXISTS (SELECT 1 FROM un y WHERE y.cell = x.cell AND y.l_partkey = x.l_partkey AND (y.l_orderkey + y.run) % 4 = 0) GROUP BY cell),
su AS (SELECT cell, count(*) AS units, count(*) AS records, sum(l_linenumber + run)::BIGINT AS cases_read, sum((l_orderkey + run) % 3)::BIGINT AS relevant_accepted, 2 * count(*) AS irrelevant_accepted, count(*) FILTER (WHERE (l_partkey + run) % 7 = 0) AS units_retried, count(*) FILTER (WHERE l_partkey % 5 = 0) AS checker_units, count(*) FILTER (WHERE (l_orderkey + run) % 11 = 0) AS failures FROM un GROUP BY cell),
mc AS (SELECT su.*, batches, stop, row_number() OVER (ORDER BY f, su.cell) AS place, coalesce(cases_lost, 0) AS cases_lost FROM su JOIN wb USING (cell) JOIN fr USING (cell) LEFT JOIN lo USING (cell))"""


def _gold(s, d):
    o = table(s, d, "orders")
    return o.selectExpr("o_orderkey AS id", "o_orderstatus AS tier", "if(o_orderkey % 13 = 0, null, o_custkey % 1500) AS case_id")


def _lineage(s, d):
    o, c = table(s, d, "orders"), table(s, d, "customer")
    signals = table(s, d, "lineitem").filter("l_partkey % 3 > 0").selectExpr("l_partkey % 1500 AS case_id", "concat('s', l_suppkey % 6) AS selector_id", "int(l_linenumber % 2) AS version")
    packed, kept = c.filter("c_custkey % 7 <> 0").selectExpr("c_custkey AS case_id"), c.filter("c_custkey % 5 = 0 and c_custkey % 7 <> 0 and c_custkey % 3 <> 1").selectExpr("c_custkey AS case_id")
    reads = o.filter("o_orderkey % 4 = 0").selectExpr("o_orderkey % 1500 AS case_id", "o_totalprice > 150000 AS relevant")
    about = c.selectExpr("c_custkey AS case_id", "c_mktsegment AS era", "string(c_nationkey % 5) AS jurisdiction")
    scopes = about.select("era", "jurisdiction").distinct().select(F.explode(F.array(*(F.lit(f"s{i}") for i in range(6)))).alias("selector_id"), "era", "jurisdiction").filter("ascii(era) % 2 = int(substr(selector_id, 2)) % 2")
    return C.gold_lineage(_gold(s, d), signals, packed, reads, kept, about, scopes)


LINEAGE = """g AS (SELECT o_orderkey AS id, o_orderstatus AS tier, CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey % 1500 END AS case_id FROM orders),
sg AS (SELECT l_partkey % 1500 AS case_id, string_agg(DISTINCT 's' || l_suppkey % 6 || '@v' || l_linenumber % 2, ',' ORDER BY 's' || l_suppkey % 6 || '@v' || l_linenumber % 2) AS sel FROM lineitem WHERE l_partkey % 3 > 0 GROUP BY 1),
rd AS (SELECT o_orderkey % 1500 AS case_id, bool_or(o_totalprice > 150000) AS rel FROM orders WHERE o_orderkey % 4 = 0 GROUP BY 1),
ab AS (SELECT c_custkey AS case_id, string_agg('s' || i, ',' ORDER BY i) AS could FROM customer, range(6) r(i) WHERE ascii(c_mktsegment) % 2 = i % 2 GROUP BY 1),
ln AS (SELECT id, tier, g.case_id, coalesce(sel, '') AS selectors, CASE WHEN g.case_id IS NULL THEN 'unresolved' WHEN c_custkey % 5 = 0 AND c_custkey % 7 <> 0 AND c_custkey % 3 <> 1 THEN NULL WHEN sel IS NULL THEN 'unsignaled' WHEN c_custkey IS NULL OR c_custkey % 7 = 0 THEN 'unpacked' WHEN rel IS NULL THEN 'unread' WHEN NOT rel THEN 'reader-negative' ELSE 'withdrawn' END AS lost_at, could
  FROM g LEFT JOIN sg USING (case_id) LEFT JOIN customer ON c_custkey = g.case_id LEFT JOIN rd ON rd.case_id = g.case_id LEFT JOIN ab ON ab.case_id = g.case_id)"""

AXES = {"region": ["0", "1", "2", "3"], "era": ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE"], "tier": ["F", "O", "P"], "duration": ["nights", "weeks", "months", "unclear"]}
REC = (
    "o_orderkey AS seq", "o_orderkey AS case_id", "o_custkey % 3 > 0 AS relevant", "CASE WHEN o_custkey % 5 < 2 AND c_nationkey % 5 < 4 THEN 'favorable' WHEN o_custkey % 5 < 4 THEN 'adverse' ELSE 'mixed' END AS polarity", "CASE WHEN o_orderkey % 2 = 0 THEN 'householder' END AS who",
    "c_mktsegment AS era", "CAST(c_nationkey % 5 AS STRING) AS region", "o_orderstatus AS tier", "CASE o_orderkey % 4 WHEN 0 THEN 'nights' WHEN 1 THEN 'weeks' WHEN 2 THEN 'months' ELSE 'unclear' END AS duration", "o_orderkey % 7 = 0 AS reviewed",
)


def _snapshot(s, d):
    o = table(s, d, "orders").join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).selectExpr(*REC)
    head = table(s, d, "orders").join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).agg(F.max("o_orderkey")).first()[0]
    library = cases(s, d).selectExpr("case_id", "jurisdiction", "year", "jurisdiction < 'src15' AS in_scope", "case_id % 4 = 0 AS flagged")
    bands = table(s, d, "supplier").selectExpr("s_suppkey AS unread", "s_nationkey AS estimate")
    sample = table(s, d, "labels").selectExpr("doc_id AS case_id", f"{head} AS drawn_seq")
    return C.snapshot_figures(o, library, _lineage(s, d), bands, sample, head, AXES)


SNAP = f"""{CASES}, {LINEAGE}, r AS (SELECT {", ".join(REC)} FROM orders JOIN customer ON o_custkey = c_custkey), rr AS (SELECT *, CASE WHEN reviewed THEN 1 ELSE 0 END AS h FROM r WHERE relevant),
f AS (SELECT name, sum(h) AS human, sum(1 - h) AS machine FROM (SELECT 'relevant' AS name, h FROM rr UNION ALL SELECT polarity, h FROM rr UNION ALL SELECT 'favorable_householder', h FROM rr WHERE polarity = 'favorable' AND who = 'householder') GROUP BY name),
lib AS (SELECT *, jurisdiction < 'src15' AS sc FROM cases)
SELECT 'ledger' AS section, 'read' AS name, count(*)::BIGINT AS human, NULL::BIGINT AS machine FROM r UNION ALL SELECT 'ledger', name, human, machine FROM f
UNION ALL SELECT 'grid', era || '|' || region || '|' || tier || '|' || duration, sum(h), sum(1 - h) FROM rr WHERE polarity = 'favorable' GROUP BY ALL
UNION ALL SELECT 'library', unnest(['total', 'in_scope', 'outside', 'flagged', 'jurisdictions', 'first_year', 'last_year']), unnest([count(*), count(*) FILTER (WHERE sc), count(*) FILTER (WHERE NOT sc), count(*) FILTER (WHERE sc AND case_id % 4 = 0), count(DISTINCT jurisdiction) FILTER (WHERE sc), min(year) FILTER (WHERE sc), max(year) FILTER (WHERE sc)]), NULL FROM lib
UNION ALL SELECT 'gold', unnest(['entries', 'resolved', 'kept', 'lost unsignaled', 'lost unpacked', 'lost unread', 'lost reader-negative', 'lost withdrawn']), unnest([count(*), count(case_id), count(*) FILTER (WHERE lost_at IS NULL), count(*) FILTER (WHERE lost_at = 'unsignaled'), count(*) FILTER (WHERE lost_at = 'unpacked'), count(*) FILTER (WHERE lost_at = 'unread'), count(*) FILTER (WHERE lost_at = 'reader-negative'), count(*) FILTER (WHERE lost_at = 'withdrawn')]), NULL FROM ln
UNION ALL SELECT 'tail', unnest(['unread', 'low', 'high']), unnest([sum(s_suppkey)::BIGINT, min(s_nationkey), max(s_nationkey)]), NULL FROM supplier
UNION ALL SELECT 'audit', unnest(['n', 'drawn_seq', 'not_yet_read']), unnest([(SELECT count(*) FROM labels), (SELECT max(seq) FROM r), 1]), NULL"""


def _batch_files(s, d):
    """Batches of orders, one file each; one in four is a retry, and one is cut short."""
    path = _root(s, d, "batches")
    if not exists(s, f"{path}/_SUCCESS"):
        o = table(s, d, "orders").withColumn("k", F.col("o_custkey") % 32)
        signal = F.struct(F.lit("s1").alias("selector_id"), F.lit(1).alias("selector_version"), F.col("o_orderstatus").alias("matched_text"), F.lit(None).cast("long").alias("chunk_id"), F.lit(0.5).alias("cosine"), F.lit("r").alias("run_id"))
        case = F.struct(F.col("o_orderkey").alias("case_id"), F.col("o_totalprice").alias("rank_score"), F.array(signal).alias("signals"))
        b = o.groupBy("k").agg(F.sort_array(F.collect_list(case)).alias("cases"))
        name = F.concat(F.lit("batch-"), F.lpad(F.col("k").cast("string"), 4, "0"), F.when(F.col("k") % 4 == 3, "-retry").otherwise(""), F.lit(".json"))
        body = F.to_json(F.struct(F.concat(F.lit("b"), "k").alias("batch_id"), F.lit("early").alias("era_partition"), F.lit("x").alias("jurisdiction"), F.lit("none").alias("ranker_id"), "cases"))
        cut = F.when(F.col("k") == 5, F.substr(body, F.lit(1), (F.length(body) / 2).cast("int"))).otherwise(body)
        b.select(name.alias("name"), cut.alias("value")).repartition("name").write.mode("overwrite").partitionBy("name").text(path)
    return records.batch_files(s, path)


NAME = "'batch-' || lpad((o_custkey % 32)::VARCHAR, 4, '0') || CASE WHEN o_custkey % 4 = 3 THEN '-retry' ELSE '' END || '.json'"
IN_CELLS = "(" + ", ".join(f"('{e}', '{j}')" for e, j in CELLS) + ")"

QUERIES = {
    "d4_integer_scores": (
        lambda s, d: V.scored_codes(_codes(s, d), {"q": _query(s, d)}).select("chunk_id", F.round("sim_q", 6).alias("sim")),
        f"WITH {CODES} SELECT vec_id AS chunk_id, round(list_dot_product(q, e) * scale, 6) AS sim FROM z, q0",
    ),
    "d4_whole_number_scores": (
        lambda s, d: V.scored_codes(_codes(s, d), {"q": _query(s, d)}, whole=True).select("chunk_id", F.round("sim_q", 6).alias("sim")),
        f"WITH {CODES}, w AS (SELECT list_max(list_transform(e, lambda x: abs(x))) / 127 AS ws, e FROM q0), v AS (SELECT ws, list_transform(e, lambda x: round_even(x / ws, 0)) AS wq FROM w) SELECT vec_id AS chunk_id, round(list_dot_product(q, wq) * scale * ws, 6) AS sim FROM z, v",
    ),
    "d10_current_chunks": (lambda s, d: _chunk_rows(s, d), f"WITH {CHUNKS} SELECT * FROM ch"),
    "d10_cells_quota_limit": (
        lambda s, d: V.to_embed(cases(s, d).withColumn("is_duplicate_of", F.when(F.col("case_id") % 7 == 0, F.col("case_id") - 1)), _chunk_rows(s, d), "r1", CELLS, 12, 100).select("case_id"),
        f"""WITH {CASES}, {CHUNKS}, t AS (SELECT case_id, row_number() OVER (PARTITION BY era, jurisdiction ORDER BY case_id) AS k FROM cases WHERE case_id % 7 <> 0 AND norm_text <> '' AND (era, jurisdiction) IN {IN_CELLS} AND case_id NOT IN (SELECT case_id FROM ch WHERE run = 'r1'))
        SELECT case_id FROM t WHERE k <= 12 ORDER BY case_id LIMIT 100""",
    ),
    "h13_map_cells": (lambda s, d: C.map_cells(_merged(s, d)), f"WITH {MAPS} SELECT cell, batches, stop, place, units, records, cases_read, relevant_accepted, irrelevant_accepted, units_retried, checker_units, failures, cases_lost FROM mc"),
    "h13_map_totals": (
        lambda s, d: C.map_totals(_merged(s, d)),
        f"WITH {MAPS} SELECT 12 AS calls, 300 AS tokens, 1.5::DOUBLE AS cost, sum(records)::BIGINT AS records, sum(cases_read)::BIGINT AS cases_read, sum(relevant_accepted)::BIGINT AS relevant_accepted, sum(irrelevant_accepted)::BIGINT AS irrelevant_accepted, sum(cases_lost)::BIGINT AS cases_lost FROM mc",
    ),
    "l21_lineage": (
        lambda s, d: _lineage(s, d).select("id", "tier", "case_id", F.array_join("selectors", ",").alias("selectors"), "lost_at", F.array_join("could_find", ",").alias("could_find")),
        f"WITH {LINEAGE} SELECT id, tier, case_id, selectors, lost_at, CASE WHEN lost_at = 'unsignaled' THEN coalesce(could, '') ELSE '' END AS could_find FROM ln",
    ),
    "l21_lineage_recall": (
        lambda s, d: C.lineage_recall(_lineage(s, d)),
        f"WITH {LINEAGE}, a AS (SELECT tier, count(*) AS total, count(case_id) AS resolved, count(*) FILTER (WHERE case_id IS NOT NULL AND selectors <> '') AS signaled, count(*) FILTER (WHERE lost_at IS NULL) AS kept FROM ln GROUP BY tier) SELECT *, round(signaled / resolved, 3) AS shard_recall, round(kept / resolved, 3) AS end_to_end FROM a",
    ),
    "l24_snapshot": (_snapshot, f"WITH {SNAP}"),
    "a18_batches": (
        lambda s, d: _batch_files(s, d)[0].select("file", "kind", "batch_id", F.explode("cases").alias("c")).select("file", "kind", "batch_id", "c.case_id", F.col("c.signals")[0]["matched_text"].alias("matched_text")),
        f"SELECT {NAME} AS file, CASE WHEN o_custkey % 4 = 3 THEN 'retry' ELSE 'pool' END AS kind, 'b' || o_custkey % 32 AS batch_id, o_orderkey AS case_id, o_orderstatus AS matched_text FROM orders WHERE o_custkey % 32 <> 5",
    ),
    "a18_broken_files": (lambda s, d: _batch_files(s, d)[1], f"SELECT DISTINCT {NAME} AS file FROM orders WHERE o_custkey % 32 = 5"),
}
