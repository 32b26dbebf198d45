"""Queries of runs, training, loading and answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.functions.offsets import offset_map
from foliospark.operators import evidence as E
from foliospark.operators import runs as R
from foliospark.operators import vectors as V
from foliospark.plans.base import CASES, ERAS, cases, era_sql
from foliospark.plans.search import _match
from foliospark.session import shared_dir, table
from foliospark.sources import archives, records


def _orders(s, d, *columns):
    return table(s, d, "orders").selectExpr(*columns)


PHRASES = {"p1": ["of the", "tion*"], "p2": ["with"]}


def _plan(s, d):
    ids = s.createDataFrame([("p1",), ("p2",), ("r1",)], "selector_id string")
    return cases(s, d).select("era", "jurisdiction").distinct().crossJoin(F.broadcast(ids)).select("selector_id", F.lit(1).alias("version"), "era", "jurisdiction", F.when(F.col("selector_id") == "p2", F.when(F.col("era") == "late", "run").otherwise("covered")).otherwise("run").alias("status"))


def _run(s, d):
    return R.run_planned(_plan(s, d), [R.lexical_signals(cases(s, d), PHRASES, {"r1": "ing[a-z]+ th"})])


RUN_SQL = f"""hit AS (SELECT 'p1' AS selector_id, case_id, era, jurisdiction FROM cases WHERE {_match("of the")} OR {_match("tion*")} UNION ALL SELECT 'p2', case_id, era, jurisdiction FROM cases WHERE era = 'late' AND {_match("with")} UNION ALL SELECT 'r1', case_id, era, jurisdiction FROM cases WHERE regexp_matches(norm_text, '(?i)ing[a-z]+ th'))"""


def _coverage(s, d):
    cov = table(s, d, "orders").selectExpr("o_orderkey % 50 AS k", "o_orderkey AS seq").groupBy("k").agg(F.max("seq").alias("n_signals"))
    return cov.selectExpr("concat('s', k % 5) AS selector_id", "int(k % 3) AS version", "concat('e', k % 7) AS era", "'j' AS jurisdiction", "if(k % 5 = 0, 'unknown:v1', 'fts:v1') AS fingerprint", "'r' AS run_id", "n_signals").dropDuplicates(R.COVERED)


def _features(s, d):
    c = _orders(s, d, "o_orderkey AS case_id", "o_orderstatus AS era", "o_orderpriority AS jurisdiction", "if(o_custkey % 3 = 0, null, o_custkey / 100.0D) AS pagerank_pct", "if(o_custkey % 4 = 0, null, 0.5D) AS ocr_confidence", "o_custkey AS n_chars")
    sig = table(s, d, "lineitem").selectExpr("l_orderkey AS case_id", "concat('s', l_partkey % 3, '@v1') AS label", "l_discount * 10 AS cosine", "if(l_linenumber = 1, null, l_suppkey) AS chunk_id")
    ch = table(s, d, "supplier").selectExpr("s_suppkey AS chunk_id", "s_suppkey * 37 AS case_id", "s_nationkey AS seq", "array(s_acctbal, 1.0D) AS v")
    return R.case_features(c, sig, ch, ["s0@v1", "s1@v1"], ["s2@v1"], ["F", "O"], ["1-URGENT"], 3)


def _trained(s, d):
    """The coefficients of a model of which orders are open, from their price, customer and day."""
    rows = _orders(s, d, "o_orderkey AS case_id", "int(o_orderstatus = 'O') AS label", "1.0D AS weight", "o_totalprice AS price", "double(o_custkey) AS customer", "double(datediff(o_orderdate, date'1992-01-01')) AS day")
    model = R.train(rows.filter("case_id % 10 > 0"), ["price", "customer", "day"], rows.filter("case_id % 10 = 0").select("case_id"), (0.1, 1.0), 3)
    return s.createDataFrame([(n, round(c, 4), model["C"]) for n, c in zip(model["names"], model["coef"])], "name string, coef double, C double")


def _documents_raw(s, d):
    c = table(s, d, "documents")
    body = F.to_json(F.struct(
        F.col("doc_id").alias("id"), F.concat(F.lit("Case "), "doc_id").alias("name"), F.concat(F.lit("19"), F.lpad((F.col("doc_id") % 90 + 10).cast("string"), 2, "0"), F.lit("-01-02")).alias("decision_date"), F.lit("7").alias("first_page"),
        F.array(F.struct(F.concat("doc_id", F.lit(" Rep. 1")).alias("cite"), F.lit("official").alias("type"))).alias("citations"), F.struct(F.col("lang").alias("name")).alias("court"), F.struct(F.col("source").alias("name")).alias("jurisdiction"),
        F.array(F.struct(F.lit("1 X 2").alias("cite"), F.array(F.col("doc_id") + 1, F.col("doc_id") + 2).alias("case_ids"))).alias("cites_to"),
    ))
    html = F.concat(F.lit('<section class="casebody"><p>'), F.regexp_replace(F.coalesce("text", F.lit("")), "[<>&\\r]", " "), F.lit('</p><a class="page-label" data-label="8">*8</a><p>end</p></section>'))
    return c.select(F.lit("docs.zip").alias("path"), body.alias("case_json"), html.alias("html"), F.lit(None).cast("string").alias("error"))


def _tables(s, d):
    return archives.case_tables(_documents_raw(s, d), ERAS)


TEXT = "regexp_replace(coalesce(text, ''), '[<>&\\r]', ' ', 'g')"


def _json_records(s, d):
    path = f"{shared_dir(s)}/records-{abs(hash(d))}"
    rows = table(s, d, "labels").select((F.col("doc_id") % 16).alias("k"), F.struct(F.col("doc_id").alias("case_id"), F.expr("quality = 1 AS relevant"), F.expr("if(toxic = 1, 'x', null) AS polarity")).alias("r"))
    arrays = rows.groupBy("k").agg(F.to_json(F.collect_list("r")).alias("value"))  # one file each
    arrays.write.mode("overwrite").partitionBy("k").text(path)
    good, _ = records.record_arrays(s, path, "case_id long, relevant boolean, polarity string")
    return good.drop("file")


def _csv(s, d):
    path = f"{shared_dir(s)}/csv-{abs(hash(d))}"
    records.write_csv(_orders(s, d, "o_orderkey", "if(o_custkey % 3 = 0, null, o_orderstatus) AS status", "o_custkey"), ["o_custkey", "o_orderkey", "status"], path)
    return s.read.option("header", True).csv(path).select(F.col("o_custkey").cast("long").alias("o_custkey"), F.col("o_orderkey").cast("long").alias("o_orderkey"), F.coalesce("status", F.lit("")).alias("status"))


def _rows(s, d):
    r = cases(s, d).selectExpr("case_id", "cite", "year", "era", "jurisdiction", "if(case_id % 4 = 0, null, 'favorable') AS polarity")
    names = cases(s, d).filter("case_id % 5 > 0").select("case_id", "name", "court")
    cites = table(s, d, "part").selectExpr("p_partkey AS case_id", "array(p_brand, p_name) AS cites")
    quotes = table(s, d, "lineitem").selectExpr("l_partkey AS case_id", "l_orderkey * 10 + l_linenumber AS ord", "concat('q', l_suppkey) AS text", "string(l_linenumber) AS page", "if(l_quantity > 25, 'verified', 'failed') AS status")
    return E.case_rows(r, names, cites, quotes, table(s, d, "labels").selectExpr("doc_id AS case_id"), ["polarity"])


ROWS_SQL = f"""{CASES}, q AS (SELECT l_partkey AS case_id, arg_min(('q' || l_suppkey, l_linenumber::VARCHAR), (l_orderkey * 10 + l_linenumber, 'q' || l_suppkey, l_linenumber::VARCHAR)) AS q FROM lineitem WHERE l_quantity > 25 GROUP BY 1),
rows_ AS (SELECT CASE WHEN c.case_id % 5 > 0 THEN c.name ELSE '' END AS case_name, CASE WHEN c.case_id % 5 > 0 THEN c.court ELSE '' END AS court, CASE WHEN p_partkey IS NOT NULL THEN p_brand || '; ' || p_name ELSE c.cite END AS citations, c.year, c.era, c.jurisdiction, CASE WHEN c.case_id % 4 > 0 THEN 'favorable' END AS polarity,
  coalesce(q.q[1], '') AS quote, coalesce(q.q[2], '') AS quote_page, CASE WHEN c.case_id IN (SELECT doc_id FROM labels) THEN 'human-reviewed' ELSE 'machine-only' END AS review_tier, c.case_id FROM cases c LEFT JOIN part ON p_partkey = c.case_id LEFT JOIN q ON q.case_id = c.case_id)"""

QUERIES = {
    "a1_cases": (
        lambda s, d: _tables(s, d)["cases"].select("case_id", "cite", "court", "jurisdiction", "year", "era", F.length("raw_text").alias("n"), F.element_at("page_map", -1)["offset"].alias("page_at"), F.element_at("page_map", 1)["label"].alias("first_page")),
        f"""WITH y AS (SELECT *, 1910 + doc_id % 90 AS y, length({TEXT}) AS l FROM documents) SELECT doc_id AS case_id, doc_id || ' Rep. 1' AS cite, lang AS court, source AS jurisdiction, y::INT AS year, {era_sql("y")} AS era, (l + 6)::INT AS n, (l + 1)::INT AS page_at, '7' AS first_page FROM y""",
    ),
    "a1_citations": (lambda s, d: _tables(s, d)["citations"], "SELECT doc_id AS case_id, doc_id || ' Rep. 1' AS cite, 'official' AS type, doc_id || ' rep 1' AS cite_norm FROM documents"),
    "a1_edges": (lambda s, d: _tables(s, d)["edges"].select("citing", "cited", "cite"), "SELECT doc_id AS citing, unnest([doc_id + 1, doc_id + 2]) AS cited, '1 X 2' AS cite FROM documents"),
    "a5_offset_map": (lambda s, d: cases(s, d).select("case_id", offset_map(F.col("raw_text")).alias("o")).select("case_id", F.size("o").alias("n"), F.get("o", F.lit(0)).alias("first"), F.get("o", F.size("o") - 1).alias("last")), None),
    "a14_cells": (
        lambda s, d: cases(s, d).withColumn("dup", F.when(F.col("case_id") % 7 == 0, 1)).filter("dup is null").select("case_id", F.concat_ws("|", "era", "jurisdiction").alias("cell")),
        f"WITH {CASES} SELECT case_id, era || '|' || jurisdiction AS cell FROM cases WHERE case_id % 7 > 0",
    ),
    "a15_records": (_json_records, "SELECT doc_id AS case_id, quality = 1 AS relevant, CASE WHEN toxic = 1 THEN 'x' END AS polarity FROM labels"),
    "a16_csv": (_csv, "SELECT o_custkey, o_orderkey, CASE WHEN o_custkey % 3 > 0 THEN o_orderstatus ELSE '' END AS status FROM orders"),
    "d8_one_run": (lambda s, d: V.one_run(table(s, d, "embeddings").selectExpr("vec_id", "'r1' AS run")), "SELECT vec_id, 'r1' AS run FROM embeddings"),
    "d11_embedding_cost": (
        lambda s, d: V.embedding_cost(cases(s, d), 100, 20, 50, "cost", 0.02).select("n_cases", "sampled", "tokens"),
        f"""WITH {CASES}, t AS (SELECT case_id, list_filter(string_split(norm_text, ' '), lambda x: x <> '') AS t FROM cases ORDER BY md5('cost|' || case_id), case_id LIMIT 50), w AS (SELECT t, unnest(range(0, greatest(ceil((len(t) - 100) / 80.0)::INT, 0) + 1)) AS seq FROM t WHERE len(t) > 0),
        k AS (SELECT sum(least(seq * 80 + 100, len(t)) - seq * 80) AS k FROM w) SELECT (SELECT count(*) FROM cases) AS n_cases, 50 AS sampled, round(k * (SELECT count(*) FROM cases) / 50.0)::BIGINT AS tokens FROM k""",
    ),
    "d13_best_chunk_text": (
        lambda s, d: V.best_chunk_text(cases(s, d), table(s, d, "part").selectExpr("p_partkey AS chunk_id", "p_partkey % 120 AS case_id", "p_partkey AS seq", "p_name AS text"), table(s, d, "lineitem").selectExpr("l_partkey % 90 AS case_id", "l_discount AS cosine", "if(l_linenumber = 1, null, l_partkey) AS chunk_id")).select("case_id", F.md5("text").alias("md5")),
        f"""WITH {CASES}, s AS (SELECT l_partkey % 90 AS case_id, arg_min(l_partkey, (-l_discount, l_partkey)) AS chunk_id FROM lineitem WHERE l_linenumber <> 1 GROUP BY 1), f AS (SELECT p_partkey % 120 AS case_id, arg_min(p_name, p_partkey) AS t FROM part GROUP BY 1)
        SELECT c.case_id, md5(coalesce(p_name, f.t, substr(norm_text, 1, 2000))) AS md5 FROM cases c LEFT JOIN s ON s.case_id = c.case_id LEFT JOIN part ON p_partkey = s.chunk_id LEFT JOIN f ON f.case_id = c.case_id""",
    ),
    "f2_union_scope": (lambda s, d: R.union_scope(_orders(s, d, "o_orderstatus AS era", "o_orderpriority AS jurisdiction", "o_orderkey AS place")), "SELECT o_orderstatus AS era, o_orderpriority AS jurisdiction, min(o_orderkey) AS first FROM orders GROUP BY 1, 2"),
    "f7_marked": (
        lambda s, d: R.mark_covered(_coverage(s, d), _coverage(s, d).filter("version = 1").withColumn("run_id", F.lit("r2"))).groupBy("run_id", "version").agg(F.count("*").alias("n")),
        """WITH k AS (SELECT DISTINCT 's' || k % 5 AS s, (k % 3)::INT AS version, 'e' || k % 7 AS e, k % 5 = 0 AS u FROM (SELECT DISTINCT o_orderkey % 50 AS k FROM orders)) SELECT CASE WHEN version = 1 THEN 'r2' ELSE 'r' END AS run_id, version, count(*) AS n FROM k GROUP BY 1, 2""",
    ),
    "f8_migrated": (
        lambda s, d: R.migrated_coverage(_coverage(s, d).filter("selector_id = 's1'"), _coverage(s, d).drop("fingerprint").dropDuplicates(["selector_id", "version", "era"]), s.createDataFrame([("s1", 1, "phrase"), ("s2", 1, "embed"), ("s3", 2, "regex")], "selector_id string, version int, kind string"), "run0").groupBy("fingerprint").agg(F.count("*").alias("n")),
        """WITH k AS (SELECT DISTINCT 's' || k % 5 AS s, (k % 3)::INT AS v, 'e' || k % 7 AS e FROM (SELECT DISTINCT o_orderkey % 50 AS k FROM orders)), m AS (SELECT *, CASE WHEN s = 's1' AND v = 1 THEN 'fts:v1' WHEN s = 's2' AND v = 1 THEN 'embed:run0|engine:v1' WHEN s = 's3' AND v = 2 THEN 'regex:v1' ELSE 'unknown:v1' END AS f FROM k),
        a AS (SELECT s, v, e, 'fts:v1' AS f FROM k WHERE s = 's1' UNION SELECT s, v, e, f FROM m) SELECT f AS fingerprint, count(*) AS n FROM a GROUP BY 1""",
    ),
    "f9_signals": (lambda s, d: _run(s, d)[0].select("selector_id", "case_id", "era", "jurisdiction"), f"WITH {CASES}, {RUN_SQL} SELECT * FROM hit"),
    "f9_unit_counts": (
        lambda s, d: _run(s, d)[1].select("selector_id", "era", "jurisdiction", "n_signals"),
        f"""WITH {CASES}, {RUN_SQL}, u AS (SELECT DISTINCT i.s AS selector_id, era, jurisdiction FROM cases, (VALUES ('p1'), ('p2'), ('r1')) i(s) WHERE i.s <> 'p2' OR era = 'late')
        SELECT u.selector_id, u.era, u.jurisdiction, count(case_id) AS n_signals FROM u LEFT JOIN hit USING (selector_id, era, jurisdiction) GROUP BY ALL""",
    ),
    "f16_rankings": (
        lambda s, d: R.stored_rankings(_orders(s, d, "'r' AS run_id", "'k' AS ranker_id", "o_orderkey AS case_id", "1.0D AS score"), _orders(s, d, "'r' AS run_id", "if(o_custkey % 2 = 0, 'k', 'l') AS ranker_id", "o_orderkey AS case_id", "2.0D AS score")),
        "SELECT 'r' AS run_id, 'k' AS ranker_id, o_orderkey AS case_id, CASE WHEN o_custkey % 2 = 0 THEN 2.0 ELSE 1.0 END::DOUBLE AS score FROM orders UNION ALL SELECT 'r', 'l', o_orderkey, 2.0 FROM orders WHERE o_custkey % 2 = 1",
    ),
    "f17_rerank_pool": (
        lambda s, d: R.rerank_pool(table(s, d, "lineitem").groupBy("l_suppkey").agg(F.collect_set("l_orderkey").alias("case_ids")), _orders(s, d, "o_orderkey AS case_id", "o_custkey").filter("o_custkey % 3 = 0"))[0],
        "SELECT DISTINCT l_orderkey AS case_id FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey % 3 = 0)",
    ),
    "f17_uncovered": (lambda s, d: R.uncovered_jurisdictions(cases(s, d), cases(s, d).filter("case_id % 40 = 1")), f"WITH {CASES} SELECT DISTINCT jurisdiction FROM cases WHERE jurisdiction NOT IN (SELECT jurisdiction FROM cases WHERE case_id % 40 = 1)"),
    "g4_features": (
        lambda s, d: _features(s, d).select("case_id", *(F.round(F.col(f"`{c}`"), 6).alias(c.replace(":", "_").replace("@", "_").replace("-", "_")) for c in R.feature_names(["s0@v1", "s1@v1"], ["s2@v1"], ["F", "O"], ["1-URGENT"], 3))),
        """WITH s AS (SELECT l_orderkey AS case_id, count(DISTINCT l_partkey % 3) AS n, bool_or(l_partkey % 3 = 0) AS a, bool_or(l_partkey % 3 = 1) AS b, max(CASE WHEN l_partkey % 3 = 2 THEN l_discount * 10 END) AS c, arg_min(l_suppkey, (-l_discount * 10, l_suppkey)) FILTER (WHERE l_linenumber <> 1) AS best FROM lineitem GROUP BY 1),
        f AS (SELECT s_suppkey * 37 AS case_id, s_acctbal AS v FROM supplier)
        SELECT o_orderkey AS case_id, coalesce(a, false)::INT::DOUBLE AS sel_s0_v1, coalesce(b, false)::INT::DOUBLE AS sel_s1_v1, coalesce(n, 0)::DOUBLE AS n_selectors, round(coalesce(c, 0), 6)::DOUBLE AS cos_s2_v1, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE round(o_custkey / 100.0, 6) END::DOUBLE AS pagerank_pct, (o_custkey % 3 = 0)::INT::DOUBLE AS pagerank_missing,
        round(ln(1 + o_custkey), 6) AS log_len, CASE WHEN o_custkey % 4 = 0 THEN 0 ELSE 0.5 END::DOUBLE AS ocr_confidence, (o_custkey % 4 = 0)::INT::DOUBLE AS ocr_missing, (o_orderstatus = 'F')::INT::DOUBLE AS era_F, (o_orderstatus = 'O')::INT::DOUBLE AS era_O, (o_orderpriority = '1-URGENT')::INT::DOUBLE AS jur_1_URGENT,
        round(coalesce(x.s_acctbal, f.v, 0), 6)::DOUBLE AS vec_0, CASE WHEN x.s_suppkey IS NOT NULL OR f.case_id IS NOT NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS vec_1, 0.0::DOUBLE AS vec_2
        FROM orders LEFT JOIN s ON s.case_id = o_orderkey LEFT JOIN supplier x ON x.s_suppkey = best LEFT JOIN f ON f.case_id = o_orderkey""",
    ),
    "g6_trained_model": (_trained, None),
    "g10_ranking_delta": (
        lambda s, d: R.ranking_delta(_orders(s, d, "o_orderstatus AS view", "o_totalprice").groupBy("view").agg((F.avg("o_totalprice") / 1e6).alias("ap")), _orders(s, d, "o_orderstatus AS view", "o_totalprice").groupBy("view").agg((F.max("o_totalprice") / 1e6).alias("ap"))).select("view", F.round("delta", 8).alias("delta"), "ships", "reaches_bar"),
        "WITH d AS (SELECT o_orderstatus AS view, max(o_totalprice) / 1e6 - avg(o_totalprice) / 1e6 AS delta FROM orders GROUP BY 1) SELECT view, round(delta, 8) AS delta, min(delta) OVER () > 0 AS ships, min(delta) OVER () >= 0.05 AS reaches_bar FROM d",
    ),
    "g12_human_labels": (
        lambda s, d: R.human_labels(_orders(s, d, "o_orderkey AS case_id", "o_custkey % 5 > 0 AS in_file", "o_custkey % 2 = 0 AS relevant"), _orders(s, d, "o_orderkey AS case_id", "o_custkey").filter("o_custkey % 3 = 0"), _orders(s, d, "o_orderkey AS case_id", "o_custkey").filter("o_custkey % 7 = 0")),
        "SELECT o_orderkey AS case_id, (o_custkey % 2 = 0)::INT AS label, CASE WHEN o_custkey % 2 = 0 THEN 3.0 ELSE 1.0 END::DOUBLE AS weight FROM orders WHERE o_custkey % 5 > 0 AND ((o_custkey % 2 = 0 AND o_custkey % 3 = 0) OR (o_custkey % 2 = 1 AND o_custkey % 7 = 0))",
    ),
    "g14_training_split": (
        lambda s, d: R.split_labels(*(_orders(s, d, "o_orderkey AS case_id", "o_custkey").filter(f) for f in ("o_custkey % 2 = 0", "o_custkey % 3 = 0", "o_custkey % 5 = 0")), 2)[0].select("case_id").withColumn("part", F.lit("train")).unionByName(R.split_labels(*(_orders(s, d, "o_orderkey AS case_id", "o_custkey").filter(f) for f in ("o_custkey % 2 = 0", "o_custkey % 3 = 0", "o_custkey % 5 = 0")), 2)[1].select("case_id").withColumn("part", F.lit("evaluate"))),
        "SELECT o_orderkey AS case_id, 'train' AS part FROM orders WHERE o_custkey % 2 = 0 AND o_custkey % 3 > 0 AND o_custkey % 5 > 0 UNION ALL SELECT o_orderkey, 'evaluate' FROM orders WHERE o_custkey % 10 = 0",
    ),
    "m4_text_matches": (lambda s, d: E.text_matches(cases(s, d).filter("era = 'late'"), cases(s, d), ["of the", "with"]), f"WITH {CASES} SELECT case_id FROM cases WHERE era = 'late' AND ({_match('of the')} OR {_match('with')})"),
    "m5_case_rows": (_rows, f"WITH {ROWS_SQL} SELECT * FROM rows_"),
    "m10_answer_summary": (
        lambda s, d: E.answer(_rows(s, d), ["court"])["summary"],
        f"WITH {ROWS_SQL} SELECT jurisdiction, era, court, count(*) FILTER (WHERE review_tier = 'human-reviewed') AS human_reviewed, count(*) FILTER (WHERE review_tier <> 'human-reviewed') AS machine_only, grouping(jurisdiction, era, court) AS g FROM rows_ GROUP BY GROUPING SETS ((), (jurisdiction, era), (court))",
    ),
    "m10_answer_earliest": (
        lambda s, d: E.answer(_rows(s, d), ["court"])["earliest"],
        f"WITH {ROWS_SQL} SELECT jurisdiction, case_id, year FROM (SELECT *, row_number() OVER (PARTITION BY jurisdiction ORDER BY year NULLS LAST, case_id) AS r FROM rows_) WHERE r = 1",
    ),
}
