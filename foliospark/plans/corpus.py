"""Queries of loading, chunks, vectors and the graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators import tables as L
from foliospark.operators import vectors as V
from foliospark.plans.base import CASES, ERAS, cases, era_sql
from foliospark.session import table


def _vectors(s, d):
    e = table(s, d, "embeddings")
    return e.select((F.col("vec_id") % 200).alias("case_id"), F.col("vec_id").alias("chunk_id"), F.col("label").cast("string").alias("cell"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))


def _sims(s, d):
    q = [float(x) for x in _vectors(s, d).filter("chunk_id = 0").first()["v"]]
    return V.scored(_vectors(s, d), {"q": q}).withColumnRenamed("sim_q", "sim")


SIMS = "sims AS (SELECT vec_id % 200 AS case_id, vec_id AS chunk_id, label::VARCHAR AS cell, list_dot_product(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)) AS sim FROM embeddings)"


def _edges(s, d):
    o, li = table(s, d, "orders"), table(s, d, "lineitem")
    return o.join(li, o.o_orderkey == li.l_orderkey).select(F.col("o_custkey").alias("citing"), (F.col("l_suppkey") + 1).alias("cited"), F.concat_ws(" ", "l_partkey", F.lit("Rep")).alias("cite")).distinct()


EDGES = "edge AS (SELECT DISTINCT o_custkey AS citing, l_suppkey + 1 AS cited, l_partkey || ' Rep' AS cite FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"


def _cites(s, d):
    li = table(s, d, "lineitem").select(F.col("l_orderkey").alias("case_id"), F.concat_ws(" ", F.col("l_partkey").cast("string"), F.lit("Rep")).alias("cite"), F.array("l_suppkey", "l_partkey").alias("case_ids"))
    return li.groupBy("case_id").agg(F.collect_list(F.struct("cite", "case_ids")).alias("cites_to"))


QUERIES = {
    "a2_admission": (
        lambda s, d: L.admitted(table(s, d, "documents").select("doc_id", F.col("source").alias("jurisdiction"), F.col("lang").alias("slug")), ["src1", "src2"], ["fr"]),
        "SELECT doc_id, source AS jurisdiction, lang AS slug FROM documents WHERE source IN ('src1', 'src2') OR lang IN ('fr')",
    ),
    "a3_html_text": (lambda s, d: L.pages_to_text(table(s, d, "pages")).withColumn("page_map", F.size("page_map")), None),
    "a4_normalise": (lambda s, d: cases(s, d).select("case_id", F.md5("norm_text").alias("norm_md5"), F.length("norm_text").alias("n")), f"WITH {CASES} SELECT case_id, md5(norm_text) AS norm_md5, length(norm_text) AS n FROM cases"),
    "a6_cite_key": (lambda s, d: table(s, d, "part").select("p_partkey", T.cite_key(F.concat_ws(". ", "p_brand", "p_type")).alias("k")), "SELECT p_partkey, trim(regexp_replace(lower(replace(concat_ws('. ', p_brand, p_type), '.', ' ')), '\\s+', ' ', 'g')) AS k FROM part"),
    "a7_leading_year": (
        lambda s, d: cases(s, d).select("case_id", T.leading_year(F.when(F.col("case_id") % 3 == 0, F.lit("n.d.")).otherwise(F.col("decision_date"))).alias("y")),
        f"WITH {CASES} SELECT case_id, coalesce(CASE WHEN case_id % 3 = 0 THEN 0 ELSE year END, 0) AS y FROM cases",
    ),
    "a8_primary_cite": (
        lambda s, d: table(s, d, "customer").select("c_custkey", T.primary_cite(F.when(F.col("c_custkey") % 4 == 0, F.array().cast("array<struct<cite:string,type:string>>")).otherwise(F.array(F.struct(F.col("c_name").alias("cite"), F.lit("x").alias("type")), F.struct(F.col("c_mktsegment").alias("cite"), F.when(F.col("c_custkey") % 2 == 0, "official").otherwise("y").alias("type"))))).alias("cite")),
        "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_name END AS cite FROM customer",
    ),
    "a9_era": (lambda s, d: table(s, d, "orders").select("o_orderkey", T.era_label(F.when(F.col("o_orderkey") % 10 != 0, F.year("o_orderdate")), ERAS).alias("era")), f"SELECT o_orderkey, {era_sql('CASE WHEN o_orderkey % 10 <> 0 THEN year(o_orderdate) END')} AS era FROM orders"),
    "a10_edges": (lambda s, d: L.edges(_cites(s, d)), "SELECT DISTINCT l_orderkey AS citing, unnest([l_suppkey, l_partkey]) AS cited, l_partkey || ' Rep' AS cite FROM lineitem"),
    "a11_pagerank": (
        lambda s, d: L.attach_pagerank(cases(s, d).select("case_id"), table(s, d, "customer").select(F.col("c_custkey").alias("case_id"), F.col("c_acctbal").alias("raw"), F.lit(0.5).alias("percentile"))),
        "SELECT doc_id AS case_id, c_acctbal AS raw, CASE WHEN c_custkey IS NOT NULL THEN 0.5::DOUBLE END AS percentile FROM documents LEFT JOIN customer ON c_custkey = doc_id",
    ),
    "a12_not_loaded": (
        lambda s, d: L.not_loaded(table(s, d, "orders").select(F.col("o_orderkey").alias("zip_key")), table(s, d, "lineitem").select(F.col("l_orderkey").alias("zip_key"), F.col("l_linenumber").alias("norm_version")), 4),
        "SELECT o_orderkey AS zip_key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 4)",
    ),
    "a13_upsert": (
        lambda s, d: L.upsert(table(s, d, "customer").select("c_custkey", "c_acctbal"), table(s, d, "customer").filter("c_custkey % 3 = 0").select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal")), ["c_custkey"]),
        "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer",
    ),
    "a13_first_per_key": (
        lambda s, d: L.first_per_key(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"], F.desc("l_linenumber"), F.col("l_partkey")),
        "SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey) AS r FROM lineitem) WHERE r = 1",
    ),
    "a17_sub_corpus": (lambda s, d: L.sub_corpus({"c": cases(s, d).select("case_id", "era")}, table(s, d, "labels").select(F.col("doc_id").alias("case_id")))["c"], f"WITH {CASES} SELECT case_id, era FROM cases WHERE case_id IN (SELECT doc_id FROM labels)"),
    "a19_lookup": (
        lambda s, d: L.lookup_in_order(cases(s, d), table(s, d, "labels").select(F.col("doc_id").alias("case_id"), (-F.col("doc_id")).alias("ord"))).select("case_id", "ord", F.length("norm_text").alias("n")),
        f"WITH {CASES} SELECT case_id, -case_id AS ord, length(norm_text) AS n FROM cases WHERE case_id IN (SELECT doc_id FROM labels)",
    ),
    "d1_chunks": (
        lambda s, d: V.chunks(cases(s, d), 100, 20).select("case_id", "seq", F.md5("text").alias("m")),
        f"""WITH {CASES}, t AS (SELECT case_id, list_filter(string_split(norm_text, ' '), lambda x: x <> '') AS t FROM cases), w AS (SELECT case_id, t, unnest(range(0, greatest(ceil((len(t) - 100) / 80.0)::INT, 0) + 1)) AS seq FROM t WHERE len(t) > 0)
        SELECT case_id, seq, md5(array_to_string(list_slice(t, seq * 80 + 1, least(seq * 80 + 100, len(t))), ' ')) AS m FROM w""",
    ),
    "d2_embedding_input": (
        lambda s, d: V.chunks(cases(s, d), 100, 20).join(cases(s, d).select("case_id", "jurisdiction", "year"), "case_id").select("case_id", "seq", F.md5(V.embedding_input(["jurisdiction", "year"], F.col("text"))).alias("x")),
        f"""WITH {CASES}, t AS (SELECT case_id, jurisdiction, year, list_filter(string_split(norm_text, ' '), lambda x: x <> '') AS t FROM cases), w AS (SELECT *, unnest(range(0, greatest(ceil((len(t) - 100) / 80.0)::INT, 0) + 1)) AS seq FROM t WHERE len(t) > 0)
        SELECT case_id, seq, md5(coalesce(jurisdiction, '') || ' | ' || coalesce(year::VARCHAR, '') || ' | ' || array_to_string(list_slice(t, seq * 80 + 1, least(seq * 80 + 100, len(t))), ' ')) AS x FROM w""",
    ),
    "d3_quantised": (
        lambda s, d: table(s, d, "embeddings").select("vec_id", V.quantised(F.col("embedding")).alias("z")).select("vec_id", F.round("z.scale", 8).alias("scale"), F.aggregate("z.q", F.lit(0), lambda a, x: a + x).alias("total")),
        """WITH n AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS l FROM embeddings), u AS (SELECT vec_id, list_transform(v, lambda x: x / l) AS u FROM n),
        s AS (SELECT vec_id, u, list_max(list_transform(u, lambda x: abs(x))) / 127 AS s FROM u)
        SELECT vec_id, round(s, 8) AS scale, list_sum(list_transform(u, lambda x: round_even(x / s, 0)::INT))::INT AS total FROM s""",
    ),
    "d4_query_scores": (lambda s, d: _sims(s, d).select("chunk_id", F.round("sim", 6).alias("sim")), f"WITH {SIMS} SELECT chunk_id, round(sim, 6) AS sim FROM sims"),
    "d5_top_cases": (
        lambda s, d: V.top_cases(_sims(s, d), 5, 0.05, ["cell"], s.createDataFrame([(0,)], "case_id long")).select("cell", "case_id", "rank", F.round("sim", 6).alias("sim")),
        f"""WITH {SIMS}, p AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY sim DESC, chunk_id) AS place FROM sims), c AS (SELECT cell, case_id, min(place) AS place, arg_min(sim, place) AS sim FROM p WHERE place <= 15 AND sim >= 0.05 AND case_id <> 0 GROUP BY cell, case_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY place) AS rank FROM c) SELECT cell, case_id, rank, round(sim, 6) AS sim FROM r WHERE rank <= 5""",
    ),
    "d6_mean_query": (
        lambda s, d: V.mean_query(_vectors(s, d).filter("cell = '1'")).select(F.posexplode("q").alias("i", "x")).select("i", F.round("x", 6).alias("x")),
        """WITH m AS (SELECT i - 1 AS i, avg(x) AS m FROM (SELECT unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE label = 1) GROUP BY i), n AS (SELECT sqrt(sum(m * m)) AS n FROM m) SELECT i, round(m / n, 6) AS x FROM m, n""",
    ),
    "d7_runs_of_cells": (
        lambda s, d: V.runs_of_cells(table(s, d, "nation").select(F.col("n_nationkey").cast("string").alias("cell")), _vectors(s, d).withColumn("run", F.concat(F.lit("r"), F.col("chunk_id") % 2))).select("cell", F.array_join("runs", ",").alias("runs")),
        "SELECT n_nationkey::VARCHAR AS cell, coalesce((SELECT string_agg(DISTINCT 'r' || vec_id % 2, ',' ORDER BY 'r' || vec_id % 2) FROM embeddings WHERE label = n_nationkey), '') AS runs FROM nation",
    ),
    "d10_to_embed": (
        lambda s, d: V.to_embed(cases(s, d).withColumn("is_duplicate_of", F.when(F.col("case_id") % 7 == 0, F.col("case_id") - 1)), _vectors(s, d).withColumn("run", F.concat(F.lit("r"), F.col("chunk_id") % 2)), "r1").select("case_id"),
        f"WITH {CASES} SELECT case_id FROM cases WHERE case_id % 7 <> 0 AND norm_text <> '' AND case_id NOT IN (SELECT vec_id % 200 FROM embeddings WHERE vec_id % 2 = 1)",
    ),
    "d12_consistency": (
        lambda s, d: V.consistency(_vectors(s, d).select(F.col("chunk_id").alias("id"), "v"), _vectors(s, d).select(F.col("chunk_id").alias("id"), F.transform("v", lambda x: F.round(x, 2)).alias("v")), 0.99).select("n", "ok", *(F.round(c, 6).alias(c) for c in ("mean", "p5", "least"))),
        """WITH p AS (SELECT embedding::DOUBLE[] AS x, list_transform(embedding::DOUBLE[], lambda z: round(z, 2)) AS y FROM embeddings), c AS (SELECT list_cosine_similarity(x, y) AS c FROM p)
        SELECT count(*) AS n, quantile_cont(c, 0.05) >= 0.99 AS ok, round(avg(c), 6) AS mean, round(quantile_cont(c, 0.05), 6) AS p5, round(min(c), 6) AS least FROM c""",
    ),
    "e1_neighbours": (
        lambda s, d: V.neighbours(_edges(s, d), s.createDataFrame([(3,), (8,)], "case_id long"), "both"),
        f"""WITH {EDGES}, a AS (SELECT citing AS case_id, 0 AS p, 'cites ' || min(cite) AS t FROM edge WHERE cited IN (3, 8) GROUP BY 1 UNION ALL SELECT cited, 1, 'cited by ' || min(cite) FROM edge WHERE citing IN (3, 8) GROUP BY 1)
        SELECT case_id, arg_min(t, p) AS matched_text FROM a WHERE case_id NOT IN (3, 8) GROUP BY case_id""",
    ),
}
