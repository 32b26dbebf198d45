"""Volume archives: zip files with metadata/CasesMetadata.json and html/<file_name>.html, read where Spark reaches them."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators.tables import edges, html_text

METADATA = "metadata/CasesMetadata.json"
RAW = "path string, case_json string, html string, error string"


def archive_cases(spark: SparkSession, path: str) -> DataFrame:
    """One row a case of every archive under path: path, case_json (its metadata), html, and error (a file that is no archive, or whose metadata can't be read).

    A case without its HTML and an archive without metadata give no rows. One archive is one task's file.
    """

    def cases_of(name: str, content: bytes) -> Iterator[tuple]:
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                names = set(z.namelist())
                if METADATA not in names:
                    return
                for case in json.loads(z.read(METADATA)):
                    page = f"html/{case.get('file_name')}.html"
                    if page in names:
                        yield name, json.dumps(case), z.read(page).decode("utf-8"), None
        except (zipfile.BadZipFile, ValueError, AttributeError) as e:
            yield name, None, None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for name, content in zip(files["path"], files["content"], strict=True):
                yield pd.DataFrame(list(cases_of(name, content)), columns=["path", "case_json", "html", "error"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(run, RAW)


#: The fields of a case's metadata that are read.
CASE = (
    "id long, name string, name_abbreviation string, decision_date string, first_page string, citations array<struct<cite:string,type:string>>, court struct<name:string>, jurisdiction struct<name:string>, file_name string, "
    "cites_to array<struct<cite:string,category:string,reporter:string,year:int,weight:int,opinion_index:int,case_ids:array<long>>>, analysis struct<ocr_confidence:double,sha256:string,pagerank:struct<raw:double,percentile:double>>"
)


def case_tables(raw: DataFrame, eras: list[tuple[str, int]], jurisdictions: list[str] | None = None) -> dict[str, DataFrame]:
    """The tables cases, citations, edges, pageranks and errors of raw (as archive_cases gives it); jurisdictions: those admitted, all if None."""
    c = raw.filter("error is null").select("path", F.from_json("case_json", CASE).alias("c"), "html").select("path", "c.*", "html")
    c = c.filter(F.col("jurisdiction.name").isin(jurisdictions)) if jurisdictions is not None else c

    @F.pandas_udf("text string, page_map array<struct<offset:int,label:string>>")
    def texts(html: pd.Series) -> pd.DataFrame:
        found = [html_text(h) for h in html]
        return pd.DataFrame({"text": [t for t, _ in found], "page_map": [[{"offset": o, "label": x} for o, x in m] for _, m in found]})

    year = T.leading_year(F.col("decision_date"))
    first = F.array(F.struct(F.lit(0).alias("offset"), F.coalesce("first_page", F.lit("")).alias("label")))
    t = c.withColumn("t", texts("html"))
    cases = t.select(
        F.col("id").alias("case_id"), "name", F.col("name_abbreviation").alias("short_name"), T.primary_cite(F.col("citations")).alias("cite"), F.col("court.name").alias("court"), F.col("jurisdiction.name").alias("jurisdiction"),
        "decision_date", F.nullif(year, F.lit(0)).alias("year"), F.when(year > 0, T.era_label(year, eras)).alias("era"), F.col("t.text").alias("raw_text"), T.normalise(F.col("t.text")).alias("norm_text"),
        F.concat(first, F.col("t.page_map")).alias("page_map"), F.col("analysis.ocr_confidence").alias("ocr_confidence"), F.col("path").alias("archive"),
    )
    citations = c.select(F.col("id").alias("case_id"), F.explode("citations").alias("x")).select("case_id", "x.cite", "x.type", T.cite_key(F.col("x.cite")).alias("cite_norm")).dropDuplicates(["case_id", "cite"])
    ranks = c.filter("analysis.pagerank is not null").select(F.col("id").alias("case_id"), "analysis.pagerank.raw", "analysis.pagerank.percentile")
    return {"cases": cases, "citations": citations, "edges": edges(c.select(F.col("id").alias("case_id"), "cites_to")), "pageranks": ranks, "errors": raw.filter("error is not null").select("path", "error")}
