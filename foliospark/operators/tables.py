"""Loading tables: admission, edges, upserts, incremental loads, sub-corpora, lookups."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Elements that end with a line end.
BLOCKS = frozenset("p h1 h2 h3 h4 h5 blockquote section article aside div tr".split())
#: Elements without content, and those whose beginning ends an open one: paragraphs end where a block begins, items and cells where the next does.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote section article aside div ul ol dl table pre form fieldset hr address center".split())
ENDS_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}


def admitted(rows: DataFrame, jurisdictions: list[str], slugs: list[str]) -> DataFrame:
    """Rows whose jurisdiction or slug is listed."""
    return rows.filter(F.col("jurisdiction").isin(jurisdictions) | F.col("slug").isin(slugs))


class _Text(HTMLParser):
    """Text in document order with line ends where blocks end, closed by their tags or by what follows; page-label anchors give (offset, label) instead of text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.length = 0
        self.pages: list[tuple[int, str]] = []
        self.label: list[str] | None = None
        self.open: list[str] = []

    def emit(self, s: str) -> None:
        self.out.append(s)
        self.length += len(s)

    def end(self, n: int) -> None:
        """Closes open elements until n are left, the inner first."""
        while len(self.open) > n:
            if self.open.pop() in BLOCKS:
                self.emit("\n")

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "a" and "page-label" in (a.get("class") or ""):
            self.pages.append((self.length, a.get("data-label") or ""))
            self.label = []
            return
        if tag in ENDS_PARAGRAPH and "p" in self.open:
            self.end(len(self.open) - 1 - self.open[::-1].index("p"))
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i] in HOLDS.get(tag, ()):
                break
            if self.open[i] in ENDS_LIKE.get(tag, ()):
                self.end(i)
        if tag not in VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag not in BLOCKS:
            return
        self.handle_starttag(tag, attrs)
        self.end(len(self.open) - 1)

    def handle_endtag(self, tag):
        if tag == "a" and self.label is not None:
            at, label = self.pages[-1]
            self.pages[-1] = (at, label or "".join(self.label).strip("*"))
            self.label = None
        elif tag in self.open:
            self.end(len(self.open) - 1 - self.open[::-1].index(tag))
        elif tag == "p":  # stands for an empty paragraph
            self.emit("\n")

    def close(self) -> None:
        super().close()
        self.end(0)

    def handle_data(self, data):
        if self.label is not None:
            self.label.append(data)
        else:
            self.emit(data)


def html_text(html: str) -> tuple[str, list[tuple[int, str]]]:
    parser = _Text()
    parser.feed(html)
    parser.close()
    return "".join(parser.out), parser.pages


def pages_to_text(pages: DataFrame) -> DataFrame:
    """page_id, text and page_map (array of offset and label) of each HTML page; a null page has an empty text."""

    def run(batches):
        for pdf in batches:
            found = [html_text(h or "") for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "text": [t for t, _ in found], "page_map": [[{"offset": o, "label": x} for o, x in m] for _, m in found]})

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, text string, page_map array<struct<offset:int,label:string>>")


def first_per_key(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the order: insert-or-ignore by load order, insert-or-replace by its reverse."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")


def upsert(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """table with the rows of new in place of those of the same key."""
    return table.join(new.select(keys).distinct(), keys, "left_anti").unionByName(new)


def insert_ignore(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return table.unionByName(new.join(table.select(keys).distinct(), keys, "left_anti"))


def not_loaded(archives: DataFrame, log: DataFrame, version: int) -> DataFrame:
    """Archives that the log doesn't hold at this version."""
    return archives.join(log.filter(F.col("norm_version") == version).select("zip_key"), "zip_key", "left_anti")


def edges(cites: DataFrame) -> DataFrame:
    """citing, cited, cite and the citation's category, reporter, year, weight and opinion_index, of cites (case_id, cites_to); of rows with one key the first in the list stays."""
    more = [f.name for f in cites.schema["cites_to"].dataType.elementType.fields if f.name not in ("cite", "case_ids")]
    rows = cites.select(F.col("case_id").alias("citing"), F.posexplode("cites_to").alias("ord", "c")).select("citing", "ord", F.col("c.cite").alias("cite"), *(F.col(f"c.{k}").alias(k) for k in more), F.posexplode("c.case_ids").alias("ord2", "cited"))
    rest = F.struct("ord", "ord2", *more)
    return rows.groupBy("citing", "cited", "cite").agg(F.min_by(rest, F.struct("ord", "ord2")).alias("r")).select("citing", "cited", "cite", *(F.col(f"r.{k}").alias(k) for k in more))


def attach_pagerank(cases: DataFrame, ranks: DataFrame) -> DataFrame:
    """cases with raw and percentile of the supplied ranks; cases without one have none."""
    return cases.join(ranks.select("case_id", "raw", "percentile"), "case_id", "left")


def sub_corpus(tables: dict[str, DataFrame], ids: DataFrame) -> dict[str, DataFrame]:
    """Each table's rows of the given case ids."""
    return {k: df.join(ids, "case_id", "left_semi") for k, df in tables.items()}


def lookup_in_order(cases: DataFrame, wanted: DataFrame) -> DataFrame:
    """case_id, ord and norm_text in the requested order; any id without a case fails the job and is named."""
    d = wanted.join(cases.select("case_id", "norm_text", F.lit(True).alias("found")), "case_id", "left")
    bad = F.raise_error(F.concat(F.lit("no case "), F.col("case_id").cast("string"))).cast("string")
    return d.select("case_id", "ord", F.when(F.col("found"), F.col("norm_text")).otherwise(bad).alias("norm_text")).orderBy("ord")
