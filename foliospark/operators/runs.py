"""Running planned selectors, coverage, rankings, features and training."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.operators.search import has_phrase
from foliospark.operators.selection import average_precision
from foliospark.operators.tables import insert_ignore, upsert

EVIDENCE = 200  # characters on both sides of a hit
COVERED = ["selector_id", "version", "era", "jurisdiction", "fingerprint"]
#: Fingerprints of selectors that read texts, and of those without one.
FINGERPRINTS = {"phrase": "fts:v1", "near": "fts:v1", "regex": "regex:v1"}
UNKNOWN = "unknown:v1"


def union_scope(scope: DataFrame) -> DataFrame:
    """era, jurisdiction and first (the least place) of each partition of scope (selector rows with place): their union in first-seen order."""
    return scope.groupBy("era", "jurisdiction").agg(F.min("place").alias("first"))


def lexical_signals(cases: DataFrame, phrases: dict[str, list[str]], patterns: dict[str, str], version: int = 1) -> DataFrame:
    """selector_id, version, case_id, era, jurisdiction, matched_text of all phrase selectors (any of their phrases) and regex selectors: one scan of cases whatever their number.

    The text is around the first phrase found verbatim, in the selector's order, or around the first match; else its beginning.
    """
    text = F.col("norm_text")
    around = lambda at, n: F.substr(text, F.greatest(F.lit(1), at - EVIDENCE), at + n + EVIDENCE - F.greatest(F.lit(1), at - EVIDENCE))

    def hit(name: str, found: Column, shown: Column) -> Column:
        return F.when(found, F.struct(F.lit(name).alias("selector_id"), shown.alias("matched_text")))

    rows = []
    for name, terms in phrases.items():
        found, shown = F.lit(False), F.substring(text, 1, 2 * EVIDENCE)
        for t in reversed(terms):
            plain = t.rstrip("*").lower()
            found = found | has_phrase(text, t)
            shown = F.when(F.instr(text, plain) > 0, around(F.instr(text, plain), F.lit(len(plain)))).otherwise(shown)
        rows.append(hit(name, found, shown))
    for name, pattern in patterns.items():
        match = F.regexp_extract(text, f"(?i)({pattern})", 1)
        rows.append(hit(name, text.rlike(f"(?i){pattern}"), around(F.position(match, text), F.length(match))))
    return cases.select("case_id", "era", "jurisdiction", F.explode(F.array_compact(F.array(*rows))).alias("s")).select("s.selector_id", F.lit(version).alias("version"), "case_id", "era", "jurisdiction", "s.matched_text")


def run_planned(plan: DataFrame, signals: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(signals of the planned units, one row a unit with n_signals) of the plan (selector_id, version, era, jurisdiction, status), of which units with status 'run' are run; signals: one table for each kind of selector."""
    keys = ["selector_id", "version", "era", "jurisdiction"]
    units = plan.filter("status = 'run'").select(keys).distinct()
    columns = [*keys, "case_id", "matched_text"]
    found = signals[0].select(columns)
    for s in signals[1:]:
        found = found.unionByName(s.select(columns))
    found = found.join(units, keys, "left_semi")
    counts = found.groupBy(*keys).agg(F.count("*").alias("n_signals"))
    return found, units.join(counts, keys, "left").fillna(0, ["n_signals"])


def mark_covered(coverage: DataFrame, done: DataFrame) -> DataFrame:
    """coverage with the units of done (COVERED, run_id, n_signals) in place of those of equal key."""
    return upsert(coverage, done, COVERED)


def not_covered(units: DataFrame, coverage: DataFrame) -> DataFrame:
    return units.join(coverage.select(COVERED), COVERED, "left_anti")


def migrated_coverage(coverage: DataFrame, legacy: DataFrame, selectors: DataFrame, run: str) -> DataFrame:
    """coverage with the rows of a legacy table (selector_id, version, era, jurisdiction, run_id, n_signals) that it lacks, with the fingerprint of the selector's kind (selectors: selector_id, version, kind)."""
    known = F.create_map(*(F.lit(x) for kv in FINGERPRINTS.items() for x in kv))
    d = legacy.join(selectors.select("selector_id", "version", "kind"), ["selector_id", "version"], "left")
    mark = F.when(F.col("kind").isNull(), UNKNOWN).otherwise(F.coalesce(F.try_element_at(known, F.col("kind")), F.lit(f"embed:{run}|engine:v1")))
    rows = d.withColumn("fingerprint", mark).select(*COVERED, "run_id", "n_signals")
    return insert_ignore(coverage, rows, COVERED)


def stored_rankings(rankings: DataFrame, scores: DataFrame) -> DataFrame:
    """rankings (run_id, ranker_id, case_id, score) with the new scores in place of those of equal key."""
    return upsert(rankings, scores, ["run_id", "ranker_id", "case_id"])


def rerank_pool(batches: DataFrame, read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pool cases of an earlier run's batches that aren't read yet, those that were): case_id, distinct."""
    pool = batches.select(F.explode("case_ids").alias("case_id")).distinct()
    return pool.join(read.select("case_id"), "case_id", "left_anti"), pool.join(read.select("case_id"), "case_id", "left_semi")


def uncovered_jurisdictions(ranked: DataFrame, held_out: DataFrame) -> DataFrame:
    return ranked.select("jurisdiction").distinct().join(held_out.select("jurisdiction").distinct(), "jurisdiction", "left_anti")


def feature_names(labels: list[str], vectors: list[str], eras: list[str], jurisdictions: list[str], dim: int) -> list[str]:
    """The layout of case_features: its columns in order."""
    return [*(f"sel:{x}" for x in labels), "n_selectors", *(f"cos:{x}" for x in vectors), "pagerank_pct", "pagerank_missing", "log_len", "ocr_confidence", "ocr_missing", *(f"era:{x}" for x in eras), *(f"jur:{x}" for x in jurisdictions), *(f"vec:{i}" for i in range(dim))]


def case_features(cases: DataFrame, signals: DataFrame, chunk_rows: DataFrame, labels: list[str], vectors: list[str], eras: list[str], jurisdictions: list[str], dim: int) -> DataFrame:
    """case_id and the columns of feature_names for every case (case_id, era, jurisdiction, pagerank_pct, ocr_confidence, n_chars).

    signals: case_id, label (id@vN), cosine, chunk_id. The vector is that of the chunk (chunk_id, case_id, seq, v) with the highest cosine (lowest id), else the case's first, else zeros; shorter ones are filled with zeros.
    """
    s = signals.groupBy("case_id").agg(
        F.collect_set("label").alias("labels"), F.min_by("chunk_id", F.when(F.col("chunk_id").isNotNull(), F.struct(-F.coalesce("cosine", F.lit(-2.0)), "chunk_id"))).alias("best"),
        *(F.max(F.when(F.col("label") == x, F.col("cosine"))).alias(f"cos:{x}") for x in vectors),
    )
    first = chunk_rows.groupBy("case_id").agg(F.min_by("v", "seq").alias("first_v"))
    d = cases.join(s, "case_id", "left").join(chunk_rows.select(F.col("chunk_id").alias("best"), F.col("v").alias("best_v")), "best", "left").join(first, "case_id", "left")
    v = F.coalesce("best_v", "first_v", F.array().cast("array<double>"))
    one = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    q = lambda x: F.col(f"`{x}`")
    found = F.coalesce("labels", F.array().cast("array<string>"))
    return d.select(
        "case_id", *(one(F.array_contains(found, F.lit(x))).alias(f"sel:{x}") for x in labels), F.size(found).cast("double").alias("n_selectors"), *(F.coalesce(q(f"cos:{x}"), F.lit(0.0)).alias(f"cos:{x}") for x in vectors),
        F.coalesce("pagerank_pct", F.lit(0.0)).alias("pagerank_pct"), one(F.col("pagerank_pct").isNull()).alias("pagerank_missing"), F.log1p(F.coalesce("n_chars", F.lit(0))).alias("log_len"),
        F.coalesce("ocr_confidence", F.lit(0.0)).alias("ocr_confidence"), one(F.col("ocr_confidence").isNull()).alias("ocr_missing"), *(one(F.col("era") == x).alias(f"era:{x}") for x in eras), *(one(F.col("jurisdiction") == x).alias(f"jur:{x}") for x in jurisdictions),
        *(F.coalesce(F.get(v, F.lit(i)), F.lit(0.0)).alias(f"vec:{i}") for i in range(dim)),
    )


def train(rows: DataFrame, names: list[str], held_out: DataFrame, grid: tuple[float, ...] = (0.01, 0.1, 1.0, 10.0), folds: int = 5, seed: str = "cv") -> dict:
    """The logistic model of rows (case_id, label, weight and names): names, coef, intercept, mean, scale, C and its cross-validated average precision.

    Features are standardised by mean and population deviation (1 where that is 0), classes balanced on top of the weights, and C is the one of the grid with the best mean average precision over keyed folds.
    Rows that are held out fail the training. Only sums and coefficients reach the driver.
    """
    if not rows.join(held_out.select("case_id"), "case_id", "left_semi").isEmpty():
        raise ValueError("training rows are held out")
    q = lambda n: F.col(f"`{n}`")
    stats = rows.agg(*(F.avg(q(n)).alias(f"m{i}") for i, n in enumerate(names)), *(F.stddev_pop(q(n)).alias(f"s{i}") for i, n in enumerate(names)), F.count("*").alias("n"), F.sum("label").alias("positive")).first()
    mean, scale = [stats[f"m{i}"] for i in range(len(names))], [stats[f"s{i}"] or 1.0 for i in range(len(names))]
    n, positive = stats["n"], stats["positive"]
    balance = F.when(F.col("label") == 1, n / (2 * max(1, positive))).otherwise(n / (2 * max(1, n - positive)))
    d = rows.select("case_id", F.col("label").cast("double").alias("label"), (F.col("weight") * balance).alias("w"), F.pmod(F.xxhash64("case_id", F.lit(seed)), F.lit(folds)).alias("fold"), *(((q(x) - m) / s).alias(f"f{i}") for i, (x, m, s) in enumerate(zip(names, mean, scale, strict=True))))
    d = VectorAssembler(inputCols=[f"f{i}" for i in range(len(names))], outputCol="features").transform(d).select("case_id", "label", "w", "fold", "features").cache()
    probability = lambda c: vector_to_array(c)[1]

    def fitted(c: float, df: DataFrame) -> object:
        total = df.agg(F.sum("w")).first()[0]
        return LogisticRegression(weightCol="w", regParam=1.0 / (c * total), elasticNetParam=0.0, standardization=False, maxIter=200).fit(df)

    best = (-1.0, grid[0])
    for c in grid:
        scored = None
        for k in range(folds):
            out = fitted(c, d.filter(F.col("fold") != k)).transform(d.filter(F.col("fold") == k)).select(F.col("fold"), probability("probability").alias("score"), "label", F.lit(1.0).alias("weight"), F.col("case_id").alias("idx"))
            scored = out if scored is None else scored.unionByName(out)
        ap = average_precision(scored, ["fold"]).agg(F.avg("ap")).first()[0]
        best = max(best, (ap, c), key=lambda x: x[0])
    model = fitted(best[1], d)
    d.unpersist()
    return {"names": names, "coef": list(map(float, model.coefficients)), "intercept": float(model.intercept), "mean": mean, "scale": scale, "C": best[1], "ap": best[0]}


def ranking_delta(a: DataFrame, b: DataFrame, bar: float = 0.05) -> DataFrame:
    """view, delta, ships (b is better on every view) and reaches_bar (by `bar` on every view) of two tables of view and ap."""
    d = a.join(b.withColumnRenamed("ap", "new"), "view").withColumn("delta", F.col("new") - F.col("ap"))
    least = d.agg(F.min("delta").alias("least"))
    return d.crossJoin(F.broadcast(least)).select("view", "delta", (F.col("least") > 0).alias("ships"), (F.col("least") >= bar).alias("reaches_bar"))


def human_labels(records: DataFrame, reviewed: DataFrame, overturned: DataFrame) -> DataFrame:
    """case_id, label and weight of what people decided: relevant records of the file that are reviewed (1, weight 3), irrelevant ones that a reviewer overturned (0, weight 1)."""
    d = records.filter("in_file").join(reviewed.select("case_id", F.lit(True).alias("r")).distinct(), "case_id", "left").join(overturned.select("case_id", F.lit(True).alias("o")).distinct(), "case_id", "left")
    label = F.when(F.col("relevant") & F.col("r"), 1).when(~F.col("relevant") & F.col("o"), 0)
    return d.withColumn("label", label).filter("label is not null").select("case_id", "label", F.when(F.col("label") == 1, 3.0).otherwise(1.0).alias("weight"))


def split_labels(labels: DataFrame, held_1: DataFrame, held_2: DataFrame, evaluate_on: int) -> tuple[DataFrame, DataFrame]:
    """(training labels without both held-out slices, the slice evaluated on, of what has a label)."""
    both = held_1.select("case_id").unionByName(held_2.select("case_id"))
    chosen = held_2 if evaluate_on == 2 else held_1
    return labels.join(both, "case_id", "left_anti"), chosen.join(labels.select("case_id"), "case_id", "left_semi")
