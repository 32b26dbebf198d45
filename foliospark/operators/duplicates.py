"""Duplicate cases by citation, and parallel reports of one decision by name, date and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.session import shuffles_removed, written

GROUP_KEYS = ("jurisdiction", "court", "year", "name_key")
#: Members of a group that meet one copy of its winner, rows of a partition in which they meet, and most groups that are broadcast (about 100 bytes each).
PIECE, PARTITION, BROADCAST = 256, 20_000, 500_000
LEAST_NAME, LEAST_SHINGLES, SIZE_RATIO = 6, 50, (0.5, 2.0)


def citation_duplicates(citations: DataFrame, official: DataFrame) -> DataFrame:
    """(loser, winner): each case that shares a citation key with another, at its first mark.

    citations: case_id, cite_norm. official: case_id of the cases whose own citation is the official reporter's. Of a pair a < b, a wins
    unless only b is official; pairs are taken by (a, b), a loser keeps its first mark, and chains stay open.
    All pairs of one key are never built: a loser's first pair in that order is found per key from the key's smallest ids.
    For b that loses: its first pair is with the smallest id of any of its keys that beats it. For an official-less a, it loses
    to the smallest official id above it, unless a smaller id beat it before.
    """
    rows = citations.select("case_id", "cite_norm").distinct().join(official.select("case_id", F.lit(True).alias("off")).distinct(), "case_id", "left")
    rows = rows.withColumn("off", F.coalesce("off", F.lit(False)))
    least = rows.groupBy("cite_norm").agg(F.min("case_id").alias("least"), F.min(F.when(F.col("off"), F.col("case_id"))).alias("least_off"))
    rows = rows.join(least, "cite_norm")
    # a smaller id beats b if b isn't official, or if it is itself official; the smallest of a key is as good as any
    beaten = F.when(F.col("off"), F.when(F.col("least_off") < F.col("case_id"), F.col("least_off"))).otherwise(F.when(F.col("least") < F.col("case_id"), F.col("least")))
    # looked at only for the smallest id of all its keys: every official one is above it then
    by_later = F.when(~F.col("off") & (F.col("least_off") > F.col("case_id")), F.col("least_off"))
    marks = rows.select("case_id", beaten.alias("smaller"), by_later.alias("larger")).groupBy("case_id").agg(F.min("smaller").alias("smaller"), F.min("larger").alias("larger"))
    # pairs in order of (a, b): one with a smaller partner comes before any with this case as a
    return marks.select(F.col("case_id").alias("loser"), F.coalesce("smaller", "larger").alias("winner")).filter("winner is not null")


def candidate_groups(cases: DataFrame) -> DataFrame:
    """Members of groups that share jurisdiction, court, year and name (6 characters at least) and have more than one reporter, with their group's winner and the number of its members (`n_members`).

    The groups are written first and their number is known then: up to BROADCAST of them go to all executors, and no case moves to find its group.
    """
    d = cases.withColumn("name_key", T.group_name(F.col("name"))).filter(F.length("name_key") >= LEAST_NAME)
    d = d.withColumns({k: F.coalesce(k, F.lit("")) for k in ("jurisdiction", "court")}).withColumn("year_key", F.coalesce("year", F.lit(-1)))
    keys = ["jurisdiction", "court", "year_key", "name_key"]
    groups = d.groupBy(*keys).agg(F.min("reporter").alias("r1"), F.max("reporter").alias("r2"), F.min(F.struct(~F.col("official"), "case_id")).alias("w"), F.count("*").alias("n_members"))
    several = groups.filter(~F.col("r1").eqNullSafe(F.col("r2"))).select(*keys, F.col("w.case_id").alias("winner"), "n_members")
    with shuffles_removed(cases.sparkSession):
        several = written(several, "groups")
    return d.join(F.broadcast(several) if several.count() <= BROADCAST else several, keys).drop("year_key")


def _shingles(words: Column, n: int) -> Column:
    """Hashes of the kinds of n words in a row, straight from the words' places, without an array for each."""
    run = lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(n)))
    runs = F.when(F.size(words) >= n, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(words) - n), run)))
    return F.coalesce(runs, F.array().cast("array<bigint>"))


def scored_pairs(members: DataFrame) -> DataFrame:
    """Each member against its group's winner: containment of 3- and 5-word shingles (4 places) and the guards.

    The winner is the official case of lowest id, else the lowest id. Shingles are compared as 64-bit hashes. Only texts of members move, each once: at most
    about PIECE of a group meet a copy of their winner's shingles, so no group is gathered in one task. The pairs are written once.
    """
    pieces = F.ceil(F.col("n_members") / PIECE).cast("int")
    parts = max(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), members.count() // PARTITION + 1)
    d = members.withColumn("w", T.plain_words(F.col("norm_text")))
    first = d.filter("case_id = winner").select("winner", F.col("decision_date").alias("wd"), _shingles(F.col("w"), 3).alias("w3"), _shingles(F.col("w"), 5).alias("w5"), F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"))
    others = members.filter("case_id <> winner").select("case_id", "winner", "decision_date", "norm_text", F.pmod(F.xxhash64("case_id"), pieces).cast("int").alias("piece"))
    both = others.repartition(parts, "winner", "piece").join(first.repartition(parts, "winner", "piece"), ["winner", "piece"])
    both = both.withColumn("w", T.plain_words(F.col("norm_text"))).select("winner", "case_id", "decision_date", "wd", "w3", "w5", _shingles(F.col("w"), 3).alias("s3"), _shingles(F.col("w"), 5).alias("s5"))
    both = both.select("winner", "case_id", "decision_date", "wd", *(F.size(f"{x}{n}").alias(f"{y}{n}") for x, y in (("w", "m"), ("s", "n")) for n in (3, 5)), *(F.size(F.array_intersect(f"s{n}", f"w{n}")).alias(f"both{n}") for n in (3, 5)))
    contained = lambda n: F.bround(F.when(F.least(f"n{n}", f"m{n}") > 0, F.col(f"both{n}") / F.least(f"n{n}", f"m{n}")).otherwise(0.0), 4).alias(f"c{n}")
    n, m = F.col("m5"), F.col("n5")
    pairs = both.select(
        "winner",
        F.col("case_id").alias("loser"),
        contained(3),
        contained(5),
        T.dates_compatible(F.col("wd"), F.col("decision_date")).alias("date_ok"),
        ((n > 0) & (m > 0) & (n >= SIZE_RATIO[0] * m) & (n <= SIZE_RATIO[1] * m)).alias("size_ok"),
        (F.least(n, m) >= LEAST_SHINGLES).alias("long_enough"),
    )
    with shuffles_removed(members.sparkSession):
        return written(pairs, "pairs")


def guarded(pairs: DataFrame) -> DataFrame:
    return pairs.filter("date_ok and size_ok and long_enough")


def banded_sample(pairs: DataFrame, k: int, seed: str, least: float = 0.2) -> DataFrame:
    """At most k guarded pairs of each 0.1 band of c5 from `least` on, in keyed md5 order."""
    d = guarded(pairs).filter(F.col("c5") >= least).withColumn("band", F.floor(F.col("c5") * 10 + 1e-9).cast("int"))
    order = F.md5(F.concat_ws("|", F.lit(seed), "winner", "loser"))
    return d.withColumn("r", F.row_number().over(Window.partitionBy("band").orderBy(order))).filter(F.col("r") <= k).drop("r")


def choose_threshold(labelled: DataFrame) -> DataFrame:
    """(measure, bound, merged): for each measure the lowest value strictly above every pair not labelled 'same', and of both the one that merges most.

    labelled: c3, c5, label. c5 wins ties. A measure on which a different pair is as high as any same pair has no bound and merges none.
    """
    long = labelled.select("label", F.explode(F.array(F.struct(F.lit("c3").alias("measure"), F.col("c3").alias("x")), F.struct(F.lit("c5").alias("measure"), F.col("c5").alias("x")))).alias("m")).select("label", "m.*")
    worst = long.groupBy("measure").agg(F.max(F.when(F.col("label") != "same", F.col("x"))).alias("worst"))
    above = long.join(F.broadcast(worst), "measure").filter(F.col("worst").isNull() | (F.col("x") > F.col("worst")))  # two rows
    found = above.groupBy("measure").agg(F.min("x").alias("bound"), F.count("*").alias("merged"))
    return found.orderBy(F.desc("merged"), F.desc("measure")).limit(1)


def apply_merges(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """(loser, winner, outcome) of each pair: 'recorded' (already marked so), 'stale' (either is marked a duplicate), 'target' (the loser is a winner of another pair or mark) or 'merged'.

    marks: loser, winner, as they stand. Pairs form disjoint stars, as scored_pairs makes them, so their order doesn't matter.
    """
    old = marks.select("loser", F.col("winner").alias("old"))
    d = pairs.select("loser", "winner").distinct().join(old, "loser", "left")
    d = d.join(marks.select(F.col("loser").alias("winner"), F.lit(True).alias("winner_gone")).distinct(), "winner", "left")
    targets = pairs.select("winner").unionByName(marks.select("winner")).distinct().select(F.col("winner").alias("loser"), F.lit(True).alias("target"))
    d = d.join(targets, "loser", "left")
    outcome = F.when(F.col("old") == F.col("winner"), "recorded").when(F.col("old").isNotNull() | F.coalesce("winner_gone", F.lit(False)), "stale").when(F.coalesce("target", F.lit(False)), "target").otherwise("merged")
    return d.select("loser", "winner", outcome.alias("outcome"))


def undo_merges(marks: DataFrame, method: str) -> DataFrame:
    """marks without those that one method made."""
    return marks.filter(~F.col("method").eqNullSafe(F.lit(method)))


def redirect(rows: DataFrame, marks: DataFrame, column: str = "case_id") -> DataFrame:
    """rows with ids of losers replaced by their winners; merged_from keeps the old id, or is null."""
    m = marks.select(F.col("loser").alias(column), "winner")
    d = rows.join(m, column, "left").withColumn("merged_from", F.when(F.col("winner").isNotNull(), F.col(column)))
    return d.withColumn(column, F.coalesce("winner", column)).drop("winner")


def ledger_winner(members: DataFrame, ledger: DataFrame) -> DataFrame:
    """(group columns of members: `group`) winner by what the ledger holds: relevant before any record before none, then reviewed, more verified quotes, official, lowest id."""
    d = members.join(ledger, "case_id", "left")
    standing = F.when(F.col("relevant"), 0).when(F.col("relevant").isNotNull(), 1).otherwise(2)
    key = F.struct(standing, ~F.coalesce("reviewed", F.lit(False)), -F.coalesce("quotes", F.lit(0)), ~F.col("official"), "case_id")
    return d.groupBy("group").agg(F.min_by("case_id", key).alias("winner"))


def reconcile(members: DataFrame, ledger: DataFrame, values: DataFrame) -> DataFrame:
    """winner, case_id (null for a group), action ('patch' or 'for-user') and reason: what the ledger must do about merged groups.

    members: case_id, winner (winners as members too). ledger: case_id, relevant, duplicate_of. values: case_id, field, value, human (a person set it). Groups with two records or more count.
    Disagreeing readings are for the user ('relevant'), and end the group unless the winner reads relevant. With two relevant records or more, a winner that isn't one of them is for the user
    ('winner-not-counted'), and so is, unless readings disagree, a copy whose person-set value isn't the winner's ('human-value'). Otherwise every other relevant copy without such a value becomes the winner's duplicate.
    """
    d = members.select("case_id", "winner").join(ledger.select("case_id", "relevant", "duplicate_of"), "case_id")
    own = values.filter("human").select("case_id", "field", "value").join(members.select("case_id", "winner"), "case_id").filter("case_id <> winner")
    theirs = values.select(F.col("case_id").alias("winner"), "field", F.col("value").alias("winner_value"))
    differs = own.join(theirs, ["winner", "field"], "left").filter(~F.col("value").eqNullSafe(F.col("winner_value"))).select("case_id", F.lit(True).alias("differs")).distinct()
    d = d.join(differs, "case_id", "left").withColumn("differs", F.coalesce("differs", F.lit(False)))
    is_winner, other = F.col("case_id") == F.col("winner"), (F.col("case_id") != F.col("winner")) & F.col("relevant")
    g = d.groupBy("winner").agg(
        F.count("*").alias("n"), F.coalesce(F.bool_or("relevant"), F.lit(False)).alias("yes"), F.coalesce(F.bool_or(~F.col("relevant")), F.lit(False)).alias("no"), F.coalesce(F.bool_or(is_winner & F.col("relevant")), F.lit(False)).alias("counted"),
        F.count_if("relevant").alias("n_counted"), F.coalesce(F.bool_or(other & F.col("differs")), F.lit(False)).alias("differing"),
    ).filter("n >= 2")
    g = g.withColumn("disagree", F.col("yes") & F.col("no"))
    goes_on = (~F.col("disagree") | F.col("counted")) & (F.col("n_counted") >= 2)
    g = g.withColumn("patched", goes_on & F.col("counted") & (F.col("disagree") | ~F.col("differing")))
    reason = F.when(F.col("disagree"), "relevant").when(goes_on & ~F.col("counted"), "winner-not-counted").when(goes_on & F.col("differing"), "human-value")
    asked = g.withColumn("reason", reason).filter("reason is not null").select("winner", F.lit(None).cast("long").alias("case_id"), F.lit("for-user").alias("action"), "reason")
    copies = d.filter(other & ~F.col("differs") & ~F.col("duplicate_of").eqNullSafe(F.col("winner"))).join(g.filter("patched").select("winner"), "winner", "left_semi")
    return asked.unionByName(copies.select("winner", "case_id", F.lit("patch").alias("action"), F.lit(None).cast("string").alias("reason")))


def calibration_crosstab(labelled: DataFrame, vocabulary: list[str]) -> DataFrame:
    """band (tenth of c5) and the count of each label; labels outside the vocabulary or missing fail the job."""
    bad = F.raise_error(F.concat(F.lit("label outside the vocabulary: "), F.coalesce("label", F.lit("null"))))
    d = labelled.withColumn("label", F.when(F.col("label").isin(vocabulary), F.col("label")).otherwise(bad.cast("string")))
    d = d.withColumn("band", F.floor(F.col("c5") * 10 + 1e-9).cast("int"))
    return d.groupBy("band").agg(*(F.count_if(F.col("label") == v).alias(v) for v in vocabulary))


