"""The positional index, queries over it, accents, and places in the raw text."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from foliospark.functions.fold import accents, folded, folded_word
from foliospark.functions.stem import porter
from foliospark.functions.text import normalise
from foliospark.operators import positions as P
from foliospark.operators import postings as I
from foliospark.plans.base import cases as case_table
from foliospark.plans.base import index
from foliospark.sources import versions

WORDS = "let lets letting lodger lodgers café cafe naïve the of a single family house rooming".split()


def texts(seed, n):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 25)))) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "case_id long, norm_text string")


def plain(text):
    return [w for w in re.findall(r"[^\W_]+", "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c)))]


def places(words, phrase):
    """Beginnings of a phrase in a list of words, by trying every place."""
    ws = phrase.words
    same = lambda w, v, i: porter(w) == porter(v) if phrase.stem else v.startswith(w) if phrase.open and i == len(ws) - 1 else v == w
    return [k for k in range(len(words) - len(ws) + 1) if all(same(w, words[k + i], i) for i, w in enumerate(ws))] if ws else []


def holds(q, words):
    if isinstance(q, P.Phrase):
        return bool(places(words, q))
    if isinstance(q, P.Near):
        spans = [[(k, k + len(p.words) - 1) for k in places(words, p)] for p in (q.a, q.b)]
        return any(0 <= max(c - b, a - d) - 1 <= q.distance for a, b in spans[0] for c, d in spans[1])
    if isinstance(q, P.Without):
        return holds(q.a, words) and not holds(q.b, words)
    return (all if isinstance(q, P.All) else any)(holds(p, words) for p in q.parts)


def test_every_kind_of_query_against_brute_force(spark, tmp_path):
    rows, root = texts(1, 400), str(tmp_path / "i")
    I.add_cases(frame(spark, [*rows, (999, None)]), root, 5)
    ph = P.Phrase
    queries = [
        ph("lodger"), ph("Café"), ph("single family house"), ph("let*"), ph("single fam*"), ph("let", stem=True), ph("lodger house", stem=True), ph("absent"), ph(""), ph("—"),
        P.Near(ph("single family"), ph("lodg*"), 3), P.Near(ph("the"), ph("the"), 2), P.Near(ph("the of"), ph("of the"), 0), P.Near(ph("a a"), ph("a"), 4), P.Near(ph("let", stem=True), ph("naive"), 1),
        P.Any((P.Near(ph("rooming"), ph("house"), 1), P.Near(ph("cafe"), ph("let*"), 0))), P.All((ph("the"), ph("of"), P.Any((ph("a"), ph("house"))))), P.Without(ph("the"), P.Near(ph("of"), ph("a"), 5)), P.All(()), P.Any(()),
    ]
    words = {i: plain(t) for i, t in rows}
    for q in queries:
        got = sorted(r.case_id for r in P.matching_ids(spark, root, q).collect())
        want = sorted(i for i, ws in words.items() if holds(q, ws)) if P._phrases(q) else []
        assert got == want, q
    labelled = {str(k): q for k, q in enumerate(queries) if P._phrases(q)}
    got = {}
    for r in P.matching_labels(spark, root, labelled).collect():
        got.setdefault(r.label, []).append(r.case_id)
    assert {k: sorted(v) for k, v in got.items()} == {k: w for k, q in labelled.items() if (w := sorted(i for i, ws in words.items() if holds(q, ws)))}
    spans = sorted(map(tuple, P.phrase_spans(spark, root, ph("single fam*")).collect()))
    assert spans == sorted((i, k, k + 1) for i, ws in words.items() for k in places(ws, ph("single fam*")))


def rows_of(spark, root):
    return sorted(map(tuple, I.all_postings(spark, root).collect()))


def test_increments_deletions_and_merges_equal_a_rebuild(spark, tmp_path):
    rows = texts(2, 120)
    root, whole = str(tmp_path / "i"), str(tmp_path / "w")
    I.add_cases(frame(spark, rows[:50]), root, 4)
    I.add_cases(frame(spark, rows[:80]), root, 3)  # 50 of them are there already
    I.add_cases(frame(spark, rows[80:]), root, 2)
    I.add_cases(frame(spark, rows), whole, 4)
    assert rows_of(spark, root) == rows_of(spark, whole)
    I.delete_cases(frame(spark, rows[40:60]).select("case_id"), root)
    changed = [(i, t + " again") for i, t in rows[40:45]]
    I.add_cases(frame(spark, changed), root, 2)
    left = rows[:40] + rows[60:] + changed
    again = str(tmp_path / "a")
    I.add_cases(frame(spark, left), again, 4)
    want, q = rows_of(spark, again), P.Near(P.Phrase("the"), P.Phrase("again"), 30)
    found = lambda r: sorted(x.case_id for x in P.matching_ids(spark, r, q).collect())
    assert rows_of(spark, root) == want and found(root) == found(again)
    I.merge_segments(spark, root, 3)
    assert rows_of(spark, root) == want and found(root) == found(again) and len(versions.live_parts(spark, root)[1]) == 1
    assert sorted(r.case_id for r in I.indexed_cases(spark, root).collect()) == sorted(i for i, _ in left)


def test_a_writer_that_dies_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "i")
    assert rows_of(spark, root) == [] and P.matching_ids(spark, root, P.Phrase("x")).count() == 0
    I.add_cases(frame(spark, texts(3, 20)), root, 2)
    before = rows_of(spark, root)
    broken = frame(spark, texts(4, 20)).select(F.col("case_id") + 100, F.when(F.col("case_id") < 15, F.col("norm_text")).otherwise(F.raise_error(F.lit("disk full"))).alias("norm_text")).toDF("case_id", "norm_text")
    with pytest.raises(Exception, match="disk full"):
        I.add_cases(broken, root, 2)
    assert rows_of(spark, root) == before
    I.add_cases(frame(spark, [(i + 100, t) for i, t in texts(4, 20)]), root, 2)
    assert len(rows_of(spark, root)) > len(before)


def test_queries_read_only_ranges_that_can_hold_their_words(spark, tmp_path):
    root = str(tmp_path / "i")
    I.add_cases(frame(spark, [(i, f"word{i:04d} other{i:04d} zebra") for i in range(500)]), root, 8)
    rows = I.term_postings(spark, root, [("word0100", False)])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan) and "EqualTo(token,word0100)" in plan
    assert len({f.rpartition("bucket=")[2][:2] for f in rows.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}) == 1 and rows.count() == 1
    assert sorted(r.case_id for r in P.matching_ids(spark, root, P.Phrase("word01*")).collect()) == list(range(100, 200))
    query = P.matching_ids(spark, root, P.Any((P.Near(P.Phrase("word0003 other0003"), P.Phrase("zebra")), P.Near(P.Phrase("other0004"), P.Phrase("zebra")))))
    assert str(query._jdf.queryExecution().executedPlan()).count("Exchange ") == 1
    assert sorted(r.case_id for r in query.collect()) == [3, 4]


def test_accents(spark):
    olds, news, _ = accents()
    assert len(olds) == len(news) > 400 and all(unicodedata.normalize("NFD", a)[0] == b for a, b in zip(olds, news))
    rows = ["café", "café noir", "naïve Ünï", "ångström", "ελλά", "łódź", ""]
    d = spark.createDataFrame([(r,) for r in rows], "t string")
    got = [r.f for r in d.select(folded(F.col("t")).alias("f")).collect()]
    assert got == ["cafe", "cafe noir", "naive Uni", "angstrom", "ελλά", "łodz", ""] == [folded_word(r) for r in rows]


def test_spans_point_into_the_raw_text(spark, tmp_path):
    raw = ["The  Caf\u00e9-\n au lait, or caf\u00e9s; a \ufb01ne Cafe\u0301 au  LAIT.", "no such", "Cafe\u0301 au lait"]
    d = spark.createDataFrame(list(enumerate(raw)), "case_id long, raw_text string").withColumn("norm_text", normalise(F.col("raw_text")))
    root = str(tmp_path / "i")
    I.add_cases(d, root, 2)
    spans = P.character_spans(d, P.phrase_spans(spark, root, P.Phrase("cafe au lait")))
    assert sorted(raw[r.case_id][r.start : r.end] for r in spans.collect()) == sorted(["Caf\u00e9-\n au lait", "Cafe\u0301 au  LAIT", "Cafe\u0301 au lait"])
    assert sorted(raw[r.case_id][r.start : r.end] for r in P.character_spans(d, P.phrase_spans(spark, root, P.Phrase("fine"))).collect()) == ["ﬁne"]


def test_stems_over_all_words_of_the_table(spark, small):
    root = index(spark, small)
    stems = {}
    for r in I.word_counts(spark, root).collect():
        stems.setdefault(porter(r.token), set()).add(r.token)
    assert all(w.startswith(stem[: max(1, len(stem) - 3)]) for stem, ws in stems.items() for w in ws)
    stem = max(stems, key=lambda x: (len(stems[x]), x))
    rows = {r.case_id: set(plain(r.norm_text or "")) for r in case_table(spark, small).select("case_id", "norm_text").collect()}
    got = sorted(r.case_id for r in P.matching_ids(spark, root, P.Phrase(sorted(stems[stem])[0], stem=True)).collect())
    assert got == sorted(i for i, ws in rows.items() if ws & stems[stem]) and len(stems[stem]) > 1
