import random
import time

from foliospark.operators import duplicates as D


def test_citation_marks(spark):
    c = spark.createDataFrame([(1, "k"), (2, "k"), (3, "k"), (3, "j"), (4, "j"), (5, "z")], "case_id long, cite_norm string")
    official = spark.createDataFrame([(2,)], "case_id long")
    got = {r.loser: r.winner for r in D.citation_duplicates(c, official).collect()}
    assert got == {1: 2, 3: 1, 4: 3}


def test_merge_then_undo(spark):
    marks = spark.createDataFrame([(2, 1, "m"), (4, 3, "n")], "loser long, winner long, method string")
    assert [tuple(r) for r in D.undo_merges(marks, "m").collect()] == [(4, 3, "n")]
    rows = spark.createDataFrame([(1,), (2,)], "case_id long")
    got = sorted(((r.case_id, r.merged_from) for r in D.redirect(rows, marks).collect()), key=str)
    assert got == [(1, 2), (1, None)]


def records_shuffled(spark):
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_pairs_of_a_large_group_move_texts_not_shingles(spark):
    rng = random.Random(2)
    n, words = 2 * D.PIECE + 88, ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(40)]
    base = [rng.choice(words) for _ in range(120)]
    texts = [" ".join(rng.choice(words) if rng.random() < i / n else w for w in base) for i in range(n)] + ["", "two words", None]
    rows = [(i, "case of a name", "en", None, "all", f"rep{i % 3}", i % 5 == 3, ("1900", "1900-01", None)[i % 3], t) for i, t in enumerate(texts)]
    rows += [(1000, "one reporter", "en", None, "all", "rep1", True, None, "x"), (1001, "one reporter", "en", None, "all", "rep1", True, None, "x")]
    c = spark.createDataFrame(rows, "case_id long, name string, court string, year int, jurisdiction string, reporter string, official boolean, decision_date string, norm_text string")
    before = records_shuffled(spark)
    got = {r.loser: r for r in D.scored_pairs(D.candidate_groups(c)).collect()}
    assert records_shuffled(spark) - before < 10 * len(rows)
    kinds = lambda t, k: {tuple((t or "").split()[i : i + k]) for i in range(len((t or "").split()) - k + 1)}
    assert sorted(got) == [i for i in range(len(texts)) if i != 3] and {r.winner for r in got.values()} == {3}
    for i, r in got.items():
        for k, x in ((3, r.c3), (5, r.c5)):
            a, b = kinds(texts[i], k), kinds(texts[3], k)
            assert abs(x - (len(a & b) / min(len(a), len(b)) if a and b else 0)) <= 0.5e-4 + 1e-9
        assert r.date_ok == (i % 3 < 2)


def shuffle_bytes(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [blocks.apply(i) for i in range(blocks.size())]
    return sum(f.length() for f in files if f.getName().startswith("shuffle_"))


def test_texts_that_were_moved_leave_the_disk_once_pairs_are_written(spark):
    words = [f"{random.Random(i).getrandbits(64):x}" for i in range(4000)]
    rows = [(i, "case of a name", "en", None, "all", f"rep{i % 3}", i == 0, None, " ".join(words[i * 10 : i * 10 + 300])) for i in range(300)]
    c = spark.createDataFrame(rows, "case_id long, name string, court string, year int, jurisdiction string, reporter string, official boolean, decision_date string, norm_text string")
    before, end = shuffle_bytes(spark), time.time() + 20
    pairs = D.scored_pairs(D.candidate_groups(c))
    while shuffle_bytes(spark) - before > 20_000 and time.time() < end:
        time.sleep(0.5)
    assert shuffle_bytes(spark) - before <= 20_000 and pairs.count() == 299
