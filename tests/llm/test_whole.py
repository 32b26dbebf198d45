"""Cases in which an operator once did less than the whole job."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import neardup, quality, tokenstore


def shingle_set(text, width):
    words = text.split()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def components(texts, width, percent):
    sets, parent = [shingle_set(x, width) for x in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    linked = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    for i, j in linked:
        i, j = find(i), find(j)
        parent[max(i, j)] = min(i, j)
    return linked, {i: find(i) for i in range(len(texts))}


def test_a_crowd_just_below_the_limit_hides_no_link(spark):
    """All members resemble each other by 0.8 to 0.85; only twins reach 0.85."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(1200)]
    texts = []
    for i in range(60):
        places = rng.sample(range(8, 1190, 4), 32)
        for name, own in (("x", places[8:20]), ("y", places[20:])):
            words = list(base)
            for k in places[:8]:
                words[k] = f"c{i}_{k}"
            for k in own:
                words[k] = f"{name}{i}_{k}"
            texts.append(" ".join(words))
    linked, want = components(texts, 3, 85)
    assert {(i + 1, i) for i in range(0, 120, 2)} <= set(linked) and len(set(want.values())) > 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 3, 85).collect()}
    assert got == want


def test_trees_reach_their_recall_at_every_depth():
    for percent in (60, 70, 80, 85, 90):
        for k, children in neardup.steps(percent):
            assert children * (percent / 100) ** k >= 1
        roots = neardup.needed_trees(percent) * neardup.ROOTS_PER_TREE
        assert roots >= 16
        assert all(1 - (1 - neardup.meeting_chance(percent, depth)) ** roots >= neardup.RECALL for depth in range(neardup.DEEPEST + 1))


def test_recall_in_a_deep_family(spark):
    """Documents that share most of a template: pairs just above the limit in nodes that only branching divides."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(800)]
    texts = []
    for i in range(200):
        places = rng.sample(range(6, 790, 3), 26)
        for name, own in (("x", places[10:18]), ("y", places[18:])):
            words = list(base)
            for k in places[:10] + own:
                words[k] = f"{name if k in own else 'c'}{i}_{k}"
            for k in range(790, 790 + 9):  # and no common end
                words[k] = f"{name}{i}_{k}"
            texts.append(" ".join(words))
    linked, want = components(texts, 5, 80)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 5, 80).collect()}
    assert all(got[i] >= want[i] for i in got)  # nothing is linked that isn't
    met = sum(got[i] == got[j] for i, j in linked)
    assert len(linked) >= 60 and met >= neardup.RECALL * len(linked) - 1, (met, len(linked))


def test_stages_keep_documents_without_id(spark, small):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(None, f"text number {i} of a source that lacks ids", "en", "a", 9) for i in range(6)] + [(i, f"named text {i} is here", "en", "b", 9) for i in range(6)]
    docs = spark.createDataFrame([*rows, (7, "named text 1 is here", "en", "b", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, small)
    assert out.columns == docs.columns
    assert sorted(r.text for r in out.collect()) == sorted(r[1] for r in rows)
    mixed = corpus_pipeline.mix(spark, docs.filter("doc_id is null"), small)
    assert mixed.columns == docs.columns
    assert {r.text for r in mixed.collect()} == {r[1] for r in rows if r[0] is None}


def test_small_strata_take_no_cutoff_from_others(spark):
    plain = " ".join(f"word{k}" for k in range(30))
    docs = [(i, plain, "en") for i in range(1200)] + [(i, plain, "de") for i in range(1200, 2200)]
    docs += [(i, plain.upper(), "xx") for i in range(3000, 3040)]  # good, but unlike the others
    docs += [(i, plain.upper(), lang) for i, lang in enumerate(("en", "de", "zz", None), 4000)]
    labels = spark.createDataFrame([(i, 1) for i in [*range(2200), *range(3000, 3040)]], "doc_id long, quality int")
    rows = quality.quality_verdicts(spark.createDataFrame(docs, "doc_id long, text string, lang string"), labels).collect()
    dropped = {r.doc_id for r in rows if not r.kept}
    assert len(rows) == len(docs) and dropped == {4000, 4001}


def test_a_pool_of_small_strata_has_no_cutoff(spark):
    plain = " ".join(f"word{k}" for k in range(30))
    docs = [(100 * g + i, plain, f"l{g}") for g in range(12) for i in range(100)] + [(9000, plain.upper(), "l0"), (9001, plain.upper(), "zz")]
    labels = spark.createDataFrame([(i, 1) for i in range(1200)], "doc_id long, quality int")
    rows = quality.quality_verdicts(spark.createDataFrame(docs, "doc_id long, text string, lang string"), labels).collect()
    assert len(rows) == len(docs) and all(r.kept for r in rows)


def test_a_changed_recipe_is_refused(spark, tmp_path):
    import public_tokenizers

    texts = [(i, " ".join(f"word{k}" for k in range(i + 1))) for i in range(8)]
    docs = spark.createDataFrame([*texts, texts[3]], "doc_id long, text string")
    whole = str(tmp_path / "whole")
    tokenstore.write_store(docs, whole, public_tokenizers.path("word_bpe_49k.json"), 1)
    assert tokenstore.read_store(spark, whole).count() == 9
    recipes = spark.read.parquet(f"{whole}/recipes")
    moved = F.when(F.col("doc_id") == 5, F.col("start") + 1).otherwise(F.col("start"))
    changes = {
        "missing": recipes.filter("doc_id <> 2"),
        "repeated": recipes.unionByName(recipes.filter("doc_id = 2")),
        "moved": recipes.withColumn("start", moved),
    }
    for name, changed in changes.items():
        folder = str(tmp_path / name)
        changed.write.parquet(f"{folder}/recipes")
        for part in ("chunks", "manifest"):
            spark.read.parquet(f"{whole}/{part}").write.parquet(f"{folder}/{part}")
        with pytest.raises(ValueError):
            tokenstore.read_store(spark, folder).collect()


def test_roots_that_pairs_share():
    for percent, roots in ((80, 18), (85, 18), (50, 28)):
        least, s = neardup.least_shared(percent, roots), percent / 100
        missed = [sum(math.comb(roots, k) * s**k * (1 - s) ** (roots - k) for k in range(below)) for below in (least, least + 1)]
        assert missed[0] <= neardup.ALONE < missed[1]


def test_common_passage_and_copies_at_the_roots(spark):
    """Of a passage in all texts, no root node is left; near copies alone have one."""
    passage = [f"p{k}" for k in range(30)]
    texts = [" ".join(passage + [f"o{i}_{k}" for k in range(90)]) for i in range(60)]
    texts += [f"{t} end{i}" for i, t in enumerate(texts[:10])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    roots = neardup.needed_trees(85) * neardup.ROOTS_PER_TREE
    reps = neardup.sketches(docs, 3, neardup.needed_trees(85)).withColumnRenamed("doc_id", "rep")
    rows = neardup._roots(reps, 85, roots, 16).collect()
    of = {}
    for r in rows:
        of.setdefault(r.node, set()).add(r.rep)
    assert {(i, 60 + i) for i in range(10)} <= {tuple(sorted(x)) for x in of.values()}
    few = [tuple(sorted(x)) for x in of.values() if len(x) <= 16]
    assert len(few) == len(set(few)) and {r.rep for r in rows} <= {*range(10), *range(60, 70)}


def test_families_are_not_branched_and_pairs_nominated_once(spark, monkeypatch):
    """A template with many changes in each text: below the limit, in all roots. Before, every text made children in every root."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(600)]
    texts = []
    for i in range(150):
        words = list(base)
        for k in rng.sample(range(3, 597), 14):
            words[k] = f"x{i}_{k}"
        texts.append(" ".join(words))
    linked, want = components(texts, 3, 85)
    made, branch = [], neardup._branch
    monkeypatch.setattr(neardup, "_branch", lambda *a: made.append((out := branch(*a)).count()) or out)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 3, 85).collect()}
    assert got == want and sum(made) <= len(texts)
    sig = np.zeros((4, neardup.COORDINATES), np.uint8)
    column = lambda *x: np.array(x)
    full = np.array([[3, 5, neardup.NONE], [3, 5, 8], [3, 5, neardup.NONE], [5, 8, neardup.NONE]])
    rows = neardup._Rows([column(5, 5, 3, 5), column(0, 0, 0, 0), column(0, 0, 0, 0), column(1, 2, 3, 4), column(1, 2, 1, 4), column(9, 9, 9, 9), column(1, 2, 1, 4), column(0, 0, 0, 0), sig, full], 85, 92)
    assert rows.here(column(0, 0, 1), column(1, 3, 3)).tolist() == [False, True, True]


def test_outsiders_ask_for_a_crowd_by_name(spark, monkeypatch):
    """150 texts close to each other and 20 that are linked with few of them. Before, all of them came with their signatures to every root node, twice."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(600)]

    def changed(words, k, name):
        words = list(words)
        for place in rng.sample(range(3, 597), k):
            words[place] = f"{name}_{place}"
        return words

    crowd = [changed(base, 3, f"x{i}") for i in range(150)]
    texts = [" ".join(x) for x in crowd + [changed(crowd[i], 12, f"y{i}") for i in range(20)]]
    linked, want = components(texts, 3, 85)
    assert sum(i >= 150 for i, _ in linked) < 150 and len(set(want.values())) == 1
    dealt, nominated = [], neardup._nominated
    monkeypatch.setattr(neardup, "_nominated", lambda rows, *a: dealt.append(rows.count()) or nominated(rows, *a))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 3, 85).collect()}
    roots = neardup.needed_trees(85) * neardup.ROOTS_PER_TREE
    assert got == want and len(dealt) > 1 and sum(dealt) < roots * len(texts) / 2, (dealt, roots)
