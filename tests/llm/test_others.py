"""Conversations, vectors and the pipeline."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from foliospark.llm import ann, quotes, toxicity
from foliospark.session import table


def test_quote_threads(spark):
    a, b, thanks = "The quick brown fox jumps over the dog.", "Nobody expects the second message here.", "Thanks a lot for that answer."
    rows = [
        (1, 0, "user", a), (1, 1, "assistant", f"> {a.upper()}\n\n{b}"), (1, 2, "user", f"On Monday, X wrote:\n> > {a}\n> {b}\n{thanks}"),
        (1, 3, "user", f"> {thanks}\nwelcome"), (2, 0, "user", f"> {b}\nSee there."), (2, 1, "user", None), (3, 0, "user", ""), (3, 0, "user", ""), (None, None, None, "> x"),
    ]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", quotes.F.lit(1))
    out = {(r.conv_id, r.turn): r for r in quotes.reply_threads(d).collect()}
    assert quotes.reply_threads(d).count() == len(rows)
    assert out[1, 1].body == b and out[1, 2].body == thanks
    assert [out[1, t].reply_to for t in range(4)] == [None, 0, 1, 2] and [out[1, t].depth for t in range(4)] == [0, 1, 2, 3]
    assert {out[1, t].thread_root for t in range(4)} == {0}
    assert (out[2, 0].linked_conv, out[2, 0].linked_turn, out[2, 0].reply_to) == (1, 1, None)
    assert quotes.reply_threads(d.limit(0)).count() == 0
    assert sorted((c, out[c, t].place) for c, t in out if c == 1) == [(1, k) for k in range(1, 5)]


def test_short_passages_and_lines_are_linked(spark):
    rows = [
        (1, 0, "a", "yes, sure"), (1, 1, "b", "> yes, sure\nfine"), (1, 2, "a", "First line of it is here.\nSecond line of it.\n\nAnother part altogether."), (1, 3, "b", "> Second line of it.\nwhy?"),
        (1, 4, "b", "> Another part altogether.\n> and what nobody has said\nok"), (2, 0, "a", "> yes, sure\nno"), (2, 1, "a", "on a day in " + "x" * 200 + " somebody wrote:\n> no\nreally"),
    ]
    out = {(r.conv_id, r.turn): r for r in quotes.reply_threads(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {k: r.reply_to for k, r in out.items()} == {(1, 0): None, (1, 1): 0, (1, 2): None, (1, 3): 2, (1, 4): 2, (2, 0): None, (2, 1): 0}
    assert [(out[k].n_quotes, out[k].n_linked) for k in ((1, 1), (1, 3), (1, 4), (2, 0))] == [(1, 1), (1, 1), (1, 1), (1, 0)]
    assert out[2, 1].body == "really"
    order = sorted((r.place, r.turn) for (c, _), r in out.items() if c == 1)
    assert order == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 4)]


def test_forest_recall_and_odd_rows(spark, small):
    rows = table(spark, small, "embeddings")
    x = rows.toPandas().sort_values("vec_id")
    v, ids = np.array(x.embedding.tolist(), float), x.vec_id.to_numpy()
    got = ann.nearest(rows, rows.filter("vec_id % 20 = 0")).collect()
    hits = 0
    for q in ids[ids % 20 == 0]:
        i = int(np.searchsorted(ids, q))
        best = [j for j in np.lexsort((ids, -(v @ v[i]))) if j != i][:20]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        hits += len({ids[j] for j in best} & {r.vec_id for r in mine})
    assert hits >= 0.9 * 20 * (ids % 20 == 0).sum()
    odd = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [0.5, 2.0]), (8, [1.0]), (None, [1.0, 1.0]), (20, [])]
    d = spark.createDataFrame(odd, "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in ann.nearest(d, d.filter("vec_id % 20 = 0"), k=2).collect()))
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    assert ann.nearest(d.limit(0), d.limit(0)).count() == 0


def test_recall_over_several_shards(spark):
    """More rows than a shard holds, so that every query meets several forests whose reach is a share of their rows."""
    rng = np.random.default_rng(4)
    v = rng.standard_normal((9000, 64)).astype(np.float32)
    v[100:200] = v[0:100]  # equal scores in different shards
    d = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got: dict = {}
    for r in ann.nearest(d, d.filter("vec_id % 90 = 0"), k=20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert -(-len(v) // ann.SHARD_ROWS) == 3
    x, hits = v.astype(float), 0
    for q, rows in got.items():
        score = x @ x[q]
        best = [j for j in np.lexsort((np.arange(len(x)), -score)) if j != q][:20]
        assert [k for k, *_ in sorted(rows)] == list(range(1, 21)) and all(abs(s - score[j]) < 1e-9 for _, j, s in rows)
        hits += len(set(best) & {j for _, j, _ in rows})
    assert len(got) == 100 and hits >= 0.9 * 2000, hits


def test_identical_vectors_tie_by_id(spark):
    d = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(60)], "vec_id long, embedding array<float>")
    got = ann.nearest(d, d.filter("vec_id = 20"), k=20).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [i for i in range(21) if i != 20]


def test_pipeline(spark, small):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = table(spark, small, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == columns, name
    out = corpus_pipeline.run(spark, small)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_stages_on_odd_tables(spark, small):
    """Null ids, null and empty texts, repeated rows, an empty table: every stage gives what its docstring says."""
    cp = pytest.importorskip("corpus_pipeline")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, "a text without id", "en", None, 1), (1, None, None, "a", None), (2, "", "en", "a", 0), (3, "some words that stand here", "en", "a", 9), (3, "some words that stand here", "en", "a", 9), (4, "Some words that stand here", "en", "b", 9)]
    docs = spark.createDataFrame(rows, schema)
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(cp.drop_toxic(spark, docs, small)) == key(docs)
    assert key(cp.drop_near_duplicates(spark, docs, small)) == key(docs.filter("doc_id is null or doc_id <> 4"))
    assert sorted((r.doc_id or 0, r.text or "") for r in cp.pseudonymise(spark, docs, small).collect()) == sorted((i or 0, t or "") for i, t, *_ in rows)
    mixed = [r.doc_id for r in cp.mix(spark, docs, small).collect()]
    assert {None, 1, 2, 3, 4} >= set(mixed) and max(map(mixed.count, mixed)) <= 3
    assert cp.tokenise(spark, docs, small).count() == len(rows)
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), small).count() == 0


def test_pipeline_against_a_plain_version(spark, small):
    """The rows of run(): kept documents of each stage by brute force, each as often as the mix takes it, digests of tiktoken."""
    cp = pytest.importorskip("corpus_pipeline")
    import base64
    import hashlib

    import public_tokenizers as P
    import tiktoken

    from test_documents import brute_components

    spark.conf.set("spark.foliospark.pii.key", "test")
    try:
        out = sorted(map(tuple, cp.run(spark, small).collect()))
        docs = table(spark, small, "documents")
        kept = cp.drop_toxic(spark, docs, small).collect()
        roots = brute_components({r.doc_id: r.text for r in kept}, 5, 80)
        left = spark.createDataFrame([r for r in kept if roots[r.doc_id] == r.doc_id], docs.schema)
        texts = {r.doc_id: r.text for r in cp.pseudonymise(spark, left, small).collect()}
        times = {r.doc_id: r.repeats for r in cp.mixing.mix_sources(cp.mixing.sized_documents(cp.pseudonymise(spark, left, small))).collect()}
    finally:
        spark.conf.unset("spark.foliospark.pii.key")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, n in times.items():
        ids = enc.encode_ordinary(texts[i] or "")
        want += [(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((texts[i] or "").encode()).hexdigest())] * n
    assert out == sorted(want)


def test_stages_keep_clashing_columns_and_choose_repeated_ids_alike(spark, small):
    cp = pytest.importorskip("corpus_pipeline")
    rows = [(i, f"plain text number {i} of some words " * (1 + i % 3), "en", f"s{i % 3}", 9, 7.0, "p", 5, 6, "r") for i in range(20)]
    rows += [(3, "another text under the same id", "en", "s0", 9, 8.0, "p", 5, 6, "r"), (3, "a third one under it", None, None, None, None, None, None, None, None), (40, "long " * 200_000, "en", "s1", 9, 7.0, "p", 5, 6, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, private string, __id long, __draw long, shard string")
    out = cp.drop_toxic(spark, docs, small)
    assert out.columns == docs.columns and sorted(map(repr, out.collect())) == sorted(map(repr, docs.collect()))
    assert cp.drop_near_duplicates(spark, docs, small).columns == docs.columns
    assert {r.private for r in cp.pseudonymise(spark, docs, small).collect()} == {"p", None}
    mixes = [sorted(map(repr, cp.mix(spark, docs.repartition(n), small).collect())) for n in (1, 3, 4)]
    assert mixes[0] == mixes[1] == mixes[2] and len({m for m in mixes[0] if "doc_id=3," in m}) <= 1 and cp.mix(spark, docs, small).columns == docs.columns


def test_texts_travel_once_and_counts_in_pieces(spark, monkeypatch):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.createDataFrame([(1, "plain words", "en", "a", 11), (2, None, "en", "b", 0)], "doc_id long, text string, lang string, score string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    seen, scores = [], corpus_pipeline.toxicity.toxicity_scores
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: labels)
    monkeypatch.setattr(corpus_pipeline.toxicity, "toxicity_scores", lambda d, m: seen.append(d) or scores(d, m))
    out = corpus_pipeline.drop_toxic(spark, docs, "")
    assert seen[0].columns == ["text", "__row"] and "text" not in seen[0].schema["__row"].dataType.names
    assert out.columns == docs.columns and sorted(out.collect()) == sorted(docs.collect())
    runs = []
    monkeypatch.setattr(toxicity, "freed", lambda f: runs.append(f) or f)
    toxicity._counted(docs.selectExpr("text", "0 AS fold"), None)
    letters = np.array(list("abcdefghij"))
    words = ["".join(letters[[int(c) for c in f"{i:06d}"]]) for i in range(120_000)]
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(words[k::40]) for k in range(40)] + [words[0]]), pa.array([0] * 40 + [2], pa.int32())], ["text", "fold"])
    got = list(runs[0](iter([batch])))
    assert len(got) > 2 and max(b.num_rows for b in got) < 120_000
    total = {(r["term"], r["fold"]): 0 for b in got for r in b.to_pylist()}
    for b in got:
        for r in b.to_pylist():
            total[r["term"], r["fold"]] += r["n"]
    want = Counter((t, f) for x, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for t in toxicity.features_of(x))
    assert total == dict(want)
