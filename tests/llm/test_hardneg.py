"""Hard negatives against brute force, on odd rows too."""

import duckdb
import numpy as np

from foliospark.llm import hardneg
from foliospark.session import table


def brute(rows, positives=5, negatives=3):
    """rows: vec_id -> (label, list of whole numbers)."""
    out = []
    for a, (label, v) in rows.items():
        if a % 50:
            continue
        score = {b: sum(x * y for x, y in zip(v, w)) for b, (_, w) in rows.items() if b != a and len(w) == len(v)}
        first = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in first if rows[b][0] == label][:positives]:
            band = [b for b in first if rows[b][0] != label and 50 * score[p] <= 100 * score[b] <= 95 * score[p]]
            out += [(a, p, k, b, score[p], score[b]) for k, b in enumerate(band[:negatives], 1)]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 20)) * 60
    rows = {int(i): (int(rng.integers(0, 4)), [int(x) for x in np.floor(centres[i % 6] + rng.standard_normal(20) * 30)]) for i in rng.permutation(900)}
    for i in range(300, 420):  # many copies of one vector
        rows[i] = (rows[i][0], rows[300][1])
    d = spark.createDataFrame([(i, *r, 1.0) for i, r in rows.items()], "vec_id long, label int, v array<long>, score double")
    want = brute(rows)
    assert len(want) > 100 and found(hardneg.hard_negatives(d, "vec_id % 50 = 0")) == want


def test_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "SHARD_ROWS", 40)
    monkeypatch.setattr(hardneg, "MOST_SHARD_ROWS", 90)
    monkeypatch.setattr(hardneg, "ANCHOR_ROWS", 3)
    rng = np.random.default_rng(8)
    rows = {i: (int(i % 3), [int(x) for x in rng.integers(-300, 300, 70)]) for i in range(400)}  # 70 numbers: two words a code
    d = spark.createDataFrame([(i, *r) for i, r in rows.items()], "vec_id long, label int, v array<long>")
    assert found(hardneg.hard_negatives(d, "vec_id % 50 = 0")) == brute(rows)


def test_intervals_hold_the_product():
    rng = np.random.default_rng(1)
    for width in (1, 5, 64, 100):
        x = rng.integers(-200, 200, (50, width)).astype(float)
        y = hardneg.rotated(x)
        assert np.allclose(y @ y.T, x @ x.T)
        codes, align, left = hardneg.coded(y)
        rest = y.copy()
        for k in range(hardneg.LEVELS):
            bits = np.unpackbits(codes[:, k].view(np.uint8), axis=1, bitorder="little").astype(bool)
            rest -= np.where(bits, 1, -1) * align[:, k, None] / np.sqrt(y.shape[1])
            assert np.allclose(np.sqrt((rest**2).sum(axis=1)), left[:, k])


def test_odd_rows(spark):
    rows = [
        (0, 1, [3, 4]), (0, 1, [3, 4]), (0, 2, [9, 9]), (1, 1, [6, 8]), (2, 1, [6, 8]), (3, 2, [4, 5]), (4, 2, [4, 5]), (5, None, [6, 8]), (6, 2, None), (7, 2, []), (8, 2, [None, 1]),
        (None, 2, [4, 5]), (9, 2, [4, 5, 6]), (50, 3, [1, 1]), (100, 7, [2**62, 2**62]), (101, 7, [2**62, 2**62]), (102, 8, [2**61, 2**62]), (150, 9, [0, 0]), (151, 9, [-1, 0]),
    ]
    d = spark.createDataFrame(rows, "vec_id long, label int, v array<long>").withColumn("rank", hardneg.F.lit(1))
    got = found(hardneg.hard_negatives(d, "vec_id % 50 = 0"))
    small = [r for r in got if r[0] == 0]
    assert small == [(0, p, k, n, 50, 32) for p in (1, 2) for k, n in ((1, 3), (2, 4))]
    assert [r for r in got if r[0] == 100] == []  # clamped scores: the negative's is as high as the positive's
    assert all(r[4] == r[5] == 0 for r in got if r[0] == 150) and {r[1] for r in got if r[0] == 150} == {151}
    assert hardneg.hard_negatives(d.limit(0), "vec_id % 50 = 0").count() == 0


def test_query_equals_sql(spark, small):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{small}/embeddings.parquet'")
    rel = con.sql(hardneg.ORACLE)
    got = hardneg.op13_hard_negatives(spark, small)
    assert rel.columns == got.columns and sorted(rel.fetchall()) == found(got) and table(spark, small, "embeddings").count() > 50
