"""The conversation trie against brute force and SQL, in one shard and in many."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from foliospark.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        whole[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members = {}
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    out = []
    below = {p: [0, 0] for p in members}
    parents = {p[:-1] for p in members if p}
    for p, cs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            below[p[:d]][0] += p not in parents
            below[p[:d]][1] += (len(cs) - 1) * words
    for p, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(whole[c]) == len(p))))
        kids = sum(1 for q in members if q and q[:-1] == p)
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids, *below[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def found(spark, tmp_path, rows):
    folder = str(tmp_path / "in")
    spark.createDataFrame(rows, SCHEMA).withColumn("depth", trie.F.lit(5)).withColumn("at", trie.F.lit(1)).write.parquet(f"{folder}/conversations.parquet")
    return sorted(map(tuple, trie.op12_conversation_trie(spark, folder).collect()), key=lambda r: r[:2])


def some_rows(seed, convs=150):
    rng = random.Random(seed)
    rows = []
    for c in range(-30, convs - 30):
        n = rng.choice((1, 2, 3, 5, 9))
        rows += [(c, rng.choice((None, *range(n + 2))), rng.choice(("user", "bot", None)), rng.choice(("a b", "c", "", None, "d e  f"))) for _ in range(n)]
    rows += [(1000 + i, t, "user", f"turn {t} of a common one") for i in range(60) for t in range(6)]  # copies
    rows += [(2000 + i, t, "user", f"snapshot {t}") for i in range(12) for t in range(i + 1)]  # each longer than the one before
    rows += [(2100 - i, t, "user", f"other {t}") for i in range(12) for t in range(i + 1)]
    return rows


@pytest.mark.parametrize(("seed", "nodes"), [(1, 50_000), (2, 40), (3, 7)])
def test_against_brute_force(spark, tmp_path, monkeypatch, seed, nodes):
    monkeypatch.setattr(trie, "SHARD_NODES", nodes)
    monkeypatch.setattr(trie, "ENDS", 8)
    rows = some_rows(seed)
    assert found(spark, tmp_path, rows) == brute(rows)


def test_one_very_long_conversation_over_many_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_NODES", 30)
    rows = [(40, t, "user", f"word {t}") for t in range(400)] + [(41, t, "user", f"word {t}") for t in range(350)] + [(60, t, "x", "y z") for t in range(3)] + [(61, 0, "x", "y z")]
    assert found(spark, tmp_path, rows) == brute(rows)


def test_odd_tables(spark, tmp_path):
    rows = [(None, 1, "user", "x"), (7, 1, "user", "x"), (7, 1, "user", "x"), (27, None, None, None), (33, 2, "bot", "long " * 3000), (33, 2, "ant", "z")]
    assert found(spark, tmp_path / "a", rows) == brute(rows)
    assert found(spark, tmp_path / "b", rows[:1]) == []


def test_parentheses_against_a_stack():
    rng = random.Random(3)
    for _ in range(200):
        depth = [rng.randint(0, 6)]
        for _ in range(rng.randint(0, 40)):
            depth.append(rng.randint(max(0, depth[-1] - rng.choice((0, 1, 5))), depth[-1] + 1))
        leaf = rng.random() < 0.5
        p = trie.Parentheses(np.array(depth), leaf)
        n = len(depth)
        for i in range(n):
            after = next((j for j in range(i + 1, n) if depth[j] <= depth[i]), n)
            inside = [k for k in range(i, after) if (k + 1 < n and depth[k + 1] <= depth[k]) or (k == n - 1 and leaf)]
            assert p.after()[i] == after and p.leaves()[i] == len(inside)
            assert p.closed[i] == (after < n or (i == n - 1 and leaf))


def test_min_tree():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 17, 64, 100):
        values = rng.integers(0, 20, n)
        tree = trie.MinTree(values)
        start, limit = rng.integers(0, n + 1, 300), rng.integers(-2, 21, 300)
        want = [next((j for j in range(s, n) if values[j] <= m), n) for s, m in zip(start, limit)]
        assert tree.first(start, limit).tolist() == want


def test_query_equals_sql(spark, small):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{small}/conversations.parquet'")
    rel, got = con.sql(trie.ORACLE), trie.op12_conversation_trie(spark, small)
    assert rel.columns == got.columns
    assert sorted(rel.fetchall(), key=lambda r: r[:2]) == sorted(map(tuple, got.collect()), key=lambda r: r[:2])
