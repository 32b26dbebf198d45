"""Chunks replaced by case, integer scores, maps merged in any order, lineages, the snapshot's assertions, batch files."""

import itertools
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.operators import composed as C
from foliospark.operators import vectors as V
from foliospark.sources import chunks, records, versions


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_chunks_are_replaced_whole_and_a_dead_writer_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "c")
    make = lambda rows: spark.createDataFrame(rows, "case_id long, seq int, run string")
    with pytest.raises(ValueError):
        chunks.current_rows(spark, root)
    chunks.replace_cases(make([(1, 0, "a"), (1, 1, "a"), (2, 0, "a"), (3, 0, "a")]), root)
    chunks.replace_cases(make([(1, 0, "b"), (4, 0, "b")]), root, make([(1, 0, ""), (3, 0, ""), (4, 0, "")]))
    want = [(1, 0, "b"), (2, 0, "a"), (4, 0, "b")]
    assert rows_of(chunks.current_rows(spark, root)) == want
    # a writer that dies in the middle of its rows, and one that dies between its rows and the commit
    broken = make([(2, 0, "c")]).withColumn("run", F.raise_error(F.lit("killed")).cast("string"))
    with pytest.raises(Exception, match="killed"):
        chunks.replace_cases(broken, root)
    part = f"{root}/part-{versions.next_number(spark, root):08d}"
    make([(2, 0, "d")]).write.mode("overwrite").parquet(f"{part}/rows")
    make([(2, 0, "d")]).select("case_id").write.mode("overwrite").parquet(f"{part}/cases")
    (tmp_path / "c" / "commits" / "version=3" / "_temporary").mkdir(parents=True)
    assert rows_of(chunks.current_rows(spark, root)) == want
    chunks.replace_cases(make([(2, 5, "e")]), root)
    want = [(1, 0, "b"), (2, 5, "e"), (4, 0, "b")]
    assert rows_of(chunks.current_rows(spark, root)) == want
    chunks.merge_parts(spark, root)
    assert rows_of(chunks.current_rows(spark, root)) == want and len(versions.live_parts(spark, root)[1]) == 1


def test_codes_score_as_numpy_does(spark):
    rng = np.random.default_rng(3)
    codes, scales = rng.integers(-128, 128, (300, 24)), rng.random(300)
    rows = [(i, [int(x) for x in c], float(s)) for i, (c, s) in enumerate(zip(codes, scales))] + [(1000, None, 1.0), (1001, [1, 2], 1.0), (1002, [0] * 24, None)]
    d = spark.createDataFrame(rows, "id long, q array<int>, scale double").repartition(3).select("id", V.packed_codes(F.col("q")).alias("code"), "scale")
    queries = {"a": rng.standard_normal(24).tolist(), "b": [0.0] * 24}
    got = {r.id: r for r in V.scored_codes(d, queries).collect()}
    exact = {r.id: r for r in V.scored_codes(d, queries, whole=True).collect()}
    q = np.array(queries["a"])
    step = np.abs(q).max() / 127
    for i in range(300):
        assert abs(got[i].sim_a - codes[i] @ q * scales[i]) < 1e-9 and got[i].sim_b == 0 == exact[i].sim_b
        assert abs(exact[i].sim_a - int(codes[i] @ np.rint(q / step).astype(int)) * scales[i] * step) < 1e-9
    assert got[1000].sim_a is None and got[1001].sim_a is None and got[1002].sim_a is None and len(got) == 303
    assert V.scored_codes(d.limit(0), queries).count() == 0


def a_map(spark, run, at, units, walks, bought):
    u = [(run, at, c, k, s, 1, n, 1, 0, False, True, lost, answered) for c, k, s, n, lost, answered in units]
    return C.map_state(
        spark.createDataFrame(u, "run string, at int, cell string, unit_id string, status string, records int, cases_read int, relevant_accepted int, irrelevant_accepted int, retried boolean, sampled boolean, cases_lost array<long>, cases_answered array<long>"),
        spark.createDataFrame([(run, at, *w) for w in walks], "run string, at int, cell string, position int, batches int, stop string"),
        spark.createDataFrame([(run, at, *bought)], "run string, at int, calls int, tokens int, cost double"),
    )


def test_maps_merge_alike_in_every_order(spark):
    maps = [
        a_map(spark, "r1", 1, [("A", "u1", "ok", 5, [1, 2], []), ("A", "u2", "failed", 3, [3], []), ("B", "u3", "ok", 7, [], [])], [("A", 0, 4, "budget"), ("B", 1, 2, None)], (1, 10, 0.5)),
        a_map(spark, "r2", 2, [("A", "u1", "ok", 6, [], [2]), ("C", "u9", "ok", 1, [], [])], [("A", 1, 4, "yield"), ("C", 0, 1, None)], (2, 20, 0.25)),
        a_map(spark, "r3", 3, [("A", "u1b", "ok", 2, [], [3]), ("B", "u3", "failed", 0, [8], [])], [("A", 0, 1, "dry"), ("B", 2, 9, "end")], (4, 40, 0.125)),
    ]
    seen = []
    for order in itertools.permutations(range(3)):
        a, b, c = (maps[i] for i in order)
        for state in (C.merge_maps(C.merge_maps(a, b), c), C.merge_maps(a, C.merge_maps(b, c), a)):
            seen.append((rows_of(C.map_cells(state)), rows_of(C.map_totals(state))))
    assert all(s == seen[0] for s in seen)
    cells = {r.cell: r.asDict() for r in C.map_cells(C.merge_maps(*maps)).collect()}
    assert (cells["A"]["stop"], cells["A"]["batches"], cells["A"]["place"], cells["A"]["cases_read"], cells["A"]["cases_lost"], cells["A"]["failures"]) == ("yield", 4, 1, 11, 0, 1)
    assert (cells["B"]["stop"], cells["B"]["cases_lost"], cells["B"]["place"], cells["C"]["place"]) == ("end", 1, 2, 3)
    assert seen[0][1][0][:3] == (7, 70, 0.875)


def snapshot(spark, records_, lineage_, as_of=9, axes=None):
    make = spark.createDataFrame
    r = make(records_, "seq long, case_id long, relevant boolean, polarity string, who string, era string, region string, tier string, duration string, reviewed boolean")
    lib = make([(1, "x", 1900, True, True), (2, "y", 1950, False, True)], "case_id long, jurisdiction string, year int, in_scope boolean, flagged boolean")
    lin = make(lineage_, "case_id long, lost_at string")
    out = C.snapshot_figures(r, lib, lin, make([(5, 7)], "unread int, estimate int"), make([(1, 9)], "case_id long, drawn_seq long"), as_of, axes or {"region": ["n"], "era": ["e"], "tier": ["t"], "duration": ["d"]})
    return {(x.section, x.name): (x.human, x.machine) for x in out.collect()}


def test_snapshot_and_its_assertions(spark):
    good = [(8, 1, True, "favorable", "householder", "e", "n", "t", "d", True), (9, 2, True, "adverse", None, "e", "n", "t", "d", None), (3, 3, False, "favorable", None, "zz", "n", "t", "d", True), (4, 4, None, None, None, None, None, None, None, None)]
    got = snapshot(spark, good, [(1, None), (2, "unread"), (None, "unresolved")])
    assert got[("ledger", "read")] == (4, None) and got[("ledger", "relevant")] == (1, 1) and got[("grid", "e|n|t|d")] == (1, 0) and got[("gold", "lost unread")] == (1, None) and got[("library", "first_year")] == (1900, None)
    with pytest.raises(Exception, match="head is 9, not 10"):
        snapshot(spark, good, [(1, None)], as_of=10)
    with pytest.raises(Exception, match="outside the grid"):
        snapshot(spark, [*good, (5, 5, True, "favorable", None, "other", "n", "t", "d", True)], [(1, None)])
    with pytest.raises(Exception, match="the ledger 2"):
        snapshot(spark, [*good, (5, 5, True, "favorable", None, "e", "unlisted", "t", "d", True)], [(1, None)])
    with pytest.raises(Exception, match="losses are"):
        snapshot(spark, good, [(1, None), (2, "somewhere")])


def test_snapshot_scans_each_input_once(spark, tmp_path):
    make = spark.createDataFrame
    make([(9, 1, True, "favorable", "x", "e", "n", "t", "d", True)], "seq long, case_id long, relevant boolean, polarity string, who string, era string, region string, tier string, duration string, reviewed boolean").write.parquet(str(tmp_path / "r"))
    r = spark.read.parquet(str(tmp_path / "r"))
    lib = make([(1, "x", 1900, True, True)], "case_id long, jurisdiction string, year int, in_scope boolean, flagged boolean")
    out = C.snapshot_figures(r, lib, make([(1, None)], "case_id long, lost_at string"), make([(5, 7)], "unread int, estimate int"), make([(1, 9)], "case_id long, drawn_seq long"), 9, {"region": ["n"], "era": ["e"], "tier": ["t"], "duration": ["d"]})
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert str(tmp_path) not in final and final.count("snapshot-groups") == 2


def test_broken_batch_files_stop_nothing(spark, tmp_path):
    body = {"batch_id": "b1", "era_partition": "e", "jurisdiction": "j", "cases": [{"case_id": 1, "signals": []}]}
    (tmp_path / "sub").mkdir()
    for name, text in {"batch-1.json": json.dumps(body), "sub/batch-2-retry.json": json.dumps(body | {"batch_id": "b2"}), "sub/batch-3.json": json.dumps(body)[:30], "batch-4.json": "[]", "batch-5.json": '{"batch_id": "x"}', "notes.json": "{", "batch-6.txt": "{"}.items():
        (tmp_path / name).write_text(text)
    good, broken = records.batch_files(spark, str(tmp_path))
    assert sorted((r.file, r.kind, r.batch_id) for r in good.collect()) == [("batch-1.json", "pool", "b1"), ("batch-2-retry.json", "retry", "b2")]
    assert {r.file for r in broken.collect()} >= {"batch-3.json", "batch-5.json"}
