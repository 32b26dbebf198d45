"""Registered queries against their SQL on made-up tables that the smallest ones don't stand for."""

import duckdb
import pytest

from foliospark.operators import duplicates, reading
from foliospark.plans import registry


def rows_and_sql(spark, folder, name, orders):
    con = duckdb.connect()
    con.sql(f"create table orders as {orders}")
    con.sql(f"copy orders to '{folder}/orders.parquet'")
    df = registry.queries()[name](spark, str(folder))
    want = con.sql(registry.oracles()[name])
    return sorted(map(tuple, df.select(want.columns).collect())), sorted(want.fetchall())


def test_more_than_999_batches_of_a_cell(spark, tmp_path):
    orders = "select i as o_orderkey, case when i % 40 = 0 then '2-B' else '1-A' end as o_orderpriority from range(18600) t(i)"
    got, want = rows_and_sql(spark, tmp_path, "h16_rebatched", orders)
    assert got == want
    ids = reading.rebatched(spark.read.parquet(f"{tmp_path}/orders.parquet").selectExpr("o_orderpriority as cell", "o_orderkey as case_id"), "screen")
    assert ids.groupBy("batch_id").count().filter("count > 18").isEmpty()
    assert {r.batch_id for r in ids.filter("case_id in (0, 1, 18599)").collect()} == {"screen-2-B-001", "screen-1-A-001", "screen-1-A-1008"}


#: prices of which 1,000 parts end in a 5 that is less in binary: 0.284 and 0.285 are both 0.28 in SQL
PRICES = "select i as o_orderkey, 'F' as o_orderstatus, '1-A' as o_orderpriority, 2 * i + 1 as o_custkey, (289 - i)::double as o_totalprice from range(9) t(i)"


def test_scores_of_capped_cells_are_rounded_as_in_sql(spark, tmp_path):
    orders = f"select * replace (case o_orderkey when 3 then 286 when 4 then 284 when 5 then 285 else o_totalprice end::double as o_totalprice) from ({PRICES})"
    got, want = rows_and_sql(spark, tmp_path, "h2_capped_cells", orders)
    assert got == want and len(got) == 9


def test_scores_of_the_walk_are_rounded_as_in_sql(spark, tmp_path):
    orders = f"select * replace (case o_orderkey when 3 then 286 when 4 then 284 when 5 then 285 else o_totalprice end::double as o_totalprice) from ({PRICES})"
    got, want = rows_and_sql(spark, tmp_path, "h4_h6_walk_order", orders)
    assert got == want and len(got) == 9


def test_undone_marks_read_the_written_pairs_only(spark, small):
    plan = registry.queries()["b13_undo_merges"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "norm_text" not in plan


def test_guarded_pairs_read_the_written_pairs_only(spark, small):
    df = registry.queries()["b6_guarded_pairs"](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "norm_text" not in plan and df.filter("not size_ok or not long_enough").isEmpty()


def test_scored_pairs_are_the_same_however_groups_meet_their_members(spark, small, monkeypatch):
    pairs = lambda: sorted(map(tuple, registry.queries()["b3_b7_scored_pairs"](spark, small).collect()))
    want = pairs()
    monkeypatch.setattr(duplicates, "BROADCAST", 0)
    monkeypatch.setattr(duplicates, "PIECE", 2)
    monkeypatch.setattr(duplicates, "PARTITION", 5)
    assert pairs() == want and len(want) > 10


def test_duplicate_ids_move_no_text(spark, small):
    plan = registry.queries()["b15_duplicate_ids"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "norm_text" not in plan and "Generate" not in plan
