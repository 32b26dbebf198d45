import pytest

from foliospark.operators import reports as R
from foliospark.operators import selection as S
from foliospark.operators import tables as L


def test_html_text_and_pages():
    text, pages = L.html_text('<section class="casebody"><p>One<br>two<a class="page-label" data-label="2">*2</a> three</p><ul><li>four &amp; five</li></ul><a class="page-label">*7</a></section>')
    assert text == "Onetwo three\nfour & five\n"
    assert pages == [(6, "2"), (len("Onetwo three\nfour & five"), "7")]


def test_upsert_and_ignore(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    assert sorted(map(tuple, L.upsert(t, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, L.insert_ignore(t, new, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "d")]


def test_missing_lookup_is_refused(spark):
    cases = spark.createDataFrame([(1, "x")], "case_id long, norm_text string")
    wanted = spark.createDataFrame([(1, 0), (9, 1)], "case_id long, ord long")
    with pytest.raises(Exception, match="no case 9"):
        L.lookup_in_order(cases, wanted).collect()


def test_batches_partition_the_pool(spark):
    rows = [(i, "e", f"j{i % 2}", f"s{i % 3}") for i in range(100)]
    signals = spark.createDataFrame(rows, "case_id long, era string, jurisdiction string, selector_id string")
    gold = spark.createDataFrame([(5,)], "case_id long")
    out = S.packed(signals, gold, 18).collect()
    assert sorted(r.case_id for r in out) == list(range(100))
    sizes = {}
    for r in out:
        sizes[r.batch_id] = sizes.get(r.batch_id, 0) + 1
    assert sorted(sizes) == [1, 2, 3, 4, 5, 6] and max(sizes.values()) == 18
    assert next(r.batch_id for r in out if r.case_id == 5) == 1


def test_layout_mismatch_is_refused(spark):
    with pytest.raises(ValueError, match="feature 1"):
        S.logistic_score(spark.range(1), ["a", "b"], ["a", "c"], [1.0, 1.0], 0.0, [0.0, 0.0], [1.0, 1.0])


def test_unknown_cell_is_refused(spark):
    b = spark.createDataFrame([("x", 1)], "cell string, batch_id long")
    with pytest.raises(Exception, match="no cell y"):
        R.chosen_cells(b, ["x", "y"]).collect()


def test_average_precision(spark):
    rows = spark.createDataFrame([("g", 0.9, 1, 1.0, 0), ("g", 0.8, 0, 1.0, 1), ("g", 0.7, 1, 1.0, 2), ("h", 0.5, 0, 1.0, 0)], "v string, score double, label int, weight double, idx long")
    got = {r.v: r.ap for r in S.average_precision(rows, ["v"]).collect()}
    assert got["h"] == 0.0 and abs(got["g"] - (1 + 2 / 3) / 2) < 1e-12


def test_blocks_end_without_their_tags():
    text = lambda h: L.html_text(h)[0]
    assert text("<p>a<p>b") == "a\nb\n"
    assert text("<div><p>a<div>b</div>c</div>d") == "a\nb\nc\nd"
    assert text("<table><tr><td>a<td>b<tr><td>c</table>") == "ab\nc\n"
    assert text("<ul><li>a<li>b</ul>") == "ab"
    assert text("<blockquote><p>a</blockquote>b") == "a\n\nb"
    assert text("<p>a<br>b</p></p>c</div>") == "ab\n\nc"
    assert text("<p/>x<section>y") == "\nxy\n"
