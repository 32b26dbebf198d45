import json
import random

from pyspark.sql import functions as F

from foliospark.functions import offsets
from foliospark.operators import evidence as E
from foliospark.operators import folding, patches, quotes

LOG = "seq long, case_id long, cycle string, op string, field string, new string, reviewer string, model string, prompt_version string, run_id string, rule_id string"


def patch(seq, op, field=None, new=None, reviewer=None, model="m", prompt="mapper-v3", run="r", case=1, cycle="c"):
    return (seq, case, cycle, op, field, json.dumps(new), reviewer, model, prompt, run, None)


def folded(spark, *log, protect_from=0):
    out = folding.fold(spark.createDataFrame(list(log), LOG), protect_from)
    return {r.case_id: r for r in out.records.collect()}, sorted(map(tuple, out.conflicts.collect())), sorted(map(tuple, out.errors.collect()))


def test_similarity():
    assert quotes.similarity("abcd", "xxabcdxx") == 100.0
    assert quotes.similarity("abcd", "abxd") == 75.0
    assert quotes.similarity("", "x") == 0.0


def test_quotes_with_spans_and_pages(spark):
    text = "A long sen-\ntence without any damage at all. " * 3 + "The tenant held the house ﬁrst for a term of years and paid rent weekly" + " and so on and on" * 5
    pages = [(0, "1"), (100, "2"), (5000, "3")]
    case = spark.createDataFrame([(1, text, pages)], "case_id long, raw_text string, page_map array<struct<offset:int,label:string>>").withColumn("norm_text", quotes.T.normalise(F.col("raw_text")))
    asked = ["long sentence without", "the tenant held the hquse first for a term of years and paid rent wekly", "nothing like this was ever written by anyone in the world", "", None]
    q = spark.createDataFrame([(1, i, t) for i, t in enumerate(asked)], "case_id long, quote_id long, text string")
    out = {r.quote_id: r for r in quotes.checked_quotes(q, case).collect()}
    assert [out[i].status for i in range(5)] == ["verified", "verified-fuzzy", "failed", "failed", "failed"]
    assert text[out[0].raw_start : out[0].raw_end] == "long sen-\ntence without" and out[0].page == "1"
    assert out[1].score >= 92 and abs(out[1].raw_start - text.index("The tenant")) < 40 and out[1].page == "2"
    assert out[2].page is None and out[2].raw_start is None


def test_a_text_shorter_than_its_quote_is_looked_for_in_the_quote(spark):
    text = "held the house for a year"
    case = spark.createDataFrame([(1, text, text, [(0, "1")])], "case_id long, raw_text string, norm_text string, page_map array<struct<offset:int,label:string>>")
    q = spark.createDataFrame([(1, 1, "the tenant, who paid rent weekly, " + text + " and then left the town for good, as he said"), (2, 1, "of no case")], "case_id long, quote_id long, text string")
    assert [(r.status, r.place, r.score, r.raw_start, r.page) for r in quotes.checked_quotes(q, case).orderBy("case_id").collect()] == [("verified-fuzzy", 0, 100.0, 0, "1"), ("failed", None, None, None, None)]


def test_windows_are_scored_only_where_they_can_reach_the_limit(monkeypatch):
    text = "no man shall keep an inn, or such a house as this, anywhere in the said town; the words of the act are plain at all points. " * 20
    quote, scored = "no such words anywhere at all", []
    exact = quotes.similarity
    monkeypatch.setattr(quotes, "similarity", lambda *a: scored.append(a) or exact(*a))
    assert quotes.best_window(quote, text, quotes._runs(text)) is None and len(scored) < 5
    damaged = text[:700] + " no such wrds anywhere, at all " + text[700:]
    got = quotes.best_window(quote, damaged, quotes._runs(damaged))
    assert got == max(((at, exact(quote, damaged[at : at + 49])) for at in range(0, len(damaged) - 28, 20)), key=lambda x: (x[1], -x[0]))


def test_places_of_a_whole_text_are_those_of_its_letters():
    rng = random.Random(5)
    for _ in range(500):
        raw = "".join(rng.choice("ab-  \n\t’“—ſﬁ■İA é.-") for _ in range(rng.randint(0, 25)))
        assert offsets.normalised_places(raw).tolist() == offsets.normalised_offsets(raw)[1]


def test_wilson_and_kappa(spark):
    row = spark.createDataFrame([(10, 20)], "k long, n long").select(E.wilson(F.col("k"), F.col("n")).alias("w")).first().w
    assert round(row.lo, 4) == 0.2993 and round(row.hi, 4) == 0.7007
    pairs = [("g", "y", "y")] * 20 + [("g", "y", "n")] * 5 + [("g", "n", "y")] * 10 + [("g", "n", "n")] * 15
    k = E.kappa(spark.createDataFrame(pairs, "g string, a string, b string"), ["g"]).first()
    assert round(k.kappa, 4) == 0.4 and k.n == 50


def test_fold_protects_a_persons_value(spark):
    log = [patch(1, "admit", new={"relevant": True, "polarity": "a"}), patch(2, "set", "polarity", "b", reviewer="ann"), patch(3, "set", "polarity", "c"), patch(4, "set", "polarity", "b")]
    records, conflicts, _ = folded(spark, *log)
    assert records[1].fields["polarity"] == '"b"' and records[1].flags == ["needs-review:polarity"] and records[1].provenance["polarity"] == "human"
    assert conflicts == [(1, "polarity", '"c"', '"b"', 3, False)]
    records, conflicts, _ = folded(spark, *log[:3], protect_from=10)
    assert records[1].fields["polarity"] == '"c"' and conflicts[0][-1] and not records[1].flags


def test_fold_cascades_and_reports(spark):
    quoted = [{"text": "q", "supports": ["polarity"]}, {"text": "r", "supports": "holding_summary"}]
    body = {"relevant": True, "polarity": "a", "holding_summary": "h", "quotes": quoted}
    records, _, errors = folded(spark, patch(1, "admit", new=body), patch(2, "drop_quote", new="q", reviewer="ann"), patch(3, "set", "polarity", "x", prompt=None), patch(4, "set", "polarity", "a", case=2))
    assert "polarity" not in records[1].fields and records[1].fields["holding_summary"] == '"h"' and records[1].nulled_fields == ["polarity"] and len(records[1].quotes) == 1
    assert [(c, n) for c, n, _ in errors] == [(1, 3), (2, 4)] and errors[1][2] == "unknown case"


def test_fold_of_a_second_admission(spark):
    first, again = {"relevant": True, "polarity": "a", "name": "n"}, {"relevant": False, "polarity": "z"}
    log = [patch(1, "admit", new=first), patch(2, "set", "polarity", "b", reviewer="ann"), patch(3, "admit", new=again), patch(4, "admit", new=first, cycle="other"), patch(5, "migrate", new={"schema_version": 2, "name": "m"})]
    records, conflicts, errors = folded(spark, *log)
    r = records[1]
    assert r.fields == {"polarity": '"b"', "relevant": "false", "schema_version": "2", "name": '"m"'} and not r.in_file and r.admit_seq == 1
    assert [c[1] for c in conflicts] == ["polarity"] and [e[1] for e in errors] == [4]


def test_in_file_follows_what_a_person_said_before_a_second_admission(spark):
    body = {"relevant": True, "polarity": "x"}
    log = [patch(1, "admit", new=body), patch(2, "set", "relevant", False, reviewer="ann"), patch(3, "admit", new=body)]
    for end, want in ((2, True), (3, False)):  # a later set doesn't move the file, a later admission does
        records, *_ = folded(spark, *log[:end])
        assert records[1].in_file is want and records[1].fields["relevant"] == "false"
    assert folded(spark, *log, protect_from=10)[0][1].in_file is True
    assert folded(spark, log[0], log[1], patch(3, "admit", new={"polarity": "x"}))[0][1].in_file is False


def test_fold_of_nothing(spark):
    assert folded(spark, patch(1, "admit", new={}, case=7))[0][7].fields == {}
    empty = folding.fold(spark.createDataFrame([], LOG), 0)
    assert empty.records.count() == empty.conflicts.count() == empty.errors.count() == 0


def test_applied_outcomes(spark):
    log = spark.createDataFrame([patch(1, "admit", new={"relevant": True, "polarity": "a"}), patch(2, "set", "polarity", "b", reviewer="ann")], LOG)
    rows = [patch(0, "set", "polarity", "b", reviewer="ann"), patch(1, "set", "polarity", "c"), patch(2, "set", "era", "x"), patch(3, "set", "era", "x"), patch(4, "set", "era", "x", case=9)]
    new = spark.createDataFrame(rows, LOG).withColumnRenamed("seq", "ord")
    out = {r.ord: (r.outcome, r.seq) for r in patches.applied(log, new, 2, 0, "ord").collect()}
    assert out == {0: ("skipped", None), 1: ("rejected", 3), 2: ("applied", 4), 3: ("skipped", None), 4: ("rejected", 5)}
