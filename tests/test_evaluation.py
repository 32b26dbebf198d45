"""Scores and audits on small cases; their SQL covers whole tables."""

import pytest

from foliospark.operators import evaluation as V


def test_reader_scores_gate_and_macro(spark):
    cols = "case_id long, relevant string, polarity string"
    ref = spark.createDataFrame([(1, "true", "favorable"), (2, "true", "adverse"), (3, "false", None), (4, "true", "irrelevant"), (5, "true", "mixed")], cols)
    got = spark.createDataFrame([(1, "true", "favorable"), (2, "false", "adverse"), (3, "true", "mixed"), (4, "true", "adverse"), (5, "true", None), (9, "true", "mixed")], cols)
    rows = {r.field: r for r in V.reader_scores(got, ref, {"relevant": None, "polarity": ["favorable", "adverse", "mixed"]}).collect()}
    assert (rows["relevant"].n_reference_decided, rows["relevant"].agreement_decided) == (5, 0.6)
    p = rows["polarity"]
    assert (p.n_reference_decided, p.n_both_decided, p.n_prediction_irrelevant, p.decided_rate, p.agreement_decided) == (2, 1, 1, 0.5, 1.0)
    assert rows["macro"].agreement_decided == pytest.approx(0.8)
    none = {r.field: r for r in V.reader_scores(got.limit(0), ref, {"relevant": None, "polarity": None}).collect()}
    assert none["relevant"].decided_rate == 0.0 and none["macro"].agreement_decided == 0.0


def test_audit_counts_and_strays(spark):
    sample = spark.createDataFrame([(i, "F" if i % 2 else "O") for i in range(1, 6)], "case_id long, polarity string")
    schema = "case_id long, status string, final_relevant boolean, initial_relevant boolean, final_polarity string, initial_polarity string"
    out = [(1, "decided", True, True, "F", "F"), (2, "decided", True, False, "F", "F"), (3, "decided", False, False, None, None), (4, "unreadable", None, None, None, None)]
    rows = {(r.measure, r.scope): r for r in V.audit_precision(sample, spark.createDataFrame(out, schema), ["polarity"], "polarity = 'F'").collect()}
    count = lambda m, s="all": (rows[m, s].k, rows[m, s].n)
    assert count("decided") == (3, 5) and count("unresolved") == (2, 5) and count("precision") == (2, 3) and count("accuracy:polarity") == (1, 2) and count("joint") == (1, 3) and count("revised:relevant") == (1, 3)
    assert count("precision", "subgroup") == (1, 2) and rows["precision", "all"].lo < 2 / 3 < rows["precision", "all"].hi
    with pytest.raises(Exception, match="not in the sample: case 77"):
        V.audit_precision(sample, spark.createDataFrame([*out, (77, "decided", True, True, "F", "F")], schema), ["polarity"], "true").collect()
    empty = V.audit_precision(sample.limit(0), spark.createDataFrame([], schema), ["polarity"], "true").collect()
    assert all(r.n == 0 and r.rate is None for r in empty)


def test_reads_fall_back_to_admissions(spark):
    units = spark.createDataFrame([("r1", 1, False, [1, 2]), ("r2", 2, True, [1]), ("r3", 3, True, [1, 3]), ("r4", 4, False, [4])], "run string, place int, ok boolean, case_ids array<long>")
    admits = spark.createDataFrame([(4, 1, "a"), (5, 2, None), (5, 3, "b"), (6, 9, "c")], "case_id long, seq long, run_id string")
    assert {r.case_id: r.run for r in V.read_by(units, admits).collect()} == {1: "r2", 2: "read-failed", 3: "r3", 4: "read-failed", 5: "unknown-run", 6: "c"}
