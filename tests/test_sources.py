import json
import zipfile

import pytest

from foliospark.operators import runs
from foliospark.sources import archives, records

ERAS = [("early", 1900), ("late", 2000)]


def case(i, **more):
    body = {"id": i, "name": f"A v. B{i}", "name_abbreviation": "A v. B", "decision_date": "1850-03", "first_page": "10", "citations": [{"cite": f"{i} X 1", "type": "nominative"}, {"cite": f"{i} Rep. 2", "type": "official"}]}
    body |= {"court": {"name": "C"}, "jurisdiction": {"name": "N.Y."}, "file_name": f"f{i}", "cites_to": [{"cite": "9 X 9", "category": "r", "case_ids": [7, 8]}, {"cite": "9 X 9", "category": "s", "case_ids": [7]}], "analysis": {"ocr_confidence": 0.5, "pagerank": {"raw": 0.1, "percentile": 0.9}}}
    return body | more


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as z:
        z.writestr("metadata/CasesMetadata.json", json.dumps([case(1), case(2), case(3, jurisdiction={"name": "Elsewhere"}), case(4, decision_date="n.d.")]))
        for i in (1, 3, 4):  # case 2 has no page
            z.writestr(f"html/f{i}.html", f'<section class="casebody"><p>Text {i}<a class="page-label" data-label="11">*11</a> goes on</p></section>')
    with zipfile.ZipFile(tmp_path / "empty.zip", "w") as z:
        z.writestr("readme", "nothing")
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    raw = archives.archive_cases(spark, f"file://{tmp_path}")
    t = archives.case_tables(raw, ERAS, ["N.Y."])
    rows = {r.case_id: r for r in t["cases"].collect()}
    assert sorted(rows) == [1, 4] and rows[1].cite == "1 Rep. 2" and rows[1].raw_text == "Text 1 goes on\n\n" and rows[1].year == 1850 and rows[1].era == "early"
    assert [tuple(p) for p in rows[1].page_map] == [(0, "10"), (6, "11")] and rows[4].year is None and rows[4].era is None
    assert t["citations"].count() == 4 and t["pageranks"].count() == 2
    assert sorted((r.citing, r.cited, r.category) for r in t["edges"].collect()) == [(1, 7, "r"), (1, 8, "r"), (4, 7, "r"), (4, 8, "r")]
    assert [r.path.rsplit("/", 1)[1] for r in t["errors"].collect()] == ["bad.zip"]


def test_records_and_batches(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.json").write_text('[{"case_id": 1, "x": "y"}, {"case_id": 2}]')
    (tmp_path / "r" / "b.json").write_text("no json")
    good, bad = records.record_arrays(spark, f"file://{tmp_path}/r", "case_id long, x string")
    assert sorted((r.case_id, r.x) for r in good.collect()) == [(1, "y"), (2, None)] and bad.count() == 1
    (tmp_path / "b").mkdir()
    for name in ("batch-001", "batch-002", "retry-001", "batch-retry-001"):
        (tmp_path / "b" / f"{name}.json").write_text(json.dumps({"batch_id": name, "era_partition": "e", "jurisdiction": "j", "cases": [{"case_id": 1, "signals": [{"selector_id": "s"}]}]}))
    assert sorted(r.batch_id for r in records.pool_batches(spark, f"file://{tmp_path}/b").collect()) == ["batch-001", "batch-002"]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, "a"), (2, "x,y", "b")], "n long, s string, k string")
    records.write_csv(rows.coalesce(1), ["s", "n"], f"file://{tmp_path}/csv")
    lines = next((tmp_path / "csv").glob("*.csv")).read_text().splitlines()
    assert lines == ["s,n", ",1", '"x,y",2']
    records.write_jsonl(rows, f"file://{tmp_path}/json", ["k"])
    found = [json.loads(x) for f in (tmp_path / "json").rglob("*.json") for x in f.read_text().splitlines()]
    assert sorted(found, key=str) == [{"n": 1, "s": None}, {"n": 2, "s": "x,y"}]


def test_training(spark):
    rows = [(i, int(i % 3 == 0), 1.0, float(i % 3 == 0) + (i * 37 % 11) / 20, float(i * 7919 % 13)) for i in range(240)]
    d = spark.createDataFrame(rows, "case_id long, label int, weight double, a double, b double")
    model = runs.train(d, ["a", "b"], d.limit(0), grid=(0.1, 1.0), folds=2)
    assert model["ap"] > 0.95 and model["coef"][0] > 1 > abs(model["coef"][1]) and model["C"] in (0.1, 1.0)
    with pytest.raises(ValueError, match="held out"):
        runs.train(d, ["a"], d.limit(1))
