"""Sources, sinks, providers and streams on written files."""

import json

from pyspark.sql import functions as F

from quillspark.operators import providers as L
from quillspark.plans import export as X
from quillspark.sources import documents as D
from quillspark.sources import sinks as K
from quillspark.sources import tables as S


def test_csv_with_bom_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('﻿Abstract_ID , Title,firm\r\n1,"a, ""b""\nsecond",<0>A;;B\r\n,"no id",\r\n2,,x\r\n', encoding="utf-8")
    df = S.read_csv(spark, str(path))
    assert df.count() == 3
    rows = S.records(df, ("abstract_id", "abstract_title", "firms", "session_title")).orderBy("abstract_id").collect()
    assert [tuple(r) for r in rows] == [("1", 'a, "b"\nsecond', "<0>A;;B", ""), ("2", "", "x", "")]
    assert S.records(df, ("abstract_id", "abstract_title"), ("abstract_id", "abstract_title")).count() == 1


def test_csv_round_trip(spark, tmp_path):
    rows = [("1", 'q"uote', "line\nbreak"), ("2", "", ",;"), ("3", None, "é")]
    K.write_csv(spark.createDataFrame(rows, "a string, b string, c string"), str(tmp_path / "o"), single=True)
    assert sorted(tuple(r) for r in S.read_csv(spark, str(tmp_path / "o")).collect()) == [(a, b or "", c) for a, b, c in rows]


def test_documents_by_record(spark, tmp_path):
    for k, doc in {"r1": {"primary_drugs": ["A"]}, "r2": {}, "r3": {"primary_drugs": None}}.items():
        (tmp_path / "abstracts" / k).mkdir(parents=True)
        (tmp_path / "abstracts" / k / "drug_extraction.json").write_text(json.dumps(doc, indent=2))
    (tmp_path / "abstracts" / "r1" / "status.json").write_text("{}")
    got = D.read_step(spark, str(tmp_path), "drug_extraction", "primary_drugs array<string>").orderBy("abstract_id").collect()
    assert [tuple(r) for r in got] == [("r1", ["A"]), ("r2", None), ("r3", None)]
    assert [r[0] for r in D.record_ids(spark, str(tmp_path)).collect()] == ["r1"]


def test_export_keeps_repeated_and_missing_records(spark):
    rows = spark.createDataFrame([("1",), ("1",), ("2",)], "abstract_id string")
    empty = "array<struct<key:string,items:array<string>>>"
    docs = {
        "drug_extraction": spark.createDataFrame([("1", ["A", ""], ["NA"], [], ["r"])], "abstract_id string, primary_drugs array<string>, secondary_drugs array<string>, comparator_drugs array<string>, reasoning array<string>"),
        "drug_validation": spark.createDataFrame([], "abstract_id string, validation_status string, grounded_search_performed boolean, search_results array<string>, missed_drugs array<string>, issues_found array<string>, validation_reasoning string"),
        "drug_class_step1": spark.createDataFrame([("1", [("A", [])])], f"abstract_id string, components {empty}"),
        "drug_class_step2": spark.createDataFrame([], f"abstract_id string, classes {empty}, details array<string>"),
        "drug_class_step3": spark.createDataFrame([("1", [("A", ["NA", " z "])], None)], f"abstract_id string, selections {empty}, reasoning array<string>"),
        "drug_class_step4": spark.createDataFrame([], "abstract_id string, explicit_drug_classes array<string>, extraction_details array<string>"),
        "drug_class_step5": spark.createDataFrame([("1", ["b", "z"], [], "why")], "abstract_id string, refined_explicit_classes array<string>, removed_classes array<string>, reasoning string"),
        "drug_class_validation": spark.createDataFrame([("1", [("A", []), ("B", ["c"])])], f"abstract_id string, missed {empty}"),
    }
    out = X.drug_export(rows, docs).orderBy("abstract_id").collect()
    assert [r.abstract_id for r in out] == ["1", "1", "2"]
    first, last = out[0], out[2]
    assert len(out[0]) == 23
    assert (first.drug_extraction_primary_drugs, first.drug_extraction_secondary_drugs) == ("A", "NA")
    assert first.drug_class_step1_drug_to_components == '"A": '
    assert first.drug_class_combined_all_classes == "b;;z"
    assert first.drug_class_validation_missed_drug_classes == '"B": c'
    assert set(list(last)[1:]) == {""}


def test_failed_calls_become_errors(spark):
    def call(batch):
        raise RuntimeError("down")

    rows = spark.createDataFrame([("1",)], "abstract_id string")
    assert [tuple(r) for r in L.external(call)(rows).collect()] == [("1", None, "down")]
    assert L.replay(spark.createDataFrame([("1", "x")], "abstract_id string, response string"))(rows).first().response == "x"


def test_places_follow_the_order_of_the_whole_table(spark):
    df = S.with_places(spark.range(500).select((F.col("id") * 7919 % 500).alias("k")), ["k"], "place")
    assert all(r.place == r.k + 1 for r in df.collect())


def test_limit_zero_is_no_limit(spark):
    assert S.limited(spark.range(5), 0, ["id"]).count() == 5
    assert S.limited(spark.range(5), 2, ["id"]).count() == 2


def _write(root, record, step, document):
    (root / "abstracts" / record).mkdir(parents=True, exist_ok=True)
    (root / "abstracts" / record / f"{step}.json").write_text(json.dumps(document, indent=2))


def test_exports_from_folders_by_command(spark, tmp_path):
    from quillspark.__main__ import main

    detail = {"extracted_text": "x inhibitor", "class_type": "odd type"}
    _write(tmp_path, "1", "drug_extraction", {"primary_drugs": [], "Primary Drugs": ["A", "B"], "Reasoning": ["é"]})
    _write(tmp_path, "1", "drug_class_steps1_3", {"drug_results": [
        {"drug": "A", "components": ["A1", "A2"], "extractions": {"A1": {"drug_classes": ["old"]}, "A2": {"drug_classes": ["NA"], "extraction_details": [detail]}}, "selections": {"A1": {"selected_drug_classes": ["NA"]}}},
        {"drug": "B", "components": [], "extractions": {"A1": {"drug_classes": ["new"]}}, "selections": {"B": {"selected_drug_classes": ["X Inhibitor", " Y "], "reasoning": "r"}}, "error": "late"},
    ]})
    _write(tmp_path, "1", "drug_class_validation", {"results": [{"drug_name": "A", "validation": {"missed_drug_classes": []}}, {"drug_name": "B", "validation": {"missed_drug_classes": ["Z"]}}]})
    _write(tmp_path, "1", "status", {"abstract_title": "t", "status": "partial", "metrics": {"llm_calls": 3}, "drug": {"extraction": {"status": "success", "llm_calls": 1, "tokens": 5}}, "indication": {"validation": {"status": "failed", "error": "down"}}, "errors": ["e1"]})
    _write(tmp_path, "1", "indication_extraction", {"selected_source": "none", "reasoning": "r"})
    source = tmp_path / "in.csv"
    source.write_text('﻿Id,title,firms\n1,"a\nb",<3> F\n2,,\n', encoding="utf-8")

    out = lambda name: S.read_csv(spark, str(tmp_path / name)).orderBy("abstract_id").collect()
    main(["drug-export", "--input", str(source), "--data_dir", str(tmp_path), "--output", str(tmp_path / "drug")])
    first, second = out("drug")
    assert (first.drug_extraction_primary_drugs, json.loads(first.drug_extraction_reasoning)) == ("A;;B", ["é"])
    assert first.drug_class_step1_drug_to_components == '"A": A1;;A2\n"B": '
    assert first.drug_class_step2_drug_classes == '"A1": new\n"A2": NA'
    assert first.drug_class_step3_selected_drug_classes == '"A1": NA\n"B": X Inhibitor;;Y'
    assert first.drug_class_combined_all_classes == "X Inhibitor;;Y"
    assert first.drug_class_validation_missed_drug_classes == '"B": Z'
    assert second.title == "" and second.drug_class_combined_all_classes == ""
    main(["indication-export", "--input", str(source), "--data_dir", str(tmp_path), "--output", str(tmp_path / "indication")])
    assert [r.validation_status for r in out("indication")] == ["ERROR: down", "Validation not completed"]
    main(["metrics", "--data_dir", str(tmp_path), "--output", str(tmp_path / "metrics")])
    (row,) = out("metrics")
    assert len(row) == 59 and (row.overall_status, row.drug_extraction_tokens, row.drug_class_step1_status, json.loads(row.errors)) == ("partial", "5", "", ["e1"])
    main(["clean-firms", "--input", str(source), "--output", str(tmp_path / "clean")])
    assert sorted(r.firms for r in S.read_csv(spark, str(tmp_path / "clean")).collect()) == ["", "F"]
