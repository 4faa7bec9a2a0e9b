"""Cleaning from CSV to CSV, prompt files, model limits and regimens."""

import pytest
from pyspark.sql import functions as F

from quillspark.functions import rules
from quillspark.sources import documents
from quillspark.sources.cleaning import clean_csv
from quillspark.sources.tables import read_csv


def test_a_csv_is_cleaned_in_one_pass(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text('id,Firms ,note\n1,<1>Acme ;; Beta,"a\nb"\n2,,x\n3,Gamma,\n4,<22> Delta,y\n')
    assert clean_csv(spark, str(source), str(tmp_path / "out")) == {"total": 4, "filled": 3, "changed": 2, "multi": 1}
    got = read_csv(spark, str(tmp_path / "out"))
    assert got.columns == ["id", "Firms ", "note"]
    assert sorted(map(tuple, got.collect())) == [("1", "Acme ;; Beta", "a\nb"), ("2", "", "x"), ("3", "Gamma", ""), ("4", "Delta", "y")]
    source.write_text("id\n1\n")
    assert clean_csv(spark, str(source), str(tmp_path / "none"))["total"] == 1


def test_prompts_are_read_once(spark, tmp_path):
    path = tmp_path / "a" / "prompt.md"
    path.parent.mkdir()
    path.write_text("﻿first\nline\n", encoding="utf-8")
    assert [tuple(r) for r in documents.read_prompts(spark, str(tmp_path / "*/*")).collect()] == [("a", "first\nline\n")]
    text = documents.prompt_text(spark, str(path))
    path.write_text("changed")
    assert documents.prompt_text(spark, str(path)) == text
    with pytest.raises(Exception, match="nothing"):
        documents.prompt_text(spark, str(tmp_path / "nothing"))


def test_limits(spark):
    rows = spark.createDataFrame([(0.0, 1, "openai"), (2.0, 100_000, "google"), (2.1, 0, "other"), (None, None, None), (-0.1, 100_001, "openai")], "t double, n int, p string")
    ok, wrong = rules.within_limits(F.col("t"), F.col("n"), F.col("p"))
    kept, others = rules.quarantined(rows.select("t", ok.alias("ok"), wrong.alias("wrong")), F.col("ok"))
    assert kept.count() == 2
    assert sorted(map(str, (r.wrong for r in others.collect()))) == sorted(map(str, (["temperature", "max_tokens", "provider"], ["temperature", "max_tokens", "provider"], ["temperature", "max_tokens"])))


def test_regimens_by_a_table(spark):
    table = rules.regimen_table(spark).union(spark.createDataFrame([("FOLFOX", 1, "5-FU"), ("FOLFOX", 2, "Oxaliplatin"), ("FOLFOX", 2, "Oxaliplatin")], "regimen string, place int, component string"))
    drugs = spark.createDataFrame([(1, " chop "), (2, "folfox"), (3, "Aspirin"), (4, None)], "id int, drug string")
    got = rules.components(drugs, "drug", table).orderBy("id", "place").collect()
    assert [(r.id, r.component) for r in got] == [*((1, c) for c in rules.REGIMENS["CHOP"]), (2, "5-FU"), (2, "Oxaliplatin"), (3, "Aspirin"), (4, None)]
