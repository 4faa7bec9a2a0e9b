"""A keyed table that is changed by the bucket, and exports from step documents in one shuffle."""

import pytest
from pyspark.sql import functions as F

from quillspark.plans import export
from quillspark.sources.bucket_table import BucketTable

SCHEMA = "id long, part string, note string"


def rows_of(table):
    return sorted(map(str, table.read().collect()))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), ["id", "part"], SCHEMA, buckets=8)
    assert table.read().count() == 0 and table.upsert(frame(spark, [])) == 0
    first = [(k, "a", "old") for k in range(100)] + [(None, "a", "no id"), (None, None, "no keys")]
    assert table.upsert(frame(spark, first)) == 1
    before = table.manifest()[1]
    assert table.upsert(frame(spark, [(5, "a", "new"), (None, "a", "found"), (5, "b", "other part")])) == 2
    after = table.manifest()[1]
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 3
    want = [(k, "a", "new" if k == 5 else "old") for k in range(100)] + [(None, "a", "found"), (None, None, "no keys"), (5, "b", "other part")]
    assert rows_of(table) == sorted(map(str, frame(spark, want).collect()))
    again = BucketTable(spark, str(tmp_path / "t"), ["id", "part"], SCHEMA, buckets=8)
    assert rows_of(again) == rows_of(table)


@pytest.mark.parametrize("where", ["_switch", "write"])
def test_an_interrupted_write_leaves_the_old_rows(spark, tmp_path, monkeypatch, where):
    table = BucketTable(spark, str(tmp_path / "t"), ["id"], SCHEMA, buckets=4)
    table.upsert(frame(spark, [(k, "a", "old") for k in range(20)]))
    before = rows_of(table)
    with monkeypatch.context() as m:
        if where == "_switch":
            m.setattr(table, "_switch", lambda *_: (_ for _ in ()).throw(OSError("lost")))
            changes = frame(spark, [(1, "a", "new")])
        else:
            changes = frame(spark, [(1, "a", "x")]).withColumn("note", F.raise_error("lost").cast("string"))
        with pytest.raises(Exception, match="lost"):
            table.upsert(changes)
    assert rows_of(table) == before
    (tmp_path / "t/manifests/version=2/_temporary").mkdir(parents=True)  # what a write of a manifest that was cut off leaves
    assert rows_of(table) == before
    assert table.upsert(frame(spark, [(1, "a", "new")])) == 2 and "new" in str(rows_of(table))


def test_step_documents_are_merged_with_one_shuffle(spark):
    rows = spark.createDataFrame([("1", "x"), ("2", "y"), ("2", "again"), (None, "z"), ("9", "w")], "abstract_id string, title string")
    steps = {f"s{k}": spark.createDataFrame([(str(i), i * k) for i in range(1, 4 + k)], "abstract_id string, n int") for k in range(6)}
    got = export._documents(rows, steps)
    found = sorted((r.title, *(None if r[s] is None else r[s].n for s in steps)) for r in got.collect())
    of = lambda i: tuple(i * k if i < 4 + k else None for k in range(6))
    assert found == sorted([("x", *of(1)), ("y", *of(2)), ("again", *of(2)), ("z", *[None] * 6), ("w", *[None] * 6)], key=lambda r: r[0])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = export._documents(rows, steps)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # the documents', and the rows'
