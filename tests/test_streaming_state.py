"""The state of a stream: what a batch costs, restarts, late and equal events."""

import random

from pyspark.sql import functions as F

from quillspark.operators.records import latest
from quillspark.streaming import status

SCHEMA = "user string, step string, ts timestamp, n long, note string"


def put(spark, folder, rows):
    spark.createDataFrame(rows, "user string, step string, ts long, n long, note string").withColumn("ts", F.timestamp_seconds("ts")).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, checkpoint, changed=None):
    stream = spark.readStream.schema(SCHEMA).parquet(folder)
    query = status.keep_latest(stream, ["user", "step"], ["ts", "n"], checkpoint, changed)
    query.awaitTermination()
    return next(iter(query.lastProgress["stateOperators"]), None)


def test_a_batch_touches_its_own_keys_and_a_restart_goes_on(spark, tmp_path):
    folder, checkpoint, log = str(tmp_path / "in"), str(tmp_path / "checkpoint"), str(tmp_path / "log")
    draw = random.Random(1)
    first = [(f"u{draw.randrange(300)}", draw.choice("abc"), draw.randrange(1000), k, "x") for k in range(2000)]
    first += [("u1", "a", 7, 9000, "x"), ("u2", "a", 8, 9001, "x")]
    put(spark, folder, first)
    changed = lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{log}/epoch={epoch}")
    before = run(spark, folder, checkpoint, changed)
    assert before["numRowsTotal"] == len({r[:2] for r in first})
    second = [("u1", "a", 5000, 1, "newest"), ("u2", "a", -5, 1, "late"), ("new", "a", 1, 1, None), (None, "b", 1, 2, "no user"), (None, "b", 1, 2, "no user, equal order")]
    put(spark, folder, second)
    after = run(spark, folder, checkpoint, changed)  # a new query on the same checkpoint
    assert after["numRowsUpdated"] == 4 and after["numRowsTotal"] == before["numRowsTotal"] + 2
    want = latest(spark.read.schema(SCHEMA).parquet(folder), ["user", "step"], ["ts", "n", "note"])
    got = status.live(spark, checkpoint)
    assert sorted(map(str, got.select("user", "step", "ts", "n", "note").collect())) == sorted(map(str, want.select("user", "step", "ts", "n", "note").collect()))
    newest = spark.read.parquet(f"{log}/epoch=1")
    assert newest.count() == 4 and newest.where("user = 'u2' and step = 'a'").first().note == "x"  # a late event changes nothing
    assert run(spark, folder, checkpoint, changed) is None  # nothing new, no batch
    assert status.live(spark, checkpoint).count() == after["numRowsTotal"]
