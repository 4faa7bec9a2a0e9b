"""Text tables: CSV with a header, quoted line breaks and byte-order marks, all strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions.text import or_empty, parsed_list, strip
from quillspark.sources.csv_blocks import largest_file, read_blocks
from quillspark.sources.scratch import written

# The header names that stand for a field, in order of preference.
ALIASES = {
    "abstract_id": ("abstract_id", "id"),
    "abstract_title": ("abstract_title", "title"),
    "session_title": ("session_title", "session"),
    "full_abstract": ("full_abstract", "abstract"),
    "firms": ("firms", "firm", "sponsor"),
}


def read_csv(spark: SparkSession, path: str, large: int = 64 << 20) -> DataFrame:
    """All columns are strings; missing cells are empty, names keep their spelling but for a byte-order mark.

    With a file of more than `large` bytes, all tasks read each file by byte ranges; smaller files are read by a task each.
    """
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False)
    if largest_file(spark, path) > large:
        df = read_blocks(spark, path, df.columns)
    return df.select(*[or_empty(F.col(f"`{c}`")).alias(c.lstrip("﻿")) for c in df.columns])


def field(columns: list[str], name: str) -> Column:
    """The column that stands for a field, by any alias in any case; empty text if none does."""
    known = {c.lower().strip(): c for c in reversed(columns)}
    for alias in ALIASES.get(name, (name,)):
        if alias in known:
            return or_empty(F.col(f"`{known[alias]}`"))
    return F.lit("")


def records(df: DataFrame, fields: tuple[str, ...], required: tuple[str, ...] = ("abstract_id",)) -> DataFrame:
    """The named fields as columns of the rows in which the required ones are not empty."""
    rows = df.select(*[strip(field(df.columns, f)).alias(f) for f in fields])
    for name in required:
        rows = rows.where(F.col(name) != "")
    return rows


def batch(df: DataFrame, limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Records for a batch: every field stripped, firms as a list, and the first `limit` of those with an id, in order."""
    fields = ("abstract_id", "abstract_title", "session_title", "full_abstract", "firms")
    kept = limited(df.where(field(df.columns, "abstract_id") != ""), limit, order or [])
    return kept.select(*[strip(field(df.columns, f)).alias(f) for f in fields]).withColumn("firms", parsed_list(F.col("firms")))


def limited(df: DataFrame, limit: int | None, order: list[str]) -> DataFrame:
    """The first rows; all if the limit is 0 or none."""
    return df.orderBy(*order).limit(limit) if limit else df


def with_places(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows numbered from 1 in order, over the whole table, without gathering it in one task.

    Rows are range-sorted; the tasks' sizes, one number a task, are summed up and added to the place within the task.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranged")  # bounds of ranges are drawn once
    local = ranged.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.alias("a").join(sizes.alias("b"), F.col("b._part") < F.col("a._part"), "left").groupBy("a._part").agg(F.coalesce(F.sum("b._n"), F.lit(0)).alias("_before"))
    return local.join(F.broadcast(before), "_part").select(*df.columns, (F.col("_at") + F.col("_before")).alias(name))  # one row a task
