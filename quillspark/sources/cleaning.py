"""Cleaning of one column of a CSV, into another CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.text import without_rank
from quillspark.sources.sinks import write_csv
from quillspark.sources.tables import read_csv


def cleaned(rows: DataFrame, column: str, clean: Column) -> tuple[DataFrame, Observation]:
    """rows with the column cleaned where it isn't empty, and what is counted while they are written: total, filled, changed, multi (several values)."""
    value = F.col(f"`{column}`")
    after = F.when(value == "", value).otherwise(clean)
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(value != "").alias("filled"), F.count_if(value != after).alias("changed"), F.count_if(after.contains(";;")).alias("multi"))
    return counted.withColumn(column, after), seen


def clean_csv(spark: SparkSession, source: str, target: str, column: str = "firms", limit: int = 0) -> dict[str, int]:
    """Writes the source to the target with its firms cleaned, and returns the counts; the rows are read once. A table without the column is written as it is."""
    rows = read_csv(spark, source)
    rows = rows.limit(limit) if limit else rows
    named = next((c for c in rows.columns if c.lower().strip() == column), None)
    if named is None:
        write_csv(rows, target)
        return {"total": read_csv(spark, target).count(), "filled": 0, "changed": 0, "multi": 0}
    rows, seen = cleaned(rows, named, without_rank(F.col(f"`{named}`")))
    write_csv(rows, target)
    return seen.get
