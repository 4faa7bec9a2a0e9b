"""Sinks: CSV with fixed columns, documents, retry lists."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, StringType, StructField, StructType

from quillspark.functions.text import or_empty, pretty_json


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, single: bool = False) -> None:
    """Rows as quoted CSV with a header; null as an empty cell. single: one file, for results of a bounded size."""
    rows = df.select(*[or_empty(F.col(f"`{c}`").cast("string")).alias(c) for c in (columns or df.columns)])
    (rows.coalesce(1) if single else rows).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', quoteAll=False, emptyValue="", lineSep="\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_text(df: DataFrame, path: str, bom: bool = False) -> None:
    """One text column; with a byte-order mark in front of the first line of each file only if asked for."""
    value = F.col(df.columns[0])
    (df.select(F.concat(F.lit("﻿"), value).alias("value")) if bom else df.select(value.alias("value"))).write.mode("overwrite").text(path)


def model_response(payload: Column, kind: DataType | str, error: Column) -> Column:
    """The payload as JSON with an indent of two; an error object where there is none. kind: the payload's type."""
    failure = F.struct(F.coalesce(error, F.lit("not processed")).alias("error"))
    return F.when(payload.isNotNull(), pretty_json(payload, kind)).otherwise(pretty_json(failure, "struct<error:string>"))


def class_response(selections: Column, kind: DataType, explicit: Column, final: Column, status: Column, calls: Column) -> Column:
    """What the drug-class steps made of a record, as JSON with an indent of two: a missing step's parts are empty, a missing status is not_processed.

    selections: a map of the type `kind`; explicit and final: lists of classes; status, calls: of the status document.
    """
    none = F.array().cast("array<string>")
    parts = {
        "drug_selections": F.coalesce(selections, F.create_map().cast(kind)), "explicit_drug_classes": F.coalesce(explicit, none), "final_drug_classes": F.coalesce(final, none),
        "pipeline_status": F.coalesce(status, F.lit("not_processed")), "total_llm_calls": F.coalesce(calls, F.lit(0)).cast("long"),
    }
    shape = StructType([StructField("drug_selections", kind), StructField("explicit_drug_classes", ArrayType(StringType())), StructField("final_drug_classes", ArrayType(StringType())), StructField("pipeline_status", StringType()), StructField("total_llm_calls", LongType())])
    return pretty_json(F.struct(*[c.alias(n) for n, c in parts.items()]), shape)


def retry_lists(rows: DataFrame, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """Rows that failed, and rows that succeeded in part; all columns of the input stay."""
    return rows.where(F.col(status) == "failed"), rows.where(F.col(status) == "partial")


def validation_text(status: Column, error: Column) -> Column:
    """The status; else what went wrong; else that it was not completed."""
    return F.coalesce(F.when(status != "", status), F.when(error != "", F.concat(F.lit("ERROR: "), error)), F.lit("Validation not completed"))
