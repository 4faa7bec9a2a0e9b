"""Step documents: one JSON file a record and step, or a table partitioned by step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillspark.functions.text import strip
from quillspark.sources.tables import read_csv

_ID = r".*/abstracts/([^/]+)/[^/]+$"


def read_step(spark: SparkSession, data_dir: str, step: str, schema: StructType | str) -> DataFrame:
    """abstract_id and the document's fields, of the records that have the step's file. Null stays null."""
    df = spark.read.schema(schema).option("multiLine", True).json(f"{data_dir}/abstracts/*/{step}.json")
    return df.select(F.regexp_extract(F.col("_metadata.file_path"), _ID, 1).alias("abstract_id"), "*")


def record_ids(spark: SparkSession, data_dir: str, marker: str = "status.json") -> DataFrame:
    """Ids of the records that have a status file. Sort by abstract_id for the order of strings."""
    files = spark.read.format("binaryFile").load(f"{data_dir}/abstracts/*/{marker}").select(F.col("path"))
    return files.select(F.regexp_extract("path", _ID, 1).alias("abstract_id"))


def listed_ids(spark: SparkSession, data_dir: str) -> DataFrame:
    """Ids of the folders of records in a store, whatever files they hold: Spark lists the prefix, so any store that Hadoop reads will do."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{data_dir}/abstracts").select("path")
    return files.select(F.regexp_extract("path", r".*/abstracts/([^/]+)/", 1).alias("abstract_id")).where("abstract_id <> ''").distinct()


def write_step(df: DataFrame, data_dir: str, step: str) -> None:
    """Documents as one table partition a step, replaced whole: the scalable form of a file a record."""
    df.write.mode("overwrite").json(f"{data_dir}/step_outputs/step_name={step}")


def location(path: Column) -> Column:
    """Scheme, bucket, prefix and file name of a path; a local one has no bucket."""
    remote = path.rlike("^[a-z0-9]+://")
    rest = F.regexp_replace(path, "^[a-z0-9]+://", "")
    bucket = F.when(remote, F.split_part(rest, F.lit("/"), F.lit(1))).otherwise("")
    inner = F.when(remote, F.regexp_replace(rest, "^[^/]*/?", "")).otherwise(path)
    return F.struct(
        F.when(remote, F.regexp_extract(path, "^([a-z0-9]+)://", 1)).otherwise("file").alias("scheme"), bucket.alias("bucket"),
        F.regexp_replace(inner, "/?[^/]*$", "").alias("prefix"), F.regexp_extract(inner, "([^/]*)$", 1).alias("file"),
    )


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """A rule table: names and values stripped."""
    df = read_csv(spark, path)
    return df.select(*[strip(F.col(f"`{c}`")).alias(c.strip()) for c in df.columns])


def read_prompt(spark: SparkSession, path: str) -> DataFrame:
    """prompt: the whole file as one row."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("prompt"))


def read_prompts(spark: SparkSession, pattern: str) -> DataFrame:
    """name (the file's folder) and prompt: every file of a pattern as one row, without a byte-order mark."""
    files = spark.read.text(pattern, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("name"), F.col("value"))
    return files.select("name", F.regexp_replace("value", "^\ufeff", "").alias("prompt"))


_prompts: dict[tuple[str, str], str] = {}


def prompt_text(spark: SparkSession, path: str) -> str:
    """A prompt file's text, read once in an application however often it is asked for; it is an error if there is none."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _prompts:
        row = read_prompt(spark, path).first()
        if row is None:
            raise FileNotFoundError(path)
        _prompts[key] = row.prompt
    return _prompts[key]
