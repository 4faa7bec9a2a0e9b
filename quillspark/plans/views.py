"""The engine's record shapes, as views over the star schema and corpus tables.

Each view exists twice: as a DataFrame, and as SQL for a check by another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def abstracts(spark: SparkSession, d: str) -> DataFrame:
    """abstract_id, abstract_title (first line), session_title, full_abstract, firm."""
    t = table(spark, d, "documents")
    return t.select(
        F.col("doc_id").cast("string").alias("abstract_id"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("abstract_title"),
        F.col("source").alias("session_title"), F.col("text").alias("full_abstract"), F.concat("lang", F.lit(";;"), "source").alias("firm"),
    )


def validations(spark: SparkSession, d: str) -> DataFrame:
    """abstract_id, validation_status; only of reviewed abstracts."""
    t = table(spark, d, "labels")
    status = F.when(F.col("toxic") == 1, "FAIL").when(F.col("quality") == 1, "PASS").otherwise("REVIEW")
    return t.select(F.col("doc_id").cast("string").alias("abstract_id"), status.alias("validation_status"))


def drugs(spark: SparkSession, d: str) -> DataFrame:
    """abstract_id, pos, drug, drug_class, class_type, severity, status, tokens."""
    line, part = table(spark, d, "lineitem"), table(spark, d, "part")
    kind = F.when(F.col("p_type") == "STANDARD", "MoA").when(F.col("p_type") == "SMALL", "Chemical").when(F.col("p_type") == "MEDIUM", "Mode").otherwise("Therapeutic")
    return line.join(part, line.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").cast("string").alias("abstract_id"), F.col("l_linenumber").alias("pos"), F.col("p_name").alias("drug"), F.col("p_brand").alias("drug_class"), kind.alias("class_type"),
        F.when(F.col("l_returnflag") == "R", "high").when(F.col("l_returnflag") == "A", "medium").otherwise("low").alias("severity"),
        F.when(F.col("l_linestatus") == "F", "success").otherwise("pending").alias("status"), F.col("l_quantity").cast("long").alias("tokens"),
    )


def attempts(spark: SparkSession, d: str) -> DataFrame:
    """abstract_id, attempt_id, step, status, duration_seconds, ts."""
    status = F.when(F.col("event_type") == "error", "failed").otherwise("success")
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("abstract_id"), F.col("event_id").alias("attempt_id"), F.col("event_type").alias("step"), status.alias("status"), F.col("value").alias("duration_seconds"), "ts"
    )


def messages(spark: SparkSession, d: str) -> DataFrame:
    """conv_id, turn, role, text."""
    return table(spark, d, "conversations").select("conv_id", "turn", "role", "text")


def search_results(spark: SparkSession, d: str) -> DataFrame:
    """page_id, url, raw_content."""
    return table(spark, d, "pages").select("page_id", "url", F.col("html").alias("raw_content"))


def firms(spark: SparkSession, d: str) -> DataFrame:
    """firm_id, name, nation, and raw: the name as it may come in a table, in one of six spellings."""
    t = table(spark, d, "supplier")
    name, k = F.col("s_name"), F.col("s_suppkey") % 6
    raw = (
        F.when(k == 0, F.concat(F.lit('["'), name, F.lit('", " Acme "]'))).when(k == 1, F.concat(F.lit("<"), F.col("s_suppkey").cast("string"), F.lit(">"), name, F.lit(" ;; Beta;;")))
        .when(k == 2, F.concat(name, F.lit(", Inc.")))
        .when(k == 3, F.concat(F.lit("[bad "), name)).when(k == 4, F.lit("  ")).otherwise(F.concat(F.lit(" "), name))
    )
    return t.select(F.col("s_suppkey").alias("firm_id"), name.alias("name"), F.col("s_nationkey").alias("nation"), raw.alias("raw"))


SQL = {
    "abstracts": "select cast(doc_id as varchar) as abstract_id, split_part(text, chr(10), 1) as abstract_title, source as session_title, text as full_abstract, concat(lang, ';;', source) as firm from documents",
    "validations": "select cast(doc_id as varchar) as abstract_id, case when toxic = 1 then 'FAIL' when quality = 1 then 'PASS' else 'REVIEW' end as validation_status from labels",
    "drugs": """select cast(l.l_orderkey as varchar) as abstract_id, l.l_linenumber as pos, p.p_name as drug, p.p_brand as drug_class,
      case p.p_type when 'STANDARD' then 'MoA' when 'SMALL' then 'Chemical' when 'MEDIUM' then 'Mode' else 'Therapeutic' end as class_type,
      case l.l_returnflag when 'R' then 'high' when 'A' then 'medium' else 'low' end as severity,
      case l.l_linestatus when 'F' then 'success' else 'pending' end as status, cast(l.l_quantity as bigint) as tokens from lineitem l join part p on p.p_partkey = l.l_partkey""",
    "attempts": "select cast(user_id as varchar) as abstract_id, event_id as attempt_id, event_type as step, case when event_type = 'error' then 'failed' else 'success' end as status, value as duration_seconds, ts from events",
    "messages": "select conv_id, turn, role, text from conversations",
    "search_results": "select page_id, url, html as raw_content from pages",
    "firms": """select s_suppkey as firm_id, s_name as name, s_nationkey as nation,
      case s_suppkey % 6 when 0 then '["' || s_name || '", " Acme "]' when 1 then '<' || s_suppkey || '>' || s_name || ' ;; Beta;;' when 2 then s_name || ', Inc.'
      when 3 then '[bad ' || s_name when 4 then '  ' else ' ' || s_name end as raw from supplier""",
}


def sql(body: str, *views: str) -> str:
    """SQL with the named views in front, each under its own name."""
    return "with " + ", ".join(f"{v} as ({SQL[v]})" for v in views) + (", " if body.lstrip().startswith("+") else " ") + body.lstrip().lstrip("+")
