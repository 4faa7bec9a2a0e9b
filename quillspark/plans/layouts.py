"""From folders of step documents to the tables that the exports take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quillspark.functions.text import first_filled, let
from quillspark.plans.export import STEPS
from quillspark.sources.documents import read_step

DETAIL = "struct<extracted_text:string,normalized_form:string,class_type:string,evidence:string,source:string,rules_applied:array<string>>"
CHECK = "struct<passed:boolean,note:string>"
DRUGS = "primary_drugs array<string>, secondary_drugs array<string>, comparator_drugs array<string>, reasoning array<string>, `Primary Drugs` array<string>, `Secondary Drugs` array<string>, `Comparator Drugs` array<string>"
DRUG_VALIDATION = (
    "validation_status string, grounded_search_performed boolean, missed_drugs array<string>, validation_reasoning string,"
    "search_results array<struct<drug_queried:string,is_therapeutic_drug:boolean,source_url:string,source_title:string,evidence:string,confidence:string>>,"
    "issues_found array<struct<check_type:string,severity:string,description:string,evidence:string,drug:string,correct_category:string,rule_reference:string>>"
)
EXTRACTION = f"struct<drug_name:string,drug_classes:array<string>,selected_sources:array<string>,confidence_score:double,extraction_details:array<{DETAIL}>,extraction_method:string,reasoning:string,success:boolean>"
SELECTION = "struct<drug_name:string,selected_drug_classes:array<string>,reasoning:string>"
STEPS_1_TO_3 = f"drug_results array<struct<drug:string,components:array<string>,extractions:map<string,{EXTRACTION}>,selections:map<string,{SELECTION}>,error:string>>"
STEP_4 = f"explicit_drug_classes array<string>, extraction_details array<{DETAIL}>, reasoning string"
STEP_5 = "refined_explicit_classes array<string>, removed_classes array<string>, reasoning string"
CLASS_VALIDATION = "results array<struct<drug_name:string,validation:struct<missed_drug_classes:array<string>>>>"
INDICATION = "selected_source string, generated_indication string, reasoning string, rules_retrieved array<struct<category:string,subcategories:array<string>,reason:string>>"
INDICATION_VALIDATION = "validation_status string, issues_found array<struct<check_type:string,severity:string,description:string,evidence:string,component:string>>, checks_performed map<string," + CHECK + ">, validation_reasoning string"
STEP = "struct<status:string,llm_calls:long,tokens:long,input_tokens:long,output_tokens:long,error:string>"
#: Where the status document holds each of STEPS.
PATHS = (
    "drug.extraction", "drug.validation", "drug_class.step1_regimen", "drug_class.step2_extraction", "drug_class.step3_selection", "drug_class.step4_explicit", "drug_class.step5_consolidation", "drug_class.validation",
    "indication.extraction", "indication.validation",
)
STATUS = (
    "abstract_title string, status string, last_updated string, metrics struct<duration_seconds:double,llm_calls:long,input_tokens:long,output_tokens:long>, errors array<string>, "
    + ", ".join(f"{p} struct<{','.join(f'{x.split('.')[1]}:{STEP}' for x in PATHS if x.startswith(p + '.'))}>" for p in ("drug", "drug_class", "indication"))
)


def _read(spark: SparkSession, data_dir: str, step: str, schema: str) -> DataFrame:
    """A step's documents; an empty table where no record has the step."""
    try:
        return read_step(spark, data_dir, step, schema)
    except AnalysisException as failure:
        if "PATH_NOT_FOUND" not in str(failure):
            raise
        return spark.createDataFrame([], f"abstract_id string, {schema}")


def merged(entries: Column) -> Column:
    """array<struct<key, items>> with one entry a key: at the place of its first, with the items of its last."""
    keys = lambda kept: F.array_distinct(F.transform(kept, lambda e: e["key"]))
    return let(F.filter(entries, lambda e: e["key"] != ""), lambda kept: F.transform(keys(kept), lambda k: F.element_at(F.filter(kept, lambda e: e["key"] == k), -1)))


def _pairs(maps: str, value: str) -> Column:
    """Entries (key, items) of a map in each of drug_results."""
    each = F.transform("drug_results", lambda r: F.transform(F.map_entries(r[maps]), lambda e: F.struct(e["key"].alias("key"), e["value"][value].alias("items"))))
    return merged(F.flatten(F.filter(each, lambda x: x.isNotNull())))


def _as_map(entries: Column) -> Column:
    return F.map_from_entries(entries)


def workflow_documents(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """The documents of drug_export, from one folder a record with one file a step."""
    # Names that differ in case only can't be in one schema.
    titled = _read(spark, data_dir, "drug_extraction", "`Reasoning` array<string>").select("abstract_id", F.col("Reasoning").alias("_reasoning"))
    drugs = _read(spark, data_dir, "drug_extraction", DRUGS).join(titled, "abstract_id", "left")
    both = lambda snake, title: first_filled(F.col(snake), F.col(f"`{title}`")).alias(snake)
    steps = _read(spark, data_dir, "drug_class_steps1_3", STEPS_1_TO_3)
    components = merged(F.transform("drug_results", lambda r: F.struct(r["drug"].alias("key"), r["components"].alias("items"))))
    missed = merged(F.transform("results", lambda r: F.struct(r["drug_name"].alias("key"), r["validation"]["missed_drug_classes"].alias("items"))))
    return {
        "drug_extraction": drugs.select("abstract_id", both("primary_drugs", "Primary Drugs"), both("secondary_drugs", "Secondary Drugs"), both("comparator_drugs", "Comparator Drugs"), both("reasoning", "_reasoning")),
        "drug_validation": _read(spark, data_dir, "drug_validation", DRUG_VALIDATION),
        "drug_class_step1": steps.select("abstract_id", components.alias("components")),
        "drug_class_step2": steps.select("abstract_id", _pairs("extractions", "drug_classes").alias("classes"), _as_map(_pairs("extractions", "extraction_details")).alias("details")),
        "drug_class_step3": steps.select("abstract_id", _pairs("selections", "selected_drug_classes").alias("selections"), _as_map(_pairs("selections", "reasoning")).alias("reasoning")),
        "drug_class_step4": _read(spark, data_dir, "drug_class_step4", STEP_4),
        "drug_class_step5": _read(spark, data_dir, "drug_class_step5", STEP_5),
        "drug_class_validation": _read(spark, data_dir, "drug_class_validation", CLASS_VALIDATION).select("abstract_id", missed.alias("missed")),
    }


def indication_documents(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    """Extraction and validation of indication_export; a record without a validation has its error from the status."""
    status = _read(spark, data_dir, "status", STATUS).select("abstract_id", F.col("indication.validation.error").alias("error"))
    validation = _read(spark, data_dir, "indication_validation", INDICATION_VALIDATION)
    return _read(spark, data_dir, "indication_extraction", INDICATION), validation.join(status, "abstract_id", "full")


def status_tables(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    """base and steps of metrics_export."""
    s = _read(spark, data_dir, "status", STATUS)
    m = lambda name, alias: F.col(f"metrics.{name}").alias(alias)
    base = s.select("abstract_id", "abstract_title", F.col("status").alias("overall_status"), "last_updated", m("duration_seconds", "duration_seconds"), m("llm_calls", "total_llm_calls"), m("input_tokens", "total_input_tokens"), m("output_tokens", "total_output_tokens"), "errors")
    steps = s.select("abstract_id", F.explode(F.array(*[F.struct(F.lit(n).alias("step"), F.col(p).alias("s")) for n, p in zip(STEPS, PATHS, strict=True)])).alias("x"))
    return base, steps.select("abstract_id", "x.step", "x.s.*").where("status is not null")
