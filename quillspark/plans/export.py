"""Wide exports for review: one scan a step, left joins on the record, one projection, no Python code on the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import first_filled, keyed_lines, listed, or_empty, pretty_json
from quillspark.operators.records import combined
from quillspark.sources.sinks import validation_text

# The ten steps of a record's status, and what is known of each.
STEPS = ("drug_extraction", "drug_validation", "drug_class_step1", "drug_class_step2", "drug_class_step3", "drug_class_step4", "drug_class_step5", "drug_class_validation", "indication_extraction", "indication_validation")
METRICS = ("status", "llm_calls", "input_tokens", "output_tokens", "tokens")
BASE = ("abstract_id", "abstract_title", "overall_status", "last_updated", "duration_seconds", "total_llm_calls", "total_input_tokens", "total_output_tokens")


def _documents(rows: DataFrame, documents: dict[str, DataFrame]) -> DataFrame:
    """rows with a struct column a step; null where a record lacks the step. Repeated records in rows stay; a step has one document a record.

    The documents of all steps are one union, merged by record with one shuffle; rows are dealt in the same way and joined where they meet.
    """
    structs = {step: F.struct(*[c for c in df.columns if c != "abstract_id"]).alias(step) for step, df in documents.items()}
    kinds = {step: df.select(structs[step]).schema[0].dataType for step, df in documents.items()}
    tagged = [df.select(F.col("abstract_id").alias("_record"), *[structs[s] if s == step else F.lit(None).cast(kinds[s]).alias(s) for s in documents]) for step, df in documents.items()]
    merged = reduce(DataFrame.unionByName, tagged).groupBy("_record").agg(*[F.first(s, ignorenulls=True).alias(s) for s in documents])
    return rows.join(merged, rows.abstract_id == F.col("_record"), "left").drop("_record")


def _classes(entries: Column) -> Column:
    return F.flatten(F.transform(entries, lambda e: e["items"]))


def drug_export(abstracts: DataFrame, documents: dict[str, DataFrame]) -> DataFrame:
    """The input's columns, then the 22 of the drug and drug-class review, in fixed order.

    documents: by step, tables with abstract_id and
    drug_extraction (primary_drugs, secondary_drugs, comparator_drugs, reasoning), drug_validation (validation_status, grounded_search_performed, search_results, missed_drugs, issues_found, validation_reasoning),
    drug_class_step1 (components), _step2 (classes, details), _step3 (selections, reasoning), _step4 (explicit_drug_classes, extraction_details), _step5 (refined_explicit_classes, removed_classes, reasoning),
    drug_class_validation (missed). Maps are ordered: array<struct<key, items>>; details and reasoning of a step are maps or lists, shown as JSON.
    """
    return drug_columns(_documents(abstracts, documents), abstracts.columns)


def drug_columns(rows: DataFrame, columns_of_input: list[str]) -> DataFrame:
    """The columns of drug_export, of rows that have the documents of their steps as structs."""
    c = F.col

    def json_text(value: Column) -> Column:
        return pretty_json(value, rows.select(value).schema[0].dataType)

    columns = {
        "drug_extraction_primary_drugs": listed(c("drug_extraction.primary_drugs")),
        "drug_extraction_secondary_drugs": listed(c("drug_extraction.secondary_drugs")),
        "drug_extraction_comparator_drugs": listed(c("drug_extraction.comparator_drugs")),
        "drug_extraction_reasoning": json_text(c("drug_extraction.reasoning")),
        "drug_validation_status": or_empty(c("drug_validation.validation_status")),
        "drug_validation_grounded_search_performed": or_empty(c("drug_validation.grounded_search_performed").cast("string")),
        "drug_validation_search_results": json_text(c("drug_validation.search_results")),
        "drug_validation_missed_drugs": listed(c("drug_validation.missed_drugs")),
        "drug_validation_issues_found": json_text(c("drug_validation.issues_found")),
        "drug_validation_reasoning": or_empty(c("drug_validation.validation_reasoning")),
        "drug_class_step1_drug_to_components": keyed_lines(c("drug_class_step1.components")),
        "drug_class_step2_drug_classes": keyed_lines(c("drug_class_step2.classes")),
        "drug_class_step2_extraction_details": json_text(c("drug_class_step2.details")),
        "drug_class_step3_selected_drug_classes": keyed_lines(c("drug_class_step3.selections")),
        "drug_class_step3_reasoning": json_text(c("drug_class_step3.reasoning")),
        "drug_class_step4_explicit_drug_classes": listed(c("drug_class_step4.explicit_drug_classes")),
        "drug_class_step4_extraction_details": json_text(c("drug_class_step4.extraction_details")),
        "drug_class_step5_refined_explicit_classes": listed(c("drug_class_step5.refined_explicit_classes")),
        "drug_class_step5_removed_classes": listed(c("drug_class_step5.removed_classes")),
        "drug_class_step5_reasoning": or_empty(c("drug_class_step5.reasoning")),
        "drug_class_combined_all_classes": combined([_classes(c("drug_class_step3.selections")), c("drug_class_step5.refined_explicit_classes")]),
        "drug_class_validation_missed_drug_classes": keyed_lines(c("drug_class_validation.missed"), skip_empty=True),
    }
    return rows.select(*[F.col(f"`{x}`") for x in columns_of_input], *[e.alias(n) for n, e in columns.items()])


def indication_export(abstracts: DataFrame, extraction: DataFrame, validation: DataFrame) -> DataFrame:
    """The input's columns, then 4 of the extraction and 4 of the validation."""
    rows = _documents(abstracts, {"e": extraction, "v": validation})
    c = F.col

    def json_text(value: Column) -> Column:
        return pretty_json(value, rows.select(value).schema[0].dataType)

    return rows.select(
        *[F.col(f"`{x}`") for x in abstracts.columns],
        or_empty(c("e.selected_source")).alias("extraction_selected_source"), or_empty(c("e.generated_indication")).alias("extraction_generated_indication"),
        or_empty(c("e.reasoning")).alias("extraction_reasoning"), json_text(c("e.rules_retrieved")).alias("extraction_rules_retrieved"),
        validation_text(c("v.validation_status"), c("v.error")).alias("validation_status"), json_text(c("v.issues_found")).alias("validation_issues_found"),
        json_text(c("v.checks_performed")).alias("validation_checks_performed"), or_empty(c("v.validation_reasoning")).alias("validation_reasoning"),
    )


def metrics_export(base: DataFrame, steps: DataFrame) -> DataFrame:
    """One row a record: BASE, METRICS of each of STEPS as cells (empty for none), errors: 59 columns. base has BASE and errors (array); steps is long: abstract_id, step, METRICS. Records without a status are left out."""
    wide = steps.groupBy("abstract_id").pivot("step", list(STEPS)).agg(*[F.first(m).alias(m) for m in METRICS])
    rows = base.join(wide, "abstract_id", "left")
    return rows.select(*BASE, *[or_empty(F.col(f"{s}_{m}").cast("string")).alias(f"{s}_{m}") for s in STEPS for m in METRICS], F.when(F.size("errors") > 0, pretty_json(F.col("errors"), "array<string>")).otherwise("").alias("errors"))


def nested_get(document: Column, path: str) -> Column:
    """A dotted path in JSON text; null where a part is missing or no object."""
    return F.get_json_object(document, "$." + path)


def aliased(document: Column, snake: str, title: str) -> Column:
    """A list under either spelling of its name; an empty list falls through to the other."""
    one = lambda name: F.from_json(F.get_json_object(document, f"$['{name}']"), "array<string>")
    return first_filled(one(snake), one(title))


def search_outcome(found: Column, none_found: Column | bool = False) -> Column:
    """Names (NA for none), distinct sources, details and success of array<struct<name, url>>. none_found: what the search itself says."""
    names = F.filter(F.transform(found, lambda x: x["name"]), lambda n: n != "")
    empty = (F.lit(none_found) if isinstance(none_found, bool) else none_found) | (F.coalesce(F.size(found), F.lit(0)) <= 0)
    details = F.transform(found, lambda x: F.struct(x["name"].alias("extracted_text"), x["name"].alias("normalized_form"), x["url"].alias("source")))
    return F.struct(
        F.when(~empty & (F.size(names) > 0), names).otherwise(F.array(F.lit("NA"))).alias("names"),
        F.when(~empty, F.array_distinct(F.filter(F.transform(found, lambda x: x["url"]), lambda u: u != ""))).otherwise(F.array().cast("array<string>")).alias("sources"),
        F.when(~empty, details).otherwise(F.slice(details, 1, 0)).alias("details"), (~empty & (F.size(names) > 0)).alias("success"),
    )


def explicit_outcome(found: Column) -> Column:
    """Explicit classes: NA for none, and the source is the title."""
    names = F.transform(found, lambda x: x["name"])
    return F.struct(F.when(F.size(names) > 0, names).otherwise(F.array(F.lit("NA"))).alias("classes"), F.lit("abstract_title").alias("source"))
