"""Incremental work: compute only what no table holds yet, fill caches, fall back."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.sources.scratch import written

Step = Callable[[DataFrame], DataFrame]


def memoised(inputs: DataFrame, done: DataFrame, keys: list[str], step: Step, succeeded: Column | None = None, save: Callable[[DataFrame, str], DataFrame] = written) -> tuple[DataFrame, DataFrame]:
    """All results, and the new ones that are to be kept. Inputs with a kept result are not computed again; failures aren't kept."""
    new = save(step(inputs.join(done.select(*keys), keys, "left_anti")), "computed")  # once, however often both results are read
    kept = new if succeeded is None else new.where(succeeded)
    return done.join(inputs.select(*keys), keys, "left_semi").unionByName(new), kept


def resumable(items: DataFrame, kept: DataFrame, keys: list[str], item: str, steps: dict[str, Step], save: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """keys, item, step, status, computed (now, not kept) of the steps that records reach, each over all records before the next.

    A step gets the items without a success in kept (keys, item, step, status), of records that passed the steps before it, and adds `status`.
    A failed item doesn't stop the others of its step, but its record ends there; so does an item without an answer.
    save writes the new results of a step and returns them as read again: the barrier, and what a later run resumes from.
    """
    at, live, found = [*keys, item], items.select(*keys, item), []
    for name, step in steps.items():
        done = kept.where((F.col("step") == name) & (F.col("status") == "success")).select(*at, "status", F.lit(False).alias("computed")).distinct()
        results, _ = memoised(live, done, at, lambda new: step(new).select(*at, "status", F.lit(True).alias("computed")), save=lambda new, _: save(new, name))  # noqa: B023
        found.append(results.withColumn("step", F.lit(name)))
        stopped = live.join(results.where("status = 'success'"), at, "left_anti").select(*keys).distinct()
        live = written(live.join(stopped, keys, "left_anti"), "live")
    return reduce(DataFrame.unionByName, found)


def workflow(records: DataFrame, kept: DataFrame, keys: list[str], pipelines: dict[str, tuple[Step, str | None]], save: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """keys, the outcome of each pipeline, and status: failed after an exception, partial_success with errors, else success.

    pipelines: name -> what adds `status` (success, error, exception) and `output` (a list), and the pipeline whose output it needs, if any.
    A pipeline with a success in kept (keys, pipeline, status, output) is complete and not run; one without its needed output is skipped.
    After an exception, which no answer also is, a record runs nothing more (not_run); after an error it goes on. save is that of `resumable`.
    """
    state, live, outputs = records.select(*keys), records.select(*keys), {}
    for name, (step, needed) in pipelines.items():
        done = kept.where((F.col("pipeline") == name) & (F.col("status") == "success")).select(*keys, F.lit("complete").alias("status"), "output")
        wanted = live if needed is None else live.join(outputs[needed].where(F.size("output") > 0), keys, "left_semi")
        results, _ = memoised(wanted, done, keys, lambda new: step(new).select(*keys, "status", "output"), save=lambda new, _: save(new, name))  # noqa: B023
        outputs[name] = written(wanted.join(results, keys, "left").withColumn("status", F.coalesce("status", F.lit("exception"))), name)
        reached = live.join(outputs[name].select(*keys, "status"), keys, "left").select(*keys, F.coalesce("status", F.lit("skipped")).alias(name))
        state = state.join(reached, keys, "left").withColumn(name, F.coalesce(name, F.lit("not_run")))
        live = written(reached.where(F.col(name) != "exception").select(*keys), "live")
    any_of = lambda what: F.array_contains(F.array(*pipelines), what)
    return state.withColumn("status", F.when(any_of("exception"), "failed").when(any_of("error"), "partial_success").otherwise("success"))


def cached_lookup(wanted: DataFrame, cache: DataFrame, keys: list[str], results: str, fetch: Step) -> tuple[DataFrame, DataFrame]:
    """Results of all wanted keys, and what was fetched. A cached empty list counts as missing. Each missing key is fetched once."""
    full = cache.where(F.size(results) > 0)
    keyed = wanted.select(*keys).distinct()
    fetched = written(fetch(keyed.join(full.select(*keys), keys, "left_anti")), "fetched")  # once, however often both results are read
    return keyed.join(full, keys).unionByName(fetched), fetched


def standalone(items: DataFrame, keys: list[str], item: str, step: Step) -> DataFrame:
    """A step by itself, without checkpoints: keys, item, output of the records of which every item succeeded; of the others nothing is kept.

    step adds `status` and `output` to the items. An item without an answer counts as failed.
    """
    results = written(step(items.select(*keys, item)).select(*keys, item, "status", "output"), "standalone")
    failed = items.select(*keys, item).join(results.where("status = 'success'"), [*keys, item], "left_anti").select(*keys).distinct()
    return results.join(failed, keys, "left_anti").select(*keys, item, "output")


def transition(step: Column, outcome: Column, at: Column, calls: Column, error: Column) -> Column:
    """A step's status record after an outcome: running, success or failed set what belongs to them, and a success clears an error.

    step: struct<status, llm_calls, started_at, completed_at, failed_at, error, attempts>, or null for none yet.
    """
    old = lambda f: step[f]
    ran, ok, bad = (outcome == s for s in ("running", "success", "failed"))
    return F.struct(
        outcome.alias("status"), calls.alias("llm_calls"), F.when(ran, at).otherwise(old("started_at")).alias("started_at"), F.when(ok, at).otherwise(old("completed_at")).alias("completed_at"),
        F.when(bad, at).otherwise(old("failed_at")).alias("failed_at"), F.when(bad, error).when(~ok, old("error")).alias("error"), (F.coalesce(old("attempts"), F.lit(0)) + bad.cast("int")).alias("attempts"),
    )


def resumed(status: Column) -> tuple[Column, Column]:
    """A record's status and errors when it is taken up again: running, without the errors of the run before; pending without a status."""
    return F.when(status.isNotNull(), "running").otherwise("pending"), F.array().cast("array<string>")


def fallback(rows: DataFrame, classes: str, second: Step) -> DataFrame:
    """Rows with no class, or only NA, go through `second`; the others pass. The branches are split, so `second` never sees the others."""
    empty = (F.size(classes) <= 0) | (F.col(classes) == F.array(F.lit("NA"))) | F.col(classes).isNull()
    return rows.where(~empty).unionByName(second(rows.where(empty)))


def upsert(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Current rows, those with a change replaced by it."""
    return current.join(changes.select(*keys), keys, "left_anti").unionByName(changes)


def backoff(attempt: Column, first: float, factor: float, most: float) -> Column:
    """Seconds to wait before attempt 1, 2, ...: growing by a factor up to a limit."""
    return F.least(F.lit(first) * F.pow(F.lit(factor), attempt - 1), F.lit(most))
