"""Model-backed steps behind one interface: replayed from records, computed by rules, or called from outside."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.sources.scratch import scratch_path, written


class Provider(Protocol):
    def __call__(self, requests: DataFrame) -> DataFrame:
        """requests: abstract_id and the inputs; returns abstract_id, response (JSON text), error."""


def replay(recorded: DataFrame) -> Provider:
    """Answers from a table of abstract_id and response; what was never recorded is an error."""

    def run(requests: DataFrame) -> DataFrame:
        both = requests.select("abstract_id").join(recorded.select("abstract_id", "response"), "abstract_id", "left")
        return both.withColumn("error", F.when(F.col("response").isNull(), "no recorded response"))

    return run


def by_rules(response: Column) -> Provider:
    """Answers with an expression over the request's columns."""

    def run(requests: DataFrame) -> DataFrame:
        return requests.select("abstract_id", F.to_json(response).alias("response"), F.lit(None).cast("string").alias("error"))

    return run


def external(call: Callable[[list[dict]], list[str]], partitions: int | None = None) -> Provider:
    """Calls out in batches from executors; a failed batch gives errors, not a failed job. partitions bounds the concurrency."""

    def run(requests: DataFrame) -> DataFrame:
        def batches(frames: Iterator) -> Iterator:
            for pdf in frames:
                out = pdf[["abstract_id"]].copy()
                try:
                    out["response"], out["error"] = call(pdf.to_dict("records")), None
                except Exception as failure:  # noqa: BLE001  reported as the row's error
                    out["response"], out["error"] = None, str(failure)
                yield out

        spread = requests.repartition(partitions) if partitions else requests
        return spread.mapInPandas(batches, "abstract_id string, response string, error string")

    return run


def short_circuit(rows: DataFrame, known: Column, answer: Column, provider: Provider) -> DataFrame:
    """Rows whose answer is known don't reach the provider: the branches are split before it."""
    direct = rows.where(known).select("abstract_id", F.to_json(answer).alias("response"), F.lit(None).cast("string").alias("error"))
    return direct.unionByName(provider(rows.where(~known)))


def agent_loop(rows: DataFrame, step: Callable[[DataFrame], DataFrame], done: Column, most: int = 100) -> DataFrame:
    """Repeats a step on the rows that aren't done, up to `most` times; all rows come back.

    Each round's rows are written once: those that are done to a folder that is read when all rounds are over, the others for the next round.
    """
    path = scratch_path(rows.sparkSession, "rounds")
    rows.where(done).write.parquet(f"{path}/round=0")
    rest, folders = rows.where(~done), [f"{path}/round=0"]
    for k in range(1, most + 1):
        if rest.isEmpty():
            break
        ran = written(step(rest), "round")  # a round's calls are made once, not again by each later one
        folders.append(f"{path}/round={k}")
        ran.where(done).write.parquet(folders[-1])
        rest = ran.where(~done)
    return rows.sparkSession.read.schema(rows.schema).parquet(*folders).unionByName(rest)


# The most batches of a kind of step that call out at the same time.
CONCURRENT = {"drug": 15, "drug_class": 10, "indication_extraction": 20, "indication_validation": 5, "checkpoint": 50}


def capped(call: Callable[[list[dict]], list[str]], kind: str) -> Provider:
    """external() with the concurrency that its kind of step allows: one task a batch in flight."""
    return external(call, CONCURRENT[kind])


def metered(provider: Provider, tokens: Callable[[Column], Column]) -> Callable[[DataFrame], DataFrame]:
    """abstract_id, output, llm_calls, tokens, error: the answer as JSON with what it cost inside, as steps hand it on, and taken out again.

    tokens: what an answer costs. A failed call costs one call and no tokens.
    """

    def run(requests: DataFrame) -> DataFrame:
        answers = provider(requests)
        cost = F.when(F.col("response").isNotNull(), tokens(F.col("response"))).otherwise(F.lit(0)).cast("long")
        wire = F.to_json(F.struct(F.col("response").alias("value"), F.lit(1).alias("_llm_calls"), cost.alias("_token_usage")))
        read = F.from_json(wire, "value string, _llm_calls long, _token_usage long")
        return answers.select("abstract_id", read["value"].alias("output"), F.coalesce(read["_llm_calls"], F.lit(1)).alias("llm_calls"), read["_token_usage"].alias("tokens"), "error")

    return run


def guarded(provider: Provider) -> Callable[[DataFrame], DataFrame]:
    """abstract_id, validation_status, issues: a validation that never stops a batch; one that fails is a REVIEW with a system_error."""

    def run(requests: DataFrame) -> DataFrame:
        issue = F.struct(F.lit("system_error").alias("check_type"), F.lit("high").alias("severity"), F.col("error").alias("description"))
        none = F.array().cast("array<struct<check_type:string,severity:string,description:string>>")
        answers = provider(requests)
        return answers.select("abstract_id", F.coalesce("response", F.lit("REVIEW")).alias("validation_status"), F.when(F.col("error").isNotNull(), F.array(issue)).otherwise(none).alias("issues"))

    return run


# Why nothing was consolidated.
NO_EXPLICIT, NO_SELECTIONS = "No explicit drug classes to consolidate.", "No drug selections to compare against."


def consolidated(explicit: Column, selections: Column) -> Column:
    """What is known without a call: NA without explicit classes, those as they are without selections; else null.

    struct<refined, removed, reasoning>.
    """
    none = F.array().cast("array<string>")
    answer = lambda refined, why: F.struct(refined.alias("refined"), none.alias("removed"), F.lit(why).alias("reasoning"))
    empty = explicit.isNull() | (F.size(explicit) <= 0) | (explicit == F.array(F.lit("NA")))
    return F.when(empty, answer(F.array(F.lit("NA")), NO_EXPLICIT)).when(selections.isNull() | (F.size(selections) <= 0), answer(explicit, NO_SELECTIONS))
