"""Retries that outlive a job: a log of attempts, and a loop that takes only what is due.

Every round writes the outcomes of the rows it tried, as a part of the log of its own, before anything reads them. So a step is called once an
attempt, and a run that starts again reads the log and goes on: rows that are done or given up stay so, others wait until they are due.
A round costs what is due in it; rows that wait are kept apart and aren't tried.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.incremental import Step, backoff
from quillspark.operators.records import latest
from quillspark.sources.scratch import written


@dataclass(frozen=True)
class Policy:
    """Seconds before the second attempt, the factor by which waits grow, the longest wait, the most attempts, and errors that no retry mends."""

    first: float
    factor: float
    most: float
    attempts: int
    fatal: tuple[str, ...] = ()


# The policy of each kind of work.
POLICIES = {
    "storage": Policy(1, 2.0, 10, 3, ("ValueError", "PermissionError")),
    "fast_llm": Policy(5, 2.0, 30, 3, ("ValueError", "ValidationError")),
    "slow_llm": Policy(15, 2.0, 60, 2, ("ValueError", "ValidationError")),
    "search": Policy(2, 2.0, 15, 3, ("ValueError",)),
}


class Clock:
    """The time in seconds, and how to wait for a later one."""

    def now(self) -> float:
        return time.time()

    def wait_until(self, due: float) -> None:
        time.sleep(max(0.0, due - self.now()))


class Jumping(Clock):
    """A clock that jumps to where it is told to wait: for tests, and for work whose time is recorded elsewhere."""

    def __init__(self, start: float = 0.0) -> None:
        self.time = start

    def now(self) -> float:
        return self.time

    def wait_until(self, due: float) -> None:
        self.time = max(self.time, due)


def _by_policy(kind: Column, policies: dict[str, Policy], value: Callable[[Policy], Column]) -> Column:
    return F.coalesce(*[F.when(kind == name, value(p)) for name, p in policies.items()])


def outcome(kind: Column, attempt: Column, error: Column, now: Column, policies: dict[str, Policy]) -> tuple[Column, Column]:
    """The state after an attempt (done, gave_up, waiting) and when the next one is due. A kind without a policy is tried once."""
    last = F.coalesce(_by_policy(kind, policies, lambda p: F.lit(p.attempts)), F.lit(1))
    fatal = F.coalesce(_by_policy(kind, policies, lambda p: error.isin(*p.fatal) if p.fatal else F.lit(False)), F.lit(False))
    state = F.when(error.isNull(), "done").when(fatal | (attempt >= last), "gave_up").otherwise("waiting")
    wait = _by_policy(kind, policies, lambda p: backoff(attempt, p.first, p.factor, p.most))
    return state, F.when(state == "waiting", now + wait)


def attempts(spark: SparkSession, path: str) -> DataFrame | None:
    """The log: keys, kind, attempt, at, error, state, due, round; null if there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def retried(items: DataFrame, keys: list[str], kind: str, step: Step, path: str, policies: dict[str, Policy] = POLICIES, clock: Clock | None = None, most_rounds: int = 1000) -> DataFrame:
    """keys, kind, attempts, state, error and at (of the last attempt) of all items; `waiting` ones are left only after most_rounds.

    step adds `error` to items that are due: null for a success, else the error's type; an item that it doesn't return is a lost call. path: of the log.
    """
    clock, spark = clock or Clock(), items.sparkSession
    log = attempts(spark, path)
    tried = None if log is None else latest(log, keys, ["attempt"]).drop("round")
    fresh = items if tried is None else items.join(tried.select(*keys), keys, "left_anti")
    begun = fresh.withColumns({"_attempt": F.lit(0), "_due": F.lit(0.0)})
    if tried is not None:
        waits = items.join(tried.where("state = 'waiting'").select(*keys, F.col("attempt").alias("_attempt"), F.col("due").alias("_due")), keys)
        begun = begun.unionByName(waits)
    number = 0 if log is None else log.agg(F.max("round")).first()[0] + 1
    open_ = written(begun, "open")
    for k in range(number, number + most_rounds):
        soonest = open_.agg(F.min("_due")).first()[0]
        if soonest is None:
            break
        clock.wait_until(soonest)
        now = clock.now()
        due = open_.where(F.col("_due") <= now)
        answers = step(due.drop("_attempt", "_due")).select(*keys, "error", F.lit(True).alias("_answered"))
        results = due.join(answers, keys, "left").withColumn("error", F.when(F.col("_answered"), F.col("error")).otherwise("LostCall"))
        attempt = F.col("_attempt") + 1
        state, again = outcome(F.col(kind), attempt, F.col("error"), F.lit(now), policies)
        results.select(*keys, F.col(kind).alias("kind"), attempt.alias("attempt"), F.lit(now).alias("at"), "error", state.alias("state"), again.alias("due")).write.mode("overwrite").parquet(f"{path}/round={k}")
        tried_now = spark.read.parquet(f"{path}/round={k}").where("state = 'waiting'").select(*keys, F.col("attempt").alias("_attempt"), F.col("due").alias("_due"))
        still = due.drop("_attempt", "_due").join(tried_now, keys)
        open_ = written(open_.where(F.col("_due") > now).unionByName(still), "open")
    log = attempts(spark, path)
    if log is None:
        return items.limit(0).select(*keys, F.col(kind).alias("kind"), F.lit(0).alias("attempts"), F.lit("").alias("state"), F.lit("").alias("error"), F.lit(0.0).alias("at"))
    return latest(log, keys, ["attempt"]).select(*keys, "kind", F.col("attempt").alias("attempts"), "state", "error", "at")
