"""Status: what is pending, what comes next, counts by outcome, totals over steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN = ("pending", "running", "failed")
SEVERITY = {"low": 1, "medium": 1, "high": 2}


def pending(rows: DataFrame, status: DataFrame, key: str, column: str = "status") -> DataFrame:
    """Rows without a successful status: a left-anti join with the successes."""
    return rows.join(status.where(F.col(column) == "success").select(key), key, "left_anti")


def ready(rows: DataFrame, status: DataFrame, key: str, before: str, after: str) -> DataFrame:
    """Rows whose step `before` succeeded and `after` didn't yet."""
    return rows.join(status.where((F.col(before) == "success") & ~F.col(after).eqNullSafe("success")).select(key), key, "left_semi")


def next_step(steps: dict[str, Column]) -> Column:
    """The first step that is pending, running or failed; else complete. Unknown statuses count as passed."""
    return F.coalesce(*[F.when(s.isin(*OPEN), F.lit(name)) for name, s in steps.items()], F.lit("complete"))


def outcome(status: Column) -> Column:
    """Three-way: none is not processed, and all but success is failed, pending included."""
    return F.when(status.isNull(), "not_processed").when(status == "success", "success").otherwise("failed")


def census(rows: DataFrame, status: DataFrame, key: str, column: str = "status") -> DataFrame:
    """One row: counts of outcomes."""
    o = outcome(F.col(column))
    return rows.join(status.select(key, column), key, "left").agg(*[F.count_if(o == name).alias(name) for name in ("success", "failed", "not_processed")])


def tally(rows: DataFrame, keys: list[str], column: str = "validation_status") -> DataFrame:
    """Counts of PASS, REVIEW, FAIL and others per key, and whether all succeeded (true for none)."""
    s = F.col(column)
    named = s.isin("PASS", "REVIEW", "FAIL")
    return rows.groupBy(*keys).agg(*[F.count_if(s == n).alias(n.lower()) for n in ("PASS", "REVIEW", "FAIL")], F.count_if(~named | s.isNull()).alias("error"), F.coalesce(F.bool_and(named), F.lit(True)).alias("all_success"))


def severity_status(rows: DataFrame, keys: list[str], severity: str = "severity") -> DataFrame:
    """PASS without issues, REVIEW with low or medium ones at most, FAIL with a high one."""
    worst = F.max(F.coalesce(*[F.when(F.col(severity) == s, F.lit(r)) for s, r in SEVERITY.items()], F.lit(0)))
    return rows.groupBy(*keys).agg(F.when(worst == 2, "FAIL").when(worst == 1, "REVIEW").otherwise("PASS").alias("validation_status"))


def totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Calls and tokens of the steps that succeeded."""
    ok = F.col("status") == "success"
    return rows.groupBy(*keys).agg(F.count_if(ok).alias("llm_calls"), F.coalesce(F.sum(F.when(ok, F.col("tokens"))), F.lit(0)).alias("tokens"))


def all_done(items: Column, succeeded: Column) -> Column:
    """Whether each item is among those that succeeded; true for none."""
    return F.forall(items, lambda x: F.array_contains(succeeded, x))


def still_open(items: Column, succeeded: Column) -> Column:
    """Items not among those that succeeded, in order."""
    return F.filter(items, lambda x: ~F.array_contains(succeeded, x))


def batch_update(now: DataFrame, before: DataFrame) -> DataFrame:
    """A one-row batch status brought up to date with the one before it: counts are new, durations add up, the first start stays."""
    b = before.select(F.col("duration_seconds").alias("_d"), F.col("started_at").alias("_s"))
    both = now.join(b, how="left")
    return both.select(*[c for c in now.columns if c not in ("duration_seconds", "started_at")], F.round(F.col("duration_seconds") + F.coalesce("_d", F.lit(0.0)), 2).alias("duration_seconds"), F.coalesce("_s", "started_at").alias("started_at"))
