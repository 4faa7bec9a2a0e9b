"""Per-key operators on ordered records: distinct, last wins, latest, nesting, ranking. All are group-wise; nothing is collected beyond a record's own lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_distinct(df: DataFrame, keys: list[str], order: list[str], value: str, name: str = "items") -> DataFrame:
    """Per key, the distinct values in order of first appearance."""
    firsts = df.groupBy(*keys, value).agg(F.min(F.struct(*order)).alias("_first"))
    items = F.array_sort(F.collect_list(F.struct("_first", value)))
    return firsts.groupBy(*keys).agg(F.transform(items, lambda x: x[value]).alias(name))


def last_wins(df: DataFrame, keys: list[str], order: list[str], values: list[str], first: str = "first_pos") -> DataFrame:
    """Per key, the values of the last row; `first` is the key's place, that of its first row."""
    last = F.max_by(F.struct(*values), F.struct(*order, *values)).alias("_last")
    return df.groupBy(*keys).agg(F.min(order[0]).alias(first), last).select(*keys, first, "_last.*")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, all columns."""
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def nested(df: DataFrame, keys: list[str], order: list[str], columns: list[str], name: str = "entries") -> DataFrame:
    """Per key, an ordered list of structs."""
    items = F.array_sort(F.collect_list(F.struct(*order, *[c for c in columns if c not in order])))
    return df.groupBy(*keys).agg(F.transform(items, lambda x: F.struct(*[x[c].alias(c) for c in columns])).alias(name))


def numbered_rows(df: DataFrame, order: list[str], name: str = "row_idx", keys: list[str] | None = None) -> DataFrame:
    """Rows numbered from 1 within a key. Without keys the number is over all rows, for tables of a bounded size only."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*(keys or [F.lit(1)])).orderBy(*order)))


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_k") <= k).drop("_k")


def top_types(df: DataFrame, keys: list[str], kind: str, priority: dict[str, int], default: int = 99) -> DataFrame:
    """Rows of the best type that a key has."""
    rank = F.coalesce(*[F.when(F.col(kind) == k, F.lit(p)) for k, p in priority.items()], F.lit(default))
    return df.withColumn("_p", rank).withColumn("_best", F.min("_p").over(Window.partitionBy(*keys))).where("_p = _best").drop("_p", "_best")


def without_parents(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct names of a key without those that another name of it contains. The comparison is within keys only."""
    names = df.select(*keys, name).distinct()
    p, c = names.alias("p"), names.alias("c")
    same = [F.col(f"p.{k}") == F.col(f"c.{k}") for k in keys]
    inside = F.col(f"c.{name}").contains(F.col(f"p.{name}")) & (F.col(f"c.{name}") != F.col(f"p.{name}"))
    condition = inside
    for s in same:
        condition = s & condition
    return p.join(c, condition, "left_anti")


def running_failures(df: DataFrame, keys: list[str], order: list[str], failed: Column, name: str = "attempt") -> DataFrame:
    """How many rows of the key have failed so far, this one included."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(failed.cast("long")).over(window))


def combined(classes: list[Column], none: str = "NA") -> Column:
    """Union of lists without missing items and `none`, stripped, distinct, sorted, joined by ;;."""
    from quillspark.functions.text import strip

    every = F.flatten(F.array(*[F.coalesce(c, F.array().cast("array<string>")) for c in classes]))
    kept = F.transform(F.filter(every, lambda x: x.isNotNull() & (x != "") & (x != none)), strip)
    return F.array_join(F.array_sort(F.array_distinct(kept)), ";;")
