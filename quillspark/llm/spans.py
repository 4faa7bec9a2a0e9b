"""Spans of regular expressions in texts, as Column expressions: no Python code runs on the data.

A span is struct<kind, start, stop>, in code points, stop exclusive. Matches are leftmost and non-overlapping.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sums are run up in blocks of so many, since appending to an array copies it.
RUN = 256


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value worked out once: an expression that a lambda refers to is worked out anew for each element."""
    return F.element_at(F.transform(F.array(value), then), 1)


def before(lengths: Column) -> Column:
    """Of each element, the sum of those before it, in time proportional to them."""
    blocks = lambda own: F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / RUN).cast("int")), lambda b: F.slice(own, b * RUN + 1, RUN))
    total = lambda block: F.aggregate(block, F.lit(0), lambda s, x: s + x)
    bases = lambda own: F.aggregate(F.transform(own, total), F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    run = lambda block, base: F.slice(F.aggregate(block, F.array(base), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))), 1, F.size(block))
    summed = lambda own, base: F.flatten(F.transform(own, lambda block, i: run(block, F.element_at(base, i + 1))))
    of_blocks = lambda own: bound(bases(own), lambda base: summed(own, base))
    return bound(lengths, lambda own: F.when(F.size(own) > 0, bound(blocks(own), of_blocks)).otherwise(F.array().cast("array<int>")))


def with_matches(df: DataFrame, name: str, text: str, pattern: str, gate: Column) -> DataFrame:
    """Adds `name`: array of struct<start, stop, found> of the matches of pattern. gate: a cheap condition that every text with a match meets."""
    found, rest, sums = f"{name}__found", f"{name}__rest", f"{name}__before"
    df = df.withColumn(found, F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    df = df.withColumn(rest, F.when(F.size(found) > 0, F.slice(F.split(text, pattern, -1), 1, F.size(found))).otherwise(F.array().cast("array<string>")))
    df = df.withColumn(sums, before(F.zip_with(F.col(rest), F.col(found), lambda r, m: F.length(r) + F.length(m))))
    both = F.zip_with(F.zip_with(F.col(rest), F.col(sums), lambda r, b: F.length(r) + b), F.col(found), lambda start, m: F.struct(start.alias("start"), (start + F.length(m)).alias("stop"), m.alias("found")))
    return df.withColumn(name, both).drop(found, rest, sums)


def spans_of(name: str, kind: str, keep=None) -> Column:
    """The matches in column `name` for which keep(found) holds, as spans of `kind`."""
    matches = F.filter(F.col(name), lambda m: keep(m["found"])) if keep else F.col(name)
    return F.transform(matches, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["stop"].alias("stop")))


def listed(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:stop by start, then by the order of kinds, joined by commas."""
    order = F.array(*[F.lit(k) for k in kinds])
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def same_row(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on doc_id, where null equals null, and version."""
    other = right.withColumnRenamed("doc_id", "_id").withColumnRenamed("version", "_version")
    return left.join(other, left.doc_id.eqNullSafe(other._id) & (left.version == other._version), how).drop("_id", "_version")
