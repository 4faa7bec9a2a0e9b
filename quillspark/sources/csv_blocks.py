"""CSV with quoted line breaks, read by all tasks.

The text reader cuts a file into byte ranges, and a task can't know whether its range begins inside a quoted cell. So a first scan finds, for each
range and either beginning, how it ends: a range is a function from state to state. Composed along a file, these
functions give every range its true beginning. A second scan then makes records of the lines of each range; records that cross from one range
into others, at most two pieces a range, are put together by one small shuffle. Nothing else moves.

A quote opens a cell only where a cell begins, and closes it before a comma or the line's end, as Spark's reader has it with quote and escape
both '"'. Lines end with \\n or \\r\\n; files are UTF-8, with or without a byte-order mark, and each begins with its header. Compressed files can't be cut and are one range.
A carriage return at a record's end belongs to the line end, also where the reader for whole files, which guesses line ends, keeps it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_QUOTED, _BARE = r'"[^"]*+(?:""[^"]*+)*+"[^,]*+', r'[^",][^,]*+'
#: A line that begins outside quotes and ends inside them.
_OPENS = re.compile(rf'(?:(?:{_QUOTED}|{_BARE})?,)*+"[^"]*+(?:""[^"]*+)*+', re.DOTALL)
LAST = (1 << 63) - 1
_RANGE = "file string, block long"
_STATES = f"{_RANGE}, first long, ends_open boolean, still_open boolean, closes long, opens long, reopens long"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that begins inside or outside quotes ends inside them."""
    if '"' not in line:
        return inside
    return _OPENS.fullmatch(f'"{line}' if inside else line) is not None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (the first byte of its range), at (grows along a range, the same in every scan), line."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def _bare(line: str) -> str:
    return line.lstrip("﻿").rstrip("\r")


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range: its first line with text, how it ends if it begins outside quotes (ends_open, opens: the first line of the record left
    open) or inside (still_open, closes: the line that ends the record it begins in, reopens).
    """
    now, row = None, []

    def out() -> pa.RecordBatch:
        first, (o, opens), (i, closes, reopens) = row
        cells = [*now, first, o, i, closes, opens if o else None, reopens if i else None]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds, strict=True)], names=[c.split()[0] for c in _STATES.split(", ")])

    for batch in batches:
        for file, block, at, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, block) != now:
                if now:
                    yield out()
                now, row = (file, block), [None, (False, None), (True, None, None)]
                line = line.lstrip("﻿") if block == 0 else line
            first, (o, opens), (i, closes, reopens) = row
            if first is None and _bare(line):
                first = at
            after = ends_inside(line, o)
            outside = (after, at if after and not o else opens)
            after = ends_inside(line, i)
            inside = (after, at if closes is None and not after else closes, at if closes is not None and after and not i else reopens)
            row = [first, outside, inside]
    if now:
        yield out()


def _chained(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range of a file: the last line that still belongs to the record of `head_of`, and the first of the record that it leaves open."""
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["block"])
    inside, owner, out = False, None, []
    for r in rows:
        if not inside:
            head, tail, inside = -1, r["opens"], r["ends_open"]
        elif r["closes"] is None:
            head, tail = LAST, None
        else:
            head, tail, inside = r["closes"], r["reopens"], r["still_open"]
        out.append((r["file"], r["block"], r["first"] if r["block"] == 0 else None, head, owner, LAST if tail is None else tail))
        owner = None if not inside else owner if head == LAST else r["block"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["file", "block", "first", "head", "head_of", "tail"])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that lie within a range, each with its first line's place."""
    now, inside, open_, begun = None, False, [], None
    for batch in batches:
        places, texts, of = [], [], []
        for k, (file, block, at, line) in enumerate(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
            if (file, block) != now:
                now, inside, open_ = (file, block), False, []
                line = line.lstrip("﻿") if block == 0 else line
            if not inside:
                begun = at
            inside = ends_inside(line, inside)
            open_.append(line)
            if not inside:
                places.append(begun)
                texts.append("\n".join(open_) if len(open_) > 1 else line)
                of.append(k)
                open_ = []
        of = pa.array(of, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), pa.array(places, pa.int64()), pa.array(texts, pa.string())], names=["file", "block", "at", "record"])


def records(spark: SparkSession, path: str) -> DataFrame:
    """record: the text of every record of the files but their headers."""
    lines = _lines(spark, path)
    states = lines.mapInArrow(_states, _STATES).groupBy("file").applyInArrow(_chained, f"{_RANGE}, first long, head long, head_of long, tail long")
    # one row a range: as many as the scan has tasks, or files
    placed = lines.join(F.broadcast(states), ["file", "block"])
    within = placed.where("at > head and at < tail").select("file", "block", "at", "line").mapInArrow(_records, f"{_RANGE}, at long, record string")
    line = F.when(F.col("at") == F.col("first"), F.ltrim(F.col("line"), F.lit("﻿"))).otherwise(F.col("line"))
    crossing = placed.where("at <= head or at >= tail").select("file", F.when(F.col("at") <= F.col("head"), F.col("head_of")).otherwise(F.col("block")).alias("block"), F.struct("block", "at", line.alias("line")).alias("piece"))
    whole = crossing.groupBy("file", "block").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    whole = whole.select("file", "block", F.element_at("pieces.at", 1).alias("at"), F.array_join("pieces.line", "\n").alias("record"))
    heads = states.where("first is not null").select(F.col("file").alias("h_file"), F.col("first").alias("h_at"))
    every = within.unionByName(whole).join(F.broadcast(heads), (F.col("file") == F.col("h_file")) & (F.col("at") == F.col("h_at")), "left_anti")
    return every.select(F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''")


def read_blocks(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The records' cells under these names, as strings; null where a record has no such cell, or an empty one."""
    schema = StructType([StructField(f"c{k}", StringType()) for k in range(len(names))])
    cells = F.from_csv(F.col("record"), schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"quote": '"', "escape": '"', "multiLine": "true"})
    return records(spark, path).select(cells.alias("r")).select(*[F.col(f"r.c{k}").alias(n) for k, n in enumerate(names)])


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file."""
    return spark.read.format("binaryFile").load(path).agg(F.coalesce(F.max("length"), F.lit(0)).alias("n")).first()["n"]
