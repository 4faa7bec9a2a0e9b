"""Removal of repeated substrings by threshold-bounded interval expansion, over the bytes of whole texts.

A byte goes if a string of `length` bytes that covers it also starts anywhere else.

Two equal strings of that length have the same smallest hash of ANCHOR bytes, at the same place
inside them. So a text's start positions fall into ranges with one such anchor each, and only ranges whose
anchor hash occurs elsewhere can hold repeated starts:

1. ``anchors``: one pass (Arrow batches) gives each range's anchor hash, its bounds and a hash of its whole segment,
   from its first start to the end of its last string.
2. Ranges with equal segments are repeated as a whole. What is left are anchors with several different segments.
   One of each goes on, as bytes.
3. ``expanded``: the segments of an anchor, aligned at it, are suffixes of one another's columns. Backward extension goes through
   the columns from the right, breadth-first over all intervals: each step sorts the suffixes by the byte in
   front of them, stably, which is the Burrows-Wheeler step, and derives the common prefix of neighbours, one byte more than the
   least of those between them before, or none. Starts whose common prefix with a neighbour reaches `length` are repeated; nothing beyond that length is looked at.
4. Repeated starts are joined back to all ranges with that segment, merged to spans and cut from the texts.

A group of more than ``LARGE`` different segments would not fit a task, so it is divided, by the bytes that its strings must share: strings
that begin at least half of the possible distance before the anchor share that half, all others share bytes behind the anchor. Each part is grouped by
those bytes, as a wider anchor, and goes on with its own starts; after at most eight divisions the shared bytes are the whole string,
and what is left are equal strings, counted as they are. Anchors and segments that are a thousandth of all or more join by broadcast.

Hashes of the segments are 128 bits with the anchor's. They are polynomial, modulo 2**64; the strings against which that is
weak are longer than a segment. Edge cases: null texts are empty; texts of fewer bytes than `length` stay whole; repeated rows are documents each for itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import durable, join_counted, lean, let_go, mixed, plain

ANCHOR = 160
#: Different segments that fill a block of the expansion, and those of one group beyond which it is divided.
BLOCK_ROWS, LARGE = 4096, 50_000
#: Bytes that are hashed at once.
CHUNK = 1 << 20

_U = np.uint64
_TABLE = np.random.default_rng(20240611).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            _powers.append(np.cumprod(np.concatenate([[_U(1)], np.full(CHUNK + 4096, _U(base), np.uint64)]), dtype=np.uint64))
    return _powers


def _ranges(chunk: bytes, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of the texts that begin at `starts` (with the end): text, anchor hash, segment hash, anchor, first and last start, within the chunk."""
    up, down = _power_tables()
    c = np.frombuffer(chunk, np.uint8)
    sums = np.zeros(len(c) + 1, np.uint64)
    np.cumsum(_TABLE[c] * up[: len(c)], out=sums[1:])
    h = mixed((sums[ANCHOR:] - sums[:-ANCHOR]) * down[: len(c) - ANCHOR + 1])
    # The smallest hash of each string; the first of equal ones. Prefix and suffix minima of blocks give sliding minima.
    width = length - ANCHOR + 1
    key = (h & ~_U(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    blocks = np.concatenate([key, np.full(-len(key) % width, _U(2**64 - 1))]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(c) - length + 1
    anchor = (np.minimum(right[:n], left[width - 1 : width - 1 + n]) & _U(0xFFFFFF)).astype(np.int64)
    counts = np.diff(starts) - length + 1
    text = np.repeat(np.arange(len(counts)), counts)
    p = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + starts[text]
    a = anchor[p]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([first[1:], [len(p)]]) - 1
    a, text, lo, hi = a[first], text[first], p[first], p[last]
    segment = mixed((sums[hi + length] - sums[lo]) * down[lo] + ((a - lo) * 1_000_003 + (hi - lo)).astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F))
    return text, h[a], segment, a, lo, hi


def _anchorer(length: int):
    def flush(parts: list[tuple[int, int, bytes]], found: dict[int, list]) -> None:
        starts = np.concatenate([[0], np.cumsum([len(b) for _, _, b in parts])])
        text, h, segment, a, lo, hi = _ranges(b"".join(b for _, _, b in parts), starts, length)
        bounds = np.searchsorted(text, np.arange(len(parts) + 1))
        for k, (row, offset, _) in enumerate(parts):
            s = slice(bounds[k], bounds[k + 1])
            shift = offset - starts[k]
            found.setdefault(row, []).append((h[s], segment[s], a[s] + shift, lo[s] + shift, hi[s] + shift))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        step = CHUNK // 2
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                rows = batch.slice(begin, 1024)
                parts, size, found, sizes = [], 0, {}, []
                for k in range(rows.num_rows):
                    value = rows.column(2)[k]
                    text = value.as_buffer().to_pybytes() if value.is_valid else b""
                    sizes.append(len(text))
                    for at in range(0, len(text) - length + 1, step):
                        piece = text[at : at + step + length - 1]
                        if size + len(piece) > CHUNK:
                            flush(parts, found)
                            parts, size = [], 0
                        parts.append((k, at, piece))
                        size += len(piece)
                if parts:
                    flush(parts, found)
                none = [np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64)]  # of the same type: with another, numpy would make all of them floats
                columns = [[np.concatenate([x[i] for x in found[k]]) if k in found else none[i] for k in range(rows.num_rows)] for i in range(5)]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in columns[0]])]).astype(np.int32))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                fields = [pa.array(np.concatenate(x).view(np.int64) if x else np.empty(0, np.int64)).cast(t) for x, t in zip(columns, kinds, strict=True)]
                ranges = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, ["hash", "segment", "at", "lo", "hi"]))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(3), pa.array(sizes, pa.int64()), ranges], names=["doc_id", "version", "sha", "n_bytes", "ranges"])

    return run


def _segmenter(length: int):
    """The bytes of the listed ranges of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                rows = batch.slice(begin, 256)
                out: list[tuple] = []
                for text, ranges in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                    out += [(r["hash"], r["segment"], r["at"] - r["lo"], r["hi"] - r["lo"], text[r["lo"] : r["hi"] + length]) for r in ranges]
                columns = list(zip(*out, strict=True)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["hash", "segment", "lead", "last", "bytes"])

    return run


def _divider(length: int):
    """Two rows for each segment of a group: its starts at least `middle` bytes before the anchor, and those nearer to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                out: list[tuple] = []
                for r in batch.slice(begin, 512).to_pylist():
                    middle, text, lead = (r["low"] + r["high"] + 1) // 2, r["bytes"], r["lead"]
                    for low, high in ((middle, r["high"]), (r["low"], middle - 1)):
                        first, last = max(0, lead - high), min(r["last"], lead - low)
                        if first <= last:
                            shared = text[lead - low : lead - high + length]
                            key = xxhash.xxh3_64_intdigest(shared, seed=(r["grp"] * 1_000_003 + low) % 2**64) - 2**63
                            out.append((key, r["hash"], r["segment"], r["base"] + first, lead - first, last - first, low, high, text[first : last + length]))
                columns = list(zip(*out, strict=True)) or [()] * 9
                kinds = [pa.int64()] * 3 + [pa.int32()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["grp", "hash", "segment", "base", "lead", "last", "low", "high", "bytes"])

    return run


def expanded(lead: np.ndarray, last: np.ndarray, segments: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and start (from the row's first) of each start whose string another row has at the same distance from the anchor."""
    rows, before = len(segments), int(lead.max())
    sizes = np.array([len(s) for s in segments])
    width = before + int((sizes - lead).max())
    grid = np.full((width, rows), 256, np.uint16)
    row = np.repeat(np.arange(rows), sizes)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grid[inner + (before - lead)[row], row] = np.frombuffer(b"".join(segments), np.uint8)
    order, common = np.arange(rows), np.zeros(rows + 1, np.int32)  # common[i]: of the suffixes i - 1 and i in order
    marks: list[tuple[np.ndarray, np.ndarray]] = []
    for column in range(width - 1, -1, -1):
        byte = grid[column][order]
        by = np.argsort(byte, kind="stable")
        byte = byte[by]
        same = np.flatnonzero((byte[1:] == byte[:-1]) & (byte[1:] < 256)) + 1
        longer = np.zeros(rows + 1, np.int32)
        if len(same):
            pairs = np.empty(2 * len(same), np.int64)
            pairs[::2], pairs[1::2] = by[same - 1] + 1, by[same] + 1
            longer[same] = np.minimum.reduceat(common, pairs)[::2] + 1
        order, common = order[by], longer
        if column <= before:
            enough = longer >= length
            at = np.flatnonzero(enough[:-1] | enough[1:])
            if len(at):
                hit = order[at]
                start = column - (before - lead[hit])
                valid = (start >= 0) & (start <= last[hit])
                marks.append((hit[valid], start[valid]))
    if not marks:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([m[0] for m in marks]), np.concatenate([m[1] for m in marks])


def _runs(row: np.ndarray, start: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, first, last) of the runs of consecutive starts."""
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    if not len(row):
        return []
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)])
    first = np.flatnonzero(new)
    return list(zip(row[first].tolist(), start[first].tolist(), start[np.concatenate([first[1:], [len(row)]]) - 1].tolist(), strict=True))


def _expander(length: int):
    """Rows come sorted by group and segment, so a block holds all segments of its groups."""

    def block(held: list[list]) -> pa.RecordBatch:
        _, keys, names, base, lead, last, texts = held
        out = _runs(*expanded(np.array(lead), np.array(last), texts, length))
        columns = [[keys[r] for r, _, _ in out], [names[r] for r, _, _ in out], [base[r] + a for r, a, _ in out], [base[r] + z for r, _, z in out]]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["hash", "segment", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(7)]
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held[0] and held[0][-1] != row[0] and len(held[0]) >= BLOCK_ROWS:
                    yield block(held)
                    held = [[] for _ in range(7)]
                if held[0] and (held[0][-1], held[1][-1], held[2][-1]) == row[:3]:
                    continue  # a repeated row of the table
                for x, value in zip(held, row, strict=True):
                    x.append(value)
        if held[0]:
            yield block(held)

    return run


def _marks(segments: DataFrame, length: int, most: int) -> DataFrame:
    """hash, segment, first, last: the runs of repeated starts of each segment. most: a bound on the segments."""
    columns, found, groups = ["grp", "hash", "segment", "base", "lead", "last", "bytes"], [], segments.withColumn("grp", F.col("hash"))
    groups = groups.withColumns({"base": F.lit(0), "low": F.lit(0), "high": F.lit(length - ANCHOR)})
    while True:
        sizes = groups.groupBy("grp").agg(F.count("*").alias("n"))
        large = durable(sizes.where(F.col("n") > LARGE), "large", most)
        small = groups if not large.rows else groups.join(large.select("grp"), "grp", "left_anti")
        ordered = small.select(columns).repartition(F.col("grp")).sortWithinPartitions("grp", "hash", "segment")
        found.append(ordered.mapInArrow(lean(_expander(length)), "hash long, segment long, first int, last int"))
        if not large.rows:
            return durable(reduce(DataFrame.unionByName, found), "marks", most, 50_000)
        big = groups.join(large.select("grp"), "grp", "left_semi")
        # Strings that are shared as a whole: one start each.
        same = durable(big.where("low = high").select("grp", "hash", "segment", F.col("base").alias("first"), F.col("base").alias("last"), "bytes"), "same")
        equal = durable(same.groupBy("bytes").agg(F.count_distinct("hash", "segment").alias("copies"), F.count("*").alias("n")).where("copies > 1"), "equal")
        found.append(join_counted(same, equal.drop("copies"), ["bytes"], "n", same.rows).select("hash", "segment", "first", "last"))
        groups = durable(big.where("low < high").select(*columns, "low", "high").mapInArrow(_divider(length), "grp long, hash long, segment long, base int, lead int, last int, low int, high int, bytes binary"), "divided")


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the spans, which may overlap, out of the texts."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            rows = batch.slice(begin, 256)
            out = []
            for text, starts, stops in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(), rows.column(3).to_pylist(), strict=True):
                kept, end, n = [], 0, 0
                for start, stop in sorted(zip(starts, stops, strict=True)):
                    if start > end or not n:
                        n += 1
                        kept.append(text[end:start])
                        end = stop
                    end = max(end, stop)
                kept.append(text[end:])
                left = b"".join(kept)
                out.append((len(text), len(text) - len(left), n, hashlib.sha256(left).hexdigest(), left))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["doc_id", *CUT_NAMES])


CUT_NAMES = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
RANGES = "array<struct<hash:long,segment:long,at:int,lo:int,hi:int>>"


def _of_document(frame: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Join on doc_id, where null equals null, and version."""
    right = other.withColumnRenamed("doc_id", "_id").withColumnRenamed("version", "_version")
    return frame.join(right, frame.doc_id.eqNullSafe(right._id) & (frame.version == right._version), how).drop("_id", "_version")


def dedup_substrings(docs: DataFrame, length: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (bytes; null where nothing was removed) of every row of docs."""
    if length <= ANCHOR:
        raise ValueError(f"strings must be longer than an anchor's {ANCHOR} bytes")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    source = plain(docs, id_col, text_col).toDF("doc_id", "text").select("doc_id", F.xxhash64(text).alias("version"), text.alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    scanned = durable(source.withColumn("sha", F.sha2("text", 256)).mapInArrow(lean(_anchorer(length)), f"doc_id {kind}, version long, sha string, n_bytes long, ranges {RANGES}"), "ranges")
    ranged = scanned.select("doc_id", "version", F.explode("ranges").alias("r")).select("doc_id", "version", "r.*")
    total = ranged.count()
    twice = durable(ranged.groupBy("hash").agg(F.count("*").alias("n"), (F.min("segment") < F.max("segment")).alias("various")).where("n > 1"), "twice", total // 2)
    found = durable(join_counted(ranged, twice, ["hash"], "n", total).drop("n"), "found", 2 * total)
    each = durable(found.groupBy("hash", "segment", "various").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "version", "at", "lo", "hi")).alias("one")), "segments", found.rows)
    suspects = durable(_of_document(source, found.select("doc_id", "version").distinct(), "left_semi"), "suspects", scanned.rows, 10_000)

    wanted = each.where("various").select("hash", "segment", "one.*").groupBy("doc_id", "version").agg(F.collect_list(F.struct("hash", "segment", "at", "lo", "hi")).alias("ranges"))
    segments = _of_document(suspects, wanted, "inner").select("text", "ranges").mapInArrow(lean(_segmenter(length)), "hash long, segment long, lead int, last int, bytes binary")
    segments = durable(segments, "bytes", each.rows, 50_000)
    marks = _marks(segments, length, each.rows)

    once, more = each.where("copies = 1"), each.where("copies > 1").select("hash", "segment", "copies")
    partial = marks.join(once.select("hash", "segment", "one"), ["hash", "segment"]).select("one.doc_id", "one.version", (F.col("one.lo") + F.col("first")).alias("start"), (F.col("one.lo") + F.col("last") + length).alias("stop"))
    whole = join_counted(found, more, ["hash", "segment"], "copies", found.rows).select("doc_id", "version", F.col("lo").alias("start"), (F.col("hi") + length).alias("stop"))
    spans = durable(partial.unionByName(whole).groupBy("doc_id", "version").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops")), "spans", scanned.rows, 50_000)
    cut = _of_document(suspects, spans, "inner").select("doc_id", "text", "starts", "stops")
    cut = cut.mapInArrow(lean(_cutter), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    zero = F.lit(0).cast("long")
    clear = _of_document(scanned.drop("ranges"), spans.select("doc_id", "version"), "left_anti")
    return cut.unionByName(clear.select("doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha").alias("kept_sha256"), F.lit(None).cast("binary").alias("kept")))


def digest(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of docs; edge cases as above."""
    return dedup_substrings(docs, length).drop("kept")
