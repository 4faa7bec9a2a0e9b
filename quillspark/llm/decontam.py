"""Benchmark decontamination with a distributed positional inverted index.

``index`` stores the training tokens' postings once, as Parquet in the shared folder. It is partitioned by document: each block of
documents that a task reads becomes a segment, with its words, and for each word the sorted positions at which it
stands (as gaps to the one before). Any number of benchmarks can be searched in a stored index without reading a text again.

``search`` answers each benchmark window from its rarest term in a segment: its postings, less the term's offset, are candidate
starts, and the lists of the other terms, likewise offset-adjusted, are intersected with them in order of rarity.
What is left are exact phrase matches. Proximity matches come from the same lists: every other term
must have a posting within `reach` words of the window's longest word (the first of the longest), in any order.

Documents never move: there is no shuffle, and a lost task is redone from its input or its segments. The benchmark is the
query side; it is split into groups of at most ``GROUP_WORDS`` words and an item, and each group is broadcast to a pass of its own over the
index, so a worker holds one group however long the benchmark is. Only with several groups are their answers joined, by document.

Edge cases: null and empty texts have no words. Items without words or with a null id ask nothing; a repeated item_id counts
once. item_id may be of any type, and lists of items have it too. Repeated rows of documents are answered each for itself. An empty
benchmark finds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quillspark.llm.common import durable, lean, let_go, plain

#: Words of a group of benchmark items.
GROUP_WORDS = 1_000_000
#: Words of a segment; a longer document is a segment of its own.
BLOCK_WORDS = 500_000
#: Words on either side of a window's longest word that proximity matches may take in production: twice a window.
REACH = 20
#: Candidates for proximity matches that are held at once, or those of one window.
NEAR_ROWS = 2_000_000

#: Bytes of words: digits, lower-case letters and all of a non-ASCII character. A-Z become lower case, others a space.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))

#: A segment. words are parted by line breaks; n_words (of each document), counts and gaps (of each word) are little-endian 32-bit numbers.
SEGMENT = "segment long, ids array<{id}>, versions array<long>, n_words binary, words binary, counts binary, gaps binary"
FOUND = "segment long, place int, doc_id {id}, version long, n_words long, items array<{item}>, near_items array<{item}>, spans array<struct<start:long,stop:long>>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


class Numbers(dict):
    """word -> its number, in order of first use."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


@dataclass
class Group:
    """Windows of some items: a row of term numbers each, filled up with -1."""

    vocabulary: dict[bytes, int]
    windows: np.ndarray
    lengths: np.ndarray
    centre: np.ndarray
    item_of: np.ndarray
    item_ids: list


def grouped(items: list[tuple[object, bytes]], window: int) -> Group:
    vocabulary, rows, centre, item_of, ids = Numbers(), [], [], [], []
    for item_id, text in items:
        words = words_of(text)
        terms = [vocabulary[w] for w in words]
        if not terms:
            continue
        for i in range(max(1, len(terms) - window + 1)):
            rows.append((terms[i : i + window] + [-1] * window)[:window])
            centre.append(max(range(min(window, len(terms) - i)), key=lambda j: (len(words[i + j]), -j)))
            item_of.append(len(ids))
        ids.append(item_id)
    windows = np.array(rows, dtype=np.int32).reshape(-1, window)
    return Group(dict(vocabulary), windows, (windows >= 0).sum(1), np.array(centre, dtype=np.int64), np.array(item_of, dtype=np.int64), ids)


class Postings:
    """Term -> sorted positions, of one segment. A -1 in `terms` has none."""

    def __init__(self, counts: np.ndarray, positions: np.ndarray, words: int):
        self.stride = words + 1
        self.counts = counts
        self.begin = np.cumsum(counts) - counts
        self.keys = np.repeat(np.arange(len(counts), dtype=np.int64) * self.stride, counts) + positions

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and positions of the concatenated lists of `terms`."""
        counts = self.counts[terms]
        rows = np.repeat(np.arange(len(terms)), counts)
        inner = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
        return rows, self.keys[self.begin[terms][rows] + inner] % self.stride

    def hold(self, terms: np.ndarray, positions: np.ndarray) -> np.ndarray:
        key = terms * self.stride + positions
        i = np.searchsorted(self.keys, key)
        return (positions >= 0) & (i < len(self.keys)) & (self.keys[np.minimum(i, len(self.keys) - 1)] == key)

    def near(self, terms: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a posting of the term lies in low..high."""
        i = np.searchsorted(self.keys, terms * self.stride + np.maximum(low, 0))
        return (i < len(self.keys)) & (self.keys[np.minimum(i, len(self.keys) - 1)] <= terms * self.stride + np.minimum(high, self.stride - 1))


def stored(texts: list[list[bytes]]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Words of each text, the different words, their counts and the gaps between their positions. A position lies empty behind each text."""
    n_words = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(n_words + 1) - (n_words + 1)
    numbers = Numbers()
    total = int(n_words.sum())
    terms = np.fromiter((numbers[w] for t in texts for w in t), np.int64, total)
    at = np.arange(total) + np.repeat(starts - (np.cumsum(n_words) - n_words), n_words)
    keys = np.sort(terms << 32 | at)
    counts, at = np.bincount(terms, minlength=len(numbers)), keys & 0xFFFFFFFF
    gaps = np.diff(at, prepend=0)
    first = (np.cumsum(counts) - counts)[counts > 0]
    gaps[first] = at[first]
    return n_words, list(numbers), counts, gaps


def positions_of(counts: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    if not len(gaps):
        return gaps
    sums, first = np.cumsum(gaps), np.cumsum(counts) - counts
    return sums - np.repeat(sums[first] - gaps[first], counts)


def answer(group: Group, index: Postings, numbers: np.ndarray, doc_start: np.ndarray, doc_of: np.ndarray, reach: int) -> tuple[np.ndarray, ...]:
    """Windows and starts of exact matches; documents and items of proximity matches.

    numbers: of each term of the group its number in the index, or -1. doc_start: where each document begins, with the end.
    """
    none = np.empty(0, np.int64)
    if not len(index.keys) or not len(group.windows):
        return none, none, none, none
    live = np.flatnonzero(((group.windows < 0) | (numbers >= 0)[group.windows]).all(1))
    terms = np.where(group.windows[live] >= 0, numbers[group.windows[live]], -1)
    counts = np.where(terms >= 0, index.counts[np.maximum(terms, 0)], np.iinfo(np.int64).max)
    order = np.argsort(counts, axis=1, kind="stable")
    row, at = index.lists(terms[np.arange(len(live)), order[:, 0]]) if len(live) else (none, none)
    exact_row, start = row, at - order[row, 0]
    for j in range(1, terms.shape[1]):
        if len(exact_row):
            offset = order[exact_row, j]
            term = terms[exact_row, offset]
            keep = (term < 0) | index.hold(term, start + offset)
            exact_row, start = exact_row[keep], start[keep]
    near = _proximity(group, index, live, terms, doc_start, doc_of, reach) if reach and len(live) else np.empty((0, 2), np.int64)
    return live[exact_row], start, near[:, 0], near[:, 1]


def _proximity(group: Group, index: Postings, live: np.ndarray, terms: np.ndarray, doc_start: np.ndarray, doc_of: np.ndarray, reach: int) -> np.ndarray:
    """Documents and items of proximity matches, from parts of the windows so that NEAR_ROWS bounds what is held."""
    centres = terms[np.arange(len(live)), group.centre[live]]
    _, first = np.unique(np.cumsum(index.counts[centres]) // NEAR_ROWS, return_index=True)
    found = []
    for a, z in zip(first, [*first[1:], len(live)], strict=True):
        row, at = index.lists(centres[a:z])
        row += a
        low, high = doc_start[doc_of[at]], doc_start[doc_of[at] + 1] - 2
        low, high = np.maximum(at - reach, low), np.minimum(at + reach, high)
        for j in range(terms.shape[1]):
            term = terms[row, j]
            keep = (term < 0) | index.near(term, low, high)
            row, at, low, high = row[keep], at[keep], low[keep], high[keep]
        found.append(np.unique(np.stack([doc_of[at], group.item_of[live[row]]], 1), axis=0))
    return np.unique(np.concatenate(found), axis=0)


def _indexer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    segment = TaskContext.get().partitionId() << 32
    for batch in batches:
        texts, size, begin = [], 0, 0
        for k in range(batch.num_rows):
            one = batch.column(2)[k]
            texts.append(words_of(one.as_buffer().to_pybytes() if one.is_valid else None))
            size += len(texts[-1])
            if size >= BLOCK_WORDS or k == batch.num_rows - 1:
                n_words, words, counts, gaps = stored(texts)
                rows = pa.array([0, k + 1 - begin], pa.int32())
                ids, versions = (pa.ListArray.from_arrays(rows, pa.concat_arrays([c.slice(begin, k + 1 - begin)])) for c in batch.columns[:2])
                numbers = [pa.array([x.astype("<u4").tobytes()], pa.binary()) for x in (n_words, counts, gaps)]
                yield pa.RecordBatch.from_arrays([pa.array([segment]), ids, versions, numbers[0], pa.array([b"\n".join(words)], pa.binary()), *numbers[1:]], names=["segment", "ids", "versions", "n_words", "words", "counts", "gaps"])
                texts, size, begin = [], 0, k + 1
                segment += 1


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index of docs: a table of segments."""
    text = F.col("text").cast("binary")
    rows = plain(docs, id_col, text_col).toDF("doc_id", "text").select("doc_id", F.xxhash64(text).alias("version"), text.alias("text"))
    return durable(rows.mapInArrow(lean(_indexer), SEGMENT.format(id=rows.schema["doc_id"].dataType.simpleString())), "postings")


def _searcher(broadcast, reach: int, item_type: pa.DataType):
    def one(segment: dict, ids: pa.Array, versions: pa.Array) -> pa.RecordBatch:
        group = broadcast.value
        n_words, counts, gaps = (np.frombuffer(segment[c], "<u4").astype(np.int64) for c in ("n_words", "counts", "gaps"))
        doc_start = np.concatenate([[0], np.cumsum(n_words + 1)])
        doc_of = np.repeat(np.arange(len(n_words)), n_words + 1)
        numbers = np.full(len(group.vocabulary), -1, np.int64)
        for k, word in enumerate(segment["words"].split(b"\n")):
            n = group.vocabulary.get(word)
            if n is not None:
                numbers[n] = k
        items, near, spans = ([[] for _ in n_words] for _ in range(3))
        row, start, near_doc, near_item = answer(group, Postings(counts, positions_of(counts, gaps), int(doc_start[-1])), numbers, doc_start, doc_of, reach)
        edges = np.zeros(doc_start[-1] + 1, np.int32)
        np.add.at(edges, start, 1)
        np.add.at(edges, start + group.lengths[row], -1)
        found = {(int(d), int(i)) for d, i in zip(doc_of[start], group.item_of[row], strict=True)}
        for d, i in sorted(found):
            items[d].append(group.item_ids[i])
        for d, i in zip(near_doc.tolist(), near_item.tolist(), strict=True):
            if (d, i) not in found:
                near[d].append(group.item_ids[i])
        covered = np.cumsum(edges[:-1]) > 0
        change = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
        for a, z in zip(change[::2].tolist(), change[1::2].tolist(), strict=True):
            d = int(doc_of[a])
            spans[d].append({"start": a - int(doc_start[d]), "stop": z - int(doc_start[d])})
        listed = pa.list_(item_type)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(n_words), segment["segment"], np.int64)), pa.array(np.arange(len(n_words), dtype=np.int32)), ids, versions, pa.array(n_words),
                pa.array(items, listed), pa.array(near, listed), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
            ],
            names=["segment", "place", "doc_id", "version", "n_words", "items", "near_items", "spans"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for k in range(batch.num_rows):
                segment = {c: batch.column(c)[k].as_py() for c in ("segment", "n_words", "words", "counts", "gaps")}
                yield one(segment, *(batch.column(c)[k].values for c in ("ids", "versions")))

    return run


def _groups(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> Iterator[Group]:
    """Read item by item, so the driver holds one group at a time. One without items, if there are none."""
    items, size, any_group = [], 0, False
    rows = plain(benchmark, id_col, text_col).toDF("item_id", "text").where("item_id is not null and text is not null").select("item_id", F.col("text").cast("binary"))
    for item_id, text in rows.toLocalIterator():
        items.append((item_id, bytes(text)))
        size += len(words_of(items[-1][1]))
        if size >= GROUP_WORDS:
            yield grouped(items, window)
            items, size, any_group = [], 0, True
    if items or not any_group:
        yield grouped(items, window)


def search(segments: DataFrame, benchmark: DataFrame, window: int = 10, reach: int = 0, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per document of a stored index: doc_id, version (a hash of its text), n_words, items and near_items with matches, and the hit spans in words.

    items hold a window of `window` words (all words, of an item of fewer) as a phrase. near_items only have all
    words of a window within `reach` words of its longest word (none with reach = 0).
    """
    context, kind = segments.sparkSession.sparkContext, benchmark.schema[item_col].dataType
    schema = FOUND.format(id=segments.schema["ids"].dataType.elementType.simpleString(), item=kind.simpleString())
    # Each broadcast has at most GROUP_WORDS words and an item.
    passes = [segments.mapInArrow(lean(_searcher(context.broadcast(g), reach, to_arrow_type(kind))), schema) for g in _groups(benchmark, window, item_col, item_text_col)]
    columns = ["doc_id", "version", "n_words", "items", "near_items", "spans"]
    if len(passes) == 1:
        return passes[0].select(columns)
    all_of = lambda c: F.array_distinct(F.flatten(F.collect_list(c))).alias(c)
    found = reduce(DataFrame.unionByName, passes).groupBy("segment", "place")
    found = found.agg(*[F.first(c).alias(c) for c in ("doc_id", "version", "n_words")], *[all_of(c) for c in ("items", "near_items", "spans")])
    none = F.array().cast("array<struct<start:long,stop:long>>")
    merged = F.aggregate(
        F.array_sort("spans"),
        none,
        lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] >= s["start"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["stop"], s["stop"]).alias("stop"))))).otherwise(F.concat(acc, F.array(s))),
    )
    return found.select("doc_id", "version", "n_words", "items", F.array_except("near_items", "items").alias("near_items"), merged.alias("spans"))


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10, reach: int = 0, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """search() in a new index of docs: a row for every row of docs."""
    return search(index(docs, id_col, text_col), benchmark, window, reach, item_col, item_text_col)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", reach: int = 0) -> DataFrame:
    """The rows of docs without any phrase of the benchmark nor, with a reach, any proximity match; all columns."""
    found = find(docs, benchmark, window, reach, id_col, text_col).where("size(items) > 0 or size(near_items) > 0")
    hits = durable(found.select(F.col("doc_id").alias("hit_id"), F.col("version").alias("hit_version")).distinct(), "hits")
    same = F.xxhash64(docs[f"`{text_col}`"].cast("binary")) == hits["hit_version"]
    return docs.join(hits, docs[f"`{id_col}`"].eqNullSafe(hits["hit_id"]) & same, "left_anti")


def digest(docs: DataFrame, benchmark: DataFrame, reach: int = 0) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of docs.

    With a reach also n_near and near_items, the items of which a row has proximity matches only; the other columns stay as they are.
    """
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    near = F.array_sort(F.array_except("near_items", "items"))
    return find(docs, benchmark, window=10, reach=reach).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(F.array_distinct("items")).cast("long").alias("n_items"),
        F.sha2(listed(F.array_distinct("items")), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
        *([F.size(near).cast("long").alias("n_near"), near.alias("near_items")] if reach else []),
    )


def listed(items: Column | str) -> Column:
    """The items as strings, sorted as such, joined by commas."""
    return F.array_join(F.array_sort(F.transform(items, lambda i: i.cast("string"))), ",")
