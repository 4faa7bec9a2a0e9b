"""Periodic runs of words, by a suffix tree and the smaller-half traversal of its leaf lists.

A run is a maximal stretch of words with smallest period q that is at least `times` * q long. Per document:

1. A word of a run stands in it `times` times or more. So texts are cut at words that are rarer in their stretch, again and again
   until none is; no run is lost, none grows past a cut, and stretches in which nothing recurs are left out of the tree.
2. The stretches' suffixes are sorted by prefix doubling, which also ranks all windows of 1, 2, 4, ... words. Common prefixes of neighbours
   in that order are read from these ranks. Intervals of the order with a common prefix are the nodes of the suffix tree.
3. At a node of depth q, the leaf lists of all children but the largest are gone through: suffixes i and i + q under different children
   are a branching tandem repeat, one of 2q words that the word after it doesn't continue. A leaf is gone through at most log2(n) times.
4. Branching repeats are rotated to the left as far as words agree, again by the ranks of windows. That is the run; what the same
   stretch gives for multiples of its period is merged into its smallest.

Stretches of many documents share one array, and every step is done to all of them at once. Documents don't move: one pass, no shuffle. Time is
O(n log n) sorts and traversal for n words of a stretch, memory some 100 bytes a word of the documents that are taken together, and of
the longest document, times log2 of its longest repeat for stretches that recur.

Edge cases: null and empty texts have no words and no runs. Equal words are equal byte strings. Repeated rows count each for itself. A null
doc_id is a value like another.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillspark.llm.common import lean, let_go, plain

#: Words of documents that are taken together, leaves that are gone through at once.
TOGETHER, LEAVES = 300_000, 1 << 20


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        k = self[word] = len(self)
        return k


def _ranked(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of keys."""
    shift = max(1, len(keys) - 1).bit_length()
    if len(keys) and int(keys.max()).bit_length() + shift > 62:  # no room for positions beside them
        return np.unique(keys, return_inverse=True)[1]
    both = np.sort(keys << shift | np.arange(len(keys)))
    at, of = both & ((1 << shift) - 1), both >> shift
    rank = np.empty(len(keys), np.int64)
    rank[at] = np.cumsum(np.diff(of, prepend=of[:1]) != 0)
    return rank


def _stretches(codes: np.ndarray, text: np.ndarray, times: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that are left after cutting, and the stretch of each: a number that grows."""
    at, of = np.arange(len(codes)), text
    while len(at):
        key = of * (int(codes.max()) + 1) + codes[at]
        _, group, many = np.unique(key, return_inverse=True, return_counts=True)
        stays = many[group] >= times
        kept, home = at[stays], of[stays]
        starts = np.flatnonzero((np.diff(kept, prepend=-2) > 1) | (np.diff(home, prepend=-1) != 0))
        long_ = np.diff(starts, append=len(kept)) >= least
        sizes = np.diff(starts, append=len(kept))
        of = np.repeat(np.cumsum(long_) - 1, sizes)[np.repeat(long_, sizes)]
        kept = kept[np.repeat(long_, sizes)]
        if len(kept) == len(at):
            return kept, of
        at = kept
    return at, at


def _windows(first: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
    """Ranks of windows of 1, 2, 4, ... words at each position, until all differ; windows that reach past the stretch equal no other. stop: where each position's stretch ends."""
    levels, place, h = [first], np.arange(len(first)), 1
    while True:
        now = levels[-1]
        if len(now) == 0 or now.max() + 1 == len(now):
            return levels
        inside = place + h < stop
        second = np.where(inside, now[np.minimum(place + h, len(now) - 1)] + 1, 0)
        levels.append(_ranked(now << len(now).bit_length() + 1 | second))
        h *= 2


def _equal(level: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = len(level)
    return (a < n) & (b < n) & (level[np.minimum(a, n - 1)] == level[np.minimum(b, n - 1)])


def _reach(low: list[np.ndarray], at: np.ndarray, depth: np.ndarray, step: int) -> np.ndarray:
    """From at, how far to the left (step -1) or right (1) values stay at depth or above; low[k][i] is the least of the 2**k values from i."""
    n = len(low[0])
    for k in range(len(low) - 1, -1, -1):
        if step > 0:
            can = at + (1 << k) < n
            can &= low[k][np.minimum(at + 1, n - (1 << k))] >= depth
        else:
            can = at - (1 << k) >= 0
            can &= low[k][np.maximum(at - (1 << k), 0)] >= depth
        at = np.where(can, at + (step << k), at)
    return at


def branching_repeats(levels: list[np.ndarray], begin: np.ndarray, stop: np.ndarray, times: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) of all branching tandem repeats whose period goes into their stretch `times` times."""
    n = len(begin)
    rank = levels[-1]
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    one, other, common = order[:-1], order[1:], np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        common += np.where(_equal(levels[k], one + common, other + common), 1 << k, 0)
    # common[i] is that of the suffixes of rank i - 1 and i; both ends are fenced
    common = np.concatenate([[-1], common, [-1]])
    low = [common]
    while 2 << (len(low) - 1) <= n + 1:
        half = 1 << (len(low) - 1)
        low.append(np.minimum(low[-1][:-half], low[-1][half:]))
    cut = np.flatnonzero((common > 0) & (common * times <= np.append((stop - begin)[order], 0)))
    depth = common[cut]
    left, right = _reach(low, cut, depth, -1) - 1, _reach(low, cut, depth, 1)  # the node's suffixes: ranks left to right
    del low
    if not len(cut):
        return cut, depth
    # cuts of one node together, in order: they part its children
    by_node = np.lexsort((cut, depth, left))
    cut, depth, left, right = cut[by_node], depth[by_node], left[by_node], right[by_node]
    opens = (np.diff(left, prepend=-1) != 0) | (np.diff(depth, prepend=-1) != 0)
    node = np.cumsum(opens) - 1
    head = np.flatnonzero(opens)
    first = head + np.arange(len(head))  # each node's first child among all children
    place = np.arange(len(cut)) + node + 1
    child, child_end, home = np.empty(len(cut) + len(head), np.int64), np.empty(len(cut) + len(head), np.int64), np.empty(len(cut) + len(head), np.int64)
    child[first], child[place] = left[head], cut
    child_end[place - 1] = cut - 1
    child_end[np.append(first[1:], len(child)) - 1] = right[head]
    home[first], home[place] = np.arange(len(head)), node
    size = child_end - child + 1
    most = np.maximum.reduceat(size, first)
    number = np.arange(len(child))
    largest = np.minimum.reduceat(np.where(size == most[home], number, len(child)), first)
    small = number != largest[home]
    child, child_end, home, size = child[small], child_end[small], home[small], size[small]
    depth, left, right = depth[head][home], left[head][home], right[head][home]
    ends = np.cumsum(size)
    found_at, found_period = [], []
    begin_child = 0
    while begin_child < len(child):
        done = ends[begin_child - 1] if begin_child else 0
        end_child = max(begin_child + 1, int(np.searchsorted(ends, done + LEAVES, side="right")))
        part = slice(begin_child, end_child)
        of = np.repeat(np.arange(begin_child, end_child), size[part])
        leaf = order[child[of] + np.arange(len(of)) - (ends[of] - size[of] - done)]
        q = depth[of]
        for other in (leaf + q, leaf - q):
            ok = (other >= begin[leaf]) & (other < stop[leaf])
            there = rank[np.where(ok, other, 0)]
            ok &= (there >= left[of]) & (there <= right[of]) & ((there < child[of]) | (there > child_end[of]))
            found_at.append(np.minimum(leaf, other)[ok])
            found_period.append(q[ok])
        begin_child = end_child
    return np.concatenate(found_at), np.concatenate(found_period)


def maximal_runs(codes: np.ndarray, text: np.ndarray, least: int = 6, times: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of at least max(least, times * period) words, by start and period.

    codes: the words of some texts, one after another, as numbers; text: the number of each word's text, which grows.
    """
    none = np.empty(0, np.int64)
    at, of = _stretches(codes, text, times, max(least, times))
    if not len(at):
        return none, none, none
    edge = np.flatnonzero(np.diff(of, prepend=-1) != 0)
    sizes = np.diff(edge, append=len(at))
    begin, stop = np.repeat(edge, sizes), np.repeat(edge + sizes, sizes)
    levels = _windows(_ranked(of * (int(codes.max()) + 1) + codes[at]), stop)
    i, q = branching_repeats(levels, begin, stop, times)
    start = i
    for k in range(len(levels) - 1, -1, -1):
        there = start - (1 << k)
        ok = there >= begin[i]
        there = np.where(ok, there, 0)
        start = np.where(ok & (levels[k][there] == levels[k][np.minimum(there + q, len(at) - 1)]), there, start)
    length = i + 2 * q - start
    ok = length >= np.maximum(least, times * q)
    start, length, q = start[ok], length[ok], q[ok]
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    ok = (np.diff(start, prepend=-1) != 0) | (np.diff(length, prepend=-1) != 0)  # the smallest period of a stretch
    start, length, q = start[ok], length[ok], q[ok]
    order = np.lexsort((q, start))
    return at[start[order]], length[order], q[order]


def _groups(texts: list[bytes | None], ids: list, change: Callable[[list[bytes], object], list[bytes]] | None, least: int, times: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """The words of each text and its runs; texts are taken together until they have TOGETHER words."""
    group: list[list[bytes]] = []
    many = 0
    for k, raw in enumerate(texts):
        words = (raw or b"").split()  # at the six ASCII white space characters
        group.append(change(words, ids[k]) if change else words)
        many += len(words)
        if many >= TOGETHER or k == len(texts) - 1:
            sizes = np.array([len(w) for w in group], np.int64)
            first = np.cumsum(sizes) - sizes
            numbers = _Numbers()
            codes = np.fromiter(map(numbers.__getitem__, chain.from_iterable(group)), np.int64, many)
            text = np.repeat(np.arange(len(group)), sizes)
            start, length, period = maximal_runs(codes, text, least, times) if many else (np.empty(0, np.int64),) * 3
            own = text[start]
            rows = np.stack([start - first[own], length, period], 1).tolist()
            bounds = np.searchsorted(own, np.arange(len(group) + 1)).tolist()
            for words, a, b in zip(group, bounds[:-1], bounds[1:], strict=True):
                yield words, [tuple(r) for r in rows[a:b]]
            group, many = [], 0


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run has after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]


def _over(docs: DataFrame, rows_of: Callable[[list, list, Callable], list[tuple]], schema: str, kinds: list[pa.DataType], change, id_col: str, text_col: str, least: int, times: int) -> DataFrame:
    rows = plain(docs, id_col, text_col).toDF("doc_id", "text")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {schema}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            of, columns = [], []
            ids = batch.column(0).to_pylist()
            for k, (words, runs) in enumerate(_groups(batch.column(1).cast(pa.binary()).to_pylist(), ids, change, least, times)):
                made = rows_of(words, runs)
                of += [k] * len(made)
                columns += made
            parts = list(zip(*columns, strict=True)) or [()] * len(kinds)
            names = [c.split()[0] for c in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), *(pa.array(c, t) for c, t in zip(parts, kinds, strict=True))], names=names)

    return rows.mapInArrow(lean(run), schema)


def runs(docs: DataFrame, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start (word number), length and period (words) of every run of each text."""
    return _over(docs, lambda words, found: found, "start long, length long, period long", [pa.int64()] * 3, None, id_col, text_col, least, times)


def without_repeats(docs: DataFrame, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and n_dropped: each text's words but those that a run has after its first period, joined by one space. A null text becomes the empty text."""

    def rows_of(words: list[bytes], found: list) -> list[tuple]:
        kept = collapsed(words, found)
        return [(b" ".join(kept).decode(), len(words) - len(kept))]

    return _over(docs, rows_of, "text string, n_dropped long", [pa.string(), pa.int64()], None, id_col, text_col, least, times)


def planted(words: list[bytes], doc_id: object) -> list[bytes]:
    """The words, in a tenth of documents made periodic from some word on, as the query's contract says. Null ids plant nothing."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * (-(-(n - a) // p)))[: n - a]


def digest(docs: DataFrame) -> DataFrame:
    """The contract of the query: n_runs, the longest run, and hashes of all runs and of the words that stay, after planting."""

    def rows_of(words: list[bytes], found: list[tuple[int, int, int]]) -> list[tuple]:
        start, length, period = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        kept = hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest()
        return [(len(found), start, length, period, 1000 * length // period if found else None, hashlib.sha256(listed.encode()).hexdigest(), kept)]

    schema = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return _over(docs, rows_of, schema, [pa.int64()] * 5 + [pa.string()] * 2, planted, "doc_id", "text", 6, 4)
