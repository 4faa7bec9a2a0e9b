"""Hard negatives, with an orthogonal rotation to principal components that discards pairs early.

A row's score for an anchor is the integer inner product of their scaled, floored vectors. Rotated by the eigenvectors of all rows'
second moments, vectors have most of their length in their first components. Scores are accumulated over these: after the first k, the rest of a
product is at most the product of what the two vectors have left (Cauchy and Schwarz), plus a slack for rounding. Pairs
whose score can't count any more are discarded; what remains is verified by integer products, so results are exact, whatever the rotation.

Two passes, each over pairs of blocks: rows and anchors are packed in blocks of bounded size, blocks of rows are dealt to groups, and every
group gets all blocks of anchors. A task streams through such pairs and keeps, for the block of anchors that it works on, the best so far.

1. Positives: the first of the rows of an anchor's label. A pair is discarded when its upper bound is below the last of the best so far,
   or of the lower bounds in its block.
2. Negatives: the first of the rows of another label whose score is in the band that a positive's score allows. A pair is
   discarded when it can't be in a band, or only below the last of the best so far in it.

Rows of one label may be a third of all or more: blocks hold any labels, so labels don't matter for how work is dealt.

Edge cases: rows with a null id, label or vector, or with a component that is null, not finite, or not finite when scaled, take no part. Shorter vectors
have zeros after their end; an empty one is all zeros. Rows are known by their ids: an anchor's other rows are those with another id. Rows that repeat an id count each for itself, as
anchors too. Pairs whose score doesn't fit a long are left out. An empty table has no result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import durable, lean, let_go, plain

#: Rows of a block, anchors of a block, blocks of a group.
ROWS, ANCHORS, GROUP = 2048, 512, 64
#: Shares of the vectors' squared length that are left when bounds are looked at, and the share of pairs that is few enough to verify singly.
LEFT, FEW = (0.5, 0.2, 0.05), 1 / 32

_BLOCK = "block long, n int, ids binary, labels binary, kind string, vectors binary"


def _scaled(column: pa.ListArray, scale: float, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) as doubles, with zeros after a vector's end, and which rows are whole."""
    there = np.asarray(column.is_valid())
    size = np.diff(column.offsets.to_numpy())
    size[~there] = 0
    dim = int(size.max(initial=0)) if dim is None else dim
    flat = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dim))
    inside = np.arange(dim) < size[:, None]
    with np.errstate(over="ignore", invalid="ignore"):
        out[inside] = np.floor(scale * flat[np.repeat(column.offsets.to_numpy()[:-1], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)])
    return out, there & np.isfinite(out).all(1)


def _moments(scale: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of a task's rows: the rows of the sum of their outer products, and how many they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        total, n = np.zeros((0, 0)), 0
        for batch in batches:
            x, ok = _scaled(batch.column(0), scale)
            x, n = x[ok], n + int(ok.sum())
            if x.shape[1] > len(total):
                total = np.pad(total, (0, x.shape[1] - len(total)))
            total[: x.shape[1], : x.shape[1]] += x.T @ x
        if n:
            rows = [r.tolist() for r in total] or [[]]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.list_(pa.float64())), pa.array([n] * len(rows), pa.int64())], names=["i", "sums", "n"])

    return run


def _added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(0), 0
    for batch in batches:
        n += sum(batch.column("n").to_pylist())
        for row in batch.column("sums"):
            row = row.values.to_numpy()
            if len(row) > len(total):
                total = np.pad(total, (0, len(row) - len(total)))
            total[: len(row)] += row
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64())), pa.array([n], pa.int64())], names=["i", "sums", "n"])


def rotation(rows: DataFrame, scale: float, vec_col: str = "vec") -> tuple[np.ndarray, tuple[int, ...], int]:
    """The principal axes of all whole rows as columns, the numbers of components after which to look at bounds, and the number of rows.

    What comes to the driver is a matrix of the vectors' dimension squared.
    """
    sums = rows.select(vec_col).mapInArrow(_moments(scale), "i int, sums array<double>, n long").groupBy("i").applyInArrow(_added, "i int, sums array<double>, n long").collect()
    dim = max((len(r.sums) for r in sums), default=0)
    matrix = np.zeros((dim, dim))
    for r in sums:
        if dim:
            matrix[r.i, : len(r.sums)] = r.sums
    size = np.abs(matrix).max(initial=0) or 1.0
    values, axes = np.linalg.eigh((matrix + matrix.T) / (2 * size)) if dim else (np.zeros(0), matrix)
    values, axes = np.maximum(values[::-1], 0), axes[:, ::-1]
    left = 1 - np.cumsum(values) / max(values.sum(), 1e-300)
    cuts = {int(np.argmax(left <= share)) + 1 for share in LEFT} if dim else set()
    return np.ascontiguousarray(axes), (*sorted(c for c in cuts if c < dim), dim), max((r.n for r in sums), default=0)


def _packed(scale: float, dim: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of at most `most` whole rows, with the smallest kind of number that holds their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        number = TaskContext.get().partitionId() << 32
        ids, labels, vectors = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, dim))

        def block(k: int) -> pa.RecordBatch:
            top = np.abs(vectors[:k]).max(initial=0)
            kind = "int16" if top < 1 << 15 else "int32" if top < 1 << 31 else "float64"
            cells = [number, len(ids[:k]), ids[:k].tobytes(), labels[:k].tobytes(), kind, vectors[:k].astype(kind).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.string(), pa.binary()), strict=True)], names=["block", "n", "ids", "labels", "kind", "vectors"])

        for batch in batches:
            x, ok = _scaled(batch.column(2), scale, dim)
            ids = np.concatenate([ids, batch.column(0).to_numpy()[ok]])
            labels = np.concatenate([labels, batch.column(1).to_numpy()[ok]])
            vectors = np.concatenate([vectors, x[ok]])
            while len(ids) >= most:
                yield block(most)
                ids, labels, vectors, number = ids[most:], labels[most:], vectors[most:], number + 1
        if len(ids):
            yield block(len(ids))

    return run


class _Side:
    """One block: its ids, labels, integer vectors, and these rotated, with the lengths that are left after each cut."""

    def __init__(self, ids: bytes, labels: bytes, kind: str, vectors: bytes, axes: np.ndarray, cuts: tuple[int, ...]) -> None:
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.whole = np.frombuffer(vectors, kind).reshape(len(self.ids), len(axes)).astype(np.float64)
        self.turned = self.whole @ axes
        self.left = {k: np.sqrt(np.square(self.turned[:, k:]).sum(1)) for k in cuts}
        self.length = np.sqrt(np.square(self.whole).sum(1))
        self.top = float(np.abs(self.whole).max(initial=0))


def _survivors(a: _Side, r: _Side, cuts: tuple[int, ...], keep: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, exact score) of the pairs that keep(lower bounds, upper bounds) leaves."""
    dim = cuts[-1]
    slack = (64 + 8 * np.sqrt(dim)) * max(dim, 1) * np.finfo(float).eps * np.outer(a.length, r.length)
    partial, begin = np.zeros((len(a.ids), len(r.ids))), 0
    for k in cuts:
        partial += a.turned[:, begin:k] @ r.turned[:, begin:k].T
        bound = np.outer(a.left[k], r.left[k]) + slack
        alive = keep(partial - bound, partial + bound)
        begin = k
        if np.count_nonzero(alive) <= FEW * alive.size:
            break
    one, other = np.nonzero(alive)
    reach = dim * a.top * r.top  # no partial sum of a product is larger
    if reach < 1 << 53 and len(one) > FEW * alive.size:
        score = (a.whole @ r.whole.T)[one, other].astype(np.int64)  # sums of integers that doubles hold exactly
    elif reach < 1 << 62:
        score, step = np.empty(len(one), np.int64), max(1, (1 << 22) // max(dim, 1))
        for b in range(0, len(one), step):
            part = slice(b, b + step)
            score[part] = np.einsum("ij,ij->i", a.whole[one[part]].astype(np.int64), r.whole[other[part]].astype(np.int64))
    else:  # whole numbers of any size
        exact = [sum(int(x) * int(y) for x, y in zip(a.whole[i], r.whole[j], strict=True)) for i, j in zip(one.tolist(), other.tolist(), strict=True)]
        fits = np.array([-(1 << 63) <= s < 1 << 63 for s in exact], bool)
        one, other, score = one[fits], other[fits], np.array([s for s in exact if -(1 << 63) <= s < 1 << 63], np.int64)
    return one, other, score


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, many: int) -> np.ndarray:
    """Where the first `many` of each group stand, in order of group, falling score and id."""
    order = np.lexsort((ids, -score, group))  # no score is the least long: it would need a sum beyond its half
    of = group[order]
    start = np.flatnonzero(np.diff(of, prepend=-1) != 0)
    place = np.arange(len(of)) - np.repeat(start, np.diff(start, append=len(of)))
    return order[place < many]


def _last_of(best: tuple[np.ndarray, np.ndarray, np.ndarray], groups: int, many: int) -> np.ndarray:
    """Of each group, the score of its last row if it has `many`, else minus infinity."""
    count = np.bincount(best[0], minlength=groups)
    least = np.full(groups, np.inf)
    np.minimum.at(least, best[0], best[1].astype(float))
    return np.where(count >= many, least, -np.inf)


def _merged(best: tuple, group: np.ndarray, score: np.ndarray, ids: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    group, score, ids = (np.concatenate(x) for x in zip(best, (group, score, ids), strict=True))
    at = _first(group, score, ids, many)
    return group[at], score[at], ids[at]


_NONE = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))


def _better_positives(a: _Side, r: _Side, best: tuple, cuts: tuple[int, ...], many: int, _) -> tuple:
    for label in np.intersect1d(a.labels, r.labels):
        own, rows = np.flatnonzero(a.labels == label), np.flatnonzero(r.labels == label)
        part_a, part_r = _part(a, own), _part(r, rows)
        other = part_a.ids[:, None] != part_r.ids
        so_far = _last_of(best, len(a.ids), many)[own]

        def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
            floor = so_far
            if lower.shape[1] > many:
                floor = np.maximum(floor, np.partition(np.where(other, lower, -np.inf), -many, axis=1)[:, -many])
            return other & (upper >= floor[:, None])

        one, row, score = _survivors(part_a, part_r, cuts, keep)
        best = _merged(best, own[one], score, part_r.ids[row], many)
    return best


def _part(side: _Side, at: np.ndarray) -> _Side:
    new = object.__new__(_Side)
    new.ids, new.labels, new.whole, new.turned, new.length, new.top = side.ids[at], side.labels[at], side.whole[at], side.turned[at], side.length[at], side.top
    new.left = {k: v[at] for k, v in side.left.items()}
    return new


def _better_negatives(a: _Side, r: _Side, best: tuple, cuts: tuple[int, ...], many: int, bands: tuple) -> tuple:
    """bands: the least and the greatest score that each positive (row) of each anchor (column) allows; none where least > greatest."""
    least, greatest = bands
    places = len(least)
    differ = a.labels[:, None] != r.labels
    so_far = _last_of(best, len(a.ids) * places, many).reshape(len(a.ids), places)

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        alive = np.zeros(lower.shape, bool)
        for k in range(places):
            alive |= (upper >= np.maximum(least[k], so_far[:, k])[:, None]) & (lower <= greatest[k][:, None])
        return alive & differ

    one, row, score = _survivors(a, r, cuts, keep)
    for k in range(places):
        ok = (score >= least[k][one]) & (score <= greatest[k][one])
        best = _merged(best, one[ok] * places + k, score[ok], r.ids[row[ok]], many)
    return best


def _over_pairs(better: Callable, axes, cuts: tuple[int, ...], many: int, places: int, low: int, high: int):
    """Streams through pairs of blocks; yields the best of each block of anchors whenever another follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        turn = axes.value
        now, side, bands, best = None, None, None, _NONE

        def out() -> pa.RecordBatch:
            of, place = best[0] // places, best[0] % places
            cells = [np.full(len(of), now), of, place, side.ids[of], best[2], best[1]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cells], names=["block", "at", "place", "anchor_id", "vec_id", "score"])

        for batch in batches:
            col = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            for k in range(batch.num_rows):
                cell = {name: c[k].as_py() for name, c in col.items() if not name.startswith("p_")}
                if cell["block"] != now:
                    if len(best[0]):
                        yield out()
                    now, best = cell["block"], _NONE
                    side = _Side(cell["ids"], cell["labels"], cell["kind"], cell["vectors"], turn, cuts)
                    if "p_at" in col:
                        at, place, score = (col[c][k].values.to_numpy() for c in ("p_at", "p_place", "p_score"))
                        # Python's whole numbers: a hundred times a score may not fit a long
                        bands = (np.full((places, len(side.ids)), np.inf), np.full((places, len(side.ids)), -np.inf))
                        bands[0][place, at] = [float(-(-low * s // 100)) for s in score.tolist()]
                        bands[1][place, at] = [float(high * s // 100) for s in score.tolist()]
                rows = _Side(cell["r_ids"], cell["r_labels"], cell["r_kind"], cell["r_vectors"], turn, cuts)
                best = better(side, rows, best, cuts, many, bands)
        if len(best[0]):
            yield out()

    return lean(run)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, scale: float = 256.0, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each anchor and each of its first `positives` other rows of its label, the first `negatives` rows of other labels
    with low * positive_score <= 100 * negative_score <= high * positive_score. Higher scores come first, smaller ids among equals.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("__anchor", is_anchor)
    rows = plain(rows, id_col, label_col, vec_col, "__anchor").toDF("vec_id", "label", "vec", "anchor").where("vec_id is not null and label is not null and vec is not null")
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "vec", F.coalesce("anchor", F.lit(False)).alias("anchor"))
    axes, cuts, _ = rotation(rows, scale)
    dim = cuts[-1]
    turn = spark.sparkContext.broadcast(axes)
    data = durable(rows.drop("anchor").mapInArrow(lean(_packed(scale, dim, ROWS)), _BLOCK), "negatives-rows")
    asked = rows.where("anchor").drop("anchor")
    spread = max(1, min(spark.sparkContext.defaultParallelism, -(-data.rows * ROWS // ANCHORS)))
    asked = durable(asked.repartition(spread).mapInArrow(lean(_packed(scale, dim, ANCHORS)), _BLOCK), "negatives-anchors")

    groups = max(1, min(data.rows, max(4 * spark.sparkContext.defaultParallelism, -(-data.rows // GROUP))))
    data = data.toDF(*(f"r_{c}" for c in data.columns)).withColumn("g", F.pmod(F.xxhash64("r_block"), F.lit(groups))).repartition(groups, "g")

    def over_pairs(anchors: DataFrame, better: Callable, many: int, places: int) -> DataFrame:
        dealt = anchors.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>"))).repartition(groups, "g")
        found = dealt.hint("merge").join(data, "g").drop("g").mapInArrow(_over_pairs(better, turn, cuts, many, places, low, high), "block long, at long, place long, anchor_id long, vec_id long, score long")
        order = Window.partitionBy("block", "at", "place").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(f"rank <= {many}")

    first = durable(over_pairs(asked, _better_positives, positives, 1), "negatives-positives")
    of_block = first.groupBy("block").agg(F.collect_list(F.struct("at", (F.col("rank") - 1).cast("long").alias("place"), "score")).alias("p"))
    of_block = of_block.select("block", *(F.col(f"p.{c}").alias(f"p_{c}") for c in ("at", "place", "score")))
    second = over_pairs(asked.join(of_block, "block"), _better_negatives, negatives, positives)
    named = first.select("block", "at", (F.col("rank") - 1).cast("long").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = second.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(named, ["block", "at", "place"])
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
