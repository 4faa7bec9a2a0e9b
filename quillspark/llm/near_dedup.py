"""Near-duplicate groups by min-max hashing, confirmed on full shingle sets.

Plan
----
1. One pass over the texts (Arrow batches) makes, per document, the size of its set of
   word shingles, a 128-bit hash of the set, and a min-max sketch: under each of
   ``PERMUTATIONS`` hash permutations both the smallest and the largest value are kept, so
   one evaluation gives two sketch entries. ``BAND_ROWS`` entries form a band.
2. Documents of equal sets are one class, represented by the smallest doc_id.
3. Representatives that share a band are candidates. Instead of all pairs of a bucket, each
   member is paired with two hubs: the bucket's smallest doc_id, and its most central member, the one whose
   bands have the most members in all (the copy that the others were made from keeps the most minima).
4. Candidates that survive size and bit-sketch bounds are confirmed on the full sets.
5. Confirmed links are contracted to components by alternating large-star and small-star.
6. Buckets that still hold several components are revisited. Components that meet in such buckets form a
   family; its members are dealt into blocks of bounded size, and each pair of blocks finds, on the
   full sets, the links between different components. Only links leave that step, so no link that could
   join two components is lost, and no pair is emitted that is none. Pairs inside one component cannot change the result.

With 100 entries in 25 bands of 4, a pair at the threshold of 0.85 shares no band with a
probability of (1 - 0.85**4)**25 = 1e-8. Of 100 sketch bits, 20 may differ there,
five standard deviations over the expected 7.5.

Edge cases: null texts and texts without words have the empty set, are linked with nothing and
are kept. Rows with a null doc_id are linked with nothing. A repeated doc_id gives a row each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from quillspark.llm.common import WordHashes, durable, join_counted, lean, let_go, plain, word_shingles

PERMUTATIONS, BAND_ROWS = 50, 4
ENTRIES = 2 * PERMUTATIONS
BANDS = ENTRIES // BAND_ROWS

#: The most shingles of a block of a family (but for one set), those up to which a family is one block, and the blocks that it gets for the sake of spreading its work.
BLOCK_SHINGLES, SMALL_FAMILY, SPREAD = 1_000_000, 15_000, 16
#: Postings of a block that are looked at at once.
POSTINGS = 500_000
#: Shingles gathered before a block is sketched: small enough to stay in a core's cache.
BLOCK = 200_000

_rng = np.random.default_rng(20240607)
_MUL = (_rng.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)

SKETCH = "doc_id long, n_shingles long, set_hash binary, bands array<long>, bits0 long, bits1 long"


def _sets(texts: list[bytes | None], width: int, cache: WordHashes) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text. bytes.lower() and split() are ASCII only: A-Z and [\\x20\\x09-\\x0D]."""
    for text in texts:
        words = text.lower().split() if text else []
        yield np.unique(word_shingles(cache.of(words), width))


def _sketch(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes (sets x BANDS) and two 64-bit words of sketch bits per set."""
    v = (values >> np.uint64(32)).astype(np.uint32)
    sig = np.empty((len(starts), ENTRIES), dtype=np.uint32)
    for k in range(PERMUTATIONS):
        p = v * _MUL[k] + _ADD[k]
        p ^= p >> np.uint32(15)
        sig[:, 2 * k] = np.minimum.reduceat(p, starts)
        sig[:, 2 * k + 1] = np.maximum.reduceat(p, starts)
    bands = np.zeros((len(starts), BANDS), dtype=np.uint64)
    for r in range(BAND_ROWS):
        bands = (bands + sig[:, r::BAND_ROWS]) * np.uint64(0x9E3779B97F4A7C15)
        bands ^= bands >> np.uint64(29)
    bands = (bands + np.arange(BANDS, dtype=np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
    bit = ((sig * np.uint32(0x9E3779B1)) >> np.uint32(31)).astype(np.uint64)
    half = ENTRIES // 2
    weights = np.uint64(1) << np.arange(half, dtype=np.uint64)
    return bands, np.stack([(bit[:, :half] * weights).sum(1), (bit[:, half:] * weights).sum(1)], axis=1)


def _sketcher(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        cache = WordHashes()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at, rows = 0, batch.num_rows
            while at < rows:
                sets, size, begin = [], 0, at
                while at < rows and size < BLOCK:
                    one = next(_sets([texts[at].as_buffer().to_pybytes() if texts[at].is_valid else None], width, cache))
                    sets.append(one)
                    size += len(one)
                    at += 1
                yield _block(ids.slice(begin, at - begin), sets)

    return run


def _block(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
    n = np.array([len(s) for s in sets], dtype=np.int64)
    full = np.flatnonzero(n)
    bands, bits = np.zeros((len(sets), BANDS), np.uint64), np.zeros((len(sets), 2), np.uint64)
    if len(full):
        bands[full], bits[full] = _sketch(np.concatenate(sets), np.concatenate([[0], np.cumsum(n[full])[:-1]]))
    hashes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
    offsets = pa.array(np.arange(0, len(sets) * BANDS + 1, BANDS, dtype=np.int32))
    return pa.RecordBatch.from_arrays(
        [
            ids.cast(pa.int64()),
            pa.array(n),
            pa.array(hashes, pa.binary()),
            pa.ListArray.from_arrays(offsets, pa.array(bands.view(np.int64).ravel())),
            pa.array(bits[:, 0].view(np.int64)),
            pa.array(bits[:, 1].view(np.int64)),
        ],
        names=["doc_id", "n_shingles", "set_hash", "bands", "bits0", "bits1"],
    )


def _set_maker(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        cache = WordHashes()
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                sets = list(_sets(part.column(1).to_pylist(), width, cache))
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["doc_id", "shingles"])

    return run


def _cross_linker(percent: int):
    """Links between members of different components, of one pair of blocks."""

    def run(table: pa.Table) -> pa.Table:
        doc, component = table.column("doc_id").to_numpy(), table.column("component").to_numpy()
        lists = table.column("shingles").combine_chunks()
        values, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
        owner = np.repeat(np.arange(len(doc)), sizes)
        names, at, times = np.unique(values, return_inverse=True, return_counts=True)
        order = np.argsort(at, kind="stable")
        begin, of = np.concatenate([[0], np.cumsum(times)]), owner[order]
        # What a set has in common with any other is at most what it has in common with all.
        common = np.bincount(owner, weights=times[at] > 1, minlength=len(doc))
        _, group, members = np.unique(component, return_inverse=True, return_counts=True)
        rank = np.argsort(np.argsort(-members, kind="stable"), kind="stable")[group]  # the largest component is not a start
        starts = np.concatenate([[0], np.cumsum(sizes)])
        a, b = [], []
        for x in np.flatnonzero((rank > 0) & (100 * common >= percent * sizes)):
            mine = at[starts[x] : starts[x + 1]]
            mine = mine[times[mine] > 1]
            hits = np.zeros(len(doc), np.int64)
            for part in np.split(mine, np.flatnonzero(np.diff(np.cumsum(times[mine]) // POSTINGS)) + 1):
                counts = times[part]
                inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                hits += np.bincount(of[np.repeat(begin[part], counts) + inner], minlength=len(doc))
            for y in np.flatnonzero((rank < rank[x]) & ((100 + percent) * hits >= percent * (sizes + sizes[x]))):
                a.append(int(doc[x]))
                b.append(int(doc[y]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def connected_components(links: DataFrame, most: int) -> DataFrame:
    """node, component (its smallest reachable node) of every node that has a link (a, b). most: a bound on the links."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v")).where("u != v").distinct()
        edges = durable(small, "edges", 2 * most)
        # Done when all are stars: every node has one edge down, and what it leads to has none.
        roots = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi")
        if roots.isEmpty() and edges.groupBy("u").count().where("count > 1").isEmpty():
            break
        most = edges.rows
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return durable(nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "groups", 2 * edges.rows)


def near_duplicates(docs: DataFrame, shingle_words: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs.

    Two documents are linked if 100 * |intersection| >= percent * |union| over their shingle sets;
    component_id is the smallest doc_id reachable over links, kept says that it is the row's own. id_col must be of integers.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be of integers, since groups are named by their smallest")
    source = plain(docs, id_col, text_col).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    sketches = durable(source.mapInArrow(lean(_sketcher(shingle_words)), SKETCH), "sketches")
    filled = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = durable(filled.groupBy("set_hash").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes", sketches.rows)
    facts = durable(
        filled.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select("doc_id", F.col("n_shingles").alias("n"), "bits0", "bits1", "bands"),
        "facts", classes.rows, 20_000,
    )
    banded = facts.select("doc_id", F.posexplode("bands").alias("k", "band"))
    buckets = banded.groupBy("band").agg(F.min("doc_id").alias("low"), F.count("*").alias("members")).where("members > 1")
    shared = durable(banded.join(buckets, "band"), "shared", BANDS * facts.rows, 250_000)
    central = shared.groupBy("doc_id").agg(F.sum("members").alias("weight"))
    hubs = shared.join(central, "doc_id").groupBy("band").agg(F.max(F.struct("weight", (-F.col("doc_id")).alias("minus"))).alias("top")).select("band", (-F.col("top.minus")).alias("hub"))
    near = shared.select("doc_id", F.col("low").alias("hub")).unionByName(shared.join(hubs, "band").select("doc_id", "hub")).where("doc_id != hub")
    sets = durable(source.join(central.select("doc_id"), "doc_id", "left_semi").mapInArrow(lean(_set_maker(shingle_words)), "doc_id long, shingles array<long>"), "sets", facts.rows, 4_000)

    def side(frame: DataFrame, p: str, *keys: str) -> DataFrame:
        return frame.select(*keys, *[F.col(c).alias(f"{p}_{c}" if c != "doc_id" else p) for c in frame.columns if c not in keys])

    known = facts.drop("bands")
    pairs = near.select(F.least("doc_id", "hub").alias("a"), F.greatest("doc_id", "hub").alias("b")).distinct()
    pairs = pairs.join(side(known, "a"), "a").join(side(known, "b"), "b").where(_plausible(percent)).select("a", "b", "a_n", "b_n")
    both = pairs.join(side(sets, "a"), "a").join(side(sets, "b"), "b")
    links = durable(both.where(_linked(percent)).select("a", "b").distinct(), "links", 2 * shared.rows, 20_000)
    groups = connected_components(links, links.rows)

    placed = shared.select("band", "doc_id").join(groups.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select("band", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    split = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("band", "lo")
    open_rows = durable(placed.join(split, "band").groupBy("doc_id", "component", "lo").agg(F.lit(1)).drop("1"), "open", shared.rows)
    families = connected_components(open_rows.select(F.col("component").alias("a"), F.col("lo").alias("b")), open_rows.rows)
    members = open_rows.select("doc_id", "component").distinct().join(families.select(F.col("node").alias("component"), F.col("component").alias("family")), "component")
    members = durable(members.join(sets, "doc_id"), "members", open_rows.rows, 10_000)
    size = F.sum(F.size("shingles"))
    blocks = members.groupBy("family").agg(F.count("*").alias("n"), F.greatest(F.ceil(size / BLOCK_SHINGLES), F.least(F.ceil(size / SMALL_FAMILY), F.lit(SPREAD))).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    dealt = join_counted(members, durable(blocks, "blocks", members.rows), ["family"], "n", members.rows).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("family", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "doc_id", "component", "shingles")
    # By block pair: dealt by family alone, as the join leaves it, all pairs of a family would meet in one task.
    dealt = dealt.repartition("family", "low", "high")
    more = durable(dealt.groupBy("family", "low", "high").applyInArrow(_cross_linker(percent), "a long, b long"), "links")
    if not more.isEmpty():
        groups = connected_components(links.unionByName(more), links.rows + more.rows)

    placed = classes.join(groups, classes.rep == groups.node, "left").select("set_hash", "copies", F.coalesce("component", "rep").alias("component_id"))
    placed = durable(placed, "placed", classes.rows)
    alone = sketches.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = join_counted(filled.select("doc_id", "n_shingles", "set_hash"), placed, ["set_hash"], "copies", sketches.rows).select("doc_id", "n_shingles", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))


def _most_bits(percent: int) -> int:
    """Sketch bits that may differ: five standard deviations over what is expected at the threshold."""
    p = (1 - percent / 100) / 2
    return int(ENTRIES * p + 5 * (ENTRIES * p * (1 - p)) ** 0.5)


def _plausible(percent: int) -> str:
    return (
        f"100 * least(a_n, b_n) >= {percent} * greatest(a_n, b_n)"
        f" and bit_count(a_bits0 ^ b_bits0) + bit_count(a_bits1 ^ b_bits1) <= {_most_bits(percent)}"
    )


def _linked(percent: int) -> str:
    """100 * common >= percent * (a_n + b_n - common), on the full sets."""
    return f"(100 + {percent}) * size(array_intersect(a_shingles, b_shingles)) >= {percent} * (a_n + b_n)"
