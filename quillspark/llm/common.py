"""What the corpus operators share: table reading, scratch tables and word hashing.

Scratch tables cut lineage. They are Parquet folders under the folder that the cluster
names in ``spark.checkpoint.dir``, so a lost executor never takes an intermediate
result with it. A machine-local folder is only ever used in local mode.
"""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

_U = np.uint64
#: Odd multipliers of the word mixer.
_K1, _K2, _K3, _K4 = (_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
#: Words kept in a worker's word-to-hash cache before it is emptied.
CACHE_WORDS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The shared folder for scratch tables; a temporary one in local mode if none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="quillspark-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def durable(df: DataFrame, name: str, most_rows: int | None = None, file_rows: int = 200_000) -> DataFrame:
    """Writes df once as Parquet in the shared folder and returns a reader of it, whose attribute `rows` is its row count.

    most_rows: a bound on its rows, where one is known, from which the number of files follows: narrow tables don't
    become one tiny file a shuffle partition, and large ones keep as many files as they need.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/quillspark/{name}-{uuid.uuid4().hex}"
    if most_rows is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, -(-most_rows // file_rows)))
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.rows = seen.get["n"]
    return written


def plain(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that other columns of the input can never clash."""
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def fresh(name: str, columns: list[str]) -> str:
    """The name, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


_held: dict = {}


def held(key: tuple, make: Callable[[], object]) -> object:
    """An object that a worker keeps between tasks. It keeps one at a time."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Frees what a worker kept; called by operators that keep nothing, so that memory isn't held for others."""
    _held.clear()


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow; when a task ends, the worker gives what it freed back to the system, since workers stay while other stages need the memory."""

    def lean_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim:
                trim(0)

    return lean_run


def widened(df: DataFrame, **more: str | DataType) -> StructType:
    """df's schema with more columns; a new one, since StructType.add changes its own."""
    schema = StructType(list(df.schema.fields))
    for name, kind in more.items():
        schema.add(name, kind)
    return schema


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, filled on demand, bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _K4
    return h ^ (h >> _U(29))


def word_shingles(ids: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words; a shorter text is one run; none without words."""
    n = len(ids)
    if not n:
        return ids
    k = min(width, n)
    h = np.full(n - k + 1, _U(k), dtype=np.uint64)
    for i in range(k):
        h = (h + ids[i : n - k + 1 + i]) * _K1
        h ^= h >> _U(31)
        h *= _K2
    return mixed(h)


def join_counted(rows: DataFrame, counted: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Inner join of rows with a table that has one row and the count of rows for a key.

    Keys with a thousandth of all rows or more are at most a thousand, so they are broadcast; all
    others are joined by shuffle, where no key can then be a large part of a task.
    """
    heavy = F.broadcast(counted.where(F.col(count) * 1000 >= total))
    light = counted.where(F.col(count) * 1000 < total)
    return rows.join(heavy, keys).unionByName(rows.join(heavy.select(keys), keys, "left_anti").join(light, keys))
