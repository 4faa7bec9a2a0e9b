"""A keyed table that is changed by the bucket.

Rows are dealt to buckets by a hash of their keys. A write makes new folders for the buckets that it touches and leaves all others as they are; then a manifest
that says where each bucket is, one small file, makes the switch. Readers take the last manifest that was written to its end, so a write that is
interrupted anywhere leaves the rows as they were, and the next write takes its place. One writer at a time; readers may go on with the version
they have begun with. Folders that no manifest in use names may be deleted.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.sources.scratch import written


class BucketTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: str, buckets: int = 64) -> None:
        """schema: the columns, in DDL. keys, schema and buckets are those that the table was made with."""
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        self.schema = spark.createDataFrame([], schema).schema

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def manifest(self) -> tuple[int, dict[int, str]]:
        """The last version and the folder of each bucket that has rows: as many entries as buckets at most. Version 0 has none."""
        try:
            every = self.spark.read.schema("bucket int, folder string, version int").option("basePath", f"{self.path}/manifests").json(f"{self.path}/manifests")
            last = every.agg(F.max("version")).first()[0]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            last = None
        if last is None:
            return 0, {}
        return last, {r.bucket: r.folder for r in every.where(F.col("version") == last).collect() if r.bucket is not None}

    def read(self, only: set[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        folders = [f for b, f in sorted(self.manifest()[1].items()) if only is None or b in only]
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{f}" for f in folders]) if folders else self.spark.createDataFrame([], self.schema)

    def upsert(self, changes: DataFrame) -> int:
        """Replaces the rows whose keys changes has, adds its other rows, and returns the new version. changes: one row a key."""
        dealt = written(changes.select(*self.schema.names).withColumn("bucket", self._bucket()), "changes")
        touched = {r.bucket for r in dealt.select("bucket").distinct().collect()}
        version, folders = self.manifest()
        if not touched:
            return version
        new = dealt.select(*[F.col(k).alias(f"_{k}") for k in self.keys])
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys))
        kept = self.read(touched).withColumn("bucket", self._bucket()).join(new, same, "left_anti")
        write = f"write={version + 1}-{uuid.uuid4().hex}"
        kept.unionByName(dealt).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{write}")
        self._switch(version + 1, folders | {b: f"{write}/bucket={b}" for b in touched})
        return version + 1

    def _switch(self, version: int, folders: dict[int, str]) -> None:
        """One file, which Spark moves into place when it is complete."""
        rows = self.spark.createDataFrame(sorted(folders.items()), "bucket int, folder string")
        rows.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifests/version={version}")
