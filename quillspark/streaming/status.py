"""Status events as a stream. An extension: records are otherwise processed in batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def events(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet") -> DataFrame:
    """Files of a folder as a stream, with an event time that can be watermarked."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(stream: DataFrame, keys: list[str], length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums of values by event-time window; state is dropped behind the watermark."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", length), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), *keys, "n", "total")


def sessions(stream: DataFrame, keys: list[str], gap: str, late: str = "10 minutes") -> DataFrame:
    """Active periods of a key: a gap without events ends one."""
    return stream.withWatermark("ts", late).groupBy(F.session_window("ts", gap), *keys).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "n")


def keep_latest(stream: DataFrame, keys: list[str], order: list[str], checkpoint: str, changed: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Keeps the last row of each key in the query's state: rows of equal order go by their other columns, null before all values.

    The state is dealt by key and kept in the checkpoint. A batch reads and writes the states of its own keys, so what it costs follows
    the batch and not all that came before; a query that starts again from the checkpoint goes on where the last batch was committed.
    changed: gets, per batch, the rows that are new to their keys, as often as a batch is run; in a table, write them under the batch's number.
    """
    rest = [c for c in stream.columns if c not in keys and c not in order]
    state = stream.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("state"))

    def hand_on(batch: DataFrame, epoch: int) -> None:
        changed(batch.select(*keys, "state.*"), epoch)

    writer = state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.foreachBatch(hand_on) if changed else writer.format("noop")).start()


def live(spark: SparkSession, checkpoint: str) -> DataFrame:
    """All keys and their last rows, as of the last batch committed: read from the state itself, while the query runs or after it."""
    return spark.read.format("statestore").load(checkpoint).select("key.*", "value.max.*")
