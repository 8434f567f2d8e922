"""Extensions beyond batch: files as a stream, debounced notifications, windowed sums, idempotent upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.store import Store


def new_files(spark: SparkSession, path: str, schema: str, kind: str = "json") -> DataFrame:
    """Each file once; run with ``trigger(availableNow=True)`` in place of a poll."""
    return spark.readStream.schema(schema).format(kind).load(path)


def debounced(events: DataFrame, key: str, ts: str, quiet: str = "90 seconds", late: str = "5 minutes") -> DataFrame:
    """One row for each burst of a key's notifications, once it has been quiet."""
    return events.withWatermark(ts, late).groupBy(key, F.session_window(ts, quiet).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("first"), F.col("w.end").alias("due"), "n")


def windowed_totals(events: DataFrame, key: str, ts: str, value: str, length: str = "1 hour", late: str = "2 hours") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.window(ts, length).alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(key, F.col("w.start").alias("start"), "n", "total")


def upsert_batches(stream: DataFrame, store: Store, table: str, keys: list[str], newest: str, checkpoint: str):
    """A stream into a store table; a batch that is run again gives the same table."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, _: store.upsert(table, df, keys, newest)).start()
