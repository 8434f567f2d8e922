"""Listings of source files against what has been loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listing(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """uri, mtime and bytes of the files below ``path``; their content is not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("uri"), F.col("modificationTime").alias("mtime"), F.col("length").alias("bytes"))


def plan(now: DataFrame, loaded: DataFrame, key: str = "uri", version: str = "mtime") -> DataFrame:
    """key and state: new, changed, unchanged or deleted."""
    a, b = now.select(F.col(key).alias("_a"), F.col(version).alias("_va")), loaded.select(F.col(key).alias("_b"), F.col(version).alias("_vb"))
    state = F.when(F.col("_b").isNull(), "new").when(F.col("_a").isNull(), "deleted").when(~F.col("_va").eqNullSafe(F.col("_vb")), "changed").otherwise("unchanged")
    return a.join(b, F.col("_a") == F.col("_b"), "outer").select(F.coalesce("_a", "_b").alias(key), state.alias("state"))


def expected_points(spark: SparkSession, path: str, glob: str, tag: str = "<trkpt") -> DataFrame:
    """uri and how often ``tag`` stands in the file: a count that no parser made."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("uri"), F.regexp_count(F.col("content").cast("string"), F.lit(tag)).cast("long").alias("points"))
