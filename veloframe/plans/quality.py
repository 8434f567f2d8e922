"""Data-quality rules. Each gives the violating rows; none means the rule holds."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """NULL passes."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def between(df: DataFrame, column: str, least, most) -> DataFrame:
    """NULL passes."""
    return df.filter(~F.col(column).between(least, most))


def fresh(df: DataFrame, date: str, as_of: dt.date, days: int = 14) -> DataFrame:
    """A row if the latest date is over ``days`` old, or there is none."""
    age = F.datediff(F.lit(as_of), F.max(date))
    return df.agg(F.max(date).alias("latest"), age.alias("age")).filter(F.col("age").isNull() | (F.col("age") > days))


def excludes_duplicates(mart: DataFrame, silver: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Sports whose kilometres differ between the mart and the activities that aren't duplicates."""
    expected = silver.filter(~F.col("is_duplicate")).groupBy("sport").agg(F.sum("distance_km").alias("expected"))
    both = mart.select(F.col("sport").alias("_s"), F.col("distance_km").alias("found")).join(expected, F.col("_s") == F.col("sport"), "outer")
    gap = F.abs(F.coalesce("found", F.lit(0.0)) - F.coalesce("expected", F.lit(0.0)))
    return both.select(F.coalesce("_s", "sport").alias("sport"), "found", "expected").filter(gap > tolerance)


def reconciled(audit: DataFrame) -> DataFrame:
    """Tables whose latest run loaded another number of rows than its source held."""
    latest = Window.partitionBy("table_name").orderBy(F.desc("run_ts"), F.desc("loaded_count"))
    return audit.withColumn("_rn", F.row_number().over(latest)).filter("_rn = 1 and not (source_count <=> loaded_count)").drop("_rn")


def volume_drops(df: DataFrame, key: str, order: str, count: str, share: float = 0.05, latest_only: bool = False) -> DataFrame:
    """Rows whose count is under (1 - share) of the one before."""
    w = Window.partitionBy(key).orderBy(order)
    out = df.select(key, order, count, F.lag(count).over(w).alias("before"), F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order))).alias("_rn"))
    if latest_only:
        out = out.filter("_rn = 1")
    return out.drop("_rn").filter(F.col(count) < (1 - share) * F.col("before"))


def biased(df: DataFrame, difference: str, most: float = 15.0) -> DataFrame:
    """A row if the mean difference is beyond ``most``."""
    return df.agg(F.avg(difference).alias("bias")).filter(F.abs("bias") > most)


def covered(expected: DataFrame, found: DataFrame, key: str, share: float = 0.95) -> DataFrame:
    """A row if under ``share`` of the expected keys are found."""
    a = expected.select(key).distinct().agg(F.count(F.lit(1)).alias("expected"))
    b = found.select(key).distinct().join(expected.select(key).distinct(), key, "left_semi").agg(F.count(F.lit(1)).alias("found"))
    return a.crossJoin(F.broadcast(b)).filter(F.col("found") < share * F.col("expected"))


def no_literal_none(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Texts that say 'None' or are blank where NULL is meant."""
    parts = [df.filter(F.trim(F.col(c)).isin("None", "")).select(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
    return reduce(DataFrame.unionByName, parts)


def unlinked(symptoms: DataFrame) -> DataFrame:
    return symptoms.filter(F.col("link_method").isin("ambiguous", "unmatched"))


def report(rules: Mapping[str, DataFrame]) -> DataFrame:
    """rule, violations."""
    counts = [v.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations") for name, v in rules.items()]
    return reduce(DataFrame.unionByName, counts)


def differences(a: DataFrame, b: DataFrame, keys: Sequence[str], values: Sequence[str], relative: float = 1e-6) -> DataFrame:
    """Cells that differ between two tables by more than ``relative``, with rows that only one has."""
    def apart(c: str) -> Column:
        x, y = F.col(f"a.{c}"), F.col(f"b.{c}")
        both = F.abs(x - y) > relative * F.greatest(F.abs(x), F.abs(y), F.lit(1e-12))
        return F.when(x.isNull() | y.isNull(), ~x.eqNullSafe(y)).otherwise(both)

    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    joined = a.withColumn("_in", F.lit(1)).alias("a").join(b.withColumn("_in", F.lit(1)).alias("b"), on, "outer")
    named = [F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"a.{c}").cast("string").alias("left"), F.col(f"b.{c}").cast("string").alias("right"), apart(c).alias("apart")) for c in values])
    out = joined.select(*named, F.col("a._in").alias("_a"), F.col("b._in").alias("_b"), F.inline(cells))
    return out.filter(F.col("_a").isNull() | F.col("_b").isNull() | F.col("apart")).drop("_a", "_b", "apart")
