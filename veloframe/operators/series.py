"""Operators on keyed, timed values. Frames are ranges of time, never rows, unless said; every order is total.

All windows of one call share partitioning and order, so they plan as one exchange, one sort and one window.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def trailing(what: str, key: str, ts: str, seconds: int) -> Column:
    """``what`` (an aggregate in SQL) over the trailing seconds, both ends in."""
    return F.expr(f"{what} over (partition by {key} order by {ts} range between interval {seconds} seconds preceding and current row)")


def l4_mean(c: Column) -> Column:
    """The fourth root of the mean fourth power."""
    return F.pow(F.avg(F.pow(c, 4)), 0.25)


def normalised_power(df: DataFrame, key: str, ts: str, value: str, seconds: int = 30) -> DataFrame:
    """For each key: L4 mean of the trailing mean, plain mean, most, count."""
    smooth = df.filter(F.col(value).isNotNull()).select(key, value, trailing(f"avg({value})", key, ts, seconds).alias("smooth"))
    return smooth.groupBy(key).agg(l4_mean(F.col("smooth")).alias("np"), F.avg(value).alias("mean"), F.max(value).alias("most"), F.count(value).alias("n"))


def best_means(df: DataFrame, key: str, ts: str, value: str, windows: Sequence[tuple[int, int]]) -> DataFrame:
    """For each key and window (seconds, least samples): the best trailing mean among complete windows; NULL windows don't appear."""
    means = [F.when(trailing(f"count({value})", key, ts, s) >= n, trailing(f"avg({value})", key, ts, s)).alias(f"w{s}") for s, n in windows]
    return _best(df.select(key, *means), key, windows)


def best_means_by_second(df: DataFrame, key: str, ts: str, value: str, windows: Sequence[tuple[int, int]]) -> DataFrame:
    """``best_means`` for samples at whole seconds, in time that does not depend on the windows' lengths.

    A range frame is summed anew for every row. Here the seconds between samples become empty rows, and a window is the difference of two running
    sums, ``seconds`` + 1 rows apart. Gaps longer than the longest window stay gaps: what is behind them is a part of its own.
    """
    longest = max(s for s, _ in windows)
    by = Window.partitionBy(key).orderBy("t")
    each = df.filter(F.col(value).isNotNull()).groupBy(key, F.unix_seconds(ts).alias("t")).agg(F.sum(F.col(value).cast("double")).alias("v"), F.count(F.lit(1)).alias("n"))
    each = each.withColumns({"_next": F.lead("t").over(by), "_before": F.lag("t").over(by)})
    each = each.withColumn("_part", F.sum(F.when(F.col("t") - F.col("_before") > longest, 1).otherwise(0)).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.when(F.col("_next") - F.col("t") <= longest, F.col("_next") - 1).otherwise(F.col("t"))
    dense = each.withColumn("s", F.explode(F.sequence("t", last))).withColumn("_own", F.col("s") == F.col("t"))
    part = Window.partitionBy(key, "_part").orderBy("s")
    run = part.rowsBetween(Window.unboundedPreceding, 0)
    sums = dense.select(key, "_part", "s", "_own", F.sum(F.when(F.col("_own"), F.col("v")).otherwise(0.0)).over(run).alias("v"), F.sum(F.when(F.col("_own"), F.col("n")).otherwise(0)).over(run).alias("n"))
    behind = lambda c, s: F.col(c) - F.lag(c, s + 1, 0).over(part)
    means = [F.when(F.col("_own") & (behind("n", s) >= n), behind("v", s) / behind("n", s)).alias(f"w{s}") for s, n in windows]
    return _best(sums.select(key, *means), key, windows)


def _best(means: DataFrame, key: str, windows: Sequence[tuple[int, int]]) -> DataFrame:
    best = means.groupBy(key).agg(*[F.max(f"w{s}").alias(f"w{s}") for s, _ in windows])
    pairs = ", ".join(f"{s}, w{s}" for s, _ in windows)
    return best.selectExpr(key, f"stack({len(windows)}, {pairs}) as (seconds, best)").filter("best is not null")


def top_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group by a total order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def zones(value: Column, bounds: Sequence[float | Column]) -> Column:
    """1 and up: the first bound that the value is under."""
    out = F.when(value < bounds[0], 1)
    for i, b in enumerate(bounds[1:], 2):
        out = out.when(value < b, i)
    return out.otherwise(len(bounds) + 1)


def sessions(df: DataFrame, keys: Sequence[str], start: str, end: str, rank: Sequence[Column], tie: str, scope: Column | None = None, compat: bool = False) -> DataFrame:
    """Transitive overlap groups: overlap_group, group_size, is_duplicate, duplicate_of.

    A row begins a group when it starts no earlier than every earlier end. In a group the first by ``rank`` stays and the
    others are flagged, not dropped. Rows outside ``scope`` never take part; with ``compat`` they split groups of the rows
    around them, as a known earlier rule did.
    """
    inside = F.coalesce(scope, F.lit(False)) if scope is not None else F.lit(True)
    df = df.withColumn("_in", inside)
    part = [*keys] if compat else [*keys, "_in"]
    order = Window.partitionBy(*part).orderBy(start, tie)
    before = F.max(F.when(F.col("_in"), F.col(end))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("_in") & before.isNotNull() & (F.col(start) < before), 0).otherwise(1)
    out = df.withColumn("_new", new).withColumn("overlap_group", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    group = Window.partitionBy(*part, "overlap_group")
    first = group.orderBy(*rank, tie)
    out = out.withColumns({"group_size": F.count(F.lit(1)).over(group), "_rn": F.row_number().over(first), "_winner": F.first(tie).over(first)})
    flagged = F.col("_in") & (F.col("_rn") > 1) if not compat else F.col("_rn") > 1
    return out.withColumns({"is_duplicate": flagged, "duplicate_of": F.when(flagged, F.col("_winner"))}).drop("_in", "_new", "_rn", "_winner")


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, values: Sequence[str]) -> DataFrame:
    """``left`` with each of ``values`` from the latest right row at or before it. One pass over the union; no range join, no fan-out.

    Right rows of equal time: the greatest values win.
    """
    packed = F.struct(right_ts, *values)
    tagged = left.withColumns({"_t": F.col(left_ts), "_side": F.lit(1), "_v": F.lit(None).cast(right.select(packed.alias("x")).schema["x"].dataType)})
    other = right.select(*keys, F.col(right_ts).alias("_t"), F.lit(0).alias("_side"), packed.alias("_v"))
    both = tagged.unionByName(other, allowMissingColumns=True)
    seen = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_v", F.max("_v").over(seen)).filter("_side = 1")
    return out.withColumns({f"asof_{v}": F.col("_v")[v] for v in [right_ts, *values]}).drop("_t", "_side", "_v")


def islands(df: DataFrame, keys: Sequence[str], order: str, flag: str) -> DataFrame:
    """Rows where ``flag`` holds, with ``island``: a number for each run of them."""
    w = Window.partitionBy(*keys).orderBy(order)
    changes = F.when(F.col(flag) & ~F.coalesce(F.lag(flag).over(w), F.lit(False)), 1).otherwise(0)
    return df.withColumn("_c", changes).withColumn("island", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))).filter(flag).drop("_c")


def held(df: DataFrame, keys: Sequence[str], t: str, values: Sequence[str], gap: int) -> DataFrame:
    """One row a step of ``t`` (integer): each row's values hold until the next row, where that is at most ``gap`` away; then they are missing, not filled."""
    w = Window.partitionBy(*keys).orderBy(t)
    ahead = F.col("_ahead")
    last = F.when(ahead - F.col(t) <= gap, ahead - 1).otherwise(F.col(t))
    return df.withColumn("_ahead", F.lead(t).over(w)).select(*keys, F.explode(F.sequence(F.col(t), last)).alias("step"), *values)


def sliding(df: DataFrame, keys: Sequence[str], t: str, value: str, width: int, stride: int, share: float) -> DataFrame:
    """Means of [start, start + width) for every ``stride`` on a grid of one row a step, where at least ``share`` of the steps have values."""
    starts = F.explode(F.sequence(F.floor((F.col(t) - width) / stride) * stride + stride, F.floor(F.col(t) / stride) * stride, F.lit(stride).cast("long")))
    cells = df.select(*keys, starts.alias("start"), value)
    return cells.groupBy(*keys, "start").agg(F.count(value).alias("n"), F.avg(value).alias("mean")).filter(F.col("n") >= share * width)


def halves(df: DataFrame, keys: Sequence[str], t: str, value: str, gap: float) -> DataFrame:
    """Time-weighted means of a key's first and second half: a value holds until the next row, at most ``gap``; intervals are cut at the middle."""
    w = Window.partitionBy(*keys).orderBy(t)
    whole = Window.partitionBy(*keys)
    df = df.withColumns({"_e": F.least(F.coalesce(F.lead(t).over(w), F.col(t)), F.col(t) + gap), "_lo": F.min(t).over(whole), "_hi": F.max(t).over(whole)})
    middle = (F.col("_lo") + F.col("_hi")) / 2
    first = F.greatest(F.least(F.col("_e"), middle) - F.col(t), F.lit(0.0))
    second = F.greatest(F.col("_e") - F.greatest(F.col(t), middle), F.lit(0.0))
    part = lambda d: F.sum(F.when(F.col(value).isNotNull(), F.col(value) * d)) / F.nullif(F.sum(F.when(F.col(value).isNotNull(), d)), F.lit(0.0))
    return df.groupBy(*keys).agg(part(first).alias("first_half"), part(second).alias("second_half"))


def greedy_disjoint(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Intervals by (start, end), each kept if it starts no earlier than the last kept one's end.

    Sorted rows stream past the last kept end of their key, so no key has to fit in memory. Of a key's rows those without a start come first; one without start or end
    is kept only if it is the first, and after a kept one without end no other is.
    """
    rows = df.select(*keys, start, end)
    sorted_ = rows.repartition(*keys).sortWithinPartitions(*keys, F.asc_nulls_first(start), F.asc_nulls_first(end))
    n = len(keys)

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = until = None
        begun = False
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            kept = []
            for i, (own, s, e) in enumerate(zip(zip(*columns[:n], strict=True), columns[n], columns[n + 1], strict=True)):
                if not begun or own != key or (s is not None and until is not None and s >= until):
                    kept.append(i)
                    begun, key, until = True, own, e
            yield batch.take(pa.array(kept, pa.int64()))

    return sorted_.mapInArrow(streamed, rows.schema)


def linear_fit(df: DataFrame, keys: Sequence[str], x: str, y: str, least: int = 3) -> DataFrame:
    """Slope and intercept of y on x, from at least ``least`` points that don't share one x."""
    out = df.groupBy(*keys).agg(F.regr_count(F.col(y), F.col(x)).alias("n"), F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept"))
    return out.filter((F.col("n") >= least) & F.col("slope").isNotNull())


def period_totals(df: DataFrame, date: str, key: str, aggregates: Sequence[Column]) -> DataFrame:
    """Months, years and all time in one scan, by grouping sets: period_type, period, key and the aggregates."""
    view = df.withColumns({"_m": F.date_format(date, "yyyy-MM"), "_y": F.date_format(date, "yyyy")})
    grouped = view.groupingSets([["_m", key], ["_y", key], [key]], "_m", "_y", key).agg(F.grouping("_m").alias("_gm"), F.grouping("_y").alias("_gy"), *aggregates)
    kind = F.when(F.col("_gm") == 0, "month").when(F.col("_gy") == 0, "year").otherwise("all")
    return grouped.withColumns({"period_type": kind, "period": F.coalesce("_m", "_y", F.lit("all"))}).drop("_m", "_y", "_gm", "_gy")
