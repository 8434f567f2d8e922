"""Normalisers of a second service's documents into the first one's form, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: ids of the second service are moved beyond those of the first.
ID_OFFSET = 10**12


def activity_id(text: Column) -> Column:
    return F.lit(ID_OFFSET) + F.regexp_extract(text, r"(\d+)$", 1).cast("long")


# Fields that both services call alike, and those of the first by their names at the second.
ALIKE = (
    "name", "type", "start_date", "timezone", "distance", "moving_time", "elapsed_time", "total_elevation_gain", "average_speed", "max_speed", "average_cadence", "average_temp",
    "has_heartrate", "average_heartrate", "max_heartrate", "calories", "perceived_exertion", "device_name", "description",
)
RENAMED = {"sport_type": "type", "elev_high": "max_altitude", "elev_low": "min_altitude", "average_watts": "icu_average_watts", "weighted_average_watts": "icu_weighted_avg_watts"}


def activities(documents: DataFrame) -> DataFrame:
    """The second service's activities in the first one's form.

    ``documents``: a column a field, and ``latlng`` and ``watts`` from the normalised streams. Absent fields are NULL. The local start has the
    first service's mark; the offset is what lies between both starts; joules become kilojoules; places are the first and the last that were fixed (an
    empty array if none was); power counts as measured where there is a meter or a power stream.
    """
    have = set(documents.columns)
    c = lambda name, kind="string": F.col(name) if name in have else F.lit(None).cast(kind)
    fixed = F.filter("latlng", lambda p: p.isNotNull())
    place = lambda i: F.coalesce(F.try_element_at(fixed, F.lit(i)), F.array().cast("array<double>"))
    local, yes = c("start_date_local"), lambda name: F.coalesce(c(name, "boolean"), F.lit(False))
    return documents.select(
        activity_id(F.col("id")).alias("id"), *[c(x).alias(x) for x in ALIKE], *[c(theirs).alias(ours) for ours, theirs in RENAMED.items()],
        F.concat(F.coalesce(local, F.lit("")), F.lit("Z")).alias("start_date_local"),
        (F.unix_seconds(F.try_to_timestamp(local)) - F.unix_seconds(F.try_to_timestamp(F.replace(c("start_date"), F.lit("Z"), F.lit(""))))).cast("double").alias("utc_offset"),
        (c("icu_joules", "double") / 1000).alias("kilojoules"), (yes("power_meter") | F.coalesce(F.size("watts") > 0, F.lit(False))).alias("device_watts"),
        c("gear_id").alias("gear_id"), (yes("trainer") | F.coalesce(c("type") == "VirtualRide", F.lit(False))).alias("trainer"), yes("commute").alias("commute"),
        F.concat(F.lit("garmin:"), F.nullif(c("external_id"), F.lit(""))).alias("external_id"), place(1).alias("start_latlng"), place(-1).alias("end_latlng"),
    )


def rounded(values: Column) -> Column:
    """Whole numbers at their places; NULL keeps its place."""
    return F.transform(values, lambda x: F.bround(x).cast("long"))


def paired(lat: Column, lon: Column) -> Column:
    """[lat, lon] by place; a place that lacks either is NULL, and so is what one array has beyond the other."""
    return F.zip_with(lat, lon, lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.array(a, b)))


def in_motion(speed: Column) -> Column:
    return F.transform(speed, lambda v: v > 0.5)


def laps(array: Column) -> Column:
    """Laps with their place and a speed; laps of no distance (rests) stay."""
    return F.transform(array, lambda x, i: F.struct((i + 1).alias("lap_index"), x["distance"].alias("distance"), x["moving_time"].alias("moving_time"), F.coalesce(x["average_speed"], F.try_divide(x["distance"], x["moving_time"])).alias("average_speed")))


def grade(points: DataFrame, key: str, order: str, distance: str, height: str, back_m: float = 30.0) -> DataFrame:
    """``points`` with grade_pct: the rise from the farthest point at most ``back_m`` behind, cut to 30 either way; over under five metres the last grade holds.

    The look-back is a range of distance, so it is one window; holding the last grade is another.
    """
    both = F.col(distance).isNotNull() & F.col(height).isNotNull()
    by = Window.partitionBy(key, "_both").orderBy(distance, order)
    out = points.withColumn("_both", both)
    first = F.expr(
        f"min(named_struct('d', {distance}, 'o', {order}, 'h', {height})) over (partition by {key}, _both order by {distance} range between {float(back_m)}D preceding and current row)"
    )
    run = F.col(distance) - first["d"]
    out = out.withColumn("_g", F.when(F.col("_both") & (run >= 5), F.round(F.greatest(F.lit(-30.0), F.least(F.lit(30.0), 100 * (F.col(height) - first["h"]) / run)), 1)))
    held = F.last("_g", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn("grade_pct", F.when(F.col("_both"), F.coalesce(held, F.lit(0.0)))).drop("_both", "_g")
