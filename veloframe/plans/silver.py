"""Silver: classified activities with duplicates flagged, unified points, laps and splits with their activity's context."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veloframe.config import Config
from veloframe.functions import label_from, one_of, per
from veloframe.operators.series import sessions

POINT_COLUMNS = (
    "activity_id", "point_idx", "source", "point_ts", "time_offset_s", "lat", "lon", "ele_m", "distance_m", "speed_ms", "grade_pct",
    "heartrate", "cadence", "watts", "temp_c", "moving", "sport", "gear_label", "is_indoor", "is_duplicate", "year",
)


def prefer(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All of ``first``, and of ``second`` the rows whose keys ``first`` doesn't have."""
    return first.unionByName(second.join(first.select(*keys).distinct(), list(keys), "left_anti"))


def activities(bronze: DataFrame, gears: Mapping[str, str], config: Config = Config(), athlete: Sequence[str] = (), compat: bool = False) -> DataFrame:
    """Sport, gear label, units, flags and overlap groups; activities without distance stay out of the groups.

    Days, months and years are those of the athlete's calendar (``start_date_key``), not of UTC.
    """
    out = bronze.withColumns({
        "sport": one_of(F.col("type"), config.sports, config.other_sport), "gear_label": label_from(F.col("gear_id"), gears, config.unassigned),
        "year": F.year("start_date_key"), "month": F.date_format("start_date_key", "yyyy-MM"), "activity_date": F.col("start_date_key"),
        "distance_km": F.col("distance") / 1000, "moving_h": F.col("moving_time") / 3600, "elapsed_h": F.col("elapsed_time") / 3600,
        "average_kmh": F.col("average_speed") * 3.6, "max_kmh": F.col("max_speed") * 3.6, "elev_m": F.coalesce("total_elevation_gain", F.lit(0.0)),
        "is_indoor": F.coalesce("trainer", F.lit(False)) | F.coalesce(F.col("type") == "VirtualRide", F.lit(False)), "has_gps": F.col("start_lat").isNotNull(),
        "end_ts_utc": F.expr("start_ts_utc + make_interval(0, 0, 0, 0, 0, 0, coalesce(elapsed_time, 0))"),
    })
    out = sessions(out, [*athlete, "sport"], "start_ts_utc", "end_ts_utc", [F.desc("elapsed_time")], "activity_id", scope=F.col("distance") > 0, compat=compat)
    return out.withColumnRenamed("duplicate_of", "duplicate_of_activity_id").drop("group_size")


def trackpoints(streams: DataFrame, gpx: DataFrame, acts: DataFrame) -> DataFrame:
    """One time series an activity: sensor streams where there are any, GPX points else; hand-dropped GPX files not at all."""
    context = acts.select("activity_id", "start_ts_utc", "sport", "gear_label", "is_indoor", "is_duplicate")
    a = streams.join(context, "activity_id").withColumns({"source": F.lit("stream"), "point_ts": F.expr("start_ts_utc + make_interval(0, 0, 0, 0, 0, 0, time_offset_s)")})
    b = gpx.filter("origin <> 'manual_drop'").withColumns({"source": F.lit("gpx")}).join(context, "activity_id")
    b = b.withColumn("time_offset_s", F.unix_seconds("point_ts") - F.unix_seconds("start_ts_utc"))
    for c, kind in (("distance_m", "double"), ("speed_ms", "double"), ("grade_pct", "double"), ("watts", "bigint"), ("moving", "boolean")):
        b = b.withColumn(c, F.lit(None).cast(kind))
    for c in ("heartrate", "cadence", "temp_c", "point_idx"):
        a, b = a.withColumn(c, F.col(c).cast("bigint")), b.withColumn(c, F.col(c).cast("bigint"))
    both = prefer(a.withColumn("year", F.year("point_ts")).select(*POINT_COLUMNS), b.withColumn("year", F.year("point_ts")).select(*POINT_COLUMNS), ["activity_id"])
    return both


def _context(acts: DataFrame) -> DataFrame:
    return acts.select("activity_id", "sport", "is_duplicate", "activity_date", "gear_label", "is_indoor")


def laps(bronze: DataFrame, acts: DataFrame) -> DataFrame:
    """Laps with units and pace, which comes from the mean speed."""
    return _paced(bronze.join(_context(acts), "activity_id")).withColumn("distance_km", F.col("distance") / 1000)


def _paced(df: DataFrame) -> DataFrame:
    speed = F.col("average_speed")
    return df.withColumns({"average_kmh": speed * 3.6, "pace_s_per_km": per(F.lit(1000.0), speed), "pace_s_per_100m": per(F.lit(100.0), speed)})


def splits(bronze: DataFrame, acts: DataFrame) -> DataFrame:
    """Kilometre splits with pace and climbing rate."""
    return _paced(bronze.join(_context(acts), "activity_id")).withColumns({
        "climb_m_per_km": per(F.col("elevation_difference"), F.col("distance")) * 1000,
        "is_partial": F.col("distance") < 950,
    })
