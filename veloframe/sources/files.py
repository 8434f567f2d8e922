"""Readers of source files: activity JSON, stream JSON, GPX, Markdown tables, wellness JSON, seeds.

Schemas are fixed. Raw text and lineage (``_source_file``, ``_source_mtime``) stay beside what was parsed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Names and types of the source formats.
LAP = "id long, name string, lap_index int, split int, start_index int, end_index int, start_date string, start_date_local string, distance double, moving_time long, elapsed_time long, total_elevation_gain double, average_speed double, max_speed double, average_heartrate double, max_heartrate double, average_cadence double, average_watts double, device_watts boolean, pace_zone int"
SPLIT = "split int, distance double, moving_time long, elapsed_time long, elevation_difference double, average_speed double, average_grade_adjusted_speed double, average_heartrate double, pace_zone int"
ACTIVITY = (
    "id long, name string, type string, sport_type string, workout_type long, start_date string, start_date_local string, timezone string, utc_offset double, distance double, moving_time long, elapsed_time long,"
    " total_elevation_gain double, elev_high double, elev_low double, average_speed double, max_speed double, average_cadence double, average_temp double, has_heartrate boolean, average_heartrate double, max_heartrate double,"
    " device_watts boolean, average_watts double, weighted_average_watts double, max_watts double, kilojoules double, calories double, suffer_score double, perceived_exertion double, trainer boolean, commute boolean, manual boolean,"
    " private boolean, flagged boolean, gear_id string, device_name string, visibility string, description string, external_id string, achievement_count long, kudos_count long, athlete_count long, pr_count long, upload_id long,"
    f" start_latlng array<double>, end_latlng array<double>, laps array<struct<{LAP.replace(' ', ':').replace(',:', ',')}>>, splits_metric array<struct<{SPLIT.replace(' ', ':').replace(',:', ',')}>>"
)
CHANNELS = {
    "time": "bigint", "latlng": "array<double>", "distance": "double", "altitude": "double", "velocity_smooth": "double", "heartrate": "bigint",
    "cadence": "bigint", "watts": "bigint", "temp": "bigint", "grade_smooth": "double", "moving": "boolean",
}
STREAM = f"activity_id long, date string, type string, fetched_at string, streams struct<{','.join(f'{k}:struct<data:array<{t}>>' for k, t in CHANNELS.items())}>"


def _existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Globs that match something; a glob without matches would fail the read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).globStatus(p):
            found.append(path)
    return found


def _lineage(df: DataFrame) -> DataFrame:
    return df.withColumns({"_source_file": F.col("_metadata.file_path"), "_source_mtime": F.col("_metadata.file_modification_time")})


def activity_documents(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row a file with an id: parsed document ``p``, raw text and lineage. A text without an id is left out."""
    paths = _existing(spark, paths)
    if not paths:
        return spark.createDataFrame([], f"_raw string, _source_file string, _source_mtime timestamp, p struct<{ACTIVITY}>")
    raw = _lineage(spark.read.text(list(paths), wholetext=True)).withColumnRenamed("value", "_raw")
    return raw.withColumn("p", F.from_json("_raw", ACTIVITY)).filter("p.id is not null")


def activities(documents: DataFrame, run_ts: str) -> DataFrame:
    """Bronze activities: one column a field, coordinates apart, counts of children, typed keys."""
    fields = [f.name for f in documents.schema["p"].dataType if f.name not in ("id", "start_latlng", "end_latlng", "laps", "splits_metric")]
    at = lambda c, i: F.get(F.col(f"p.{c}"), i)  # noqa: E731  NULL beyond the end
    n = lambda c: F.size(F.coalesce(f"p.{c}", F.array().cast(documents.schema["p"].dataType[c].dataType)))
    return documents.select(
        F.col("p.id").alias("activity_id"), *[F.col(f"p.{c}") for c in fields],
        at("start_latlng", 0).alias("start_lat"), at("start_latlng", 1).alias("start_lon"), at("end_latlng", 0).alias("end_lat"), at("end_latlng", 1).alias("end_lon"),
        n("laps").alias("lap_count"), n("splits_metric").alias("split_count"), F.to_timestamp("p.start_date").alias("start_ts_utc"),
        F.try_to_date(F.substring("p.start_date_local", 1, 10)).alias("start_date_key"), "_raw", "_source_file", "_source_mtime", F.to_timestamp(F.lit(run_ts)).alias("_ingested_at"),
    )


def children(documents: DataFrame, field: str) -> DataFrame:
    """Laps or splits, a row each; no row for a missing or empty list."""
    out = documents.select(F.col("p.id").alias("activity_id"), F.explode(f"p.{field}").alias("c")).select("activity_id", "c.*")
    return out.withColumnRenamed("id", "lap_id") if field == "laps" else out


def stream_documents(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    paths = _existing(spark, paths)
    return _lineage(spark.read.schema(STREAM).json(list(paths))) if paths else spark.createDataFrame([], f"{STREAM}, _source_file string, _source_mtime timestamp")


def stream_points(documents: DataFrame) -> DataFrame:
    """A row for each index of the longest channel; shorter and missing channels are NULL there, never filled."""
    arrays = [F.coalesce(F.col(f"streams.{k}.data"), F.array().cast(f"array<{t}>")).alias(k) for k, t in CHANNELS.items()]
    cells = documents.select("activity_id", F.try_to_date("date").alias("activity_date"), "_source_file", F.posexplode(F.arrays_zip(*arrays)).alias("point_idx", "z"))
    z = lambda c: F.col(f"z.{c}")
    return cells.select(
        "activity_id", "activity_date", "point_idx", z("time").alias("time_offset_s"), F.get(z("latlng"), 0).alias("lat"), F.get(z("latlng"), 1).alias("lon"), z("distance").alias("distance_m"), z("altitude").alias("ele_m"),
        z("velocity_smooth").alias("speed_ms"), z("heartrate"), z("cadence"), z("watts"), z("temp").alias("temp_c"), z("grade_smooth").alias("grade_pct"), z("moving"), "_source_file",
    )


def expected_stream_points(documents: DataFrame) -> DataFrame:
    """activity_id and the length of its longest channel."""
    return documents.select("activity_id", F.greatest(*[F.size(F.coalesce(F.col(f"streams.{k}.data"), F.array().cast(f"array<{t}>"))) for k, t in CHANNELS.items()]).cast("long").alias("points"))


_NAME = {"activity_id": r"_(\d+)\.gpx$", "date": r"(\d{4}-\d{2}-\d{2})_"}
_POINT = "point_idx:int,lat:double,lon:double,ele_m:double,time:string,heartrate:int,cadence:int,temp_c:int"


def gpx_points(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """GPX track points by file. A malformed file has none; a point without coordinates is left out, but counts for ``point_idx``.

    Points of one file are parsed where the file is; files are the unit of parallel work.
    """
    paths = _existing(spark, paths)
    if not paths:
        return spark.createDataFrame([], f"activity_id long, activity_date date, origin string, {_POINT.replace(':', ' ').replace(',', ', ')}, point_ts timestamp, _source_file string, _source_mtime timestamp")

    @F.pandas_udf(f"array<struct<{_POINT}>>")
    def parsed(texts: pd.Series) -> pd.Series:
        return texts.map(_parse_gpx)

    files = _lineage(spark.read.text(list(paths), wholetext=True))
    name = lambda k: F.nullif(F.regexp_extract("_source_file", _NAME[k], 1), F.lit(""))
    named = files.withColumns({"activity_id": name("activity_id").try_cast("long"), "activity_date": F.try_to_date(name("date"))}).withColumn("origin", F.when(F.col("activity_id").isNull(), "manual_drop").otherwise("sync"))
    points = named.select("activity_id", "activity_date", "origin", "_source_file", "_source_mtime", F.inline(parsed("value")))
    return points.withColumn("point_ts", F.try_to_timestamp("time"))


def _parse_gpx(text: str) -> list[dict]:
    import xml.etree.ElementTree as xml

    try:
        root = xml.fromstring(text)
    except (xml.ParseError, TypeError):
        return []
    out = []
    for i, point in enumerate(x for x in root.iter() if x.tag.rpartition("}")[2] == "trkpt"):
        values = {x.tag.rpartition("}")[2]: (x.text or "").strip() for x in point.iter()}
        lat, lon = _number(point.get("lat")), _number(point.get("lon"))
        if lat is None or lon is None:
            continue
        whole = {k: None if (v := _number(values.get(tag))) is None else int(v) for k, tag in (("heartrate", "hr"), ("cadence", "cad"), ("temp_c", "atemp"))}
        out.append({"point_idx": i, "lat": lat, "lon": lon, "ele_m": _number(values.get("ele")), "time": values.get("time"), **whole})
    return out


def _number(text: str | None) -> float | None:
    try:
        return float(text) if text else None
    except ValueError:
        return None


def not_all_null(df: DataFrame, column: str) -> DataFrame:
    """``df``, or an error when it has rows and the column is NULL in every one."""
    if df.agg(F.count(F.lit(1)).alias("n"), F.count(column).alias("k")).filter("n > 0 and k = 0").count():
        raise ValueError(f"{column} is NULL in every row")
    return df


def _cells(spark: SparkSession, path: str) -> DataFrame:
    """Table rows of a Markdown file as arrays of trimmed cells, with the line number's order kept in ``line``."""
    if not _existing(spark, [path]):
        return spark.createDataFrame([], "cells array<string>")
    lines = spark.read.text(path).filter(F.col("value").startswith("|"))
    inner = F.regexp_replace(F.trim("value"), r"^\||\|$", "")
    return lines.select(F.transform(F.split(inner, r"\|"), lambda x: F.trim(x)).alias("cells"))


def ftp_log(spark: SparkSession, path: str) -> DataFrame:
    """Dated rows of the threshold log. The file's stated present value marks one row: the latest that has it."""
    from pyspark.sql import Window

    text = spark.read.text(path, wholetext=True)
    now = text.select(F.regexp_extract("value", r"##\s*현재값[\s\S]+?\*\*(\d+)\s*W\*\*", 1).try_cast("int").alias("now"))
    c = lambda i: F.get("cells", i)
    rows = _cells(spark, path).filter((F.size("cells") >= 5) & c(0).rlike(r"^\d{4}-\d{2}-\d{2}$") & c(1).rlike(r"^\d+$"))
    rows = rows.select(F.to_date(c(0)).alias("effective_date"), c(1).cast("int").alias("ftp_watts"), F.when(c(2).rlike(r"^[\d.]+$"), c(2)).try_cast("double").alias("w_per_kg"), F.replace(c(3), F.lit('"')).alias("method"), c(4).alias("confidence"))
    same = rows.crossJoin(F.broadcast(now)).withColumn("_same", F.coalesce(F.col("ftp_watts") == F.col("now"), F.lit(False)))
    rank = F.row_number().over(Window.partitionBy("_same").orderBy(F.desc("effective_date"), "method", "confidence"))
    return same.withColumn("is_current", F.col("_same") & (rank == 1)).drop("_same", "now")


def checked(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``rows``, where a row that breaks a rule stops the run with the rule's name."""
    out = rows
    for name, rule in rules.items():  # in a filter, which no projection above can prune
        broken = F.raise_error(F.concat(F.lit(f"{name}: "), F.to_json(F.struct(*rows.columns)))).cast("boolean")
        out = out.filter(F.when(F.coalesce(rule, F.lit(False)), broken).otherwise(F.lit(True)))
    return out


def symptom_log(spark: SparkSession, path: str, vocabularies: Mapping[str, Sequence[str]], sports: Mapping[str, str]) -> DataFrame:
    """Dated rows of eleven cells; a value outside its vocabulary, or a severity beyond 0 to 10, stops the run."""
    c = lambda i: F.nullif(F.get("cells", i), F.lit(""))
    rows = _cells(spark, path).filter(F.get("cells", 0).rlike(r"^\d{4}-\d{2}-\d{2}$"))
    names = ("symptom_date", "sport", "activity_id", "area", "side", "severity", "onset", "course", "next_day", "confounders", "memo")
    rows = rows.select(F.size("cells").alias("_n"), *[c(i).alias(n) for i, n in enumerate(names)])
    rules = {"eleven cells": F.col("_n") != len(names), "severity": F.col("severity").isNotNull() & ~F.coalesce(F.col("severity").try_cast("int").between(0, 10), F.lit(False)), "sport": ~F.col("sport").isin(*sports)}
    rules |= {n: F.col(n).isNotNull() & ~F.col(n).isin(*v) for n, v in vocabularies.items()}
    rows = checked(rows, rules)
    sport = F.create_map(*[F.lit(x) for kv in sports.items() for x in kv])[F.col("sport")]
    return rows.drop("_n").withColumns({"symptom_date": F.to_date("symptom_date"), "sport": sport, "activity_id": F.col("activity_id").try_cast("long"), "severity": F.col("severity").try_cast("int"), "next_day": F.col("next_day").try_cast("int")})


def fitting_changes(spark: SparkSession, path: str, states: Mapping[str, str]) -> DataFrame:
    """Dated rows of nine cells; other tables of the file and undated rows are left out; no file, no rows."""
    names = ("effective_date", "target", "item", "side", "before", "after", "status", "source", "memo")
    rows = _cells(spark, path).filter((F.size("cells") == len(names)) & F.get("cells", 0).rlike(r"^\d{4}-\d{2}-\d{2}$"))
    state = F.create_map(*[F.lit(x) for kv in states.items() for x in kv])[F.col("status")]
    return rows.select(*[F.nullif(F.get("cells", i), F.lit("")).alias(n) for i, n in enumerate(names)]).withColumns({"effective_date": F.to_date("effective_date"), "status": F.coalesce(state, "status")})


def wellness(spark: SparkSession, path: str) -> DataFrame:
    """Daily fitness; the ride's threshold is that of the entry of type Ride; NULL stays NULL; no file, no rows."""
    schema = "id string, ctl double, atl double, rampRate double, ctlLoad double, sportInfo array<struct<type:string,eftp:double>>"
    if not _existing(spark, [path]):
        return spark.createDataFrame([], "fitness_date date, ctl double, atl double, ramp_rate double, load double, ride_eftp double")
    ride = F.get(F.filter("sportInfo", lambda s: s["type"] == "Ride"), 0)["eftp"]
    return spark.read.schema(schema).option("multiLine", "true").json(path).select(
        F.try_to_date("id").alias("fitness_date"), *[F.round(a, 2).alias(b) for a, b in (("ctl", "ctl"), ("atl", "atl"), ("rampRate", "ramp_rate"), ("ctlLoad", "load"))], F.round(ride).alias("ride_eftp")).filter("fitness_date is not null")


def seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header and declared types; empty cells are NULL."""
    return spark.read.schema(schema).csv(path, header=True)
