"""More queries with SQL: bronze and silver, the remaining marts, pacing, hand-off and collecting, on frames bound from the supplied tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veloframe.config import Config
from veloframe.plans import coach, gold, handoff, pacing, quality, silver
from veloframe.plans.catalog import _ACTS, _BOUND, _NOTES, _acts, _plain, _points, query, table
from veloframe.sources import collect, files, normalise

NTZ = "timestamp_ntz"


def _kind(c, *names: str):
    """A name for each of three order states: F, O and the rest."""
    return F.when(c == "F", names[0]).when(c == "O", names[1]).otherwise(names[2])


# Bronze: documents made from orders (their lines are laps) and events (one stream a user).

_DOCUMENTS = """lines AS (SELECT l_orderkey, count(*) AS laps FROM lineitem GROUP BY 1),
docs AS (SELECT o_orderkey AS activity_id, o_orderpriority AS name, o_totalprice AS distance, o_custkey AS moving_time, CASE WHEN o_custkey % 3 > 0 THEN o_custkey / 10 END AS lat, o_orderdate FROM orders)"""


def _documents(spark, d) -> DataFrame:
    key, place, at = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    lap = F.struct(F.col("l_linenumber").alias("lap_index"), F.col("l_quantity").alias("distance"), F.col("l_discount").alias("average_speed"))
    laps = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(lap).alias("laps"))
    utc = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    body = F.struct(
        key.alias("id"), F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("distance"), place.alias("moving_time"), utc.alias("start_date"), utc.alias("start_date_local"),
        F.when(place % 3 > 0, F.array(place / 10, -place / 10)).otherwise(F.array().cast("array<double>")).alias("start_latlng"), "laps",
    )
    raw = table(spark, d, "orders").join(laps, "o_orderkey", "left").select(F.to_json(body).alias("_raw"), F.lit("orders").alias("_source_file"), at.cast("timestamp").alias("_source_mtime"))
    return raw.withColumn("p", F.from_json("_raw", files.ACTIVITY))


@query(f"""WITH {_DOCUMENTS} SELECT activity_id, name, round(distance, 6) AS distance, moving_time, round(lat, 6) AS start_lat, round(-lat, 6) AS start_lon, NULL::DOUBLE AS end_lat, coalesce(laps, 0)::BIGINT AS lap_count, 0::BIGINT AS split_count,
o_orderdate AS start_ts_utc, o_orderdate::DATE AS start_date_key FROM docs LEFT JOIN lines ON activity_id = l_orderkey""")
def bronze_activities(spark, d):
    out = files.activities(_documents(spark, d), "2024-01-01 00:00:00").withColumn("start_ts_utc", F.col("start_ts_utc").cast(NTZ))
    return _plain(out, "activity_id", "name", "distance", "moving_time", "start_lat", "start_lon", "end_lat", "lap_count", "split_count", "start_ts_utc", "start_date_key")


@query("SELECT l_orderkey AS activity_id, l_linenumber::BIGINT AS lap_index, round(l_quantity, 6) AS distance, round(l_discount, 6) AS average_speed FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def bronze_laps(spark, d):
    return _plain(files.children(_documents(spark, d), "laps"), "activity_id", "lap_index", "distance", "average_speed")


def _streams(spark, d) -> DataFrame:
    """A document a user: all times, and watts of views alone, so that channels differ in length."""
    listed = lambda when, c: F.transform(F.array_sort(F.collect_list(F.when(when, F.struct(F.col("event_id").alias("i"), c.alias("v"))))), lambda x: x["v"])
    times, watts = listed(F.lit(True), F.col("event_id")), listed(F.col("event_type") == "view", F.round("value").cast("long"))
    each = table(spark, d, "events").groupBy(F.col("user_id").alias("activity_id")).agg(times.alias("times"), watts.alias("watts"))
    body = F.to_json(F.struct("activity_id", F.lit("2024-01-01").alias("date"), F.struct(F.struct(F.col("times").alias("data")).alias("time"), F.struct(F.col("watts").alias("data")).alias("watts")).alias("streams")))
    return each.select(F.from_json(body, files.STREAM).alias("p")).select("p.*", F.lit("events").alias("_source_file"))


_STREAMS = """a AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events),
w AS (SELECT user_id, round(value)::BIGINT AS watts, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events WHERE event_type = 'view')"""


@query(f"WITH {_STREAMS} SELECT a.user_id AS activity_id, a.i::BIGINT AS point_idx, a.event_id AS time_offset_s, w.watts, NULL::DOUBLE AS lat FROM a LEFT JOIN w ON a.user_id = w.user_id AND a.i = w.i")
def bronze_stream_points(spark, d):
    return _plain(files.stream_points(_streams(spark, d)), "activity_id", "point_idx", "time_offset_s", "watts", "lat")


@query("SELECT user_id AS activity_id, count(*)::BIGINT AS points FROM events GROUP BY 1")
def expected_stream_points(spark, d):
    return files.expected_stream_points(_streams(spark, d))


# Silver

_BRONZE = """bronze AS (SELECT o_orderkey AS activity_id, o_custkey AS athlete, CASE o_orderstatus WHEN 'F' THEN 'cycling' WHEN 'O' THEN 'running' ELSE 'other' END AS sport, CASE WHEN o_orderkey % 5 > 0 THEN 'gear-' || o_custkey % 4 END AS gear_id,
  o_orderdate AS s, o_orderdate + to_seconds(86400 * (1 + o_orderkey % 400)) AS e, 86400 * (1 + o_orderkey % 400) AS elapsed, CASE WHEN o_orderkey % 10 > 0 THEN o_totalprice ELSE 0 END AS distance, o_orderkey FROM orders),
o AS (SELECT *, distance > 0 AS inn, max(CASE WHEN distance > 0 THEN e END) OVER (PARTITION BY athlete, sport, distance > 0 ORDER BY s, activity_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM bronze),
g AS (SELECT *, sum(CASE WHEN inn AND s < before THEN 0 ELSE 1 END) OVER (PARTITION BY athlete, sport, inn ORDER BY s, activity_id ROWS UNBOUNDED PRECEDING) AS grp FROM o),
r AS (SELECT *, row_number() OVER k AS rn, first_value(activity_id) OVER k AS winner FROM g WINDOW k AS (PARTITION BY athlete, sport, inn, grp ORDER BY elapsed DESC, activity_id))"""


@query(f"""WITH {_BRONZE} SELECT activity_id, sport, CASE gear_id WHEN 'gear-0' THEN 'road' WHEN 'gear-1' THEN 'gravel' ELSE coalesce('other(' || gear_id || '…)', 'unassigned') END AS gear_label, round(distance / 1000, 6) AS distance_km, round(elapsed / 3600, 6) AS elapsed_h,
round((o_orderkey % 13)::DOUBLE * 3.6::DOUBLE, 6) AS average_kmh, coalesce(CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 90)::DOUBLE END, 0) AS elev_m, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 2 = 0 END, false) AS is_indoor, o_orderkey % 6 > 0 AS has_gps, e AS end_ts_utc,
s::DATE AS activity_date, year(s)::BIGINT AS year, strftime(s, '%Y-%m') AS month, inn AND rn > 1 AS is_duplicate, CASE WHEN inn AND rn > 1 THEN winner END AS duplicate_of_activity_id FROM r""")
def silver_activities(spark, d):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    bronze = table(spark, d, "orders").select(
        key.alias("activity_id"), F.col("o_custkey").alias("athlete"), _kind(F.col("o_orderstatus"), "Ride", "Run", "Yoga").alias("type"), F.when(key % 5 > 0, F.concat(F.lit("gear-"), F.col("o_custkey") % 4)).alias("gear_id"),
        day.alias("start_ts_utc"), day.cast("date").alias("start_date_key"), (86_400 * (1 + key % 400)).alias("elapsed_time"), F.lit(3600).alias("moving_time"), F.when(key % 10 > 0, F.col("o_totalprice")).otherwise(0.0).alias("distance"),
        (key % 13).cast("double").alias("average_speed"), F.lit(20.0).alias("max_speed"), F.when(key % 4 > 0, (key % 90).cast("double")).alias("total_elevation_gain"), F.when(key % 3 == 0, key % 2 == 0).alias("trainer"), F.when(key % 6 > 0, 1.0).alias("start_lat"),
    )
    out = silver.activities(bronze, {"gear-0": "road", "gear-1": "gravel"}, athlete=("athlete",))
    return _plain(out, "activity_id", "sport", "gear_label", "distance_km", "elapsed_h", "average_kmh", "elev_m", "is_indoor", "has_gps", "end_ts_utc", "activity_date", "year", "month", "is_duplicate", "duplicate_of_activity_id")


def _context(spark, d) -> DataFrame:
    return _acts(spark, d).withColumn("is_duplicate", F.col("activity_id") % 6 == 0)


@query(f"""WITH {_ACTS} SELECT activity_id, l_linenumber::BIGINT AS lap_index, sport, activity_date, activity_id % 6 = 0 AS is_duplicate, round(l_quantity * 100 / 1000, 6) AS distance_km, round(l_discount * 50 * 3.6, 6) AS average_kmh,
CASE WHEN l_discount > 0 THEN round(1000 / (l_discount * 50), 6) END AS pace_s_per_km, CASE WHEN l_discount > 0 THEN round(100 / (l_discount * 50), 6) END AS pace_s_per_100m FROM lineitem JOIN acts ON l_orderkey = activity_id""")
def silver_laps(spark, d):
    laps = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("activity_id"), F.col("l_linenumber").alias("lap_index"), (F.col("l_quantity") * 100).alias("distance"), (F.col("l_discount") * 50).alias("average_speed"))
    return _plain(silver.laps(laps, _context(spark, d)), "activity_id", "lap_index", "sport", "activity_date", "is_duplicate", "distance_km", "average_kmh", "pace_s_per_km", "pace_s_per_100m")


@query(f"""WITH {_ACTS} SELECT activity_id, l_linenumber::BIGINT AS split, sport, CASE WHEN l_discount > 0 THEN round(1000 / (l_discount * 50), 6) END AS pace_s_per_km,
round((l_tax * 1000 - 30) / (l_quantity * 100) * 1000, 6) AS climb_m_per_km, l_quantity * 100 < 950 AS is_partial FROM lineitem JOIN acts ON l_orderkey = activity_id""")
def silver_splits(spark, d):
    splits = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("activity_id"), F.col("l_linenumber").alias("split"), (F.col("l_quantity") * 100).alias("distance"), (F.col("l_discount") * 50).alias("average_speed"), (F.col("l_tax") * 1000 - 30).alias("elevation_difference"))
    return _plain(silver.splits(splits, _context(spark, d)), "activity_id", "split", "sport", "pace_s_per_km", "climb_m_per_km", "is_partial")


@query(f"""WITH {_ACTS}, c AS (SELECT activity_id, activity_date::TIMESTAMP AS s, sport, gear_label FROM acts),
a AS (SELECT user_id AS activity_id, event_id AS point_idx, 'stream' AS source, s + to_seconds(event_id % 7200) AS point_ts, event_id % 7200 AS time_offset_s, value / 10 AS lat, event_id % 180 AS heartrate, round(value)::BIGINT AS watts, event_type <> 'error' AS moving, sport, gear_label
  FROM events JOIN c ON activity_id = user_id WHERE event_type <> 'signup' AND user_id % 3 > 0),
b AS (SELECT user_id AS activity_id, event_id AS point_idx, 'gpx' AS source, ts AS point_ts, floor(epoch(ts))::BIGINT - epoch(s)::BIGINT AS time_offset_s, value / 5 AS lat, event_id % 150 AS heartrate, NULL::BIGINT AS watts, NULL::BOOLEAN AS moving, sport, gear_label
  FROM events JOIN c ON activity_id = user_id WHERE event_id % 11 > 0 AND user_id NOT IN (SELECT activity_id FROM a))
SELECT activity_id, point_idx, source, point_ts, time_offset_s, round(lat, 6) AS lat, heartrate, watts, moving, sport, gear_label, year(point_ts)::BIGINT AS year FROM (SELECT * FROM a UNION ALL SELECT * FROM b)""")
def silver_trackpoints(spark, d):
    """Streams are there for two users of three, GPX points for all; every eleventh GPX point is of a file that was dropped in by hand."""
    e, u, v = F.col("event_id"), F.col("user_id"), F.col("value")
    events = table(spark, d, "events")
    no = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
    streams = events.filter((F.col("event_type") != "signup") & (u % 3 > 0)).select(
        u.alias("activity_id"), e.alias("point_idx"), (e % 7200).alias("time_offset_s"), (v / 10).alias("lat"), (e % 180).alias("heartrate"), F.round(v).cast("long").alias("watts"), (F.col("event_type") != "error").alias("moving"),
        *no("double", "lon", "ele_m", "distance_m", "speed_ms", "grade_pct"), *no("long", "cadence", "temp_c"),
    )
    gpx = events.select(
        u.alias("activity_id"), F.when(e % 11 == 0, "manual_drop").otherwise("sync").alias("origin"), e.alias("point_idx"), (v / 5).alias("lat"), (e % 150).alias("heartrate"), F.col("ts").cast("timestamp").alias("point_ts"), *no("double", "lon", "ele_m"), *no("long", "cadence", "temp_c"))
    acts = _context(spark, d).withColumn("start_ts_utc", F.col("activity_date").cast("timestamp"))
    out = silver.trackpoints(streams, gpx, acts).withColumn("point_ts", F.col("point_ts").cast(NTZ))
    return _plain(out, "activity_id", "point_idx", "source", "point_ts", "time_offset_s", "lat", "heartrate", "watts", "moving", "sport", "gear_label", "year")


# Staging and marts

_SYMPTOMS = """days AS (SELECT o_orderkey AS activity_id, DATE '2024-01-01' + (o_orderkey % 10000)::INT AS symptom_date, CASE o_orderstatus WHEN 'F' THEN 'cycling' WHEN 'O' THEN 'running' ELSE 'swimming' END AS sport FROM orders WHERE o_totalprice > 0),
log AS (SELECT DISTINCT ts::DATE AS symptom_date, CASE event_type WHEN 'view' THEN 'cycling' WHEN 'click' THEN 'running' ELSE 'swimming' END AS sport, CASE WHEN event_id % 9 = 0 THEN event_id % 100 END AS own, CASE WHEN event_id % 4 > 0 THEN 'knee' END AS area,
  event_id % 11 AS severity, CASE WHEN event_id % 2 = 0 THEN 'm' || event_id % 3 END AS memo FROM events),
one AS (SELECT symptom_date, sport, min(activity_id) AS id, count(DISTINCT activity_id) AS n FROM days GROUP BY 1, 2),
symptoms AS (SELECT log.*, CASE WHEN own IS NOT NULL THEN own WHEN n = 1 THEN id END AS activity_id, CASE WHEN own IS NOT NULL THEN 'explicit' WHEN n IS NULL THEN 'unmatched' WHEN n = 1 THEN 'date_sport' ELSE 'ambiguous' END AS link_method FROM log LEFT JOIN one USING (symptom_date, sport))"""


def _symptoms(spark, d) -> DataFrame:
    e = F.col("event_id")
    log = table(spark, d, "events").select(
        F.col("ts").cast("date").alias("symptom_date"), F.when(F.col("event_type") == "view", "cycling").when(F.col("event_type") == "click", "running").otherwise("swimming").alias("sport"), F.when(e % 9 == 0, e % 100).alias("activity_id"),
        F.when(e % 4 > 0, "knee").otherwise("None").alias("area"), F.lit("L").alias("side"), (e % 11).alias("severity"), F.lit(" ").alias("onset"), F.lit(None).cast("string").alias("course"), F.lit("").alias("confounders"),
        F.when(e % 2 == 0, F.concat(F.lit("m"), e % 3)).otherwise("").alias("memo"),
    )
    acts = _acts(spark, d).withColumn("activity_date", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("activity_id") % 10_000).cast("int")))
    return gold.stg_symptoms(log, acts)


@query(f"""WITH {_SYMPTOMS} SELECT md5(concat_ws('|', symptom_date::VARCHAR, sport, coalesce(area, '∅'), 'L', severity::VARCHAR, '∅', coalesce(memo, '∅'))) AS symptom_key, symptom_date, sport, area, severity, memo, activity_id, link_method FROM symptoms""")
def stg_symptoms(spark, d):
    return _symptoms(spark, d).select("symptom_key", "symptom_date", "sport", "area", "severity", "memo", "activity_id", "link_method")


_CHANGES = """changes AS (SELECT effective_date, target, status, trim(item || coalesce('(' || side || ')', '') || ' ' || coalesce(after, '')) AS change_label FROM (SELECT DATE '2024-01-01' + (p_partkey % 60)::INT AS effective_date, CASE p_partkey % 3 WHEN 0 THEN 'bike 0' WHEN 1 THEN 'bike 1' ELSE '신발' END AS target,
  p_name AS item, CASE WHEN p_partkey % 2 = 0 THEN 'L' END AS side, CASE WHEN p_size > 25 THEN p_brand END AS after, CASE p_partkey % 4 WHEN 0 THEN 'applied' WHEN 1 THEN 'reverted' ELSE 'planned' END AS status FROM part) WHERE status <> 'planned')"""


def _changes(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    return gold.stg_fitting_changes(table(spark, d, "part").select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (k % 60).cast("int")).alias("effective_date"), F.when(k % 3 == 0, "bike 0").when(k % 3 == 1, "bike 1").otherwise(gold.SHOES).alias("target"), F.col("p_name").alias("item"),
        F.when(k % 2 == 0, "L").otherwise(" ").alias("side"), F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise("None").alias("after"), F.when(k % 4 == 0, "applied").when(k % 4 == 1, "reverted").otherwise("planned").alias("status"),
    ))


@query(f"WITH {_CHANGES} SELECT effective_date, target, status, change_label FROM changes")
def stg_fitting_changes(spark, d):
    return _changes(spark, d).select("effective_date", "target", "status", "change_label")


@query("SELECT (200 + o_custkey)::DOUBLE AS ftp FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate::DATE DESC, 200 + o_custkey DESC LIMIT 1")
def current_threshold(spark, d):
    log = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("effective_date"), (200 + F.col("o_custkey")).alias("ftp_watts"), F.lit(None).cast("double").alias("w_per_kg"), F.lit("").alias("method"), F.lit("").alias("confidence"), (F.col("o_orderstatus") == "F").alias("is_current"))
    return gold.current_ftp(gold.stg_ftp(log))


@query("""SELECT ts::DATE AS fitness_date, round(avg(value), 2) AS ctl, round(max(value), 2) AS atl, round(round(avg(value), 2) - round(max(value), 2), 1) AS form, round(min(value), 6) AS ramp_rate, count(*)::DOUBLE AS load, NULL::DOUBLE AS ride_eftp FROM events
WHERE ts::DATE <= DATE '2024-01-15' GROUP BY 1""")
def mart_fitness_daily(spark, d):
    days = table(spark, d, "events").groupBy(F.col("ts").cast("date").alias("fitness_date")).agg(
        F.round(F.avg("value"), 2).alias("ctl"), F.round(F.max("value"), 2).alias("atl"), F.min("value").alias("ramp_rate"), F.count(F.lit(1)).cast("double").alias("load"), F.lit(None).cast("double").alias("ride_eftp"))
    return _plain(gold.mart_fitness_daily(gold.stg_fitness(days, Config(as_of=dt.date(2024, 1, 15)))))


@query(f"""WITH {_ACTS}, s AS (SELECT activity_id, sport, moving_time, moving_time + activity_id % 900 AS elapsed_time, activity_id % 6 = 0 AS is_duplicate FROM acts)
SELECT activity_id, sport, sport = 'swimming' AND moving_time >= 0.95 * elapsed_time AS rest_included FROM s WHERE NOT is_duplicate""")
def stg_activities(spark, d):
    acts = _context(spark, d).withColumn("elapsed_time", F.col("moving_time") + F.col("activity_id") % 900)
    return gold.stg_activities(acts).select("activity_id", "sport", "rest_included")


@query(f"""{_BOUND}, u AS (SELECT activity_id, point_ts, max(watts) AS watts FROM power GROUP BY 1, 2),
q AS (SELECT activity_id, point_ts, watts, ntile(4) OVER (PARTITION BY activity_id ORDER BY point_ts) AS q FROM u JOIN acts USING (activity_id) WHERE acts.sport = 'cycling'),
s AS (SELECT activity_id, q, watts, avg(watts) OVER (PARTITION BY activity_id, q ORDER BY point_ts RANGE BETWEEN INTERVAL 30 SECOND PRECEDING AND CURRENT ROW) AS p FROM q),
e AS (SELECT activity_id, q, pow(avg(pow(p, 4)), 0.25) AS np, avg(CASE WHEN watts > 0 THEN 1.0 ELSE 0.0 END) >= 0.2 AS sound FROM s GROUP BY 1, 2),
w AS (SELECT activity_id, max(np) FILTER (q = 1 AND sound) AS q1, max(np) FILTER (q = 2 AND sound) AS q2, max(np) FILTER (q = 3 AND sound) AS q3, max(np) FILTER (q = 4 AND sound) AS q4, bool_or(NOT sound) AS dropout FROM e GROUP BY 1)
SELECT activity_id, round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3, round(q4, 6) AS q4, dropout, CASE WHEN q1 > 0 THEN round(q4 / q1, 6) END AS q4_to_q1, CASE WHEN q1 + q2 > 0 THEN round((q3 + q4) / (q1 + q2), 6) END AS second_half_ratio FROM w""")
def mart_ride_durability(spark, d):
    """All rides, since no bound one is long; one sample a second, as sensors give."""
    power = gold.stg_power_points(_points(spark, d)).groupBy("activity_id", "point_ts").agg(F.max("watts").alias("watts"))
    out = gold.mart_ride_durability(power, _acts(spark, d), Config(long_ride_s=0))
    return _plain(out, "activity_id", "q1", "q2", "q3", "q4", "dropout", "q4_to_q1", "second_half_ratio")


@query(f"""WITH {_NOTES} SELECT k AS activity_id, o_orderdate::DATE AS activity_date, k % 90 AS fitness, o_custkey % 80 AS fatigue, k % 200 AS load, o_custkey % 300 AS peak_20min_w, NULL::BIGINT AS peak_1h_w, NULL::VARCHAR AS training_type FROM notes""")
def mart_service_metrics(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = F.concat(F.lit("훈련상태 체력 "), k % 90, F.lit(" 피로 "), c % 80, F.lit(" 균형 -"), k % 30, F.lit("\nR파워 "), 180 + k % 90, F.lit("w 강도 0."), 50 + k % 50, F.lit(" 훈련량 "), k % 200, F.lit(" 20분  "), c % 300, F.lit("w"))
    notes = gold.stg_service_notes(table(spark, d, "orders").select(k.alias("activity_id"), F.col("o_orderdate").cast("date").alias("activity_date"), text.alias("description")))
    return _plain(gold.mart_service_metrics(notes), "activity_id", "activity_date", "fitness", "fatigue", "load", "peak_20min_w", "peak_1h_w", "training_type")


_RIDES = f"""{_CHANGES}, acts AS (SELECT o_orderkey AS activity_id, DATE '2024-01-01' + (o_orderkey % 100)::INT AS activity_date, 'bike ' || o_custkey % 3 AS bike, o_totalprice / 1000 AS distance_km, 600 + o_orderkey % 20000 AS moving_time FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 0),
felt AS (SELECT event_id % 1500 AS activity_id, ts::DATE AS symptom_date, CASE event_id % 4 WHEN 0 THEN '무릎내측' WHEN 1 THEN '안장' WHEN 2 THEN '경련-종아리' ELSE '허리' END AS area, CASE event_id % 3 WHEN 0 THEN '좌' WHEN 1 THEN '우' ELSE '양' END AS side, event_id % 11 AS severity, event_id % 7 AS next_day, nullif(event_type, 'view') AS confounders FROM events),
load AS (SELECT l_orderkey AS activity_id, sum(l_linenumber) * 60 AS grind_s, avg(l_linenumber) AS climb_cadence, avg(l_quantity) / 50 AS intensity FROM lineitem GROUP BY 1),
by_ride AS (SELECT activity_id, count(*) AS symptoms, max(severity) FILTER (area = '무릎내측' AND side IN ('좌', '양')) AS knee_medial_l, max(next_day) FILTER (area = '무릎내측' AND side IN ('좌', '양')) AS knee_medial_l_next, max(severity) FILTER (area = '안장') AS saddle, max(severity) FILTER (area LIKE '경련-%') AS cramp,
  string_agg(DISTINCT confounders, ' / ' ORDER BY confounders) AS confounders FROM felt GROUP BY 1),
since AS (SELECT a.activity_id, max(effective_date) AS setup_since FROM acts a JOIN changes c ON c.target IN (a.bike, '신발') AND effective_date <= activity_date GROUP BY 1),
rides AS (SELECT activity_id, activity_date, bike, distance_km, coalesce(symptoms, 0)::BIGINT AS symptoms, knee_medial_l, knee_medial_l_next, saddle, cramp, confounders, setup_since, climb_cadence, intensity, round(moving_time / 60, 1) AS moving_min, round(grind_s / 60, 1) AS grind_min,
  round(grind_s / (moving_time / 3600) / 60, 1) AS grind_min_per_h FROM acts LEFT JOIN by_ride USING (activity_id) LEFT JOIN load USING (activity_id) LEFT JOIN since USING (activity_id) WHERE activity_date >= (SELECT min(symptom_date) FROM felt))"""


def _rides(spark, d) -> DataFrame:
    e = F.col("event_id")
    acts = _acts(spark, d).withColumn("activity_date", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("activity_id") % 100).cast("int")))
    side = F.when(e % 3 == 0, "좌").when(e % 3 == 1, "우").otherwise("양")
    felt = table(spark, d, "events").select(
        (e % 1500).alias("activity_id"), F.col("ts").cast("date").alias("symptom_date"), F.when(e % 4 == 0, "무릎내측").when(e % 4 == 1, "안장").when(e % 4 == 2, "경련-종아리").otherwise("허리").alias("area"), side.alias("side"),
        (e % 11).alias("severity"), (e % 7).alias("next_day"), F.nullif("event_type", F.lit("view")).alias("confounders"),
    )
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("activity_id"))
    load = lines.agg((F.sum("l_linenumber") * 60).alias("grind_s"), F.avg("l_linenumber").alias("climb_cadence"), F.lit(250.0).alias("ftp_anchor"))
    power = lines.agg((F.avg("l_quantity") / 50).alias("intensity"), F.lit(200.0).alias("np"), F.lit(50.0).alias("tss"))
    return gold.mart_symptom_ride(acts, felt, _changes(spark, d), power, load, F.col("gear_label"))


@query(f"""WITH {_RIDES} SELECT activity_id, activity_date, bike, symptoms, knee_medial_l, knee_medial_l_next, saddle, cramp, confounders, setup_since, moving_min, grind_min, grind_min_per_h, round(intensity, 6) AS intensity FROM rides""")
def mart_symptom_ride(spark, d):
    return _plain(_rides(spark, d), "activity_id", "activity_date", "bike", "symptoms", "knee_medial_l", "knee_medial_l_next", "saddle", "cramp", "confounders", "setup_since", "moving_min", "grind_min", "grind_min_per_h", "intensity")


@query(f"""WITH {_RIDES}, labels AS (SELECT effective_date, count(*) AS n_changes, string_agg(change_label, ', ' ORDER BY change_label) AS changes FROM changes WHERE target IN ('bike 0', '신발') GROUP BY 1)
SELECT coalesce(setup_since::VARCHAR, 'baseline') AS epoch, setup_since AS epoch_start, changes, n_changes, min(activity_date) AS first_ride, max(activity_date) AS last_ride, count(*)::BIGINT AS rides, count(knee_medial_l)::BIGINT AS knee_rides, max(knee_medial_l) AS knee_max,
(count(*) FILTER (knee_medial_l >= 4))::BIGINT AS knee_ge4_rides, round(avg(climb_cadence), 1) AS climb_cadence_avg FROM rides LEFT JOIN labels ON setup_since = effective_date WHERE bike = 'bike 0' GROUP BY 1, 2, 3, 4""")
def mart_fitting_epochs(spark, d):
    out = gold.mart_fitting_epochs(_rides(spark, d), _changes(spark, d), "bike 0")
    return _plain(out, "epoch", "epoch_start", "changes", "n_changes", "first_ride", "last_ride", "rides", "knee_rides", "knee_max", "knee_ge4_rides", "climb_cadence_avg")


# Pacing: an activity a user, a sample every four seconds, every eighth of them doubled; windows of eight seconds.

_PACING = pacing.PacingConfig(window_s=8, stride_s=4)
_SECONDS = """pts AS (SELECT user_id AS activity_id, 4 * ((rn * 7) // 8) AS t, round(value) AS watts, (event_id % 5)::DOUBLE AS cadence, (event_id % 190)::DOUBLE AS heartrate, 20.0::DOUBLE AS temp_c, 0.2 * (event_id % 9) AS speed_ms, 10 + rn / 1000 AS lat, 20 - rn / 1000 AS lon, rn * 400.0 AS distance_m,
  rn * (event_id % 7) * 1.0 AS ele_m, CASE WHEN event_id % 3 > 0 THEN event_type <> 'error' END AS moving FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)),
once AS (SELECT activity_id, t, count(*) > 1 AS doubled, CASE WHEN count(*) = 1 THEN max(watts) END AS watts, CASE WHEN count(*) = 1 THEN max(cadence) END AS cadence, CASE WHEN count(*) = 1 THEN max(heartrate) END AS heartrate, CASE WHEN count(*) = 1 THEN max(speed_ms) END AS speed_ms,
  CASE WHEN count(*) = 1 THEN max(lat) END AS lat, CASE WHEN count(*) = 1 THEN max(lon) END AS lon, CASE WHEN count(*) = 1 THEN max(distance_m) END AS distance_m, CASE WHEN count(*) = 1 THEN max(ele_m) END AS ele_m, CASE WHEN count(*) = 1 THEN bool_or(moving) END AS moving FROM pts GROUP BY 1, 2),
ahead AS (SELECT *, lead(t) OVER w AS nt, lead(lat) OVER w AS nlat, lead(lon) OVER w AS nlon, lead(distance_m) OVER w AS nd, lead(ele_m) OVER w AS nh FROM once WINDOW w AS (PARTITION BY activity_id ORDER BY t)),
cells AS (SELECT *, unnest(generate_series(t, nt - 1)) AS s FROM ahead WHERE nt - t <= 5),
seconds AS (SELECT activity_id, s AS t, watts, coalesce(moving, speed_ms >= 0.5, cadence > 0) AS moving, cadence, CASE WHEN heartrate > 0 THEN heartrate END AS heartrate, lat + coalesce((nlat - lat) * (s - t) / (nt - t), 0) AS lat, lon + coalesce((nlon - lon) * (s - t) / (nt - t), 0) AS lon,
  distance_m + coalesce((nd - distance_m) * (s - t) / (nt - t), 0) AS distance_m, ele_m + coalesce((nh - ele_m) * (s - t) / (nt - t), 0) AS ele_m, doubled FROM cells)"""


def _samples(spark, d) -> DataFrame:
    e, rn = F.col("event_id"), F.col("rn")
    ranked = table(spark, d, "events").withColumn("rn", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")))
    return ranked.select(
        F.col("user_id").alias("activity_id"), (4 * F.floor(rn * 7 / 8)).cast("long").alias("t"), F.round("value").alias("watts"), (e % 5).cast("double").alias("cadence"), (e % 190).cast("double").alias("heartrate"), F.lit(20.0).alias("temp_c"), (0.2 * (e % 9)).alias("speed_ms"),
        (10 + rn / 1000).alias("lat"), (20 - rn / 1000).alias("lon"), (rn * 400.0).alias("distance_m"), (rn * (e % 7) * 1.0).alias("ele_m"), F.when(e % 3 > 0, F.col("event_type") != "error").alias("moving"),
    )


@query(f"""WITH {_SECONDS}, s AS (SELECT activity_id, count(DISTINCT t) AS n, min(t) AS lo, max(t) AS hi FROM pts GROUP BY 1)
SELECT c_custkey AS activity_id, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'indoor' WHEN c_mktsegment = 'MACHINERY' THEN 'estimated_power' WHEN coalesce(n, 0) < 2 THEN 'no_stream' WHEN lo < 0 THEN 'invalid_time' WHEN hi < 8 OR hi > 172800 THEN 'duration' END AS rejection FROM customer LEFT JOIN s ON c_custkey = activity_id""")
def pacing_eligible(spark, d):
    segment = F.col("c_mktsegment")
    metas = table(spark, d, "customer").select(F.col("c_custkey").alias("activity_id"), F.when(segment == "FURNITURE", True).alias("is_indoor"), F.when(segment == "MACHINERY", False).alias("device_watts"))
    return pacing.eligible(metas, _samples(spark, d), _PACING).select("activity_id", "rejection")


@query(f"WITH {_SECONDS} SELECT activity_id, t, watts, moving, cadence, heartrate, round(lat, 6) AS lat, round(lon, 6) AS lon, round(distance_m, 6) AS distance_m, round(ele_m, 6) AS ele_m, doubled FROM seconds")
def pacing_seconds(spark, d):
    return _plain(pacing.grid(_samples(spark, d), _PACING).drop("temp_c"))


_SPANS = "spans AS (SELECT activity_id, max(t) AS span FROM pts GROUP BY 1)"


def _spans(samples: DataFrame) -> DataFrame:
    return samples.groupBy("activity_id").agg(F.max("t").alias("span"))


@query(f"""WITH {_SECONDS}, {_SPANS} SELECT activity_id, span, count(watts) FILTER (t IS NOT NULL)::BIGINT AS recorded_power_s, count_if(moving)::BIGINT AS observed_moving_s, round(count(watts) / span, 6) AS power_coverage FROM spans JOIN seconds USING (activity_id) GROUP BY 1, 2""")
def pacing_quality(spark, d):
    """Activities with a known second."""
    samples = _samples(spark, d)
    return _plain(pacing.quality(pacing.grid(samples, _PACING), _spans(samples)).filter("recorded_power_s is not null"))


@query(f"""WITH {_SECONDS}, {_SPANS}, st AS (SELECT activity_id, unnest(generate_series(0, span - 8, 4)) AS start_s FROM spans WHERE span >= 8),
c AS (SELECT start_s, t - start_s AS k, seconds.* FROM st JOIN seconds ON st.activity_id = seconds.activity_id AND t >= start_s AND t < start_s + 8),
e AS (SELECT activity_id, start_s, count(watts) / 8 AS coverage, count_if(moving) / 8 AS moving_fraction, count_if(cadence > 0) / 8 AS pedaling_fraction, avg(watts) AS avg_watts, count(lat) FILTER (k IN (0, 2, 4, 6, 7)) AS places, max(distance_m) FILTER (k = 7) - max(distance_m) FILTER (k = 0) AS distance_m,
  max(ele_m) FILTER (k = 7) - max(ele_m) FILTER (k = 0) AS climb, CASE WHEN count(heartrate) >= 0.9 * 8 THEN avg(heartrate) END AS heartrate FROM c GROUP BY 1, 2),
p AS (SELECT st.activity_id, start_s, coalesce(sum(watts) FILTER (t < start_s), 0) / 1000 AS kj, count(watts) FILTER (t < start_s) AS v, count_if(moving AND t < start_s) AS m, count_if(moving) AS whole FROM st JOIN seconds ON st.activity_id = seconds.activity_id GROUP BY 1, 2),
g AS (SELECT *, CASE WHEN distance_m > 0 THEN 100 * climb / distance_m END AS grade FROM e JOIN p USING (activity_id, start_s))
SELECT activity_id, start_s, start_s + 8 AS end_s, round(avg_watts, 6) AS avg_watts, round(coverage, 6) AS coverage, round(moving_fraction, 6) AS moving_fraction, round(pedaling_fraction, 6) AS pedaling_fraction, round(distance_m, 6) AS distance_m, round(grade, 6) AS grade_pct, round(heartrate, 6) AS heartrate,
CASE WHEN coverage < 0.98 THEN 'power_gap' WHEN moving_fraction < 0.95 THEN 'stops_or_unknown_motion' WHEN pedaling_fraction < 0.8 THEN 'coasting_or_missing_cadence' WHEN places < 5 THEN 'missing_gps' WHEN distance_m IS NULL OR distance_m < 300 OR grade IS NULL THEN 'distance_or_elevation' WHEN grade < -0.5 THEN 'descent' END AS rejection,
round(kj, 6) AS prior_recorded_kj, (start_s - v)::BIGINT AS prior_unknown_s, m::BIGINT AS prior_active_s, CASE WHEN start_s > 0 THEN round((start_s - v) / start_s, 6) ELSE 0.0 END::DOUBLE AS prior_unknown_fraction, CASE WHEN whole > 0 THEN round(m / whole, 6) ELSE 0.0 END::DOUBLE AS active_fraction FROM g""")
def pacing_windows(spark, d):
    samples = _samples(spark, d)
    found = pacing.windows(pacing.grid(samples, _PACING), _spans(samples), _PACING)
    return _plain(found.drop("anchors", "cadence", "temp_c"))


@query("""WITH n AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) SELECT c_custkey AS activity_id, coalesce(n, 0)::BIGINT AS comparison_count,
CASE WHEN c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 'no_eligible_ride' WHEN n IS NULL THEN 'no_comparable_segments' ELSE 'observations_available' END AS status FROM customer LEFT JOIN n ON user_id = c_custkey""")
def pacing_statuses(spark, d):
    asked = table(spark, d, "customer").select(F.col("c_custkey").alias("activity_id"))
    targets = table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("activity_id"))
    return pacing.statuses(asked, targets, table(spark, d, "events").filter("event_type = 'error'").select(F.col("user_id").alias("activity_id")))


@query("""WITH seconds AS (SELECT user_id AS activity_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS t, value AS watts FROM events), m AS (SELECT *, count(watts) OVER w = 30 AND avg(watts) OVER w > 45 AS high FROM seconds WHERE t < 5400 WINDOW w AS (PARTITION BY activity_id ORDER BY t RANGE BETWEEN 29 PRECEDING AND CURRENT ROW)),
n AS (SELECT *, CASE WHEN high AND NOT coalesce(lag(high) OVER (PARTITION BY activity_id ORDER BY t), false) THEN 1 ELSE 0 END AS new FROM m), i AS (SELECT *, sum(new) OVER (PARTITION BY activity_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS island FROM n),
r AS (SELECT activity_id, greatest(0, min(t) - 29) AS start_s, max(t) + 1 AS end_s, count(*)::BIGINT AS above_s FROM i WHERE high GROUP BY activity_id, island HAVING count(*) >= 5)
SELECT activity_id, start_s, end_s, above_s, round(avg(watts), 6) AS avg_watts, round(sum(watts) / 1000, 6) AS recorded_kj FROM r JOIN seconds USING (activity_id) WHERE t >= start_s AND t < end_s GROUP BY 1, 2, 3, 4""")
def pacing_early_efforts(spark, d):
    t = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long")
    seconds = table(spark, d, "events").select(F.col("user_id").alias("activity_id"), t.alias("t"), F.col("value").alias("watts"))
    return _plain(pacing.early_efforts(seconds, 45.0, least_s=5))


@query("""WITH f AS (SELECT *, 300 * (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1) AS start_s FROM lineitem),
u AS (SELECT l_orderkey AS activity_id, o_orderdate AS day, o_custkey % 3 AS gear, start_s, start_s + 300 AS end_s, l_quantity * 5 AS watts, l_partkey AS place, l_tax * 100 AS grade, 1000 + l_discount * 2000 AS metres, start_s * 1.0 AS kj FROM f JOIN orders ON l_orderkey = o_orderkey),
p AS (SELECT a.activity_id, a.start_s, a.watts, b.activity_id AS r, b.start_s AS rs, b.watts AS rw, b.day AS rd FROM u a JOIN u b ON a.place = b.place AND date_diff('day', b.day, a.day) BETWEEN 0 AND 180 AND (a.activity_id = b.activity_id OR a.gear = b.gear AND a.day > b.day) AND (a.activity_id <> b.activity_id OR b.end_s <= a.start_s - 300)
  AND a.kj - b.kj >= 150 AND abs(a.metres / b.metres - 1) <= 0.15 AND abs(a.grade - b.grade) <= 1.5),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY activity_id, start_s, r ORDER BY rs) AS rn FROM p) WHERE rn = 1), five AS (SELECT * FROM (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY activity_id, start_s ORDER BY rd DESC, rs, r) AS rn FROM one) WHERE rn <= 5)
SELECT activity_id, start_s, round(median(rw), 6) AS reference_watts, round(100 * (watts / median(rw) - 1), 6) AS change_pct, count(*)::BIGINT AS refs FROM five GROUP BY activity_id, start_s, watts""")
def pacing_comparisons(spark, d):
    """Lines of an order are its windows, one after another; a part is a place."""
    rank = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    lines = table(spark, d, "lineitem").withColumn("start_s", (300 * (rank - 1)).cast("long"))
    anchor = F.struct((F.col("l_partkey") * 0.01 % 60).alias("lat"), F.floor(F.col("l_partkey") / 6000).cast("double").alias("lon"))
    found = lines.select(
        F.col("l_orderkey").alias("activity_id"), "start_s", (F.col("start_s") + 300).alias("end_s"), (F.col("l_quantity") * 5).alias("avg_watts"), (1000 + F.col("l_discount") * 2000).alias("distance_m"), (F.col("l_tax") * 100).alias("grade_pct"),
        F.lit(None).cast("double").alias("temp_c"), F.col("start_s").cast("double").alias("prior_recorded_kj"), F.lit(0.0).alias("prior_unknown_fraction"), F.lit(6000).alias("prior_active_s"), F.lit(0.9).alias("active_fraction"),
        F.array(*[anchor] * 5).alias("anchors"), F.lit(None).cast("string").alias("rejection"),
    )
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("activity_id"), F.col("o_orderdate").cast("date").alias("activity_date"), F.col("o_orderdate").alias("start_utc"), (F.col("o_custkey") % 3).alias("gear_id"))
    out = pacing.comparisons(found, orders, orders)
    return _plain(out.withColumn("refs", F.size("references")), "activity_id", "start_s", "reference_watts", "change_pct", "refs")


# Quality

_RULES = f"""WITH {_SYMPTOMS}, latest AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, o_custkey ORDER BY o_orderdate DESC, o_orderkey - o_custkey % 2 DESC) AS rn FROM orders),
sums AS (SELECT o_orderstatus, sum(o_totalprice) / 1000 AS whole, sum(o_totalprice) FILTER (o_custkey % 50 > 0) / 1000 AS kept FROM orders GROUP BY 1)
SELECT 'fresh' AS rule, (SELECT count(*) FROM (SELECT max(ts)::DATE AS m FROM events) WHERE date_diff('day', m, DATE '2024-03-01') > 14) AS violations
UNION ALL SELECT 'duplicates', (SELECT count(*) FROM sums WHERE abs(whole - coalesce(kept, 0)) > 1) UNION ALL SELECT 'reconciled', (SELECT count(*) FROM latest WHERE rn = 1 AND o_custkey % 2 <> 0)
UNION ALL SELECT 'biased', (SELECT count(*) FROM (SELECT avg(o_totalprice) AS b FROM orders) WHERE abs(b) > 15) UNION ALL SELECT 'covered', (SELECT count(*) FROM (SELECT count(DISTINCT o_orderkey) AS a, count(DISTINCT l_orderkey) AS b FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey) WHERE b < 0.999 * a)
UNION ALL SELECT 'literal none', (SELECT count(*) FROM orders WHERE o_custkey % 5 < 2) UNION ALL SELECT 'unlinked', (SELECT count(*) FROM symptoms WHERE link_method IN ('ambiguous', 'unmatched'))"""


@query(_RULES)
def quality_more(spark, d):
    orders, c = table(spark, d, "orders"), F.col("o_custkey")
    mart = orders.groupBy(F.col("o_orderstatus").alias("sport")).agg((F.sum("o_totalprice") / 1000).alias("distance_km"))
    acts = orders.select(F.col("o_orderstatus").alias("sport"), (F.col("o_totalprice") / 1000).alias("distance_km"), (c % 50 == 0).alias("is_duplicate"))
    audit = orders.select(F.concat_ws("/", "o_orderpriority", "o_custkey").alias("table_name"), F.col("o_orderdate").alias("run_ts"), F.col("o_orderkey").alias("source_count"), (F.col("o_orderkey") - c % 2).alias("loaded_count"))
    texts = orders.select(F.when(c % 5 == 0, "None").when(c % 5 == 1, " ").otherwise("x").alias("text"))
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return quality.report({
        "fresh": quality.fresh(table(spark, d, "events").select(F.col("ts").cast("date").alias("day")), "day", dt.date(2024, 3, 1)), "duplicates": quality.excludes_duplicates(mart, acts), "reconciled": quality.reconciled(audit), "biased": quality.biased(orders, "o_totalprice"),
        "covered": quality.covered(orders, lines, "o_orderkey", 0.999), "literal none": quality.no_literal_none(texts, ["text"]), "unlinked": quality.unlinked(_symptoms(spark, d)),
    })


@query("""WITH a AS (SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
SELECT a.o_custkey, c AS "column" FROM a LEFT JOIN b ON a.o_custkey = b.o_custkey, (SELECT unnest(['total', 'n']) AS c) WHERE b.o_custkey IS NULL OR (c = 'n' AND a.n <> b.n) OR (c = 'total' AND abs(a.total - b.total) > 1e-6 * greatest(a.total, b.total))""")
def table_differences(spark, d):
    totals = lambda df: df.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n"))
    orders = table(spark, d, "orders")
    return quality.differences(totals(orders), totals(orders.filter("o_orderstatus <> 'P'")), ["o_custkey"], ["total", "n"]).select("o_custkey", "column")


# Hand-off

@query("""WITH posts AS (SELECT event_id, ts::DATE AS day, round(value) * 10 AS metres FROM events), swims AS (SELECT o_orderkey AS swim, DATE '2024-01-01' + (o_orderkey % 30)::INT AS day, (o_custkey % 1500) * 20.0 AS m FROM orders),
p AS (SELECT event_id, swim, count(*) OVER (PARTITION BY event_id) AS a, count(*) OVER (PARTITION BY swim) AS b FROM posts JOIN swims ON posts.day = swims.day AND abs(metres - m) <= 0.5) SELECT event_id, swim FROM p WHERE a = 1 AND b = 1""")
def linked_swims(spark, d):
    posts = table(spark, d, "events").select("event_id", F.col("ts").cast("date").alias("day"), (F.round("value") * 10).alias("metres"), F.lit(None).cast("double").alias("seconds"))
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("o_orderkey") % 30).cast("int"))
    swims = table(spark, d, "orders").select(F.col("o_orderkey").alias("activity_id"), F.concat(day.cast("string"), F.lit("T07:00:00")).alias("start_local"), ((F.col("o_custkey") % 1500) * 20.0).alias("distance"), F.lit(1800).alias("moving_time"))
    return handoff.linked_swims(posts, swims, "event_id", metres_off=0.5)


@query("""SELECT l_orderkey AS activity_id, 'catalog' AS origin FROM lineitem GROUP BY 1 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def stacked_catalog(spark, d):
    catalog = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("activity_id"), F.lit("catalog").alias("origin")).distinct()
    return handoff.stacked(catalog, table(spark, d, "orders").select(F.col("o_orderkey").alias("activity_id")))


@query("""WITH s AS (SELECT l_orderkey, l_linenumber - 1 AS split, l_quantity AS x, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem), h AS (SELECT *, CASE WHEN split < floor(n / 2) THEN 'a' WHEN split >= ceil(n / 2) THEN 'b' END AS h FROM s)
SELECT l_orderkey, count(*)::BIGINT AS splits, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS spread, round(100 * stddev_pop(x) / nullif(avg(x), 0), 6) AS cv_pct, min(x) AS best, max(x) AS worst, round(100 * (avg(x) FILTER (h = 'b') / nullif(avg(x) FILTER (h = 'a'), 0) - 1), 6) AS fade_pct FROM h GROUP BY 1""")
def swim_split_stats(spark, d):
    splits = table(spark, d, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).alias("split"), F.col("l_quantity").alias("seconds"))
    return _plain(coach.split_stats(splits, "l_orderkey"))


@query("""SELECT o_orderkey AS activity_id, CASE WHEN o_orderdate::DATE < DATE '1997-01-01' THEN 'before_cutover' WHEN state IS NOT NULL THEN 'already_' || state ELSE 'queued' END AS status
FROM orders LEFT JOIN (SELECT l_orderkey, max(l_linestatus) AS state FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def queue_admitted(spark, d):
    queue = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("activity_id")).agg(F.max("l_linestatus").alias("state"))
    return handoff.admitted(table(spark, d, "orders").select(F.col("o_orderkey").alias("activity_id"), F.col("o_orderdate").cast("date").alias("activity_date")), queue, "1997-01-01")


@query("""SELECT o_orderkey AS activity_id, o_orderpriority AS start_local FROM orders WHERE o_orderstatus = 'P' AND o_orderdate <= TIMESTAMP '1997-06-01' ORDER BY start_local, activity_id LIMIT 1""")
def next_job(spark, d):
    queue = table(spark, d, "orders").select(F.col("o_orderkey").alias("activity_id"), _kind(F.col("o_orderstatus"), "done", "failed", "pending").alias("state"), F.col("o_orderpriority").alias("start_local"), F.col("o_orderdate").cast("timestamp").alias("next_at"))
    return handoff.next_job(queue, "1997-06-01 00:00:00").select("activity_id", "start_local")


@query("""WITH now AS (SELECT o_orderkey, min(o_custkey) + min(l_linenumber) // 4 AS owner, CASE WHEN min(l_discount) < 0.02 THEN 'x' ELSE min(o_orderpriority) END AS text FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT o.o_orderkey AS activity_id, CASE WHEN n.o_orderkey IS NULL THEN 'missing' WHEN text <> o_orderpriority THEN 'text' ELSE 'owner' END AS fault FROM orders o LEFT JOIN now n ON o.o_orderkey = n.o_orderkey WHERE n.o_orderkey IS NULL OR text <> o_orderpriority OR owner <> o_custkey""")
def migration_faults(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("activity_id"), F.col("o_custkey").alias("athlete_id"), F.col("o_orderpriority").alias("analysis"))
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("activity_id")).agg(F.min("l_linenumber").alias("_n"), F.min("l_discount").alias("_d"))
    now = orders.join(lines, "activity_id").select("activity_id", (F.col("athlete_id") + F.floor(F.col("_n") / 4)).alias("athlete_id"), F.when(F.col("_d") < 0.02, "x").otherwise(F.col("analysis")).alias("analysis"))
    return handoff.migration_faults(orders, now)


@query("""SELECT count(*)::BIGINT AS n, count_if(sport IS NULL)::BIGINT AS kept, sum(activity_id)::BIGINT AS ids FROM (SELECT DISTINCT l_orderkey AS activity_id, NULL AS sport FROM lineitem UNION ALL SELECT o_orderkey, 'swimming' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))""")
def migrated(spark, d):
    now = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("activity_id"), F.lit(None).cast("string").alias("sport")).distinct()
    out = handoff.migrated(now, table(spark, d, "orders").select(F.col("o_orderkey").alias("activity_id")))
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("sport").isNull()).alias("kept"), F.sum("activity_id").alias("ids"))


@query("""WITH replies AS (SELECT l_orderkey, 100 * (2 + max(l_linenumber) % 4) AS code FROM lineitem GROUP BY 1), t AS (SELECT o_orderkey AS activity_id, CASE o_orderstatus WHEN 'F' THEN 'sending' WHEN 'O' THEN 'pending' ELSE 'sent' END AS old, code FROM orders LEFT JOIN replies ON l_orderkey = o_orderkey)
SELECT activity_id, CASE WHEN old <> 'sending' OR code IS NULL THEN old WHEN code = 200 THEN 'sent' WHEN code = 400 THEN 'failed' ELSE 'unknown' END AS state, CASE WHEN old = 'sending' AND code > 200 THEN 'status ' || code END AS error FROM t""")
def delivery_states(spark, d):
    deliveries = table(spark, d, "orders").select(F.col("o_orderkey").alias("activity_id"), _kind(F.col("o_orderstatus"), "sending", "pending", "sent").alias("state"), F.lit(None).cast("string").alias("error"))
    replies = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("activity_id")).agg((100 * (2 + F.max("l_linenumber") % 4)).alias("status"))
    return coach.delivered(deliveries, replies).select("activity_id", "state", "error")


@query("""WITH s AS (SELECT user_id, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY event_id)) AS dt, value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS dd FROM events)
SELECT user_id, bool_and(coalesce(dt > 0 AND dt <= 3e6 AND dd >= -150, true)) AND count(dt) > 0 AS usable FROM (SELECT user_id, dt, dd + 150 - 150 AS dd FROM s) GROUP BY 1""")
def evidence_usable(spark, d):
    """Distance is made to grow by 150 a point, so that some streams run forward and some do not."""
    stream = table(spark, d, "events").select("user_id", F.col("event_id").alias("point_idx"), F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("t"), "value", "event_id")
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    stream = stream.withColumns({"t": F.col("t") / 1e6, "distance": F.col("value") + 150 * rank})
    return handoff.evidence_usable(stream, "user_id", 3e6)


@query(f"""WITH {_ACTS}, lines AS (SELECT l_orderkey, 240.0 + max(l_linenumber) AS ftp, bool_or(l_tax > 0.07) AS dropout FROM lineitem GROUP BY 1), dated AS (SELECT 240.0 + s_nationkey % 4 AS ftp, max(DATE '2024-01-01' + s_suppkey::INT) AS ftp_date FROM supplier GROUP BY 1)
SELECT activity_id, sport, 'raw' || activity_id AS _raw, lines.ftp::DOUBLE AS ftp, ftp_date, dropout AS power_dropout, 'device' AS device_name FROM acts LEFT JOIN lines ON l_orderkey = activity_id LEFT JOIN dated ON dated.ftp = lines.ftp WHERE sport <> 'swimming' AND activity_date >= DATE '1996-01-01' AND activity_id % 6 <> 0""")
def coach_export(spark, d):
    acts = _context(spark, d)
    device = acts.withColumns({"elapsed_time": F.col("moving_time"), "max_speed": F.lit(1.0), "max_heartrate": F.lit(150.0), "device_name": F.lit("device"), "device_watts": F.lit(True)})
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("activity_id")).agg((240.0 + F.max("l_linenumber")).alias("ftp"), F.bool_or(F.col("l_tax") > 0.07).alias("dropout"))
    log = table(spark, d, "supplier").select((240 + F.col("s_nationkey") % 4).alias("ftp_watts"), F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("s_suppkey").cast("int")).alias("effective_date"), F.lit(True).alias("is_current"))
    out = coach.export_rows(acts.select("activity_id", "sport", "activity_date"), device, acts.select("activity_id", F.concat(F.lit("raw"), "activity_id").alias("_raw")), lines, log, lines, "1996-01-01", ("cycling", "running"))
    return out.select("activity_id", "sport", "_raw", "ftp", "ftp_date", "power_dropout", "device_name")


# Collecting

@query("""SELECT o_orderkey AS activity_id FROM orders WHERE (o_custkey % 3 = 0 OR o_custkey % 4 = 0) AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) AND o_orderkey NOT IN (SELECT user_id FROM events WHERE event_type IN ('view', 'click'))""")
def stream_todo(spark, d):
    c = F.col("o_custkey")
    acts = table(spark, d, "orders").select(F.col("o_orderkey").alias("activity_id"), F.when(c % 3 == 0, 100.0).alias("average_watts"), F.when(c % 4 == 0, 37.0).alias("start_lat"), F.col("o_orderdate").cast("date").alias("start_date_key"))
    ledger = table(spark, d, "events").select(F.col("user_id").alias("activity_id"), F.when(F.col("event_type") == "view", "done").when(F.col("event_type") == "click", "missing").otherwise("stopped").alias("status"))
    return collect.stream_todo(acts, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("activity_id")), ledger).select("activity_id")


@query("""SELECT 'i' || o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'Swim' ELSE 'Ride' END AS type FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND (o_custkey % 2 = 1 OR (o_orderstatus = 'O' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)))""")
def second_service_todo(spark, d):
    """Of every other customer an older name was seen."""
    ident = lambda c: F.concat(F.lit("i"), c)
    now = table(spark, d, "orders").select(ident("o_orderkey").alias("id"), _kind(F.col("o_orderstatus"), "Ride", "Swim", "Ride").alias("type"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderpriority").alias("name"), "o_custkey")
    seen = now.select("id", collect.fingerprint(F.when(F.col("o_custkey") % 2 == 1, "older").otherwise(F.col("name")).alias("name")).alias("fingerprint"))
    upgraded = table(spark, d, "lineitem").select(ident("l_orderkey").alias("id"))
    return collect.second_service_todo(now, seen, upgraded, ["name"], dt.date(1997, 1, 1)).select("id", "type")


@query("""SELECT 1000000000000 + o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'Ride' WHEN 'O' THEN 'VirtualRide' ELSE 'Swim' END AS type, (3600 * (o_custkey % 10))::DOUBLE AS utc_offset, round(o_totalprice / 1000, 6) AS kilojoules, o_custkey % 2 = 0 OR o_orderkey % 3 > 0 AS device_watts, o_orderstatus = 'O' AS trainer,
CASE WHEN o_custkey % 5 > 0 THEN 'garmin:' || o_custkey END AS external_id, CASE WHEN o_custkey % 4 > 0 THEN 1.5::DOUBLE END AS start_lat, CASE WHEN o_custkey % 4 > 0 THEN (o_custkey % 4)::DOUBLE END AS end_lat FROM orders""")
def second_service_activities(spark, d):
    key, c, at = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate").cast("timestamp")
    text = lambda x: F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss")
    place = lambda x: F.array(x.cast("double"), F.lit(0.0))
    lost = F.lit(None).cast("array<double>")
    docs = table(spark, d, "orders").select(
        F.concat(F.lit("i"), key).alias("id"), _kind(F.col("o_orderstatus"), "Ride", "VirtualRide", "Swim").alias("type"), F.concat(text(at), F.lit("Z")).alias("start_date"), text(at + F.make_dt_interval(hours=(c % 10).cast("int"))).alias("start_date_local"),
        F.col("o_totalprice").alias("icu_joules"), F.when(c % 2 == 0, True).alias("power_meter"), F.when(c % 5 > 0, c.cast("string")).otherwise("").alias("external_id"),
        F.when(c % 4 > 0, F.array(lost, place(F.lit(1.5)), place(c % 4), lost)).otherwise(F.array(lost)).alias("latlng"), F.when(key % 3 > 0, F.array(key)).otherwise(F.array().cast("array<long>")).alias("watts"),
    )
    out = normalise.activities(docs)
    return _plain(out.withColumns({"start_lat": F.get("start_latlng", F.lit(0)), "end_lat": F.get("end_latlng", F.lit(0))}), "id", "type", "utc_offset", "kilojoules", "device_watts", "trainer", "external_id", "start_lat", "end_lat")


@query(f"""WITH {_ACTS} SELECT activity_id FROM acts WHERE sport = 'cycling' AND activity_id % 3 > 0""")
def awaiting_service(spark, d):
    k = F.col("activity_id") % 3
    text = F.when(k == 0, F.lit(" ".join(gold.SERVICE_WORDS))).when(k == 1, F.lit(gold.SERVICE_WORDS[0]))
    return gold.awaiting_service(_acts(spark, d).withColumn("description", text)).select("activity_id")


@query("""SELECT o_orderkey AS activity_id, sha256('b' || o_orderkey || o_orderpriority) AS sha256 FROM orders WHERE o_custkey % 2 = 1""")
def publish_todo(spark, d):
    """The receiver has an older form of every other customer's bundles."""
    text = lambda *last: F.concat(F.lit("b"), "o_orderkey", *last)
    orders = table(spark, d, "orders").withColumn("activity_id", F.col("o_orderkey"))
    ledger = orders.select("activity_id", F.sha2(F.when(F.col("o_custkey") % 2 == 1, text(F.lit("older"))).otherwise(text("o_orderpriority")), 256).alias("sha256"))
    return collect.to_publish(orders.select("activity_id", text("o_orderpriority").alias("bundle")), ledger).select("activity_id", "sha256")


@query("""WITH p AS (SELECT user_id, event_id, (event_id % 97) * 3.0 AS x, CASE WHEN event_type <> 'error' THEN value / 17.3::DOUBLE END AS h FROM events), f AS (SELECT *, min({'d': x, 'o': event_id, 'h': h}) OVER (PARTITION BY user_id, h IS NOT NULL ORDER BY x RANGE BETWEEN 30 PRECEDING AND CURRENT ROW) AS a FROM p),
g AS (SELECT *, CASE WHEN h IS NOT NULL AND x - a.d >= 5 THEN round(greatest(-30, least(30, 100 * (h - a.h) / (x - a.d))), 1) + 0 END AS own FROM f)
SELECT user_id, event_id, CASE WHEN h IS NOT NULL THEN coalesce(last_value(own IGNORE NULLS) OVER (PARTITION BY user_id, h IS NOT NULL ORDER BY x, event_id ROWS UNBOUNDED PRECEDING), 0)::DOUBLE END AS grade_pct FROM g""")
def grade_from_height(spark, d):
    points = table(spark, d, "events").select("user_id", "event_id", ((F.col("event_id") % 97) * 3.0).alias("x"), F.when(F.col("event_type") != "error", F.col("value") / 17.3).alias("h"))
    return _plain(normalise.grade(points, "user_id", "event_id", "x", "h"), "user_id", "event_id", "grade_pct")
