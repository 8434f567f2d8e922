import datetime as dt

import pytest
from pyspark.sql import functions as F

from veloframe.config import Config
from veloframe.plans import coach, gold, quality, report, silver

CONFIG = Config(as_of=dt.date(2024, 3, 1))
ACT = "activity_id long, type string, gear_id string, start string, elapsed_time long, moving_time long, distance double, average_speed double, max_speed double, total_elevation_gain double, trainer boolean, start_lat double, name string, description string, weighted_average_watts double, device_watts boolean"


def act(id_, type_="Ride", start="2024-02-20 08:00:00", elapsed=3600, moving=3500, distance=30_000.0, gear="g1", trainer=False, description=None):
    return (id_, type_, gear, start, elapsed, moving, distance, 8.0, 12.0, 300.0, trainer, 37.0, f"a{id_}", description, 205.0, True)


@pytest.fixture(scope="module")
def acts(spark):
    rows = [act(1), act(2, start="2024-02-20 08:10:00", elapsed=1000), act(3, "Swim", "2024-02-21 07:00:00", 1800, 1750, 1500.0, None), act(4, "Swim", "2024-02-22 07:00:00", 1800, 1200, 1500.0, None),
            act(5, "Yoga", "2024-01-10 07:00:00", 1800, 1800, 0.0, None), act(6, "VirtualRide", "2024-01-20 07:00:00", 12_000, 11_000, 90_000.0, "g9999999", description="훈련상태 체력 50 피로 60 균형 -10, R파워 210w 강도 0.84 훈련량 80 회복시간 12 시간, 지구력 훈련 (L2) 20분  230w")]
    # Local days, nine hours ahead of UTC.
    df = spark.createDataFrame(rows, ACT).withColumn("start_ts_utc", F.to_timestamp("start")).withColumn("start_date_key", F.expr("cast(start_ts_utc + interval 9 hours as date)"))
    return silver.activities(df, {"g1": "road one"}, CONFIG).cache()


@pytest.fixture(scope="module")
def points(spark, acts):
    rows = [(1, i, 200 if i < 3000 else None, 60 if i % 2 else 0, 5.0 if i < 100 else 0.0) for i in range(3400)] + [(6, i, 150 + 50 * (i > 8000), 90, 0.0) for i in range(11_000)]
    streams = spark.createDataFrame(rows, "activity_id long, point_idx int, watts long, cadence long, grade_pct double").selectExpr(
        "activity_id", "point_idx", "cast(point_idx as long) time_offset_s", "37.0D lat", "127.0D lon", "10.0D ele_m", "point_idx * 8.0D distance_m", "8.0D speed_ms", "120L heartrate", "cadence", "watts", "20L temp_c", "grade_pct", "true moving")
    gpx = spark.createDataFrame([(1, "sync", 0), (3, "sync", 0), (4, "manual_drop", 0)], "activity_id long, origin string, point_idx int").selectExpr(
        "activity_id", "origin", "point_idx", "37.0D lat", "127.0D lon", "1.0D ele_m", "100 heartrate", "cast(null as int) cadence", "cast(null as int) temp_c", "timestamp'2024-02-21 07:00:05' point_ts")
    return silver.trackpoints(streams, gpx, acts).cache()


@pytest.fixture(scope="module")
def ftp(spark):
    log = spark.createDataFrame([("2024-01-01", 240, True), ("2024-02-01", 250, True), ("2024-03-01", 260, False)], "d string, ftp_watts int, is_current boolean").withColumn("effective_date", F.to_date("d"))
    return gold.current_ftp(log)


def test_silver(acts, points):
    got = {r.activity_id: r for r in acts.collect()}
    assert got[2].is_duplicate and got[2].duplicate_of_activity_id == 1 and not got[1].is_duplicate and not got[5].is_duplicate
    assert [got[i].sport for i in (1, 3, 5, 6)] == ["cycling", "swimming", "other", "cycling"]
    assert [got[i].gear_label for i in (1, 3, 6)] == ["road one", "unassigned", "other(g99999…)"] and got[6].is_indoor
    assert {(r.activity_id, r.source) for r in points.select("activity_id", "source").distinct().collect()} == {(1, "stream"), (6, "stream"), (3, "gpx")}
    assert points.filter("source = 'gpx'").first().time_offset_s == 5


def test_one_current_threshold(spark, ftp):
    assert [r.ftp for r in ftp.collect()] == [250.0]
    with pytest.raises(Exception, match="no current threshold"):
        gold.current_ftp(spark.createDataFrame([(1, False)], "ftp_watts int, is_current boolean").withColumn("effective_date", F.lit(None).cast("date"))).collect()


def test_power_marts(spark, acts, points, ftp):
    clean, power = gold.stg_activities(acts, CONFIG), gold.stg_power_points(gold.stg_trackpoints(points))
    ride = {r.activity_id: r for r in gold.mart_ride_power(points, clean, ftp, CONFIG).collect()}
    assert ride[1].np == pytest.approx(200) and ride[1].intensity == pytest.approx(0.8) and ride[1].tss == pytest.approx(3500 * 200 * 0.8 / (250 * 3600) * 100) and ride[1].np_diff == pytest.approx(-5)
    curve = gold.int_power_curve_ride(power, clean, config=CONFIG)
    best = {(r.activity_id, r.duration_s): r.best_watts for r in curve.collect()}
    assert best[1, 1800] == 200 and (1, 3600) not in best and best[6, 1200] == 200 and (6, 14400) not in best
    assert {r.activity_id for r in gold.int_power_curve_ride(power, clean, clean.filter("activity_id = 1"), CONFIG).collect()} == {6}
    mart = gold.mart_power_curve(curve, CONFIG)
    top = {(r.duration_s, r.window_label): (r.activity_id, r.duration_label) for r in mart.collect()}
    assert top[60, "all_time"] == (6, "1분") and top[3600, "recent_90d"][1] == "1시간"
    est = {r.window_label: r for r in gold.mart_ftp_estimate(mart, ftp).collect()}
    assert est["all_time"].by_20min == pytest.approx(190) and est["all_time"].cp == pytest.approx(200) and est["all_time"].method_spread == pytest.approx(10)
    zones = {(r.activity_id, r.zone): (r.seconds, r.pct) for r in gold.mart_power_zones(power, clean, ftp, CONFIG).collect()}
    assert zones[1, 3] == (3000, 100.0) and sum(p for (a, _), (_, p) in zones.items() if a == 6) == pytest.approx(100)
    load = {r.activity_id: r for r in gold.int_ride_load(points, ftp, CONFIG).collect()}
    assert load[1].grind_s == 1500 and load[1].climb_s == 100 and load[1].grind_climb_s == 50 and load[1].pedaling_cadence == 60 and load[1].power_samples == 3000
    assert {r.activity_id for r in gold.int_ride_load(points, ftp, CONFIG, spark.createDataFrame([(1, 250.0), (6, 240.0)], 'activity_id long, ftp_anchor double')).collect()} == {6}
    long = gold.mart_ride_durability(power, clean, CONFIG).collect()
    assert [r.activity_id for r in long] == [6] and not long[0].dropout and long[0].q4_to_q1 == pytest.approx(200 / 150)


def test_totals(acts):
    clean = gold.stg_activities(acts, CONFIG)
    assert {r.sport: r.activities for r in gold.mart_sport_totals(clean).collect()} == {"cycling": 2, "swimming": 2, "other": 1}
    assert quality.excludes_duplicates(gold.mart_sport_totals(clean), acts).count() == 0
    assert quality.excludes_duplicates(gold.mart_sport_totals(acts), acts).count() == 1
    periods = {(r.period_type, r.period, r.sport): r.activities for r in gold.mart_period_summary(clean).collect()}
    assert periods["month", "2024-02", "swimming"] == 2 and periods["all", "all", "cycling"] == 2 and periods["year", "2024", "other"] == 1
    assert {(r.year, r.sport): r.indoor for r in gold.mart_yearly_summary(clean).collect()}[2024, "cycling"] == 1
    gear = {(r.gear_id, r.gear_label): r.indoor_pct for r in gold.mart_gear_usage(clean).collect()}
    assert gear == {("g1", "road one"): 0.0, ("g9999999", "other(g99999…)"): 100.0}
    pace = gold.mart_swim_pace_monthly(clean).first()
    assert (pace.swims, pace.paced_swims, pace.pace_s_per_100m, pace.pace_label) == (2, 1, 80.0, "1:20")
    status = gold.mart_training_status(clean, CONFIG)
    got = {r.sport: r for r in status.collect()}
    assert (got["cycling"].recent_n, got["cycling"].previous_n, got["running"].recent_n, got["running"].days_since) == (1, 1, 0, None)
    assert "swimming 2x" in report.status_sentence(status) and "running" not in report.status_sentence(status)
    assert report.markdown_table(status.orderBy("sport"), ["sport", "days_since"]).splitlines()[3] == "| running | · |"


def test_text_fields_and_symptoms(spark, acts, points, ftp):
    clean = gold.stg_activities(acts, CONFIG)
    said = gold.stg_service_notes(clean)
    r = gold.mart_service_metrics(said).first()
    assert (r.fitness, r.fatigue, r.form, r.r_power, r.intensity, r.load, r.recovery_h, r.training_type, r.peak_20min_w, r.peak_5min_w, r.implied_ftp) == (50, 60, -10, 210, 0.84, 80, 12, "지구력 훈련 (L2)", 230, None, 250)
    log = spark.createDataFrame([("2024-02-20", "cycling", None, "무릎내측", 3, 1), ("2024-02-20", "cycling", None, "무릎내측", 3, 1), ("2024-02-21", "running", None, "허리", 1, None), ("2024-01-20", "cycling", 6, "허리", 5, None), ("2024-02-21", "swimming", None, "None", 1, None)],
                                "d string, sport string, activity_id long, area string, severity int, next_day int").withColumn("symptom_date", F.to_date("d")).drop("d").withColumns({"side": F.lit("좌"), "onset": F.lit(""), "memo": F.lit(""), "confounders": F.lit("wind")})
    symptoms = gold.stg_symptoms(log, clean)
    assert sorted((r.link_method, r.activity_id or 0) for r in symptoms.collect()) == [("date_sport", 1), ("date_sport", 3), ("explicit", 6), ("unmatched", 0)]
    assert quality.unlinked(symptoms).count() == 1 and quality.no_literal_none(log, ["area"]).count() == 1
    changes = gold.stg_fitting_changes(spark.createDataFrame([("2024-02-01", "road", "saddle", "L", "1", "2", "applied"), ("2024-02-10", "신발", "cleat", "", "1", None, "applied"), ("2024-02-15", "road", "bar", "", "", "", "planned")],
                                                             "d string, target string, item string, side string, before string, after string, status string").withColumn("effective_date", F.to_date("d")))
    assert sorted(r.change_label for r in changes.collect()) == ["cleat", "saddle(L) 2"]
    bike = F.when(F.col("gear_label").like("road%"), "road").otherwise("other")
    rides = gold.mart_symptom_ride(clean, symptoms, changes, gold.mart_ride_power(points, clean, ftp, CONFIG), gold.int_ride_load(points, ftp, CONFIG), bike)
    got = {r.activity_id: r for r in rides.collect()}
    assert got[1].knee_medial_l == 3 and got[1].knee_medial_l_next == 1 and got[1].low_back is None and got[1].confounders == "wind" and str(got[1].setup_since) == "2024-02-10" and got[6].setup_since is None and got[6].low_back == 5
    epochs = {r.epoch: (r.changes, r.n_changes, r.rides, r.knee_rides, r.knee_ge4_rides) for b in ("road", "other") for r in gold.mart_fitting_epochs(rides, changes, b).collect()}
    assert epochs == {"2024-02-10": ("cleat", 1, 1, 1, 0), "baseline": (None, None, 1, 0, 0)}
    feed = gold.mart_activity_feed(clean, gold.mart_ride_power(points, clean, ftp, CONFIG), said, symptoms)
    assert feed.count() == clean.count() and feed.filter("activity_id = 1").first().symptoms == 1
    bundle = {r.activity_id: r.bundle for r in coach.bundles(feed, feed, "2024-02-22").collect()}
    assert set(bundle) == {4} and "a1" in bundle[4] and "a6" not in bundle[4] and "lat" not in bundle[4]


def test_quality_catches_faults(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (None, "c", 50)], "id int, k string, v int")
    assert [x.count() for x in (quality.unique(df, "id"), quality.not_null(df, "id"), quality.accepted(df, "k", ["a", "b"]), quality.between(df, "v", 0, 10), quality.unique_combination(df, ["id", "k"]))] == [1, 1, 1, 1, 0]
    days = spark.createDataFrame([("2024-01-01",)], "d string").select(F.to_date("d").alias("d"))
    assert quality.fresh(days, "d", dt.date(2024, 1, 10)).count() == 0 and quality.fresh(days, "d", dt.date(2024, 2, 10)).count() == 1 and quality.fresh(days.limit(0), "d", dt.date(2024, 2, 10)).count() == 1
    assert quality.covered(spark.range(100), spark.range(90), "id").count() == 1 and quality.covered(spark.range(100), spark.range(96), "id").count() == 0
    a, b = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double"), spark.createDataFrame([(1, 1.0 + 1e-9), (3, 2.0)], "k int, v double")
    assert sorted(r.k for r in quality.differences(a, b, ["k"], ["v"]).collect()) == [2, 3]


def test_swims(spark):
    rows, d = [], 0.0
    for t in range(0, 400):
        d += 0.0 if 150 <= t < 180 else 1.0
        rows.append((1, float(t), d))
    stream = spark.createDataFrame(rows, "k int, t double, distance double")
    laps = [(r.kind, r.start, r.stop) for r in coach.laps_from_stream(stream, "k").orderBy("start").collect()]
    assert [x[0] for x in laps] == ["swim", "rest", "swim"] and laps[1][1:] == (149.0, 179.0)
    splits = {r.split: r.seconds for r in coach.swim_splits(stream, "k").collect()}
    assert splits[1] == pytest.approx(100) and splits[2] == pytest.approx(100)
    stats = coach.split_stats(coach.swim_splits(stream, "k"), "k").first()
    assert stats.spread == pytest.approx(0, abs=1e-6)


def test_job_states(spark):
    jobs = spark.createDataFrame([(1, 0, "analyzing"), (2, 4, "sending")], "id int, tries int, state string")
    assert [(r.state, r.tries) for r in coach.next_state(jobs, "2024-01-01 00:00:00").orderBy("id").collect()] == [("pending", 1), ("failed", 5)]
    assert [r.state for r in coach.recovered(jobs).orderBy("id").collect()] == ["pending", "unknown"]


def test_setups_by_day_and_label_by_epoch(spark):
    """Rides and changes in numbers whose pairs, or whose label on each ride, would take minutes."""
    import time

    n, day = 100_000, dt.date(2024, 1, 5)
    k = F.col("id")
    acts = spark.range(n).select(k.alias("activity_id"), F.lit(day).alias("activity_date"), F.lit("cycling").alias("sport"), F.lit(1.0).alias("distance_km"), F.lit(3600).alias("moving_time"))
    changes = spark.range(n).select(F.when(k % 2 == 0, "road").otherwise(gold.SHOES).alias("target"), F.date_sub(F.lit(day), (k % 3).cast("int")).alias("effective_date"), F.concat(F.lit("saddle of many words "), k).alias("change_label"))
    felt = spark.createDataFrame([(1, day, "무릎내측", "좌", 5, 4, None)], "activity_id long, symptom_date date, area string, side string, severity long, next_day long, confounders string")
    power = spark.createDataFrame([], "activity_id long, np double, intensity double, tss double")
    load = spark.createDataFrame([], "activity_id long, grind_s long, climb_cadence double, ftp_anchor double")
    start = time.monotonic()
    bike = F.when(F.col("activity_id") % 2 == 0, "road")
    rides = gold.mart_symptom_ride(acts, felt, changes, power, load, bike)
    assert [tuple(r) for r in rides.groupBy("setup_since").count().collect()] == [(day, n)]  # without a bike, what all share counts
    (epoch,) = gold.mart_fitting_epochs(rides, changes, "road").collect()
    assert (epoch.epoch, epoch.epoch_start, epoch.n_changes, epoch.rides, len(epoch.changes.split(", "))) == ("2024-01-05", day, 33_334, n // 2, 33_334)
    assert time.monotonic() - start < 60
