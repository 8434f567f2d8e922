"""Gold: staging views, intermediate tables and marts as functions of DataFrames.

Nothing here reads the clock, collects, or orders by fewer columns than make the order total. Marts that need the threshold power take one
row of it (``current_ftp``), which is joined as a broadcast of one row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veloframe.config import Config
from veloframe.functions import blank_to_null, minutes_seconds, per
from veloframe.operators.series import as_of, best_means_by_second, l4_mean, period_totals, top_one, trailing, zones

# Staging


def stg_activities(silver: DataFrame, config: Config = Config()) -> DataFrame:
    """Activities without duplicates; swims whose moving time is nearly the elapsed time include their rests."""
    rest = (F.col("sport") == "swimming") & (F.col("moving_time") >= config.rest_share * F.col("elapsed_time"))
    return silver.filter(~F.col("is_duplicate")).withColumn("rest_included", F.coalesce(rest, F.lit(False)))


def stg_trackpoints(silver: DataFrame) -> DataFrame:
    return silver.filter(~F.col("is_duplicate"))


def stg_power_points(points: DataFrame) -> DataFrame:
    """Points of rides with power; runs with power are another measure."""
    return points.filter("sport = 'cycling' and watts is not null").select("activity_id", "point_ts", "watts")


def stg_ftp(ftp_log: DataFrame) -> DataFrame:
    return ftp_log.select("effective_date", "ftp_watts", "w_per_kg", "method", "confidence", "is_current")


def current_ftp(ftp: DataFrame) -> DataFrame:
    """Exactly one row: of the rows marked current, the latest. None at all is an error, not an empty mart."""
    one = ftp.filter("is_current").agg(F.max_by("ftp_watts", F.struct("effective_date", "ftp_watts")).alias("ftp_watts"))
    return one.select(F.when(F.col("ftp_watts").isNull(), F.raise_error(F.lit("no current threshold power"))).otherwise(F.col("ftp_watts")).cast("double").alias("ftp"))


def stg_fitness(fitness: DataFrame, config: Config = Config()) -> DataFrame:
    return fitness.filter(F.col("fitness_date") <= F.lit(config.as_of))


def stg_fitting_changes(changes: DataFrame) -> DataFrame:
    """Applied and reverted changes, with a label; blanks are NULL."""
    names = ("target", "item", "side", "before", "after", "status", "source", "memo")
    out = changes.withColumns({c: blank_to_null(F.col(c)) for c in names if c in changes.columns}).filter(F.col("status").isin("applied", "reverted"))
    side = F.coalesce(F.concat(F.lit("("), "side", F.lit(")")), F.lit(""))
    return out.withColumn("change_label", F.trim(F.concat("item", side, F.lit(" "), F.coalesce("after", F.lit("")))))


def link_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], id_: str, explicit: str | None = None) -> DataFrame:
    """``left`` with ``linked`` and ``method``: its explicit id; else the only right id with its keys (method 'date'); else 'ambiguous' or 'unmatched'."""
    found = right.groupBy(*keys).agg(F.min(id_).alias("_id"), F.count_distinct(id_).alias("_n"))
    own = F.col(explicit) if explicit else F.lit(None).cast("long")
    out = left.join(found, list(keys), "left")
    method = F.when(own.isNotNull(), "explicit").when(F.col("_n").isNull(), "unmatched").when(F.col("_n") == 1, "date").otherwise("ambiguous")
    return out.withColumns({"linked": F.coalesce(own, F.when(F.col("_n") == 1, F.col("_id"))), "method": method}).drop("_id", "_n")


def stg_symptoms(log: DataFrame, activities: DataFrame) -> DataFrame:
    """Symptoms with a key and the activity they belong to; equal rows count once."""
    names = ("sport", "area", "side", "onset", "course", "confounders", "memo")
    out = log.withColumns({c: blank_to_null(F.col(c)) for c in names if c in log.columns}).distinct()
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("∅")) for c in ("symptom_date", "sport", "area", "side", "severity", "onset", "memo")]
    out = out.withColumn("symptom_key", F.md5(F.concat_ws("|", *parts).cast("binary")))
    moved = activities.filter("distance > 0").select(F.col("activity_date").alias("symptom_date"), "sport", F.col("activity_id").alias("candidate"))
    out = link_unique(out, moved, ["symptom_date", "sport"], "candidate", "activity_id")
    return out.drop("activity_id").withColumnsRenamed({"linked": "activity_id", "method": "link_method"}).withColumn("link_method", F.when(F.col("link_method") == "date", "date_sport").otherwise(F.col("link_method")))


#: What the service writes into descriptions, by field: pattern, group and type.
SERVICE_FIELDS = {
    "fitness": (r"체력\s*(-?\d+)", 1, "int"),
    "fatigue": (r"피로\s*(-?\d+)", 1, "int"),
    "form": (r"균형\s*(-?\d+)", 1, "int"),
    "r_power": (r"R파워\s*(\d+)", 1, "int"),
    "intensity": (r"강도\s*([\d.]+)", 1, "double"),
    "load": (r"훈련량\s*(\d+)", 1, "int"),
    "recovery_h": (r"회복시간\s*(\d+)\s*시간", 1, "int"),
    "training_type": (r"([가-힣A-Za-z][가-힣A-Za-z ]*훈련)\s*\(([^)]*)\)", 0, "string"),
    "peak_5min_w": (r"5분\s+(\d+)w", 1, "int"),
    "peak_20min_w": (r"20분\s+(\d+)w", 1, "int"),
    "peak_40min_w": (r"40분\s+(\d+)w", 1, "int"),
    "peak_1h_w": (r"1시간\s+(\d+)w", 1, "int"),
}
#: Words that all stand in what the service writes.
SERVICE_WORDS = ("훈련상태", "R파워")


def has_service_text(text: Column, service: str | None = None) -> Column:
    """Whether a service wrote into a description: all its words stand there, or its name (in any case)."""
    its = F.lit(True)
    for word in SERVICE_WORDS:
        its = its & text.contains(word)
    return its | F.lower(text).contains(service.lower()) if service else its


def awaiting_service(activities: DataFrame, service: str | None = None) -> DataFrame:
    """Rides in whose description the service has not written yet; it writes into rides alone."""
    return activities.filter((F.col("sport") == "cycling") & ~F.coalesce(has_service_text(F.col("description"), service), F.lit(False)))


def stg_service_notes(activities: DataFrame, service: str | None = None) -> DataFrame:
    """Numbers that a service wrote into descriptions, and the threshold power that they imply."""
    text = F.col("description")
    out = activities.filter(has_service_text(text, service))
    for name, (pattern, group, kind) in SERVICE_FIELDS.items():
        out = out.withColumn(name, F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast(kind))
    return out.withColumn("implied_ftp", F.round(per(F.col("r_power"), F.col("intensity"))).cast("int"))


# Intermediate


def int_power_curve_ride(power: DataFrame, activities: DataFrame, done: DataFrame | None = None, config: Config = Config()) -> DataFrame:
    """activity_id, duration_s, best_watts, activity_date and name. Activities of ``done`` (activity_id) are left out before the windows, not after."""
    if done is not None:
        power = power.join(done.select("activity_id").distinct(), "activity_id", "left_anti")
    windows = [(s, math.ceil(s * config.window_share)) for s in config.durations]
    best = best_means_by_second(power, "activity_id", "point_ts", "watts", windows).withColumnsRenamed({"seconds": "duration_s", "best": "best_watts"})
    return best.join(activities.select("activity_id", "activity_date", "name"), "activity_id")


def int_ride_load(points: DataFrame, ftp: DataFrame, config: Config = Config(), done: DataFrame | None = None) -> DataFrame:
    """Of rides with power: seconds of low cadence under load, of climbing, and both; mean cadences. Rides of ``done`` (activity_id, ftp_anchor) are
    left out where their anchor is still the present one, since a new anchor makes all old rows wrong."""
    p = points.filter("sport = 'cycling' and watts is not null").crossJoin(F.broadcast(ftp))
    if done is not None:
        p = p.join(done.select("activity_id", F.col("ftp_anchor").alias("ftp")).distinct(), ["activity_id", "ftp"], "left_anti")
    turning = F.col("cadence") > 0
    grind = turning & (F.col("cadence") < config.low_cadence) & (F.col("watts") >= config.hard_share * F.col("ftp"))
    steep = F.col("grade_pct") >= config.climb_grade
    return p.groupBy("activity_id").agg(
        F.max("ftp").alias("ftp_anchor"), F.count(F.lit(1)).alias("power_samples"), F.count_if(grind).alias("grind_s"), F.count_if(steep & F.coalesce("moving", F.lit(True))).alias("climb_s"),
        F.count_if(grind & steep).alias("grind_climb_s"), F.avg(F.when(turning & steep, F.col("cadence"))).alias("climb_cadence"), F.avg(F.when(turning, F.col("cadence"))).alias("pedaling_cadence"),
    )


# Marts


def quarters(df: DataFrame, key: str, ts: str, value: str, seconds: int, active: float, least_share: float) -> DataFrame:
    """L4 power of each quarter of a key's samples; a quarter with too small a share above ``active`` is NULL; ``dropout`` tells of any."""
    q = df.filter(F.col(value).isNotNull()).select(key, ts, value, F.ntile(4).over(Window.partitionBy(key).orderBy(ts)).alias("q"))
    smooth = q.select(key, "q", value, trailing(f"avg({value})", f"{key}, q", ts, seconds).alias("p"))
    each = smooth.groupBy(key, "q").agg(l4_mean(F.col("p")).alias("np"), F.avg((F.col(value) > active).cast("double")).alias("share"))
    sound = F.col("share") >= least_share
    return each.groupBy(key).agg(*[F.max(F.when((F.col("q") == i) & sound, F.col("np"))).alias(f"q{i}") for i in range(1, 5)], F.bool_or(~sound).alias("dropout"))


def mart_ride_power(points: DataFrame, activities: DataFrame, ftp: DataFrame, config: Config = Config()) -> DataFrame:
    """Normalised power, intensity and stress of each ride, and how far the device's figure is from ours."""
    smooth = stg_power_points(points).select("activity_id", trailing("avg(watts)", "activity_id", "point_ts", config.smooth_s).alias("p"))
    each = smooth.groupBy("activity_id").agg(l4_mean(F.col("p")).alias("np"), F.count(F.lit(1)).alias("power_samples"))
    out = activities.filter("sport = 'cycling'").join(each, "activity_id").crossJoin(F.broadcast(ftp))
    intensity = F.col("np") / F.col("ftp")
    return out.withColumns({
        "intensity": intensity, "tss": F.col("moving_time") * F.col("np") * intensity / (F.col("ftp") * 3600) * 100, "np_diff": F.col("np") - F.col("weighted_average_watts"),
    }).select(*[c for c in RIDE_CONTEXT if c in activities.columns], "np", "power_samples", "np_diff", "ftp", "intensity", "tss")


#: What a ride's power mart carries of the activity.
RIDE_CONTEXT = (
    "activity_id", "activity_date", "year", "month", "name", "gear_label", "is_indoor", "distance_km", "moving_h", "moving_time", "elev_m", "average_watts", "weighted_average_watts",
    "average_heartrate", "max_heartrate", "kilojoules",
)


def mart_power_zones(power: DataFrame, activities: DataFrame, ftp: DataFrame, config: Config = Config()) -> DataFrame:
    """Seconds, minutes and share of each ride in each of seven zones."""
    zone = zones(F.col("watts"), [b * F.col("ftp") for b in config.zones])
    each = power.crossJoin(F.broadcast(ftp)).groupBy("activity_id", zone.alias("zone")).agg(F.count(F.lit(1)).alias("seconds"))
    share = 100.0 * F.col("seconds") / F.sum("seconds").over(Window.partitionBy("activity_id"))
    label = F.get(F.array(*map(F.lit, config.zone_labels)), F.col("zone") - 1)
    return each.withColumns({"zone_label": label, "minutes": F.col("seconds") / 60, "pct": share}).join(activities.select("activity_id", "activity_date", "name", "is_indoor"), "activity_id")


def mart_ride_durability(power: DataFrame, activities: DataFrame, config: Config = Config()) -> DataFrame:
    """Rides of three hours and more: power by quarter of the samples, the last against the first, and the second half against the first."""
    long = activities.filter((F.col("sport") == "cycling") & (F.col("moving_time") >= config.long_ride_s)).select("activity_id", "activity_date", "name", "moving_time")
    out = quarters(power.join(long.select("activity_id"), "activity_id", "left_semi"), "activity_id", "point_ts", "watts", config.smooth_s, 0.0, config.dropout_share)
    return out.join(long, "activity_id").withColumns({"q4_to_q1": per(F.col("q4"), F.col("q1")), "second_half_ratio": per(F.col("q3") + F.col("q4"), F.col("q1") + F.col("q2"))})


def mart_power_curve(curve: DataFrame, config: Config = Config()) -> DataFrame:
    """The best of all rides and of recent ones for each duration; the earlier of equal bests."""
    recent = F.datediff(F.lit(config.as_of), "activity_date").between(0, config.curve_days)
    labelled = curve.withColumn("window_label", F.explode(F.when(recent, F.array(F.lit("all_time"), F.lit("recent_90d"))).otherwise(F.array(F.lit("all_time")))))
    out = top_one(labelled, ["duration_s", "window_label"], [F.desc("best_watts"), F.asc("activity_date"), F.asc("activity_id")])
    d = F.col("duration_s")
    second, minute, hour = config.time_units
    label = F.when(d < 60, F.concat(d.cast("string"), F.lit(second))).when(d < 3600, F.concat((d / 60).cast("int").cast("string"), F.lit(minute))).otherwise(F.concat((d / 3600).cast("int").cast("string"), F.lit(hour)))
    return out.withColumn("duration_label", label)


def mart_ftp_estimate(curve: DataFrame, ftp: DataFrame) -> DataFrame:
    """Threshold power by 95 % of 20 minutes, and by the critical-power line P = W'/t + CP through bests of 2 to 20 minutes, which needs three points."""
    x = 1.0 / F.col("duration_s")
    fit = curve.filter(F.col("duration_s").between(120, 1200)).groupBy("window_label").agg(
        F.count(F.lit(1)).alias("points"), F.regr_slope(F.col("best_watts"), x).alias("w_prime"), F.regr_intercept(F.col("best_watts"), x).alias("cp")).filter("points >= 3")
    twenty = curve.filter("duration_s = 1200").select("window_label", F.col("best_watts").alias("p20"), F.col("activity_date").alias("p20_date"), (F.col("best_watts") * 0.95).alias("by_20min"))
    out = twenty.join(fit, "window_label", "left").crossJoin(F.broadcast(ftp))
    return out.withColumns({"by_20min_diff": F.col("by_20min") - F.col("ftp"), "cp_diff": F.col("cp") - F.col("ftp"), "method_spread": F.abs(F.col("by_20min") - F.col("cp"))})


def mart_activity_feed(activities: DataFrame, power: DataFrame, notes: DataFrame, symptoms: DataFrame) -> DataFrame:
    """A row an activity with what each source knows of it. Pace comes from the mean speed, which leaves rests out."""
    felt = symptoms.filter("activity_id is not null").groupBy("activity_id").agg(F.count(F.lit(1)).alias("symptoms"))
    out = activities.join(power.select("activity_id", "np", "intensity", "tss"), "activity_id", "left").join(notes.select("activity_id", F.col("load").alias("service_load")), "activity_id", "left").join(felt, "activity_id", "left")
    return out.withColumns({
        "moving_min": F.round(F.col("moving_time") / 60, 0), "pace_s_per_km": F.when(F.col("sport") == "running", per(F.lit(1000.0), F.col("average_speed"))),
        "pace_s_per_100m": F.when(F.col("sport") == "swimming", per(F.lit(100.0), F.col("average_speed"))), "symptoms": F.coalesce("symptoms", F.lit(0)),
    })


def mart_fitness_daily(fitness: DataFrame) -> DataFrame:
    return fitness.select("fitness_date", "ctl", "atl", F.round(F.col("ctl") - F.col("atl"), 1).alias("form"), "ramp_rate", "load", "ride_eftp")


def mart_gear_usage(activities: DataFrame) -> DataFrame:
    """Bikes by their id: two of one label stay two."""
    return activities.filter("sport = 'cycling'").groupBy("gear_id", "gear_label").agg(
        F.count(F.lit(1)).alias("activities"), F.sum("distance_km").alias("distance_km"), F.sum("moving_h").alias("moving_h"), F.sum("elev_m").alias("elev_m"), F.avg("distance_km").alias("avg_km_per_ride"),
        F.count_if("is_indoor").alias("indoor"), (100.0 * F.count_if("is_indoor") / F.count(F.lit(1))).alias("indoor_pct"), F.min("activity_date").alias("first_used"), F.max("activity_date").alias("last_used"),
    )


def _totals() -> list[Column]:
    return [F.count(F.lit(1)).alias("activities"), F.sum("distance_km").alias("distance_km"), F.sum("moving_h").alias("moving_h"), F.sum("elev_m").alias("elev_m")]


def mart_sport_totals(activities: DataFrame) -> DataFrame:
    return activities.groupBy("sport").agg(*_totals(), F.avg("distance_km").alias("mean_km"), F.max("distance_km").alias("longest_km"), F.min("activity_date").alias("first_date"), F.max("activity_date").alias("last_date"))


def mart_yearly_summary(activities: DataFrame) -> DataFrame:
    return activities.groupBy("year", "sport").agg(*_totals(), F.count_if("is_indoor").alias("indoor"))


def mart_period_summary(activities: DataFrame) -> DataFrame:
    """Months, years and all time, from one scan."""
    out = period_totals(activities, "activity_date", "sport", _totals())
    return out.withColumns({"distance_km": F.round("distance_km", 1), "moving_h": F.round("moving_h", 1), "elev_m": F.round("elev_m", 0)})


def mart_service_metrics(notes: DataFrame) -> DataFrame:
    return notes.select("activity_id", "activity_date", *SERVICE_FIELDS, "implied_ftp")


def weighted_pace(df: DataFrame, keys: Sequence[str], seconds: str, metres: str, sound: Column) -> DataFrame:
    """Seconds a hundred metres over the sound rows, weighted by distance; NULL where there is none."""
    pace = 100.0 * F.sum(F.when(sound, F.col(seconds))) / F.nullif(F.sum(F.when(sound, F.col(metres))).cast("double"), F.lit(0.0))
    return df.groupBy(*keys).agg(pace.alias("pace"), F.count(F.lit(1)).alias("n"), F.count_if(sound).alias("sound"), F.sum(metres).alias("metres"))


def mart_swim_pace_monthly(activities: DataFrame) -> DataFrame:
    """Pace of swimming itself: swims whose time holds rests don't count, months of nothing else are NULL."""
    swims = activities.filter((F.col("sport") == "swimming") & (F.col("distance") > 0))
    out = weighted_pace(swims, ["month", "year"], "moving_time", "distance", ~F.col("rest_included"))
    return out.withColumnRenamed("metres", "distance_m").withColumnsRenamed({"pace": "pace_s_per_100m", "n": "swims", "sound": "paced_swims"}).withColumn("pace_label", minutes_seconds(F.col("pace_s_per_100m")))


def mart_training_status(activities: DataFrame, config: Config = Config()) -> DataFrame:
    """The last 28 days against the 28 before, for each of the three sports, whether there is anything or not."""
    scaffold = activities.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, ("cycling", "running", "swimming")))).alias("sport"))
    age = F.datediff(F.lit(config.as_of), "activity_date")
    n = config.recent_days
    recent, before = F.col("age").between(0, n - 1), F.col("age").between(n, 2 * n - 1)
    acts = activities.select("sport", "activity_date", "distance_km", "moving_h", age.alias("age"))
    of = lambda when, c: F.round(F.sum(F.when(when, F.col(c))), 1)  # noqa: E731  NULL where there is none
    return F.broadcast(scaffold).join(acts, "sport", "left").groupBy("sport").agg(
        F.lit(config.as_of).alias("today"), F.max("activity_date").alias("last_date"), F.min("age").alias("days_since"), of(recent, "distance_km").alias("recent_km"), of(before, "distance_km").alias("previous_km"),
        of(recent, "moving_h").alias("recent_h"), of(before, "moving_h").alias("previous_h"), F.count_if(recent).alias("recent_n"), F.count_if(before).alias("previous_n"), F.round(F.max(F.when(recent, F.col("distance_km"))), 1).alias("recent_longest_km"),
    )


#: What the symptom log calls areas and sides, by measure: area (a prefix where it ends in '-'), sides, and the value taken.
MEASURES = {
    "knee_medial_l": ("무릎내측", ("좌", "양"), "severity"),
    "knee_medial_l_next": ("무릎내측", ("좌", "양"), "next_day"),
    "saddle": ("안장", (), "severity"),
    "hand_numb": ("손저림", (), "severity"),
    "triceps_shoulder": ("삼두어깨", (), "severity"),
    "low_back": ("허리", (), "severity"),
    "cramp": ("경련-", (), "severity"),
}
#: Fixed value: the setup that all bikes share, as the log of changes calls it.
SHOES = "신발"


def mart_symptom_ride(activities: DataFrame, symptoms: DataFrame, changes: DataFrame, power: DataFrame, load: DataFrame, bike: Column, shared: str = SHOES, measures: Mapping[str, tuple] = MEASURES) -> DataFrame:
    """Rides since the first day of the symptom log, with load, symptoms by measure (not recorded stays NULL) and the setup of the day: the latest change
    of the bike or of what all bikes share."""
    since_first = F.broadcast(symptoms.agg(F.min("symptom_date").alias("_first")))
    rides = activities.filter("sport = 'cycling' and distance_km > 0").crossJoin(since_first).filter("activity_date >= _first").drop("_first").withColumn("bike", bike)
    # A row for each bike and day, not ride, and each target that it answers to; each finds the latest of the target's days of change.
    days = rides.select(F.col("bike").alias("_bike"), F.col("activity_date").alias("_date")).distinct().withColumn("target", F.explode(F.array(F.col("_bike"), F.lit(shared))))
    dates = changes.select("target", "effective_date").filter("target is not null and effective_date is not null").distinct()
    since = as_of(days, dates, ["target"], "_date", "effective_date", []).groupBy("_bike", "_date").agg(F.max("asof_effective_date").alias("setup_since"))

    def measure(area: str, sides: Sequence[str], value: str) -> Column:
        there = F.col("area").startswith(area) if area.endswith("-") else F.col("area") == area
        return F.max(F.when(there & F.col("side").isin(*sides) if sides else there, F.col(value)))

    felt = symptoms.filter("activity_id is not null").groupBy("activity_id").agg(
        F.count(F.lit(1)).alias("symptoms"), *[measure(*m).alias(name) for name, m in measures.items()],
        F.nullif(F.array_join(F.array_sort(F.collect_set("confounders")), " / "), F.lit("")).alias("confounders"),
    )
    out = rides.join(power.select("activity_id", "np", "intensity", "tss"), "activity_id", "left").join(load.drop("ftp_anchor"), "activity_id", "left").join(felt, "activity_id", "left")
    out = out.join(since, F.col("bike").eqNullSafe(F.col("_bike")) & (F.col("activity_date") == F.col("_date")), "left").drop("_bike", "_date")
    return out.withColumns({
        "moving_min": F.round(F.col("moving_time") / 60, 1), "grind_min": F.round(F.col("grind_s") / 60, 1),
        "grind_min_per_h": F.round(F.col("grind_s") / (F.nullif(F.col("moving_time"), F.lit(0)) / 3600) / 60, 1), "symptoms": F.coalesce("symptoms", F.lit(0)),
    })


def mart_fitting_epochs(rides: DataFrame, changes: DataFrame, bike: str, shared: str = SHOES, measure: str = "knee_medial_l") -> DataFrame:
    """Rides of one bike between setup changes of it or of what all bikes share; before the first change is the baseline, whose date stays NULL."""
    labels = changes.filter(F.col("target").isin(bike, shared)).groupBy("effective_date").agg(F.count(F.lit(1)).alias("n_changes"), F.array_join(F.array_sort(F.collect_list("change_label")), ", ").alias("changes"))
    m = F.col(measure)
    epochs = rides.filter(F.col("bike") == bike).groupBy(F.col("setup_since").alias("epoch_start")).agg(
        F.min("activity_date").alias("first_ride"), F.max("activity_date").alias("last_ride"), F.count(F.lit(1)).alias("rides"), F.round(F.sum("distance_km"), 1).alias("distance_km"),
        F.count(m).alias("knee_rides"), F.round(F.avg(m), 1).alias("knee_avg"), F.max(m).alias("knee_max"), F.count_if(m >= 4).alias("knee_ge4_rides"),
        F.round(F.avg("grind_min_per_h"), 1).alias("grind_min_per_h_avg"), F.round(F.avg("climb_cadence"), 1).alias("climb_cadence_avg"), F.round(F.avg("intensity"), 2).alias("if_avg"),
    )
    # Labels join epochs, not rides: a label is as long as its day has changes.
    out = epochs.join(labels, F.col("epoch_start") == F.col("effective_date"), "left")
    return out.select(F.coalesce(F.col("epoch_start").cast("string"), F.lit("baseline")).alias("epoch"), "epoch_start", "changes", "n_changes", *epochs.columns[1:])
