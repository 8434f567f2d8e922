"""Evidence for a coach: weekly volumes, comparable sessions, stream halves, swim splits, laps from a stream, compact bundles."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veloframe.operators.series import halves


def weekly_volumes(df: DataFrame, cutoff: str, classes: Sequence[str], weeks: int = 4) -> DataFrame:
    """week (1: the last seven days), class, n and total of ``df`` (day, class, x); weeks without any are zero."""
    spark = df.sparkSession
    scaffold = spark.range(1, weeks + 1).withColumnRenamed("id", "week").withColumn("class", F.explode(F.array(*map(F.lit, classes))))
    age = F.datediff(F.lit(cutoff).cast("date"), "day")
    sums = df.filter((age >= 0) & (age < 7 * weeks)).groupBy((F.floor(age / 7) + 1).cast("long").alias("week"), "class").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("total"))
    return scaffold.join(sums, ["week", "class"], "left").select("week", "class", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("total", F.lit(0.0)).alias("total"))


def comparables(targets: DataFrame, sessions: DataFrame, keys: Sequence[str], id_: str, size: str, ratio: float, most: int) -> DataFrame:
    """For each target the latest ``most`` earlier sessions of its keys whose sizes are within ``ratio``; id, other and ratio."""
    other = sessions.select(*keys, F.col(id_).alias("other"), F.col(size).alias("_s"))
    share = F.least(F.col(size), F.col("_s")) / F.greatest(F.col(size), F.col("_s"))
    found = targets.join(other, list(keys)).filter(F.col("other") < F.col(id_)).withColumn("ratio", share).filter(F.col("ratio") >= ratio)
    rn = F.row_number().over(Window.partitionBy(id_).orderBy(F.desc("other")))
    return found.withColumn("_rn", rn).filter(F.col("_rn") <= most).select(*keys, id_, "other", "ratio")


def stream_halves(points: DataFrame, values: Sequence[str], gap_s: float = 5.0) -> DataFrame:
    """Half means of each channel; a channel with no values is NULL."""
    out = None
    for v in values:
        one = halves(points.withColumn("t", F.col("time_offset_s").cast("double")), ["activity_id"], "t", v, gap_s).withColumnsRenamed({"first_half": f"{v}_first", "second_half": f"{v}_second"})
        out = one if out is None else out.join(one, "activity_id")
    return out


def laps_from_stream(stream: DataFrame, key: str, rest_s: float = 10.0, still_m: float = 0.5) -> DataFrame:
    """Laps of ``stream`` (key, t, distance): standing still (under ``still_m``) for ``rest_s`` is a rest; its metres belong to the lap before.

    The state runs along each key's rows, so it is a fold over one key at a time; a key is one activity.
    """

    def laps(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=["t", "distance"]).sort_values(["t", "distance"], kind="stable")
        out, start, still = [], 0, 0
        t, d = pdf["t"].to_numpy(), pdf["distance"].to_numpy()
        name = pdf[key].iloc[0] if len(pdf) else None
        i = 1
        while i < len(t):
            if d[i] - d[still] >= still_m:
                still = i
            elif t[i] - t[still] >= rest_s:
                end = i
                while end + 1 < len(t) and d[end + 1] - d[still] < still_m:
                    end += 1
                if still > start:
                    out.append((name, "swim", t[start], t[still], d[still] - d[start]))
                out.append((name, "rest", t[still], t[end], d[end] - d[still]))
                start = still = i = end
            i += 1
        if len(t) and start < len(t) - 1:
            out.append((name, "swim", t[start], t[-1], d[-1] - d[start]))
        return pd.DataFrame(out, columns=[key, "kind", "start", "stop", "metres"])

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandas(laps, f"{key} {kind}, kind string, start double, stop double, metres double")


def swim_splits(stream: DataFrame, key: str, every_m: float = 100.0, still_ms: float = 0.3) -> DataFrame:
    """Moving seconds of each full ``every_m``: time is shared out over the boundaries that an interval crosses; intervals slower than ``still_ms`` are rests."""
    w = Window.partitionBy(key).orderBy("t")
    df = stream.withColumns({"_d": F.lead("distance").over(w) - F.col("distance"), "_s": F.lead("t").over(w) - F.col("t")}).filter("_s > 0 and _d >= 0")
    df = df.withColumn("_s", F.when(F.col("_d") / F.col("_s") >= still_ms, F.col("_s")).otherwise(0.0))
    first, last = F.floor(F.col("distance") / every_m), F.floor((F.col("distance") + F.col("_d")) / every_m)
    cells = df.withColumn("split", F.explode(F.sequence(first, last)))
    lo, hi = F.greatest(F.col("distance"), F.col("split") * every_m), F.least(F.col("distance") + F.col("_d"), (F.col("split") + 1) * every_m)
    share = F.when(F.col("_d") > 0, (hi - lo) / F.col("_d")).otherwise(1.0)
    out = cells.groupBy(key, "split").agg(F.sum(F.col("_s") * share).alias("seconds"), F.sum(F.greatest(hi - lo, F.lit(0.0))).alias("metres"))
    return out.filter(F.col("metres") >= every_m - 1e-6).drop("metres")


def split_stats(splits: DataFrame, key: str) -> DataFrame:
    """Mean, population spread and fade (second half of the splits against the first) of split times."""
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    half = F.when(F.col("split") < F.floor(F.col("_n") / 2), "a").when(F.col("split") >= F.ceil(F.col("_n") / 2), "b")
    df = splits.withColumn("_n", n).withColumn("_h", half)
    mean = lambda h: F.avg(F.when(F.col("_h") == h, F.col("seconds")))
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("splits"), F.avg("seconds").alias("mean"), F.stddev_pop("seconds").alias("spread"), (100 * F.stddev_pop("seconds") / F.nullif(F.avg("seconds"), F.lit(0.0))).alias("cv_pct"),
        F.min("seconds").alias("best"), F.max("seconds").alias("worst"), (100 * (mean("b") / F.nullif(mean("a"), F.lit(0.0)) - 1)).alias("fade_pct"),
    )


#: What a bundle may hold; no coordinate is among them.
BUNDLE_FIELDS = ("activity_id", "sport", "type", "name", "start_local", "distance_km", "moving_time", "elapsed_time", "is_indoor", "average_speed", "average_heartrate", "np", "intensity", "tss")


def export_rows(feed: DataFrame, silver: DataFrame, bronze: DataFrame, power: DataFrame, ftp_log: DataFrame, durability: DataFrame, since: str, sports: Sequence[str] = ("cycling", "running", "swimming")) -> DataFrame:
    """What bundles are made from: activities of ``sports`` from ``since`` on that are no duplicates, with device and raw text, the threshold's date (NULL without power) and whether power dropped out."""
    own = silver.filter(~F.col("is_duplicate")).select("activity_id", "elapsed_time", "max_speed", "max_heartrate", "device_name", "device_watts")
    dated = ftp_log.filter("is_current").groupBy(F.col("ftp_watts").cast("double").alias("ftp")).agg(F.max("effective_date").alias("ftp_date"))
    rows = feed.filter(F.col("sport").isin(*sports) & (F.col("activity_date") >= F.lit(since).cast("date")))
    joined = rows.join(own, "activity_id").join(bronze.select("activity_id", "_raw"), "activity_id")
    joined = joined.join(power.select("activity_id", "ftp"), "activity_id", "left").join(dated, "ftp", "left")
    return joined.join(durability.select("activity_id", F.col("dropout").alias("power_dropout")), "activity_id", "left")


def bundles(targets: DataFrame, history: DataFrame, since: str, days: int = 28, most: int = 200, run: str | None = None) -> DataFrame:
    """activity_id and bundle (JSON) of each activity from ``since`` on: its allowed fields, and the activities of the strict ``days`` before, newest first; and the run's name."""
    fields = [c for c in BUNDLE_FIELDS if c in targets.columns]
    prior = history.select(F.col("activity_id").alias("_id"), F.col("activity_date").alias("_day"), F.struct(*[c for c in fields if c in history.columns]).alias("_row"))
    new = targets.filter(F.col("activity_date") >= F.lit(since).cast("date"))
    age = F.datediff("activity_date", "_day")
    # A day of history is an equality, so this is a hash join on the day and not a range join.
    spread = new.select("activity_id", "activity_date", F.explode(F.transform(F.sequence(F.lit(1), F.lit(days)), lambda k: F.date_sub("activity_date", k))).alias("_day"))
    found = spread.join(prior, "_day").withColumn("_age", age)
    context = found.groupBy("activity_id").agg(F.slice(F.transform(F.sort_array(F.collect_list(F.struct("_day", "_id", "_row")), asc=False), lambda x: x["_row"]), 1, most).alias("context"))
    named = [F.lit(run).alias("run")] if run else []
    body = F.to_json(F.struct(F.lit(1).alias("version"), *named, F.struct(*fields).alias("activity"), F.coalesce("context", F.array().cast(context.schema["context"].dataType)).alias("context")))
    return new.join(context, "activity_id", "left").select("activity_id", body.alias("bundle"))


def next_state(state: DataFrame, now: str, most: int = 5) -> DataFrame:
    """A job table after a failed try: waits of min(60, 2^tries) minutes, and failed for good at ``most`` tries."""
    tries = F.col("tries") + 1
    wait = F.least(F.lit(60.0), F.pow(F.lit(2.0), tries))
    return state.withColumns({"tries": tries, "state": F.when(tries >= most, "failed").otherwise("pending"), "next_at": F.when(tries < most, F.to_timestamp(F.lit(now)) + F.make_dt_interval(mins=wait.cast("int")))})


def recovered(state: DataFrame) -> DataFrame:
    """After a crash: work that was under way waits again; a delivery that was under way is unknown and never sent again by itself."""
    return state.withColumn("state", F.when(F.col("state") == "analyzing", "pending").when(F.col("state") == "sending", "unknown").otherwise(F.col("state")))


def alerts_due(jobs: DataFrame, alerts: DataFrame) -> DataFrame:
    """Jobs that had a failed try and of which nobody was told yet: one alert a job, however often it fails."""
    return jobs.filter("tries > 0 and state <> 'done'").select("activity_id").distinct().join(alerts.select("activity_id"), "activity_id", "left_anti")


def opened(analyses: DataFrame, notify: bool = True) -> DataFrame:
    """Deliveries of new analyses: pending, or suppressed for good."""
    return analyses.select("activity_id", F.lit("pending" if notify else "suppressed").alias("state"), F.lit(None).cast("string").alias("error"))


def next_delivery(deliveries: DataFrame, analyses: DataFrame) -> DataFrame:
    """The pending delivery of the earliest activity; at most one row."""
    due = deliveries.filter("state = 'pending'").select("activity_id")
    return analyses.join(due, "activity_id", "left_semi").orderBy("activity_date", "activity_id").limit(1)


def sending(deliveries: DataFrame, chosen: DataFrame) -> DataFrame:
    """Deliveries with ``chosen`` (activity_id) under way; only what is pending can be."""
    mark = chosen.select("activity_id").distinct().withColumn("_chosen", F.lit(True))
    return deliveries.join(mark, "activity_id", "left").withColumn("state", F.when(F.col("_chosen") & (F.col("state") == "pending"), "sending").otherwise(F.col("state"))).drop("_chosen")


def delivered(deliveries: DataFrame, replies: DataFrame) -> DataFrame:
    """Deliveries under way, after their replies (activity_id, status): sent; failed where the receiver said no; unknown where it may have taken the message (a server's error, a redirect, no reply)."""
    code = F.col("_code")
    state = F.when(code.between(200, 299), "sent").when(code.between(400, 499), "failed").otherwise("unknown")
    out = deliveries.join(replies.select("activity_id", F.col("status").alias("_code"), F.lit(True).alias("_reply")), "activity_id", "left")
    now = F.col("_reply") & (F.col("state") == "sending")
    return out.withColumns({"state": F.when(now, state).otherwise(F.col("state")), "error": F.when(now, F.when(state != "sent", F.concat(F.lit("status "), F.coalesce(code.cast("string"), F.lit("unknown"))))).otherwise(F.col("error"))}).drop("_code", "_reply")


def sent_again(deliveries: DataFrame, asked: DataFrame) -> DataFrame:
    """Failed and unknown deliveries wait again where a person asked for it (activity_id); nothing else sends them again."""
    mark = asked.select("activity_id").distinct().withColumn("_asked", F.lit(True))
    again = F.coalesce("_asked", F.lit(False)) & F.col("state").isin("unknown", "failed")
    return deliveries.join(mark, "activity_id", "left").withColumns({"state": F.when(again, "pending").otherwise(F.col("state")), "error": F.when(~again, F.col("error"))}).drop("_asked")


def state_counts(jobs: DataFrame, states: Sequence[str]) -> DataFrame:
    """state, n and latest (``changed_at``) for every one of ``states``, 0 and NULL where no job is in it."""
    every = jobs.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, states))).alias("state"))
    return F.broadcast(every).join(jobs.select("state", "changed_at"), "state", "left").groupBy("state").agg(F.count("changed_at").alias("n"), F.max("changed_at").alias("latest"))
