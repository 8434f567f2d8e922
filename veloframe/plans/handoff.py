"""The receiving side of the hand-off: contract checks, swim diaries, notes, queue decisions; and the swim catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veloframe.functions import strip_markup
from veloframe.plans.coach import BUNDLE_FIELDS
from veloframe.sources.collect import local_text

BUNDLE = "version int, activity struct<activity_id:long,sport:string,start_local:string,distance_km:double,moving_time:double,elapsed_time:double>, context array<struct<activity_id:long,sport:string,distance_km:double>>"


def violations(bundles: DataFrame, most_context: int = 200) -> DataFrame:
    """activity_id and the rules that its bundle breaks; none for a good one."""
    b = F.from_json("bundle", BUNDLE)
    keys = F.json_object_keys(F.get_json_object("bundle", "$.activity"))
    a = b["activity"]
    ids = F.transform(b["context"], lambda x: x["activity_id"])
    out_of = lambda c, lo, hi: F.coalesce(~c.between(lo, hi) | F.isnan(c), F.lit(False))
    rules: dict[str, Column] = {
        "not JSON": b.isNull(), "version": F.coalesce(b["version"] != 1, F.lit(True)), "id": F.coalesce(a["activity_id"] <= 0, F.lit(True)),
        "unknown field": F.coalesce(F.size(F.array_except(keys, F.array(*map(F.lit, BUNDLE_FIELDS)))) > 0, F.lit(False)),
        "distance": out_of(a["distance_km"], 0.0, 2000.0), "moving time": out_of(a["moving_time"], 0.0, 10 * 86_400.0), "elapsed time": out_of(a["elapsed_time"], 0.0, 10 * 86_400.0),
        "too much context": F.coalesce(F.size(b["context"]) > most_context, F.lit(False)), "repeated context": F.coalesce(F.size(F.array_distinct(ids)) < F.size(ids), F.lit(False)),
    }
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return bundles.select("activity_id", broken.alias("broken")).filter(F.size("broken") > 0)


def admitted(bundles: DataFrame, queued: DataFrame, since: str, date: str = "activity_date") -> DataFrame:
    """activity_id and status: before_cutover, already_<state> or queued."""
    known = queued.select("activity_id", "state")
    status = F.when(F.col(date) < F.lit(since).cast("date"), "before_cutover").when(F.col("state").isNotNull(), F.concat(F.lit("already_"), "state")).otherwise("queued")
    return bundles.join(known, "activity_id", "left").select("activity_id", status.alias("status"))


def next_job(queue: DataFrame, now: str) -> DataFrame:
    """The pending job that began first among those that are due; at most one row."""
    due = (F.col("state") == "pending") & F.coalesce(F.col("next_at") <= F.to_timestamp(F.lit(now)), F.lit(True))
    return queue.filter(due).orderBy("start_local", "activity_id").limit(1)


def accepted_review(review: DataFrame, current: DataFrame, most: int = 3) -> DataFrame:
    """A result counts only for the revision that it was made for; others wait again or fail at ``most`` tries."""
    j = review.join(current.select("activity_id", F.col("revision").alias("_now")), "activity_id")
    fits = F.col("revision") == F.col("_now")
    return j.withColumn("state", F.when(fits, "done").when(F.col("tries") >= most, "failed").otherwise("pending")).drop("_now")


def swim_catalog(feed: DataFrame) -> DataFrame:
    """activity_id, start_local (19 characters), distance, moving_time of swims with a wall time."""
    return feed.filter("sport = 'swimming'").select("activity_id", local_text(F.col("start_date_local")).alias("start_local"), "distance", "moving_time").filter("start_local is not null")


def catalog_violations(catalog: DataFrame, most: int = 10_000) -> DataFrame:
    """Rules that a catalog breaks: real dates, unique positive ids, finite values, at most ``most`` rows."""
    odd = F.try_to_timestamp(F.col("start_local"), F.lit("yyyy-MM-dd'T'HH:mm:ss")).isNull()
    rows = catalog.select(F.when(odd, "date").when(F.coalesce(F.col("activity_id") <= 0, F.lit(True)), "id").when(F.isnan("distance") | (F.col("distance") < 0), "distance").alias("rule")).filter("rule is not null").distinct()
    twice = catalog.groupBy("activity_id").count().filter("count > 1").select(F.lit("repeated id").alias("rule")).limit(1)
    many = catalog.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select(F.lit("too many").alias("rule"))
    return rows.union(twice).union(many)


def diary_posts(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with the text of a post, and the day, metres and seconds that it tells of (NULL if it doesn't)."""
    text = strip_markup(F.col(html))
    day = F.try_to_date(F.regexp_replace(F.regexp_extract(text, r"(\d{4}[-./]\d{1,2}[-./]\d{1,2})", 1), "[./]", "-"), "yyyy-M-d")
    metres = F.nullif(F.regexp_replace(F.regexp_extract(text, r"(\d[\d,]*) ?m\b", 1), ",", ""), F.lit("")).try_cast("double")
    clock = lambda i: F.regexp_extract(text, r"\b(?:(\d{1,2}):)?(\d{1,2}):(\d{2})\b", i).try_cast("double")
    seconds = F.when(clock(3).isNotNull(), 3600 * F.coalesce(clock(1), F.lit(0.0)) + 60 * clock(2) + clock(3))
    return pages.withColumns({"body": text, "day": day, "metres": metres, "seconds": seconds})


def linked_swims(posts: DataFrame, swims: DataFrame, id_: str, metres_off: float = 25.0, seconds_off: float = 120.0) -> DataFrame:
    """Posts with the one swim of their day that agrees in distance, and in time if both tell it; none if several do, or if several posts claim it.

    Posts and swims of equal figures meet once for all of them, by day and cell of distance (and its two neighbours); how many a post or swim has is a sum of counts, so pairs are
    never dealt out.
    """
    ours = posts.select(id_, F.col("day").alias("_day"), F.col("metres").cast("double").alias("_pm"), F.col("seconds").cast("double").alias("_ps")).filter(F.col("_day").isNotNull() & (F.abs("_pm") < float("inf")))
    other = swims.select(F.col("activity_id").alias("swim"), F.to_date("start_local").alias("_day"), F.col("distance").cast("double").alias("_m"), F.col("moving_time").cast("double").alias("_s")).filter(F.col("_day").isNotNull() & (F.abs("_m") < float("inf")))
    post, swim = ("_day", "_pm", "_ps"), ("_day", "_m", "_s")
    cell = lambda c: F.floor(F.greatest(F.least(F.col(c) / max(2 * metres_off, 1.0), F.lit(1e18)), F.lit(-1e18)))  # noqa: E731  two values that fit are at most one cell apart
    left = ours.groupBy(*post).agg(F.count(F.lit(1)).alias("_np")).withColumn("_cell", F.explode(F.array(*[cell("_pm") + i for i in (-1, 0, 1)])))
    right = other.groupBy(*swim).agg(F.count(F.lit(1)).alias("_nw")).withColumn("_cell", cell("_m"))
    fits = (F.abs(F.col("_pm") - F.col("_m")) <= metres_off) & F.coalesce(F.abs(F.col("_ps") - F.col("_s")) <= seconds_off, F.lit(True))
    pairs = left.join(right, ["_day", "_cell"]).filter(fits)
    by_post = pairs.groupBy(*post).agg(F.sum("_nw").alias("_n"), F.max(F.struct("_m", "_s")).alias("_to"))
    by_swim = pairs.groupBy(*swim).agg(F.sum("_np").alias("_n"))

    def alone(rows: DataFrame, figures: Sequence[str], counts: DataFrame, key: str, *keep: str) -> DataFrame:
        """Ids with one pair in all, with what is kept of its row."""
        renamed = counts.withColumnsRenamed({c: f"{c}_k" for c in figures})
        same = [F.col(c).eqNullSafe(F.col(f"{c}_k")) for c in figures]
        found = rows.join(renamed, same).groupBy(key).agg(F.sum("_n").alias("_n"), F.max(F.struct(*keep)).alias("_kept"))
        return found.filter("_n = 1").select(key, "_kept.*")

    mine = alone(ours, post, by_post, id_, "_day", "_to").select(id_, "_day", F.col("_to._m").alias("_m"), F.col("_to._s").alias("_s"))
    theirs = alone(other, swim, by_swim, "swim", *swim).select("swim", *[F.col(c).alias(f"{c}_k") for c in swim])
    return mine.join(theirs, [F.col(c).eqNullSafe(F.col(f"{c}_k")) for c in swim]).select(id_, "swim")


def new_notes(notes: DataFrame, links: DataFrame) -> DataFrame:
    """Notes whose swim has none yet and whose address no swim has; of several for one, the first by address."""
    fresh = notes.join(links.select("swim"), "swim", "left_anti").join(links.select("url"), "url", "left_anti")
    a, b = Window.partitionBy("swim").orderBy("url"), Window.partitionBy("url").orderBy("swim")
    return fresh.withColumns({"_a": F.row_number().over(a), "_b": F.row_number().over(b)}).filter("_a = 1 and _b = 1").drop("_a", "_b")


def pool_length(activities: DataFrame, overrides: DataFrame, stored: DataFrame) -> DataFrame:
    """Metres of the pool: what was set by hand, else what the source says, else NULL."""
    out = activities.join(overrides.select("activity_id", F.col("pool_m").alias("_o")), "activity_id", "left").join(stored.select("activity_id", F.col("pool_m").alias("_s")), "activity_id", "left")
    return out.withColumn("pool_m", F.coalesce("_o", "_s")).drop("_o", "_s")


def evidence_usable(stream: DataFrame, key: str, most_gap_s: float = 5.0) -> DataFrame:
    """key and whether its stream runs forward in time and distance with gaps of at most ``most_gap_s``."""
    w = Window.partitionBy(key).orderBy("point_idx")
    step = stream.select(key, (F.col("t") - F.lag("t").over(w)).alias("dt"), (F.col("distance") - F.lag("distance").over(w)).alias("dd"))
    return step.groupBy(key).agg((F.coalesce(F.bool_and(F.coalesce((F.col("dt") > 0) & (F.col("dt") <= most_gap_s) & (F.col("dd") >= 0), F.lit(True))), F.lit(False)) & (F.count("dt") > 0)).alias("usable"))


def notice(analysis: DataFrame, most: int = 1900) -> DataFrame:
    """The text of a message: kind, distance in its sport's unit, and the analysis, cut to ``most`` characters."""
    size = F.when(F.col("sport") == "swimming", F.format_string("%d m", F.round(F.col("distance_km") * 1000).cast("long"))).otherwise(F.format_string("%.1f km", F.col("distance_km")))
    return analysis.select("activity_id", F.substring(F.concat_ws("\n", F.concat_ws(" · ", "sport", size), "text"), 1, most).alias("message"))


def stacked(catalog: DataFrame, legacy: DataFrame, keys: Sequence[str] = ("activity_id",)) -> DataFrame:
    """The catalog, and of older rows those that it lacks."""
    return catalog.unionByName(legacy.join(catalog.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def migrated(analyses: DataFrame, legacy: DataFrame) -> DataFrame:
    """The analyses, and of the older ones those that they lack, as swims (the only sport that was analysed then)."""
    older = legacy.withColumn("sport", F.lit("swimming")).join(analyses.select("activity_id"), "activity_id", "left_anti")
    return analyses.unionByName(older, allowMissingColumns=True)


def migration_faults(legacy: DataFrame, analyses: DataFrame) -> DataFrame:
    """activity_id and fault: older analyses that are missing, or whose text or owner is another now. None means that the migration is whole."""
    now = analyses.select("activity_id", F.col("analysis").alias("_text"), F.col("athlete_id").alias("_owner"), F.lit(True).alias("_there"))
    fault = F.when(F.col("_there").isNull(), "missing").when(~F.col("analysis").eqNullSafe(F.col("_text")), "text").when(~F.col("athlete_id").eqNullSafe(F.col("_owner")), "owner")
    return legacy.join(now, "activity_id", "left").select("activity_id", fault.alias("fault")).filter("fault is not null")


def preview(files: DataFrame, run: str | None = None) -> DataFrame:
    """``files`` (file, bundle) as the receiver would take them: file, activity_id, sport, status and fault (NULL: none). Nothing is sent and no model is called.

    A file bears its activity's number, its bundle keeps the contract and belongs to the ``run``; an activity that comes twice is queued once.
    """
    b = F.from_json("bundle", BUNDLE)
    own = files.select("file", "bundle", b["activity"]["activity_id"].alias("activity_id"), b["activity"]["sport"].alias("sport"), F.get_json_object("bundle", "$.run").alias("_run"))
    named = F.regexp_extract("file", r"(?:^|/)([0-9]+)\.json$", 1).try_cast("long")
    broken = violations(own.select(F.col("file").alias("activity_id"), "bundle")).select(F.col("activity_id").alias("file"), F.element_at("broken", 1).alias("_rule"))
    other = F.lit(False) if run is None else ~F.col("_run").eqNullSafe(F.lit(run))
    first = F.row_number().over(Window.partitionBy("activity_id").orderBy("file")) == 1
    out = own.join(broken.distinct(), "file", "left")
    fault = F.coalesce("_rule", F.when(~named.eqNullSafe(F.col("activity_id")), "file name"), F.when(other, "another run"))
    status = F.when(F.col("fault").isNull(), F.when(first, "queued").otherwise("already_queued"))
    return out.withColumn("fault", fault).withColumn("status", status).select("file", "activity_id", "sport", "status", "fault")
