"""Every query by name, with DuckDB SQL. Each binds generic operators to the supplied tables.

Counts are bigint and doubles are rounded to six digits on both sides; every order is total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veloframe.functions import blank_to_null, haversine_m, label_from, minutes_seconds, one_of, per, strip_markup
from veloframe.operators import series

QUERIES: dict = {}
ORACLE_SQL: dict = {}
DAY = 86_400


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def r6(c, name: str):
    return F.round(c, 6).alias(name)


@query("""
SELECT user_id, round(pow(avg(pow(p, 4)), 0.25), 6) AS np, round(avg(value), 6) AS mean_value, max(value) AS most, count(*)::BIGINT AS n
FROM (SELECT user_id, value, avg(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW) AS p FROM events)
GROUP BY user_id""")
def rolling_l4_power(spark, d):
    out = series.normalised_power(table(spark, d, "events"), "user_id", "ts", "value", 3 * DAY)
    return out.select("user_id", r6(F.col("np"), "np"), r6(F.col("mean"), "mean_value"), "most", F.col("n").cast("long"))


_WINDOWS = [(DAY, 3), (3 * DAY, 9), (7 * DAY, 20)]
_BEST_SQL = """
w AS (SELECT user_id,
  CASE WHEN count(value) OVER a >= 3 THEN avg(value) OVER a END AS w1, CASE WHEN count(value) OVER b >= 9 THEN avg(value) OVER b END AS w2,
  CASE WHEN count(value) OVER c >= 20 THEN avg(value) OVER c END AS w3 FROM events
  WINDOW a AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 86400 SECOND PRECEDING AND CURRENT ROW),
         b AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 259200 SECOND PRECEDING AND CURRENT ROW),
         c AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 604800 SECOND PRECEDING AND CURRENT ROW)),
best AS (SELECT user_id, 86400::BIGINT AS seconds, max(w1) AS best FROM w GROUP BY 1 UNION ALL SELECT user_id, 259200, max(w2) FROM w GROUP BY 1
  UNION ALL SELECT user_id, 604800, max(w3) FROM w GROUP BY 1)"""


@query(f"WITH {_BEST_SQL} SELECT user_id, seconds, round(best, 6) AS best FROM best WHERE best IS NOT NULL")
def best_mean_by_window(spark, d):
    out = series.best_means(table(spark, d, "events").select("user_id", "ts", "value"), "user_id", "ts", "value", _WINDOWS)
    return out.select("user_id", F.col("seconds").cast("long"), r6(F.col("best"), "best"))


@query(f"""
WITH {_BEST_SQL}, r AS (SELECT user_id, seconds, round(best, 6) AS best FROM best WHERE best IS NOT NULL),
l AS (SELECT 'all' AS label, * FROM r UNION ALL SELECT 'even' AS label, * FROM r WHERE user_id % 2 = 0)
SELECT label, seconds, user_id, best FROM (SELECT *, row_number() OVER (PARTITION BY label, seconds ORDER BY best DESC, user_id) AS rn FROM l) WHERE rn = 1""")
def best_mean_top1(spark, d):
    best = best_mean_by_window(spark, d)
    # Both labels come from one pass over the best means.
    labelled = best.withColumn("label", F.explode(F.when(F.col("user_id") % 2 == 0, F.array(F.lit("all"), F.lit("even"))).otherwise(F.array(F.lit("all")))))
    return series.top_one(labelled, ["label", "seconds"], [F.desc("best"), F.asc("user_id")]).select("label", "seconds", "user_id", "best")


@query("""
WITH a AS (SELECT round(avg(value), 2) AS anchor FROM events),
z AS (SELECT user_id, CASE WHEN value < 0.56 * anchor THEN 1 WHEN value < 0.76 * anchor THEN 2 WHEN value < 0.91 * anchor THEN 3 WHEN value < 1.06 * anchor THEN 4
  WHEN value < 1.21 * anchor THEN 5 WHEN value < 1.51 * anchor THEN 6 ELSE 7 END AS zone FROM events CROSS JOIN a),
c AS (SELECT user_id, zone, count(*) AS n FROM z GROUP BY 1, 2)
SELECT user_id, zone::BIGINT AS zone, n::BIGINT AS n, round(100.0 * n / sum(n) OVER (PARTITION BY user_id), 6) AS pct FROM c""")
def zone_distribution(spark, d):
    from veloframe.config import Config

    events = table(spark, d, "events").select("user_id", "value")
    anchor = events.agg(F.round(F.avg("value"), 2).alias("anchor"))
    named = events.crossJoin(F.broadcast(anchor))
    zone = series.zones(F.col("value"), [b * F.col("anchor") for b in Config().zones]).cast("long")
    counts = named.groupBy("user_id", zone.alias("zone")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.round(F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy("user_id")), 6))


@query("""
WITH q AS (SELECT user_id, ts, value, ntile(4) OVER (PARTITION BY user_id ORDER BY ts) AS q FROM events),
s AS (SELECT *, avg(value) OVER (PARTITION BY user_id, q ORDER BY ts RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW) AS p FROM q),
g AS (SELECT user_id, q, pow(avg(pow(p, 4)), 0.25) AS np, avg(CASE WHEN value > 20 THEN 1.0 ELSE 0.0 END) AS share FROM s GROUP BY 1, 2),
w AS (SELECT user_id, max(CASE WHEN q = 1 AND share >= 0.5 THEN np END) AS q1, max(CASE WHEN q = 2 AND share >= 0.5 THEN np END) AS q2, max(CASE WHEN q = 3 AND share >= 0.5 THEN np END) AS q3,
  max(CASE WHEN q = 4 AND share >= 0.5 THEN np END) AS q4, bool_or(share < 0.5) AS dropout FROM g GROUP BY 1)
SELECT user_id, round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3, round(q4, 6) AS q4, dropout, round(q4 / q1, 6) AS ratio FROM w""")
def quarter_durability(spark, d):
    from veloframe.plans.gold import quarters

    out = quarters(table(spark, d, "events"), "user_id", "ts", "value", 3 * DAY, active=20.0, least_share=0.5)
    return out.select("user_id", *[r6(F.col(f"q{i}"), f"q{i}") for i in range(1, 5)], "dropout", r6(F.col("q4") / F.col("q1"), "ratio"))


@query("""
WITH e AS (SELECT event_id, user_id, event_type, ts, ts + INTERVAL 6 HOUR AS ends, value FROM events WHERE value > 1),
p AS (SELECT *, max(ends) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM e),
g AS (SELECT *, sum(CASE WHEN before IS NOT NULL AND ts < before THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM p),
r AS (SELECT *, count(*) OVER (PARTITION BY user_id, event_type, grp) AS group_size, row_number() OVER (PARTITION BY user_id, event_type, grp ORDER BY value DESC, event_id) AS rn,
  first_value(event_id) OVER (PARTITION BY user_id, event_type, grp ORDER BY value DESC, event_id) AS winner FROM g)
SELECT event_id, group_size::BIGINT AS group_size, rn > 1 AS is_duplicate, CASE WHEN rn > 1 THEN winner END AS duplicate_of FROM r
UNION ALL SELECT event_id, 1, false, NULL FROM events WHERE NOT value > 1""")
def overlap_sessionize(spark, d):
    events = table(spark, d, "events").withColumn("ends", F.expr("ts + interval 6 hours"))
    out = series.sessions(events, ["user_id", "event_type"], "ts", "ends", [F.desc("value")], "event_id", scope=F.col("value") > 1)
    inside = F.col("value") > 1
    return out.select("event_id", F.when(inside, F.col("group_size")).otherwise(1).cast("long").alias("group_size"), F.when(inside, F.col("is_duplicate")).otherwise(False).alias("is_duplicate"), "duplicate_of")


@query("""SELECT o_orderpriority AS class, count(*)::BIGINT AS n, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 6) AS mean, min(o_totalprice) AS least, max(o_totalprice) AS most,
min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day FROM orders GROUP BY 1""")
def totals_by_class(spark, d):
    return table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("class")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), r6(F.avg("o_totalprice"), "mean"), F.min("o_totalprice").alias("least"), F.max("o_totalprice").alias("most"),
        F.min("o_orderdate").cast("date").alias("first_day"), F.max("o_orderdate").cast("date").alias("last_day"),
    )


@query("""SELECT year(o_orderdate)::BIGINT AS year, o_orderpriority AS class, count(*)::BIGINT AS n, count_if(o_orderstatus = 'F')::BIGINT AS finished, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2""")
def yearly_summary(spark, d):
    return table(spark, d, "orders").groupBy(F.year("o_orderdate").cast("long").alias("year"), F.col("o_orderpriority").alias("class")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""
SELECT 'month' AS period_type, strftime(o_orderdate, '%Y-%m') AS period, o_orderstatus AS class, count(*)::BIGINT AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 2, 3
UNION ALL SELECT 'year', strftime(o_orderdate, '%Y'), o_orderstatus, count(*), round(sum(o_totalprice), 2) FROM orders GROUP BY 2, 3
UNION ALL SELECT 'all', 'all', o_orderstatus, count(*), round(sum(o_totalprice), 2) FROM orders GROUP BY 3""")
def period_grouping_sets(spark, d):
    out = series.period_totals(table(spark, d, "orders"), "o_orderdate", "o_orderstatus", [F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")])
    return out.select("period_type", "period", F.col("o_orderstatus").alias("class"), "n", "total")


@query("""SELECT c_mktsegment AS label, count(*)::BIGINT AS n, count_if(o_orderstatus = 'F')::BIGINT AS finished, round(100.0 * count_if(o_orderstatus = 'F') / count(*), 6) AS finished_pct, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def gear_usage(spark, d):
    joined = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    done = F.count_if(F.col("o_orderstatus") == "F")
    return joined.groupBy(F.col("c_mktsegment").alias("label")).agg(F.count(F.lit(1)).alias("n"), done.alias("finished"), r6(F.lit(100.0) * done / F.count(F.lit(1)), "finished_pct"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""
WITH s AS (SELECT unnest(['F', 'O', 'P', 'X']) AS class), o AS (SELECT *, date_diff('day', o_orderdate::DATE, DATE '2001-08-01') AS age FROM orders)
SELECT s.class, count(CASE WHEN age BETWEEN 0 AND 27 THEN 1 END)::BIGINT AS recent, count(CASE WHEN age BETWEEN 28 AND 55 THEN 1 END)::BIGINT AS previous,
round(coalesce(sum(CASE WHEN age BETWEEN 0 AND 27 THEN o_totalprice END), 0), 2) AS recent_total, min(age)::BIGINT AS days_since
FROM s LEFT JOIN o ON o_orderstatus = s.class GROUP BY 1""")
def recent_vs_previous(spark, d):
    classes = spark.range(1).select(F.explode(F.array(*map(F.lit, "FOPX"))).alias("class"))
    orders = table(spark, d, "orders").select("o_orderstatus", "o_totalprice", F.datediff(F.lit("2001-08-01").cast("date"), F.col("o_orderdate").cast("date")).alias("age"))
    recent, previous = F.col("age").between(0, 27), F.col("age").between(28, 55)
    return F.broadcast(classes).join(orders, F.col("class") == F.col("o_orderstatus"), "left").groupBy("class").agg(
        F.count_if(recent).alias("recent"), F.count_if(previous).alias("previous"), F.round(F.coalesce(F.sum(F.when(recent, F.col("o_totalprice"))), F.lit(0.0)), 2).alias("recent_total"), F.min("age").cast("long").alias("days_since"))


@query("""
WITH p AS (SELECT user_id, value AS y, 1.0 / (1 + event_id % 97) AS x FROM events)
SELECT user_id, regr_count(y, x)::BIGINT AS n, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept FROM p GROUP BY 1 HAVING regr_count(y, x) >= 3 AND regr_slope(y, x) IS NOT NULL""")
def linear_fit(spark, d):
    points = table(spark, d, "events").select("user_id", F.col("value").alias("y"), (F.lit(1.0) / (1 + F.col("event_id") % 97)).alias("x"))
    return series.linear_fit(points, ["user_id"], "x", "y").select("user_id", F.col("n").cast("long"), r6(F.col("slope"), "slope"), r6(F.col("intercept"), "intercept"))


@query("""
SELECT p.event_id, (SELECT max(s.ts) FROM events s WHERE s.event_type = 'signup' AND s.user_id = p.user_id AND s.ts <= p.ts) AS asof_ts
FROM events p WHERE p.event_type = 'purchase'""")
def asof_latest(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    left, right = events.filter("event_type = 'purchase'"), events.filter("event_type = 'signup'").select("user_id", "ts")
    return series.as_of(left, right, ["user_id"], "ts", "ts", []).select("event_id", "asof_ts")


@query("""
SELECT user_id, event_id, 'first' AS source FROM events WHERE event_type = 'purchase' AND value > 100
UNION ALL SELECT user_id, event_id, 'second' FROM events e WHERE event_type = 'view' AND NOT EXISTS (SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.value > 100 AND p.user_id = e.user_id)""")
def anti_join_precedence(spark, d):
    from veloframe.plans.silver import prefer

    events = table(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    first = events.filter("event_type = 'purchase' and value > 100").select("user_id", "event_id", F.lit("first").alias("source"))
    second = events.filter("event_type = 'view'").select("user_id", "event_id", F.lit("second").alias("source"))
    return prefer(first, second, ["user_id"])


@query("""
WITH a AS (SELECT user_id, ts::DATE AS day, round(sum(value), 6) AS spent FROM events WHERE event_type = 'purchase' GROUP BY 1, 2), b AS (SELECT user_id, ts::DATE AS day, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY 1, 2)
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.day, b.day) AS day, spent, errors::BIGINT AS errors, CASE WHEN a.day IS NULL THEN 'right' WHEN b.day IS NULL THEN 'left' ELSE 'both' END AS side
FROM a FULL JOIN b ON a.user_id = b.user_id AND a.day = b.day""")
def full_outer_reconcile(spark, d):
    events = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    of = lambda kind: events.filter(F.col("event_type") == kind).groupBy("user_id", "day")
    a, b = of("purchase").agg(r6(F.sum("value"), "spent")), of("error").agg(F.count(F.lit(1)).alias("errors"))
    side = F.when(F.col("spent").isNull(), "right").when(F.col("errors").isNull(), "left").otherwise("both")
    return a.join(b, ["user_id", "day"], "outer").select("user_id", "day", "spent", "errors", side.alias("side"))


@query("""
WITH d AS (SELECT event_type, ts::DATE AS day, sum(value) AS total FROM events GROUP BY 1, 2)
SELECT event_type, day, round(total, 6) AS total, round(avg(total) OVER (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 6) AS trailing FROM d""")
def trailing_7d(spark, d):
    days = table(spark, d, "events").groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.sum("value").alias("total"))
    mean = F.expr("avg(total) over (partition by event_type order by day range between interval 6 days preceding and current row)")
    return days.select("event_type", "day", r6(F.col("total"), "total"), r6(mean, "trailing"))


@query("""SELECT user_id, round(sum(CASE WHEN event_type = 'view' THEN value END), 6) AS view_sum, round(avg(CASE WHEN event_type = 'click' THEN value END), 6) AS click_mean,
max(CASE WHEN event_type = 'error' THEN value END) AS error_most, count(DISTINCT event_type)::BIGINT AS kinds FROM events GROUP BY 1""")
def conditional_aggs(spark, d):
    of = lambda kind: F.when(F.col("event_type") == kind, F.col("value"))
    return table(spark, d, "events").groupBy("user_id").agg(r6(F.sum(of("view")), "view_sum"), r6(F.avg(of("click")), "click_mean"), F.max(of("error")).alias("error_most"), F.count_distinct("event_type").alias("kinds"))


@query("SELECT user_id, bool_or(value > 300) AS any_high, bool_and(value > 0.05) AS all_positive FROM events GROUP BY 1")
def bool_or_flags(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.bool_or(F.col("value") > 300).alias("any_high"), F.bool_and(F.col("value") > 0.05).alias("all_positive"))


@query("""
WITH d AS (SELECT event_type, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2), l AS (SELECT *, lag(n) OVER (PARTITION BY event_type ORDER BY day) AS before FROM d)
SELECT event_type, day, n::BIGINT AS n, before::BIGINT AS before FROM l WHERE n < 0.8 * before""")
def lag_regression_check(spark, d):
    from veloframe.plans.quality import volume_drops

    days = table(spark, d, "events").groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return volume_drops(days, "event_type", "day", "n", 0.2)


@query("SELECT event_type, (json_extract_string(props, '$.k')::BIGINT // 10)::BIGINT AS bucket, count(*)::BIGINT AS n FROM events GROUP BY 1, 2")
def json_props(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, d, "events").groupBy("event_type", F.floor(k / 10).cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(r"""SELECT doc_id, nullif(regexp_extract(text, '([0-9]{1,3})\.([0-9]{1,3})\.', 2), '') AS part, nullif(regexp_extract(text, 'Version ([0-9.]+)', 1), '') AS version, text LIKE '%License%' AS named FROM documents""")
def text_regex_extract(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    pick = lambda p, i: F.nullif(F.regexp_extract("text", p, i), F.lit(""))
    return docs.select("doc_id", pick(r"([0-9]{1,3})\.([0-9]{1,3})\.", 2).alias("part"), pick(r"Version ([0-9.]+)", 1).alias("version"), F.col("text").like("%License%").alias("named"))


@query("""SELECT (i - 1)::BIGINT AS place, count(*)::BIGINT AS n, round(avg(embedding[i]::DOUBLE), 6) AS mean, round(max(embedding[i]::DOUBLE), 6) AS most
FROM embeddings, range(1, 65) t(i) GROUP BY i""")
def array_transpose(spark, d):
    cells = table(spark, d, "embeddings").select(F.posexplode("embedding").alias("place", "x"))
    x = F.col("x").cast("double")
    return cells.groupBy(F.col("place").cast("long").alias("place")).agg(F.count(F.lit(1)).alias("n"), r6(F.avg(x), "mean"), r6(F.max(x), "most"))


@query(r"""SELECT page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<p[ >]'))::BIGINT AS paragraphs FROM pages""")
def raw_html_extract(spark, d):
    return table(spark, d, "pages").select(
        "page_id", F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.size(F.regexp_extract_all("html", F.lit("<p[ >]"), F.lit(0))).cast("long").alias("paragraphs"))


@query(r"""SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'),
'&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\r\n]+', ' ', 'g'))) AS body_md5 FROM pages""")
def markup_text(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(strip_markup(F.col("html")).cast("binary")).alias("body_md5"))


@query("""
SELECT 'orders.o_orderkey unique' AS rule, count(*)::BIGINT AS violations FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'orders.o_custkey not_null', count(*) FROM orders WHERE o_custkey IS NULL
UNION ALL SELECT 'orders.o_orderstatus accepted', count(*) FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'lineitem.l_quantity between', count(*) FROM lineitem WHERE l_quantity NOT BETWEEN 2 AND 49
UNION ALL SELECT 'lineitem unique_combination', count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""")
def quality_violations(spark, d):
    from veloframe.plans import quality

    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    return quality.report({
        "orders.o_orderkey unique": quality.unique(orders, "o_orderkey"), "orders.o_custkey not_null": quality.not_null(orders, "o_custkey"),
        "orders.o_orderstatus accepted": quality.accepted(orders, "o_orderstatus", ["F", "O"]), "lineitem.l_quantity between": quality.between(lines, "l_quantity", 2, 49),
        "lineitem unique_combination": quality.unique_combination(lines, ["l_orderkey", "l_linenumber"]),
    })


_GRID = "h AS (SELECT user_id, (date_diff('hour', TIMESTAMP '2024-01-01', date_trunc('hour', ts)))::BIGINT AS t, avg(value) AS v FROM events GROUP BY 1, 2)"
_HELD = f"""WITH {_GRID}, l AS (SELECT *, lead(t) OVER (PARTITION BY user_id ORDER BY t) AS nxt FROM h),
g AS (SELECT user_id, unnest(generate_series(t, CASE WHEN nxt - t <= 12 THEN nxt - 1 ELSE t END)) AS step, v FROM l)"""


def _hours(spark, d):
    hour = F.floor((F.unix_seconds(F.date_trunc("hour", "ts").cast("timestamp")) - F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))) / 3600).cast("long")
    return table(spark, d, "events").groupBy("user_id", hour.alias("t")).agg(F.avg("value").alias("v"))


@query(f"{_HELD} SELECT user_id, count(*)::BIGINT AS steps, min(step)::BIGINT AS first_step, max(step)::BIGINT AS last_step, round(avg(v), 6) AS mean FROM g GROUP BY 1")
def resample_hold(spark, d):
    grid = series.held(_hours(spark, d), ["user_id"], "t", ["v"], 12)
    return grid.groupBy("user_id").agg(F.count(F.lit(1)).alias("steps"), F.min("step").alias("first_step"), F.max("step").alias("last_step"), r6(F.avg("v"), "mean"))


@query(f"""{_HELD}, s AS (SELECT user_id, unnest(generate_series(((floor((step - 48) / 12.0) + 1) * 12)::BIGINT, (floor(step / 12.0) * 12)::BIGINT, 12)) AS start, v FROM g)
SELECT user_id, start::BIGINT AS start, count(v)::BIGINT AS n, round(avg(v), 6) AS mean FROM s GROUP BY 1, 2 HAVING count(v) >= 0.9 * 48""")
def sliding_windows(spark, d):
    grid = series.held(_hours(spark, d), ["user_id"], "t", ["v"], 12)
    return series.sliding(grid, ["user_id"], "step", "v", 48, 12, 0.9).select("user_id", "start", "n", r6(F.col("mean"), "mean"))


@query(f"""{_HELD}, f AS (SELECT *, v > 60 AS high FROM g WHERE step < 360), i AS (SELECT *, sum(CASE WHEN high AND NOT coalesce(before, false) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY step ROWS UNBOUNDED PRECEDING) AS island
FROM (SELECT *, lag(high) OVER (PARTITION BY user_id ORDER BY step) AS before FROM f))
SELECT user_id, min(step)::BIGINT AS start, max(step)::BIGINT AS last_step, count(*)::BIGINT AS n FROM i WHERE high GROUP BY user_id, island HAVING count(*) >= 6""")
def early_islands(spark, d):
    grid = series.held(_hours(spark, d), ["user_id"], "t", ["v"], 12).filter("step < 360").withColumn("high", F.col("v") > 60)
    runs = series.islands(grid, ["user_id"], "step", "high")
    return runs.groupBy("user_id", "island").agg(F.min("step").alias("start"), F.max("step").alias("last_step"), F.count(F.lit(1)).alias("n")).filter("n >= 6").drop("island")


@query(f"""WITH {_GRID}, n AS (SELECT *, least(coalesce(lead(t) OVER (PARTITION BY user_id ORDER BY t), t), t + 24)::DOUBLE AS e, min(t) OVER (PARTITION BY user_id) AS lo, max(t) OVER (PARTITION BY user_id) AS hi FROM h),
p AS (SELECT user_id, v, greatest(least(e, (lo + hi) / 2.0) - t, 0) AS a, greatest(e - greatest(t, (lo + hi) / 2.0), 0) AS b FROM n)
SELECT user_id, round(sum(v * a) / nullif(sum(a), 0), 6) AS first_half, round(sum(v * b) / nullif(sum(b), 0), 6) AS second_half FROM p GROUP BY 1""")
def half_split_means(spark, d):
    out = series.halves(_hours(spark, d).withColumn("t", F.col("t").cast("double")), ["user_id"], "t", "v", 24.0)
    return out.select("user_id", r6(F.col("first_half"), "first_half"), r6(F.col("second_half"), "second_half"))


@query("""
WITH s AS (SELECT unnest([1, 2, 3, 4]) AS week), k AS (SELECT unnest(['F', 'O', 'P']) AS class), o AS (SELECT *, date_diff('day', o_orderdate::DATE, DATE '2001-08-01') AS age FROM orders)
SELECT week::BIGINT AS week, class, count(o_orderkey)::BIGINT AS n, round(coalesce(sum(o_totalprice), 0), 2) AS total FROM s CROSS JOIN k LEFT JOIN o ON o_orderstatus = class AND age >= 0 AND age // 7 + 1 = week GROUP BY 1, 2""")
def weekly_buckets(spark, d):
    from veloframe.plans.coach import weekly_volumes

    orders = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderstatus").alias("class"), F.col("o_totalprice").alias("x"))
    return weekly_volumes(orders, "2001-08-01", ["F", "O", "P"]).select("week", "class", "n", F.round("total", 2).alias("total"))


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT user_id, ts FROM events), k AS (SELECT user_id, min(ts) AS start FROM e GROUP BY 1
UNION ALL SELECT k.user_id, (SELECT min(e.ts) FROM e WHERE e.user_id = k.user_id AND e.ts >= k.start + INTERVAL 1 DAY) FROM k WHERE k.start IS NOT NULL)
SELECT user_id, start, start + INTERVAL 1 DAY AS stop FROM k WHERE start IS NOT NULL""")
def greedy_non_overlap(spark, d):
    windows = table(spark, d, "events").select("user_id", F.col("ts").alias("start"), F.expr("ts + interval 1 day").alias("stop"))
    return series.greedy_disjoint(windows, ["user_id"], "start", "stop")


@query(None)
def lap_reconstruct(spark, d):
    from veloframe.plans.coach import laps_from_stream

    w = Window.partitionBy("user_id").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    stream = _hours(spark, d).withColumn("distance", F.sum(F.when(F.col("v") > 30, F.col("v")).otherwise(0.0)).over(w))
    return laps_from_stream(stream.select("user_id", F.col("t").cast("double").alias("t"), "distance"), "user_id", rest_s=10.0, still_m=0.5)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(spark, d):
    return table(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("SELECT event_type, round(median(value), 6) AS median, round(quantile_cont(value, 0.25), 6) AS lower, count(*)::BIGINT AS n FROM events GROUP BY 1")
def exact_median(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(r6(F.percentile("value", 0.5), "median"), r6(F.percentile("value", 0.25), "lower"), F.count(F.lit(1)).alias("n"))


@query("SELECT event_type, quantile_disc(value, 0.5) AS median FROM events GROUP BY 1")
def approximate_median(spark, d):
    """Exact to one rank in ten thousand; at the sizes compared, a rank is a value."""
    return table(spark, d, "events").groupBy("event_type").agg(F.percentile_approx("value", 0.5, 100_000).alias("median"))


@query("""SELECT event_type, minutes, round(100.0 * minutes / sum(minutes) OVER (), 6) AS pct FROM (SELECT event_type, round(sum(value) / 60, 6) AS minutes FROM events GROUP BY 1)""")
def share_of_total(spark, d):
    # The outer window has one row for each type.
    kinds = table(spark, d, "events").groupBy("event_type").agg(F.round(F.sum("value") / 60, 6).alias("minutes"))
    total = kinds.agg(F.sum("minutes").alias("all"))
    return kinds.crossJoin(F.broadcast(total)).select("event_type", "minutes", r6(F.lit(100.0) * F.col("minutes") / F.col("all"), "pct"))


@query("""WITH d AS (SELECT ts::DATE AS day, round(sum(value), 6) AS total FROM events GROUP BY 1) SELECT day, total FROM d WHERE date_diff('day', day, (SELECT max(day) FROM d)) % 7 = 0 AND date_diff('day', day, (SELECT max(day) FROM d)) <= 49""")
def weekly_samples(spark, d):
    days = table(spark, d, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(r6(F.sum("value"), "total"))
    last = days.agg(F.max("day").alias("last"))
    age = F.datediff("last", "day")
    return days.crossJoin(F.broadcast(last)).filter((F.pmod(age, F.lit(7)) == 0) & (age <= 49)).select("day", "total")


@query("""SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ', ') AS kinds, count(*)::BIGINT AS n FROM events GROUP BY 1""")
def collected_labels(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ", ").alias("kinds"), F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey, c_name, n_name, r_name, coalesce(lines, 0)::BIGINT AS lines FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def enrichment_chain(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    out = table(spark, d, "orders").join(table(spark, d, "customer"), F.expr("o_custkey = c_custkey"), "left").join(table(spark, d, "nation"), F.expr("c_nationkey = n_nationkey"), "left")
    out = out.join(table(spark, d, "region"), F.expr("n_regionkey = r_regionkey"), "left").join(lines, F.expr("o_orderkey = l_orderkey"), "left")
    return out.select("o_orderkey", "c_name", "n_name", "r_name", F.coalesce("lines", F.lit(0)).cast("long").alias("lines"))


@query("""SELECT user_id, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance, round(100 * stddev_pop(value) / nullif(avg(value), 0), 6) AS cv_pct FROM events GROUP BY 1""")
def spread_stats(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(r6(F.avg("value"), "mean"), r6(F.var_pop("value"), "variance"), r6(100 * F.stddev_pop("value") / F.nullif(F.avg("value"), F.lit(0.0)), "cv_pct"))


@query("""SELECT user_id, round(100.0 * sum(CASE WHEN value >= 10 THEN value END) / nullif(sum(CASE WHEN value >= 10 THEN 1 + event_id % 5 END), 0), 6) AS pace FROM events GROUP BY 1""")
def weighted_pace(spark, d):
    from veloframe.plans.gold import weighted_pace as pace

    events = table(spark, d, "events").withColumn("size", 1 + F.col("event_id") % 5)
    return pace(events, ["user_id"], "value", "size", F.col("value") >= 10).select("user_id", r6(F.col("pace"), "pace"))


@query("""
WITH s AS (SELECT event_id, user_id, ts::DATE AS day FROM events WHERE event_type = 'error'), c AS (SELECT user_id, ts::DATE AS day, min(event_id) AS id, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT s.event_id, CASE WHEN n = 1 THEN id END AS linked, CASE WHEN n IS NULL THEN 'unmatched' WHEN n = 1 THEN 'date' ELSE 'ambiguous' END AS method FROM s LEFT JOIN c ON s.user_id = c.user_id AND s.day = c.day""")
def unique_link(spark, d):
    from veloframe.plans.gold import link_unique

    events = table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day"))
    return link_unique(events.filter("event_type = 'error'"), events.filter("event_type = 'purchase'").withColumnRenamed("event_id", "id"), ["user_id", "day"], "id").select("event_id", "linked", F.col("method"))


@query("""
WITH t AS (SELECT user_id, event_id, value FROM events WHERE event_type = 'view'), r AS (SELECT user_id, event_id AS other, value AS v FROM events WHERE event_type = 'view'),
j AS (SELECT t.event_id, other, least(value, v) / greatest(value, v) AS ratio FROM t JOIN r USING (user_id) WHERE other < event_id AND least(value, v) / greatest(value, v) >= 0.8)
SELECT event_id, other, round(ratio, 6) AS ratio FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY other DESC) AS rn FROM j) WHERE rn <= 8""")
def comparable_sessions(spark, d):
    from veloframe.plans.coach import comparables

    views = table(spark, d, "events").filter("event_type = 'view'").select("user_id", "event_id", "value")
    return comparables(views, views, ["user_id"], "event_id", "value", 0.8, 8).select("event_id", "other", r6(F.col("ratio"), "ratio"))


@query("""SELECT conv_id, count(*)::BIGINT AS turns, string_agg(role, '>' ORDER BY turn) AS roles, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY 1""")
def ordered_children(spark, d):
    turns = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.array_join(F.transform(turns, lambda x: x["role"]), ">").alias("roles"), F.sum(F.length("text")).cast("long").alias("chars"))


@query("""SELECT event_id, floor(round(value * 10) / 60)::BIGINT || ':' || lpad((round(value * 10)::BIGINT % 60)::VARCHAR, 2, '0') AS mmss,
CASE event_type WHEN 'view' THEN 'seen' WHEN 'click' THEN 'used' WHEN 'error' THEN 'other(error…)' WHEN 'signup' THEN 'other(signup…)' ELSE 'other(purcha…)' END AS label,
CASE WHEN event_type IN ('view', 'click') THEN 'light' WHEN event_type = 'purchase' THEN 'heavy' ELSE 'rest' END AS kind, CASE WHEN value - 5 > 0 THEN round(100 / (value - 5), 6) END AS rate,
CASE WHEN trim(event_type) IN ('', 'None') THEN NULL ELSE event_type END AS kept, round(2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians(value / 10) / 2), 2) + cos(radians(10.0)) * cos(radians(10 + value / 10)) * pow(sin(radians(1.0) / 2), 2)))), 3) AS metres FROM events""")
def scalar_functions(spark, d):
    v = F.col("value")
    return table(spark, d, "events").select(
        "event_id", minutes_seconds(v * 10).alias("mmss"), label_from(F.col("event_type"), {"view": "seen", "click": "used"}, "none").alias("label"), one_of(F.col("event_type"), {"light": ["view", "click"], "heavy": ["purchase"]}, "rest").alias("kind"),
        r6(per(F.lit(100.0), v - 5), "rate"), blank_to_null(F.col("event_type")).alias("kept"), F.round(haversine_m(F.lit(10.0), F.lit(0.0), 10 + v / 10, F.lit(1.0)), 3).alias("metres"),
    )


@query("""SELECT user_id, q, round(v, 6) AS v FROM (SELECT user_id, min(value) AS lowest, max(value) AS highest, avg(value) AS middle FROM events GROUP BY 1) UNPIVOT (v FOR q IN (lowest, highest, middle))""")
def unpivot_stats(spark, d):
    wide = table(spark, d, "events").groupBy("user_id").agg(F.min("value").alias("lowest"), F.max("value").alias("highest"), F.avg("value").alias("middle"))
    return wide.unpivot("user_id", ["lowest", "highest", "middle"], "q", "v").select("user_id", "q", r6(F.col("v"), "v"))


@query("""SELECT user_id, round(sum(value) FILTER (event_type = 'view'), 6) AS "view", round(sum(value) FILTER (event_type = 'click'), 6) AS click, round(sum(value) FILTER (event_type = 'error'), 6) AS error FROM events GROUP BY 1""")
def pivot_sums(spark, d):
    wide = table(spark, d, "events").groupBy("user_id").pivot("event_type", ["view", "click", "error"]).agg(F.round(F.sum("value"), 6))
    return wide


_LISTED = "SELECT user_id || '/' || ts::DATE AS name, count(*) AS mark FROM events WHERE event_type = '{}' GROUP BY 1"


@query(f"""
SELECT coalesce(n.name, o.name) AS name, CASE WHEN o.name IS NULL THEN 'new' WHEN n.name IS NULL THEN 'deleted' WHEN o.mark <> n.mark THEN 'changed' ELSE 'unchanged' END AS state
FROM ({_LISTED.format('view')}) n FULL JOIN ({_LISTED.format('click')}) o ON n.name = o.name""")
def incremental_plan(spark, d):
    """Two listings of user and day: those with views, as they are now, and those with clicks, as they were known."""
    from veloframe.sources.listing import plan

    events = table(spark, d, "events").withColumn("name", F.concat_ws("/", "user_id", F.col("ts").cast("date").cast("string")))
    listed = lambda kind: events.filter(F.col("event_type") == kind).groupBy("name").agg(F.count(F.lit(1)).alias("mark"))
    return plan(listed("view"), listed("click"), "name", "mark").select("name", "state")


# Marts, on frames bound from the supplied tables: orders are activities, events are points of the activity of their user's number.

_ACTS = """acts AS (SELECT o_orderkey AS activity_id, 'g' || o_custkey % 7 AS gear_id, 'bike ' || o_custkey % 3 AS gear_label, CASE o_orderstatus WHEN 'F' THEN 'cycling' WHEN 'O' THEN 'running' ELSE 'swimming' END AS sport,
  o_orderdate::DATE AS activity_date, year(o_orderdate)::INT AS year, strftime(o_orderdate, '%Y-%m') AS month, 'a' || o_orderkey AS name, o_orderkey % 4 = 0 AS is_indoor, o_totalprice AS distance, o_totalprice / 1000 AS distance_km,
  600 + o_orderkey % 20000 AS moving_time, (600 + o_orderkey % 20000) / 3600 AS moving_h, (o_custkey % 50)::DOUBLE AS elev_m, (o_orderkey % 13)::DOUBLE AS average_speed, (150 + o_orderkey % 100)::DOUBLE AS weighted_average_watts,
  o_orderkey % 3 = 0 AS rest_included FROM orders)"""
_POINTS = """points AS (SELECT user_id AS activity_id, event_id, TIMESTAMP '2024-01-01' + to_seconds((epoch(ts)::BIGINT - epoch(TIMESTAMP '2024-01-01')::BIGINT) // 600) AS point_ts, CASE WHEN event_type <> 'signup' THEN round(value * 4)::BIGINT END AS watts,
  event_id % 120 AS cadence, (event_id % 9)::DOUBLE AS grade_pct, CASE WHEN event_id % 5 > 0 THEN event_type <> 'error' END AS moving, CASE WHEN user_id % 4 = 0 THEN 'running' ELSE 'cycling' END AS sport FROM events)"""
_BOUND = f"WITH {_ACTS}, {_POINTS}, power AS (SELECT activity_id, point_ts, watts FROM points WHERE sport = 'cycling' AND watts IS NOT NULL)"


def _acts(spark, d):
    kinds = F.when(F.col("o_orderstatus") == "F", "cycling").when(F.col("o_orderstatus") == "O", "running").otherwise("swimming")
    key, gear, day, moving = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate").cast("date"), 600 + F.col("o_orderkey") % 20000
    return table(spark, d, "orders").select(
        key.alias("activity_id"), F.concat(F.lit("g"), gear % 7).alias("gear_id"), F.concat(F.lit("bike "), gear % 3).alias("gear_label"), kinds.alias("sport"), day.alias("activity_date"), F.year(day).alias("year"),
        F.date_format(day, "yyyy-MM").alias("month"), F.concat(F.lit("a"), key).alias("name"), (key % 4 == 0).alias("is_indoor"), F.col("o_totalprice").alias("distance"), (F.col("o_totalprice") / 1000).alias("distance_km"), moving.alias("moving_time"),
        (moving / 3600).alias("moving_h"), (gear % 50).cast("double").alias("elev_m"), (key % 13).cast("double").alias("average_speed"), (150 + key % 100).cast("double").alias("weighted_average_watts"), (key % 3 == 0).alias("rest_included"),
    )


def _points(spark, d):
    e = F.col("event_id")
    # Whole seconds are the nearest ones, as in the SQL, whose cast rounds; its division cuts towards zero.
    second = F.expr("(cast(rint(unix_micros(cast(ts as timestamp)) / 1e6d) as bigint) - unix_seconds(timestamp'2024-01-01')) div 600").cast("int")
    return table(spark, d, "events").select(
        F.col("user_id").alias("activity_id"), e, (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=second)).alias("point_ts"), F.when(F.col("event_type") != "signup", F.round(F.col("value") * 4).cast("long")).alias("watts"),
        (e % 120).alias("cadence"), (e % 9).cast("double").alias("grade_pct"), F.when(e % 5 > 0, F.col("event_type") != "error").alias("moving"), F.when(F.col("user_id") % 4 == 0, "running").otherwise("cycling").alias("sport"),
    )


def _ftp(spark):
    return spark.range(1).select(F.lit(250.0).alias("ftp"))


def _plain(df: DataFrame, *columns: str) -> DataFrame:
    """Columns as the comparison has them: whole numbers as bigint, doubles to six digits."""
    kinds = dict(df.dtypes)
    return df.select(*[F.col(c).cast("long").alias(c) if kinds[c] in ("int", "smallint") else F.round(c, 6).alias(c) if kinds[c] == "double" else F.col(c) for c in columns or df.columns])


@query(f"""{_BOUND}, s AS (SELECT activity_id, avg(watts) OVER (PARTITION BY activity_id ORDER BY point_ts RANGE BETWEEN INTERVAL 30 SECOND PRECEDING AND CURRENT ROW) AS p FROM power),
e AS (SELECT activity_id, pow(avg(pow(p, 4)), 0.25) AS np, count(*) AS n FROM s GROUP BY 1)
SELECT activity_id, activity_date, gear_label, round(np, 6) AS np, n::BIGINT AS power_samples, round(np - weighted_average_watts, 6) AS np_diff, round(np / 250, 6) AS intensity, round(moving_time * np * np / 250 / (250.0 * 3600) * 100, 6) AS tss
FROM acts JOIN e USING (activity_id) WHERE sport = 'cycling'""")
def mart_ride_power(spark, d):
    from veloframe.plans import gold

    return _plain(gold.mart_ride_power(_points(spark, d), _acts(spark, d), _ftp(spark)), "activity_id", "activity_date", "gear_label", "np", "power_samples", "np_diff", "intensity", "tss")


@query(f"""{_BOUND}, z AS (SELECT activity_id, CASE WHEN watts < 0.56 * 250 THEN 1 WHEN watts < 0.76 * 250 THEN 2 WHEN watts < 0.91 * 250 THEN 3 WHEN watts < 1.06 * 250 THEN 4 WHEN watts < 1.21 * 250 THEN 5 WHEN watts < 1.51 * 250 THEN 6 ELSE 7 END AS zone FROM power),
c AS (SELECT activity_id, zone, count(*) AS n FROM z GROUP BY 1, 2), p AS (SELECT *, 100.0 * n / sum(n) OVER (PARTITION BY activity_id) AS pct FROM c)
SELECT activity_id, zone::BIGINT AS zone, n::BIGINT AS seconds, round(n / 60, 6) AS minutes, round(pct, 6) AS pct, name FROM p JOIN acts USING (activity_id)""")
def mart_power_zones(spark, d):
    from veloframe.plans import gold

    return _plain(gold.mart_power_zones(gold.stg_power_points(_points(spark, d)), _acts(spark, d), _ftp(spark)), "activity_id", "zone", "seconds", "minutes", "pct", "name")


@query(f"""{_BOUND}, q AS (SELECT activity_id, point_ts, watts, ntile(4) OVER (PARTITION BY activity_id ORDER BY point_ts, watts) AS q FROM power JOIN acts USING (activity_id) WHERE acts.sport = 'cycling' AND moving_time >= 10800),
s AS (SELECT activity_id, q, count(*) AS n FROM q GROUP BY 1, 2) SELECT activity_id, max(n) FILTER (q = 1)::BIGINT AS n1, max(n) FILTER (q = 4)::BIGINT AS n4, count(*)::BIGINT AS quarters FROM s GROUP BY 1""")
def ride_quarters(spark, d):
    points = _points(spark, d).filter("sport = 'cycling' and watts is not null").join(_acts(spark, d).filter("sport = 'cycling' and moving_time >= 10800").select("activity_id"), "activity_id", "left_semi")
    each = points.select("activity_id", F.ntile(4).over(Window.partitionBy("activity_id").orderBy("point_ts", "watts")).alias("q")).groupBy("activity_id", "q").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("activity_id").agg(F.max(F.when(F.col("q") == 1, F.col("n"))).alias("n1"), F.max(F.when(F.col("q") == 4, F.col("n"))).alias("n4"), F.count(F.lit(1)).alias("quarters"))


@query(f"""{_BOUND}, p AS (SELECT *, cadence > 0 AND cadence < 75 AND watts >= 0.75 * 250 AS grind, grade_pct >= 4 AS steep FROM points WHERE sport = 'cycling' AND watts IS NOT NULL)
SELECT activity_id, 250.0::DOUBLE AS ftp_anchor, count(*)::BIGINT AS power_samples, count_if(grind)::BIGINT AS grind_s, count_if(steep AND coalesce(moving, true))::BIGINT AS climb_s, count_if(grind AND steep)::BIGINT AS grind_climb_s,
round(avg(CASE WHEN steep AND cadence > 0 THEN cadence END), 6) AS climb_cadence, round(avg(CASE WHEN cadence > 0 THEN cadence END), 6) AS pedaling_cadence FROM p GROUP BY 1""")
def int_ride_load(spark, d):
    from veloframe.plans import gold

    return _plain(gold.int_ride_load(_points(spark, d), _ftp(spark)))


_CURVE = f"""{_BOUND}, w AS (SELECT activity_id, {", ".join(f"CASE WHEN count(*) OVER w{s} >= ceil({s} * 0.02) THEN avg(watts) OVER w{s} END AS b{s}" for s in (120, 300, 480, 720, 1200))} FROM power
  WINDOW {", ".join(f"w{s} AS (PARTITION BY activity_id ORDER BY point_ts RANGE BETWEEN INTERVAL {s} SECOND PRECEDING AND CURRENT ROW)" for s in (120, 300, 480, 720, 1200))}),
curve AS (SELECT activity_id, s::BIGINT AS duration_s, b AS best_watts, activity_date, name FROM ({" UNION ALL ".join(f"SELECT activity_id, {s} AS s, max(b{s}) AS b FROM w GROUP BY 1" for s in (120, 300, 480, 720, 1200))}) JOIN acts USING (activity_id) WHERE b IS NOT NULL),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY duration_s, window_label ORDER BY round(best_watts, 6) DESC, activity_date, activity_id) AS rn FROM (SELECT *, 'all_time' AS window_label FROM curve
  UNION ALL SELECT *, 'recent_90d' FROM curve WHERE date_diff('day', activity_date, DATE '2001-08-01') BETWEEN 0 AND 90)) WHERE rn = 1)"""


def _curve(spark, d):
    import datetime as dt

    from veloframe.config import Config
    from veloframe.plans import gold

    config = Config(durations=(120, 300, 480, 720, 1200), window_share=0.02, as_of=dt.date(2001, 8, 1))
    best = gold.int_power_curve_ride(gold.stg_power_points(_points(spark, d)), _acts(spark, d), config=config)
    return best.withColumn("best_watts", F.round("best_watts", 6)), config


@query(f"{_CURVE} SELECT activity_id, duration_s, round(best_watts, 6) AS best_watts, activity_date, name FROM curve")
def int_power_curve_ride(spark, d):
    return _plain(_curve(spark, d)[0], "activity_id", "duration_s", "best_watts", "activity_date", "name")


@query(f"{_CURVE} SELECT window_label, duration_s, activity_id, round(best_watts, 6) AS best_watts, activity_date, name FROM top")
def mart_power_curve(spark, d):
    from veloframe.plans import gold

    return _plain(gold.mart_power_curve(*_curve(spark, d)), "window_label", "duration_s", "activity_id", "best_watts", "activity_date", "name")


@query(f"""{_CURVE}, f AS (SELECT window_label, count(*) AS points, regr_slope(round(best_watts, 6), 1.0::DOUBLE / duration_s) AS w_prime, regr_intercept(round(best_watts, 6), 1.0::DOUBLE / duration_s) AS cp FROM top GROUP BY 1 HAVING count(*) >= 3)
SELECT window_label, round(best_watts, 6) AS p20, activity_date AS p20_date, round(best_watts * 0.95, 4) AS by_20min, points::BIGINT AS points, round(w_prime, 4) AS w_prime, round(cp, 4) AS cp, round(abs(best_watts * 0.95 - cp), 4) AS method_spread
FROM top LEFT JOIN f USING (window_label) WHERE duration_s = 1200""")
def mart_ftp_estimate(spark, d):
    from veloframe.plans import gold

    out = gold.mart_ftp_estimate(gold.mart_power_curve(*_curve(spark, d)), _ftp(spark))
    return out.select("window_label", "p20", "p20_date", "points", *[F.round(c, 4).alias(c) for c in ("by_20min", "w_prime", "cp", "method_spread")])


@query(f"""WITH {_ACTS} SELECT gear_id, gear_label, count(*)::BIGINT AS activities, round(sum(distance_km), 6) AS distance_km, round(sum(moving_h), 6) AS moving_h, round(sum(elev_m), 6) AS elev_m, round(avg(distance_km), 6) AS avg_km_per_ride,
count_if(is_indoor)::BIGINT AS indoor, round(100.0 * count_if(is_indoor) / count(*), 6) AS indoor_pct, min(activity_date) AS first_used, max(activity_date) AS last_used FROM acts WHERE sport = 'cycling' GROUP BY 1, 2""")
def mart_gear_usage(spark, d):
    from veloframe.plans import gold

    return _plain(gold.mart_gear_usage(_acts(spark, d)))


@query(f"""WITH {_ACTS}, p AS (SELECT unnest([['month', month], ['year', year::VARCHAR], ['all', 'all']]) AS k, * FROM acts)
SELECT k[1] AS period_type, k[2] AS period, sport, count(*)::BIGINT AS activities, round(sum(distance_km), 1) AS distance_km, round(sum(moving_h), 1) AS moving_h, round(sum(elev_m), 0) AS elev_m FROM p GROUP BY 1, 2, 3""")
def mart_period_summary(spark, d):
    from veloframe.plans import gold

    return _plain(gold.mart_period_summary(_acts(spark, d)), "period_type", "period", "sport", "activities", "distance_km", "moving_h", "elev_m")


@query(f"""WITH {_ACTS} SELECT sport, count(*)::BIGINT AS activities, round(sum(distance_km), 6) AS distance_km, round(sum(moving_h), 6) AS moving_h, round(sum(elev_m), 6) AS elev_m, round(avg(distance_km), 6) AS mean_km,
max(distance_km) AS longest_km, min(activity_date) AS first_date, max(activity_date) AS last_date FROM acts GROUP BY 1""")
def mart_sport_totals(spark, d):
    from veloframe.plans import gold

    return _plain(gold.mart_sport_totals(_acts(spark, d)))


@query(f"""WITH {_ACTS} SELECT year::BIGINT AS year, sport, count(*)::BIGINT AS activities, round(sum(distance_km), 6) AS distance_km, round(sum(moving_h), 6) AS moving_h, round(sum(elev_m), 6) AS elev_m, count_if(is_indoor)::BIGINT AS indoor FROM acts GROUP BY 1, 2""")
def mart_yearly_summary(spark, d):
    from veloframe.plans import gold

    return _plain(gold.mart_yearly_summary(_acts(spark, d)))


@query(f"""WITH {_ACTS}, m AS (SELECT month, year::BIGINT AS year, count(*)::BIGINT AS swims, count_if(NOT rest_included)::BIGINT AS paced_swims, round(sum(distance), 4) AS distance_m,
round(100.0 * sum(CASE WHEN NOT rest_included THEN moving_time END) / nullif(sum(CASE WHEN NOT rest_included THEN distance END), 0), 6) AS pace_s_per_100m FROM acts WHERE sport = 'swimming' AND distance > 0 GROUP BY 1, 2)
SELECT *, (round(pace_s_per_100m)::BIGINT // 60) || ':' || lpad((round(pace_s_per_100m)::BIGINT % 60)::VARCHAR, 2, '0') AS pace_label FROM m""")
def mart_swim_pace_monthly(spark, d):
    from veloframe.plans import gold

    return _plain(gold.mart_swim_pace_monthly(_acts(spark, d)).withColumn("distance_m", F.round("distance_m", 4)))


@query(f"""WITH {_ACTS}, s AS (SELECT unnest(['cycling', 'running', 'swimming']) AS sport), a AS (SELECT *, date_diff('day', activity_date, DATE '2001-08-01') AS age FROM acts)
SELECT sport, DATE '2001-08-01' AS today, max(activity_date) AS last_date, min(age)::BIGINT AS days_since, round(sum(distance_km) FILTER (age BETWEEN 0 AND 27), 1) AS recent_km, round(sum(distance_km) FILTER (age BETWEEN 28 AND 55), 1) AS previous_km,
round(sum(moving_h) FILTER (age BETWEEN 0 AND 27), 1) AS recent_h, round(sum(moving_h) FILTER (age BETWEEN 28 AND 55), 1) AS previous_h, count(*) FILTER (age BETWEEN 0 AND 27)::BIGINT AS recent_n, count(*) FILTER (age BETWEEN 28 AND 55)::BIGINT AS previous_n,
round(max(distance_km) FILTER (age BETWEEN 0 AND 27), 1) AS recent_longest_km FROM s LEFT JOIN a USING (sport) GROUP BY 1""")
def mart_training_status(spark, d):
    import datetime as dt

    from veloframe.config import Config
    from veloframe.plans import gold

    return _plain(gold.mart_training_status(_acts(spark, d), Config(as_of=dt.date(2001, 8, 1))))


_NOTES = """notes AS (SELECT *, o_orderkey AS k, '훈련상태 체력 ' || o_orderkey % 90 || ' 피로 ' || o_custkey % 80 || ' 균형 -' || o_orderkey % 30 || chr(10) || 'R파워 ' || (180 + o_orderkey % 90) || 'w 강도 0.' || (50 + o_orderkey % 50) || ' 훈련량 ' || o_orderkey % 200
  || CASE WHEN o_orderkey % 2 = 0 THEN ' 회복시간 ' || o_orderkey % 48 || ' 시간' ELSE '' END || ' 20분  ' || o_custkey % 300 || 'w' AS description FROM orders)"""


@query(f"""WITH {_NOTES} SELECT k AS activity_id, k % 90 AS fitness, o_custkey % 80 AS fatigue, -(k % 30) AS form, 180 + k % 90 AS r_power, round((50 + k % 50) / 100, 6) AS intensity, k % 200 AS load, CASE WHEN k % 2 = 0 THEN k % 48 END AS recovery_h,
o_custkey % 300 AS peak_20min_w, NULL::BIGINT AS peak_5min_w, round((180 + k % 90) / ((50 + k % 50) / 100))::BIGINT AS implied_ftp FROM notes""")
def stg_service_notes(spark, d):
    from veloframe.plans import gold

    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rest = F.when(k % 2 == 0, F.concat(F.lit(" 회복시간 "), k % 48, F.lit(" 시간"))).otherwise("")
    text = F.concat(F.lit("훈련상태 체력 "), k % 90, F.lit(" 피로 "), c % 80, F.lit(" 균형 -"), k % 30, F.lit("\nR파워 "), 180 + k % 90, F.lit("w 강도 0."), 50 + k % 50, F.lit(" 훈련량 "), k % 200, rest, F.lit(" 20분  "), c % 300, F.lit("w"))
    out = gold.stg_service_notes(table(spark, d, "orders").select(k.alias("activity_id"), text.alias("description")))
    return _plain(out, "activity_id", "fitness", "fatigue", "form", "r_power", "intensity", "load", "recovery_h", "peak_20min_w", "peak_5min_w", "implied_ftp")


@query(f"""WITH {_ACTS}, f AS (SELECT user_id AS activity_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT activity_id, sport, round(moving_time / 60, 0) AS moving_min, CASE WHEN sport = 'running' THEN round(1000 / nullif(average_speed, 0), 6) END AS pace_s_per_km, CASE WHEN sport = 'swimming' THEN round(100 / nullif(average_speed, 0), 6) END AS pace_s_per_100m,
coalesce(n, 0)::BIGINT AS symptoms FROM acts LEFT JOIN f USING (activity_id)""")
def mart_activity_feed(spark, d):
    from veloframe.plans import gold

    acts = _acts(spark, d)
    none = spark.createDataFrame([], "activity_id long, load int")
    felt = table(spark, d, "events").filter("event_type = 'error'").select(F.col("user_id").alias("activity_id"))
    power = gold.mart_ride_power(_points(spark, d), acts, _ftp(spark))
    return _plain(gold.mart_activity_feed(acts, power, none, felt), "activity_id", "sport", "moving_min", "pace_s_per_km", "pace_s_per_100m", "symptoms")


@query("""SELECT s.state, count(o_orderkey)::BIGINT AS n, max(o_orderdate)::DATE AS latest FROM (SELECT unnest(['F', 'O', 'P', 'failed']) AS state) s LEFT JOIN orders ON o_orderstatus = s.state GROUP BY 1""")
def state_counts(spark, d):
    from veloframe.plans.coach import state_counts as counted

    jobs = table(spark, d, "orders").select(F.col("o_orderstatus").alias("state"), F.col("o_orderdate").cast("date").alias("changed_at"))
    return counted(jobs, ["F", "O", "P", "failed"])


from veloframe.plans import catalog_marts  # noqa: E402, F401  its queries join those above
