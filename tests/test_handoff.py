import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from veloframe.plans import handoff
from veloframe.sources import collect, files


def test_client_renews_waits_and_stops():
    clock, slept, calls, renewed = [1000.0], [], [], []
    replies = [collect.Reply(200, [1], {"x-ratelimit-limit": "100,1000", "x-ratelimit-usage": "10,100"}), collect.Reply(429), collect.Reply(200, [2], {"x-ratelimit-limit": "100,1000", "x-ratelimit-usage": "1,980"})]
    client = collect.Client(lambda *a: (calls.append(a), replies.pop(0))[1], lambda: (renewed.append(1), (f"t{len(renewed)}", clock[0] + 350))[1], lambda: clock[0], slept.append)
    assert client.get("a") == [1] and slept == []
    clock[0] += 100
    assert client.get("b") == [2] and len(renewed) == 2 and slept[0] == pytest.approx(900 - 1100 % 900 + 1)
    with pytest.raises(collect.DailyLimit):
        client.get("c")
    assert len(calls) == 3


def test_pages():
    data = list(range(250))
    client = collect.Client(lambda p, q, h: collect.Reply(200, data[(q["page"] - 1) * 100 : q["page"] * 100]), lambda: ("t", 1e12), lambda: 0.0, lambda s: None)
    assert [len(x) for x in collect.pages(client, "a", 0)] == [100, 100, 50]


def test_debounce():
    d = collect.Debounce(owner=7)
    event = {"owner_id": 7, "object_type": "activity", "aspect_type": "create"}
    assert d.accept(event | {"object_id": 1}, 0) and not d.accept(event | {"owner_id": 8, "object_id": 2}, 0) and not d.accept(event | {"aspect_type": "delete", "object_id": 2}, 0)
    assert d.due(89) == [] and d.accept(event | {"object_id": 2}, 89) and d.due(100) == [] and d.due(179) == [1, 2] and d.due(1000) == []
    for t in range(0, 310, 60):
        d.accept(event | {"object_id": t}, 2000 + t)
    assert d.due(2301) == [0, 60, 120, 180, 240, 300]


def test_todo_and_ledger(spark):
    now = spark.createDataFrame([("a", "x", dt.date(2024, 1, 2)), ("b", "y", dt.date(2024, 1, 2)), ("c", "z", dt.date(2023, 1, 1))], "id string, name string, date date")
    seen = now.filter("id = 'a'").withColumn("fingerprint", collect.fingerprint(F.col("name")))
    assert [r.id for r in collect.changed(now, seen, ["name"], since=dt.date(2024, 1, 1)).collect()] == ["b"]
    bundles = spark.createDataFrame([(1, "one"), (2, "two")], "activity_id long, bundle string")
    sent = collect.to_publish(bundles, spark.createDataFrame([], "activity_id long, sha256 string"))
    ledger = collect.acknowledged(sent, spark.createDataFrame([(1, "queued"), (2, "error")], "activity_id long, status string"))
    assert [r.activity_id for r in ledger.collect()] == [1]
    assert [r.activity_id for r in collect.to_publish(bundles, ledger).collect()] == [2]
    assert [r.activity_id for r in collect.to_publish(bundles.withColumn("bundle", F.lit("new")), ledger).orderBy("activity_id").collect()] == [1, 2]


def test_gpx_round_trip(spark, tmp_path):
    points = spark.createDataFrame([(5, 1, "2024-01-01 00:00:01", 1.5, 2.5, 3.0, 120, None, None), (5, 0, "2024-01-01 00:00:00", 1.0, 2.0, None, None, 80, 20), (5, 2, "2024-01-01 00:00:02", None, 1.0, None, None, None, None)],
                                   "activity_id long, point_idx int, ts string, lat double, lon double, ele_m double, heartrate int, cadence int, temp_c int").withColumn("point_ts", F.to_timestamp("ts"))
    (tmp_path / "2024-01-01_5.gpx").write_text(collect.gpx(points).first().gpx)
    got = files.gpx_points(spark, [f"{tmp_path}/*.gpx"]).orderBy("point_idx").collect()
    assert [(r.lat, r.ele_m, r.heartrate, r.cadence, r.temp_c, str(r.point_ts)) for r in got] == [(1.0, None, None, 80, 20, "2024-01-01 00:00:00"), (1.5, 3.0, 120, None, None, "2024-01-01 00:00:01")]


def test_contract(spark):
    good = {"version": 1, "activity": {"activity_id": 1, "sport": "running", "distance_km": 5.0}, "context": [{"activity_id": 2}]}
    rows = [(1, json.dumps(good)), (2, json.dumps(good | {"activity": {"activity_id": 2, "lat": 1.0}})), (3, json.dumps(good | {"context": [{"activity_id": 2}] * 2, "version": 2})), (4, "no json"), (5, json.dumps(good | {"activity": {"activity_id": 5, "distance_km": -1.0}}))]
    got = {r.activity_id: r.broken for r in handoff.violations(spark.createDataFrame(rows, "activity_id long, bundle string")).collect()}
    assert got[2] == ["unknown field"] and got[3] == ["version", "repeated context"] and got[5] == ["distance"] and 4 in got and 1 not in got


def test_queue(spark):
    bundles = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 2, 1)), (3, dt.date(2024, 2, 2))], "activity_id long, activity_date date")
    queue = spark.createDataFrame([(2, "done", "b", None), (9, "pending", "c", "2024-01-01 00:00:00"), (8, "pending", "a", "2024-03-01 00:00:00")], "activity_id long, state string, start_local string, n string").withColumn("next_at", F.to_timestamp("n"))
    assert {r.activity_id: r.status for r in handoff.admitted(bundles, queue, "2024-01-15").collect()} == {1: "before_cutover", 2: "already_done", 3: "queued"}
    assert [r.activity_id for r in handoff.next_job(queue, "2024-02-01 00:00:00").collect()] == [9]
    review = spark.createDataFrame([(1, 3, 1), (2, 3, 1), (3, 3, 3)], "activity_id long, revision int, tries int")
    current = spark.createDataFrame([(1, 3), (2, 4), (3, 4)], "activity_id long, revision int")
    assert {r.activity_id: r.state for r in handoff.accepted_review(review, current).collect()} == {1: "done", 2: "pending", 3: "failed"}


def test_diary(spark):
    swims = spark.createDataFrame([(1, "2024-01-05T07:00:00", 1500.0, 1800), (2, "2024-01-06T07:00:00", 1000.0, 1200), (3, "2024-01-06T19:00:00", 1010.0, 1210)], "activity_id long, start_local string, distance double, moving_time int")
    pages = spark.createDataFrame([("p1", "<p>2024.1.5 swam <b>1,500m</b> in 30:30</p><script>2020-01-01</script>"), ("p2", "2024-01-06 1000 m"), ("p3", "no date 1000 m"), ("p4", "2024-01-05 1500m 59:00")], "url string, html string")
    posts = handoff.diary_posts(pages)
    first = {r.url: r for r in posts.collect()}["p1"]
    assert (str(first.day), first.metres, first.seconds) == ("2024-01-05", 1500.0, 1830.0)
    links = handoff.linked_swims(posts, swims, "url")
    assert [(r.url, r.swim) for r in links.collect()] == [("p1", 1)]
    notes = spark.createDataFrame([(1, "q"), (2, "p1"), (2, "r"), (2, "s")], "swim long, url string")
    assert [(r.swim, r.url) for r in handoff.new_notes(notes, links).collect()] == [(2, "r")]
    assert handoff.catalog_violations(swims).count() == 0
    assert sorted(r.rule for r in handoff.catalog_violations(swims.union(swims.limit(1)).unionByName(swims.limit(1).withColumn("start_local", F.lit("2024-13-01T00:00:00")).withColumn("activity_id", F.lit(77).cast("long")))).collect()) == ["date", "repeated id"]
    usable = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 3.0, 2.0), (2, 0, 0.0, 0.0), (2, 1, 30.0, 2.0), (3, 0, 0.0, 0.0)], "k int, point_idx int, t double, distance double")
    assert {r.k: r.usable for r in handoff.evidence_usable(usable, "k").collect()} == {1: True, 2: False, 3: False}
    text = handoff.notice(spark.createDataFrame([(1, "swimming", 1.5, "x" * 3000), (2, "running", 5.04, "ok")], "activity_id long, sport string, distance_km double, text string")).orderBy("activity_id").collect()
    assert len(text[0].message) == 1900 and text[0].message.startswith("swimming · 1500 m\n") and text[1].message == "running · 5.0 km\nok"


def test_linked_swims_against_all_pairs(spark):
    import itertools
    import random

    rng = random.Random(3)
    some = lambda xs: rng.choice(xs)
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]
    posts = [(rng.randrange(400), some(days), some([None, 0.0, 25.0, 49.9, float("inf"), float("nan"), *[100.0 * rng.randrange(1, 120)] * 9]), some([None, 600.0, 700.0, 900.0])) for _ in range(150)]
    swims = [(rng.randrange(400), f"{d}T07:00:00" if d else None, some([None, 0.0, 25.0, 74.9, float("inf"), *[100.0 * rng.randrange(1, 120)] * 9]), some([None, 610, 720, 1000])) for d in (some(days) for _ in range(150))]
    for off in (25.0, 0.5, 0.0):
        pairs = [(p[0], w[0]) for p, w in itertools.product(posts, swims) if p[1] and w[1] and str(p[1]) == w[1][:10] and None not in (p[2], w[2]) and abs(p[2] - w[2]) <= off and (None in (p[3], w[3]) or abs(p[3] - w[3]) <= 120)]
        once = lambda i, x: sum(p[i] == x for p in pairs) == 1
        want = sorted(p for p in pairs if once(0, p[0]) and once(1, p[1]))
        got = handoff.linked_swims(spark.createDataFrame(posts, "post int, day date, metres double, seconds double"), spark.createDataFrame(swims, "activity_id int, start_local string, distance double, moving_time int"), "post", off)
        assert sorted(map(tuple, got.collect())) == want and want


def test_linked_swims_of_equal_figures_meet_once(spark):
    """A hundred thousand of each with one day and distance, of which none links, and a pair that does: their pairs are never dealt out."""
    import time

    n, day = 100_000, F.lit("2024-01-01")
    at = F.when(F.col("id") > 0, 500.0).otherwise(900.0)
    posts = spark.range(n).select("id", day.cast("date").alias("day"), at.alias("metres"), F.lit(None).cast("double").alias("seconds"))
    swims = spark.range(n).select(F.col("id").alias("activity_id"), F.concat(day, F.lit("T07:00:00")).alias("start_local"), at.alias("distance"), F.lit(1800).alias("moving_time"))
    start = time.monotonic()
    assert list(map(tuple, handoff.linked_swims(posts, swims, "id").collect())) == [(0, 0)]
    assert time.monotonic() - start < 60
