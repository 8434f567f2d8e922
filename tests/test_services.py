import datetime as dt
import json
import stat

import pytest
from pyspark.sql import functions as F

from veloframe.plans import build, coach, gold, handoff, pacing, report
from veloframe.sources import collect, normalise, services
from veloframe.store import Store


def client(answer):
    """A client whose transport answers by path and parameters; an int is a status."""
    def transport(path, params, headers):
        found = answer(path, params)
        return found if isinstance(found, collect.Reply) else collect.Reply(found) if isinstance(found, int) else collect.Reply(200, found)

    return collect.Client(transport, lambda: ("t", 1e12), lambda: 0.0, lambda s: None)


LISTED = [{"id": i, "start_date": f"2024-01-0{i}T00:00:00Z"} for i in (3, 1, 2)]


def test_sync_goes_on_where_it_stopped():
    saved, fetched = [], []

    def fetch(a):
        if a["id"] == 3 and len(fetched) == 2:
            raise collect.Refused("a", 500)
        fetched.append(a["id"])

    state = services.State()
    c = client(lambda p, q: [a for a in LISTED if services._epoch(a["start_date"]) > q["after"]])
    assert services.sync(c, "a", state, fetch, lambda s: saved.append(set(s.done)), dry=True) == [1, 2, 3] and not state.done
    assert services.sync(c, "a", state, fetch, lambda s: saved.append(set(s.done))) == [1, 2] and saved == [{1}, {1, 2}]
    fetched.clear()
    assert services.sync(c, "a", state, fetch, lambda s: None) == [3] and state.latest == services._epoch("2024-01-03T00:00:00Z")
    assert services.sync(c, "a", state, fetch, lambda s: None) == [] == services.sync(c, "a", state, fetch, lambda s: None, everything=True)
    fetched.clear()
    assert services.sync(c, "a", state, lambda a: None, lambda s: None, since=services._epoch("2024-01-01T12:00:00Z"), refresh=True) == [2, 3]
    with pytest.raises(ValueError, match="range"):
        services.sync(c, "a", state, fetch, lambda s: None, refresh=True)
    one = services.State()
    services.fetch_again(client(lambda p, q: LISTED[0]), "a", [3], one, lambda a: None, lambda s: None)
    assert one.done == {3}


def test_back_fill_keeps_a_ledger(spark):
    ledger = {}

    def fetch(i):
        if i == 2:
            raise collect.Refused("s", 404)
        if i == 4:
            raise collect.DailyLimit("")
        return [1] if i == 1 else []

    assert not services.back_fill([1, 2, 3, 4, 5], fetch, ledger.__setitem__) and ledger == {1: "done", 2: "missing", 3: "empty"}
    acts = spark.createDataFrame([(i, 100.0 if i < 5 else None, 37.0 if i == 6 else None, None if i == 4 else "2024-01-01") for i in range(1, 8)], "activity_id long, average_watts double, start_lat double, d string").withColumn("start_date_key", F.to_date("d"))
    known = spark.createDataFrame(list(ledger.items()), "activity_id long, status string")
    stored = spark.createDataFrame([(1,)], "activity_id long")
    assert {r.activity_id for r in collect.stream_todo(acts, stored, known).collect()} == {6}
    assert {r.activity_id for r in collect.stream_todo(acts, stored, known.limit(0), places=False).collect()} == {2, 3}


def test_second_service(spark, tmp_path):
    def answer(path, q):
        return {"a/i1": {"id": "i1", "laps": 2}, "a/i2": {"id": "other"}, "a/i1/streams.json": 404, "a/i3/streams.json": [{"type": "watts"}]}[path]

    c = client(answer)
    assert services.second_service_document(c, "a", {"id": "i1", "type": "Swim", "stream_types": ["time"]}) == ({"id": "i1", "type": "Swim", "stream_types": ["time"], "laps": 2}, [])
    assert services.second_service_document(c, "a", {"id": "i3", "type": "Ride", "stream_types": ["watts"]})[1] == [{"type": "watts"}]
    assert services.second_service_document(c, "a", {"id": "i9", "type": "Yoga"}) == ({"id": "i9", "type": "Yoga"}, [])
    with pytest.raises(ValueError):
        services.second_service_document(c, "a", {"id": "i2", "type": "Swim"})
    down = client(lambda p, q: collect.Reply(503, "Maintenance until noon"))
    assert services.exit_code(lambda: down.get("a")) == 99 and services.exit_code(lambda: client(lambda p, q: 503).get("a")) == 1 and services.exit_code(lambda: None) == 0

    now = spark.createDataFrame([("a", "x", "Ride", dt.date(2024, 1, 2)), ("b", "y", "Swim", dt.date(2024, 1, 2)), ("c", "z", "Swim", dt.date(2024, 1, 2)), ("d", "n", "Ride", dt.date(2024, 1, 2)), ("e", "n", "Ride", dt.date(2023, 1, 2))], "id string, name string, type string, date date")
    seen = now.filter("id in ('a', 'b', 'c')").withColumn("fingerprint", collect.fingerprint(F.col("name")))
    todo = collect.second_service_todo(now, seen, spark.createDataFrame([("c",)], "id string"), ["name"], dt.date(2024, 1, 1))
    assert sorted(r.id for r in todo.collect()) == ["b", "d"]

    asked = []
    rows = services.daily_fitness(client(lambda p, q: (asked.append(dict(q)), [{"id": "2024-01-01"}])[1]), "w", dt.date(2024, 2, 5))
    assert asked == [{"oldest": "2023-01-01", "newest": "2024-02-06"}]
    with pytest.raises(ValueError):
        services.daily_fitness(client(lambda p, q: []), "w", dt.date(2024, 2, 5))
    path = tmp_path / "deep" / "w.json"
    services.replace_file(path, "old")
    services.replace_file(path, json.dumps(rows))
    assert json.loads(path.read_text()) == rows and stat.S_IMODE(path.stat().st_mode) == 0o600 and [p.name for p in path.parent.iterdir()] == ["w.json"]


def test_second_service_activities(spark):
    schema = "id string, type string, start_date string, start_date_local string, icu_joules double, power_meter boolean, gear_id string, trainer boolean, external_id string, icu_average_watts double, max_altitude double, latlng array<array<double>>, watts array<long>"
    rows = [("i12", "Ride", "2024-01-01T00:00:00Z", "2024-01-01T09:00:00", 5e5, None, "g", None, "e", 200.0, 30.0, [None, [1.0, 2.0], [3.0, 4.0], None], [None]), ("i13", "VirtualRide", None, None, None, None, None, None, "", None, None, [], None)]
    a, b = normalise.activities(spark.createDataFrame(rows, schema)).orderBy("id").collect()
    assert (a.id, a.utc_offset, a.kilojoules, a.device_watts, a.external_id, a.start_latlng, a.end_latlng, a.average_watts, a.elev_high, a.trainer, a.start_date_local) == (10**12 + 12, 32_400.0, 500.0, True, "garmin:e", [1.0, 2.0], [3.0, 4.0], 200.0, 30.0, False, "2024-01-01T09:00:00Z")
    assert (b.utc_offset, b.kilojoules, b.device_watts, b.external_id, b.start_latlng, b.trainer, b.name) == (None, None, False, None, [], True, None)


def test_waiting_for_the_service(spark):
    docs = {1: {"type": "Ride", "description": " ".join(gold.SERVICE_WORDS)}, 2: {"type": "Ride", "description": None}, 3: {"type": "Swim"}, 4: 404}
    c = client(lambda p, q: docs[int(p.split("/")[1])])
    waits = services.waits_for_text(gold.SERVICE_WORDS, ("Ride",), "duck")
    assert services.ready(c, "a", [1, 3, 4], waits) and not services.ready(c, "a", [1, 2], waits) and not waits({"type": "Ride", "description": "DUCK says"})
    acts = spark.createDataFrame([(i, {"Ride": "cycling", "Swim": "swimming"}[d["type"]], d.get("description")) for i, d in docs.items() if d != 404], "activity_id long, sport string, description string")
    assert [r.activity_id for r in gold.awaiting_service(acts).collect()] == [2]


def test_deliveries(spark):
    analyses = spark.createDataFrame([(i, dt.date(2024, 1, 10 - i)) for i in range(1, 7)], "activity_id long, activity_date date")
    d = coach.opened(analyses)
    assert coach.next_delivery(d, analyses).first().activity_id == 6 and coach.opened(analyses, False).filter("state <> 'suppressed'").count() == 0
    d = coach.sending(d, analyses.filter("activity_id < 6"))
    d = coach.delivered(d, spark.createDataFrame([(1, 204), (2, 404), (3, 500), (4, None), (5, 302), (6, 200)], "activity_id long, status int"))
    assert {r.activity_id: r.state for r in d.collect()} == {1: "sent", 2: "failed", 3: "unknown", 4: "unknown", 5: "unknown", 6: "pending"}
    again = coach.sent_again(d, analyses.filter("activity_id in (1, 2, 3)"))
    assert {r.activity_id: (r.state, r.error) for r in again.collect() if r.activity_id < 5} == {1: ("sent", None), 2: ("pending", None), 3: ("pending", None), 4: ("unknown", "status unknown")}
    jobs = spark.createDataFrame([(1, "pending", 1), (2, "failed", 5), (3, "done", 2), (4, "pending", 0)], "activity_id long, state string, tries int")
    assert [r.activity_id for r in coach.alerts_due(jobs, spark.createDataFrame([(2,)], "activity_id long")).collect()] == [1]


def test_migration(spark):
    schema = "activity_id long, athlete_id long, analysis string"
    legacy = spark.createDataFrame([(1, 7, "a"), (2, 7, "b"), (3, 7, None)], schema)
    now = spark.createDataFrame([(2, 7, "b")], schema).withColumn("sport", F.lit("swimming"))
    whole = handoff.migrated(now, legacy)
    assert whole.count() == 3 and handoff.migration_faults(legacy, whole).count() == 0
    bad = spark.createDataFrame([(1, 7, "x"), (2, 8, "b")], schema)
    assert {r.activity_id: r.fault for r in handoff.migration_faults(legacy, bad).collect()} == {1: "text", 2: "owner", 3: "missing"}


def test_preview(spark):
    good = lambda i, run="r": json.dumps({"version": 1, "run": run, "activity": {"activity_id": i, "sport": "running"}, "context": []})
    rows = [("out/1.json", good(1)), ("2.json", good(3)), ("4.json", good(4, "old")), ("5.json", good(5).replace('"version": 1', '"version": 2')), ("6.json", "no"), ("x/1.json", good(1))]
    got = {r.file: (r.status, r.fault) for r in handoff.preview(spark.createDataFrame(rows, "file string, bundle string"), "r").collect()}
    assert got["out/1.json"] == ("queued", None) and got["x/1.json"] == ("already_queued", None) and got["2.json"][1] == "file name" and got["4.json"][1] == "another run" and got["5.json"][1] == "version" and got["6.json"][1]


def test_pacing_reports(spark):
    metas = spark.createDataFrame([(1, "long | one", dt.date(2024, 1, 2), "g", 12_000), (2, "short", dt.date(2024, 1, 3), None, 100)], "activity_id long, name string, activity_date date, gear_id string, moving_time long")
    found = spark.createDataFrame([(1, None), (2, None)], "activity_id long, rejection string")
    assert pacing.target(metas, found).first().activity_id == 1 and pacing.target(metas, found, 2).first().activity_id == 2 and pacing.target(metas, found, 9).count() == 0
    compared = spark.createDataFrame([(1, 9000, 9300, 180.0, 200.0, -10.0, [(5.0, 3, 0, 200.0)])], "activity_id long, start_s long, end_s long, avg_watts double, reference_watts double, change_pct double, references array<struct<apart_m:double,r_activity_id:long,r_start_s:long,r_avg_watts:double>>")
    early = spark.createDataFrame([(1, 60, 120, 30, 300.0, 18.0)], "activity_id long, start_s long, end_s long, above_s long, avg_watts double, recorded_kj double")
    quality = spark.createDataFrame([(1, 12_000, 0.99)], "activity_id long, span long, power_coverage double")
    assert {r.activity_id: (r.comparison_count, r.status) for r in pacing.statuses(metas, metas.filter("activity_id = 1"), compared).collect()} == {1: (1, "observations_available"), 2: (0, "no_eligible_ride")}
    assert pacing.statuses(metas.limit(1), metas, compared.limit(0)).first().status == "no_comparable_segments"
    data = report.pacing_evidence(metas, metas.filter("activity_id = 1"), compared, early, quality, 250.0)
    back = json.loads(report.pacing_json(data))
    assert back["status"] == "observations_available" and back["comparison_count"] == 1 and back["target"]["activity_date"] == "2024-01-02"
    text = report.pacing_markdown(data)
    assert "| 2:30 to 2:35 | 180 | 200 | -10.0 | 1 earlier |" in text and "long / one" in text and "anchors" not in report.pacing_json(data) and '"lat"' not in report.pacing_json(data)
    assert "<td>-10.0</td>" in report.pacing_html(data) and "0:01 to 0:02: 300 W" in report.pacing_html(data)
    none = report.pacing_evidence(metas, metas.limit(0), compared, early, quality)
    assert none["status"] == "no_eligible_ride" and report.QUESTIONS["no_eligible_ride"] in report.pacing_html(none) and "Next" in report.pacing_markdown(none)
    alone = report.pacing_evidence(metas, metas.filter("activity_id = 2"), compared, early, quality)
    assert alone["status"] == "no_comparable_segments" and len(alone["limitations"]) == len(report.LIMITS) + 1


def test_overview_and_charts(spark):
    silver = spark.createDataFrame([(1, "cycling", dt.date(2024, 1, 1), 30.0, 1.0, 100.0, False, None, "a"), (2, "cycling", dt.date(2024, 1, 1), 29.0, 1.0, 90.0, True, 1, "b")], "activity_id long, sport string, activity_date date, distance_km double, moving_h double, elev_m double, is_duplicate boolean, duplicate_of_activity_id long, name string")
    fitness = spark.createDataFrame([(dt.date(2024, 1, 1), 50.0, 61.0, -11.0), (dt.date(2023, 12, 31), None, 60.0, None)], "fitness_date date, ctl double, atl double, form double")
    text = report.overview(silver, {"mart_sport_totals": gold.mart_sport_totals(silver.filter("not is_duplicate")), "mart_fitness_daily": fitness}, spark.range(1).select(F.lit(250.0).alias("ftp")), dt.date(2024, 1, 2))
    assert [x for x in text.split("\n") if x.startswith("## ")] == ["## 0. Now", *[f"## {t}" for t, _ in report.SECTIONS]]
    assert "form -11 on 2024-01-01" in text and "| cycling | 1 | 30.0 | 1.0 | 100.0 |" in text and "| 2024-01-01 | cycling | b | 29.0 | 1 |" in text and "Threshold power: 250 W" in text
    assert report.load_sentence(fitness.limit(0)) == ""
    assert report.bars_svg(fitness, "fitness_date", "atl").count("<rect") == 2
    lines = report.lines_svg(fitness, "fitness_date", ["ctl", "atl"])
    assert lines.count("<path") == 2 and lines.count("L") == 1 and report.lines_svg(fitness.limit(0), "fitness_date", ["ctl"]).endswith("/>")
    with pytest.raises(ValueError, match="aggregate"):
        report.bars_svg(spark.range(100).withColumn("v", F.lit(1.0)), "id", "v")


def test_build_policy(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    frames = build.build(store, {"stg_a": lambda f: f["a"].filter("id > 1"), "int_b": lambda f: f["stg_a"].withColumn("x", F.rand()), "mart_c": lambda f: f["int_b"].select("x")}, {"a": spark.range(5)})
    assert sorted(r.x for r in frames["int_b"].collect()) == sorted(r.x for r in frames["mart_c"].collect()) and store.version("gold/int_b") == 1 and store.version("gold/stg_a") is None
    with pytest.raises(ValueError, match="no policy"):
        build.policy("other_x")
