import gzip
import json

from pyspark.sql import functions as F

from veloframe.sources import files, listing, normalise


def test_activities_and_children(spark, tmp_path):
    (tmp_path / "2024-01-01_1.json").write_text(json.dumps({"id": 1, "name": "r", "type": "Ride", "start_date": "2024-01-01T08:00:00Z", "start_date_local": "2024-01-01T09:00:00Z", "start_latlng": [], "laps": None, "splits_metric": [{"split": 1, "distance": 1000.0, "moving_time": 200}]}))
    (tmp_path / "2024-01-02_2.json").write_text(json.dumps({"id": 2, "start_latlng": [1.5, 2.5], "laps": [{"id": 7, "distance": 0.0}, {"id": 8, "distance": 50.0}]}))
    (tmp_path / "2024-01-03_x.json").write_text('{"name": "no id"}')
    docs = files.activity_documents(spark, [f"{tmp_path}/*.json", f"{tmp_path}/none/*.json"])
    got = {r.activity_id: r for r in files.activities(docs, "2024-02-01 00:00:00").collect()}
    assert set(got) == {1, 2}
    assert got[1].start_lat is None and got[1].lap_count == 0 and got[1].split_count == 1 and str(got[1].start_date_key) == "2024-01-01"
    assert (got[2].start_lat, got[2].start_lon, got[2].lap_count) == (1.5, 2.5, 2) and got[2].start_ts_utc is None
    assert sorted((r.activity_id, r.lap_id) for r in files.children(docs, "laps").collect()) == [(2, 7), (2, 8)]
    assert files.children(docs, "splits_metric").count() == 1
    assert files.activity_documents(spark, [f"{tmp_path}/none/*.json"]).count() == 0


def test_streams_keep_short_channels_missing(spark, tmp_path):
    doc = {"activity_id": 5, "date": "2024-01-01", "streams": {"time": {"data": [0, 1, 2]}, "watts": {"data": [0, None]}, "latlng": {"data": [[1.0, 2.0], None, []]}}}
    with gzip.open(tmp_path / "2024-01-01_5.json.gz", "wt") as f:
        f.write(json.dumps(doc))
    docs = files.stream_documents(spark, [f"{tmp_path}/*.json.gz"])
    got = [(r.point_idx, r.time_offset_s, r.watts, r.lat, r.heartrate, r.moving) for r in files.stream_points(docs).orderBy("point_idx").collect()]
    assert got == [(0, 0, 0, 1.0, None, None), (1, 1, None, None, None, None), (2, 2, None, None, None, None)]
    assert files.expected_stream_points(docs).first().points == 3


GPX = """<?xml version="1.0"?><gpx xmlns="http://www.topografix.com/GPX/1/1" xmlns:x="http://www.garmin.com/xmlschemas/TrackPointExtension/v1"><trk><trkseg>
<trkpt lat="1.0" lon="2.0"><ele>3.5</ele><time>2024-01-01T00:00:00Z</time><extensions><x:TrackPointExtension><x:hr>120</x:hr><x:cad>80</x:cad></x:TrackPointExtension></extensions></trkpt>
<trkpt lon="2.0"><time>2024-01-01T00:00:01Z</time></trkpt><trkpt lat="1.1" lon="2.1"/></trkseg></trk></gpx>"""


def test_gpx(spark, tmp_path):
    (tmp_path / "2024-01-01_9.gpx").write_text(GPX)
    (tmp_path / "mine.gpx").write_text(GPX)
    (tmp_path / "2024-01-02_10.gpx").write_text("<gpx><broken>")
    got = files.gpx_points(spark, [f"{tmp_path}/*.gpx"])
    assert sorted((r.activity_id or 0, r.origin, r.point_idx, r.lat, r.heartrate) for r in got.collect()) == [(0, "manual_drop", 0, 1.0, 120), (0, "manual_drop", 2, 1.1, None), (9, "sync", 0, 1.0, 120), (9, "sync", 2, 1.1, None)]
    counts = {r.uri.rsplit("/", 1)[1]: r.points for r in listing.expected_points(spark, str(tmp_path), "*.gpx").collect()}
    assert counts == {"2024-01-01_9.gpx": 3, "mine.gpx": 3, "2024-01-02_10.gpx": 0}


def test_plan(spark):
    now = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "uri string, mtime int")
    old = spark.createDataFrame([("b", 2), ("c", 1), ("d", 1)], "uri string, mtime int")
    assert {r.uri: r.state for r in listing.plan(now, old).collect()} == {"a": "new", "b": "unchanged", "c": "changed", "d": "deleted"}


def test_markdown_logs(spark, tmp_path):
    log = tmp_path / "ftp.md"
    log.write_text('## 현재값\n지금 **200 W**\n\n| date | ftp | wkg | method | conf |\n|---|---|---|---|---|\n| 2024-01-01 | 200 | 3.1 | "test" | high |\n| 2024-03-01 | 200 | n/a | x | low |\n| 2023 | 180 | 3 | x | low |\n| 2024-02-01 | 190 | 3 | x | low |\n')
    got = {str(r.effective_date): (r.ftp_watts, r.w_per_kg, r.method, r.is_current) for r in files.ftp_log(spark, str(log)).collect()}
    assert got == {"2024-01-01": (200, 3.1, "test", False), "2024-03-01": (200, None, "x", True), "2024-02-01": (190, 3.0, "x", False)}
    body = tmp_path / "log.md"
    body.write_text("| 2024-01-01 | ride |  | knee | L | 3 |  |  | 1 |  | m |\n")
    rows = files.symptom_log(spark, str(body), {"area": ["knee"], "side": ["L", "R"]}, {"ride": "cycling"}).collect()
    assert [(r.sport, r.activity_id, r.severity, r.next_day) for r in rows] == [("cycling", None, 3, 1)]
    body.write_text("| 2024-01-01 | ride |  | knee | L | 11 |  |  | 1 |  | m |\n")
    import pytest

    with pytest.raises(Exception, match="severity"):
        files.symptom_log(spark, str(body), {"area": ["knee"]}, {"ride": "cycling"}).collect()
    changes = tmp_path / "changes.md"
    changes.write_text("| 2024-01-01 | bike | saddle | L | 1 | 2 | done | s | m |\n| later | bike | saddle | L | 1 | 2 | done | s | m |\n| 2024-01-01 | short |\n")
    assert [(r.status, r.side) for r in files.fitting_changes(spark, str(changes), {"done": "applied"}).collect()] == [("applied", "L")]
    assert files.fitting_changes(spark, str(tmp_path / "none.md"), {"done": "applied"}).count() == 0


def test_wellness_and_seed(spark, tmp_path):
    w = tmp_path / "w.json"
    w.write_text(json.dumps([{"id": "2024-01-01", "ctl": 50.128, "sportInfo": [{"type": "Run", "eftp": 1.0}, {"type": "Ride", "eftp": 252.5}]}, {"id": "2024-01-02", "ctl": None}]))
    assert [(str(r.fitness_date), r.ctl, r.ride_eftp) for r in files.wellness(spark, str(w)).orderBy("fitness_date").collect()] == [("2024-01-01", 50.13, 253.0), ("2024-01-02", None, None)]
    (tmp_path / "s.csv").write_text("a,b\n1,\n")
    assert [tuple(r) for r in files.seed(spark, str(tmp_path / "s.csv"), "a int, b string").collect()] == [(1, None)]


def test_normalisers(spark):
    df = spark.createDataFrame([("i42", [1.0, None, 3.0], [4.0, 5.0], [0.4, None, 0.6], [1.5, None, 2.5])], "id string, a array<double>, b array<double>, v array<double>, n array<double>")
    r = df.select(normalise.activity_id(F.col("id")).alias("i"), normalise.paired(F.col("a"), F.col("b")).alias("p"), normalise.in_motion(F.col("v")).alias("m"), normalise.rounded(F.col("n")).alias("n")).first()
    assert (r.i, r.p, r.m, r.n) == (10**12 + 42, [[1.0, 4.0], None, None], [False, None, True], [2, None, 2])
    points = spark.createDataFrame([(1, i, 10.0 * i, 100.0 + i) for i in range(6)] + [(1, 6, None, 1.0)], "k int, i int, d double, h double")
    got = {x.i: x.grade_pct for x in normalise.grade(points, "k", "i", "d", "h").collect()}
    assert got == {0: 0.0, 1: 10.0, 2: 10.0, 3: 10.0, 4: 10.0, 5: 10.0, 6: None}
