from pyspark.sql import functions as F

from veloframe.store import Store
from veloframe.streaming import feeds


def test_debounce_and_upsert(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [("a", f"2024-01-01 00:0{m}:00", v) for m, v in ((0, 1.0), (1, 2.0), (9, 3.0))] + [("z", "2024-01-02 00:00:00", 0.0)]
    spark.createDataFrame(rows, "k string, s string, v double").withColumn("ts", F.to_timestamp("s")).drop("s").write.json(src)
    stream = feeds.new_files(spark, src, "k string, ts timestamp, v double")
    q = feeds.debounced(stream, "k", "ts").writeStream.format("memory").queryName("due").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.k, r.n) for r in spark.table("due").collect()) == [("a", 1), ("a", 2)]
    store = Store(spark, str(tmp_path / "store"))
    for i in range(2):
        feeds.upsert_batches(feeds.new_files(spark, src, "k string, ts timestamp, v double"), store, "t", ["k"], "ts", str(tmp_path / f"c{i}")).awaitTermination(120)
    assert {r.k: r.v for r in store.read("t").collect()} == {"a": 3.0, "z": 0.0}
