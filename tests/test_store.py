import pytest

from veloframe.store import Conflict, Store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions_and_rollback(spark, store):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert store.version("t") is None
    store.replace("t", a)
    store.append("t", spark.createDataFrame([(3, "c", 9)], "id int, v string, extra int"))
    assert rows(store.read("t").select("id", "extra")) == [(1, None), (2, None), (3, 9)] or {r.id: r.extra for r in store.read("t").collect()} == {1: None, 2: None, 3: 9}
    store.upsert("t", spark.createDataFrame([(2, "B"), (4, "d")], "id int, v string"), ["id"])
    assert {r.id: r.v for r in store.read("t").collect()} == {1: "a", 2: "B", 3: "c", 4: "d"}
    store.delete("t", spark.createDataFrame([(1,)], "id int"))
    assert store.read("t").count() == 3
    store.rollback("t", 1)
    assert rows(store.read("t")) == [(1, "a"), (2, "b")]
    assert [(r.version, r.operation, r.is_current) for r in store.history("t").orderBy("version").collect()] == [(1, "replace", True), (2, "append", False), (3, "upsert", False), (4, "delete", False)]
    assert store.files("t").count() > 0
    store.drop("t")
    assert store.version("t") is None


def test_source_keys_must_be_unique_or_dated(spark, store):
    twice = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "id int, v string, at int")
    store.upsert("t", twice, ["id"], newest="at")
    assert [r.v for r in store.read("t").collect()] == ["new"]
    with pytest.raises(Exception, match="two source rows"):
        store.upsert("u", twice, ["id"])


def test_audit(spark, store):
    a = spark.range(3)
    store.audit("bronze/x", "file", a, a.limit(2), "2024-01-01 00:00:00")
    store.audit("bronze/x", "file", a, a, "2024-01-02 00:00:00")
    from veloframe.plans import quality

    assert quality.reconciled(store.read("audit/ingest_runs")).count() == 0
    store.audit("bronze/x", "file", a, a.limit(1), "2024-01-03 00:00:00")
    assert [r.loaded_count for r in quality.reconciled(store.read("audit/ingest_runs")).collect()] == [1]


def test_append_writes_new_rows_alone(spark, store):
    store.replace("t", spark.createDataFrame([(1, "a", "x")], "id int, v string, day string"), partition_by=["day"])
    before = {r.path for r in store.files("t").select("path").collect()}
    store.append("t", spark.createDataFrame([(2, "b", "y", 9)], "id int, v string, day string, extra int"), partition_by=["day"])
    assert before < {r.path for r in store.files("t").select("path").collect()}
    assert {(r.id, r.v, r.day, r.extra) for r in store.read("t").collect()} == {(1, "a", "x", None), (2, "b", "y", 9)}
    store.append("t", spark.createDataFrame([(2**40, "c", "y")], "id long, v string, day string"), partition_by=["day"])
    assert store.read("t").schema["id"].dataType.typeName() == "long" and store.read("t").count() == 3
    assert store.read("t", 1).count() == 1
    store.append("t", spark.createDataFrame([], "id long, v string, day string"), partition_by=["day"])
    assert store.read("t").count() == 3


def test_writers_conflict_and_cut_off_entries(spark, store, tmp_path):
    a, b = (spark.createDataFrame([(i,)], "id int") for i in (1, 2))
    store.replace("t", a)
    seen = store._log("t")
    store.append("t", b)
    with pytest.raises(Conflict):
        store._replace("t", a, (), "replace", seen)
    assert rows(store.read("t")) == [(1,), (2,)]
    (tmp_path / "t" / "_log" / "3").write_text('{"what": "repl')
    assert store.version("t") == 2
    assert store.append("t", b) == 4 and rows(store.read("t")) == [(1,), (2,), (2,)]
    store.rollback("t", 1)
    assert store.append("t", b) == 6 and rows(store.read("t")) == [(1,), (2,)]


def test_append_goes_on_top_of_another_writers(spark, store, monkeypatch):
    one = spark.createDataFrame([(1,)], "id int")
    store.replace("t", one)
    commit, tries = store._commit, []

    def late(table, n, entry):
        tries.append(n)
        if len(tries) == 1:
            Store(store.spark, store.root).append(table, one)
        return commit(table, n, entry)

    monkeypatch.setattr(store, "_commit", late)
    store.append("t", one)
    assert tries == [2, 3] and store.read("t").count() == 3
