"""Every query against DuckDB on the smallest tables."""

import duckdb
import pytest

from veloframe.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def plain(rows):
    return sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows], key=str)


@pytest.fixture(scope="session")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES.split():
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_against_sql(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    sql = duck.sql(catalog.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(sql.columns)
    kinds = dict(zip(sql.columns, map(str, sql.types), strict=True))
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    at = [sql.columns.index(c) for c in columns]
    assert plain(tuple(r[c] for c in columns) for r in df.collect()) == plain(tuple(r[i] for i in at) for r in sql.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_greedy_against_loop(spark, sf):
    rows = spark.read.parquet(f"{sf}/events.parquet").select("user_id", "ts").collect()
    import datetime as dt

    kept, last = set(), {}
    for r in sorted(rows):
        if r.user_id not in last or r.ts >= last[r.user_id]:
            kept.add((r.user_id, r.ts))
            last[r.user_id] = r.ts + dt.timedelta(days=1)
    assert {(r.user_id, r.start) for r in catalog.QUERIES["greedy_non_overlap"](spark, sf).collect()} == kept


def against(spark, d, name):
    """A query's rows and its SQL's on the tables of a folder."""
    c = duckdb.connect()
    for path in d.glob("*.parquet"):
        c.sql(f"create view {path.stem} as select * from '{path}'")
    df = catalog.QUERIES[name](spark, str(d))
    sql = c.sql(catalog.ORACLE_SQL[name])
    at = [sql.columns.index(x) for x in df.columns]
    return plain(map(tuple, df.collect())), plain(tuple(r[i] for i in at) for r in sql.fetchall())


@pytest.fixture
def edges(tmp_path):
    """A ride with stamps within half a second of a bound of the points' seconds, before 2024 too, and ties of a half."""
    c = duckdb.connect()
    c.sql(f"""copy (select 1::bigint as o_orderkey, 2::bigint as o_custkey, 'F' as o_orderstatus, 1000.0::double as o_totalprice, timestamp '2001-07-14' as o_orderdate, 'x' as o_orderpriority) to '{tmp_path}/orders.parquet'""")
    c.sql(f"""copy (select i::bigint as event_id, timestamp '2024-01-01' + to_microseconds(us::bigint) as ts, 1::bigint as user_id, 'view' as event_type, v::double as value, '{{}}' as props
    from (values (0, -600600000, 50), (1, -599500000, 70), (2, 0, 900), (3, 1000000, 20), (4, 599600000, 90), (5, 600500000, 11), (6, 18599700000, 200), (7, 72599600000, 300), (8, 72600500000, 500), (9, 90000000000, 40)) t(i, us, v)) to '{tmp_path}/events.parquet'""")
    return tmp_path


def test_ride_power_rounds_seconds_as_its_sql(spark, edges):
    ours, theirs = against(spark, edges, "mart_ride_power")
    assert len(ours) == 1 and ours == theirs


def test_ride_durability_rounds_seconds_as_its_sql(spark, edges):
    ours, theirs = against(spark, edges, "mart_ride_durability")
    assert len(ours) == 1 and ours == theirs


def test_power_curve_rounds_seconds_as_its_sql(spark, edges):
    """The third stamp is 121 seconds behind the first, and only cut down to 120 would it be in one window with it."""
    duckdb.connect().sql(f"""copy (select i::bigint as event_id, timestamp '2024-01-01' + to_microseconds(us::bigint) as ts, 1::bigint as user_id, 'view' as event_type, v::double as value, '{{}}' as props
    from (values (0, 0, 100), (1, 600000000, 100), (2, 72599600000, 400), (3, 600000000000, 5), (4, 600600000000, 5), (5, 601200000000, 5)) t(i, us, v)) to '{edges}/events.parquet'""")
    ours, theirs = against(spark, edges, "int_power_curve_ride")
    assert len(ours) > 0 and ours == theirs
