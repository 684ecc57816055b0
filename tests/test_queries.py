"""Every query against its SQL in DuckDB on the small tables."""

import duckdb
import pytest

from docmill.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, bool | str):
        return str(v)
    return repr(round(float(v), 6))


def rows(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(names, cur.fetchall())


def against_sql(spark, con, folder, name, table, values, schema):
    """The query's and its SQL's rows over one table of these rows."""
    spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    cur = con.cursor().execute(f"CREATE OR REPLACE TEMP VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'").execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    df = QUERIES[name](spark, str(folder))
    return rows(df.columns, df.collect()), rows(names, cur.fetchall())


@pytest.mark.parametrize("name", ["duration_words", "eta_words", "file_sizes"])
def test_odd_lengths(spark, tmp_path, name):
    lengths = [None, 0, 1, 15, 16, 61, 62, 3684, 3685, 16383, 16384, 368_475, 16_777_215, 16_777_216, 20_000_000, 3_000_000_000]
    got, want = against_sql(spark, duckdb.connect(), tmp_path, name, "documents", list(enumerate(lengths)), "doc_id long, n_chars long")
    assert got == want and len(got) == len(lengths)


def test_clusters_against_plain_python(spark):
    got = {}
    for r in QUERIES["cluster_rows"](spark, SF).collect():
        got.setdefault(r.s_nationkey, []).append((r.cluster, r.first, r.last, r.size))
    want = {}
    for r in sorted(spark.read.parquet(f"{SF}/supplier.parquet").collect(), key=lambda r: r.s_acctbal):
        own = want.setdefault(r.s_nationkey, [])
        if own and r.s_acctbal - own[-1][1] <= 1500.0:
            own[-1] = (own[-1][0], own[-1][1], r.s_acctbal, own[-1][3] + 1)
        else:
            own.append((len(own), r.s_acctbal, r.s_acctbal, 1))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["filter_eq"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "o_totalprice" not in plan.split("ReadSchema")[1]
    top = QUERIES["authoritative_attempt"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in top
