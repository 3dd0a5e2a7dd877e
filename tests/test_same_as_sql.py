"""Queries against their SQL on tables that the small ones do not look like."""

import os
import shutil

import duckdb
import pytest

from rfspark.plans import registry
from tools.check import TABLES, norm

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def changed(folder, table, sql):
    """The small tables with one of them made by ``sql`` from itself, ``t``."""
    for name in TABLES:
        if name != table:
            shutil.copy(f"{SF}/{name}.parquet", folder)
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    con.execute(f"CREATE VIEW t AS SELECT * FROM '{SF}/{table}.parquet'")
    con.execute(f"COPY ({sql}) TO '{folder}/{table}.parquet'")
    return str(folder)


def both(spark, name, folder):
    """Sorted rows of a query and of its SQL."""
    df = registry.queries()[name](spark, folder)
    columns = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    cur = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda k: names[k])
    want = sorted((tuple(norm(r[k]) for k in order) for r in cur.fetchall()), key=repr)
    assert sorted(names) == columns and len(got) > 0
    return got, want


def test_dumps_of_events_past_four_hex_digits(spark, tmp_path):
    folder = changed(tmp_path, "events", "SELECT * REPLACE (event_id + 65500 AS event_id) FROM t")
    got, want = both(spark, "s4_stream_dumps", folder)
    assert got == want


def test_averages_that_lie_between_two_steps(spark, tmp_path):
    """Eight frames of hundredths: their average can end in a half of the last digit."""
    sql = """SELECT vec_id, [CAST(((vec_id * 37 + k * 101 + vec_id * k * 13) % 9973 - 5000) / 10000.0 AS FLOAT) FOR k IN range(64)] AS embedding, CAST(vec_id % 50 // 8 AS INTEGER) AS label
FROM (SELECT unnest(range(2000)) AS vec_id)"""
    folder = changed(tmp_path, "embeddings", sql)
    got, want = both(spark, "p1_trace_of_frames", folder)
    assert got == want
    # The rule in whole numbers.
    levels = duckdb.sql(f"""WITH w AS (SELECT label AS s, vec_id // 50 AS w, k AS bin, CAST(floor(embedding[k+1]::DOUBLE * 10000 + 0.5) AS BIGINT) AS v
  FROM '{folder}/embeddings.parquet', (SELECT unnest(range(64)) AS k)) SELECT s, w, bin, sum(v), count(*) FROM w GROUP BY 1, 2, 3""").fetchall()
    exact = {(s, w, b): (200 * int(v) + n) // (2 * n) for s, w, b, v, n in levels}
    shown = {(r.stream_id, r.window, r.bin): r.average for r in registry.queries()["p1_trace_of_frames"](spark, folder).collect()}
    assert shown == exact and any((200 * int(v)) % (2 * n) == n for *_, v, n in levels)


def test_lags_in_whole_units_do_not_depend_on_order(spark):
    from pyspark.sql import functions as F

    from rfspark.operators import blocks as bl
    from rfspark.plans.blocks import LAG_UNIT, _lag_pairs

    pairs = _lag_pairs(spark, SF)
    sums = []
    for df in (pairs.coalesce(1), pairs.repartition(5, F.xxhash64("ai"))):
        rows = bl.correlate(df, 8, LAG_UNIT).groupBy("pair", "lag").agg(F.sum("re"), F.sum("im"))
        sums.append(sorted(tuple(r) for r in rows.collect()))
    assert sums[0] == sums[1] and isinstance(sums[0][0][2], int)
    near = {(r.pair, r.lag): (r.re, r.im) for r in bl.correlate(pairs, 8).groupBy("pair", "lag").agg(F.sum("re").alias("re"), F.sum("im").alias("im")).collect()}
    assert all(abs(re * LAG_UNIT - near[p, d][0]) < 1e-5 and abs(im * LAG_UNIT - near[p, d][1]) < 1e-5 for p, d, re, im in sums[0])


def test_of_equal_lags_the_shortest_and_lower_is_taken(spark, tmp_path):
    """One loud sample at either end of a block: lag 0 alone is strongest; silence has every lag equal."""
    sql = "SELECT vec_id, [CAST(0 AS FLOAT) FOR k IN range(64)] AS embedding, label FROM t"
    got, want = both(spark, "r8_best_lag", changed(tmp_path, "embeddings", sql))
    assert got == want and all(row[0] == 0 for row in got)
    rows = [(1, d, 3 if abs(d) == 2 else 0, 0) for d in range(-4, 5)]
    from rfspark.operators import blocks as bl

    assert bl.best_lag(spark.createDataFrame(rows, "pair long, lag int, re long, im long")).first().lag == -2


def test_best_lag_equals_its_sql(spark):
    got, want = both(spark, "r8_best_lag", SF)
    assert got == want


@pytest.mark.parametrize("sql", [
    "SELECT * REPLACE (o_orderkey - 700 AS o_orderkey, o_custkey % 20 AS o_custkey) FROM t",
    "SELECT * REPLACE (o_custkey % 20 AS o_custkey) FROM t UNION ALL SELECT * REPLACE (o_custkey % 20 AS o_custkey) FROM t WHERE o_orderkey % 3 = 0",
    "SELECT * REPLACE (nullif(o_orderkey, 40) AS o_orderkey, nullif(o_custkey % 20, 3) AS o_custkey) FROM t",
], ids=["keys to and below zero", "orders listed twice", "no key"])
def test_links_over_odd_orders(spark, tmp_path, sql):
    got, want = both(spark, "m9_follow_links", changed(tmp_path, "orders", sql))
    assert got == want and len(got) == len(set(got))
