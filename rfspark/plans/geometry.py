"""Registered queries of geometry, bands and ladders."""

from __future__ import annotations

from pyspark.sql import functions as F

from rfspark.operators import geometry as g
from rfspark.plans.views import BAND, PKT, bands, packets, table

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return keep


@query(
    "m2_sdk_packet_geometry",
    """WITH s AS (SELECT event_id, value * 1000000 - 5000000 AS start, (event_id % 11 - 1) * 1e6::DOUBLE AS rate,
    CASE event_id % 4 WHEN 0 THEN (event_id % 11 - 1) * 1e6::DOUBLE WHEN 1 THEN (event_id % 11 - 1) * 8e5::DOUBLE WHEN 2 THEN 12e6::DOUBLE ELSE -1.0::DOUBLE END AS span FROM events),
b AS (SELECT *, CASE WHEN rate > 0 AND span > 0 AND span <= rate THEN span END AS bw FROM s)
SELECT event_id, CASE WHEN rate > 0 THEN rate ELSE -1.0::DOUBLE END AS rate_hz, coalesce(bw, -1.0::DOUBLE) AS bandwidth_hz,
  CASE WHEN start + bw / 2 >= 0 THEN start + bw / 2 ELSE -1.0::DOUBLE END AS center_hz FROM b""",
)
def sdk_geometry(spark, sf):
    n = (F.col("event_id") % 11 - 1).cast("double")
    m = F.col("event_id") % 4
    s = table(spark, sf, "events").select(
        "event_id",
        (F.col("value") * 1000000 - 5000000).alias("start"),
        (n * 1e6).alias("rate"),
        F.when(m == 0, n * 1e6).when(m == 1, n * 8e5).when(m == 2, 12e6).otherwise(-1.0).alias("span"),
    )
    out = g.with_iq_geometry(s)
    return out.select(
        "event_id",
        F.coalesce("sample_rate_hz", F.lit(-1.0)).alias("rate_hz"),
        F.coalesce("bandwidth_hz", F.lit(-1.0)).alias("bandwidth_hz"),
        F.coalesce("center_frequency_hz", F.lit(-1.0)).alias("center_hz"),
    )


@query(
    "m3_band_join",
    f"""WITH {PKT}, {BAND} SELECT seq, band FROM pkt JOIN band ON center_hz + seq % 1000 * 50000 BETWEEN band_start AND band_end""",
)
def band_join(spark, sf):
    p = packets(spark, sf).select("seq", (F.col("center_hz") + F.col("seq") % 1000 * 50000).alias("hz"))
    return g.band_join(p, bands(spark, sf), 2_000_000).select("seq", "band")


@query(
    "m3_targets_in_packets",
    f"""WITH {PKT}, s AS (SELECT seq, center_hz - rate_hz // 2 AS lo, center_hz + rate_hz // 2 AS hi FROM pkt),
tg AS (SELECT s_suppkey, 2380000000 + s_suppkey * 1500000 AS hz FROM supplier)
SELECT s_suppkey, count(*) AS packets, CAST(sum(seq) AS BIGINT) AS seq_sum FROM s JOIN tg ON tg.hz >= s.lo AND tg.hz <= s.hi GROUP BY 1""",
)
def targets_in_packets(spark, sf):
    half = F.floor(F.col("rate_hz") / 2).cast("long")
    p = packets(spark, sf).select(
        "seq", (F.col("center_hz") - half).alias("start_hz"), (F.col("center_hz") + half).alias("end_hz")
    )
    targets = table(spark, sf, "supplier").select(
        "s_suppkey", (F.lit(2380000000) + F.col("s_suppkey") * 1500000).alias("target_hz")
    )
    hits = g.span_contains_join(p, targets, 20_000_000)
    return hits.groupBy("s_suppkey").agg(F.count("*").alias("packets"), F.sum("seq").alias("seq_sum"))


@query(
    "m4_rate_ladders",
    """WITH c AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 92160000.0 WHEN 1 THEN 245760000.0 WHEN 2 THEN 46080000.0 ELSE 0.0 END::DOUBLE AS clock,
  s_suppkey % 70 AS rungs FROM supplier)
SELECT s_suppkey, CAST(n AS INTEGER) AS rung, clock / 1.5::DOUBLE / pow(2.0::DOUBLE, n) AS rate_hz FROM c, (SELECT unnest(range(0, 64)) AS n)
WHERE n < rungs AND clock > 0""",
)
def ladders(spark, sf):
    m = F.col("s_suppkey") % 4
    clock = F.when(m == 0, 92160000.0).when(m == 1, 245760000.0).when(m == 2, 46080000.0).otherwise(0.0)
    return table(spark, sf, "supplier").select(
        "s_suppkey", F.posexplode(g.ladder(g.clock_top(clock), F.col("s_suppkey") % 70)).alias("rung", "rate_hz")
    )


RUNGS = "(SELECT n, 61440000.0::DOUBLE / pow(2.0::DOUBLE, n) AS r FROM (SELECT unnest(range(0, 10)) AS n))"


@query(
    "m5_nearest_rung",
    f"""WITH q AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN -1.0::DOUBLE ELSE o_totalprice * 150 END AS req FROM orders)
SELECT o_orderkey, CASE WHEN req <= 0 THEN 120000.0::DOUBLE ELSE arg_min(r, (abs(r - req), n)) END AS rung_hz,
  CAST(CASE WHEN req <= 0 THEN 9 ELSE arg_min(n, (abs(r - req), n)) END AS INTEGER) AS rung FROM q, {RUNGS} GROUP BY o_orderkey, req""",
)
def nearest(spark, sf):
    q = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 17 == 0, -1.0).otherwise(F.col("o_totalprice") * 150).alias("req")
    )
    return g.with_rung(q, F.col("req")).select("o_orderkey", "rung_hz", "rung")


@query(
    "m5_rung_for_bandwidth",
    f"""WITH q AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN -1.0::DOUBLE ELSE o_totalprice * 150 END AS req FROM orders),
w AS (SELECT o_orderkey, CASE WHEN req <= 0 THEN 120000.0::DOUBLE ELSE coalesce(min(r) FILTER (r >= req / 0.8::DOUBLE), 61440000.0::DOUBLE) END AS rung_hz
  FROM q, {RUNGS} GROUP BY o_orderkey, req)
SELECT o_orderkey, rung_hz, CAST(round(log2(61440000.0::DOUBLE / rung_hz)) AS INTEGER) AS rung FROM w""",
)
def for_bandwidth(spark, sf):
    q = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 17 == 0, -1.0).otherwise(F.col("o_totalprice") * 150).alias("req")
    )
    return g.with_rung(q, F.col("req"), "bandwidth").select("o_orderkey", "rung_hz", "rung")


@query(
    "m6_snap_to_ladder_top",
    f"""WITH c AS (SELECT unnest([46080000, 61440000, 76800000, 92160000, 122880000, 184320000, 245760000, 491520000]::DOUBLE[]) / 1.5::DOUBLE AS top),
q AS (SELECT o_orderkey, o_totalprice * 500 AS m FROM orders)
SELECT o_orderkey, coalesce(min(top) FILTER (abs(m - top) / top <= 0.01::DOUBLE), -1.0::DOUBLE) AS top_hz FROM q, c GROUP BY 1""",
)
def snap(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.coalesce(g.snap_to_top(F.col("o_totalprice") * 500), F.lit(-1.0)).alias("top_hz")
    )
