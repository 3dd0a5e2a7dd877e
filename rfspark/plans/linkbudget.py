"""Registered queries of the link budget."""

from __future__ import annotations

from pyspark.sql import functions as F

from rfspark.operators import linkbudget as lb
from rfspark.plans.views import OBS, PKT, SEQ_BLOCK, arrivals, fixed, fx, packets, table

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return keep


FMT = "CASE event_type WHEN 'click' THEN 'int16' WHEN 'view' THEN 'float16' WHEN 'purchase' THEN 'float32' ELSE 'json' END"
WIDTH = "CASE event_type WHEN 'click' THEN 4 WHEN 'view' THEN 4 WHEN 'purchase' THEN 8 END"


@query(
    "l1_required_byte_rate",
    f"""SELECT event_id, coalesce(CASE WHEN value * 100000 - 1000 > 0 THEN (value * 100000 - 1000) * ({WIDTH}) END, -1.0::DOUBLE) AS need FROM events""",
)
def required(spark, sf):
    e = table(spark, sf, "events").select("event_id", (F.col("value") * 100000 - 1000).alias("rate_hz"), F.expr(FMT).alias("format"))
    out = lb.with_required_rate(e)
    return out.select("event_id", F.coalesce("required_byte_rate", F.lit(-1.0)).alias("need"))


@query(
    "l2_sustainable_rate",
    f"""WITH e AS (SELECT event_id, value * 5000000 AS m, {WIDTH} AS w, CASE WHEN event_id % 2 = 0 THEN 61440000.0 ELSE 163840000.0 END::DOUBLE AS top FROM events),
f AS (SELECT event_id, max(top / pow(2.0::DOUBLE, n)) FILTER (m > 0 AND top / pow(2.0::DOUBLE, n) * w <= m) AS fit FROM e, (SELECT unnest(range(0, 10)) AS n) GROUP BY 1)
SELECT event_id, coalesce(fit, -1.0::DOUBLE) AS fit_rate_hz, coalesce(fit * 0.8::DOUBLE, -1.0::DOUBLE) AS fit_bandwidth_hz FROM f""",
)
def sustainable(spark, sf):
    top = F.when(F.col("event_id") % 2 == 0, 61440000.0).otherwise(163840000.0)
    e = table(spark, sf, "events").select("event_id", (F.col("value") * 5000000).alias("byte_rate"), F.expr(FMT).alias("format"), top.alias("top"))
    out = lb.with_sustainable(e, F.col("top"))
    return out.select(
        "event_id",
        F.coalesce("fit_rate_hz", F.lit(-1.0)).alias("fit_rate_hz"),
        F.coalesce("fit_bandwidth_hz", F.lit(-1.0)).alias("fit_bandwidth_hz"),
    )


DAY = 86400000000
METER = (
    OBS
    + f""", mark AS (SELECT connection_id, arg_min(seq, ("at", seq)) FILTER ("at" - opened >= {DAY}) AS mseq,
    min("at") FILTER ("at" - opened >= {DAY}) AS mat FROM obs GROUP BY 1),
r AS (SELECT o.*, mat, coalesce("at" > mat OR ("at" = mat AND seq > mseq), false) AS after, coalesce("at" - mat < {10 * DAY}, false) AS near FROM obs o JOIN mark USING (connection_id)),
c AS (SELECT connection_id, max(mat) AS mat, min(opened) AS opened, bool_or(after AND NOT near) AS closed,
    CAST(coalesce(sum(bytes) FILTER (after AND near), 0) AS BIGINT) AS bytes, max("at") FILTER (after AND near) AS last,
    CAST(coalesce(sum(bytes) FILTER (NOT after), 0) AS BIGINT) AS settle_bytes, bool_or(after AND near AND channel_full) AS consumer_limited FROM r GROUP BY 1),
meter AS (SELECT *, CASE WHEN closed AND bytes > 0 AND last > mat AND (last - mat) * 2 >= {10 * DAY} THEN last - mat END AS span FROM c)"""
)


def _meter(spark, sf):
    return lb.throughput(arrivals(spark, sf), 86400, 864000, ticks=1e6)


@query(
    "l3_throughput",
    f"""WITH {METER} SELECT connection_id, closed, bytes, settle_bytes, consumer_limited, coalesce(mat - opened, -1) AS settle,
  coalesce(span, -1) AS span, coalesce({fx(f"bytes / (span / 1e6)", 4)}, -1) AS rate FROM meter""",
)
def throughput(spark, sf):
    return _meter(spark, sf).select(
        "connection_id",
        "closed",
        "bytes",
        "settle_bytes",
        "consumer_limited",
        F.coalesce("settle", F.lit(-1)).alias("settle"),
        F.coalesce("span", F.lit(-1)).alias("span"),
        F.coalesce(fixed(F.col("byte_rate"), 4), F.lit(-1)).alias("rate"),
    )


@query("l4_not_consumer_limited", f"WITH {METER} SELECT connection_id, bytes FROM meter WHERE NOT consumer_limited")
def not_limited(spark, sf):
    return lb.drop_consumer_limited(_meter(spark, sf)).select("connection_id", "bytes")


# One geometry per user and hour-of-day stands in for the runs of a connection.
RUNS = """runs AS (SELECT user_id AS connection_id, k // 25 AS epoch_id, CASE WHEN k < 50 THEN 50.0 ELSE 20.0 END::DOUBLE AS rate_hz,
  CASE WHEN k % 2 = 0 THEN 'int16' WHEN k % 5 = 0 THEN 'json' ELSE 'float32' END AS format FROM
  (SELECT user_id, min(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k FROM events GROUP BY user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) // 25))"""


@query(
    "l5_link_verdict",
    f"""WITH {METER}, {RUNS}, v AS (SELECT r.connection_id, r.epoch_id, rate_hz, CASE format WHEN 'int16' THEN 4 WHEN 'float32' THEN 8 END AS w, bytes / (span / 1e6) AS rate
  FROM meter m JOIN runs r USING (connection_id) WHERE span IS NOT NULL AND NOT consumer_limited),
j AS (SELECT connection_id, epoch_id, rate_hz * w AS need, rate < rate_hz * w * 0.98::DOUBLE AS short,
  max(rate_hz / pow(2.0::DOUBLE, n)) FILTER (rate_hz / pow(2.0::DOUBLE, n) * w <= rate) AS fit FROM v, (SELECT unnest(range(0, 10)) AS n) WHERE w IS NOT NULL GROUP BY connection_id, epoch_id, rate_hz, w, rate)
SELECT connection_id, epoch_id, need AS required, short, CASE WHEN short AND fit IS NOT NULL THEN fit ELSE -1.0::DOUBLE END AS fit_rate_hz FROM j""",
)
def verdict(spark, sf):
    k = F.get_json_object("props", "$.k").cast("long")
    runs = (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").alias("connection_id"), F.floor(k / 25).alias("epoch_id"))
        .agg(F.min(k).alias("k"))
        .select(
            "connection_id",
            "epoch_id",
            F.when(F.col("k") < 50, 50.0).otherwise(20.0).alias("rate_hz"),
            F.when(F.col("k") % 2 == 0, "int16").when(F.col("k") % 5 == 0, "json").otherwise("float32").alias("format"),
        )
    )
    v = lb.link_verdict(_meter(spark, sf), runs)
    return v.select(
        "connection_id",
        "epoch_id",
        F.col("required_byte_rate").alias("required"),
        "short",
        F.coalesce("fit_rate_hz", F.lit(-1.0)).alias("fit_rate_hz"),
    )


@query(
    "l6_measurable_streams",
    f"""SELECT event_id, fmt AS format FROM (SELECT event_id, {FMT} AS fmt, event_id % 3 + 1 AS rr FROM events) WHERE fmt <> 'json' AND rr = 1""",
)
def measurable(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.expr(FMT).alias("format"), (F.col("event_id") % 3 + 1).alias("rate_reduction"))
    return lb.measurable(e).select("event_id", "format")


@query(
    "l7_server_egress",
    f"""WITH {OBS}, e AS (SELECT server_id, "at" - "at" % {DAY} AS slot, connection_id, sum(bytes) AS bytes FROM obs GROUP BY 1, 2, 3)
SELECT server_id, slot, count(*) AS clients, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(max(bytes) AS BIGINT) AS largest, sum(bytes) >= 300000000 AS saturated FROM e GROUP BY 1, 2""",
)
def egress(spark, sf):
    return lb.server_egress(arrivals(spark, sf), DAY, 300000000)


def timed_packets(spark, sf):
    p = packets(spark, sf)
    return p.withColumns({"ts": F.timestamp_micros("start_time"), "bytes": F.col("samples") * 4})


RATE_COLS = f"""count(*) AS packets, CAST(sum(samples) AS BIGINT) AS samples, CAST(sum(samples * 4) AS BIGINT) AS bytes"""


@query(
    "l8_stream_rates",
    f"""WITH {PKT} SELECT stream_id, start_time - start_time % 21600000000 AS window_start, {RATE_COLS},
  {fx("count(*) / 21600.0::DOUBLE", 9)} AS packet_rate FROM pkt GROUP BY 1, 2""",
)
def rates(spark, sf):
    r = lb.stream_rates(timed_packets(spark, sf), "6 hours")
    return r.select("stream_id", F.unix_micros("window_start").alias("window_start"), "packets", "samples", "bytes", fixed(F.col("packets_per_s"), 9).alias("packet_rate"))


@query(
    "l8_sliding_stream_rates",
    f"""WITH {PKT}, w AS (SELECT *, start_time - start_time % 21600000000 - d * 21600000000 AS window_start FROM pkt, (SELECT unnest([0, 1]) AS d))
SELECT stream_id, window_start, {RATE_COLS} FROM w GROUP BY 1, 2""",
)
def sliding(spark, sf):
    r = lb.stream_rates(timed_packets(spark, sf), "12 hours", "6 hours")
    return r.select("stream_id", F.unix_micros("window_start").alias("window_start"), "packets", "samples", "bytes")


@query(
    "l9_device_rate",
    f"""WITH {PKT}, b AS (SELECT stream_id AS connection_id, seq, payload, CASE WHEN seq % 3 = 0 THEN 0 ELSE rate_hz END AS rate_hz,
  coalesce(sum(samples * 4) OVER (PARTITION BY stream_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rd FROM pkt)
SELECT connection_id, coalesce(arg_min(rate_hz, seq) FILTER (rd <= 600 AND payload = 'iq' AND rate_hz > 0), -1) AS device_rate_hz FROM b GROUP BY 1""",
)
def device_rate(spark, sf):
    p = packets(spark, sf).select(
        F.col("stream_id").alias("connection_id"),
        "seq",
        "payload",
        F.when(F.col("seq") % 3 == 0, F.lit(0)).otherwise(F.col("rate_hz")).alias("rate_hz"),
        (F.col("samples") * 4).alias("bytes"),
    )
    out = lb.device_rate(p, budget=600, block=SEQ_BLOCK)
    return out.select("connection_id", F.coalesce("device_rate_hz", F.lit(-1)).alias("device_rate_hz"))
