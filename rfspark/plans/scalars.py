"""Registered queries of the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rfspark.functions import scalar as s
from rfspark.plans.views import fixed, fx, table

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return keep


@query(
    "f1_parse_frequency",
    """WITH x AS (SELECT event_id, round(value, 2) AS v, event_id % 9 AS m, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS v100 FROM events)
SELECT event_id, coalesce(CASE m WHEN 0 THEN v100::DOUBLE WHEN 1 THEN v100::DOUBLE * 1000 WHEN 2 THEN v100::DOUBLE * 1e6
  WHEN 3 THEN v100::DOUBLE * 1e9 WHEN 4 THEN v100::DOUBLE WHEN 5 THEN v100::DOUBLE * 1e6 WHEN 8 THEN v100::DOUBLE * 1000 END, -1.0::DOUBLE) AS hz
FROM (SELECT event_id, m, nullif(v100, '0') AS v100 FROM x)""",
)
def parse_frequency(spark, sf):
    v = F.round(F.col("value") * 100).cast("long").cast("string")
    m = F.col("event_id") % 9
    text = (
        F.when(m == 0, v)
        .when(m == 1, F.concat(v, F.lit("k")))
        .when(m == 2, F.concat(F.lit("  "), v, F.lit(" MHz")))
        .when(m == 3, F.concat(v, F.lit("GHZ ")))
        .when(m == 4, F.concat(v, F.lit(" Hz")))
        .when(m == 5, F.concat(v, F.lit(".0m")))
        .when(m == 6, F.concat(F.lit("-"), v, F.lit("M")))
        .when(m == 7, F.col("event_type"))
        .otherwise(F.concat(v, F.lit(" khz")))
    )
    return table(spark, sf, "events").select(
        "event_id", F.coalesce(s.parse_frequency(text), F.lit(-1.0)).alias("hz")
    )


@query(
    "f2_format_frequency",
    """SELECT event_id, CASE WHEN f >= 999995000 THEN printf('%.2f GHz', f / 1e9) WHEN f >= 999995 THEN printf('%.2f MHz', f / 1e6)
  WHEN f >= 999.995 THEN printf('%.2f kHz', f / 1e3) ELSE printf('%.1f Hz', f) END AS label
FROM (SELECT event_id, pow(10, event_id % 10)::DOUBLE * (CAST(round(value * 100) AS BIGINT) * 2 + 1) / 2.0::DOUBLE AS f FROM events)""",
)
def format_frequency(spark, sf):
    f = F.pow(F.lit(10.0), F.col("event_id") % 10) * (F.round(F.col("value") * 100).cast("long") * 2 + 1) / 2.0
    return table(spark, sf, "events").select("event_id", s.format_frequency(f).alias("label"))


@query(
    "f3_format_sample_rate",
    """SELECT event_id, CASE WHEN f >= 999950 THEN printf('%.1f Msps', f / 1e6) WHEN f >= 999.95 THEN printf('%.1f ksps', f / 1e3)
  ELSE printf('%.1f sps', f) END AS label
FROM (SELECT event_id, pow(10, event_id % 7)::DOUBLE * (CAST(round(value * 100) AS BIGINT) * 4 + 1) / 4.0::DOUBLE AS f FROM events)""",
)
def format_sample_rate(spark, sf):
    f = F.pow(F.lit(10.0), F.col("event_id") % 7) * (F.round(F.col("value") * 100).cast("long") * 4 + 1) / 4.0
    return table(spark, sf, "events").select("event_id", s.format_sample_rate(f).alias("label"))


@query(
    "f4_decibels",
    f"""SELECT event_id, CASE WHEN value <= 0 THEN -1000000000 ELSE {fx("10 * log10(value)", 6)} END AS db,
  {fx("pow(10.0::DOUBLE, value / 100 / 10)", 6)} AS linear FROM events""",
)
def decibels(spark, sf):
    db = s.linear_to_db(F.col("value"))
    return table(spark, sf, "events").select(
        "event_id",
        F.when(db == float("-inf"), F.lit(-1000000000)).otherwise(fixed(db, 6)).cast("long").alias("db"),
        fixed(s.db_to_linear(F.col("value") / 100), 6).alias("linear"),
    )


@query(
    "f5_file_epoch_seconds",
    """SELECT event_id, CASE WHEN x >= 1e13 THEN x / 1e6 ELSE x END AS seconds FROM
  (SELECT event_id, CASE event_id % 3 WHEN 0 THEN epoch_us(ts)::DOUBLE WHEN 1 THEN epoch_us(ts) / 1e6 ELSE -value END AS x FROM events)""",
)
def file_epoch_seconds(spark, sf):
    us = F.unix_micros(F.col("ts").cast("timestamp")).cast("double")
    m = F.col("event_id") % 3
    x = F.when(m == 0, us).when(m == 1, us / 1e6).otherwise(-F.col("value"))
    return table(spark, sf, "events").select("event_id", s.file_epoch_seconds(x).alias("seconds"))


@query(
    "f6_epoch_nanos",
    """WITH x AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN -value WHEN event_id % 7 = 1 THEN value * 1e12 ELSE epoch_us(ts) / 1e6 END AS s FROM events),
n AS (SELECT event_id, CASE WHEN s < 0 OR s >= 9223372036.5 THEN -1 ELSE CAST(floor(s) AS BIGINT) * 1000000000
  + CAST(floor((s - floor(s)) * 1e9::DOUBLE + 0.5) AS BIGINT) END AS nanos FROM x)
SELECT event_id, nanos, CASE WHEN nanos < 0 THEN -1.0::DOUBLE ELSE (nanos // 1000000000)::DOUBLE + (nanos % 1000000000)::DOUBLE * 1e-9::DOUBLE END AS seconds FROM n""",
)
def epoch_nanos(spark, sf):
    us = F.unix_micros(F.col("ts").cast("timestamp")).cast("double")
    m = F.col("event_id") % 7
    x = F.when(m == 0, -F.col("value")).when(m == 1, F.col("value") * 1e12).otherwise(us / 1e6)
    n = s.epoch_seconds_to_nanos(x)
    return table(spark, sf, "events").select(
        "event_id",
        F.coalesce(n, F.lit(-1)).alias("nanos"),
        F.coalesce(s.epoch_nanos_to_seconds(n), F.lit(-1.0)).alias("seconds"),
    )


FORMATS = "CASE event_type WHEN 'click' THEN 'INT16' WHEN 'view' THEN 'float16' WHEN 'purchase' THEN 'Float32' WHEN 'error' THEN 'json' ELSE 'csv' END"


@query(
    "f7_iq_bytes_per_sample",
    f"""SELECT fmt, coalesce(CASE lower(fmt) WHEN 'int16' THEN 4 WHEN 'float16' THEN 4 WHEN 'float32' THEN 8 END, -1) AS bytes,
  count(*) AS n FROM (SELECT {FORMATS} AS fmt FROM events) GROUP BY 1, 2""",
)
def bytes_per_sample(spark, sf):
    e = table(spark, sf, "events").select(F.expr(FORMATS).alias("fmt"))
    width = F.coalesce(s.iq_bytes_per_sample(F.col("fmt")), F.lit(-1))
    return e.groupBy("fmt", width.alias("bytes")).agg(F.count("*").alias("n"))


@query("f8_usable_bandwidth", "SELECT event_id, value * 1000 * 0.8::DOUBLE AS usable_hz FROM events")
def usable(spark, sf):
    return table(spark, sf, "events").select("event_id", s.usable_bandwidth_hz(F.col("value") * 1000).alias("usable_hz"))


CLOCK_LABEL = """CASE event_id % 12 WHEN 0 THEN '46MHz' WHEN 1 THEN ' 61MHz' WHEN 2 THEN '76MHz' WHEN 3 THEN '77MHz' WHEN 4 THEN '92MHz'
  WHEN 5 THEN '122MHz ' WHEN 6 THEN '184MHz' WHEN 7 THEN '245MHz' WHEN 8 THEN '492MHz' WHEN 9 THEN '300MHz' WHEN 10 THEN '150' ELSE event_type END"""


@query(
    "f9_receiver_clock",
    f"""SELECT event_id, CASE event_id % 12 WHEN 0 THEN 46080000 WHEN 1 THEN 61440000 WHEN 2 THEN 76800000 WHEN 3 THEN 76800000
  WHEN 4 THEN 92160000 WHEN 5 THEN 122880000 WHEN 6 THEN 184320000 WHEN 7 THEN 245760000 WHEN 8 THEN 491520000
  WHEN 9 THEN 300000000 WHEN 10 THEN 150000000 ELSE 92160000 END::DOUBLE AS clock_hz FROM events""",
)
def receiver_clock(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", s.receiver_clock_for_label(F.expr(CLOCK_LABEL)).alias("clock_hz")
    )


@query(
    "f10_validate_iq_mode",
    """SELECT event_id, coalesce(CASE WHEN rate <= 0 THEN 'sample rate must be a finite positive number'
  WHEN clock <= 0 THEN 'receiver clock must be a finite positive number'
  WHEN rate > clock / 1.5::DOUBLE THEN printf('sample rate %.3f MHz exceeds clock / 1.5 = %.3f MHz', rate / 1e6, clock / 1.5::DOUBLE / 1e6) END, 'ok') AS verdict
FROM (SELECT event_id, CAST(round(value * 100) AS BIGINT) * 20000.0::DOUBLE - 1000000 AS rate,
  CASE WHEN event_id % 5 = 0 THEN 0.0::DOUBLE ELSE 92160000.0::DOUBLE END AS clock FROM events)""",
)
def validate_iq_mode(spark, sf):
    rate = F.round(F.col("value") * 100).cast("long") * F.lit(20000.0) - 1000000
    clock = F.when(F.col("event_id") % 5 == 0, 0.0).otherwise(92160000.0)
    return table(spark, sf, "events").select(
        "event_id", F.coalesce(s.validate_iq_mode(rate, clock), F.lit("ok")).alias("verdict")
    )


@query(
    "f11_code_names",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
  coalesce(list_extract(string_split('U8 U16 S16 U32 S32 F32 U8N U16N S16N U32N S32N F32N', ' '), CAST(l_suppkey % 14 AS INTEGER) + 1), 'Unknown') AS sample_type,
  coalesce(list_extract(string_split('Generic Dbm Percentage DbmHz DbmM2 Index Phase Signed1 Unsigned1 Time DateTime Hz HzLog Watt Sector Symbol Db Numeric HzLogCenter Volt LogPercentage', ' '), CAST(l_partkey % 25 AS INTEGER) + 1), 'Unknown') AS unit,
  coalesce(list_extract(string_split('Generic Audio Iq Spectra Detection Histogram Energy Vector3 Structured IqSlice Image', ' '), CAST(l_orderkey % 13 AS INTEGER) + 1), 'Unknown') AS payload FROM lineitem""",
)
def code_names(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        s.sample_type_name(F.col("l_suppkey") % 14).alias("sample_type"),
        s.unit_name(F.col("l_partkey") % 25).alias("unit"),
        s.payload_name(F.col("l_orderkey") % 13).alias("payload"),
    )


@query(
    "f12_packet_flags",
    # The bits are typed here again, so that the check does not lean on the engine's own table.
    """WITH w AS (SELECT o_orderkey, (o_custkey * 2654435) % 4294967296 AS word FROM orders),
f AS (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 20, 24, 25, 26, 27, 28, 29, 30, 31]) AS bit,
  unnest(string_split('STREAM_START STREAM_END SEGMENT_START SEGMENT_END BREAK FLUSH PACKET_START PACKET_END WARN_OVERFLOW WARN_DROPPED WARN_INACCURATE WARN_RESAMPLED REPLAY IMMEDIATE TIME_OVERLAP PUSH TIME_DISCONTINUITY WARN_DIRECTION REJECTED USER_0 USER_1 USER_2 USER_3 CONDITION_0 CONDITION_1 CONDITION_2 CONDITION_3', ' ')) AS name)
SELECT o_orderkey, coalesce(string_agg(name, ',' ORDER BY bit) FILTER ((word >> bit) & 1 = 1), '') AS flags, (word & 512) <> 0 AS dropped
FROM w, f GROUP BY o_orderkey, word""",
)
def packet_flags(spark, sf):
    word = (F.col("o_custkey") * 2654435) % 4294967296
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat_ws(",", s.flags_to_array(word)).alias("flags"),
        s.has_flag(word, "WARN_DROPPED").alias("dropped"),
    )


@query(
    "f13_value_ranges",
    """SELECT o_orderkey, lo <= hi AS usable, CASE WHEN lo <= hi THEN v >= lo AND v <= hi ELSE false END AS inside,
  CASE WHEN lo <= hi AND st > 0 THEN st ELSE -1.0::DOUBLE END AS step,
  v > 0 AND hi > 0 AND lo >= 0 AND lo <= v AND v <= hi AS span_ok
FROM (SELECT o_orderkey, (o_custkey % 100)::DOUBLE - 20 AS lo, (o_orderkey % 130)::DOUBLE AS hi, (o_orderkey % 90)::DOUBLE AS v,
  (o_orderkey % 3)::DOUBLE - 1 AS st FROM orders)""",
)
def value_ranges(spark, sf):
    lo = (F.col("o_custkey") % 100).cast("double") - 20
    hi = (F.col("o_orderkey") % 130).cast("double")
    v = (F.col("o_orderkey") % 90).cast("double")
    r = s.value_range(lo, hi, (F.col("o_orderkey") % 3).cast("double") - 1)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        r.isNotNull().alias("usable"),
        F.coalesce(s.value_range_contains(lo, hi, v), F.lit(False)).alias("inside"),
        F.coalesce(r["step"], F.lit(-1.0)).alias("step"),
        s.span_in_bounds(v, lo, hi).alias("span_ok"),
    )


@query(
    "f14_sample_stride",
    """SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_linenumber AS BIGINT)
  * coalesce(list_extract([1,2,2,4,4,4,1,2,2,4,4,4], CAST(l_suppkey % 14 AS INTEGER) + 1), 0) AS stride FROM lineitem""",
)
def sample_stride(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        s.sample_stride_bytes(F.col("l_linenumber"), F.col("l_suppkey") % 14).alias("stride"),
    )


@query(
    "f15_rate_moved",
    "SELECT o_orderkey, abs(o_totalprice - (o_custkey + 100000)) / (o_custkey + 100000)::DOUBLE > 0.1::DOUBLE AS moved FROM orders",
)
def rate_moved(spark, sf):
    from rfspark.operators.continuity import rate_moved

    before = (F.col("o_custkey") + 100000).cast("double")
    return table(spark, sf, "orders").select("o_orderkey", rate_moved(before, F.col("o_totalprice")).alias("moved"))


@query(
    "f16_decimation_index",
    """SELECT l_orderkey, l_linenumber, l_partkey, coalesce(CASE f WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 4 THEN 2 WHEN 8 THEN 3 WHEN 16 THEN 4
  WHEN 32 THEN 5 WHEN 64 THEN 6 WHEN 128 THEN 7 WHEN 256 THEN 8 WHEN 512 THEN 9 END, -1) AS idx
FROM (SELECT *, l_partkey % 600 AS f FROM lineitem)""",
)
def decimation(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.coalesce(s.decimation_index(F.col("l_partkey") % 600), F.lit(-1)).alias("idx"),
    )


@query(
    "f11_device_states",
    """SELECT event_type, CASE WHEN lower(event_type) IN ('idle', 'running', 'warning') THEN lower(event_type) ELSE 'unknown' END AS state, count(*) AS n
FROM (SELECT CASE event_type WHEN 'view' THEN 'Running' WHEN 'click' THEN 'Idle' WHEN 'error' THEN 'WARNING' ELSE event_type END AS event_type FROM events) GROUP BY 1, 2""",
)
def device_states(spark, sf):
    raw = F.expr("CASE event_type WHEN 'view' THEN 'Running' WHEN 'click' THEN 'Idle' WHEN 'error' THEN 'WARNING' ELSE event_type END")
    e = table(spark, sf, "events").select(raw.alias("event_type"))
    return e.groupBy("event_type", s.device_state_name(F.col("event_type")).alias("state")).agg(F.count("*").alias("n"))
