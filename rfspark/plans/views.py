"""The engine's tables, laid over the generic test tables.

Each view has a Spark form and the same thing as a SQL ``WITH`` entry, so that a
query and its check start from identical rows. Times are integer microseconds,
frequencies and rates integer hertz.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Blocks used by the registered queries. Small, so that test scales
# cross block borders.
SEQ_BLOCK = 4096


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    # The tables' times have no zone; reading them as UTC is what the SQL checks do.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _micros(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


def packets(spark: SparkSession, sf: str, creep: bool = False) -> DataFrame:
    """Packets of 16 streams; a fresh connection every five days.

    With ``creep`` the centre stays and the rate wanders by a few per cent.
    """
    e = table(spark, sf, "events")
    start = _micros("ts")
    k = F.get_json_object("props", "$.k").cast("long")
    if creep:
        center, rate = F.lit(2440000000).cast("long"), k * 30000 + 15360000
    else:
        center = F.floor(k / 25).cast("long") * 10000000 + 2400000000
        rate = F.when(k < 50, F.lit(61440000)).otherwise(F.lit(30720000)).cast("long")
    return e.select(
        (F.col("user_id") % 16).alias("stream_id"),
        F.expr("unix_micros(cast(ts as timestamp)) div 432000000000").alias("connection_id"),
        F.col("event_id").alias("seq"),
        start.alias("start_time"),
        (start + F.round(F.col("value") * 100).cast("long") * 1250000).alias("end_time"),
        (F.round(F.col("value") * 10).cast("long") + 1).alias("samples"),
        F.when(F.col("event_type") == "signup", "spectra")
        .when(F.col("event_type") == "error", "lost")
        .otherwise("iq")
        .alias("payload"),
        center.alias("center_hz"),
        rate.alias("rate_hz"),
    )


PKT = """pkt AS (
  SELECT user_id % 16 AS stream_id, epoch_us(ts) // 432000000000 AS connection_id,
         event_id AS seq, epoch_us(ts) AS start_time,
         epoch_us(ts) + CAST(round(value * 100) AS BIGINT) * 1250000 AS end_time,
         CAST(round(value * 10) AS BIGINT) + 1 AS samples,
         CASE event_type WHEN 'signup' THEN 'spectra' WHEN 'error' THEN 'lost' ELSE 'iq' END AS payload,
         2400000000 + (CAST(json_extract_string(props, '$.k') AS BIGINT) // 25) * 10000000 AS center_hz,
         CAST(CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) < 50
              THEN 61440000 ELSE 30720000 END AS BIGINT) AS rate_hz
  FROM events)"""


CREEP = (
    PKT
    + """, creep AS (
  SELECT p.stream_id, p.connection_id, p.seq, p.start_time, p.end_time, p.samples, p.payload,
         CAST(2440000000 AS BIGINT) AS center_hz,
         15360000 + CAST(json_extract_string(e.props, '$.k') AS BIGINT) * 30000 AS rate_hz
  FROM pkt p JOIN events e ON e.event_id = p.seq)"""
)


def iq_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """32 I/Q pairs per vector, one receiver per label, louder with the label."""
    v = table(spark, sf, "embeddings")
    gain = (F.col("label") + 1).cast("float")

    def pick(parity):
        return F.transform(
            F.filter("embedding", lambda x, i: i % 2 == parity), lambda x: (x * gain).cast("float")
        )

    return v.select(
        F.col("label").cast("long").alias("stream_id"),
        F.col("vec_id").alias("seq"),
        F.lit(32).alias("n"),
        pick(0).alias("i"),
        pick(1).alias("q"),
    )


# One row per pair: k counts from 0.
IQ = """iq AS (
  SELECT CAST(label AS BIGINT) AS stream_id, vec_id AS seq, k,
         CAST(embedding[2*k+1] * CAST(label + 1 AS FLOAT) AS FLOAT) AS i,
         CAST(embedding[2*k+2] * CAST(label + 1 AS FLOAT) AS FLOAT) AS q
  FROM embeddings, (SELECT unnest(range(0, 32)) AS k))"""


def frames(spark: SparkSession, sf: str) -> DataFrame:
    """One 64-bin spectrum per vector, in whole hundredths of a dB."""
    v = table(spark, sf, "embeddings")
    return v.select(
        F.col("label").cast("long").alias("stream_id"),
        F.col("vec_id").alias("seq"),
        F.lit(0).alias("frame"),
        F.lit(2.4e9).alias("start_hz"),
        F.lit(1.25e6).alias("step_hz"),
        F.transform(
            "embedding", lambda x: F.floor(x.cast("double") * 10000 + 0.5).cast("double") / 100
        ).alias("bins"),
    )


FRAME = """frame AS (
  SELECT CAST(label AS BIGINT) AS stream_id, vec_id AS seq, b AS bin,
         2400000000 + b * 1250000 AS freq_hz,
         floor(CAST(embedding[b+1] AS DOUBLE) * 10000 + 0.5) / 100 AS level_db
  FROM embeddings, (SELECT unnest(range(0, 64)) AS b))"""


def bands(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    start = F.lit(2400000000) + F.col("n_nationkey").cast("long") * 3000000
    return n.select(F.col("n_name").alias("band"), start.alias("band_start"), (start + 4000000).alias("band_end"))


BAND = """band AS (
  SELECT n_name AS band, 2400000000 + CAST(n_nationkey AS BIGINT) * 3000000 AS band_start,
         2400000000 + CAST(n_nationkey AS BIGINT) * 3000000 + 4000000 AS band_end FROM nation)"""


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        F.col("user_id").alias("connection_id"),
        (F.col("user_id") % 16).alias("server_id"),
        F.col("event_id").alias("seq"),
        F.lit(1704067200000000).cast("long").alias("opened"),
        _micros("ts").alias("at"),
        F.round(F.col("value") * 1000000).cast("long").alias("bytes"),
        ((F.col("event_type") == "error") & (F.col("value") > 40)).alias("channel_full"),
    )


OBS = """obs AS (
  SELECT user_id AS connection_id, user_id % 16 AS server_id, event_id AS seq,
         CAST(1704067200000000 AS BIGINT) AS opened, epoch_us(ts) AS "at",
         CAST(round(value * 1000000) AS BIGINT) AS bytes,
         (event_type = 'error' AND value > 40) AS channel_full FROM events)"""


def health(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").filter("event_type = 'error'")
    return e.select(
        (F.col("user_id") % 16).alias("device_id"),
        F.col("event_id").alias("seq"),
        _micros("ts").alias("at"),
        (F.round(F.col("value") * 100).cast("long") / 10000).alias("errors_per_second"),
        F.when(F.col("user_id") % 3 == 0, F.lit(0.0)).alias("usb_overflows_per_second"),
        F.lit(None).cast("double").alias("dsp_overflows_per_second"),
    )


HEALTH = """health AS (
  SELECT user_id % 16 AS device_id, event_id AS seq, epoch_us(ts) AS "at",
         CAST(round(value * 100) AS BIGINT) / 10000 AS errors_per_second,
         CASE WHEN user_id % 3 = 0 THEN 0.0::DOUBLE END AS usb_overflows_per_second,
         CAST(NULL AS DOUBLE) AS dsp_overflows_per_second
  FROM events WHERE event_type = 'error')"""


def fixed(x, digits: int):
    """A double as a whole number of 10^-digits, the same way in both engines."""
    return F.floor(x * float(10**digits) + 0.5).cast("long")


def fx(sql: str, digits: int) -> str:
    return f"CAST(floor(({sql}) * {10**digits}.0::DOUBLE + 0.5) AS BIGINT)"
