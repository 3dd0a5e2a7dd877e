"""Registered queries of dumps, live feeds, sinks and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from rfspark.operators import decode, headers as hd
from rfspark.operators.health import losing_nothing
from rfspark.plans.continuity import ADAPT
from rfspark.plans.headers import PAIRS, _pairs, _wire
from rfspark.plans.views import BAND, HEALTH, IQ, PKT, bands, health, packets, table
from rfspark.session import shared_folder
from rfspark.sources import dumps, feed
from rfspark.streaming import continuity as live, stats

QUERIES, ORACLE = {}, {}
_landed: dict = {}
DAY = 86400000000


def query(name, sql):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return keep


def run(df, spark, purpose, rocks=False):
    """Drive a stream over everything that has landed and read its output back."""
    return spark.read.schema(df.schema).parquet(driven(df, spark, purpose, rocks))


def driven(df, spark, purpose, rocks=False, folder=None):
    """Drive a stream over everything that has landed; the folder of its output. In the ``folder`` of an earlier run it goes on."""
    folder = folder or shared_folder(spark, purpose)
    wanted = {}
    if rocks:
        rocksdb = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        wanted["spark.sql.streaming.stateStore.providerClass"] = rocksdb
    if spark.sparkContext.master.startswith("local"):
        # Every shuffle partition of a stateful query keeps a store of its own.
        wanted["spark.sql.shuffle.partitions"] = str(min(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        feed.drain(df, f"{folder}/out", f"{folder}/checkpoint")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return f"{folder}/out"


def landed(spark, sf, name, slices):
    """A landing folder filled slice after slice, each of several files in packet order; its schema and rows.

    ``slices`` gives the rows of each slice.
    """
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _landed:
        folder = shared_folder(spark, f"landing-{name}")
        for part in slices(spark, sf):
            land(part, folder)
        rows = spark.read.parquet(folder).count()
        _landed[key] = (folder, part.schema, rows)
    return _landed[key]


# Packets of one micro-batch where each stream is taken in its own order, whatever the others have sent.
BATCH_ROWS = 1 << 20


def land(part, folder):
    spread = part.repartition("stream_id").sortWithinPartitions("stream_id", "seq")
    spread.write.mode("append").parquet(folder)


def received(spark, sf, name, slices, triggers=3, most=None):
    """The landing folder as a stream of about so many micro-batches, or of ``most`` rows each if that is less."""
    folder, schema, rows = landed(spark, sf, name, slices)
    admitted = rows // triggers + 1
    return feed.read_packet_stream(spark, folder, schema, rows_per_trigger=min(admitted, most or admitted))


def thirds(df, order="seq"):
    """Three slices of a table by its order."""
    top = df.agg(F.max(order)).first()[0] + 1
    return [df.filter((F.col(order) >= top * k // 3) & (F.col(order) < top * (k + 1) // 3)) for k in range(3)]


def timed(packets):
    return packets.withColumns({"ts": F.timestamp_micros("start_time"), "bytes": F.col("samples") * 4})


def packet_slices(spark, sf):
    """Three slices of the packets, and at last the marker of each stream."""
    p = timed(packets(spark, sf))
    return [*thirds(p), feed.closing(p)]


def live_packets(spark, sf, most=None):
    return received(spark, sf, "packets", packet_slices, most=most)


DUMP_ROWS = 1 << 16  # event numbers whose packets of a stream stay in one file


# The last four digits of an event's number in hex are each pair of the payload.
@query(
    "s4_stream_dumps",
    """SELECT user_id % 16 AS stream_id, event_id AS event, n AS samples, CAST(ascii(substr(h, 1, 1)) + 256 * ascii(substr(h, 2, 1)) AS BIGINT) AS first_i,
  n * (ascii(substr(h, 3, 1)) + 256 * ascii(substr(h, 4, 1))) AS sum_q
FROM (SELECT *, lpad(upper(to_hex(event_id)), 4, '0') AS h, CAST(round(value) AS BIGINT) % 40 + 1 AS n FROM events) WHERE event_type <> 'error' AND event_id < 65536
UNION ALL SELECT user_id % 16, event_id, n, ascii(substr(h, 1, 1)) + 256 * ascii(substr(h, 2, 1)), n * (ascii(substr(h, 3, 1)) + 256 * ascii(substr(h, 4, 1)))
FROM (SELECT *, right(upper(to_hex(event_id)), 4) AS h, CAST(round(value) AS BIGINT) % 40 + 1 AS n FROM events) WHERE event_type <> 'error' AND event_id >= 65536""",
)
def stream_dumps(spark, sf):
    folder = shared_folder(spark, "dumps")
    text = """concat(CASE WHEN event_type = 'error' THEN '{"startTime":1,{' WHEN event_id % 7 = 0 THEN 'x{y{' ELSE '' END,
      '{"startTime":', event_id, ',"endTime":', event_id + 1, ',"startFrequency":1,"endFrequency":2,"samples":', CASE WHEN event_type = 'error' THEN '"none"' ELSE cast(n AS string) END,
      ',"unit":"volt","payload":"iq","minPower":0,"maxPower":0,"sampleSize":2}',
      CASE event_id % 3 WHEN 0 THEN '\\n\\u001e' WHEN 1 THEN '\\u001e' ELSE '\\n' END, repeat(right(lpad(hex(event_id), 16, '0'), 4), n))"""
    e = table(spark, sf, "events").withColumn("n", F.round("value").cast("int") % 40 + 1)
    rows = e.select((F.col("user_id") % 16).alias("stream_id"), "event_id", F.expr(text).alias("value"))
    # A stream is several dumps, each in packet order, so no stream is one task.
    rows = rows.repartition("stream_id", F.expr(f"event_id div {DUMP_ROWS}")).sortWithinPartitions("stream_id", "event_id")
    rows.drop("event_id").write.partitionBy("stream_id").text(folder)
    scanned = dumps.scan_stream_dumps(spark, folder, "int16", ".txt", split_bytes=1 << 16)
    parsed = hd.parse_headers(scanned.filter("error is null").withColumn("format", F.lit("int16")))
    iq = decode.decode_iq(parsed.select("file", "startTime", "format", "payload", F.lit(1.0).alias("scale")))
    return iq.select(
        F.regexp_extract("file", r"stream_id=(\d+)", 1).cast("long").alias("stream_id"),
        F.col("startTime").cast("long").alias("event"),
        F.col("n").cast("long").alias("samples"),
        F.get("i", F.lit(0)).cast("long").alias("first_i"),
        F.aggregate("q", F.lit(0.0), lambda a, x: a + x).cast("long").alias("sum_q"),
    )


@query("s12_live_feed", f"WITH {PKT} SELECT stream_id, seq, payload, samples, center_hz FROM pkt")
def live_feed(spark, sf):
    rows = live_packets(spark, sf).filter("payload <> 'closed'")
    return run(rows.select("stream_id", "seq", "payload", "samples", "center_hz"), spark, "feed")


@query(
    "s17_write_blocks",
    f"""WITH {PKT} SELECT stream_id, strftime(make_timestamp(start_time), '%Y-%m-%d') AS day, count(*) AS packets, CAST(sum(samples) AS BIGINT) AS samples FROM pkt GROUP BY 1, 2""",
)
def write_blocks(spark, sf):
    folder = shared_folder(spark, "blocks")
    feed.write_blocks(packets(spark, sf).withColumn("ts", F.timestamp_micros("start_time")), folder)
    back = feed.read_blocks(spark, folder)
    return back.groupBy(F.col("stream_id").cast("long").alias("stream_id"), F.col("day").cast("string").alias("day")).agg(
        F.count("*").alias("packets"), F.sum("samples").alias("samples")
    )


# The rules of the adaptive detector and of announced geometry, as one recursion.
@query(
    "t1_continuity_stream",
    f"""WITH RECURSIVE {ADAPT}, tuned AS (
  SELECT *, gap_class IN ('drop', 'backward') OR after_loss AS is_gap, CASE WHEN lag(rate_hz) OVER w IS NULL THEN 'initial'
    WHEN abs(lag(center_hz) OVER w - center_hz) > 1 OR abs(rate_hz - lag(rate_hz) OVER w) / lag(rate_hz) OVER w > 0.1 THEN 'retune' END AS change,
    CAST(coalesce(sum(samples) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at_sample
  FROM adapted WINDOW w AS (PARTITION BY stream_id ORDER BY seq))
SELECT stream_id, at_sample, 0 AS place, 'gap' AS kind, -1.0::DOUBLE AS center_hz, -1.0::DOUBLE AS rate_hz, seq FROM tuned WHERE is_gap AND at_sample > 0
UNION ALL SELECT stream_id, at_sample, 1, change, center_hz::DOUBLE, rate_hz::DOUBLE, seq FROM tuned WHERE change IS NOT NULL""",
)
def continuity_stream(spark, sf):
    b = run(live.continuity_stream(live_packets(spark, sf, BATCH_ROWS), cap_s=None, ticks=1e6, stall_s=None), spark, "breaks", rocks=True)
    b = b.filter("kind <> 'closed'").drop("at", "tuned_hz")
    return b.withColumns({c: F.coalesce(c, F.lit(-1.0)) for c in ("center_hz", "rate_hz")})


@query(
    "t2_live_stats",
    f"""WITH {PKT} SELECT stream_id, start_time - start_time % {DAY} AS window_start, count(*) AS packets, CAST(sum(samples) AS BIGINT) AS samples FROM pkt
GROUP BY 1, 2""",
)
def live_stats(spark, sf):
    w = run(stats.closed_stats(live_packets(spark, sf), "1 hour", "1 day"), spark, "stats", rocks=True)
    return w.select("stream_id", F.unix_micros("window_start").alias("window_start"), "packets", "samples")


@query(
    "t2_live_sliding_stats",
    f"""WITH {PKT}, w AS (SELECT *, start_time - start_time % {DAY // 2} - d * {DAY // 2} AS window_start FROM pkt, (SELECT unnest([0, 1]) AS d))
SELECT stream_id, window_start, count(*) AS packets FROM w WHERE start_time < window_start + {DAY} GROUP BY 1, 2""",
)
def live_sliding(spark, sf):
    w = run(stats.closed_stats(live_packets(spark, sf), "1 hour", "1 day", "12 hours"), spark, "sliding", rocks=True)
    return w.select("stream_id", F.unix_micros("window_start").alias("window_start"), "packets")


@query(
    "t3_connection_sessions",
    f"""WITH {PKT}, g AS (SELECT *, coalesce(start_time - lag(start_time) OVER w >= 1800000000, true) AS fresh FROM pkt WINDOW w AS (PARTITION BY stream_id ORDER BY start_time, seq)),
n AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY stream_id ORDER BY start_time, seq) AS sid FROM g)
SELECT stream_id, min(start_time) AS opened, max(start_time) + 1800000000 AS closed, count(*) AS packets FROM n GROUP BY stream_id, sid""",
)
def sessions(spark, sf):
    s = run(stats.closed_sessions(live_packets(spark, sf), "1 hour", "30 minutes"), spark, "sessions", rocks=True)
    return s.select("stream_id", F.unix_micros("opened").alias("opened"), F.unix_micros("closed").alias("closed"), "packets")


@query(
    "t4_late_packets",
    f"""WITH {PKT}, s AS (SELECT *, CASE WHEN seq % 5 = 0 THEN 1 ELSE 0 END AS held FROM pkt),
top AS (SELECT stream_id, max(seq) AS top FROM s WHERE held = 0 GROUP BY 1)
SELECT s.stream_id, count(*) AS late FROM s JOIN top USING (stream_id) WHERE held = 1 AND seq <= top GROUP BY 1""",
)
def late(spark, sf):
    """Every fifth packet lands when the rest has been taken."""
    landing, folder = shared_folder(spark, "landing-late"), shared_folder(spark, "late")
    for held in ("<>", "="):
        part = packets(spark, sf).filter(f"seq % 5 {held} 0")
        land(part, landing)
        source = feed.read_packet_stream(spark, landing, part.schema, rows_per_trigger=BATCH_ROWS)
        found = live.continuity_stream(source, cap_s=None, ticks=1e6, stall_s=None)
        out = driven(found, spark, "late", rocks=True, folder=folder)
    b = spark.read.schema(found.schema).parquet(out)
    return b.filter("kind = 'late'").groupBy("stream_id").agg(F.count("*").alias("late"))


@query(
    "t5_enriched_packets",
    f"""WITH {PKT}, {HEALTH}, v AS (SELECT device_id, t, arg_min(ok, seq) AS ok FROM (SELECT device_id, "at" AS t, seq, errors_per_second < 0.5 AND coalesce(usb_overflows_per_second < 0.5, true) AS ok FROM health) GROUP BY 1, 2)
SELECT p.stream_id AS device_id, p.seq, CASE WHEN v.ok IS NULL OR p.start_time >= v.t + 21600000000 THEN 'unknown' WHEN v.ok THEN 'downstream' ELSE 'device' END AS blame
FROM pkt p ASOF LEFT JOIN v ON v.device_id = p.stream_id AND p.start_time >= v.t""",
)
def enriched(spark, sf):
    marks = live_packets(spark, sf).filter("payload <> 'closed'").select(F.col("stream_id").alias("device_id"), F.col("start_time").alias("at"), "seq")
    h = health(spark, sf).withColumn("losing_nothing", losing_nothing())
    spans = stats.health_intervals(h, 6 * 3600 * 1000000, DAY, 5 * DAY)
    return run(stats.enrich_stream(marks, spans, DAY), spark, "enriched").select("device_id", "seq", "blame")


def health_slices(spark, sf):
    """Health readings as they land, and each device's marker; a device without readings has one too."""
    h = health(spark, sf).withColumn("losing_nothing", losing_nothing()).withColumn("ts", F.timestamp_micros("at"))
    h = h.select(F.col("device_id").alias("stream_id"), "seq", "ts", F.lit("health").alias("payload"), "losing_nothing")
    ends = feed.closing(timed(packets(spark, sf)).withColumn("losing_nothing", F.lit(None).cast("boolean")).select(h.columns))
    return [*thirds(h), ends]


@query(
    "t5_enriched_breaks",
    f"""WITH RECURSIVE {ADAPT}, {HEALTH}, {BAND}, tuned AS (
  SELECT *, gap_class IN ('drop', 'backward') OR after_loss AS is_gap, CASE WHEN lag(rate_hz) OVER w IS NULL THEN 'initial'
    WHEN abs(lag(center_hz) OVER w - center_hz) > 1 OR abs(rate_hz - lag(rate_hz) OVER w) / lag(rate_hz) OVER w > 0.1 THEN 'retune' END AS change,
    CAST(coalesce(sum(samples) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at_sample
  FROM adapted WINDOW w AS (PARTITION BY stream_id ORDER BY seq)),
b AS (SELECT stream_id, at_sample, 'gap' AS kind, center_hz, seq, start_time FROM tuned WHERE is_gap AND at_sample > 0
  UNION ALL SELECT stream_id, at_sample, change, center_hz, seq, start_time FROM tuned WHERE change IS NOT NULL),
v AS (SELECT device_id, t, arg_min(ok, seq) AS ok FROM (SELECT device_id, "at" AS t, seq, errors_per_second < 0.5 AND coalesce(usb_overflows_per_second < 0.5, true) AS ok FROM health) GROUP BY 1, 2),
e AS (SELECT b.*, CASE WHEN v.ok IS NULL OR b.start_time >= v.t + 21600000000 THEN 'unknown' WHEN v.ok THEN 'downstream' ELSE 'device' END AS blame
  FROM b ASOF LEFT JOIN v ON v.device_id = b.stream_id AND b.start_time >= v.t)
SELECT stream_id AS device_id, at_sample, kind, seq, blame, coalesce(band, 'none') AS band FROM e LEFT JOIN band ON e.center_hz BETWEEN band_start AND band_end""",
)
def enriched_breaks(spark, sf):
    """Breaks found in the packet feed are a feed themselves; the health feed runs beside it."""
    source = live.continuity_stream(live_packets(spark, sf, BATCH_ROWS), cap_s=None, ticks=1e6, stall_s=None)
    folder = driven(source, spark, "breaks", rocks=True)
    # The marker of a stream carries no start; its feed ends with its last break.
    found = feed.read_packet_stream(spark, folder, source.schema, rows_per_trigger=spark.read.parquet(folder).count() // 2 + 1)
    at = F.when(F.col("kind") == "closed", F.lit(None)).otherwise(F.col("at").cast("long"))
    breaks = found.select(
        F.col("stream_id").alias("device_id"), "seq", F.timestamp_micros(at).alias("ts"), "at_sample", "kind",
        F.col("tuned_hz").alias("center_hz"), (F.col("kind") == "closed").alias("closed"),
    )
    readings = received(spark, sf, "health", health_slices).select(
        F.col("stream_id").alias("device_id"), "seq", "ts", "losing_nothing", (F.col("payload") == "closed").alias("closed")
    )
    rows = stats.enrich_live(breaks, readings, bands(spark, sf), "1 hour", 6 * 3600 * 1000000, 4e6)
    out = run(rows.select("device_id", "at_sample", "kind", "seq", "blame", "band"), spark, "enriched-breaks", rocks=True)
    return out.withColumn("band", F.coalesce("band", F.lit("none")))


@query("t6_decode_stream", f"WITH {IQ} " + PAIRS.format(i="CAST(i AS DOUBLE)", q="CAST(q AS DOUBLE)"))
def decode_stream(spark, sf):
    source = received(spark, sf, "wire", lambda s, d: thirds(_wire(s, d, "float32")))
    return _pairs(run(stats.decode_stream(source), spark, "decoded"))
