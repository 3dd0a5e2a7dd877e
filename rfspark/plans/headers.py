"""Registered queries of header parsing, sizing, decoding and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from rfspark.operators import decode, headers as hd, transmit
from rfspark.plans.views import FRAME, IQ, PKT, SEQ_BLOCK, fixed, frames, fx, iq_blocks, packets, table

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return keep


def header_rows(spark, sf):
    """Wire headers written out from the events; some of them deliberately unusable."""
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    text = """concat('{"startTime":', unix_micros(cast(ts as timestamp)) / 1e6,
      ',"endTime":', unix_micros(cast(ts as timestamp)) / 1e6 + value,
      ',"startFrequency":', 2400000000 + k * 1000000, ',"endFrequency":', 2400000000 + k * 1000000 + (k % 7 - 1) * 1000000,
      CASE WHEN event_type = 'click' THEN concat(',"sampleFrequency":', k * 100000) ELSE '' END,
      ',"samples":', CASE event_type WHEN 'view' THEN concat('[', array_join(array_repeat('0.5', cast(k % 5 as int)), ','), ']')
         WHEN 'error' THEN '-3' WHEN 'purchase' THEN '12.0' ELSE cast(k as string) END,
      ',"unit":"volt","minPower":-100,"maxPower":0,"payload":"',
      CASE event_type WHEN 'signup' THEN CASE WHEN k % 4 = 0 THEN 'categories' ELSE 'spectra' END ELSE 'iq' END, '"',
      CASE WHEN k % 3 = 0 THEN ',"antenna":{"name":"north","latitude":0.0}' WHEN k % 3 = 1 THEN ',"antenna":{}' ELSE '' END,
      CASE WHEN k % 4 = 0 THEN ',"categories":[{"name":"a","startFrequency":1,"endFrequency":2},{"name":"b","startFrequency":2,"endFrequency":3}]' ELSE '' END,
      CASE WHEN k % 5 = 0 THEN ',"sampleDepth":3' ELSE '' END, CASE WHEN k % 11 = 0 THEN ',"compression":2' ELSE '' END,
      ',"sampleSize":', k % 13, '}')"""
    return e.select(
        (F.col("user_id") % 16).alias("stream_id"),
        F.col("event_id").alias("seq"),
        F.expr(text).alias("header"),
        F.expr("CASE user_id % 4 WHEN 0 THEN 'int16' WHEN 1 THEN 'float16' WHEN 2 THEN 'float32' ELSE 'json' END").alias("format"),
        F.expr("encode(repeat('x', cast(k * 8 as int)), 'utf-8')").alias("payload"),
    )


# What the headers above must parse to.
HDR = """h AS (
  SELECT user_id % 16 AS stream_id, event_id AS seq, k, event_type, epoch_us(ts) / 1e6::DOUBLE AS t0,
    epoch_us(ts) / 1e6::DOUBLE + value AS t1, 2400000000.0::DOUBLE + k * 1000000 AS f0,
    2400000000.0::DOUBLE + k * 1000000 + (k % 7 - 1) * 1000000 AS f1,
    CASE WHEN event_type = 'click' THEN (k * 100000)::DOUBLE END AS sf,
    CASE event_type WHEN 'view' THEN k % 5 WHEN 'error' THEN NULL WHEN 'purchase' THEN 12 ELSE k END AS samples,
    CASE event_type WHEN 'signup' THEN CASE WHEN k % 4 = 0 THEN 'categories' ELSE 'spectra' END ELSE 'iq' END AS kind,
    CASE WHEN k % 3 = 0 THEN 'north' WHEN k % 3 = 1 THEN '' ELSE 'Unknown' END AS antenna,
    k % 13 AS size, CASE WHEN k % 5 = 0 THEN 3 ELSE 1 END AS depth, CASE WHEN k % 11 = 0 THEN 2 ELSE 0 END AS compression,
    CASE user_id % 4 WHEN 0 THEN 4 WHEN 1 THEN 4 WHEN 2 THEN 8 END AS width
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)),
sized AS (
  SELECT *, CASE WHEN samples IS NULL THEN 'header' WHEN width IS NULL THEN 'format' WHEN kind = 'spectra' AND compression > 0 THEN 'compressed' END AS err,
    CASE WHEN kind = 'spectra' AND compression > 0 THEN NULL WHEN kind = 'iq' THEN samples * width
         WHEN kind = 'spectra' THEN samples * size * depth * (width // 2)
         ELSE greatest(samples, 1) * 2 * (width // 2) END AS need FROM h)"""


@query(
    "s3_parse_headers",
    f"""WITH {HDR} SELECT seq, CASE WHEN samples IS NULL THEN 'bad or missing: samples' ELSE 'none' END AS error,
  coalesce(samples, -1) AS samples, kind, t0 AS start_time, t1 AS end_time, f0 AS start_frequency, f1 AS end_frequency,
  coalesce(sf, -1.0::DOUBLE) AS sample_frequency, size AS sample_size, compression FROM h""",
)
def parse(spark, sf):
    return hd.parse_headers(header_rows(spark, sf)).select(
        "seq",
        F.coalesce("header_error", F.lit("none")).alias("error"),
        F.coalesce("samples", F.lit(-1)).alias("samples"),
        "kind",
        F.col("startTime").alias("start_time"),
        F.col("endTime").alias("end_time"),
        F.col("startFrequency").alias("start_frequency"),
        F.col("endFrequency").alias("end_frequency"),
        F.coalesce("sampleFrequency", F.lit(-1.0)).alias("sample_frequency"),
        F.col("sampleSize").cast("long").alias("sample_size"),
        F.coalesce("compression", F.lit(0)).alias("compression"),
    )


@query(
    "s5_expected_bytes",
    f"""WITH {HDR} SELECT seq, coalesce(CAST(need AS BIGINT), -1) AS expected_bytes FROM sized""",
)
def expected(spark, sf):
    sized = hd.with_expected_bytes(hd.parse_headers(header_rows(spark, sf)))
    return sized.select("seq", F.coalesce("expected_bytes", F.lit(-1)).alias("expected_bytes"))


@query(
    "s16_dead_letters",
    f"""WITH {HDR}, o AS (SELECT *, CASE WHEN err IS NULL AND need > k * 8 THEN 'short' ELSE err END AS why FROM sized)
SELECT stream_id, CASE WHEN why IS NULL THEN 'packet' WHEN why = 'header' OR kind = 'iq' THEN 'lost' ELSE 'skipped' END AS outcome,
  CASE why WHEN 'header' THEN 'bad or missing: samples' WHEN 'format' THEN 'no fixed payload size in this format'
    WHEN 'compressed' THEN 'compressed payload carries no byte length' WHEN 'short' THEN 'payload shorter than declared' ELSE 'none' END AS reason,
  count(*) AS packets FROM o GROUP BY 1, 2, 3""",
)
def dead_letters(spark, sf):
    sized = hd.with_expected_bytes(hd.parse_headers(header_rows(spark, sf)))
    good, bad = hd.split_dead_letters(sized)
    return (
        good.unionByName(bad)
        .groupBy("stream_id", "outcome", F.coalesce("reason", F.lit("none")).alias("reason"))
        .agg(F.count("*").alias("packets"))
    )


@query(
    "m1_packet_geometry",
    f"""WITH {HDR}, g AS (SELECT *, t1 - t0 AS d FROM h WHERE samples IS NOT NULL)
SELECT seq, (f0 + f1) / 2 AS center_hz, greatest(f1 - f0, 0) AS bandwidth_hz, antenna AS antenna_name,
  {fx("d * 1000", 3)} AS duration_us,
  {fx("CASE WHEN coalesce(sf, CASE WHEN d > 0 THEN samples / d ELSE 0 END) > 0 THEN coalesce(sf, samples / d) ELSE 0 END", 3)} AS rate_mhz,
  ((f0 + f1) / 2 - greatest(f1 - f0, 0) / 2) / 1e6 AS start_mhz FROM g""",
)
def packet_geometry(spark, sf):
    from rfspark.operators.geometry import with_packet_geometry

    g = with_packet_geometry(hd.parse_headers(header_rows(spark, sf)).filter("header_error is null"))
    return g.select(
        "seq",
        "center_hz",
        "bandwidth_hz",
        "antenna_name",
        fixed(F.col("duration_ms"), 3).alias("duration_us"),
        fixed(F.col("rate_hz_or_zero"), 3).alias("rate_mhz"),
        "start_mhz",
    )


PAIRS = "SELECT seq, CAST(k AS INTEGER) AS k, {i} AS i, {q} AS q FROM iq"


def _pairs(df):
    """One row per pair, values as double."""
    pair = F.posexplode(F.arrays_zip("i", "q")).alias("k", "p")
    return df.select("seq", pair).select(
        "seq", "k", F.col("p.i").cast("double").alias("i"), F.col("p.q").cast("double").alias("q")
    )


def _wire(spark, sf, fmt, scale=None):
    blocks = iq_blocks(spark, sf).select("stream_id", "seq", "i", "q")
    out = decode.encode_iq(blocks, fmt, scale or 32768.0).withColumn("format", F.lit(fmt))
    return out if scale is None else out.withColumn("scale", F.lit(float(scale)))


@query("s6_decode_float32", f"WITH {IQ} " + PAIRS.format(i="CAST(i AS DOUBLE)", q="CAST(q AS DOUBLE)"))
def decode_float32(spark, sf):
    return _pairs(decode.decode_iq(_wire(spark, sf, "float32")))


def _q16(x):
    return f"greatest(-32768, least(32767, sign({x}) * floor(abs(CAST({x} * CAST(4096 AS FLOAT) AS DOUBLE)) + 0.5))) / 4096.0::DOUBLE + 0.0"


@query("s6_decode_int16_scaled", f"WITH {IQ} " + PAIRS.format(i=_q16("i"), q=_q16("q")))
def decode_int16(spark, sf):
    return _pairs(decode.decode_iq(_wire(spark, sf, "int16", 4096.0)))


@query(
    "s6_decode_float16",
    f"""WITH {IQ}, v AS (SELECT seq, k, i, q, pow(2.0::DOUBLE, greatest(-14, floor(log2(abs(nullif(i::DOUBLE, 0))))) - 10) AS ui,
    pow(2.0::DOUBLE, greatest(-14, floor(log2(abs(nullif(q::DOUBLE, 0))))) - 10) AS uq FROM iq)
SELECT seq, CAST(k AS INTEGER) AS k, coalesce(round_even(i::DOUBLE / ui, 0) * ui, 0) + 0.0 AS i, coalesce(round_even(q::DOUBLE / uq, 0) * uq, 0) + 0.0 AS q FROM v""",
)
def decode_float16(spark, sf):
    p = _pairs(decode.decode_iq(_wire(spark, sf, "float16")))
    return p.select("seq", "k", (F.col("i") + 0.0).alias("i"), (F.col("q") + 0.0).alias("q"))


@query(
    "s7_decode_json",
    f"WITH {IQ} " + PAIRS.format(i="CAST(i AS DOUBLE)", q="CAST(q AS DOUBLE)"),
)
def decode_json(spark, sf):
    b = iq_blocks(spark, sf)
    flat = F.flatten(F.transform(F.arrays_zip("i", "q"), lambda p: F.array(p["i"], p["q"])))
    parsed = b.select("seq", F.lit("iq").alias("kind"), F.to_json(flat).alias("samples_json"))
    return _pairs(decode.decode_json(parsed).filter("decode_error is null"))


@query(
    "s7_decode_json_spectra",
    f"WITH {FRAME} SELECT seq, CAST(bin AS INTEGER) AS bin, CAST(CAST(level_db AS FLOAT) AS DOUBLE) AS level FROM frame",
)
def decode_json_spectra(spark, sf):
    b = frames(spark, sf)
    rows = F.array(F.slice("bins", 1, 32), F.slice("bins", 33, 32))
    parsed = b.select("seq", F.lit("spectra").alias("kind"), F.to_json(rows).alias("samples_json"))
    out = decode.decode_json(parsed).select("seq", F.posexplode("values").alias("bin", "level"))
    return out.select("seq", "bin", F.col("level").cast("double").alias("level"))


@query(
    "s8_spectra_frames",
    f"""WITH {FRAME} SELECT seq, CAST(bin // 16 AS INTEGER) AS frame, CAST(bin % 16 AS INTEGER) AS bin,
  greatest(-32768, least(32767, sign(level_db) * floor(abs(CAST(CAST(level_db AS FLOAT) * CAST(128 AS FLOAT) AS DOUBLE)) + 0.5))) / 128.0::DOUBLE + 0.0 AS level FROM frame""",
)
def spectra_frames(spark, sf):
    b = frames(spark, sf)
    halves = b.select(
        "seq",
        F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: F.get("bins", k * 2).cast("float")).alias("i"),
        F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: F.get("bins", k * 2 + 1).cast("float")).alias("q"),
    )
    wire = decode.encode_iq(halves, "int16", 128.0).select(
        "seq",
        "payload",
        F.lit("int16").alias("format"),
        F.lit(128.0).alias("scale"),
        F.lit(4).alias("samples"),
        F.lit(16).alias("sampleSize"),
        F.lit(1).alias("sampleDepth"),
        F.lit(2.4e9).alias("startFrequency"),
        F.lit(2.48e9).alias("endFrequency"),
    )
    out = decode.decode_spectra(wire).select("seq", "frame", F.posexplode("bins").alias("bin", "level"))
    return out.select("seq", "frame", "bin", F.col("level").cast("double").alias("level"))


def _framed(spark, sf, kind, samples, size, depth):
    """Each spectrum's 64 levels as a float payload of so many frames, bins and planes, decoded and cut again."""
    b = frames(spark, sf)
    lane = lambda odd: F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: F.get("bins", k * 2 + odd).cast("float"))
    wire = decode.encode_iq(b.select("seq", lane(0).alias("i"), lane(1).alias("q")), "float32", 1.0).select(
        "seq", "payload", F.lit("float32").alias("format"), F.lit(kind).alias("kind"), F.lit(samples).alias("samples"),
        F.lit(size).alias("sampleSize"), F.lit(depth).alias("sampleDepth"), F.lit(1e9).alias("startFrequency"), F.lit(1e9 + 64e3).alias("endFrequency"),
    )
    out = decode.decode_spectra(wire).select("seq", "frame", "plane", "step_hz", F.posexplode("bins").alias("bin", "level"))
    return out.withColumn("level", F.col("level").cast("double"))


@query(
    "s8_histogram_planes",
    f"""WITH {FRAME} SELECT seq, CAST(bin // 32 AS INTEGER) AS frame, CAST(bin // 8 % 4 AS INTEGER) AS plane, CAST(bin % 8 AS INTEGER) AS bin, 8000.0::DOUBLE AS step_hz,
  CAST(CAST(level_db AS FLOAT) AS DOUBLE) AS level FROM frame""",
)
def histogram_planes(spark, sf):
    """A histogram has a plane per depth in every frame."""
    return _framed(spark, sf, "histogram", 2, 8, 4)


@query(
    "s8_categories",
    f"""WITH {FRAME} SELECT seq, CAST(bin // 4 AS INTEGER) AS frame, CAST(bin % 4 AS INTEGER) AS category, CAST(CAST(level_db AS FLOAT) AS DOUBLE) AS level FROM frame""",
)
def categories(spark, sf):
    """A value per category in every frame."""
    return _framed(spark, sf, "categories", 16, 4, 1).select("seq", "frame", F.col("bin").alias("category"), "level")


# A coefficient of at most 3 is one hex digit of the bit stream: a one, two bits
# of size, a sign. The sum over levels is what the inverse transform comes to
# for one row of 64 values.
@query(
    "s9_decompress_spectra",
    f"""WITH c AS (
  SELECT vec_id, b, CAST(greatest(-3, least(3, floor(CAST(embedding[b+1] AS DOUBLE) * 8 + 0.5))) AS BIGINT) AS c
  FROM embeddings, (SELECT unnest(range(0, 64)) AS b)),
lv AS (SELECT unnest([1, 2, 4, 8, 16, 32]) AS s),
d AS (
  SELECT p.vec_id, p.b, sum((CASE WHEN p.b & lv.s = 0 THEN 1 ELSE -1 END) * q.c * pow(sqrt(0.5::DOUBLE), log2(lv.s) + 1)) AS detail
  FROM c p, lv JOIN c q ON q.vec_id = p.vec_id AND q.b = (p.b - p.b % (2 * lv.s)) + lv.s GROUP BY 1, 2)
SELECT d.vec_id AS seq, CAST(d.b AS INTEGER) AS bin, {fx("0.4 * (d.detail + r.c * pow(sqrt(0.5::DOUBLE), 6)) + 0.00001", 3)} AS level
FROM d JOIN c r ON r.vec_id = d.vec_id AND r.b = 0""",
)
def decompress(spark, sf):
    v = table(spark, sf, "embeddings")
    digit = lambda x: F.conv(
        (F.lit(8) + F.abs(x) * 2 + F.when(x < 0, 1).otherwise(0)).cast("string"), 10, 16
    )
    code = F.transform(
        "embedding",
        lambda x: F.greatest(F.lit(-3), F.least(F.lit(3), F.floor(x.cast("double") * 8 + 0.5))).cast("int"),
    )
    blocks = v.select(
        F.col("vec_id").alias("seq"),
        F.unhex(F.array_join(F.transform(code, digit), "")).alias("payload"),
        F.lit("spectra").alias("kind"),
        F.lit(3).alias("compression"),
        F.lit(1).alias("samples"),
        F.lit(64).alias("sampleSize"),
        F.lit(1).alias("sampleDepth"),
    )
    out = decode.decompress_spectra(blocks).select("seq", F.posexplode("values").alias("bin", "level"))
    return out.select("seq", "bin", fixed(F.col("level").cast("double") + 0.00001, 3).alias("level"))


@query(
    "s13_packet_limit",
    f"""WITH {PKT}, r AS (SELECT stream_id, seq, payload, row_number() OVER (PARTITION BY stream_id ORDER BY seq) AS nth FROM pkt)
SELECT stream_id, seq, payload FROM r WHERE nth <= 25""",
)
def packet_limit(spark, sf):
    return hd.limit_packets(packets(spark, sf).select("stream_id", "seq", "payload"), 25)


@query(
    "s13_thin_frames",
    "SELECT l_suppkey % 64 AS bin, datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS frame, count(*) AS n FROM lineitem "
    "WHERE datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) % 4 = 0 GROUP BY 1, 2",
)
def thin(spark, sf):
    frame = F.date_diff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date")).cast("long")
    rows = table(spark, sf, "lineitem").select((F.col("l_suppkey") % 64).alias("bin"), frame.alias("frame"))
    return hd.thin_frames(rows, 4).groupBy("bin", "frame").agg(F.count("*").alias("n"))


@query(
    "s14_encode_int16",
    f"""WITH {IQ} SELECT seq, CAST(k AS INTEGER) AS k,
  CAST(greatest(-32768, least(32767, sign(i) * floor(abs(CAST(i * CAST(32768 AS FLOAT) AS DOUBLE)) + 0.5))) AS INTEGER) AS i,
  CAST(greatest(-32768, least(32767, round_even(CAST(i AS DOUBLE) * 32767, 0))) AS INTEGER) AS cs FROM iq""",
)
def encode(spark, sf):
    b = iq_blocks(spark, sf).select(
        "seq", F.arrays_zip(decode.to_int16(F.col("i"), 32768.0).alias("i"), decode.to_cs16(F.col("i")).alias("cs")).alias("z")
    )
    return b.select("seq", F.posexplode("z").alias("k", "z")).select("seq", "k", "z.i", "z.cs")


@query(
    "s15_schedule_bursts",
    """WITH RECURSIVE b AS (SELECT o_custkey AS stream_id, o_orderkey AS seq, epoch_us(o_orderdate) AS desired,
  CAST(round(o_totalprice * 100) AS BIGINT) * 100000 AS duration, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders),
w AS (SELECT stream_id, seq, rn, desired AS start, desired + duration AS stop FROM b WHERE rn = 1
  UNION ALL SELECT b.stream_id, b.seq, b.rn, greatest(b.desired, w.stop + 1), greatest(b.desired, w.stop + 1) + b.duration
  FROM w JOIN b ON b.stream_id = w.stream_id AND b.rn = w.rn + 1)
SELECT stream_id, seq, start AS "start", stop AS "end" FROM w""",
)
def bursts(spark, sf):
    b = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("stream_id"),
        F.col("o_orderkey").alias("seq"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("desired"),
        (F.round(F.col("o_totalprice") * 100).cast("long") * 100000).alias("duration"),
        F.lit(1).cast("long").alias("guard"),
    )
    return transmit.schedule_bursts(b, SEQ_BLOCK).select("stream_id", "seq", "start", "end")
