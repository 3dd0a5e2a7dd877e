"""Registered queries of spectral and signal aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from rfspark.operators import spectral as sp
from rfspark.operators.blocks import explode_bins
from rfspark.plans.blocks import INDEXED, indexed_blocks
from rfspark.plans.views import BAND, FRAME, IQ, bands, fixed, frames, fx, iq_blocks, table

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return keep


def level_rows(spark, sf):
    """Levels from the line items: 64 bins, one frame a day, whole hundredths."""
    day = F.date_diff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date")).cast("long")
    return table(spark, sf, "lineitem").select(
        F.lit(0).cast("long").alias("stream_id"),
        day.alias("frame"),
        (F.col("l_suppkey") % 64).alias("bin"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("level_db"),
    )


LEVELS = """levels AS (SELECT datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS frame, l_suppkey % 64 AS bin,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS level FROM lineitem)"""


@query(
    "p1_trace_detectors",
    f"""WITH {LEVELS} SELECT frame // 30 AS "window", bin, CAST(floor(avg(level) * 100 + 0.5) AS BIGINT) AS average, max(level) AS maxhold,
  min(level) AS minhold FROM levels GROUP BY 1, 2""",
)
def traces(spark, sf):
    t = sp.trace(level_rows(spark, sf), 30)
    return t.select("window", "bin", fixed(F.col("average"), 2).alias("average"), "maxhold", "minhold")


# Levels are averaged as whole hundredths: a sum of doubles depends on its order, and an average
# that lies halfway between two steps then falls to either side.
@query(
    "p1_trace_of_frames",
    f"""WITH {FRAME}, w AS (SELECT *, CAST(round(level_db * 100) AS BIGINT) AS level FROM frame) SELECT stream_id, seq // 50 AS "window", CAST(bin AS INTEGER) AS bin,
  {fx("avg(level)", 2)} AS average, max(level_db) AS maxhold, min(level_db) AS minhold FROM w GROUP BY 1, 2, 3""",
)
def frame_traces(spark, sf):
    rows = explode_bins(frames(spark, sf).withColumn("frame", F.col("seq")))
    t = sp.trace(rows.withColumn("level_db", F.round(F.col("level_db") * 100).cast("long")), 50)
    hold = [(F.col(n) / 100).alias(n) for n in ("maxhold", "minhold")]
    return t.select("stream_id", "window", "bin", fixed(F.col("average"), 2).alias("average"), *hold)


@query(
    "p2_max_fall",
    f"""WITH {LEVELS}, d AS (SELECT bin, frame, max(level) AS level FROM levels GROUP BY 1, 2)
SELECT bin, frame, max(level + frame * 2500) OVER (PARTITION BY bin ORDER BY frame) - frame * 2500 AS maxfall FROM d""",
)
def max_fall(spark, sf):
    d = level_rows(spark, sf).groupBy("stream_id", "bin", "frame").agg(F.max("level_db").alias("level_db"))
    return sp.max_fall(d, 2500, block=365).select("bin", "frame", "maxfall")


@query(
    "p3_power_histogram",
    f"""WITH {LEVELS}, l AS (SELECT bin, CASE WHEN level < 0 THEN 0 WHEN level >= 10000000 THEN 21 ELSE CAST(floor(level / 500000.0) AS INTEGER) + 1 END AS level FROM levels),
c AS (SELECT bin, level, count(*) AS n FROM l GROUP BY 1, 2)
SELECT bin, CAST(level AS BIGINT) AS level, n, {fx("n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY bin)", 6)} AS micro_percent FROM c""",
)
def histogram(spark, sf):
    rows = level_rows(spark, sf).withColumn("level_db", F.col("level_db").cast("double"))
    h = sp.power_histogram(rows, 0.0, 10000000.0, 20)
    return h.select("bin", "level", "n", fixed(F.col("percent"), 6).alias("micro_percent"))


@query(
    "p4_waterfall",
    f"""WITH {LEVELS} SELECT frame // 7 AS line, bin, CAST(floor(avg(level) * 100 + 0.5) AS BIGINT) AS level FROM levels GROUP BY 1, 2""",
)
def waterfall(spark, sf):
    w = sp.waterfall(level_rows(spark, sf), 7)
    return w.select("line", "bin", fixed(F.col("level_db"), 2).alias("level"))


@query(
    "p5_channel_power",
    f"""WITH {FRAME}, {BAND} SELECT seq, band, count(*) AS n_bins, {fx("10 * log10(sum(pow(10.0::DOUBLE, level_db / 10)))", 5)} AS power
FROM frame JOIN band ON freq_hz >= band_start AND freq_hz < band_end GROUP BY 1, 2""",
)
def channel_power(spark, sf):
    rows = explode_bins(frames(spark, sf)).select("stream_id", "seq", "hz", "level_db")
    p = sp.channel_power(rows, bands(spark, sf), 5_000_000)
    return p.select("seq", "band", "n_bins", fixed(F.col("power_db"), 5).alias("power"))


@query(
    "p6_marker_values",
    f"""WITH {FRAME} SELECT stream_id, seq, 'marker ' || bin AS marker, level_db AS value FROM frame WHERE seq % 3 <> 0""",
)
def markers(spark, sf):
    names = F.transform(
        F.sequence(F.lit(0), F.size("bins") - 1),
        lambda k: F.struct(
            F.concat(F.lit("marker "), k.cast("string")).alias("name"),
            (k * 1e6).alias("startFrequency"),
            (k * 1e6 + 10).alias("endFrequency"),
        ),
    )
    edge = F.when(F.col("seq") % 3 == 0, 2.4e9).otherwise(0.0)
    p = frames(spark, sf).select(
        "stream_id",
        "seq",
        F.lit("spectra").alias("kind"),
        edge.alias("startFrequency"),
        edge.alias("endFrequency"),
        names.alias("categories"),
        F.col("bins").alias("values"),
    )
    return sp.marker_values(p).select("stream_id", "seq", "marker", "value")


CHANNELS = [(f"channel {k}", 2.44e9 + (k - 3) * 7e6) for k in range(7)]
SURVEY = (
    IQ
    + f""", m AS (SELECT stream_id, sum(i::DOUBLE * i + q::DOUBLE * q) / count(*) AS mean_power FROM iq GROUP BY 1),
ch AS (SELECT 'channel ' || k AS channel, 2440000000.0::DOUBLE + (k - 3) * 7000000 AS hz FROM (SELECT unnest(range(0, 7)) AS k)),
survey AS (SELECT stream_id, channel, hz, CASE WHEN abs(hz - 2.44e9) > 2e7 THEN -120.0::DOUBLE
  ELSE 10 * log10(mean_power) - abs(hz - 2.44e9) / 2e7 * 8 END AS power FROM m, ch)"""
)


def _survey(spark, sf):
    return sp.channel_survey(iq_blocks(spark, sf), CHANNELS, 2.44e9, 4e7, -3.0)


@query("p7_channel_survey", f"WITH {SURVEY} SELECT stream_id, channel, {fx('power', 6)} AS power, power > -3.0 AS active FROM survey")
def survey(spark, sf):
    return _survey(spark, sf).select("stream_id", "channel", fixed(F.col("power_db"), 6).alias("power"), "active")


@query("p7_strongest_channel", f"WITH {SURVEY} SELECT stream_id, arg_max(channel, (power, hz)) AS channel, {fx('max(power)', 6)} AS power FROM survey GROUP BY 1")
def strongest(spark, sf):
    return sp.strongest(_survey(spark, sf)).select("stream_id", "channel", fixed(F.col("power_db"), 6).alias("power"))


@query(
    "p8_iq_statistics",
    f"""WITH {IQ}, m AS (SELECT stream_id, sqrt(i::DOUBLE * i + q::DOUBLE * q) AS m, i = 0 AND q = 0 AS z FROM iq)
SELECT stream_id, count(*) AS n, true AS finite, {fx("sqrt(avg(m * m))", 6)} AS rms, {fx("max(m)", 6)} AS peak,
  {fx("quantile_cont(m, 0.5)", 6)} AS median, {fx("avg(CASE WHEN z THEN 1.0 ELSE 0.0 END)", 6)} AS zero_share FROM m GROUP BY 1""",
)
def iq_stats(spark, sf):
    s = sp.iq_stats(iq_blocks(spark, sf), block=0.125)
    cols = [fixed(F.col(c), 6).alias(c) for c in ("rms", "peak", "median", "zero_share")]
    return s.select("stream_id", "n", "finite", *cols)


NFFT = 16


def _segments(spark, sf):
    """Each 32-sample block cut in two segments of 16; a receiver's last is left out."""
    b = indexed_blocks(spark, sf).withColumn("half", F.explode(F.array(F.lit(0), F.lit(1))))
    cut = b.select(
        "stream_id",
        (F.col("first_sample") + F.col("half") * NFFT).alias("first_sample"),
        F.lit(NFFT).alias("n"),
        F.slice("i", F.col("half") * NFFT + 1, F.lit(NFFT)).alias("i"),
        F.slice("q", F.col("half") * NFFT + 1, F.lit(NFFT)).alias("q"),
    )
    ends = b.groupBy("stream_id").agg(F.max(F.col("first_sample") + F.col("n")).alias("run_end"))
    return sp.segments_of(cut.join(ends, "stream_id"), NFFT)


# The transform written out as a sum over samples.
PSD = (
    INDEXED
    + """, g AS (SELECT stream_id, sample // 16 AS seg, sample % 16 AS k, max(sample) OVER (PARTITION BY stream_id) AS last,
    i * (0.5::DOUBLE - 0.5 * cos(2 * pi() * (sample % 16) / 15)) AS i, q * (0.5::DOUBLE - 0.5 * cos(2 * pi() * (sample % 16) / 15)) AS q FROM s),
f AS (SELECT stream_id, seg, b AS bin,
    sum(i * cos(2 * pi() * k * (b - 8) / 16) + q * sin(2 * pi() * k * (b - 8) / 16)) AS re,
    sum(q * cos(2 * pi() * k * (b - 8) / 16) - i * sin(2 * pi() * k * (b - 8) / 16)) AS im
  FROM g, (SELECT unnest(range(0, 16)) AS b) WHERE seg * 16 + 16 < last + 1 GROUP BY 1, 2, 3),
pw AS (SELECT stream_id, seg, bin, re * re + im * im AS power FROM f)"""
)


@query(
    "p9_noise_floor",
    f"""WITH {PSD} SELECT stream_id, CAST(bin AS INTEGER) AS bin, {fx("10 * log10(quantile_cont(power, 0.1) + 1e-30)", 5)} AS psd
FROM pw GROUP BY 1, 2 HAVING count(*) >= 8""",
)
def noise_floor(spark, sf):
    n = sp.noise_floor(_segments(spark, sf), NFFT, block=4.0)
    return n.select("stream_id", "bin", fixed(F.col("psd_db"), 5).alias("psd"))


@query(
    "p9_mean_psd",
    f"""WITH {PSD} SELECT stream_id, CAST(bin AS INTEGER) AS bin, {fx("10 * log10(avg(power) + 1e-30)", 5)} AS psd FROM pw GROUP BY 1, 2""",
)
def mean_psd(spark, sf):
    n = sp.mean_psd(_segments(spark, sf), NFFT)
    return n.select("stream_id", "bin", fixed(F.col("psd_db"), 5).alias("psd"))


def _spectra(spark, sf):
    """Mean level per bin in whole thousandths of a dB, with frequencies from the centre."""
    rows = explode_bins(frames(spark, sf)).groupBy("stream_id", "bin").agg(
        (F.floor(F.avg(F.floor(F.col("level_db") * 100 + 0.5).cast("long")) * 10) / 1000.0).alias("psd_db")
    )
    return rows.withColumn("hz", (F.col("bin") - 32) * 1.25e6)


SPECTRA = (
    FRAME
    + """, psd AS (SELECT stream_id, bin, (bin - 32) * 1250000.0::DOUBLE AS hz,
    floor(avg(CAST(floor(level_db * 100 + 0.5) AS BIGINT)) * 10) / 1000.0::DOUBLE AS psd FROM frame GROUP BY 1, 2)"""
)


@query(
    "p10_find_carrier",
    f"""WITH {SPECTRA} SELECT stream_id, arg_max(hz, (psd, -hz)) FILTER (abs(abs(hz) - 2e7) < 1e7) AS carrier_hz,
  max(psd) FILTER (abs(abs(hz) - 2e7) < 1e7) AS level_db, {fx("max(psd) FILTER (abs(abs(hz) - 2e7) < 1e7) - median(psd)", 4)} AS snr FROM psd GROUP BY 1""",
)
def find_carrier(spark, sf):
    c = sp.find_carrier(_spectra(spark, sf), 2e7, 1e7)
    return c.select("stream_id", "carrier_hz", "level_db", fixed(F.col("snr_db"), 4).alias("snr"))


@query(
    "p11_compare_shapes",
    f"""WITH {SPECTRA}, r AS (SELECT stream_id, bin, psd - median(psd) OVER (PARTITION BY stream_id) AS v FROM psd),
s AS (SELECT stream_id, bin, sum(v) OVER (PARTITION BY stream_id ORDER BY bin ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) / 9 AS v FROM r),
d AS (SELECT a.stream_id AS pair, abs(a.v - b.v) AS d FROM s a JOIN s b ON b.stream_id = a.stream_id + 5 AND b.bin = a.bin WHERE a.stream_id < 5 AND a.bin >= 3 AND a.bin < 60)
SELECT pair, {fx("max(d)", 5)} AS worst, {fx("sqrt(avg(d * d))", 5)} AS rms, max(d) < 1.5 AS agrees FROM d GROUP BY 1""",
)
def compare(spark, sf):
    p = _spectra(spark, sf)
    a = p.filter("stream_id < 5").withColumnRenamed("stream_id", "pair")
    b = p.filter("stream_id >= 5").withColumn("pair", F.col("stream_id") - 5)
    c = sp.compare_shapes(a, b.drop("stream_id"), 64, smooth=9, tol_db=1.5)
    return c.select("pair", fixed(F.col("worst_db"), 5).alias("worst"), fixed(F.col("rms_db"), 5).alias("rms"), "agrees")


@query(
    "p12_passband_check",
    f"""WITH l AS (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS stream_id, l_partkey % 1024 AS bin,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS level FROM lineitem),
psd AS (SELECT stream_id, bin, (bin - 512) * 78125.0::DOUBLE AS hz, floor(avg(level) * 10) / 1000000.0::DOUBLE AS psd FROM l GROUP BY 1, 2),
m AS (SELECT stream_id, median(psd) AS m FROM psd WHERE abs(hz) < 1e7 GROUP BY 1),
s AS (SELECT p.stream_id, bin, hz, sum(psd - m) OVER (PARTITION BY p.stream_id ORDER BY bin ROWS BETWEEN 16 PRECEDING AND 16 FOLLOWING) / 33 AS v FROM psd p JOIN m ON m.stream_id = p.stream_id),
k AS (SELECT * FROM s WHERE bin >= 33 AND bin < 991)
SELECT stream_id, {fx("max(v) FILTER (abs(hz) < 3.2e7) - min(v) FILTER (abs(hz) < 3.2e7)", 5)} AS ripple,
  coalesce({fx("median(v) FILTER (abs(hz) > 3.7e7) - median(v) FILTER (abs(hz) < 3.2e7)", 5)}, 0) AS edge FROM k GROUP BY 1""",
)
def passband(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.expr("CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END").alias("stream_id"),
        (F.col("l_partkey") % 1024).alias("bin"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("level"),
    )
    psd = rows.groupBy("stream_id", "bin").agg((F.floor(F.avg("level") * 10) / 1000000.0).alias("psd_db"))
    psd = psd.withColumn("hz", (F.col("bin") - 512) * 78125.0)
    c = sp.passband_check(psd, 1024, 8e7, edge_from=0.4625)
    return c.select(
        "stream_id",
        fixed(F.col("ripple_db"), 5).alias("ripple"),
        F.coalesce(fixed(F.col("edge_db"), 5), F.lit(0)).alias("edge"),
    )


@query(
    "p13_fm_discriminator",
    f"""WITH {INDEXED}, p AS (SELECT stream_id, sample, i::DOUBLE AS i, q::DOUBLE AS q, coalesce(lag(i::DOUBLE) OVER w, 0) AS pi, coalesce(lag(q::DOUBLE) OVER w, 0) AS pq
  FROM s WINDOW w AS (PARTITION BY stream_id ORDER BY sample))
SELECT stream_id, sample, {fx("atan2(q * pi - i * pq, i * pi + q * pq)", 6)} AS phase FROM p""",
)
def fm(spark, sf):
    b = sp.fm_discriminate(indexed_blocks(spark, sf), block=128)
    out = b.select("stream_id", "first_sample", F.posexplode("phase").alias("k", "phase"))
    return out.select("stream_id", (F.col("first_sample") + F.col("k")).alias("sample"), fixed(F.col("phase"), 6).alias("phase"))


TAPS = [0.05, 0.1, 0.2, 0.3, 0.2, 0.1, 0.05]


@query(
    "p14_decimate",
    f"""WITH {INDEXED}, h AS (SELECT unnest(range(0, 7)) AS t, unnest({TAPS}::DOUBLE[]) AS h),
o AS (SELECT stream_id, sample FROM s WHERE sample % 5 = 0)
SELECT o.stream_id, o.sample // 5 AS sample, {fx("sum(h.h * s.i)", 5)} AS y FROM o, h JOIN s ON s.stream_id = o.stream_id AND s.sample = o.sample - h.t GROUP BY 1, 2""",
)
def decimate(spark, sf):
    b = indexed_blocks(spark, sf).select("stream_id", "seq", "first_sample", F.col("i").alias("x"))
    d = sp.decimate(b, 5, TAPS, block=128).select("stream_id", "first_out", F.posexplode("y").alias("k", "y"))
    return d.select("stream_id", (F.col("first_out") + F.col("k")).alias("sample"), fixed(F.col("y"), 5).alias("y"))


@query(
    "p15_format_cross_check",
    f"""WITH {FRAME}, c AS (SELECT seq // 3 AS capture, CASE seq % 3 WHEN 0 THEN 'float32' WHEN 1 THEN 'float16' ELSE 'int16' END AS format,
    arg_max(freq_hz, (level_db, bin)) AS hz, max(level_db) AS level, count(*) FILTER (abs(level_db) < 1) / count(*) AS zeros FROM frame GROUP BY 1, 2)
SELECT c.capture, c.format, abs(c.hz - r.hz) < 2e7 AND abs(c.level - r.level) < 3 AS agrees, c.zeros < 0.05 AS resolved
FROM c JOIN c r ON r.capture = c.capture AND r.format = 'float32' WHERE c.format <> 'float32'""",
)
def cross_check(spark, sf):
    rows = explode_bins(frames(spark, sf))
    m = F.col("seq") % 3
    fmt = F.when(m == 0, "float32").when(m == 1, "float16").otherwise("int16")
    c = rows.groupBy(F.floor(F.col("seq") / 3).alias("capture"), fmt.alias("format")).agg(
        F.max_by("hz", F.struct("level_db", "bin")).alias("carrier_hz"),
        F.max("level_db").alias("level_db"),
        (F.count_if(F.abs("level_db") < 1) / F.count("*")).alias("zero_share"),
    )
    return sp.cross_check(c, max_hz=2e7).select("capture", "format", "agrees", "resolved")
