"""Registered queries of the continuity operators, each with its SQL check."""

from __future__ import annotations

from pyspark.sql import functions as F

from rfspark.operators import continuity as ct
from rfspark.plans.views import (
    CREEP,
    HEALTH,
    PKT,
    SEQ_BLOCK,
    fixed,
    fx,
    health,
    packets,
)

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return keep


# Predecessor of every IQ packet, resets included.
LINK = (
    PKT
    + """, line AS (
  SELECT *, lag(payload) OVER w AS p_payload, lag(connection_id) OVER w AS p_conn,
         lag(start_time) OVER w AS p_start, lag(end_time) OVER w AS p_end
  FROM pkt WHERE payload IN ('iq', 'lost') WINDOW w AS (PARTITION BY stream_id ORDER BY seq)),
link AS (
  SELECT *, coalesce(p_payload = 'lost' OR p_conn <> connection_id, false) AS after_loss,
         CASE WHEN p_payload = 'iq' AND p_conn = connection_id THEN start_time - p_end END AS gap,
         CASE WHEN p_payload = 'iq' AND p_conn = connection_id AND p_end > p_start
                   AND end_time > start_time THEN least(end_time - start_time, p_end - p_start)
              WHEN end_time > start_time THEN end_time - start_time
              WHEN p_payload = 'iq' AND p_conn = connection_id AND p_end > p_start THEN p_end - p_start
         END AS shortest
  FROM line WHERE payload = 'iq')"""
)
GAPS = (
    LINK
    + """, gaps AS (
  SELECT *, CASE WHEN gap IS NULL THEN 'first' WHEN gap > shortest * 0.5 THEN 'drop'
                 WHEN -gap > shortest * 0.5 THEN 'backward' ELSE 'continuous' END AS gap_class
  FROM link)"""
)
TUNED = (
    GAPS
    + """, tuned AS (
  SELECT *, CASE WHEN lag(rate_hz) OVER w IS NULL THEN 'initial'
                 WHEN abs(lag(center_hz) OVER w - center_hz) > 1
                      OR abs(rate_hz - lag(rate_hz) OVER w) / lag(rate_hz) OVER w > 0.1 THEN 'retune'
            END AS geometry_change,
         gap_class IN ('drop', 'backward') OR after_loss AS is_gap,
         CAST(coalesce(sum(samples) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
           AS first_sample
  FROM gaps WINDOW w AS (PARTITION BY stream_id ORDER BY seq)),
numbered AS (
  SELECT *, CAST(sum(CASE WHEN is_gap OR geometry_change IS NOT NULL THEN 1 ELSE 0 END)
            OVER (PARTITION BY stream_id ORDER BY seq) AS BIGINT) AS epoch_id FROM tuned)"""
)
BREAKS = (
    TUNED
    + """, spots AS (
  SELECT stream_id, first_sample AS at_sample, bool_or(is_gap) AS gap,
         bool_or(coalesce(geometry_change = 'initial', false)) AS initial,
         arg_max(center_hz, seq) FILTER (geometry_change IS NOT NULL) AS center_hz,
         arg_max(rate_hz, seq) FILTER (geometry_change IS NOT NULL) AS rate_hz
  FROM tuned WHERE is_gap OR geometry_change IS NOT NULL GROUP BY 1, 2),
breaks AS (
  SELECT stream_id, at_sample, 0 AS place, 'gap' AS kind, NULL::DOUBLE AS center_hz, NULL::DOUBLE AS rate_hz
  FROM spots WHERE gap AND at_sample > 0
  UNION ALL
  SELECT stream_id, at_sample, 1, CASE WHEN initial THEN 'initial' ELSE 'retune' END,
         CAST(center_hz AS DOUBLE), CAST(rate_hz AS DOUBLE) FROM spots WHERE rate_hz IS NOT NULL)"""
)


def _spine(spark, sf):
    return ct.continuity(packets(spark, sf), block=SEQ_BLOCK)


@query(
    "g9_epochs",
    f"""WITH {TUNED}
SELECT stream_id, epoch_id, min(first_sample) AS first_sample, CAST(sum(samples) AS BIGINT) AS n_samples,
       count(*) AS n_packets, min(start_time) AS t_start, max(end_time) AS t_end,
       arg_min(center_hz, seq) AS center_hz, arg_min(rate_hz, seq) AS rate_hz,
       arg_min(CASE WHEN gap_class = 'drop' THEN gap ELSE 0 END, seq) AS lost_before,
       arg_min(concat_ws('+', CASE WHEN gap_class IN ('drop', 'backward') THEN gap_class END,
               CASE WHEN after_loss THEN 'reset' END, geometry_change), seq) AS opened_by
FROM numbered GROUP BY 1, 2""",
)
def epochs(spark, sf):
    return ct.epochs(_spine(spark, sf))


@query(
    "g1_gap_classes",
    f"WITH {GAPS} SELECT stream_id, seq, gap_class, coalesce(gap, 0) AS gap, after_loss FROM gaps",
)
def gap_classes(spark, sf):
    rows = ct.classify_gaps(packets(spark, sf), block=SEQ_BLOCK)
    return rows.select("stream_id", "seq", "gap_class", F.coalesce("gap", F.lit(0)).alias("gap"), "after_loss")


@query(
    "g1_fixed_tolerance",
    f"""WITH {LINK} SELECT stream_id, CASE WHEN gap IS NULL THEN 'first' WHEN gap > 3.6e9 THEN 'drop'
  WHEN -gap > 3.6e9 THEN 'backward' ELSE 'continuous' END AS gap_class, count(*) AS packets,
  CAST(sum(coalesce(gap, 0)) AS BIGINT) AS gap_sum FROM link GROUP BY 1, 2""",
)
def fixed_tolerance(spark, sf):
    rows = ct.classify_gaps(packets(spark, sf), tolerance=3.6e9, block=SEQ_BLOCK)
    return rows.groupBy("stream_id", "gap_class").agg(
        F.count("*").alias("packets"), F.sum(F.coalesce("gap", F.lit(0))).alias("gap_sum")
    )


# The feedback rule, row by row, as a recursion over each stream's rows.
ADAPT = (
    LINK
    + """, bound AS (
  SELECT *, greatest(4.0::DOUBLE, shortest * 0.5::DOUBLE) AS low, greatest(4.0::DOUBLE, shortest * 0.75::DOUBLE) AS high,
         row_number() OVER (PARTITION BY stream_id ORDER BY seq) AS rn FROM link),
walk AS (
  SELECT stream_id, seq, rn, 0.0::DOUBLE AS before, CASE WHEN gap IS NOT NULL AND abs(gap) <= low
         THEN abs(gap)::DOUBLE ELSE 0.0::DOUBLE END AS jitter FROM bound WHERE rn = 1
  UNION ALL
  SELECT b.stream_id, b.seq, b.rn, w.jitter,
         CASE WHEN b.gap IS NOT NULL AND (abs(b.gap) <= b.low OR (abs(b.gap) <= b.high AND abs(b.gap) <= 4.0::DOUBLE * w.jitter))
              THEN greatest(w.jitter * 0.999::DOUBLE, abs(b.gap)::DOUBLE) ELSE w.jitter END
  FROM walk w JOIN bound b ON b.stream_id = w.stream_id AND b.rn = w.rn + 1),
adapted AS (
  SELECT b.*, w.jitter, CASE WHEN b.gap IS NULL THEN 'first'
    WHEN abs(b.gap) <= b.low OR (abs(b.gap) <= b.high AND abs(b.gap) <= 4.0::DOUBLE * w.before) THEN 'continuous'
    WHEN b.gap > 0 THEN 'drop' ELSE 'backward' END AS gap_class
  FROM bound b JOIN walk w ON w.stream_id = b.stream_id AND w.rn = b.rn)"""
)


def _adaptive(spark, sf):
    return ct.classify_gaps_adaptive(packets(spark, sf), cap_s=None, ticks=1e6, block=SEQ_BLOCK)


@query(
    "g2_adaptive_tolerance",
    f"WITH RECURSIVE {ADAPT} SELECT stream_id, seq, gap_class, coalesce(gap, 0) AS gap FROM adapted",
)
def adaptive(spark, sf):
    return _adaptive(spark, sf).select("stream_id", "seq", "gap_class", F.coalesce("gap", F.lit(0)).alias("gap"))


@query(
    "g3_jitter_envelope",
    f"WITH RECURSIVE {ADAPT} SELECT stream_id, seq, {fx('jitter / 1000000', 3)} AS jitter_ms FROM adapted",
)
def jitter(spark, sf):
    rows = ct.with_jitter(_adaptive(spark, sf), SEQ_BLOCK)
    return rows.select("stream_id", "seq", fixed(F.col("jitter") / 1000000, 3).alias("jitter_ms"))


@query(
    "g4_gap_stats",
    f"""WITH {GAPS} SELECT stream_id, count(*) FILTER (gap_class = 'drop') AS drops,
  count(*) FILTER (gap_class = 'backward') AS backward_steps,
  CAST(coalesce(sum(gap) FILTER (gap_class = 'drop'), 0) AS BIGINT) AS gap_total,
  coalesce(max(abs(gap)) FILTER (gap_class = 'continuous'), 0) AS max_jitter FROM gaps GROUP BY 1""",
)
def gap_stats(spark, sf):
    return ct.gap_stats(ct.classify_gaps(packets(spark, sf), block=SEQ_BLOCK))


@query(
    "g5_retunes_announced_baseline",
    f"""WITH RECURSIVE {CREEP}, iq AS (
  SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY seq) AS rn FROM creep WHERE payload = 'iq'),
walk AS (
  SELECT stream_id, seq, rn, center_hz, rate_hz, 'initial' AS geometry_change FROM iq WHERE rn = 1
  UNION ALL
  SELECT i.stream_id, i.seq, i.rn,
    CASE WHEN abs(w.center_hz - i.center_hz) > 1 OR abs(i.rate_hz - w.rate_hz) / w.rate_hz > 0.1 THEN i.center_hz ELSE w.center_hz END,
    CASE WHEN abs(w.center_hz - i.center_hz) > 1 OR abs(i.rate_hz - w.rate_hz) / w.rate_hz > 0.1 THEN i.rate_hz ELSE w.rate_hz END,
    CASE WHEN abs(w.center_hz - i.center_hz) > 1 OR abs(i.rate_hz - w.rate_hz) / w.rate_hz > 0.1 THEN 'retune' END
  FROM walk w JOIN iq i ON i.stream_id = w.stream_id AND i.rn = w.rn + 1)
SELECT stream_id, seq, geometry_change, center_hz, rate_hz FROM walk WHERE geometry_change IS NOT NULL""",
)
def retunes(spark, sf):
    rows = ct.detect_retunes(packets(spark, sf, creep=True), SEQ_BLOCK)
    return rows.filter("geometry_change is not null").select(
        "stream_id", "seq", "geometry_change", "center_hz", "rate_hz"
    )


@query(
    "g5_retunes_by_neighbour",
    f"""WITH {TUNED} SELECT stream_id, seq, geometry_change, center_hz, rate_hz FROM tuned
WHERE geometry_change IS NOT NULL""",
)
def neighbour(spark, sf):
    rows = ct.detect_retunes(packets(spark, sf), SEQ_BLOCK)
    return rows.filter("geometry_change is not null").select(
        "stream_id", "seq", "geometry_change", "center_hz", "rate_hz"
    )


@query(
    "g6_subconnections",
    f"""WITH {PKT}, c AS (SELECT *, payload = 'lost' OR coalesce(lag(connection_id)
  OVER (PARTITION BY stream_id ORDER BY seq) <> connection_id, false) AS cut FROM pkt)
SELECT stream_id, seq, CAST(sum(CASE WHEN cut THEN 1 ELSE 0 END) OVER (PARTITION BY stream_id ORDER BY seq) AS BIGINT)
  AS subconnection FROM c""",
)
def subconnections(spark, sf):
    return ct.with_subconnection(packets(spark, sf), SEQ_BLOCK).select("stream_id", "seq", "subconnection")


@query(
    "g7_sample_index",
    f"""WITH {PKT} SELECT stream_id, seq, CAST(coalesce(sum(samples) OVER (PARTITION BY stream_id ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_sample FROM pkt WHERE payload = 'iq'""",
)
def sample_index(spark, sf):
    return ct.with_sample_index(packets(spark, sf), SEQ_BLOCK).select("stream_id", "seq", "first_sample")


@query(
    "g7_sample_index_of_turns",
    """SELECT conv_id AS stream_id, turn AS seq, CAST(coalesce(sum(length(text)) OVER (PARTITION BY conv_id
  ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_sample FROM conversations""",
)
def sample_index_of_turns(spark, sf):
    t = spark.read.parquet(f"{sf}/conversations.parquet").select(
        F.col("conv_id").alias("stream_id"),
        F.col("turn").alias("seq"),
        F.lit("iq").alias("payload"),
        F.length("text").alias("samples"),
    )
    return ct.with_sample_index(t).select("stream_id", "seq", F.col("first_sample").cast("long").alias("first_sample"))


@query("g8_break_log", f"WITH {BREAKS} SELECT stream_id, at_sample, place, kind, center_hz, rate_hz FROM breaks")
def break_log(spark, sf):
    return ct.break_log(_spine(spark, sf))


# Bits taken from the event number stand in for the device's packet flags.
SDK = """sdk AS (
  SELECT user_id % 16 AS stream_id, event_id AS seq,
         (event_id % 2) * 256 + (event_id // 2 % 3 // 2) * 512 + (event_id // 6 % 5 // 4) * 65536 AS flags,
         CAST(round(value) AS BIGINT) AS num, event_type <> 'error' AS valid_layout FROM events)"""


@query(
    "g10_flag_loss",
    f"""WITH {SDK} SELECT stream_id,
  CAST(sum(CASE WHEN num > 0 AND NOT valid_layout THEN 1 ELSE 0 END + CASE WHEN flags & 66048 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS drop_events,
  count(*) FILTER ((num > 0 AND NOT valid_layout) OR flags & 66304 <> 0) AS overruns FROM sdk GROUP BY 1""",
)
def flag_loss(spark, sf):
    sdk = spark.read.parquet(f"{sf}/events.parquet").select(
        (F.col("user_id") % 16).alias("stream_id"),
        F.expr("(event_id % 2) * 256 + (event_id div 2 % 3 div 2) * 512 + (event_id div 6 % 5 div 4) * 65536").alias("flags"),
        F.round("value").cast("long").alias("num"),
        (F.col("event_type") != "error").alias("valid_layout"),
    )
    return ct.flag_loss(sdk).groupBy("stream_id").agg(
        F.sum("drop_events").alias("drop_events"), F.count_if("overrun").alias("overruns")
    )


@query(
    "g11_overrun_per_block",
    f"""WITH {BREAKS}, lim AS (SELECT stream_id, sum(samples) AS total FROM tuned GROUP BY 1),
blk AS (SELECT stream_id, first_sample, samples AS n FROM tuned)
SELECT b.stream_id, b.first_sample, b.n, EXISTS (SELECT 1 FROM breaks k WHERE k.stream_id = b.stream_id
  AND k.at_sample >= b.first_sample AND k.at_sample < b.first_sample + b.n) AS overrun FROM blk b""",
)
def overrun(spark, sf):
    spine = _spine(spark, sf)
    blocks = spine.select("stream_id", "first_sample", F.col("samples").alias("n"))
    return ct.with_overrun(blocks, ct.break_log(spine))


@query(
    "g12_report_schedule",
    f"""WITH {GAPS}, c AS (SELECT stream_id, seq, gap_class, row_number() OVER (PARTITION BY stream_id, gap_class ORDER BY seq) AS nth
  FROM gaps WHERE gap_class IN ('drop', 'backward'))
SELECT stream_id, seq, gap_class, nth FROM c WHERE bit_count(nth) = 1
  AND (gap_class = 'backward' OR (nth & 6148914691236517205) <> 0)""",
)
def report_schedule(spark, sf):
    rows = ct.report_schedule(ct.classify_gaps(packets(spark, sf), block=SEQ_BLOCK), block=SEQ_BLOCK)
    return rows.select("stream_id", "seq", "gap_class", "nth")


@query(
    "g13_stream_accounting",
    f"""WITH {PKT}, a AS (SELECT stream_id, count(*) FILTER (payload = 'iq') AS iq_packets,
  count(*) FILTER (payload NOT IN ('iq', 'lost')) AS non_iq_skipped, count(*) FILTER (payload = 'lost') AS lost_to_parse_errors,
  CAST(coalesce(sum(samples) FILTER (payload = 'iq'), 0) AS BIGINT) AS iq_samples,
  CAST(max(end_time) - min(start_time) AS DOUBLE) AS span FROM pkt GROUP BY 1)
SELECT *, CASE WHEN span > 0 THEN iq_packets / (span / 1000000::DOUBLE) END AS packets_per_second,
  CASE WHEN span > 0 THEN iq_samples / (span / 1000000::DOUBLE) END AS samples_per_second FROM a""",
)
def accounting(spark, sf):
    return ct.stream_accounting(packets(spark, sf))


@query(
    "g13_accounting_rollup",
    f"""WITH {PKT} SELECT coalesce(CAST(stream_id AS VARCHAR), 'all') AS stream, coalesce(payload, 'all') AS payload,
  count(*) AS packets, CAST(sum(samples) AS BIGINT) AS samples FROM pkt GROUP BY ROLLUP (stream_id, payload)""",
)
def accounting_rollup(spark, sf):
    r = ct.accounting_rollup(packets(spark, sf))
    return r.select(
        F.coalesce(F.col("stream_id").cast("string"), F.lit("all")).alias("stream"),
        F.coalesce("payload", F.lit("all")).alias("payload"),
        "packets",
        "samples",
    )


@query(
    "g14_gap_attribution",
    f"""WITH {GAPS}, {HEALTH}, v AS (SELECT device_id, "at" AS t, seq, errors_per_second < 0.5
    AND coalesce(usb_overflows_per_second < 0.5, true) AS ok FROM health),
g AS (SELECT stream_id AS device_id, start_time AS t, seq FROM gaps WHERE gap_class = 'drop')
SELECT g.device_id, g.seq, CASE WHEN v.ok IS NULL THEN 'unknown' WHEN v.ok THEN 'downstream' ELSE 'device' END AS blame
FROM g ASOF LEFT JOIN v ON g.device_id = v.device_id AND g.t >= v.t""",
)
def gap_attribution(spark, sf):
    from rfspark.operators.health import losing_nothing

    gaps = ct.classify_gaps(packets(spark, sf), block=SEQ_BLOCK).filter("gap_class = 'drop'")
    h = health(spark, sf).withColumn("losing_nothing", losing_nothing())
    five_days = 432_000_000_000
    out = ct.attribute_gaps(
        gaps.select(F.col("stream_id").alias("device_id"), F.col("start_time").alias("at"), "seq"), h, five_days
    )
    return out.select("device_id", "seq", "blame")


@query(
    "g15_stalls",
    f"""WITH {PKT}, p AS (SELECT *, start_time - lag(start_time) OVER w AS silence, lag(connection_id) OVER w AS pc FROM pkt
  WINDOW w AS (PARTITION BY stream_id ORDER BY seq))
SELECT stream_id, connection_id, seq, silence FROM p WHERE pc = connection_id AND silence >= 3600000000""",
)
def stalls(spark, sf):
    return ct.stalls(packets(spark, sf), seconds=3600, ticks=1e6, block=SEQ_BLOCK)


@query(
    "g16_settle_trim",
    f"""WITH {TUNED}, e AS (SELECT *, min(first_sample) OVER (PARTITION BY stream_id, epoch_id) AS epoch_first,
    arg_min(coalesce(geometry_change = 'retune', false), seq) OVER (PARTITION BY stream_id, epoch_id) AS retuned FROM numbered),
s AS (SELECT *, CASE WHEN retuned THEN greatest(0, least(samples, CAST(ceil(0.0000015::DOUBLE * rate_hz) AS BIGINT)
    - (first_sample - epoch_first))) ELSE 0 END AS skip FROM e)
SELECT stream_id, seq, first_sample, CAST(skip AS BIGINT) AS skip, CAST(samples - skip AS BIGINT) AS kept FROM s WHERE samples > skip""",
)
def settle_trim(spark, sf):
    rows = ct.with_epoch_first(_spine(spark, sf), SEQ_BLOCK).withColumn("n", F.col("samples"))
    out = ct.trim_settle(rows, seconds=1.5e-6)
    return out.select("stream_id", "seq", "first_sample", F.col("skip").cast("long"), F.col("kept").cast("long"))
