"""Registered queries of health and configuration trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from rfspark.operators import health as hl
from rfspark.plans.views import HEALTH, health, table

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return keep


def _spread(df, key):
    """One small file, but a tree is a hundred times its row: all cores take part. By key, as dealing rows in turn sorts them first."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def snapshots(spark, sf):
    """A health tree per event: one block with a status, some with a nested satellite block."""
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    e = _spread(e.select("event_id", "user_id", "ts", "event_type", "k"), "event_id")
    number = lambda name, value, kind="float": (
        f"""concat('{{"type":"{kind}","name":"{name}","label":"","value":', {value}, ',"default":0,"min":0,"max":100,"step":0.1}}')"""
    )
    text = lambda name, value: f"""concat('{{"type":"string","name":"{name}","label":"","value":"', {value}, '","default":""}}')"""
    tree = f"""concat('{{"type":"group","name":"healthstatus","label":"H","items":[',
      '{{"type":"group","name":"Server","label":"","items":[{{"type":"group","name":"info","label":"","items":[', {text("title", "'server'")}, ']}}]}},',
      '{{"type":"group","name":"Block","label":"","items":[{{"type":"bool","name":"on","value":true,"default":true}},',
      '{{"type":"group","name":"info","label":"","items":[', {text("devname", "concat('dev', user_id % 16)")}, ',', {text("serialno", "user_id % 16")}, ']}},',
      '{{"type":"group","name":"health","label":"","items":[', {number("fpgatemp", "k / 2")}, ',', {number("boardpower", "k", "integer")}, ']}},',
      '{{"type":"group","name":"status","label":"","items":[', {text("devstate", "event_type")},
      CASE WHEN k % 5 <> 0 THEN concat(',', {number("errors", "k / 100")}) ELSE '' END,
      CASE WHEN k % 2 = 0 THEN concat(',', {number("usboverflows", "k / 200")}) ELSE '' END,
      CASE WHEN k % 3 = 0 THEN concat(',', {number("dsboverflows", "k div 90", "integer")}) ELSE '' END,
      ',', {number("iqsamples", "61498321.75")}, ',', {number("gpsposvalid", "k % 2", "integer")}, ',', {number("gpstimevalid", "k % 3 div 2", "integer")},
      ',', {number("satellites", "k % 12", "integer")}, ',', {number("gpslatitude", "k / 4")}, ',', {number("gpslongitude", "-k / 8")},
      ',', {number("gpstime", "event_id + 0.5")}, ']}}',
      CASE WHEN k % 4 = 0 THEN concat(',{{"type":"group","name":"components","label":"","items":[{{"type":"group","name":"Satellite","label":"","items":[{{"type":"group","name":"status","label":"","items":[', {number("errors", "k / 10")}, ']}}]}}]}}') ELSE '' END,
      ']}}]}}')"""
    return e.select(
        F.col("event_id").alias("snapshot"),
        (F.col("user_id") % 16).alias("device_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        F.expr(tree).alias("tree"),
    )


EV = "ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"


@query(
    "h1_flatten_tree",
    f"""WITH {EV}, n AS (
  SELECT event_id, k, user_id, event_type, unnest(['healthstatus', 'healthstatus/Server', 'healthstatus/Server/info', 'healthstatus/Server/info/title', 'healthstatus/Block',
    'healthstatus/Block/on', 'healthstatus/Block/info', 'healthstatus/Block/info/devname', 'healthstatus/Block/info/serialno', 'healthstatus/Block/health',
    'healthstatus/Block/health/fpgatemp', 'healthstatus/Block/health/boardpower', 'healthstatus/Block/status', 'healthstatus/Block/status/devstate',
    'healthstatus/Block/status/iqsamples', 'healthstatus/Block/status/gpsposvalid', 'healthstatus/Block/status/gpstimevalid', 'healthstatus/Block/status/satellites',
    'healthstatus/Block/status/gpslatitude', 'healthstatus/Block/status/gpslongitude', 'healthstatus/Block/status/gpstime']) AS path FROM ev
  UNION ALL SELECT event_id, k, user_id, event_type, 'healthstatus/Block/status/errors' FROM ev WHERE k % 5 <> 0
  UNION ALL SELECT event_id, k, user_id, event_type, 'healthstatus/Block/status/usboverflows' FROM ev WHERE k % 2 = 0
  UNION ALL SELECT event_id, k, user_id, event_type, 'healthstatus/Block/status/dsboverflows' FROM ev WHERE k % 3 = 0
  UNION ALL SELECT event_id, k, user_id, event_type, unnest(['healthstatus/Block/components', 'healthstatus/Block/components/Satellite', 'healthstatus/Block/components/Satellite/status',
    'healthstatus/Block/components/Satellite/status/errors']) FROM ev WHERE k % 4 = 0),
t AS (SELECT *, split_part(path, '/', -1) AS name, CASE split_part(path, '/', -1) WHEN 'on' THEN 'bool' WHEN 'title' THEN 'string' WHEN 'devname' THEN 'string' WHEN 'serialno' THEN 'string'
    WHEN 'devstate' THEN 'string' WHEN 'boardpower' THEN 'integer' WHEN 'dsboverflows' THEN 'integer' WHEN 'gpsposvalid' THEN 'integer' WHEN 'gpstimevalid' THEN 'integer'
    WHEN 'satellites' THEN 'integer' WHEN 'healthstatus' THEN 'group' WHEN 'Server' THEN 'group' WHEN 'Block' THEN 'group' WHEN 'info' THEN 'group' WHEN 'health' THEN 'group'
    WHEN 'status' THEN 'group' WHEN 'components' THEN 'group' WHEN 'Satellite' THEN 'group' ELSE 'float' END AS type FROM n)
SELECT event_id AS snapshot, name, type, CASE WHEN path = name THEN 'none' ELSE split_part(path, '/', -2) END AS parent_name,
  CASE name WHEN 'on' THEN 'none' WHEN 'healthstatus' THEN 'H' ELSE '' END AS label, 0::BIGINT AS disabled, 'none' AS "values",
  CASE name WHEN 'on' THEN 'true' WHEN 'title' THEN 'server' WHEN 'devname' THEN 'dev' || user_id % 16 WHEN 'serialno' THEN CAST(user_id % 16 AS VARCHAR) WHEN 'devstate' THEN event_type ELSE 'none' END AS value_str,
  CASE WHEN type IN ('float', 'integer') THEN 0 ELSE -1 END::DOUBLE AS lowest, CASE WHEN type IN ('float', 'integer') THEN 100 ELSE -1 END::DOUBLE AS highest,
  CASE WHEN type IN ('float', 'integer') THEN 0.1 ELSE -1 END::DOUBLE AS step, path, CAST(len(path) - len(replace(path, '/', '')) AS INTEGER) AS depth,
  coalesce(CASE split_part(path, '/', -1) WHEN 'fpgatemp' THEN k / 2 WHEN 'boardpower' THEN k WHEN 'iqsamples' THEN 61498321.75 WHEN 'gpsposvalid' THEN k % 2
    WHEN 'gpstimevalid' THEN k % 3 // 2 WHEN 'satellites' THEN k % 12 WHEN 'gpslatitude' THEN k / 4 WHEN 'gpslongitude' THEN -k / 8 WHEN 'gpstime' THEN event_id + 0.5
    WHEN 'errors' THEN CASE WHEN path LIKE '%Satellite%' THEN k / 10 ELSE k / 100 END WHEN 'usboverflows' THEN k / 200 WHEN 'dsboverflows' THEN k // 90 END, -1)::DOUBLE + 0.0 AS v FROM t""",
)
def flatten(spark, sf):
    n = hl.flatten_tree(snapshots(spark, sf))
    number = lambda c: F.coalesce(c, F.lit(-1.0))
    text = [F.coalesce(c, F.lit("none")).alias(c) for c in ("parent_name", "type", "name", "label", "value_str", "values")]
    limits = [number("min").alias("lowest"), number("max").alias("highest"), number("step").alias("step")]
    return n.select("snapshot", "path", "depth", (number("value_num") + 0.0).alias("v"), *text, *limits, "disabled")


BLOCKS = (
    EV
    + """, blocks AS (
  SELECT event_id AS snapshot, user_id % 16 AS device_id, epoch_us(ts) AS t, 'Block' AS block_name, event_type AS device_state, CASE WHEN k % 5 <> 0 THEN k / 100 END AS errors,
    CASE WHEN k % 2 = 0 THEN k / 200 END AS usb, CASE WHEN k % 3 = 0 THEN (k // 90)::DOUBLE END AS dsp FROM ev
  UNION ALL SELECT event_id, user_id % 16, epoch_us(ts), 'Satellite', NULL, k / 10, NULL, NULL FROM ev WHERE k % 4 = 0)"""
)


@query(
    "h2_block_health",
    f"""WITH {BLOCKS} SELECT snapshot, block_name, coalesce(device_state, 'none') AS device_state, coalesce(errors, -1.0::DOUBLE) AS errors, coalesce(usb, -1.0::DOUBLE) AS usb,
  coalesce(dsp, -1.0::DOUBLE) AS dsp FROM blocks""",
)
def block_health(spark, sf):
    b = hl.block_health(hl.nested_tree(snapshots(spark, sf)))
    return b.select(
        "snapshot",
        "block_name",
        F.coalesce("device_state", F.lit("none")).alias("device_state"),
        F.coalesce("errors_per_second", F.lit(-1.0)).alias("errors"),
        F.coalesce("usb_overflows_per_second", F.lit(-1.0)).alias("usb"),
        F.coalesce("dsp_overflows_per_second", F.lit(-1.0)).alias("dsp"),
    )


@query(
    "h3_loss_verdict",
    f"""WITH {BLOCKS} SELECT snapshot, block_name, CASE WHEN errors IS NULL AND usb IS NULL AND dsp IS NULL THEN 'unknown'
  WHEN coalesce(errors < 0.5, true) AND coalesce(usb < 0.5, true) AND coalesce(dsp < 0.5, true) THEN 'clear' ELSE 'losing' END AS verdict FROM blocks""",
)
def loss_verdict(spark, sf):
    v = hl.loss_verdict(hl.block_health(hl.nested_tree(snapshots(spark, sf))))
    verdict = F.when(F.col("losing_nothing").isNull(), "unknown").when(F.col("losing_nothing"), "clear").otherwise("losing")
    return v.select("snapshot", "block_name", verdict.alias("verdict"))


@query(
    "h3_loss_verdict_of_polls",
    f"""WITH {HEALTH} SELECT device_id, CASE WHEN errors_per_second < 0.5 AND coalesce(usb_overflows_per_second < 0.5, true) THEN 'clear' ELSE 'losing' END AS verdict,
  count(*) AS polls FROM health GROUP BY 1, 2""",
)
def poll_verdict(spark, sf):
    v = health(spark, sf).withColumn("verdict", F.when(hl.losing_nothing(), "clear").otherwise("losing"))
    return v.groupBy("device_id", "verdict").agg(F.count("*").alias("polls"))


@query(
    "h4_sensors",
    f"""WITH {EV} SELECT event_id AS snapshot, k / 2 AS fpga_temp_c, k::DOUBLE AS board_power_w, CASE WHEN k % 5 <> 0 THEN k / 100 ELSE -1 END::DOUBLE AS errors,
  (k % 12)::DOUBLE AS satellites FROM ev""",
)
def sensors(spark, sf):
    s = hl.sensors(hl.nested_tree(snapshots(spark, sf)))
    return s.select(
        "snapshot",
        "fpga_temp_c",
        "board_power_w",
        F.coalesce("errors_per_second", F.lit(-1.0)).alias("errors"),
        F.col("gps_satellites").alias("satellites"),
    )


@query(
    "h6_gps_state",
    f"""WITH {EV} SELECT event_id AS snapshot, k % 2 = 1 AS position_valid, k % 3 // 2 = 1 AS time_valid, k % 12 AS satellites,
  CASE WHEN k % 2 = 1 THEN k / 4 ELSE -999 END::DOUBLE AS latitude, CASE WHEN k % 2 = 1 THEN -k / 8 ELSE -999 END::DOUBLE AS longitude,
  CASE WHEN k % 3 // 2 = 1 THEN event_id + 0.5 ELSE -1 END::DOUBLE AS time_s FROM ev""",
)
def gps(spark, sf):
    g = hl.gps_state(hl.nested_tree(snapshots(spark, sf)))
    return g.select(
        "snapshot",
        "position_valid",
        "time_valid",
        "satellites",
        F.coalesce("latitude", F.lit(-999.0)).alias("latitude"),
        F.coalesce("longitude", F.lit(-999.0)).alias("longitude"),
        F.coalesce("time_s", F.lit(-1.0)).alias("time_s"),
    )


def device_configs(spark, sf):
    """A configuration tree per customer."""
    text = """concat('{"type":"group","name":"remoteconfig","label":"","items":[{"type":"group","name":"Server","label":"","items":[{"type":"group","name":"info","label":"","items":[{"type":"string","name":"title","label":"","value":"server","default":""}]}]},',
      '{"type":"group","name":"Block","label":"","items":[{"type":"group","name":"info","label":"","items":[{"type":"string","name":"title","label":"","value":"', c_mktsegment, '","default":""}]},',
      '{"type":"group","name":"main","label":"","items":[{"type":"float","name":"centerfreq0","label":"","value":1200000000.0,"default":1,"min":', c_custkey % 5 * 1000, ',"max":', c_custkey % 7 * 1000, ',"step":1000},',
      '{"type":"enum","name":"decimation0","label":"","value":2,"default":0,"values":"all,half,,quarter,eighth,","disabled":', c_custkey % 8, '},',
      '{"type":"enum","name":"devicemode","label":"","value":', c_custkey % 4, ',"default":0,"values":"TX1 LO1,RX1 LO1 SWEEP,RX2 LO1,TX1 RX1"}]}]}]}')"""
    return _spread(table(spark, sf, "customer"), "c_custkey").select(
        F.col("c_custkey").alias("snapshot"), F.col("c_custkey").alias("device_id"), F.lit(0).cast("long").alias("at"), F.expr(text).alias("tree")
    )


def device_health(spark, sf):
    text = """concat('{"type":"group","name":"healthstatus","label":"","items":[{"type":"group","name":"Block","label":"","items":[{"type":"group","name":"info","label":"","items":[',
      CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('{"type":"string","name":"devname","label":"","value":"', c_name, '","default":""},') END,
      '{"type":"string","name":"serialno","label":"","value":"', c_custkey, '","default":""}]},{"type":"group","name":"status","label":"","items":[',
      '{"type":"string","name":"devstate","label":"","value":"Running","default":""},{"type":"float","name":"iqsamples","label":"","value":',
      CASE c_custkey % 3 WHEN 0 THEN 61498321.75 WHEN 1 THEN 163840000.0 ELSE 1000.0 END, ',"default":0}]}]}]}')"""
    return _spread(table(spark, sf, "customer"), "c_custkey").select(
        F.col("c_custkey").alias("snapshot"), F.col("c_custkey").alias("device_id"), F.lit(0).cast("long").alias("at"), F.expr(text).alias("tree")
    )


@query(
    "h5_capabilities",
    """WITH c AS (SELECT *, c_custkey % 5 * 1000 AS lo, c_custkey % 7 * 1000 AS hi, c_custkey % 8 AS m FROM customer),
o AS (SELECT *, (CASE WHEN m & 1 = 0 THEN 1 ELSE 0 END) + (CASE WHEN m & 2 = 0 THEN 1 ELSE 0 END) + 2 AS steps FROM c)
SELECT c_custkey AS device_id, CASE WHEN lo < hi THEN lo ELSE -1 END::DOUBLE AS center_min, CASE WHEN lo < hi THEN hi ELSE -1 END::DOUBLE AS center_max,
  steps AS steps, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE c_name END AS model, CAST(c_custkey AS VARCHAR) AS serial,
  CASE c_custkey % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'RX1' WHEN 2 THEN 'RX2' ELSE 'RX1' END AS rx,
  CASE c_custkey % 3 WHEN 0 THEN 61440000 / pow(2, steps - 1) WHEN 1 THEN 163840000 / pow(2, steps - 1) ELSE -1 END::DOUBLE AS slowest FROM o""",
)
def capabilities(spark, sf):
    c = hl.capabilities(hl.nested_tree(device_configs(spark, sf)), hl.nested_tree(device_health(spark, sf)))
    return c.select(
        "device_id",
        F.coalesce("center_frequency_hz.min", F.lit(-1.0)).alias("center_min"),
        F.coalesce("center_frequency_hz.max", F.lit(-1.0)).alias("center_max"),
        F.col("decimation_steps").alias("steps"),
        "model",
        "serial",
        F.coalesce("rx_antenna", F.lit("none")).alias("rx"),
        F.coalesce(F.element_at("sample_rates", -1), F.lit(-1.0)).alias("slowest"),
    )


@query(
    "h7_verify_applied",
    """WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
rq AS (SELECT user_id % 16 AS device_id, epoch_us(ts) AS t, event_id AS request, CASE WHEN k % 3 > 0 THEN k * 400 END AS c, CASE WHEN k % 4 > 0 THEN k % 10 END AS d, k / 200 AS l FROM e WHERE event_type = 'click'),
rb AS (SELECT user_id % 16 AS device_id, epoch_us(ts) AS t, CASE WHEN k % 7 > 0 THEN k * 400 END AS c, k % 10 AS d, k / 200 AS l FROM e WHERE event_type = 'view')
SELECT rq.device_id, rq.request, CASE WHEN rq.c IS NULL THEN 'none' WHEN rb.c IS NULL THEN 'missing' WHEN abs(rb.c - rq.c) <= 1000 THEN 'applied' ELSE 'refused' END AS center,
  CASE WHEN rq.d IS NULL THEN 'none' WHEN rb.d IS NULL THEN 'missing' WHEN rb.d = rq.d THEN 'applied' ELSE 'refused' END AS decimation,
  CASE WHEN rb.l IS NULL THEN 'missing' WHEN abs(rb.l - rq.l) <= 0.25 THEN 'applied' ELSE 'refused' END AS level,
  CASE WHEN rb.l IS NULL THEN 'missing' WHEN abs(rb.l - rq.l) < 0.001 THEN 'applied' ELSE 'refused' END AS parameter
FROM rq ASOF LEFT JOIN rb ON rq.device_id = rb.device_id AND rq.t <= rb.t""",
)
def verify(spark, sf):
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    base = [
        (F.col("user_id") % 16).alias("device_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
    ]
    level = (F.col("k") / 200).alias("level_dbm")
    param = (F.col("k") / 200).alias("parameter")
    requests = e.filter("event_type = 'click'").select(
        *base,
        F.col("event_id").alias("request"),
        F.when(F.col("k") % 3 > 0, (F.col("k") * 400).cast("double")).alias("center_hz"),
        F.when(F.col("k") % 4 > 0, F.col("k") % 10).alias("decimation_index"),
        level,
        param,
    )
    reads = e.filter("event_type = 'view'").select(
        *base,
        F.when(F.col("k") % 7 > 0, (F.col("k") * 400).cast("double")).alias("center_hz"),
        (F.col("k") % 10).alias("decimation_index"),
        level,
        param,
    )
    out = hl.verify_applied(requests, reads, block=432_000_000_000)
    names = ["center", "decimation", "level", "parameter"]
    return out.select("device_id", "request", *[F.coalesce(n, F.lit("none")).alias(n) for n in names])


@query(
    "h8_config_drift",
    """WITH o AS (SELECT o_custkey AS device_id, 'main/' || (o_orderkey % 97) AS path, o_orderstatus AS s, o_orderkey % 2 AS side FROM orders),
a AS (SELECT device_id, path, max(s) AS v FROM o WHERE side = 0 OR length(path) = 6 GROUP BY 1, 2), b AS (SELECT device_id, path, min(s) AS v FROM o WHERE side = 1 OR length(path) = 6 GROUP BY 1, 2)
SELECT coalesce(a.device_id, b.device_id) AS device_id, coalesce(a.path, b.path) AS path, CASE WHEN a.v IS NULL THEN 'added' WHEN b.v IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM a FULL JOIN b ON a.device_id = b.device_id AND a.path = b.path WHERE a.v IS DISTINCT FROM b.v""",
)
def drift(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("device_id"),
        F.concat(F.lit("main/"), (F.col("o_orderkey") % 97).cast("string")).alias("path"),
        F.col("o_orderstatus").alias("s"),
        (F.col("o_orderkey") % 2).alias("side"),
    )
    both = F.length("path") == 6
    a = o.filter((F.col("side") == 0) | both).groupBy("device_id", "path").agg(F.max("s").alias("value"))
    b = o.filter((F.col("side") == 1) | both).groupBy("device_id", "path").agg(F.min("s").alias("value"))
    return hl.config_drift(a, b).select("device_id", "path", "change")
