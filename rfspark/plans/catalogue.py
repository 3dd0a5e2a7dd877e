"""Registered queries of capture files and their catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from rfspark.operators import catalogue as ca
from rfspark.plans.captures import broken_lake, capture_lake, survey_lake
from rfspark.plans.views import fixed, fx, table
from rfspark.sources import chunks as ch, samples as sm

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return keep


_tables: dict = {}


def _chunks(spark, sf, made=capture_lake):
    """The chunk table of a scale's files of a kind, written once per session."""
    lake = made(spark, sf)
    if lake not in _tables:
        _tables[lake] = ch.chunk_table(spark, lake, ".rf")
    return _tables[lake]


def numbered(df):
    """Capture number in place of the path."""
    return df.withColumn("number", F.regexp_extract("file", r"-(\d+)\.rf$", 1).cast("long"))


# What the capture files were written from.
LAKE = """v AS (SELECT vec_id, embedding, vec_id // 50 AS number, row_number() OVER (PARTITION BY vec_id // 50 ORDER BY vec_id) - 1 AS k FROM embeddings),
f AS (SELECT number, count(*) AS n, number % 4 = 3 AS raw FROM v GROUP BY 1),
s AS (SELECT v.*, k % 3 = 2 AS short FROM v WHERE number % 4 <> 3)"""


@query(
    "s1_chunk_catalogue",
    f"""WITH {LAKE}, c AS (
  SELECT number, 'DSFH' AS id, 1 AS n, 24 AS bytes FROM f UNION ALL SELECT number, 'STRM', 1, 48 FROM f UNION ALL SELECT number, 'STRT', 1, 96 FROM f
  UNION ALL SELECT number, 'DSFT', 1, 36 FROM f UNION ALL SELECT number, 'SSTR', 2, 480 FROM f WHERE NOT raw UNION ALL SELECT number, 'ANTA', 1, 264 FROM f WHERE NOT raw
  UNION ALL SELECT number, 'SSCA', 1, 168 FROM f WHERE NOT raw UNION ALL SELECT number, 'SPRV', 1, 408 FROM f WHERE NOT raw UNION ALL SELECT number, 'MDTT', 1, 496 FROM f WHERE NOT raw
  UNION ALL SELECT number, 'SAMP', count(*), sum(CASE WHEN short THEN 192 ELSE 320 END) FROM s GROUP BY 1)
SELECT number, id, CAST(n AS BIGINT) AS chunks, CAST(bytes AS BIGINT) AS bytes FROM c""",
)
def chunk_catalogue(spark, sf):
    c = numbered(ch.scan_chunks(spark, capture_lake(spark, sf), ".rf"))
    return c.groupBy("number", "id").agg(F.count("*").alias("chunks"), F.sum("size").alias("bytes"))


@query(
    "s2_sample_chunks",
    f"""WITH {LAKE} SELECT number, k, CAST(CASE WHEN short THEN 2 ELSE 1 END AS BIGINT) AS sub_stream_id, CASE WHEN short THEN 2 ELSE 5 END AS sample_type,
  CAST(32 AS BIGINT) AS num_samples, 1.7e9::DOUBLE + number + k AS start_time FROM s""",
)
def sample_chunks(spark, sf):
    s = numbered(ch.view(_chunks(spark, sf), "SAMP"))
    k = (F.col("start_time") - 1.7e9 - F.col("number")).cast("long")
    return s.select("number", k.alias("k"), "sub_stream_id", "sample_type", "num_samples", "start_time")


@query(
    "s2_substream_chunks",
    f"""WITH {LAKE} SELECT number, CAST(sub AS BIGINT) AS sub_stream_id, 1e9::DOUBLE + sub AS frequency_start,
  CASE WHEN sub = 1 THEN 1e6 WHEN number % 3 = 0 THEN -1 ELSE 5e5 END::DOUBLE AS frequency_step,
  CASE WHEN sub = 1 THEN 'main' WHEN number % 3 = 1 THEN '' ELSE 'aux' END AS name FROM f, (SELECT unnest([1, 2]) AS sub) WHERE NOT raw""",
)
def substream_chunks(spark, sf):
    s = numbered(ch.view(_chunks(spark, sf), "SSTR"))
    return s.select("number", "sub_stream_id", "frequency_start", "frequency_step", "name")


def _index(spark, sf):
    c = _chunks(spark, sf)
    return sm.iq_index(sm.with_first_sample(ch.view(c, "SAMP")), ch.view(c, "SSTR"))


# 16-bit samples step by 1/32768 of a value range of one.
@query(
    "s10_load_iq",
    f"""WITH {LAKE}, x AS (SELECT number, CAST(CASE WHEN short THEN 2 ELSE 1 END AS BIGINT) AS sub, 32 * (row_number() OVER (PARTITION BY number, short ORDER BY k) - 1) AS first, short, embedding FROM s),
y AS (SELECT number, sub, first + p AS sample, CASE WHEN short THEN greatest(-32768, least(32767, round_even(embedding[2*p+1]::DOUBLE * 32768, 0))) / 32768 ELSE embedding[2*p+1]::DOUBLE END AS i,
  CASE WHEN short THEN greatest(-32768, least(32767, round_even(embedding[2*p+2]::DOUBLE * 32768, 0))) / 32768 ELSE embedding[2*p+2]::DOUBLE END AS q FROM x, (SELECT unnest(range(0, 32)) AS p))
SELECT number, sub AS sub_stream_id, sample, i + 0.0 AS i, q + 0.0 AS q FROM y""",
)
def load_iq(spark, sf):
    b = numbered(sm.load_iq(_index(spark, sf), block=12))
    z = b.select("number", "sub_stream_id", "first_sample", F.posexplode(F.arrays_zip("i", "q")).alias("k", "z"))
    return z.select(
        "number",
        "sub_stream_id",
        (F.col("first_sample") + F.col("k")).alias("sample"),
        (F.col("z.i").cast("double") + 0.0).alias("i"),
        (F.col("z.q").cast("double") + 0.0).alias("q"),
    )


@query(
    "s11_load_raw_iq",
    """WITH v AS (SELECT embedding, vec_id // 50 AS number, 32 * (row_number() OVER (PARTITION BY vec_id // 50 ORDER BY vec_id) - 1) AS first FROM embeddings WHERE vec_id // 50 % 4 = 3)
SELECT number, first + p AS sample, CAST(embedding[2*p+1] AS DOUBLE) AS i, CAST(embedding[2*p+2] AS DOUBLE) AS q FROM v, (SELECT unnest(range(0, 32)) AS p)""",
)
def load_raw(spark, sf):
    c = _chunks(spark, sf)
    raw = ch.view(c, "DSFT").join(ch.view(c, "SAMP").select("file").distinct(), "file", "left_anti")
    b = numbered(sm.load_raw_iq(raw, block=100))
    z = b.select("number", "first_sample", F.posexplode(F.arrays_zip("i", "q")).alias("k", "z"))
    return z.select(
        "number",
        (F.col("first_sample") + F.col("k")).alias("sample"),
        F.col("z.i").cast("double").alias("i"),
        F.col("z.q").cast("double").alias("q"),
    )


NS = "CAST(1000000000 AS BIGINT)"
META = (
    LAKE
    + f""", meta AS (SELECT number, raw, n, CASE WHEN raw THEN 0 ELSE 1e6 END::DOUBLE AS rate, CASE WHEN raw THEN -1 ELSE 1e9 + 1 + 4e5 END::DOUBLE AS centre,
    CASE WHEN raw THEN 0 ELSE 8e5 END::DOUBLE AS width, 32 * n AS total, (1700000000 + number + 2) * {NS} AS start_ns,
    CASE WHEN raw THEN 0 WHEN number % 5 = 4 THEN (1700000000 + number + 2) * {NS} + 32 * n * 1000 ELSE (1700000000 + number + 4) * {NS} END AS end_ns,
    1.7e9::DOUBLE + number AS creation FROM f)"""
)


@query(
    "m7_capture_metadata",
    f"""WITH {META} SELECT number, rate AS sample_rate_hz, centre AS center_hz, width AS bandwidth_hz, total AS total_samples, start_ns AS start_time_ns,
  end_ns AS end_time_ns, creation AS creation_time_s, CASE WHEN raw THEN 'RAW_IQ' ELSE 'IQ_SAMPLES' END AS stream_type FROM meta""",
)
def capture_metadata(spark, sf):
    m = numbered(ca.capture_metadata(_chunks(spark, sf)))
    return m.select(
        "number",
        "sample_rate_hz",
        F.coalesce("center_frequency_hz", F.lit(-1.0)).alias("center_hz"),
        "bandwidth_hz",
        "total_samples",
        "start_time_ns",
        "end_time_ns",
        "creation_time_s",
        "stream_type",
    )


@query(
    "m8_first_sample_of_chunks",
    f"""WITH {LAKE} SELECT number, k, 32 * (row_number() OVER (PARTITION BY number, short ORDER BY k) - 1) AS first_sample FROM s""",
)
def first_sample(spark, sf):
    s = numbered(sm.with_first_sample(ch.view(_chunks(spark, sf), "SAMP"), block=4096))
    k = (F.col("start_time") - 1.7e9 - F.col("number")).cast("long")
    return s.select("number", k.alias("k"), "first_sample")


@query(
    "m9_follow_links",
    """WITH RECURSIVE o AS (SELECT o_custkey AS file, o_orderkey AS off, CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey + 1 ELSE
    coalesce(lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey), max(o_orderkey) OVER (PARTITION BY o_custkey)) END AS nxt
  FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderkey IS NOT NULL)),
w AS (SELECT file, max(off) AS off, 0 AS step FROM o GROUP BY 1
  UNION ALL SELECT o2.file, o2.off, w.step + 1 FROM w JOIN o ON o.file = w.file AND o.off = w.off JOIN o o2 ON o2.file = o.file AND o2.off = o.nxt WHERE o.nxt < o.off)
SELECT file, off AS "offset", CAST(step AS BIGINT) AS step FROM w""",
)
def follow_links(spark, sf):
    from pyspark.sql.window import Window

    # A place is any number here, and an order that is listed twice is one.
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("file"), F.col("o_orderkey").alias("chunk_offset"))
    o = o.dropna().distinct()
    w = Window.partitionBy("file").orderBy("chunk_offset")
    last = F.max("chunk_offset").over(Window.partitionBy("file"))
    # The first of a chain points back to its last, so every chain is a cycle unless broken.
    back = F.coalesce(F.lag("chunk_offset").over(w), last)
    nodes = o.withColumn("next", F.when(F.col("chunk_offset") % 11 == 0, F.col("chunk_offset") + 1).otherwise(back))
    roots = o.groupBy("file").agg(F.max("chunk_offset").alias("chunk_offset"))
    return ca.follow_links(nodes, roots).select("file", F.col("chunk_offset").alias("offset"), "step")


@query(
    "m9_linked_substreams",
    f"""WITH {LAKE} SELECT number, CAST(sub AS BIGINT) AS sub_stream_id, CAST(2 - sub AS BIGINT) AS step FROM f, (SELECT unnest([1, 2]) AS sub) WHERE NOT raw""",
)
def linked_substreams(spark, sf):
    return numbered(ca.linked_chunks(_chunks(spark, sf), "SSTR")).select("number", "sub_stream_id", "step")


@query(
    "m9_linked_chains",
    f"""WITH {LAKE}, c AS (SELECT number, 'ANTA' AS id, number % 3 + 1 AS n FROM f UNION ALL SELECT number, 'MDTT', number % 4 + 1 FROM f UNION ALL SELECT number, 'SPRV', number % 5 + 1 FROM f)
SELECT number, id, CAST(k AS BIGINT) AS nth, CAST(n - 1 - k AS BIGINT) AS step FROM c, (SELECT unnest(range(0, 5)) AS k) WHERE k < n""",
)
def linked_chains(spark, sf):
    c, parts = _chunks(spark, sf, survey_lake), []
    for kind, nth in (("ANTA", "antenna_id"), ("MDTT", "metadata_id"), ("SPRV", "level")):
        rows = numbered(ca.linked_chunks(c, kind))
        parts.append(rows.select("number", F.lit(kind).alias("id"), F.col(nth).cast("long").alias("nth"), "step"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _frame(rows, samp):
    """Frames with their chunk's number in its file, a row per bin."""
    k = samp.select("file", "chunk_offset", F.col("start_time").cast("long").alias("k"))
    return numbered(rows.join(k, ["file", "chunk_offset"])).select("number", "k", F.posexplode("values").alias("bin", "level"))


@query(
    "s10_load_spectra",
    f"""WITH {LAKE} SELECT number, k, CAST(b AS INTEGER) AS bin, CAST(embedding[b + 1] AS DOUBLE) AS level FROM v, (SELECT unnest(range(0, 64)) AS b) WHERE k % 2 = 0""",
)
def load_spectra(spark, sf):
    samp = ch.view(_chunks(spark, sf, survey_lake), "SAMP")
    return _frame(sm.load_spectra(samp), samp).withColumn("level", F.col("level").cast("double"))


@query(
    "s10_load_compressed_spectra",
    f"""WITH {LAKE}, c AS (
  SELECT number, k, vec_id, b, CAST(greatest(-3, least(3, floor(CAST(embedding[b+1] AS DOUBLE) * 8 + 0.5))) AS BIGINT) AS c FROM v, (SELECT unnest(range(0, 64)) AS b) WHERE k % 2 = 1),
lv AS (SELECT unnest([1, 2, 4, 8, 16, 32]) AS s),
d AS (
  SELECT p.number, p.k, p.vec_id, p.b, sum((CASE WHEN p.b & lv.s = 0 THEN 1 ELSE -1 END) * q.c * pow(sqrt(0.5::DOUBLE), log2(lv.s) + 1)) AS detail
  FROM c p, lv JOIN c q ON q.vec_id = p.vec_id AND q.b = (p.b - p.b % (2 * lv.s)) + lv.s GROUP BY 1, 2, 3, 4)
SELECT d.number, d.k, CAST(d.b AS INTEGER) AS bin, {fx("0.4 * (d.detail + r.c * pow(sqrt(0.5::DOUBLE), 6)) + 0.00001", 3)} AS level FROM d JOIN c r ON r.vec_id = d.vec_id AND r.b = 0""",
)
def load_compressed_spectra(spark, sf):
    samp = ch.view(_chunks(spark, sf, survey_lake), "SAMP")
    rows = _frame(sm.load_compressed_spectra(samp).filter("decode_error is null"), samp)
    return rows.withColumn("level", fixed(F.col("level").cast("double") + 0.00001, 3))


@query(
    "m11_unreadable_files",
    f"""WITH {LAKE} SELECT number, CASE WHEN number % 3 < 2 THEN 3 ELSE 1 END::BIGINT AS n_errors, 1::BIGINT AS n_unreadable, false AS valid,
  CASE number % 3 WHEN 0 THEN 'no chunk in this file' WHEN 1 THEN 'empty file' ELSE 'the file ends inside this chunk' END AS why FROM f""",
)
def unreadable_files(spark, sf):
    c = _chunks(spark, sf, broken_lake)
    captures = ca.capture_metadata(c)
    children = [ca.with_child_number(ch.view(c, kind), 4096) for kind in ("SSTR", "ANTA", "SPRV")]
    report = ca.validate_captures(captures, ca.capture_findings(captures, *children))
    why = c.groupBy("file").agg(F.max("error").alias("why"))
    return numbered(report.join(why, "file")).select("number", "n_errors", "n_unreadable", "valid", "why")


@query(
    "m10_orphan_chunks",
    """SELECT l_orderkey AS file, l_linenumber, l_partkey % 40 AS sub_stream_id FROM lineitem l WHERE NOT EXISTS
  (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_custkey % 40 = l.l_partkey % 40)""",
)
def orphan_chunks(spark, sf):
    samp = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("file"), "l_linenumber", (F.col("l_partkey") % 40).alias("sub_stream_id")
    )
    sstr = table(spark, sf, "orders").select(F.col("o_orderkey").alias("file"), (F.col("o_custkey") % 40).alias("sub_stream_id"))
    return ca.orphans(samp, sstr).select("file", "l_linenumber", "sub_stream_id")


def _findings(spark, sf):
    c = _chunks(spark, sf)
    captures = ca.capture_metadata(c)
    children = [ca.with_child_number(ch.view(c, kind), 4096) for kind in ("SSTR", "ANTA", "SPRV")]
    return captures, ca.capture_findings(captures, *children)


FOUND = (
    META
    + """, b AS (SELECT number, sum(CASE WHEN short THEN 192 ELSE 320 END) AS bytes FROM s GROUP BY 1),
found AS (
  SELECT number, 'error' AS severity, -1 AS k, 'stream tail reports a non-positive duration' AS text FROM meta WHERE raw OR number % 5 = 4
  UNION ALL SELECT m.number, 'warning', -1, 'sample count does not match the bytes found' FROM meta m JOIN b USING (number) WHERE abs(256 * n - bytes) > 256 * n // 10
  UNION ALL SELECT number, 'warning', 0, 'antenna has no segments' FROM meta WHERE NOT raw AND number % 2 = 0
  UNION ALL SELECT number, 'warning', 1, 'sub-stream has an invalid step' FROM meta WHERE NOT raw AND number % 3 = 0
  UNION ALL SELECT number, 'warning', 1, 'sub-stream has no name' FROM meta WHERE NOT raw AND number % 3 = 1)"""
)


@query("m11_validation_findings", f"WITH {FOUND} SELECT number, severity, CAST(k AS BIGINT) AS k, text FROM found")
def findings(spark, sf):
    f = numbered(_findings(spark, sf)[1])
    return f.select("number", "severity", F.coalesce("k", F.lit(-1)).alias("k"), "text")


@query(
    "m11_validation_report",
    f"""WITH {FOUND} SELECT m.number, count(f.number) FILTER (severity = 'error') = 0 AS valid, count(f.number) FILTER (severity = 'error') AS n_errors,
  count(f.number) FILTER (severity = 'warning') AS n_warnings FROM meta m LEFT JOIN found f ON f.number = m.number GROUP BY 1""",
)
def validation(spark, sf):
    r = numbered(ca.validate_captures(*_findings(spark, sf)))
    return r.select("number", "valid", "n_errors", "n_warnings")


@query(
    "m12_completeness",
    f"""WITH {META} SELECT number, CASE WHEN raw THEN {fx("(5 + 8 + 5 + 10) / 90.0::DOUBLE * 100", 6)} ELSE 100000000 END AS completeness FROM meta""",
)
def completeness(spark, sf):
    c = numbered(ca.with_completeness(ca.capture_metadata(_chunks(spark, sf))))
    return c.select("number", fixed(F.col("completeness"), 6).alias("completeness"))


@query(
    "m13_capture_flags",
    f"""WITH {META} SELECT number, NOT raw AS has_antenna_position, NOT raw AS has_previews, NOT raw AS has_structured_metadata,
  CASE WHEN raw THEN printf('Start: %.3fs, Duration: unknown', start_ns / 1e9) ELSE printf('Start: %.3fs, End: %.3fs, Duration: %.3fs', start_ns / 1e9, end_ns / 1e9, end_ns / 1e9 - start_ns / 1e9) END AS timing FROM meta""",
)
def flags(spark, sf):
    c = numbered(ca.with_capture_flags(ca.capture_metadata(_chunks(spark, sf))))
    return c.select("number", "has_antenna_position", "has_previews", "has_structured_metadata", "timing")


@query(
    "m14_preview_index",
    f"""WITH {LAKE} SELECT number, CAST(slot AS INTEGER) AS slot, 1.7e9::DOUBLE + number + 2 * slot AS time, 64 * slot AS sample
FROM f, (SELECT unnest(range(0, 16)) AS slot) WHERE NOT raw AND slot < n""",
)
def preview(spark, sf):
    p = numbered(ca.preview_index(ch.view(_chunks(spark, sf), "SPRV")))
    return p.select("number", "slot", "time", "sample")


@query(
    "m14_seek_preview",
    f"""WITH {LAKE}, p AS (SELECT number, 1.7e9::DOUBLE + number + 2 * slot AS t, 64 * slot AS sample FROM f, (SELECT unnest(range(0, 16)) AS slot) WHERE NOT raw AND slot < n),
r AS (SELECT number, vec_id AS request, 1.7e9::DOUBLE + number + vec_id % 37 AS t FROM v WHERE number % 4 <> 3)
SELECT r.number, request, coalesce(p.t, -1) AS time, coalesce(p.sample, -1) AS sample FROM r ASOF LEFT JOIN p ON p.number = r.number AND r.t >= p.t""",
)
def seek(spark, sf):
    index = ca.preview_index(ch.view(_chunks(spark, sf), "SPRV"))
    number = F.expr("vec_id div 50")
    r = table(spark, sf, "embeddings").filter(number % 4 != 3).select(
        number.alias("number"), F.col("vec_id").alias("request"), (F.lit(1.7e9) + number + F.col("vec_id") % 37).alias("time")
    )
    i = numbered(index).drop("file").withColumn("file", F.col("number").cast("string"))
    hits = ca.seek_preview(r.withColumn("file", F.col("number").cast("string")), i, block=10.0)
    return hits.select(
        F.col("file").cast("long").alias("number"),
        "request",
        F.coalesce("hit_time", F.lit(-1.0)).alias("time"),
        F.coalesce("sample", F.lit(-1)).alias("sample"),
    )


@query(
    "m15_default_substream",
    """SELECT l_orderkey AS file, arg_min(l_suppkey % 5, l_linenumber * 1000000 + l_partkey) AS sub_stream_id FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1""",
)
def default_sub(spark, sf):
    flag = F.when(F.col("l_returnflag") == "N", 1).otherwise(2)
    samp = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("file"),
        (F.col("l_suppkey") % 5).alias("sub_stream_id"),
        flag.alias("stream_id"),
        (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("chunk_offset"),
    )
    primary = samp.select("file", F.lit(1).alias("stream_id")).distinct()
    return ca.default_substream(samp, primary).select("file", "sub_stream_id")


@query(
    "m16_type_definitions",
    f"""WITH {LAKE}, t AS (SELECT unnest([{{'path': '', 'type': 'object', 'count': 2}}, {{'path': '/gain', 'type': 'float', 'count': 0}}, {{'path': '/tags', 'type': 'array', 'count': 4}},
  {{'path': '/tags/tag', 'type': 'string', 'count': 0}}]) AS x) SELECT number, x.path AS path, x.type AS type, CAST(x.count AS BIGINT) AS count FROM f, t WHERE NOT raw""",
)
def types(spark, sf):
    return numbered(ca.flatten_types(ch.view(_chunks(spark, sf), "MDTT"))).select("number", "path", "type", "count")


@query(
    "m17_categories_and_antennas",
    f"""WITH {LAKE} SELECT number, 'band' AS category, 1e9::DOUBLE AS start_frequency, CASE WHEN number % 2 = 1 THEN 1 ELSE -1 END AS red, 'dish' AS antenna, 48.0::DOUBLE AS latitude,
  false AS has_transform FROM f WHERE NOT raw""",
)
def categories(spark, sf):
    c = _chunks(spark, sf)
    cat = ca.substream_categories(ch.view(c, "SSCA")).select("file", F.col("name").alias("category"), "start_frequency", "red")
    ant = ca.antennas(ch.view(c, "ANTA")).select("file", F.col("name").alias("antenna"), "latitude", F.col("transform").isNotNull().alias("has_transform"))
    j = numbered(cat.join(ant, "file"))
    return j.select("number", "category", "start_frequency", F.coalesce("red", F.lit(-1)).alias("red"), "antenna", "latitude", "has_transform")
