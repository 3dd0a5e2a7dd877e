"""Capture files as records: what they hold, whether they are sound, where to seek."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rfspark.functions.scalar import file_epoch_seconds
from rfspark.operators.scan import latest, ordered_scan, salted_join, total_before
from rfspark.session import cut
from rfspark.sources.chunks import view

GIGA = 1e9
# Score of each part of the metadata that is known, and their sum.
COMPLETENESS = {
    "sample_rate_hz": 5,
    "center_frequency_hz": 5,
    "bandwidth_hz": 5,
    "total_samples": 5,
    "start_time_ns": 8,
    "end_time_ns": 7,
    "stream_type": 5,
    "n_sub_streams": 15,
    "n_antennas": 15,
    "n_previews": 10,
    "tail": 10,
}


def follow_links(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Chunks reachable from each file's root over backward links, with their step.

    ``nodes`` are ``file, chunk_offset, next`` of one kind, ``roots`` ``file,
    chunk_offset``. Reach doubles every round: after ``k`` rounds the jumps span
    ``2^k`` links, so a chain of a thousand takes ten joins over all files at
    once. A null link, or one to nothing, ends its chain; a cycle adds no new chunk, and the
    rounds stop. A chunk or root that is listed twice counts once.
    """
    known = nodes.select("file", "chunk_offset").distinct()
    jumps = (
        nodes.select("file", F.col("chunk_offset").alias("at"), F.col("next").alias("to"))
        .distinct()
        .join(known.withColumnRenamed("chunk_offset", "to"), ["file", "to"])
    )
    reach = cut(roots.distinct().join(known, ["file", "chunk_offset"]).withColumn("step", F.lit(0).cast("long")), "reach")
    jumps, span, seen = cut(jumps, "jumps"), 1, reach.count()
    while True:
        further = reach.withColumnRenamed("chunk_offset", "at").join(jumps, ["file", "at"]).select(
            "file", F.col("to").alias("chunk_offset"), (F.col("step") + span).alias("step")
        )
        reach = cut(
            reach.unionByName(further).groupBy("file", "chunk_offset").agg(F.min("step").alias("step")), "reach"
        )
        count = reach.count()
        if count == seen:
            return reach
        seen, span = count, span * 2
        second = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("end"))
        jumps = cut(jumps.join(second, ["file", "to"]).select("file", "at", F.col("end").alias("to")), "jumps")
        if jumps.isEmpty():
            return reach


LINKS = {
    "SSTR": ("sub_stream_offset", "sub_stream_offset"),
    "ANTA": ("antenna_offset", "antenna_offset"),
    "MDTT": ("metadata_offset", "metadata_offset"),
}


def linked_chunks(chunks: DataFrame, kind: str) -> DataFrame:
    """Typed chunks of a kind that a file's stream tail leads to.

    A preview's link is the first positive place it lists. In a file a link of zero is none.
    """
    typed, tails = view(chunks, kind), view(chunks, "STRT")
    if kind == "SPRV":
        first = F.filter("offsets", lambda o: o > 0)
        nodes = typed.withColumn("next", F.get(first, F.lit(0)))
        roots = tails.select("file", F.col("preview_offset").alias("chunk_offset"))
    else:
        link, root = LINKS[kind]
        nodes = typed.withColumn("next", F.when(F.col(link) > 0, F.col(link)))
        roots = tails.select("file", F.col(root).alias("chunk_offset"))
    reach = follow_links(nodes, roots.filter(F.col("chunk_offset") > 0).distinct())
    return typed.join(reach, ["file", "chunk_offset"])


def orphans(samp: DataFrame, sstr: DataFrame) -> DataFrame:
    """Sample chunks whose sub-stream nothing describes."""
    return samp.join(sstr.select("file", "sub_stream_id").distinct(), ["file", "sub_stream_id"], "left_anti")


def default_substream(samp: DataFrame, primary: DataFrame) -> DataFrame:
    """The sub-stream to read where none is asked for: the primary stream's first in the file."""
    mine = samp.join(primary.select("file", "stream_id"), ["file", "stream_id"])
    return mine.groupBy("file").agg(
        F.min_by("sub_stream_id", "chunk_offset").alias("sub_stream_id"), F.min("stream_id").alias("stream_id")
    )


def capture_metadata(chunks: DataFrame) -> DataFrame:
    """One record per file: rate, centre, span, samples and times, with their fallbacks.

    Each kind of chunk is brought to one row per file before anything is joined.
    Every file has a record; one without a header chunk, without a stream, or
    with chunks that cannot be read says so in ``error``.
    """
    files = chunks.groupBy("file").agg(F.count("error").alias("n_unreadable"))
    head = view(chunks, "DSFH").groupBy("file").agg(F.min_by("creation_time", "chunk_offset").alias("creation"))
    strm = view(chunks, "STRM").groupBy("file").agg(
        F.min_by(F.struct("stream_id", "start_time", "capture_start"), "chunk_offset").alias("strm"),
        F.count_distinct("stream_id").alias("num_streams"),
    )
    sub = view(chunks, "SSTR")
    centre = F.col("frequency_start") + F.col("frequency_span") / 2
    subs = sub.groupBy("file").agg(
        F.count_distinct("sub_stream_id").alias("n_sub_streams"),
        F.min_by(F.struct(centre.alias("centre"), F.col("frequency_span").alias("span")), "chunk_offset").alias("first_sub"),
        F.min_by("frequency_step", F.when(F.col("frequency_step") > 0, F.col("chunk_offset"))).alias("any_step"),
    )
    tail = view(chunks, "STRT").groupBy("file").agg(
        F.min_by(F.struct("num_samples", "payload_size", "end_time"), "chunk_offset").alias("tail")
    )
    foot = view(chunks, "DSFT").groupBy("file").agg(F.max_by("stream_offset", "chunk_offset").alias("stream_offset"))
    ant = view(chunks, "ANTA")
    ants = ant.groupBy("file").agg(
        F.count_distinct("antenna_id").alias("n_antennas"),
        F.bool_or((F.col("latitude") != 0) | (F.col("longitude") != 0)).alias("has_position"),
    )
    previews = view(chunks, "SPRV").groupBy("file").agg(F.count("*").alias("n_previews"))
    types = view(chunks, "MDTT").groupBy("file").agg(F.count_if(F.size("types") > 0).alias("n_types"))
    samp = salted_join(view(chunks, "SAMP"), strm.select("file", F.col("strm.stream_id").alias("primary")), "file")
    own = F.col("stream_id") == F.col("primary")
    sums = samp.groupBy("file").agg(
        F.count("*").alias("n_chunks"),
        F.sum("size").alias("sample_data_size"),
        F.sum(F.when(own, F.col("num_samples"))).alias("sum_samples"),
        F.min_by("sub_stream_id", F.when(own, F.col("chunk_offset"))).alias("sub_stream_id"),
    )
    described = sub.groupBy("file", "sub_stream_id").agg(
        F.max_by(
            F.struct(F.col("frequency_step").alias("step"), centre.alias("centre"), F.col("frequency_span").alias("span")),
            "chunk_offset",
        ).alias("iq")
    )
    out = files
    for part in (head, strm, subs, tail, foot, ants, previews, types, sums):
        out = out.join(part, "file", "left")
    return _derived(out.join(described, ["file", "sub_stream_id"], "left"))


def _derived(c: DataFrame) -> DataFrame:
    sampled = F.coalesce(F.col("n_chunks"), F.lit(0)) > 0
    own = F.col("sub_stream_id").isNotNull()
    creation = file_epoch_seconds(F.col("creation"))
    opened = F.col("strm.start_time") + F.coalesce(F.col("strm.capture_start"), F.lit(0.0))
    step = F.when(own, F.col("iq.step")).otherwise(0.0)
    rate = F.when(step > 0, step).otherwise(F.coalesce("any_step", step))
    raw = F.when(sampled, 0).otherwise(F.floor(F.coalesce("stream_offset", F.lit(0)) / 8))
    declared = F.when(own, F.coalesce("tail.num_samples", F.lit(0))).otherwise(raw)
    summed = F.coalesce("sum_samples", F.lit(0))
    span = F.when(own, F.col("iq.span")).otherwise(0.0)
    ns = lambda s: F.greatest(F.lit(0), (s * GIGA).cast("long"))
    c = c.withColumns(
        {
            "error": F.when(F.col("creation").isNull(), "no readable file header")
            .when(F.col("strm").isNull(), "no readable stream header")
            .when(own & F.col("iq").isNull(), "sub-stream of the samples is not described")
            .when(sampled & ~own & F.col("tail").isNull(), "no samples of the primary stream and no stream tail")
            .when(F.col("n_unreadable") > 0, "chunks that cannot be read"),
            "sample_rate_hz": rate,
            "center_frequency_hz": F.coalesce(F.when(own, F.col("iq.centre")), F.col("first_sub.centre")),
            "total_samples": F.when(declared == 0, summed).otherwise(declared),
            "creation_time_s": creation,
            "__start": F.when(ns(opened) == 0, ns(creation)).otherwise(ns(opened)),
        }
    )
    tail_end = F.when(own & (F.col("tail.end_time") > 0), ns(opened) + ns(F.col("tail.end_time"))).otherwise(F.lit(0))
    known = (F.col("sample_rate_hz") > 0) & (F.col("total_samples") > 0)
    derived = F.col("__start") + ns(F.col("total_samples") / F.col("sample_rate_hz"))
    return c.select(
        "file",
        "error",
        "sample_rate_hz",
        "center_frequency_hz",
        F.when(span > 0, span).otherwise(F.coalesce("first_sub.span", "sample_rate_hz")).alias("bandwidth_hz"),
        "total_samples",
        F.col("__start").alias("start_time_ns"),
        F.when((tail_end == 0) & known, derived).otherwise(tail_end).alias("end_time_ns"),
        "creation_time_s",
        F.coalesce("num_streams", F.lit(0)).alias("num_streams"),
        F.col("creation").isNotNull().alias("has_header"),
        "n_unreadable",
        F.col("strm.stream_id").alias("primary_stream_id"),
        "sub_stream_id",
        F.when(sampled, "IQ_SAMPLES").otherwise("RAW_IQ").alias("stream_type"),
        F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"),
        F.coalesce("sample_data_size", F.lit(0)).alias("sample_data_size"),
        F.coalesce("n_sub_streams", F.lit(0)).alias("n_sub_streams"),
        F.coalesce("n_antennas", F.lit(0)).alias("n_antennas"),
        F.coalesce("has_position", F.lit(False)).alias("has_position"),
        F.coalesce("n_previews", F.lit(0)).alias("n_previews"),
        F.coalesce("n_types", F.lit(0)).alias("n_types"),
        "tail",
        F.when(sampled, F.lit(None)).otherwise(F.col("stream_offset")).alias("raw_bytes"),
    )


def with_completeness(captures: DataFrame) -> DataFrame:
    """Per cent of the metadata that is known, by weight."""

    def known(name):
        if name in ("center_frequency_hz", "stream_type", "tail"):
            return F.col(name).isNotNull()
        return F.coalesce(F.col(name) > 0, F.lit(False))

    score = sum((F.when(known(n), w).otherwise(0) for n, w in COMPLETENESS.items()), F.lit(0))
    return captures.withColumn("completeness", score / float(sum(COMPLETENESS.values())) * 100)


def with_capture_flags(captures: DataFrame) -> DataFrame:
    start, end = F.col("start_time_ns") / GIGA, F.col("end_time_ns") / GIGA
    length = F.col("total_samples") / F.col("sample_rate_hz")
    timing = (
        F.when(
            F.col("end_time_ns") > 0,
            F.format_string("Start: %.3fs, End: %.3fs, Duration: %.3fs", start, end, end - start),
        )
        .when(
            (F.col("sample_rate_hz") > 0) & (F.col("total_samples") > 0),
            F.format_string("Start: %.3fs, Duration: %.3fs (calculated)", start, length),
        )
        .otherwise(F.format_string("Start: %.3fs, Duration: unknown", start))
    )
    return captures.withColumns(
        {
            "has_antenna_position": F.col("has_position"),
            "has_previews": F.col("n_previews") > 0,
            "has_structured_metadata": F.col("n_types") > 0,
            "timing": timing,
        }
    )


def with_child_number(children: DataFrame, block=1 << 30) -> DataFrame:
    """Number the chunks of a kind within their file, from 0; ``block`` is a stretch of bytes."""
    return ordered_scan(children, "file", "chunk_offset", {"k": total_before(F.lit(1).cast("long"))}, block)


def _findings(df: DataFrame, rules: list, numbered: bool) -> DataFrame:
    """One row per broken rule: ``file, severity, k, text``."""
    k = F.col("k") if numbered else F.lit(None).cast("long")
    hits = [
        F.when(bad, F.struct(F.lit(severity).alias("severity"), k.alias("k"), F.lit(text).alias("text")))
        for severity, bad, text in rules
    ]
    return df.select("file", F.explode(F.array_compact(F.array(*hits))).alias("f")).select("file", "f.*")


def capture_findings(captures: DataFrame, sstr: DataFrame, anta: DataFrame, sprv: DataFrame) -> DataFrame:
    """Errors and warnings of all files as rows; children carry their number ``k``."""
    expected = F.try_multiply(F.col("total_samples"), F.lit(8).cast("long"))
    off = F.abs(expected - F.col("sample_data_size")) > F.floor(expected / 10)
    counted = (F.col("total_samples") > 0) & (F.col("sample_data_size") > 0)
    has_subs = F.col("n_sub_streams") > 0
    tail = F.col("tail").isNotNull()
    own = [
        ("error", ~F.col("has_header"), "no readable file header"),
        ("error", F.col("num_streams") == 0, "no readable stream header"),
        ("error", F.col("n_unreadable") > 0, "chunks that cannot be read"),
        ("error", (F.col("end_time_ns") > 0) & (F.col("end_time_ns") <= F.col("start_time_ns")), "end time is not after start time"),
        (
            "error",
            tail & (F.isnan("tail.end_time") | (F.col("tail.end_time") <= 0)),
            "stream tail reports a non-positive duration",
        ),
        ("warning", (F.col("sample_rate_hz") <= 0) & has_subs, "sample rate unknown"),
        ("warning", F.col("center_frequency_hz").isNull() & has_subs, "centre frequency unknown"),
        ("warning", counted & expected.isNull(), "sample count too large for any payload"),
        ("warning", counted & off, "sample count does not match the bytes found"),
        (
            "warning",
            tail & (F.col("tail.num_samples") > 0) & (F.col("tail.payload_size") == 0),
            "stream tail has samples but no payload",
        ),
    ]
    sub = [
        ("error", F.col("frequency_span") <= 0, "sub-stream has an invalid span"),
        ("warning", F.col("frequency_step") <= 0, "sub-stream has an invalid step"),
        ("warning", F.col("name") == "", "sub-stream has no name"),
    ]
    antenna = [
        ("warning", F.col("name") == "", "antenna has no name"),
        ("warning", F.col("num_segments") == 0, "antenna has no segments"),
    ]
    preview = [
        ("error", F.least("count", F.lit(16)) != F.col("count"), "preview count does not match its places"),
        ("error", F.size("offsets") != F.size("times"), "preview places and times differ"),
    ]
    return (
        _findings(captures, own, False)
        .unionByName(_findings(sstr, sub, True))
        .unionByName(_findings(anta, antenna, True))
        .unionByName(_findings(sprv, preview, True))
    )


def validate_captures(captures: DataFrame, findings: DataFrame) -> DataFrame:
    """Count of errors and warnings of every file; valid means no error."""
    counts = findings.groupBy("file").agg(
        F.count_if(F.col("severity") == "error").alias("n_errors"),
        F.count_if(F.col("severity") == "warning").alias("n_warnings"),
    )
    report = captures.join(counts, "file", "left").fillna(0, ["n_errors", "n_warnings"])
    return report.withColumn("valid", F.col("n_errors") == 0)


def preview_index(sprv: DataFrame) -> DataFrame:
    """Seek points: the used slots of every preview chunk as rows."""
    slots = F.arrays_zip(F.col("offsets").alias("o"), F.col("times").alias("t"), F.col("samples").alias("s"))
    used = sprv.select("file", "chunk_offset", "level", "count", F.posexplode(slots).alias("slot", "z"))
    return used.filter(F.col("slot") < F.col("count")).select(
        "file",
        "chunk_offset",
        "level",
        "slot",
        F.col("z.o").alias("preview_offset"),
        F.col("z.t").alias("time"),
        F.col("z.s").alias("sample"),
    )


def seek_preview(requests: DataFrame, index: DataFrame, block: float) -> DataFrame:
    """For each ``file, time, request``, the last seek point at or before that time."""
    point = F.struct("time", "preview_offset", "sample")
    left = index.select("file", "time", F.lit(0).alias("rank"), F.lit(None).cast("bigint").alias("request"), point.alias("p"))
    right = requests.select(
        "file", "time", F.lit(1).alias("rank"), "request", F.lit(None).cast("struct<time:double,preview_offset:bigint,sample:bigint>").alias("p")
    )
    rows = ordered_scan(left.unionByName(right), "file", ["time", "rank", "request"], {"hit": latest(F.col("p"))}, block)
    return rows.filter(F.col("rank") == 1).select(
        "file", "request", "time", F.col("hit.time").alias("hit_time"), "hit.preview_offset", "hit.sample"
    )


def flatten_types(mdtt: DataFrame) -> DataFrame:
    """Type definitions as one row per element with its path."""
    return mdtt.select("file", "metadata_id", F.inline("types"))


# Validity bits of categories and antennas.
FREQUENCY_VALID, COLOR_VALID = 1, 2
LOCATION_VALID, TRANSFORM_VALID, DIRECTION_VALID, ROTATION = 1, 2, 4, 8


def _valid(bit: int, x: Column) -> Column:
    return F.when(F.col("flags").bitwiseAND(bit) != 0, x)


def substream_categories(ssca: DataFrame) -> DataFrame:
    """Categories with the fields their flags vouch for; others are null."""
    return ssca.withColumns(
        {
            **{c: _valid(FREQUENCY_VALID, F.col(c)) for c in ("start_frequency", "end_frequency")},
            **{c: _valid(COLOR_VALID, F.col(c)) for c in ("red", "green", "blue", "alpha")},
        }
    )


def antennas(anta: DataFrame) -> DataFrame:
    rows = F.array(*[F.array(*[F.col(f"t{4 * r + c}") for c in range(4)]) for r in range(4)])
    return anta.withColumns(
        {
            **{c: _valid(LOCATION_VALID, F.col(c)) for c in ("latitude", "longitude")},
            "transform": _valid(TRANSFORM_VALID, rows),
            "rotates": F.col("flags").bitwiseAND(ROTATION) != 0,
        }
    ).drop(*[f"t{k}" for k in range(16)])
