"""Packet headers: parsing, sizing, selection and the split of what cannot be decoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from rfspark.functions import tables as t
from rfspark.functions.scalar import iq_bytes_per_sample
from rfspark.operators.scan import once

PAYLOADS = ["iq", "spectra", "histogram", "categories"]

# Wire keys of a header. ``samples`` may be a count or the values themselves.
HEADER_SCHEMA = T.StructType(
    [
        T.StructField("startTime", T.DoubleType()),
        T.StructField("endTime", T.DoubleType()),
        T.StructField("startTimeDay", T.DoubleType()),
        T.StructField("endTimeDay", T.DoubleType()),
        T.StructField("startFrequency", T.DoubleType()),
        T.StructField("endFrequency", T.DoubleType()),
        T.StructField("sampleFrequency", T.DoubleType()),
        T.StructField("samples", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("minPower", T.IntegerType()),
        T.StructField("maxPower", T.IntegerType()),
        T.StructField("sampleDepth", T.IntegerType()),
        T.StructField("sampleSize", T.IntegerType()),
        T.StructField("scale", T.DoubleType()),
        T.StructField(
            "antenna",
            T.StructType(
                [T.StructField("name", T.StringType())]
                + [T.StructField(n, T.DoubleType()) for n in ("latitude", "longitude", "azimuth", "declination")]
            ),
        ),
        T.StructField(
            "categories",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("startFrequency", T.DoubleType()),
                        T.StructField("endFrequency", T.DoubleType()),
                    ]
                )
            ),
        ),
        T.StructField("compression", T.IntegerType()),
    ]
)
REQUIRED = [
    "startTime", "endTime", "startFrequency", "endFrequency", "unit", "minPower", "maxPower", "sampleSize",
]


def parse_headers(packets: DataFrame) -> DataFrame:
    """Turn the JSON ``header`` into columns; ``header_error`` says why one is no header.

    ``samples`` becomes a count in either form; ``samples_json`` keeps the values
    of the array form.
    """
    h = F.from_json("header", HEADER_SCHEMA)
    raw = F.trim(F.col("__h.samples"))
    is_list = raw.startswith("[")
    number = raw.try_cast("double")
    count = F.when(is_list, F.size(F.from_json(raw, "array<string>")).cast("long")).when(
        (number >= 0) & (number < 9.2e18), number.cast("long")
    )
    fields = [f.name for f in HEADER_SCHEMA if f.name not in ("samples", "payload")]
    parsed = once(once(packets, "__h", h), "__count", count).select(
        *packets.columns,
        *[F.col(f"__h.{n}").alias(n) for n in fields],
        F.col("__count").alias("samples"),
        F.when(is_list, raw).alias("samples_json"),
        F.when(F.col("__h.payload").isin(*PAYLOADS), F.col("__h.payload")).alias("kind"),
    )
    missing = F.array_compact(
        F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in [*REQUIRED, "samples", "kind"]])
    )
    return parsed.withColumn(
        "header_error",
        F.when(F.length("header") > t.MAX_HEADER_BYTES, "header too long").when(
            F.size(missing) > 0, F.concat(F.lit("bad or missing: "), F.array_join(missing, ","))
        ),
    )


def with_expected_bytes(parsed: DataFrame, fmt: str | None = None) -> DataFrame:
    """Bytes the payload must have; null, with ``size_error``, where that cannot be said.

    Reads ``kind, samples, sampleSize, sampleDepth, categories, compression`` and
    the stream's ``format`` (or ``fmt`` for all of them).
    """
    width = iq_bytes_per_sample(F.lit(fmt) if fmt else F.col("format")).cast("long")
    samples, size = F.col("samples"), F.col("sampleSize").cast("long")
    depth = F.greatest(F.coalesce(F.col("sampleDepth"), F.lit(1)), F.lit(1)).cast("long")
    entries = F.when(F.col("categories").isNull(), size).otherwise(F.size("categories").cast("long"))
    kind = F.col("kind")
    framed = kind.isin("spectra", "histogram")
    packed = framed & (F.coalesce(F.col("compression"), F.lit(0)) > 0)

    def times(*xs):
        out = xs[0]
        for x in xs[1:]:
            out = F.try_multiply(out, x)
        return out

    need = (
        F.when(packed, F.lit(None).cast("long"))
        .when(kind == "iq", times(samples, width))
        .when(framed, times(samples, size, depth, (width / 2).cast("long")))
        .when(kind == "categories", times(F.greatest(samples, F.lit(1)), entries, (width / 2).cast("long")))
    )
    return once(parsed, "expected_bytes", need).withColumn(
        "size_error",
        F.when(width.isNull(), "no fixed payload size in this format")
        .when(packed, "compressed payload carries no byte length")
        .when(F.col("expected_bytes").isNull(), "payload size overflows")
        .when(F.col("expected_bytes") > t.MAX_PAYLOAD_BYTES, "payload size over the cap"),
    )


def with_outcome(sized: DataFrame) -> DataFrame:
    """``outcome`` of each framed packet: ``packet``, ``lost`` or ``skipped``.

    What cannot be decoded is lost if it held IQ, or if nothing is known about
    it; a packet whose header names another payload takes only itself.
    """
    short = F.when(F.octet_length("payload") < F.col("expected_bytes"), "payload shorter than declared")
    reason = F.coalesce("header_error", "size_error", short)
    unknown = F.col("header_error").isNotNull() | (F.col("size_error") == "payload size over the cap")
    return once(sized, "reason", reason).withColumn(
        "outcome",
        F.when(F.col("reason").isNull(), "packet")
        .when(F.coalesce(unknown, F.lit(False)) | (F.col("kind") == "iq"), "lost")
        .otherwise("skipped"),
    )


def split_dead_letters(sized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Packets to decode, and the rest with their reasons."""
    marked = with_outcome(sized)
    return marked.filter("outcome = 'packet'"), marked.filter("outcome <> 'packet'")


def limit_packets(packets: DataFrame, n: int) -> DataFrame:
    """The first ``n`` packets of every stream, as the stream option asks for."""
    if n < 1:
        raise ValueError("limit must be at least 1")
    nth = F.row_number().over(Window.partitionBy("stream_id").orderBy("seq"))
    return packets.withColumn("__nth", nth).filter(F.col("__nth") <= n).drop("__nth")


def select_input(packets: DataFrame, name: str = "main") -> DataFrame:
    return packets.filter(F.coalesce(F.col("input"), F.lit("main")) == name)


def thin_frames(frames: DataFrame, n: int) -> DataFrame:
    """Keep every ``n``-th frame: time reduction of frame payloads."""
    if n < 1:
        raise ValueError("rate reduction must be at least 1")
    return frames.filter(F.col("frame") % n == 0)
