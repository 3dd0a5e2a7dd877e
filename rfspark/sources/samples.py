"""Samples of capture files, read by byte range.

What to read is itself a table, one row per range: filters on it decide which
bytes are ever touched, and Spark spreads the ranges over tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rfspark.functions.scalar import value_width
from rfspark.operators.decode import decode_scalars, decompress_spectra
from rfspark.operators.scan import DEFAULT_BLOCK, ordered_scan, total_before
from rfspark.sources.files import filesystem

BATCH_BYTES = 32 << 20  # read into one batch, about
SPREAD_BYTES = 64 << 20  # of one file, read by one task
IQ_PAYLOAD, SPECTRA_PAYLOAD = 2, 3
FLOAT_TYPES, INT16_TYPES = [5, 11], [2, 8]
MAX_COMPRESSED_BYTES = 16 << 20



def int16_scale(low: Column, high: Column) -> Column:
    """Value of one step of a 16-bit sample, from the sub-stream's value range."""
    top = F.greatest(F.abs(low), F.abs(high))
    return F.when((top > 0) & (top < float("inf")), top / 32768).otherwise(1.0 / 32768)


def _pieces(ranges: DataFrame, count: Column, block: int) -> DataFrame:
    """Cut ranges into blocks of samples, in two steps so that no row holds a long list."""
    far = block * 4096
    outer = ranges.withColumn("__n", count).filter(F.col("__n") > 0)
    outer = outer.withColumn("__far", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / far)))).withColumn(
        "__left", F.least(F.lit(far), F.col("__n") - F.col("__far") * far)
    )
    # A far piece is long and many chunks have only one, so they are dealt by their place in the file too.
    outer = outer.repartition("file", "__far", *[c for c in ("chunk_offset",) if c in outer.columns])
    inner = outer.withColumn("__near", F.explode(F.sequence(F.lit(0), F.floor((F.col("__left") - 1) / block))))
    start = F.col("__far") * far + F.col("__near") * block
    return (
        inner.withColumn("from_sample", start)
        .withColumn("n", F.least(F.lit(block), F.col("__n") - F.col("from_sample")).cast("int"))
        .drop("__n", "__far", "__left", "__near")
    )


def _read(f, at: int, size: int) -> bytes:
    f.seek(at)
    return f.read(size)


class Opened:
    """The file read last stays open for the next range of it."""

    def __init__(self):
        self.name, self.file = None, None

    def read(self, name: str, at: int, size: int) -> bytes:
        if name != self.name:
            self.close()
            system, inner = filesystem(name)
            self.file, self.name = system.open_input_file(inner), name
        return _read(self.file, at, size)

    def close(self):
        if self.file is not None:
            self.file.close()
        self.name, self.file = None, None


def _parts(batch, sizes):
    """A batch of ranges in parts whose bytes fit in memory together; a large range is a part of its own."""
    part = np.cumsum(np.array([s or 0 for s in sizes], np.int64)) // BATCH_BYTES
    first = np.flatnonzero(np.diff(part, prepend=-1))
    for lo, hi in zip(first, [*first[1:], len(part)]):
        yield batch.slice(int(lo), int(hi - lo))


def read_pairs(ranges: DataFrame) -> DataFrame:
    """Read I/Q ranges: ``file, at`` (byte), ``n, int16, scale``; adds ``n, i, q`` and ``read_error``.

    A range that goes past the end of its file gives the whole samples there are, and an error.
    """

    def run(batches):
        opened = Opened()
        for batch in batches:
            sizes = [n * (4 if short else 8) for n, short in zip(*(batch.column(c).to_pylist() for c in ("n", "int16")))]
            for part in _parts(batch, sizes):
                yield pairs(part, opened)
        opened.close()

    def pairs(batch, opened):
        lanes, counts, errors = [], [], []
        cols = (batch.column(c).to_pylist() for c in ("file", "at", "n", "int16", "scale"))
        for path, at, n, short, scale in zip(*cols):
            width = 4 if short else 8
            raw = opened.read(path, at, n * width)
            errors.append(None if len(raw) == n * width else "the file ends inside this range")
            raw = raw[: len(raw) // width * width]
            x = np.frombuffer(raw, "<i2" if short else "<f4").astype(np.float32)
            x = x * np.float32(scale) if short else np.where(np.isfinite(x), x, np.float32(0))
            lanes.append(x)
            counts.append(x.size // 2)
        flat = np.concatenate(lanes) if lanes else np.zeros(0, np.float32)
        ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        kept = batch.drop_columns(["int16", "scale", "at", "n"])
        return pa.RecordBatch.from_arrays(
            [
                *kept.columns,
                pa.array(counts, pa.int32()),
                pa.ListArray.from_arrays(ends, pa.array(flat[0::2].copy())),
                pa.ListArray.from_arrays(ends, pa.array(flat[1::2].copy())),
                pa.array(errors, pa.string()),
            ],
            names=[*kept.schema.names, "n", "i", "q", "read_error"],
        )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema if f.name not in ("int16", "scale", "at", "n")]
    return ranges.mapInArrow(run, ", ".join(fields) + ", n int, i array<float>, q array<float>, read_error string")


def _spread(ranges: DataFrame) -> DataFrame:
    """Ranges over tasks by file and stretch of the file, in order inside a task: one long file is many tasks."""
    dealt = ranges.withColumn("__stretch", F.floor(F.col("at") / SPREAD_BYTES)).repartition("file", "__stretch")
    return dealt.drop("__stretch").sortWithinPartitions("file", "at")


def with_first_sample(samp: DataFrame, block=DEFAULT_BLOCK << 10) -> DataFrame:
    """Index of each chunk's first sample within its sub-stream, in file order."""
    keys = ["file", "stream_id", "sub_stream_id"]
    return ordered_scan(samp, keys, "chunk_offset", {"first_sample": total_before(F.col("num_samples"))}, block)


def iq_problem() -> Column:
    kind, size = F.col("sample_type"), F.col("sample_size")
    readable = kind.isin(*FLOAT_TYPES, *INT16_TYPES)
    return (
        F.when(F.col("compression") > 0, "compressed IQ is not decoded")
        .when(~readable, "unsupported sample type for IQ")
        .when(size != 2, "IQ samples are pairs; the chunk declares another size")
        .when(F.col("fits") == 0, "the chunk holds no complete sample")
    )


def iq_index(samp: DataFrame, sstr: DataFrame) -> DataFrame:
    """One row per IQ chunk: where its samples lie, how many are there, or what is wrong."""
    scales = sstr.groupBy("file", "sub_stream_id").agg(
        F.max_by(F.struct("value_minimum", "value_maximum"), "chunk_offset").alias("range")
    )
    chunk = samp.filter(F.col("payload_type") == IQ_PAYLOAD).join(scales, ["file", "sub_stream_id"], "left")
    stride = F.col("sample_size") * value_width(F.col("sample_type"))
    room = F.col("size") - F.col("header_size")
    sized = chunk.withColumns(
        {
            "stride": stride,
            "fits": F.when(stride > 0, F.floor(room / stride)).otherwise(0),
            "int16": F.col("sample_type").isin(*INT16_TYPES),
            "scale": F.coalesce(int16_scale(F.col("range.value_minimum"), F.col("range.value_maximum")), F.lit(1.0 / 32768)),
        }
    )
    return sized.withColumn("error", iq_problem()).drop("range")


def load_iq(index: DataFrame, block: int = 65536) -> DataFrame:
    """I/Q blocks of the sound chunks of an index; filter the index first to read less.

    ``index`` is ``iq_index(with_first_sample(samp), sstr)``.
    """
    good = index.filter(F.col("error").isNull())
    cut = _pieces(good, F.least("num_samples", "fits"), block)
    at = F.col("chunk_offset") + F.col("header_size") + F.col("from_sample") * F.col("stride")
    ranges = cut.select(
        "file",
        "stream_id",
        "sub_stream_id",
        "chunk_offset",
        (F.col("first_sample") + F.col("from_sample")).alias("first_sample"),
        at.alias("at"),
        "n",
        "int16",
        "scale",
    )
    return read_pairs(_spread(ranges))


def load_raw_iq(tails: DataFrame, block: int = 65536) -> DataFrame:
    """Captures without sample chunks: float pairs from byte 0 up to ``stream_offset``."""
    cut = _pieces(tails.select("file", "stream_offset"), F.floor(F.col("stream_offset") / 8), block)
    ranges = cut.select(
        "file",
        F.col("from_sample").alias("first_sample"),
        (F.col("from_sample") * 8).alias("at"),
        "n",
        F.lit(False).alias("int16"),
        F.lit(1.0).alias("scale"),
    )
    return read_pairs(_spread(ranges))


def read_payloads(ranges: DataFrame) -> DataFrame:
    """Read ``bytes`` bytes at ``at`` of ``file`` into ``payload``; it is null where ``bytes`` is."""

    def run(batches):
        opened = Opened()
        for batch in batches:
            for part in _parts(batch, batch.column("bytes").to_pylist()):
                asked = zip(*(part.column(c).to_pylist() for c in ("file", "at", "bytes")))
                out = [None if size is None else opened.read(path, at, size) for path, at, size in asked]
                kept = part.drop_columns(["at", "bytes"])
                names = [*kept.schema.names, "payload"]
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(out, pa.binary())], names=names)
        opened.close()

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema if f.name not in ("at", "bytes")]
    return ranges.mapInArrow(run, ", ".join(fields) + ", payload binary")


def load_compressed_spectra(samp: DataFrame) -> DataFrame:
    """Frames of compressed spectra chunks; one block each, others keep a ``decode_error``."""
    room = F.col("size") - F.col("header_size")
    chosen = samp.filter(
        (F.col("payload_type") == SPECTRA_PAYLOAD) & F.col("sample_type").isin(*FLOAT_TYPES) & (F.col("compression") > 0)
    )
    ranges = chosen.select(
        "file",
        "chunk_offset",
        F.lit("spectra").alias("kind"),
        F.col("compression"),
        F.col("num_samples").alias("samples"),
        F.col("sample_size").alias("sampleSize"),
        F.lit(1).alias("sampleDepth"),
        (F.col("chunk_offset") + F.col("header_size")).alias("at"),
        room.alias("declared"),
        F.when(room <= MAX_COMPRESSED_BYTES, room).alias("bytes"),
    )
    frames = decompress_spectra(read_payloads(_spread(ranges)).withColumn("held", F.octet_length("payload")))
    wrong = (
        F.when(F.col("held").isNull(), "compressed chunk over the size cap")
        .when(F.col("held") == 0, "compressed chunk without data")
        .when(F.col("held") < F.col("declared"), "the file ends inside this chunk")
    )
    return frames.withColumns(
        {"decode_error": F.coalesce(wrong, "decode_error"), "values": F.when(wrong.isNull(), F.col("values"))}
    ).drop("held", "declared")


def load_spectra(samp: DataFrame) -> DataFrame:
    """Frames of plain float spectra chunks: one row per chunk with flat ``values``."""
    width = F.col("sample_size") * 4
    chosen = samp.filter(
        (F.col("payload_type") == SPECTRA_PAYLOAD) & F.col("sample_type").isin(*FLOAT_TYPES) & (F.col("compression") == 0)
    )
    fits = F.least("num_samples", F.floor((F.col("size") - F.col("header_size")) / width))
    ranges = chosen.select(
        "file",
        "chunk_offset",
        fits.alias("samples"),
        F.col("sample_size").alias("sampleSize"),
        F.lit("float32").alias("format"),
        (F.col("chunk_offset") + F.col("header_size")).alias("at"),
        (fits * width).alias("bytes"),
    )
    return decode_scalars(read_payloads(_spread(ranges)))
