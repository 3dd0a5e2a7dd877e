"""Payload bytes to samples and spectra, and back."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rfspark.functions import tables as t

DTYPES = {"int16": "<i2", "float16": "<f2", "float32": "<f4"}


def clean(x: Column) -> Column:
    """A value as float, with anything not finite as zero."""
    y = x.cast("float")
    return F.when(F.isnan(y) | (F.abs(y) == float("inf")), F.lit(0.0).cast("float")).otherwise(y)


def _scales(batch: pa.RecordBatch, default) -> np.ndarray:
    n = batch.num_rows
    fallback = np.full(n, float(default) if default else t.DEFAULT_INT16_SCALE)
    if "scale" not in batch.schema.names:
        return fallback
    s = np.array(batch.column("scale").cast(pa.float64()).to_pylist(), dtype=float)
    if default:
        s = np.where(np.isnan(s), float(default), s)
    return np.where(np.isfinite(s) & (s > 0), s, t.DEFAULT_INT16_SCALE)


def _values(batch: pa.RecordBatch, lanes: int, default_scale):
    """Decoded floats of a whole batch and the row offsets into them.

    ``lanes`` is 2 for I/Q pairs, 1 for scalars. Rows of one format are decoded
    together; a trailing partial sample is dropped.
    """
    payload = batch.column("payload").cast(pa.binary())
    formats = [f.lower() if f else "" for f in batch.column("format").to_pylist()]
    bounds = np.frombuffer(payload.buffers()[1], "<i4")[payload.offset : payload.offset + len(payload) + 1]
    data = payload.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    widths = np.array([np.dtype(DTYPES[f]).itemsize if f in DTYPES else 0 for f in formats])
    step = np.maximum(widths * lanes, 1)
    counts = np.where(widths > 0, (bounds[1:] - bounds[:-1]) // step * lanes, 0)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(offsets[-1], np.float32)
    scales = (1.0 / _scales(batch, default_scale)).astype(np.float32)
    starts = bounds[:-1].astype(np.int64)
    for name, dtype in DTYPES.items():
        rows = np.flatnonzero(np.array([f == name for f in formats]) & (counts > 0))
        if not rows.size:
            continue
        size = np.dtype(dtype).itemsize
        used = counts[rows] * size
        tight = np.array_equal(starts[rows][1:], starts[rows][:-1] + used[:-1])
        if tight:
            raw = data[starts[rows[0]] : starts[rows[-1]] + used[-1]]
        else:
            raw = np.concatenate([data[starts[k] : starts[k] + u] for k, u in zip(rows, used)])
        with np.errstate(over="ignore", invalid="ignore"):
            vals = np.frombuffer(raw.tobytes(), dtype).astype(np.float32)
        if name == "int16":
            vals *= np.repeat(scales[rows], counts[rows])
        vals[~np.isfinite(vals)] = 0
        if rows.size == len(formats):
            return vals, offsets
        for k, part in zip(rows, np.split(vals, np.cumsum(counts[rows])[:-1])):
            out[offsets[k] : offsets[k + 1]] = part
    return out, offsets


def _lists(offsets, values) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.float32()))


def _schema(df: DataFrame, drop: set, *extra) -> T.StructType:
    kept = [f for f in df.schema if f.name not in drop]
    return T.StructType(kept + [T.StructField(n, ty) for n, ty in extra])


def decode_iq(packets: DataFrame, scale: float | None = None) -> DataFrame:
    """Binary ``payload`` in its ``format`` to ``n, i, q``.

    int16 divides by the packet's ``scale``, else the stream's, else 32768.
    """

    def run(batches):
        for batch in batches:
            values, offsets = _values(batch, 2, scale)
            pairs = offsets // 2
            kept = batch.drop_columns(["payload"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(np.diff(pairs), pa.int32()), _lists(pairs, values[0::2]), _lists(pairs, values[1::2])],
                names=[*kept.schema.names, "n", "i", "q"],
            )

    floats = T.ArrayType(T.FloatType())
    return packets.mapInArrow(run, _schema(packets, {"payload"}, ("n", T.IntegerType()), ("i", floats), ("q", floats)))


def decode_scalars(packets: DataFrame, scale: float | None = None) -> DataFrame:
    """Binary spectra, histogram and category payloads to flat ``values``."""

    def run(batches):
        for batch in batches:
            values, offsets = _values(batch, 1, scale)
            kept = batch.drop_columns(["payload"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, _lists(offsets, values)], names=[*kept.schema.names, "values"]
            )

    return packets.mapInArrow(run, _schema(packets, {"payload"}, ("values", T.ArrayType(T.FloatType()))))


def decode_json(parsed: DataFrame) -> DataFrame:
    """Samples that came inside the header: ``values`` flat, or a ``decode_error``.

    IQ values alternate I and Q; spectra come as one list per frame.
    """
    flat = F.from_json("samples_json", "array<double>", {"mode": "PERMISSIVE"})
    framed = F.flatten(F.filter(F.from_json("samples_json", "array<array<double>>"), lambda x: x.isNotNull()))
    values = F.when(F.col("kind") == "spectra", framed).otherwise(flat)
    bad = F.col("__v").isNull() | F.exists("__v", lambda x: x.isNull())
    pairs = F.floor(F.size("__v") / 2).cast("int")

    def lane(first):
        steps = F.when(pairs > 0, F.sequence(F.lit(0), pairs - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(steps, lambda k: F.get(F.col("values"), k * 2 + first))

    out = parsed.withColumn("__v", values).withColumns(
        {
            "decode_error": F.when(bad, "invalid sample value"),
            "values": F.when(~bad, F.transform("__v", clean)),
        }
    )
    iq = (F.col("kind") == "iq") & F.col("values").isNotNull()
    return out.withColumns({"i": F.when(iq, lane(0)), "q": F.when(iq, lane(1))}).drop("__v")


def frames_of(decoded: DataFrame) -> DataFrame:
    """Cut flat ``values`` into ``samples`` frames of ``sampleSize`` bins and depth planes."""
    size = F.col("sampleSize")
    depth = F.greatest(F.coalesce(F.col("sampleDepth"), F.lit(1)), F.lit(1))
    last = (F.col("samples") * depth - 1).cast("int")
    cut = decoded.filter((F.col("samples") > 0) & (size > 0)).withColumn(
        "__k", F.explode(F.sequence(F.lit(0), last))
    )
    return cut.withColumns(
        {
            "frame": F.floor(F.col("__k") / depth).cast("int"),
            "plane": (F.col("__k") % depth).cast("int"),
            "bins": F.slice("values", F.col("__k") * size + 1, size),
            "start_hz": F.col("startFrequency"),
            "step_hz": (F.col("endFrequency") - F.col("startFrequency")) / size,
        }
    ).drop("__k", "values")


def decode_spectra(packets: DataFrame, scale: float | None = None) -> DataFrame:
    return frames_of(decode_scalars(packets, scale))


# --- compressed spectra ---------------------------------------------------

MAX_TIER = 9
MAX_FRAMES_PER_BLOCK = 16


def rice_values(data: bytes) -> np.ndarray:
    """Quantised numbers of one bit stream.

    A code is ``L`` zeros, a one, then ``3(L+1)`` bits: a magnitude counted from
    the end of the tier below, and a sign bit. A longer run of zeros, or a code
    cut short, is padding.
    """
    bits = np.unpackbits(np.frombuffer(data, np.uint8)).astype(np.int64)
    n = bits.size
    ones = np.flatnonzero(bits)
    if not ones.size:
        return np.zeros(0, np.int64)
    nxt = np.searchsorted(ones, np.arange(n))
    stop = np.where(nxt < ones.size, ones[np.minimum(nxt, ones.size - 1)], n + 64)
    tier = stop - np.arange(n)
    after = np.where((tier <= MAX_TIER) & (stop + 1 + 3 * (tier + 1) <= n), stop + 1 + 3 * (tier + 1), -1).tolist()
    starts, at = [], 0
    while at < n and after[at] >= 0:
        starts.append(at)
        at = after[at]
        if len(starts) > t.MAX_BLOCK_VALUES:
            raise ValueError("more values than a block may hold")
    starts = np.array(starts, np.int64)
    out = np.zeros(starts.size, np.int64)
    tiers = tier[starts] if starts.size else starts
    for level in np.unique(tiers):
        rows = np.flatnonzero(tiers == level)
        width = 3 * (int(level) + 1)
        first = starts[rows] + level + 1
        code = (bits[first[:, None] + np.arange(width)] << np.arange(width - 1, -1, -1)).sum(axis=1)
        base = sum(1 << (3 * k + 2) for k in range(int(level)))
        size = (code >> 1) + base
        out[rows] = np.where(code & 1, -size, size)
    return out


def unfold(blocks: np.ndarray) -> np.ndarray:
    """Inverse wavelet of stacked ``(block, row, column)`` grids, in place and in single precision.

    An axis has a level for each power of two that divides its length twice over.
    Levels are undone from the coarsest; where both axes have one, values along a
    row go first. A level of one axis touches only every ``step``-th line of the other.
    """
    levels = [
        (1 << k, axis) for axis, n in enumerate(blocks.shape[1:], 1) for k in range(n.bit_length()) if n % (2 << k) == 0
    ]
    scale = np.float32(np.sqrt(np.float32(0.5)))
    for step, axis in sorted(levels, reverse=True):
        lanes = np.moveaxis(blocks, axis, -1)[:, ::step]
        low, high = lanes[..., :: 2 * step], lanes[..., step :: 2 * step]
        low[...], high[...] = scale * (low + high), scale * (low - high)
    return blocks


def _refusal(kind, depth, rows, cols, factor):
    if kind != "spectra":
        return "compressed payload of this kind has no documented layout"
    if depth > 1:
        return "compressed spectra with depth planes have no documented layout"
    if rows < 1 or cols < 1:
        return "no frames or no bins declared"
    if rows > MAX_FRAMES_PER_BLOCK:
        return "more frames than one block holds"
    if rows * cols > t.MAX_BLOCK_VALUES:
        return "more values than a block may hold"
    if not 1 <= factor <= 31:
        return "compression factor out of range"
    return None


def decompress_spectra(blocks: DataFrame) -> DataFrame:
    """Compressed spectra blocks to flat ``values``, or a ``decode_error``.

    Reads ``payload, kind, compression, samples`` (frames), ``sampleSize,
    sampleDepth``. Blocks of equal shape in a batch are transformed together.
    """

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            errors, values, shapes = [None] * n, [None] * n, {}
            cols = {
                c: batch.column(c).to_pylist()
                for c in ("payload", "kind", "compression", "samples", "sampleSize", "sampleDepth")
            }
            for k in range(n):
                rows, width = int(cols["samples"][k] or 0), int(cols["sampleSize"][k] or 0)
                factor = int(cols["compression"][k] or 0)
                errors[k] = _refusal(cols["kind"][k], cols["sampleDepth"][k] or 1, rows, width, factor)
                if errors[k]:
                    continue
                try:
                    raw = rice_values(cols["payload"][k] or b"")
                except ValueError as e:
                    errors[k] = str(e)
                    continue
                grid = np.zeros(rows * width, np.float32)
                used = min(raw.size, grid.size)
                grid[:used] = raw[:used].astype(np.float32) * np.float32(np.float32(0.1) * np.float32(1 << (factor - 1)))
                shapes.setdefault((rows, width), []).append((k, grid))
            for (rows, width), members in shapes.items():
                stack = unfold(np.stack([g for _, g in members]).reshape(-1, rows, width))
                flat = np.where(np.isfinite(stack), stack, 0).reshape(len(members), -1)
                for (k, _), row in zip(members, flat):
                    values[k] = row
            kept = batch.drop_columns(["payload"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(values, pa.list_(pa.float32())), pa.array(errors, pa.string())],
                names=[*kept.schema.names, "values", "decode_error"],
            )

    floats = T.ArrayType(T.FloatType())
    return blocks.mapInArrow(run, _schema(blocks, {"payload"}, ("values", floats), ("decode_error", T.StringType())))


# --- encoding -------------------------------------------------------------


def to_int16(values: Column, scale: float) -> Column:
    """``round(v * scale)``, halves away from zero, kept within 16 bits."""

    def one(x):
        y = (x.cast("float") * F.lit(scale).cast("float")).cast("double")
        r = F.signum(y) * F.floor(F.abs(y) + 0.5)
        return F.greatest(F.lit(-32768), F.least(F.lit(32767), r)).cast("int")

    return F.transform(values, one)


def to_cs16(values: Column) -> Column:
    """Full scale at 32767, halves to even, kept within 16 bits."""
    return F.transform(
        values,
        lambda x: F.greatest(F.lit(-32768), F.least(F.lit(32767), F.rint(x.cast("double") * 32767))).cast("int"),
    )


def encode_iq(blocks: DataFrame, fmt: str, scale: float = t.DEFAULT_INT16_SCALE) -> DataFrame:
    """``i, q`` to little-endian ``payload`` bytes of a stream format."""
    if fmt not in DTYPES:
        raise ValueError(f"no binary payload in format {fmt}")

    def run(batches):
        for batch in batches:
            i, q = batch.column("i"), batch.column("q")
            pairs = np.empty((len(i.flatten()), 2), np.float32)
            pairs[:, 0], pairs[:, 1] = i.flatten().to_numpy(zero_copy_only=False), q.flatten().to_numpy(zero_copy_only=False)
            if fmt == "int16":
                y = (pairs * np.float32(scale)).astype(np.float64)
                pairs = np.clip(np.sign(y) * np.floor(np.abs(y) + 0.5), -32768, 32767)
            raw = pairs.astype(DTYPES[fmt]).tobytes()
            width = 2 * np.dtype(DTYPES[fmt]).itemsize
            ends = np.concatenate([[0], np.cumsum([len(x) for x in i])]) * width
            payload = pa.Array.from_buffers(
                pa.binary(), len(i), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(raw)]
            )
            kept = batch.drop_columns(["i", "q"])
            yield pa.RecordBatch.from_arrays([*kept.columns, payload], names=[*kept.schema.names, "payload"])

    return blocks.mapInArrow(run, _schema(blocks, {"i", "q"}, ("payload", T.BinaryType())))
