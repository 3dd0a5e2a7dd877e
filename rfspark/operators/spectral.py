"""Spectra over time, power in bands, signal statistics and checks.

Frames carry ``stream_id, seq, frame, start_hz, step_hz, bins``; ``frame`` counts
frames along a stream. Where a whole array becomes rows, the aggregate that
follows has a map-side part, so what is shuffled is one row per bin and task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from rfspark.functions.scalar import db_to_linear, linear_to_db
from rfspark.operators.geometry import band_join
from rfspark.operators.quantile import quantile
from rfspark.operators.scan import DEFAULT_BLOCK, ordered_scan, peak, previous

TRACES = {"average": F.avg, "maxhold": F.max, "minhold": F.min}
SILENT_DBM = -120.0
FALLOFF_DB = 8.0
TINY = 1e-30
# Rows that carry sample arrays are scanned in shorter blocks: a block is one window partition.
ARRAY_BLOCK = 1 << 10


def trace(bins: DataFrame, window: int, kinds=("average", "maxhold", "minhold")) -> DataFrame:
    """Average, maximum or minimum of each bin over ``window`` frames.

    ``bins`` has one row per bin: ``stream_id, frame, bin, level_db``.
    """
    group = F.floor(F.col("frame") / window).alias("window")
    return bins.groupBy("stream_id", group, "bin").agg(*[TRACES[k]("level_db").alias(k) for k in kinds])


def max_fall(bins: DataFrame, db_per_frame, block=DEFAULT_BLOCK) -> DataFrame:
    """Running maximum of each bin that falls by ``db_per_frame`` every frame."""
    fall = F.col("frame") * F.lit(db_per_frame)
    lifted = ordered_scan(bins, ["stream_id", "bin"], "frame", {"__top": peak(F.col("level_db") + fall)}, block)
    return lifted.withColumn("maxfall", F.col("__top") - fall).drop("__top")


def power_histogram(bins: DataFrame, lo: float, hi: float, levels: int) -> DataFrame:
    """Share, in per cent, of each power level in every bin."""
    level = F.width_bucket("level_db", F.lit(lo), F.lit(hi), F.lit(levels)).alias("level")
    counts = bins.groupBy("stream_id", "bin", level).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy("stream_id", "bin"))
    return counts.withColumn("percent", F.col("n") * 100.0 / whole)


def waterfall(bins: DataFrame, n: int) -> DataFrame:
    """``n`` frames become one line."""
    line = F.floor(F.col("frame") / n).alias("line")
    return bins.groupBy("stream_id", line, "bin").agg(F.avg("level_db").alias("level_db"))


def channel_power(bins: DataFrame, bands: DataFrame, bucket_hz: float) -> DataFrame:
    """Power of each frame inside each band, from bins at ``hz`` in ``[start, end)``."""
    inside = band_join(bins, bands, bucket_hz, closed=False)
    power = inside.groupBy("stream_id", "seq", "band").agg(
        F.sum(db_to_linear(F.col("level_db"))).alias("linear"), F.count("*").alias("n_bins")
    )
    return power.withColumn("power_db", linear_to_db(F.col("linear")))


def marker_values(packets: DataFrame) -> DataFrame:
    """Named values of marker packets: spectra with categories and no frequencies."""
    markers = packets.filter(
        (F.col("kind") == "spectra")
        & F.col("categories").isNotNull()
        & (F.col("startFrequency") == 0)
        & (F.col("endFrequency") == 0)
    )
    return markers.select(
        "*", F.posexplode(F.arrays_zip(F.col("categories").alias("c"), F.col("values").alias("v"))).alias("k", "z")
    ).select("stream_id", "seq", "k", F.col("z.c.name").alias("marker"), F.col("z.c.startFrequency").alias("start_hz"), F.col("z.v").alias("value"))


def _energy(i="i", q="q") -> Column:
    squares = F.zip_with(i, q, lambda a, b: a.cast("double") * a + b.cast("double") * b)
    return F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)


def channel_survey(blocks: DataFrame, channels, center_hz: float, rate_hz: float, threshold_db: float) -> DataFrame:
    """Estimated power of each channel per stream: mean power less a falloff from centre.

    ``channels`` is a short list of ``(name, hz)``, the receiver's own setup.
    """
    means = blocks.select("stream_id", "n", _energy().alias("__e")).groupBy("stream_id").agg(
        (F.sum("__e") / F.sum("n")).alias("mean_power")
    )
    listed = F.array(*[F.struct(F.lit(n).alias("channel"), F.lit(float(hz)).alias("hz")) for n, hz in channels])
    rows = means.select("stream_id", "mean_power", F.inline(listed))
    away = F.abs(F.col("hz") - center_hz)
    half = rate_hz / 2
    power = F.when(away > half, F.lit(SILENT_DBM)).otherwise(
        F.log10("mean_power") * 10 - away / half * FALLOFF_DB
    )
    return rows.withColumn("power_db", power).withColumn("active", F.col("power_db") > threshold_db)


def strongest(survey: DataFrame) -> DataFrame:
    """The strongest channel of each stream; of equals, the last listed."""
    return survey.groupBy("stream_id").agg(
        F.max_by("channel", F.struct("power_db", "hz")).alias("channel"), F.max("power_db").alias("power_db")
    )


def iq_stats(blocks: DataFrame, block: float = 1 / 256) -> DataFrame:
    """Finite, RMS, peak, median magnitude and exact zeros per stream."""
    samples = blocks.select("stream_id", F.inline(F.arrays_zip("i", "q"))).withColumns(
        {
            "__m": F.sqrt(F.col("i").cast("double") * F.col("i") + F.col("q").cast("double") * F.col("q")),
            "__z": (F.col("i") == 0) & (F.col("q") == 0),
        }
    )
    totals = samples.groupBy("stream_id").agg(
        F.count("*").alias("n"),
        F.bool_and(~F.isnan("__m") & (F.col("__m") < float("inf"))).alias("finite"),
        F.sqrt(F.avg(F.col("__m") * F.col("__m"))).alias("rms"),
        F.max("__m").alias("peak"),
        F.avg(F.col("__z").cast("double")).alias("zero_share"),
    )
    med = quantile(samples, "stream_id", "__m", 0.5, block, "median").drop("n_values")
    return totals.join(med, "stream_id").withColumn("mostly_nonzero", F.col("zero_share") < 0.5)


def segment_power(segments: DataFrame, nfft: int) -> DataFrame:
    """Power spectrum of each block of ``nfft`` samples, Hann window, zero in the middle."""
    window = np.hanning(nfft)

    def run(batches):
        for batch in batches:
            i = batch.column("i").flatten().to_numpy(zero_copy_only=False).astype(float)
            q = batch.column("q").flatten().to_numpy(zero_copy_only=False).astype(float)
            x = (i + 1j * q).reshape(-1, nfft) * window
            power = np.abs(np.fft.fftshift(np.fft.fft(x, axis=1), axes=1)) ** 2
            offsets = np.arange(len(x) + 1, dtype=np.int32) * nfft
            kept = batch.drop_columns(["i", "q"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(power.ravel()))],
                names=[*kept.schema.names, "power"],
            )

    fields = [f for f in segments.schema if f.name not in ("i", "q")]
    return segments.mapInArrow(run, T.StructType(fields + [T.StructField("power", T.ArrayType(T.DoubleType()))]))


def segments_of(blocks: DataFrame, nfft: int) -> DataFrame:
    """Whole segments only. One that ends exactly where its run ends is not used.

    ``run_end`` is the sample after the last of a run.
    """
    return blocks.filter((F.col("n") == nfft) & (F.col("first_sample") + nfft < F.col("run_end")))


def noise_floor(segments: DataFrame, nfft: int = 4096, q: float = 0.1, block: float = 1.0, least: int = 8) -> DataFrame:
    """Per-bin low quantile of the power over segments, in dB; at least eight segments."""
    bins = segment_power(segments, nfft).select("stream_id", F.posexplode("power").alias("bin", "power"))
    low = quantile(bins, ["stream_id", "bin"], "power", q, block, "low")
    return low.filter(F.col("n_values") >= least).select(
        "stream_id", "bin", (F.log10(F.col("low") + TINY) * 10).alias("psd_db")
    )


def mean_psd(segments: DataFrame, nfft: int = 4096) -> DataFrame:
    bins = segment_power(segments, nfft).select("stream_id", F.posexplode("power").alias("bin", "power"))
    return bins.groupBy("stream_id", "bin").agg((F.log10(F.avg("power") + TINY) * 10).alias("psd_db"))


def find_carrier(psd: DataFrame, offset_hz: float, search_hz: float = 4e5) -> DataFrame:
    """Strongest bin near the offset on either side of zero, and its height over the median.

    ``psd`` has ``stream_id, hz, psd_db`` with ``hz`` counted from the centre; a
    group is one spectrum.
    """
    near = F.abs(F.abs(F.col("hz")) - abs(offset_hz)) < search_hz
    found = psd.groupBy("stream_id").agg(
        F.max_by("hz", F.when(near, F.struct("psd_db", (-F.col("hz")).alias("h")))).alias("carrier_hz"),
        F.max(F.when(near, F.col("psd_db"))).alias("level_db"),
        F.median("psd_db").alias("floor_db"),
    )
    return found.withColumn("snr_db", F.col("level_db") - F.col("floor_db"))


def smoothed(psd: DataFrame, keys, value: Column, width: int) -> DataFrame:
    """Moving average of ``width`` bins; bins past the ends count as zero."""
    half = width // 2
    around = Window.partitionBy(*keys).orderBy("bin").rowsBetween(-half, half)
    return psd.withColumn("smooth", F.sum(value).over(around) / width)


def _referenced(psd: DataFrame, keys, name: str, width: int) -> DataFrame:
    medians = psd.groupBy(*keys).agg(F.median("psd_db").alias("__m"))
    flat = psd.join(medians, list(keys))
    return smoothed(flat, keys, F.col("psd_db") - F.col("__m"), width).select(*keys, "bin", F.col("smooth").alias(name))


def compare_shapes(a: DataFrame, b: DataFrame, nbins: int, keys=("pair",), smooth: int = 65, tol_db: float = 3.0) -> DataFrame:
    """Worst and RMS difference of two smoothed spectra over their inner 90 per cent."""
    both = _referenced(a, keys, "a", smooth).join(_referenced(b, keys, "b", smooth), [*keys, "bin"])
    inner = both.filter((F.col("bin") >= int(nbins * 0.05)) & (F.col("bin") < int(nbins * 0.95)))
    d = F.abs(F.col("a") - F.col("b"))
    return inner.groupBy(*keys).agg(
        F.max(d).alias("worst_db"), F.sqrt(F.avg(d * d)).alias("rms_db")
    ).withColumn("agrees", F.col("worst_db") < tol_db)


def passband_check(psd: DataFrame, nbins: int, rate_hz: float, smooth: int = 33, edge_from: float = 0.47) -> DataFrame:
    """Flatness inside 0.4 of the rate and fall beyond ``edge_from``, on a smoothed spectrum."""
    hz = F.abs("hz")
    mids = psd.filter(hz < rate_hz / 8).groupBy("stream_id").agg(F.median("psd_db").alias("__m"))
    flat = smoothed(psd.join(mids, "stream_id"), ["stream_id"], F.col("psd_db") - F.col("__m"), smooth)
    kept = flat.filter((F.col("bin") >= smooth) & (F.col("bin") < nbins - smooth))
    inband, edge = hz < rate_hz * 0.4, hz > rate_hz * edge_from
    out = kept.groupBy("stream_id").agg(
        (F.max(F.when(inband, F.col("smooth"))) - F.min(F.when(inband, F.col("smooth")))).alias("ripple_db"),
        (F.median(F.when(edge, F.col("smooth"))) - F.median(F.when(inband, F.col("smooth")))).alias("edge_db"),
    )
    return out.withColumns({"flat": F.col("ripple_db") < 12.0, "rolls_off": F.col("edge_db") < -1.0})


def fm_discriminate(blocks: DataFrame, keys=("stream_id",), block=ARRAY_BLOCK) -> DataFrame:
    """Phase step from each sample to the next; the first of a run is set against zero."""
    last = {c: F.element_at(c, -1) for c in ("i", "q")}
    rows = ordered_scan(blocks, list(keys), "seq", {"__last": previous(last)}, block)
    zero = F.lit(0.0).cast("float")

    def shifted(c):
        head = F.coalesce(F.col(f"__last.{c}"), zero)
        return F.concat(F.array(head), F.slice(c, 1, F.size(c) - 1))

    rows = rows.withColumn(
        "__z", F.arrays_zip(F.col("i").alias("i"), F.col("q").alias("q"), shifted("i").alias("pi"), shifted("q").alias("pq"))
    )

    def step(z):
        i, q, pi, pq = (z[n].cast("double") for n in ("i", "q", "pi", "pq"))
        # Against zero, IEEE signs leave half a turn when both parts are negative.
        against_zero = (pi == 0) & (pq == 0) & (i < 0) & (q < 0)
        return F.when(against_zero, F.lit(np.pi)).otherwise(F.atan2(q * pi - i * pq, i * pi + q * pq))

    return rows.withColumn("phase", F.transform("__z", step)).drop("__z", "__last")


def low_pass(factor: int, taps: int = 31) -> list[float]:
    """A Hamming-windowed low-pass for decimation by ``factor``, gain one."""
    k = np.arange(taps) - (taps - 1) / 2
    h = np.sinc(k / factor) * np.hamming(taps)
    return (h / h.sum()).tolist()


def decimate(blocks: DataFrame, factor: int = 5, taps=None, keys=("stream_id",), block=ARRAY_BLOCK) -> DataFrame:
    """Filter a series of ``x`` arrays and keep every ``factor``-th value.

    Blocks hold ``first_sample`` and follow one another; each needs the tail of
    the one before, so re-block to at least the filter's length first.
    """
    h = np.array(taps if taps is not None else low_pass(factor))
    halo = len(h) - 1
    tail = F.slice("x", F.greatest(F.lit(1), F.size("x") - halo + 1), F.lit(max(halo, 1)))
    rows = ordered_scan(blocks, list(keys), "seq", {"__tail": previous(tail)}, block)

    def run(batches):
        for batch in batches:
            out, firsts = [], batch.column("first_sample").to_pylist()
            for x, before, first in zip(batch.column("x").to_pylist(), batch.column("__tail").to_pylist(), firsts):
                before = np.array(before or [], float)[-halo:] if halo else np.zeros(0)
                padded = np.concatenate([np.zeros(halo - before.size), before, np.array(x, float)])
                y = np.convolve(padded, h, mode="valid")
                out.append(y[(-first) % factor :: factor])
            kept = batch.drop_columns(["x", "__tail"])
            first_out = pa.array([-(-f // factor) for f in firsts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, first_out, pa.array(out, pa.list_(pa.float64()))],
                names=[*kept.schema.names, "first_out", "y"],
            )

    fields = [f for f in rows.schema if f.name not in ("x", "__tail")]
    extra = [T.StructField("first_out", T.LongType()), T.StructField("y", T.ArrayType(T.DoubleType()))]
    return rows.mapInArrow(run, T.StructType(fields + extra))


def cross_check(carriers: DataFrame, reference: str = "float32", max_hz: float = 2e3, max_db: float = 3.0) -> DataFrame:
    """Whether every format of a capture sees the carrier where the reference format does.

    ``carriers`` has one row per ``capture, format``: ``carrier_hz, level_db, zero_share``.
    """
    ref = carriers.filter(F.col("format") == reference).select(
        "capture", F.col("carrier_hz").alias("__hz"), F.col("level_db").alias("__db")
    )
    rest = carriers.filter(F.col("format") != reference).join(ref, "capture")
    agrees = (F.abs(F.col("carrier_hz") - F.col("__hz")) < max_hz) & (F.abs(F.col("level_db") - F.col("__db")) < max_db)
    return rest.withColumns({"agrees": agrees, "resolved": F.col("zero_share") < 0.05}).drop("__hz", "__db")
