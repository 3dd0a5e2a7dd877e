"""Byte rates that links deliver against those that streams need.

Arrivals carry ``connection_id, seq, opened, at, bytes, channel_full``; ``ticks``
is the number of time units in a second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rfspark.functions import tables as t
from rfspark.functions.scalar import iq_bytes_per_sample, positive, usable_bandwidth_hz
from rfspark.operators.geometry import ladder
from rfspark.operators.scan import DEFAULT_BLOCK, ordered_scan, salted_join, total_before

VERDICT_TOLERANCE = 0.98
SNIFF_BYTES = 1 << 20


def required_rate(rate: Column, fmt: Column) -> Column:
    """Bytes a second that a sample rate needs; null for a bad rate or a format without fixed width."""
    return F.when(positive(rate), rate * iq_bytes_per_sample(fmt))


def with_required_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("required_byte_rate", required_rate(F.col("rate_hz"), F.col("format")))


def sustainable_rate(measured: Column, fmt: Column, top: Column | None = None) -> Column:
    """Fastest rung of the ladder below ``top`` that the measured byte rate carries."""
    rates = ladder(top if top is not None else F.lit(t.IQ_CLOCK_HZ))
    width = iq_bytes_per_sample(fmt)
    fits = F.filter(rates, lambda r: r * width <= measured)
    return F.when(positive(measured) & width.isNotNull(), F.array_max(fits))


def with_sustainable(df: DataFrame, top: Column | None = None) -> DataFrame:
    rate = sustainable_rate(F.col("byte_rate"), F.col("format"), top)
    return df.withColumn("fit_rate_hz", rate).withColumn("fit_bandwidth_hz", usable_bandwidth_hz(F.col("fit_rate_hz")))


def throughput(arrivals: DataFrame, settle_s: float, window_s: float, ticks: float = 1.0) -> DataFrame:
    """Delivered byte rate of every connection over its measuring window.

    What arrives before the settle time is discarded, and so is the first
    arrival after it, which starts the window. The arrival that crosses the end
    closes the window and is not counted. A window that never closed, counted
    nothing, or spans less than half its length gives null. ``seq`` is the order
    of arrival, along which ``at`` never falls. ``consumer_limited``
    says that the reader itself was full inside the window.
    """
    settle, window = settle_s * ticks, window_s * ticks
    settled = F.col("at") - F.col("opened") >= settle
    first = F.when(settled, F.col("seq"))
    marks = arrivals.groupBy("connection_id").agg(
        F.min(first).alias("mark_seq"), F.min_by("at", first).alias("mark_at")
    )
    rows = salted_join(arrivals, marks, "connection_id")
    after = F.coalesce(F.col("seq") > F.col("mark_seq"), F.lit(False))
    inside = after & (F.col("at") - F.col("mark_at") < window)
    early = ~after
    sums = rows.groupBy("connection_id").agg(
        F.max("mark_at").alias("mark_at"),
        F.min("opened").alias("opened"),
        F.coalesce(F.bool_or(after & ~inside), F.lit(False)).alias("closed"),
        F.coalesce(F.sum(F.when(inside, F.col("bytes"))), F.lit(0)).alias("bytes"),
        F.max(F.when(inside, F.col("at"))).alias("last"),
        F.coalesce(F.sum(F.when(early, F.col("bytes"))), F.lit(0)).alias("settle_bytes"),
        F.coalesce(F.bool_or(inside & F.col("channel_full")), F.lit(False)).alias("consumer_limited"),
    )
    span = F.col("last") - F.col("mark_at")
    good = F.col("closed") & (F.col("bytes") > 0) & (span > 0) & (span * 2 >= window)
    return sums.withColumns(
        {
            "span": F.when(good, span),
            "settle": F.col("mark_at") - F.col("opened"),
            "byte_rate": F.when(good, F.col("bytes") / (span / ticks)),
        }
    ).drop("mark_at", "last")


def drop_consumer_limited(measured: DataFrame) -> DataFrame:
    """A window in which the reader was full says nothing about the link."""
    return measured.filter(~F.col("consumer_limited"))


def with_verdict(df: DataFrame, tolerance: float = VERDICT_TOLERANCE) -> DataFrame:
    """Whether ``byte_rate`` falls short of what ``rate_hz`` and ``format`` need.

    Only a short link gets a rate that would fit, from the device's own ladder.
    """
    need = required_rate(F.col("rate_hz"), F.col("format"))
    judged = df.withColumn("required_byte_rate", need).withColumn(
        "short", F.col("byte_rate") < F.col("required_byte_rate") * tolerance
    )
    fit = sustainable_rate(F.col("byte_rate"), F.col("format"), F.col("rate_hz"))
    return judged.withColumn("fit_rate_hz", F.when(F.col("short"), fit)).withColumn(
        "fit_bandwidth_hz", usable_bandwidth_hz(F.col("fit_rate_hz"))
    )


def link_verdict(measured: DataFrame, epochs: DataFrame, tolerance: float = VERDICT_TOLERANCE) -> DataFrame:
    """A verdict per connection and geometry: a retune puts the same link to a new test.

    ``epochs`` have ``connection_id, epoch_id, rate_hz, format``. Both sides hold
    one row per connection or run, never raw arrivals.
    """
    usable = drop_consumer_limited(measured).filter(F.col("byte_rate").isNotNull())
    joined = epochs.join(usable.select("connection_id", "byte_rate"), "connection_id")
    return with_verdict(joined, tolerance).filter(F.col("required_byte_rate").isNotNull())


def measurable(streams: DataFrame) -> DataFrame:
    """Streams whose byte rate says something: fixed-width format, nothing thinned in time."""
    thinned = F.coalesce(F.col("rate_reduction"), F.lit(1)) > 1
    return streams.filter(iq_bytes_per_sample(F.col("format")).isNotNull() & ~thinned)


def server_egress(arrivals: DataFrame, interval, ceiling: float) -> DataFrame:
    """Clients and bytes of each server per interval, against what its link carries.

    Connections are summed first, so counting them needs no second shuffle of
    arrivals. ``ceiling`` is in bytes per interval.
    """
    slot = (F.col("at") - F.pmod(F.col("at"), F.lit(interval))).alias("slot")
    each = arrivals.groupBy("server_id", slot, "connection_id").agg(F.sum("bytes").alias("bytes"))
    return each.groupBy("server_id", "slot").agg(
        F.count("*").alias("clients"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest")
    ).withColumn("saturated", F.col("bytes") >= ceiling)


def stream_rates(packets: DataFrame, window: str, slide: str | None = None) -> DataFrame:
    """Packets, samples and bytes a second per stream over tumbling or sliding windows of ``ts``."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    out = packets.groupBy("stream_id", w.alias("w")).agg(
        F.count("*").alias("packets"), F.sum("samples").alias("samples"), F.sum("bytes").alias("bytes")
    )
    seconds = (F.unix_micros("w.end") - F.unix_micros("w.start")) / 1e6
    return out.select(
        "stream_id",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "packets",
        "samples",
        "bytes",
        (F.col("packets") / seconds).alias("packets_per_s"),
        (F.col("samples") / seconds).alias("samples_per_s"),
        (F.col("bytes") / seconds).alias("bytes_per_s"),
    )


def device_rate(packets: DataFrame, budget: int = SNIFF_BYTES, block=DEFAULT_BLOCK) -> DataFrame:
    """Rate of the first usable IQ header among the first bytes of a connection, or null."""
    early = ordered_scan(packets, "connection_id", "seq", {"__read": total_before(F.col("bytes"))}, block)
    usable = (F.col("__read") <= budget) & (F.col("payload") == "iq") & (F.col("rate_hz") > 0)
    return early.groupBy("connection_id").agg(
        F.min_by("rate_hz", F.when(usable, F.col("seq"))).alias("device_rate_hz")
    )
