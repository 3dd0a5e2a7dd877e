"""Where a stream's sample timeline breaks, and the runs between the breaks.

Input packets carry ``stream_id, connection_id, seq, payload, start_time,
end_time, samples, center_hz, rate_hz``. ``seq`` is the arrival order within a
stream; ``payload`` is ``iq``, another payload's name, or ``lost`` for a packet
that was framed but could not be decoded. Times are in any unit; ``ticks`` says
how many of them make a second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rfspark.operators import kernels
from rfspark.session import cut
from rfspark.operators.scan import (
    BLOCK,
    DEFAULT_BLOCK,
    block_start,
    latest,
    latest_before,
    ordered_scan,
    peak,
    previous,
    salted_join,
    total,
    total_before,
)

# Fixed values of the continuity rules.
CENTER_CHANGE_HZ = 1.0
RATE_CHANGE_BAND = 0.1
DEFAULT_CAP_S = 1e-3
PACKET_FRACTION = 0.5
PACKET_CEILING = 0.75
JITTER_MARGIN = 4.0
JITTER_DECAY = 0.999
RESOLUTION_FLOOR_S = 4e-6
STALL_S = 5.0
SETTLE_S = 0.075


def rate_moved(before: Column, now: Column) -> Column:
    return F.abs(now - before) / before > RATE_CHANGE_BAND


def center_moved(before: Column, now: Column) -> Column:
    return F.abs(before - now) > CENTER_CHANGE_HZ


def _duration(start: Column, end: Column) -> Column:
    d = end - start
    return F.when((d > 0) & (d < float("inf")), d)


def with_subconnection(packets: DataFrame, block=DEFAULT_BLOCK) -> DataFrame:
    """Number the stretches of a stream inside which packets can follow one another.

    A new connection and a lost packet each start a new stretch.
    """
    opened = cut(ordered_scan(packets, "stream_id", "seq", {"__conn": previous(F.col("connection_id"))}, block), "opened")
    starts = (F.col("payload") == "lost") | (F.col("__conn") != F.col("connection_id"))
    scans = {"subconnection": total(F.coalesce(starts, F.lit(False)).cast("long"))}
    return ordered_scan(opened, "stream_id", "seq", scans, block).drop("__conn")


def with_predecessor(packets: DataFrame, block=DEFAULT_BLOCK) -> DataFrame:
    """IQ packets with the gap to the packet before, null where none precedes.

    Other payloads never touch the timeline. A lost packet or a new connection
    forgets the previous end, and ``after_loss`` marks the packet that follows.
    """
    timeline = packets.filter(F.col("payload").isin("iq", "lost"))
    fields = {n: F.col(n) for n in ("connection_id", "start_time", "end_time")}
    before = {"lost": F.col("payload") == "lost", **fields}
    tuned = (F.col("payload") == "iq") & (F.col("rate_hz") > 0)
    geometry = {n: F.col(n) for n in ("center_hz", "rate_hz")}
    rows = ordered_scan(
        timeline,
        "stream_id",
        "seq",
        {"__prev": previous(before), "__geo": latest_before(geometry, tuned)},
        block,
    ).filter(F.col("payload") == "iq")
    prev = F.col("__prev")
    first = prev.isNull()
    reset = prev["lost"] | (prev["connection_id"] != F.col("connection_id"))
    linked = ~first & ~reset
    mine = _duration(F.col("start_time"), F.col("end_time"))
    theirs = F.when(linked, _duration(prev["start_time"], prev["end_time"]))
    return rows.withColumns(
        {
            "after_loss": F.coalesce(reset, F.lit(False)),
            "gap": F.when(linked, F.col("start_time") - prev["end_time"]),
            "shortest": F.least(mine, theirs),
            "prev_center_hz": F.col("__geo")["center_hz"],
            "prev_rate_hz": F.col("__geo")["rate_hz"],
        }
    ).drop("__prev", "__geo")


def _judge(gap: Column, tolerance: Column) -> Column:
    return (
        F.when(gap.isNull(), "first")
        .when(gap > tolerance, "drop")
        .when(-gap > tolerance, "backward")
        .otherwise("continuous")
    )


def classify_gaps(packets: DataFrame, tolerance=None, block=DEFAULT_BLOCK) -> DataFrame:
    """Class of every IQ packet against one tolerance.

    ``tolerance`` is a number in time units, or null for half of the shorter of
    the two packets.
    """
    rows = with_predecessor(packets, block)
    limit = F.lit(float(tolerance)) if tolerance is not None else F.col("shortest") * PACKET_FRACTION
    return rows.withColumn("gap_class", _judge(F.col("gap"), limit))


def classify_gaps_adaptive(
    packets: DataFrame, cap_s=DEFAULT_CAP_S, ticks: float = 1.0, block=DEFAULT_BLOCK
) -> DataFrame:
    """Class of every IQ packet against the tolerance its own stream has earned.

    The tolerance lies between a floor and a ceiling taken from packet length;
    how far up depends on the jitter seen so far. Rows outside the two bounds
    need no history. Streams with a row between the bounds are replayed: each
    block reports how it would change any incoming jitter, the reports are
    chained per stream, and the blocks are judged with the jitter that really
    came in.
    """
    cap = float("inf") if cap_s is None else cap_s * ticks
    floor = RESOLUTION_FLOOR_S * ticks
    s = F.col("shortest")
    low = F.coalesce(F.least(F.lit(cap), F.greatest(F.lit(floor), s * PACKET_FRACTION)), F.lit(cap))
    high = F.coalesce(F.least(F.lit(cap), F.greatest(F.lit(floor), s * PACKET_CEILING)), F.lit(cap))
    size = F.abs(F.col("gap"))
    rows = cut(with_predecessor(packets, block), "linked").withColumns(
        {
            "__low": low.cast("double"),
            "__high": high.cast("double"),
            "__open": F.coalesce((size > low) & (size <= high), F.lit(False)),
        }
    )
    open_streams = rows.groupBy("stream_id").agg(F.max("__open").alias("__any"))
    drop = ["__low", "__high", "__open"]
    if open_streams.filter("__any").isEmpty():
        return rows.withColumn("gap_class", _judge(F.col("gap"), F.col("__low"))).drop(*drop)
    flagged = salted_join(rows, open_streams, "stream_id")
    calm = flagged.filter(~F.col("__any")).withColumn("gap_class", _judge(F.col("gap"), F.col("__low")))
    step = block or DEFAULT_BLOCK
    uneasy = flagged.filter(F.col("__any")).withColumn(BLOCK, block_start(F.col("seq"), step))
    judged = kernels.judge_with_jitter(uneasy, JITTER_MARGIN, JITTER_DECAY)
    drop += ["__any", BLOCK]
    return calm.drop(*drop).unionByName(judged.drop(*drop))


def with_jitter(classified: DataFrame, block=DEFAULT_BLOCK) -> DataFrame:
    """Decayed peak of the residuals between packets judged continuous, after each row."""
    import math

    decay = math.log(JITTER_DECAY)
    judged = (F.col("gap_class") == "continuous") & F.col("gap").isNotNull()
    counted = ordered_scan(classified, "stream_id", "seq", {"__n": total(judged.cast("long"))}, block)
    size = F.abs(F.col("gap")).cast("double")
    level = F.when(judged & (size > 0), F.log(size) - F.col("__n") * F.lit(decay))
    scanned = ordered_scan(cut(counted, "counted"), "stream_id", "seq", {"__top": peak(level)}, block)
    jitter = F.coalesce(F.exp(F.col("__top") + F.col("__n") * F.lit(decay)), F.lit(0.0))
    return scanned.withColumn("jitter", jitter).drop("__n", "__top")


def gap_stats(classified: DataFrame) -> DataFrame:
    """Totals per stream. ``max_jitter`` is the largest accepted residual."""
    kind = F.col("gap_class")
    return classified.groupBy("stream_id").agg(
        F.count_if(kind == "drop").alias("drops"),
        F.count_if(kind == "backward").alias("backward_steps"),
        F.coalesce(F.sum(F.when(kind == "drop", F.col("gap"))), F.lit(0)).alias("gap_total"),
        F.coalesce(F.max(F.when(kind == "continuous", F.abs(F.col("gap")))), F.lit(0)).alias("max_jitter"),
    )


def neighbour_retunes(rows: DataFrame) -> DataFrame:
    """``geometry_change`` against the packet before: right where every change is a large one."""
    usable = F.col("rate_hz") > 0
    moved = center_moved(F.col("prev_center_hz"), F.col("center_hz")) | rate_moved(
        F.col("prev_rate_hz"), F.col("rate_hz")
    )
    change = F.when(usable & F.col("prev_rate_hz").isNull(), "initial").when(usable & moved, "retune")
    return rows.withColumn("geometry_change", change)


def detect_retunes(packets: DataFrame, block=DEFAULT_BLOCK) -> DataFrame:
    """Mark IQ packets whose geometry left the one last announced.

    The baseline moves only when a change is announced, so small steps add up.
    Where no step is small, comparing neighbours gives the same answer and stays
    in plain expressions; only streams with small steps are replayed by blocks.
    """
    return mark_retunes(cut(with_predecessor(packets, block), "linked"), block)


def mark_retunes(rows: DataFrame, block=DEFAULT_BLOCK) -> DataFrame:
    """The same for packets that carry their predecessor; read more than once."""
    near = neighbour_retunes(rows)
    differs = (F.col("prev_center_hz") != F.col("center_hz")) | (F.col("prev_rate_hz") != F.col("rate_hz"))
    small = F.coalesce(
        differs & (F.col("rate_hz") > 0) & F.col("geometry_change").isNull(), F.lit(False)
    )
    streams = near.withColumn("__small", small).groupBy("stream_id").agg(F.max("__small").alias("__creeps"))
    if streams.filter("__creeps").isEmpty():
        return near
    flagged = salted_join(near, streams, "stream_id")
    plain = flagged.filter(~F.col("__creeps")).drop("__creeps")
    step = block or DEFAULT_BLOCK
    creeping = (
        flagged.filter(F.col("__creeps"))
        .drop("__creeps", "geometry_change")
        .withColumn(BLOCK, block_start(F.col("seq"), step))
    )
    replayed = kernels.replay_geometry(creeping, CENTER_CHANGE_HZ, RATE_CHANGE_BAND)
    return plain.unionByName(replayed.drop(BLOCK))


def is_gap() -> Column:
    return F.col("gap_class").isin("drop", "backward") | F.col("after_loss")


def with_sample_index(rows: DataFrame, block=DEFAULT_BLOCK) -> DataFrame:
    """Absolute index of each IQ packet's first sample in its stream."""
    iq = rows.filter(F.col("payload") == "iq")
    return ordered_scan(iq, "stream_id", "seq", {"first_sample": total_before(F.col("samples"))}, block)


def break_log(indexed: DataFrame) -> DataFrame:
    """One row per break: at an index, at most a gap and then one geometry.

    ``indexed`` has ``gap_class, after_loss, geometry_change, first_sample``. Of
    several geometries at one index the last holds, and stays ``initial`` if one
    of them was. A gap before the very first sample says nothing and is left out.
    """
    change = F.col("geometry_change")
    marks = indexed.filter(is_gap() | change.isNotNull())
    at = marks.groupBy("stream_id", F.col("first_sample").alias("at_sample")).agg(
        F.bool_or(is_gap()).alias("gap"),
        F.bool_or(F.coalesce(change == "initial", F.lit(False))).alias("initial"),
        F.bool_or(change.isNotNull()).alias("moved"),
        F.max_by("center_hz", F.when(change.isNotNull(), F.col("seq"))).alias("center_hz"),
        F.max_by("rate_hz", F.when(change.isNotNull(), F.col("seq"))).alias("rate_hz"),
    )
    nothing = F.struct(
        F.lit(None).cast("double").alias("center_hz"), F.lit(None).cast("double").alias("rate_hz")
    )
    geometry = F.struct(
        F.col("center_hz").cast("double").alias("center_hz"),
        F.col("rate_hz").cast("double").alias("rate_hz"),
    )
    entries = F.array_compact(
        F.array(
            F.when(
                F.col("gap") & (F.col("at_sample") > 0),
                F.struct(F.lit(0).alias("place"), F.lit("gap").alias("kind"), nothing.alias("g")),
            ),
            F.when(
                F.col("moved"),
                F.struct(
                    F.lit(1).alias("place"),
                    F.when(F.col("initial"), "initial").otherwise("retune").alias("kind"),
                    geometry.alias("g"),
                ),
            ),
        )
    )
    return at.select("stream_id", "at_sample", F.explode(entries).alias("e")).select(
        "stream_id", "at_sample", "e.place", "e.kind", "e.g.center_hz", "e.g.rate_hz"
    )


def with_epochs(rows: DataFrame, block=DEFAULT_BLOCK) -> DataFrame:
    """Number the contiguous runs; a packet opens a run if any break sits before it.

    Index and run number come from one scan.
    """
    iq = rows.filter(F.col("payload") == "iq")
    opens = is_gap() | F.col("geometry_change").isNotNull()
    return ordered_scan(
        iq,
        "stream_id",
        "seq",
        {
            "first_sample": total_before(F.col("samples")),
            "epoch_id": total(F.coalesce(opens, F.lit(False)).cast("long")),
        },
        block,
    )


def epochs(numbered: DataFrame) -> DataFrame:
    """One row per contiguous run of a stream."""
    kind, change = F.col("gap_class"), F.col("geometry_change")
    # What opened a run as bits: numbers keep the aggregate a hash aggregate.
    bits = {"drop": kind == "drop", "backward": kind == "backward", "reset": F.col("after_loss")}
    bits |= {"initial": change == "initial", "retune": change == "retune"}
    mask = sum((F.when(F.coalesce(b, F.lit(False)), 1 << k).otherwise(0) for k, b in enumerate(bits.values())), F.lit(0))
    lost = F.when(kind == "drop", F.col("gap")).otherwise(F.lit(0))
    runs = numbered.groupBy("stream_id", "epoch_id").agg(
        F.min("first_sample").alias("first_sample"),
        F.sum("samples").alias("n_samples"),
        F.count("*").alias("n_packets"),
        F.min("start_time").alias("t_start"),
        F.max("end_time").alias("t_end"),
        F.min_by("center_hz", "seq").alias("center_hz"),
        F.min_by("rate_hz", "seq").alias("rate_hz"),
        F.min_by(lost, F.col("seq")).alias("lost_before"),
        F.min_by(mask, F.col("seq")).alias("__mask"),
    )
    return runs.select(
        "stream_id",
        "epoch_id",
        "first_sample",
        "n_samples",
        "n_packets",
        "t_start",
        "t_end",
        "center_hz",
        "rate_hz",
        "lost_before",
        F.concat_ws(
            "+", *[F.when(F.col("__mask").bitwiseAND(1 << k) != 0, n) for k, n in enumerate(bits)]
        ).alias("opened_by"),
    )


def continuity(packets: DataFrame, tolerance=None, block=DEFAULT_BLOCK) -> DataFrame:
    """The whole spine: gaps, resets, retunes, sample index and run numbers."""
    classified = cut(classify_gaps(packets, tolerance, block), "classified")
    return with_epochs(mark_retunes(classified, block), block)


def flag_loss(sdk_packets: DataFrame) -> DataFrame:
    """Loss that the device itself flags on its packets.

    ``drop_event`` and ``overrun`` follow the warning bits; a packet whose
    layout cannot be read is both.
    """
    # Fixed flag bits.
    WARN_OVERFLOW = 0x100
    WARN_DROPPED = 0x200
    TIME_DISCONTINUITY = 0x10000
    flags = F.col("flags")
    bad = (F.col("num") > 0) & ~F.col("valid_layout")
    dropped = flags.bitwiseAND(WARN_DROPPED | TIME_DISCONTINUITY) != 0
    over = flags.bitwiseAND(WARN_OVERFLOW | WARN_DROPPED | TIME_DISCONTINUITY) != 0
    return sdk_packets.withColumns(
        {
            "drop_events": bad.cast("long") + dropped.cast("long"),
            "overrun": bad | over,
        }
    )


def with_overrun(blocks: DataFrame, breaks: DataFrame, block=1 << 34) -> DataFrame:
    """Flag each read block that has a break since the block before it.

    ``block`` counts samples here.

    ``blocks`` have ``stream_id, first_sample, n``. Each break belongs to the
    block holding its sample, found by putting both on one axis.
    """
    on_axis = blocks.select("stream_id", F.col("first_sample").alias("at"), "n", F.lit(0).alias("rank"))
    marks = breaks.select(
        "stream_id", F.col("at_sample").alias("at"), F.lit(None).cast("bigint").alias("n"), F.lit(1).alias("rank")
    )
    merged = ordered_scan(
        on_axis.unionByName(marks),
        "stream_id",
        ["at", "rank"],
        {"block_first": latest_before(F.when(F.col("rank") == 0, F.col("at")))},
        block,
    )
    own = F.when(F.col("rank") == 0, F.col("at")).otherwise(F.col("block_first"))
    return (
        merged.withColumn("first_sample", own)
        .filter(F.col("first_sample").isNotNull())
        .groupBy("stream_id", "first_sample")
        .agg(F.max("n").alias("n"), F.bool_or(F.col("rank") == 1).alias("overrun"))
    )


def report_schedule(classified: DataFrame, block=DEFAULT_BLOCK) -> DataFrame:
    """The drops and backward steps that are worth a report.

    Drops 1, 4, 16, … and backward steps 1, 2, 4, … of each stream.
    """
    kind = F.col("gap_class")
    counted = ordered_scan(
        classified.filter(kind.isin("drop", "backward")),
        "stream_id",
        "seq",
        {
            "drops": total((kind == "drop").cast("long")),
            "backward_steps": total((kind == "backward").cast("long")),
        },
        block,
    )

    def power_of_two(n):
        return (n > 0) & (n.bitwiseAND(n - 1) == 0)

    # A power of four is a power of two with its bit in an even place.
    even = F.lit(0x5555555555555555).cast("long")
    drops, steps = F.col("drops"), F.col("backward_steps")
    return counted.filter(
        ((kind == "drop") & power_of_two(drops) & (drops.bitwiseAND(even) != 0))
        | ((kind == "backward") & power_of_two(steps))
    ).withColumn("nth", F.when(kind == "drop", F.col("drops")).otherwise(F.col("backward_steps")))


def stream_accounting(packets: DataFrame, ticks: float = 1e6) -> DataFrame:
    """What each stream delivered, by payload, with rates over its own span.

    ``ticks``: units of time in a second. A stream without a span has no rates.
    """
    payload = F.col("payload")
    sums = packets.groupBy("stream_id").agg(
        F.count_if(payload == "iq").alias("iq_packets"),
        F.count_if(~payload.isin("iq", "lost")).alias("non_iq_skipped"),
        F.count_if(payload == "lost").alias("lost_to_parse_errors"),
        F.coalesce(F.sum(F.when(payload == "iq", F.col("samples"))), F.lit(0)).alias("iq_samples"),
        (F.max("end_time") - F.min("start_time")).cast("double").alias("span"),
    )
    seconds = F.when(F.col("span") > 0, F.col("span") / F.lit(float(ticks)))
    return sums.withColumns(
        {"packets_per_second": F.col("iq_packets") / seconds, "samples_per_second": F.col("iq_samples") / seconds}
    )


def accounting_rollup(packets: DataFrame) -> DataFrame:
    """The same counts by stream and payload, with subtotals."""
    return packets.rollup("stream_id", "payload").agg(
        F.count("*").alias("packets"), F.sum("samples").alias("samples")
    )


def attribute_gaps(gaps: DataFrame, health: DataFrame, block) -> DataFrame:
    """Give each gap the loss verdict its device held at that time.

    ``block`` is a stretch of time, in units of ``at``, with a fair number of gaps.

    ``gaps`` have ``device_id, at, seq``; ``health`` has ``device_id, at`` and
    ``losing_nothing`` (null where the device reports no counters). The last
    verdict at or before the gap decides.
    """
    state = F.struct(F.col("losing_nothing").alias("v"), F.col("at").alias("health_at"))
    left = health.select(
        "device_id", "at", F.lit(0).alias("rank"), F.lit(None).cast("bigint").alias("seq"), state.alias("state")
    )
    right = gaps.select("device_id", "at", F.lit(1).alias("rank"), "seq", F.lit(None).cast("struct<v:boolean,health_at:bigint>").alias("state"))
    merged = ordered_scan(
        left.unionByName(right), "device_id", ["at", "rank", "seq"], {"known": latest_before(F.col("state"))}, block
    )
    verdict = F.col("known.v")
    return merged.filter(F.col("rank") == 1).select(
        "device_id",
        "at",
        "seq",
        F.col("known.health_at").alias("health_at"),
        F.when(verdict.isNull(), "unknown").when(verdict, "downstream").otherwise("device").alias("blame"),
    )


def stalls(packets: DataFrame, seconds: float = STALL_S, ticks: float = 1.0, block=DEFAULT_BLOCK) -> DataFrame:
    """Silences of at least ``seconds`` between two arrivals of a connection."""
    rows = ordered_scan(
        packets,
        "stream_id",
        "seq",
        {"__prev": previous({n: F.col(n) for n in ("connection_id", "start_time")})},
        block,
    )
    silent = F.col("start_time") - F.col("__prev.start_time")
    same = F.col("__prev.connection_id") == F.col("connection_id")
    return rows.filter(same & (silent >= seconds * ticks)).select(
        "stream_id", "connection_id", "seq", silent.alias("silence")
    )


def trim_settle(blocks: DataFrame, seconds: float = SETTLE_S) -> DataFrame:
    """Drop the samples a receiver delivers while it settles after a retune.

    ``blocks`` are numbered IQ packets with ``epoch_first`` (the run's first
    sample), ``first_sample``, ``n`` and ``rate_hz``. Returns what is left of
    each block as ``skip`` leading samples to drop and ``kept`` samples.
    """
    settle = F.ceil(F.lit(seconds) * F.col("rate_hz")).cast("long")
    skip = F.greatest(F.lit(0), F.least(F.col("n"), settle - (F.col("first_sample") - F.col("epoch_first"))))
    return (
        blocks.withColumn("skip", F.when(F.col("after_retune"), skip).otherwise(F.lit(0)))
        .withColumn("kept", F.col("n") - F.col("skip"))
        .filter(F.col("kept") > 0)
    )


def with_epoch_first(numbered: DataFrame, block=DEFAULT_BLOCK) -> DataFrame:
    """Carry each run's first sample, and whether a retune opened it, to its packets."""
    opens = is_gap() | F.col("geometry_change").isNotNull()
    retune = F.coalesce(F.col("geometry_change") == "retune", F.lit(False))
    start = latest({"first_sample": F.col("first_sample"), "retune": retune}, F.coalesce(opens, F.lit(False)))
    rows = ordered_scan(cut(numbered, "numbered"), "stream_id", "seq", {"__open": start}, block)
    return rows.withColumns(
        {"epoch_first": F.col("__open.first_sample"), "after_retune": F.col("__open.retune")}
    ).drop("__open")
