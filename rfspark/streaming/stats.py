"""Windowed counters, sessions and enrichment of live streams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rfspark.operators.decode import decode_iq
from rfspark.operators.geometry import bucket_of
from rfspark.operators.linkbudget import stream_rates
from rfspark.operators.scan import block_start, ordered_scan, previous


def live_stats(packets: DataFrame, watermark: str, window: str, slide: str | None = None) -> DataFrame:
    """Packets, samples and bytes per stream over event-time windows."""
    return stream_rates(packets.withWatermark("ts", watermark), window, slide)


def connection_sessions(packets: DataFrame, watermark: str, gap: str = "5 seconds") -> DataFrame:
    """Connections of a stream as sessions that a silence of ``gap`` ends."""
    session = F.session_window("ts", gap).alias("s")
    out = packets.withWatermark("ts", watermark).groupBy("stream_id", session).agg(
        F.count("*").alias("packets"), F.sum("samples").alias("samples")
    )
    return out.select("stream_id", F.col("s.start").alias("opened"), F.col("s.end").alias("closed"), "packets", "samples")


def closed_stats(packets: DataFrame, watermark: str, window: str, slide: str | None = None) -> DataFrame:
    """``live_stats`` of feeds that end: a stream's open windows come out with its ``closed`` marker.

    The watermark is one for all streams, so it can't tell that one of them has
    ended; here each stream keeps its open windows itself. A window comes out
    when the watermark passes it, or when the stream's marker arrives. What a
    stream sends after its marker is a new feed with windows of its own.
    """
    size, step = _micros(packets, window), _micros(packets, slide or window)
    out = _keyed(packets, watermark, OpenWindows(size, step), "stream_id bigint, opened bigint, packets bigint, samples bigint, bytes bigint")
    seconds = size / 1e6
    return out.select(
        "stream_id",
        F.timestamp_micros("opened").alias("window_start"),
        F.timestamp_micros(F.col("opened") + size).alias("window_end"),
        "packets",
        "samples",
        "bytes",
        (F.col("packets") / seconds).alias("packets_per_s"),
        (F.col("samples") / seconds).alias("samples_per_s"),
        (F.col("bytes") / seconds).alias("bytes_per_s"),
    )


def closed_sessions(packets: DataFrame, watermark: str, gap: str = "5 seconds") -> DataFrame:
    """``connection_sessions`` of feeds that end: the session still open comes out with its stream's ``closed`` marker.

    A silence of exactly ``gap`` ends a session, which the built-in session window lets go on.
    """
    processor = OpenSessions(_micros(packets, gap))
    out = _keyed(packets, watermark, processor, "stream_id bigint, opened bigint, closed bigint, packets bigint, samples bigint")
    return out.select(
        "stream_id",
        F.timestamp_micros("opened").alias("opened"),
        F.timestamp_micros("closed").alias("closed"),
        "packets",
        "samples",
    )


def _micros(df: DataFrame, interval: str) -> int:
    """An interval in microseconds."""
    return df.sparkSession.sql(f"SELECT unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {interval})").first()[0]


def _keyed(packets: DataFrame, watermark: str, processor: StatefulProcessor, schema: str) -> DataFrame:
    names = [c for c in ("samples", "bytes") if c in packets.columns]
    lean = packets.withWatermark("ts", watermark).select("stream_id", "ts", "payload", F.unix_micros("ts").alias("us"), *names)
    return lean.groupBy("stream_id").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode="EventTime"
    )


def wake(handle: StatefulProcessorHandle, times, watermark: int) -> None:
    """Keep a timer at the earliest of some times; all that is due then is done in one go.

    A timer that the watermark has reached is still listed while it is handled.
    """
    first = min((-(-us // 1000) for us in times), default=None)
    if first is not None and first < min((t for t in handle.listTimers() if t > watermark), default=first + 1):
        handle.registerTimer(first)


class Open(StatefulProcessor):
    """Spans of one stream that packets can still enter: by start, their end and sums.

    Chunks of a micro-batch are summed up one by one; the state holds open spans only.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getMapState("spans", "opened bigint", "closed bigint, packets bigint, samples bigint, bytes bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        spans = {k[0]: tuple(v) for k, v in self.spans.iterator()}
        held, ended = dict(spans), False
        for chunk in rows:
            marker = chunk["payload"] == "closed"
            ended |= bool(marker.any())
            chunk = chunk[~marker]
            if len(chunk):
                us = chunk["us"].to_numpy()
                sums = [chunk[c].fillna(0).to_numpy() if c in chunk else np.zeros(len(us), np.int64) for c in ("samples", "bytes")]
                self.enter(spans, us, sums)
        if ended:
            self.spans.clear()
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            yield self.frame(key[0], spans)
            return
        for start in held.keys() - spans.keys():
            self.spans.removeKey((start,))
        for start, values in spans.items():
            if held.get(start) != values:
                self.spans.updateValue((start,), values)
        wake(self.handle, (v[0] for v in spans.values()), timerValues.getCurrentWatermarkInMs())
        yield self.frame(key[0], {})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The watermark has passed the end of a span (or what it was before it grew)."""
        until = timerValues.getCurrentWatermarkInMs() * 1000
        spans = {k[0]: tuple(v) for k, v in self.spans.iterator()}
        past = {start: values for start, values in spans.items() if values[0] <= until}
        for start in past:
            self.spans.removeKey((start,))
        wake(self.handle, (v[0] for v in spans.values() if v[0] > until), until // 1000)
        yield self.frame(key[0], past)

    def frame(self, stream, spans) -> pd.DataFrame:
        rows = [(stream, start, *self.shown(values)) for start, values in sorted(spans.items())]
        return pd.DataFrame(rows, columns=["stream_id", "opened", *self.columns]).astype("int64")

    def close(self) -> None:
        pass


class OpenWindows(Open):
    columns = ["packets", "samples", "bytes"]

    def __init__(self, size: int, step: int):
        self.size, self.step = size, step

    def enter(self, spans, us, sums):
        first = us - us % self.step
        for k in range(-(-self.size // self.step)):
            start = first - k * self.step
            inside = start + self.size > us
            keys, at = np.unique(start[inside], return_inverse=True)
            counts = [np.bincount(at), *(np.bincount(at, weights=s[inside]).astype(np.int64) for s in sums)]
            for start, *more in zip(keys.tolist(), *(c.tolist() for c in counts)):
                old = spans.get(start, (start + self.size, 0, 0, 0))
                spans[start] = (old[0], *(a + b for a, b in zip(old[1:], more)))

    def shown(self, values):
        return values[1:]


class OpenSessions(Open):
    columns = ["closed", "packets", "samples"]

    def __init__(self, gap: int):
        self.gap = gap

    def enter(self, spans, us, sums):
        order = np.argsort(us, kind="stable")
        us = us[order]
        first = np.flatnonzero(np.append(True, np.diff(us) >= self.gap))
        last = np.append(first[1:], len(us)) - 1
        sums = [np.add.reduceat(s[order], first).astype(np.int64).tolist() for s in sums]
        new = zip(us[first].tolist(), (us[last] + self.gap).tolist(), (last - first + 1).tolist(), *sums)
        # Spans that overlap are one; those of the state are few.
        merged = []
        for start, end, *values in sorted([*new, *((s, *v) for s, v in spans.items())]):
            if merged and start < merged[-1][1]:
                merged[-1] = [merged[-1][0], max(end, merged[-1][1]), *(a + b for a, b in zip(merged[-1][2:], values))]
            else:
                merged.append([start, end, *values])
        spans.clear()
        spans.update({m[0]: tuple(m[1:]) for m in merged})

    def shown(self, values):
        return values[:3]


def health_intervals(health: DataFrame, max_age: int, bucket: int, block: int) -> DataFrame:
    """Each health reading with the stretch of time it speaks for, listed by bucket.

    It holds until the next reading of its device, and for ``max_age`` at most.
    """
    back = health.withColumn("__back", -F.col("at"))
    ended = ordered_scan(back, "device_id", ["__back", "seq"], {"__next": previous(F.col("at"))}, block)
    until = F.least(F.coalesce("__next", F.col("at") + max_age), F.col("at") + max_age)
    span = ended.select("device_id", F.col("at").alias("health_at"), until.alias("until"), "losing_nothing").filter(
        F.col("until") > F.col("health_at")
    )
    first, last = block_start(F.col("health_at"), bucket), block_start(F.col("until") - 1, bucket)
    return span.withColumn("bucket", F.explode(F.sequence(first, last, F.lit(bucket).cast("long"))))


def enrich_stream(breaks: DataFrame, intervals: DataFrame, bucket: int) -> DataFrame:
    """Attach to each live break the verdict its device held, from ``health_intervals``.

    ``breaks`` have ``device_id, at``. A stream-static join on device and time
    bucket; at most one interval holds any moment.
    """
    keyed = breaks.withColumn("bucket", block_start(F.col("at"), bucket)).alias("b")
    i = intervals.alias("i")
    on = (
        (F.col("b.device_id") == F.col("i.device_id"))
        & (F.col("b.bucket") == F.col("i.bucket"))
        & (F.col("b.at") >= F.col("i.health_at"))
        & (F.col("b.at") < F.col("i.until"))
    )
    verdict = F.col("i.losing_nothing")
    blame = F.when(verdict.isNull(), "unknown").when(verdict, "downstream").otherwise("device")
    return keyed.join(i, on, "left").select("b.*", blame.alias("blame")).drop("bucket")


def decode_stream(packets: DataFrame, scale: float | None = None) -> DataFrame:
    """Decode as packets arrive: the batch decoder holds no state."""
    return decode_iq(packets, scale)


AS_OF = "device_id bigint, us bigint, seq bigint, health_us bigint, losing_nothing boolean, carried string"


# A device's time is dealt to so many states, as one would hold all its waiting breaks at once.
SLOTS = 64


class AsOf(StatefulProcessor):
    """Breaks of one device and slot of time against the last health reading at or before each of them.

    A break waits until the watermark has passed it, as a reading may still come,
    or until both feeds of the device have ended. Of the readings only those can
    still be asked for that lie after the watermark, and the last before it.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.readings = handle.getListState("readings", "us bigint, seq bigint, ok boolean")
        self.waiting = handle.getListState("waiting", "us bigint, seq bigint, carried string")
        self.ended = handle.getValueState("ended", "breaks boolean, health boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ended = list(self.ended.get()) if self.ended.exists() else [False, False]
        times, new = [], False
        for chunk in rows:
            for k, feed in enumerate(("break", "health")):
                own = chunk[chunk["feed"] == feed]
                marker = own["closed"].astype(bool)
                if marker.any():
                    ended[k], new = True, True
                # A marker has no time, which makes the column one of floats.
                own = own[~marker].astype({"us": "int64", "seq": "int64"})
                if not len(own):
                    continue
                if feed == "break":
                    self.waiting.appendList(list(zip(own["us"].tolist(), own["seq"].tolist(), own["carried"].tolist())))
                    times.append(int(own["us"].min()))
                else:
                    ok = [None if pd.isna(x) else bool(x) for x in own["ok"]]
                    self.readings.appendList(list(zip(own["us"].tolist(), own["seq"].tolist(), ok)))
        wake(self.handle, times, timerValues.getCurrentWatermarkInMs())
        if new:
            self.ended.update(tuple(ended))
        yield self.answer(key[0], None) if all(ended) else self.frame(key[0], [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self.answer(key[0], timerValues.getCurrentWatermarkInMs() * 1000)

    def answer(self, device, until: int | None) -> pd.DataFrame:
        """Breaks up to a time (all for None) with their readings; both leave the state."""
        waiting = [tuple(w) for w in self.waiting.get()] if self.waiting.exists() else []
        due = sorted(w for w in waiting if until is None or w[0] <= until)
        if not due:
            if until is not None:
                wake(self.handle, (w[0] for w in waiting), until // 1000)
            return self.frame(device, [])
        # Of readings at one moment the first to arrive speaks, so it is sorted last.
        readings = sorted((tuple(r) for r in self.readings.get()), key=lambda r: (r[0], -r[1])) if self.readings.exists() else []
        at = np.searchsorted([r[0] for r in readings], [w[0] for w in due], side="right") - 1
        out = []
        for (us, seq, carried), k in zip(due, at.tolist()):
            us_of, _, ok = readings[k] if k >= 0 else (None, None, None)
            out.append((us, seq, us_of, ok, carried))
        rest = [w for w in waiting if until is not None and w[0] > until]
        self.keep(self.waiting, rest)
        if until is not None:
            wake(self.handle, (w[0] for w in rest), until // 1000)
        if until is not None:
            # The next break is later than any answered: older readings than the last of them are done with.
            self.keep(self.readings, readings[max(int(at[-1]), 0) :])
        return self.frame(device, out)

    def keep(self, state, rows):
        if rows:
            state.put(rows)
        else:
            state.clear()

    def frame(self, device, out) -> pd.DataFrame:
        names = [c.split()[0] for c in AS_OF.split(", ")]
        df = pd.DataFrame([(device, *row) for row in out], columns=names)
        types = {"device_id": "int64", "us": "int64", "seq": "int64", "health_us": "Int64", "losing_nothing": "boolean", "carried": "object"}
        return df.astype(types)

    def close(self) -> None:
        pass


def with_health(breaks: DataFrame, health: DataFrame, watermark: str, max_age: int) -> DataFrame:
    """Each live break with the verdict its device's live health gave at the time: ``blame``.

    Two streams with ``device_id, seq, ts, closed``, the second with
    ``losing_nothing``; ``closed`` rows end a feed. A verdict older than
    ``max_age`` microseconds says nothing. Every break comes out once.

    Time is cut into stretches of ``max_age``, dealt to ``SLOTS`` states a device. A reading goes to
    its own stretch and the next, as far as it speaks; an older one that a
    break meets there says nothing, as would the ones between them. Markers go to all.
    """
    stretch = F.floor(F.unix_micros("ts") / max_age)
    slot = lambda k: F.pmod(k, F.lit(SLOTS)).cast("int")
    everywhere = F.sequence(F.lit(0), F.lit(SLOTS - 1))
    own = F.when(F.col("closed"), everywhere).otherwise(F.array(slot(stretch)))
    spoken = F.when(F.col("closed"), everywhere).otherwise(F.array(slot(stretch), slot(stretch + 1)))
    carried = [F.col(c) for c in breaks.columns if c not in ("ts", "closed")]
    shape = F.struct(*carried)
    shared = ["device_id", "seq", "ts", F.unix_micros("ts").alias("us"), "closed"]
    left = breaks.withWatermark("ts", watermark).select(
        *shared, F.explode(own).alias("slot"), F.lit("break").alias("feed"), F.lit(None).cast("boolean").alias("ok"), F.to_json(shape).alias("carried")
    )
    right = health.withWatermark("ts", watermark).select(
        *shared, F.explode(spoken).alias("slot"), F.lit("health").alias("feed"), F.col("losing_nothing").alias("ok"), F.lit(None).cast("string").alias("carried")
    )
    found = left.unionByName(right).groupBy("device_id", "slot").transformWithStateInPandas(
        statefulProcessor=AsOf(), outputStructType=AS_OF, outputMode="append", timeMode="EventTime"
    )
    row = F.from_json("carried", breaks.select(*carried).schema)
    fresh = (F.col("us") < F.col("health_us") + max_age) & F.col("losing_nothing").isNotNull()
    blame = F.when(~F.coalesce(fresh, F.lit(False)), "unknown").when(F.col("losing_nothing"), "downstream").otherwise("device")
    return found.select(row.alias("r"), blame.alias("blame")).select("r.*", "blame")


def with_bands(breaks: DataFrame, bands: DataFrame, bucket_hz: float) -> DataFrame:
    """Each live break with the bands its centre ``center_hz`` lies in, a row each; null for none.

    A stream-static join on frequency buckets: a band is listed under every
    bucket that it touches, and its bounds are checked after.
    """
    first, last = bucket_of(F.col("band_start"), bucket_hz), bucket_of(F.col("band_end"), bucket_hz)
    listed = bands.withColumn("__bucket", F.explode(F.sequence(first, last)))
    points = breaks.withColumn("__bucket", bucket_of(F.col("center_hz"), bucket_hz))
    inside = (
        (points["__bucket"] == listed["__bucket"])
        & (points["center_hz"] >= listed["band_start"])
        & (points["center_hz"] <= listed["band_end"])
    )
    return points.join(listed, inside, "left").drop("__bucket")


def enrich_live(breaks: DataFrame, health: DataFrame, bands: DataFrame, watermark: str, max_age: int, bucket_hz: float) -> DataFrame:
    """Live breaks with their device's verdict and their band."""
    return with_bands(with_health(breaks, health, watermark, max_age), bands, bucket_hz)
