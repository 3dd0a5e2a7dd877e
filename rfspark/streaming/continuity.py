"""Breaks of live streams, found packet by packet with a small state per stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rfspark.operators import continuity as rules
from rfspark.operators.kernels import judge, moved

STATE = (
    "seq bigint, connection_id bigint, linked boolean, lost boolean, end_time double, duration double, jitter double, "
    "center_hz double, rate_hz double, produced bigint, gap boolean, initial boolean, new_center double, new_rate double, "
    "drops bigint, backward_steps bigint"
)
OUTPUT = "stream_id bigint, at_sample bigint, place int, kind string, center_hz double, rate_hz double, seq bigint, at double, tuned_hz double"
START = (-1, None, False, False, None, None, 0.0, None, None, 0, False, False, None, None, 0, 0)
NAMES = [c.split()[0] for c in STATE.split(", ")]
DAY_MS = 86_400_000
COLUMNS = ["seq", "connection_id", "payload", "start_time", "end_time", "samples", "center_hz", "rate_hz"]
PAYLOADS = ["iq", "lost", "closed", "other"]
STRETCH = 8192  # packets


class Timeline:
    """What one stream's timeline has come to, and the breaks it has met."""

    def __init__(self, values, cap: float, floor: float):
        self.s = dict(zip(NAMES, values))
        self.cap, self.floor = cap, floor
        self.out = []

    def values(self):
        return tuple(self.s[n] for n in NAMES)

    def bounds(self, duration):
        known = [d for d in (duration, self.s["duration"]) if d is not None]
        if not known:
            return self.cap, self.cap
        shortest = min(known)
        within = lambda share: min(self.cap, max(self.floor, share * shortest))
        return within(rules.PACKET_FRACTION), within(rules.PACKET_CEILING)

    def take(self, seq, connection, payload, start, end, samples, center, rate):
        s = self.s
        if seq <= s["seq"]:
            # Arrived after its successors: reported, never sorted back in.
            self.say(2, "late", None, None, seq, start)
            return
        s["seq"] = seq
        if payload == "closed":
            self.say(4, "closed", None, None, seq, start)
            return
        if payload not in ("iq", "lost"):
            return
        if s["connection_id"] is not None and connection != s["connection_id"]:
            s["gap"], s["linked"] = True, False
        s["connection_id"] = connection
        if payload == "lost":
            s["gap"], s["linked"] = True, False
            return
        duration = end - start if 0 < end - start < float("inf") else None
        if s["linked"]:
            gap = start - s["end_time"]
            low, high = self.bounds(duration)
            kind, s["jitter"] = judge(s["jitter"], gap, low, high, rules.JITTER_MARGIN, rules.JITTER_DECAY)
            if kind != "continuous":
                s["gap"] = True
                s["drops" if kind == "drop" else "backward_steps"] += 1
        s["linked"], s["end_time"], s["duration"] = True, end, duration
        if rate is not None and rate > 0:
            self.geometry(center, rate)
        if samples > 0:
            self.publish(seq, start)
            s["produced"] += samples

    def geometry(self, center, rate):
        s = self.s
        first = s["rate_hz"] is None
        if first or moved(s["center_hz"], s["rate_hz"], center, rate, rules.CENTER_CHANGE_HZ, rules.RATE_CHANGE_BAND):
            s["initial"] = s["initial"] or first
            s["new_center"], s["new_rate"] = center, rate
            s["center_hz"], s["rate_hz"] = center, rate

    def say(self, place, kind, center, rate, seq, at):
        self.out.append((self.s["produced"], place, kind, center, rate, seq, at, self.s["center_hz"]))

    def publish(self, seq, at):
        """Breaks go out ahead of the samples they precede: a gap, then a geometry."""
        s = self.s
        if s["gap"] and s["produced"] > 0:
            self.say(0, "gap", None, None, seq, at)
        if s["new_rate"] is not None:
            kind = "initial" if s["initial"] else "retune"
            self.say(1, kind, s["new_center"], s["new_rate"], seq, at)
        s["gap"], s["initial"], s["new_center"], s["new_rate"] = False, False, None, None


class ContinuityProcessor(StatefulProcessor):
    """One stream's packets of a micro-batch, in order, against its state."""

    def __init__(self, cap, floor, stall_ms, ttl_ms):
        self.cap, self.floor, self.stall_ms, self.ttl_ms = cap, floor, stall_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("timeline", STATE, self.ttl_ms) if self.ttl_ms else handle.getValueState("timeline", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        line = Timeline(self.state.get() if self.state.exists() else START, self.cap, self.floor)
        # Columns of numbers hold what is to be put in order; packets and breaks are taken in stretches.
        batch = pd.concat([self.lean(chunk) for chunk in rows], ignore_index=True)
        order = np.argsort(batch["seq"].to_numpy(), kind="stable")
        for first in range(0, len(order), STRETCH):
            part = batch.iloc[order[first : first + STRETCH]]
            for row in zip(*(part[c].tolist() for c in COLUMNS)):
                seq, conn, payload, start, end, samples, center, rate = row
                payload = PAYLOADS[payload]
                if payload == "closed":
                    start, end, conn, samples, center, rate = (0 if pd.isna(x) else x for x in (start, end, conn, samples, center, rate))
                line.take(int(seq), int(conn), payload, float(start), float(end), int(samples), float(center), float(rate))
            if line.out:
                yield _frame(key[0], line.out)
                line.out = []
        self.state.update(line.values())
        if self.stall_ms:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.stall_ms)

    def lean(self, chunk) -> pd.DataFrame:
        """A chunk's columns with the payload as a code; all that is no kind of its own is one."""
        code = chunk["payload"].map({p: k for k, p in enumerate(PAYLOADS)}).fillna(len(PAYLOADS) - 1).astype("int8")
        return chunk[COLUMNS].assign(payload=code)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Nothing came for the stall time: the connection is over."""
        line = Timeline(self.state.get(), self.cap, self.floor)
        line.s["gap"], line.s["linked"] = True, False
        self.state.update(line.values())
        line.say(3, "stall", None, None, line.s["seq"], line.s["end_time"])
        yield _frame(key[0], line.out)

    def close(self) -> None:
        pass


def _frame(stream, out) -> pd.DataFrame:
    names = [c.split()[0] for c in OUTPUT.split(", ")]
    df = pd.DataFrame([(stream, *row) for row in out], columns=names)
    return df.astype({"stream_id": "int64", "at_sample": "int64", "place": "int32", "seq": "int64", "center_hz": "float64", "rate_hz": "float64", "kind": "object", "at": "float64", "tuned_hz": "float64"})


def continuity_stream(
    packets: DataFrame, cap_s=rules.DEFAULT_CAP_S, ticks: float = 1.0, stall_s=rules.STALL_S, ttl_ms: int | None = None
) -> DataFrame:
    """Breaks of every stream as its packets arrive.

    State is one short row per stream. Packets are ordered inside a micro-batch, which is held as numbers;
    one that comes after its successors is a ``late`` row. With ``stall_s``, a
    stream that goes quiet gives a ``stall`` row and its next packet is a new
    start. A ``closed`` marker is passed on as a ``closed`` row. ``at`` is the start of
    the packet that a row speaks of, ``tuned_hz`` the centre last announced. Needs the RocksDB state store. ``ttl_ms`` forgets silent streams.
    """
    cap = float("inf") if cap_s is None else cap_s * ticks
    processor = ContinuityProcessor(
        cap, rules.RESOLUTION_FLOOR_S * ticks, int(stall_s * 1000) if stall_s else None, ttl_ms
    )
    lean = packets.select(
        "stream_id", "connection_id", "seq", "payload", "start_time", "end_time", "samples", "center_hz", "rate_hz"
    )
    return lean.groupBy("stream_id").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=OUTPUT,
        outputMode="append",
        timeMode="ProcessingTime" if stall_s or ttl_ms else "None",
    )
