"""Continuity rules whose verdict on one row changes how the next is judged.

Both run over blocks of a stream, in three steps. Every block first reports, on
its own, what it would turn any incoming state into. The reports, one short row
per block, are chained per stream. Then every block is judged on its own again,
now from the state that really came in. No task ever holds more than a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rfspark.operators.scan import BLOCK

KEYS = ["stream_id", BLOCK]


def _fields(df: DataFrame, *names: str) -> str:
    return ", ".join(f"{n} {df.schema[n].dataType.simpleString()}" for n in names)


def _with_column(df: DataFrame, name: str, ddl: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{name}` {ddl}"


def _doubles(table: pa.Table, name: str) -> list:
    return table.column(name).cast(pa.float64(), safe=False).to_pylist()


# --- jitter ---------------------------------------------------------------


class JitterReport:
    """What a block makes of an incoming jitter.

    Pieces ``(start, n, b)``: from ``start`` on, jitter ``j`` leaves as the
    larger of ``j`` decayed ``n`` times and ``b``; ``n < 0`` means ``b`` alone.
    """

    def __init__(self, margin: float, decay: float):
        self.margin, self.decay = margin, decay
        self.pieces = [(0.0, 0, 0.0)]

    def _accept(self, n, b, size):
        return (n if n < 0 else n + 1, max(b * self.decay, size))

    def close_gaps(self, count: int, top: float):
        """So many rows below the lower bound; ``top`` is their own decayed maximum behind the last."""
        if count:
            fade = self.decay**count
            self.pieces = [(lo, n if n < 0 else n + count, max(b * fade, top)) for lo, n, b in self.pieces]

    def open_gap(self, size: float):
        need, out = size / self.margin, []
        for k, (lo, n, b) in enumerate(self.pieces):
            hi = self.pieces[k + 1][0] if k + 1 < len(self.pieces) else float("inf")
            if b >= need:
                at = lo
            else:
                at = hi if n < 0 else max(lo, need / self.decay**n)
            if at > lo:
                out.append((lo, n, b))
            if at < hi:
                out.append((at, *self._accept(n, b, size)))
        self.pieces = self._merged(out)

    def _merged(self, pieces):
        out = []
        for k, (lo, n, b) in enumerate(pieces):
            hi = pieces[k + 1][0] if k + 1 < len(pieces) else float("inf")
            if n >= 0 and hi * self.decay**n <= b:
                n = -1
            if not out or out[-1][1:] != (n, b):
                out.append((lo, n, b))
        return out


def leave(jitter: float, starts, ns, bs, decay: float) -> float:
    k = int(np.searchsorted(starts, jitter, side="right")) - 1
    n, b = int(ns[k]), float(bs[k])
    if n < 0:
        return b
    while n and jitter > b:
        jitter *= decay
        n -= 1
    return max(jitter, b)


def judge(jitter: float, gap: float, low: float, high: float, margin: float, decay: float):
    """Class of one gap under the jitter so far, and the jitter after it."""
    size = abs(gap)
    if size <= low or (size <= high and size <= margin * jitter):
        return "continuous", max(jitter * decay, size)
    return ("drop" if gap > 0 else "backward"), jitter


def between_open(size, low, high, decay: float):
    """The rows between the bounds, and what the rows below them do ahead of each and behind the last.

    Decay and maximum are associative, so a stretch of rows below the lower bound
    is its length and its own decayed maximum. Rows above both bounds do nothing.
    """
    closed, opened = size <= low, np.flatnonzero((size > low) & (size <= high))
    ends = np.append(np.cumsum(closed)[opened], closed.sum())
    starts = np.append(0, ends[:-1])
    count, top = ends - starts, np.zeros(len(ends))
    some = count > 0
    if some.any():
        behind = np.repeat(ends, count) - 1 - np.arange(ends[-1])
        top[some] = np.maximum.reduceat(size[closed] * decay**behind, starts[some])
    return closed, opened, count, top


def accepted(jitter: float, size, low, high, margin: float, decay: float):
    """Which rows a block accepts from a jitter on: a step of the loop for each row between the bounds only.

    A stretch is decayed by a power, one row at a time by products; where the
    two could fall on different sides of a limit, the block is gone through row by row.
    """
    closed, opened, count, top = between_open(size, low, high, decay)
    fades, ok, state = (decay**count).tolist(), closed.copy(), jitter
    for at, s, fade, ahead in zip(opened.tolist(), size[opened].tolist(), fades, top.tolist()):
        state = max(state * fade, ahead)
        limit = margin * state
        if abs(s - limit) <= 1e-9 * s:
            break
        if s <= limit:
            ok[at], state = True, max(state * decay, s)
    else:
        return ok
    for at in np.flatnonzero(size <= np.maximum(low, high)).tolist():
        kind, jitter = judge(jitter, size[at], low[at], high[at], margin, decay)
        ok[at] = kind == "continuous"
    return ok


def judge_with_jitter(rows: DataFrame, margin: float, decay: float) -> DataFrame:
    """Add ``gap_class`` to rows holding ``gap, __low, __high`` and their block."""

    def bounds(table):
        return (table.column(n).cast(pa.float64(), safe=False).to_numpy() for n in ("gap", "__low", "__high"))

    def report(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        gap, low, high = bounds(table)
        size, r = np.abs(gap), JitterReport(margin, decay)
        _, opened, count, top = between_open(size, low, high, decay)
        for s, n, ahead in zip(size[opened].tolist(), count.tolist(), top.tolist()):
            r.close_gaps(n, ahead)
            r.open_gap(s)
        r.close_gaps(int(count[-1]), float(top[-1]))
        starts, ns, bs = zip(*r.pieces)
        return pa.table(
            {
                "stream_id": table.column("stream_id").slice(0, 1),
                BLOCK: table.column(BLOCK).slice(0, 1),
                "starts": pa.array([list(starts)]),
                "ns": pa.array([list(ns)], pa.list_(pa.int64())),
                "bs": pa.array([list(bs)]),
            }
        )

    def chain(table: pa.Table) -> pa.Table:
        table = table.sort_by(BLOCK)
        jitter, came = 0.0, []
        for p in table.select(["starts", "ns", "bs"]).to_pylist():
            came.append(jitter)
            jitter = leave(jitter, p["starts"], p["ns"], p["bs"], decay)
        return table.select(KEYS).append_column("__came", pa.array(came, pa.float64()))

    def settle(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        gap, low, high = bounds(table)
        ok = accepted(table.column("__came")[0].as_py(), np.abs(gap), low, high, margin, decay)
        first = table.column("gap").is_null().to_numpy()
        out = np.select([first, ok, gap > 0], ["first", "continuous", "drop"], "backward")
        return table.drop_columns(["__came"]).append_column("gap_class", pa.array(out, pa.string()))

    lean = rows.select(*KEYS, "seq", "gap", "__low", "__high")
    keys = _fields(rows, *KEYS)
    reports = lean.groupBy(*KEYS).applyInArrow(report, f"{keys}, starts array<double>, ns array<bigint>, bs array<double>")
    came = reports.groupBy("stream_id").applyInArrow(chain, f"{keys}, __came double")
    joined = rows.join(came, KEYS)
    return joined.groupBy(*KEYS).applyInArrow(settle, _with_column(rows, "gap_class", "string"))


# --- announced geometry ---------------------------------------------------


def moved(c0, r0, c, r, center_tol, band):
    return (np.abs(c0 - c) > center_tol) | (np.abs(r - r0) / r0 > band)


def next_move(c, r, start, c0, r0, center_tol, band) -> int:
    """First position from ``start`` on that leaves ``(c0, r0)``, or the length."""
    n, width = len(c), 256
    while start < n:
        stop = min(n, start + width)
        hit = np.flatnonzero(moved(c0, r0, c[start:stop], r[start:stop], center_tol, band))
        if hit.size:
            return start + int(hit[0])
        start, width = stop, width * 2
    return n


def geometry_report(c, r, center_tol, band):
    """Rows of a block that could be first to leave some announced geometry.

    Only a row that widens the range seen so far can. Past the point where the
    range is too wide for any geometry to cover, none is left to leave.
    """
    if not len(c):
        return [], [], [], []
    tops = [np.maximum.accumulate(x) for x in (c, r)]
    lows = [np.minimum.accumulate(x) for x in (c, r)]
    fresh = np.ones(len(c), bool)
    fresh[1:] = (
        (tops[0][1:] > tops[0][:-1]) | (lows[0][1:] < lows[0][:-1])
        | (tops[1][1:] > tops[1][:-1]) | (lows[1][1:] < lows[1][:-1])
    )
    too_wide = (tops[0] - lows[0] > 2.001 * center_tol) | (
        tops[1] / lows[1] > 1.001 * (1 + band) / (1 - band)
    )
    last = int(np.argmax(too_wide)) if too_wide.any() else len(c) - 1
    records = np.flatnonzero(fresh[: last + 1])
    ends = {}

    def end(i):
        path = []
        while i not in ends:
            path.append(i)
            j = next_move(c, r, i + 1, c[i], r[i], center_tol, band)
            if j == len(c):
                ends[i] = i
                break
            i = j
        final = ends[i]
        for p in path:
            ends[p] = final
        return final

    finals = [end(int(i)) for i in records]
    return c[records].tolist(), r[records].tolist(), c[finals].tolist(), r[finals].tolist()


def replay_geometry(rows: DataFrame, center_tol: float, band: float) -> DataFrame:
    """Add ``geometry_change`` (initial, retune or null) to rows with their block."""

    def usable(table):
        c = np.array(_doubles(table, "center_hz"), dtype=float)
        r = np.array(_doubles(table, "rate_hz"), dtype=float)
        keep = np.flatnonzero(r > 0)
        return keep, c[keep], r[keep]

    def report(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        _, c, r = usable(table)
        columns = geometry_report(c, r, center_tol, band)
        floats = pa.list_(pa.float64())
        return pa.table(
            {
                "stream_id": table.column("stream_id").slice(0, 1),
                BLOCK: table.column(BLOCK).slice(0, 1),
                **{n: pa.array([v], floats) for n, v in zip(("rc", "rr", "ec", "er"), columns)},
            }
        )

    def chain(table: pa.Table) -> pa.Table:
        table = table.sort_by(BLOCK)
        state, came = None, []
        for p in table.select(["rc", "rr", "ec", "er"]).to_pylist():
            came.append(state)
            for rc, rr, ec, er in zip(p["rc"], p["rr"], p["ec"], p["er"]):
                if state is None or moved(*state, rc, rr, center_tol, band):
                    state = (ec, er)
                    break
        return (
            table.select(KEYS)
            .append_column("__cc", pa.array([s and s[0] for s in came], pa.float64()))
            .append_column("__cr", pa.array([s and s[1] for s in came], pa.float64()))
        )

    def settle(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        keep, c, r = usable(table)
        out = [None] * table.num_rows
        c0, r0 = table.column("__cc")[0].as_py(), table.column("__cr")[0].as_py()
        at = 0
        if c0 is None and len(c):
            out[keep[0]], c0, r0, at = "initial", c[0], r[0], 1
        while c0 is not None:
            at = next_move(c, r, at, c0, r0, center_tol, band)
            if at == len(c):
                break
            out[keep[at]], c0, r0, at = "retune", c[at], r[at], at + 1
        return table.drop_columns(["__cc", "__cr"]).append_column("geometry_change", pa.array(out, pa.string()))

    lean = rows.select(*KEYS, "seq", "center_hz", "rate_hz")
    keys = _fields(rows, *KEYS)
    lists = "rc array<double>, rr array<double>, ec array<double>, er array<double>"
    reports = lean.groupBy(*KEYS).applyInArrow(report, f"{keys}, {lists}")
    came = reports.groupBy("stream_id").applyInArrow(chain, f"{keys}, __cc double, __cr double")
    joined = rows.join(came, KEYS)
    return joined.groupBy(*KEYS).applyInArrow(settle, _with_column(rows, "geometry_change", "string"))
