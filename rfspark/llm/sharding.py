"""Shards of near-equal bytes by a histogram sort.

Rows are ordered by a key of three parts: a hash of the text, the id, and a row
number. So equal texts lie together, and a crowd of them can still be split.
Splitters that cut the order into shards are found by counting, never by
gathering rows: in each round, every task counts the exact bytes and rows below
each probe and offers a few of its keys from the intervals that still hold a
splitter; the probes of the next round are spread over those keys. A splitter is
done when the bytes below it are within the tolerance of its target, or when no
key lies between the nearest probes. Boundaries between different texts are
preferred within the tolerance. Rows are then exchanged once, to stretches of
bounded size whose places in their shards the counts already tell.

A row's size is the UTF-8 bytes of its text plus 1 (a null text has none). Null
ids sort first. Rows that repeat an id and a text are told apart by their number.
An empty table gives no rows. Other columns may have any names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from rfspark.llm.common import cut, pack_row

TOLERANCE = 0.005  # of a shard
OFFERS = 64  # keys that an interval is narrowed by in a round, at most
STRETCH_BYTES = 128 << 20
KEY = 24


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    """The three parts of each row's key, as bytes that sort as the parts do."""
    parts = [np.asarray(batch.column(i)) for i in range(3)]
    out = np.empty((len(batch), KEY), np.uint8)
    for i, p in enumerate(parts):
        unsigned = p.view(np.uint64) ^ np.uint64(1 << 63)
        out[:, 8 * i : 8 * i + 8] = unsigned.astype(">u8").view(np.uint8).reshape(-1, 8)
    return out


def _below(keys: np.ndarray, probes: list[bytes]) -> np.ndarray:
    """For each key, how many probes are at most the key."""
    # One more byte, so that keys that end in zeros keep their full length.
    wide = np.hstack([keys, np.full((len(keys), 1), 1, np.uint8)]).copy().view(f"S{KEY + 1}").ravel()
    marks = np.array([p + b"\1" for p in probes], f"S{KEY + 1}")
    return np.searchsorted(marks, wide, side="right")


def _counted(keyed: DataFrame, probes: list[bytes], open_: list[int]) -> tuple[list, dict]:
    """Bytes and rows between neighbouring probes, and some keys of the open intervals."""
    wanted = np.zeros(len(probes) + 1, bool)
    wanted[open_] = True

    def run(batches):
        bytes_, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            keys = _keys(batch)
            at = _below(keys, probes)
            np.add.at(bytes_, at, np.asarray(batch.column(3)))
            rows += np.bincount(at, minlength=len(rows))
            held = np.flatnonzero(wanted[at])
            if len(held):
                luck = np.asarray(batch.column(4))[held]
                slot = at[held] * OFFERS + luck.view(np.uint64) % np.uint64(OFFERS)
                order = np.lexsort((luck, slot))
                _, first = np.unique(slot[order], return_index=True)
                best = order[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(at[held][best].astype(np.int32)),
                        pa.array((slot[best] % OFFERS).astype(np.int32)),
                        pa.array(np.zeros(len(best), np.int64)),
                        pa.array(np.zeros(len(best), np.int64)),
                        pa.array(luck[best]),
                        pa.array([k.tobytes() for k in keys[held][best]], pa.binary()),
                    ],
                    names,
                )
        full = np.flatnonzero(rows)
        none = [pa.nulls(len(full), pa.int64()), pa.nulls(len(full), pa.binary())]
        held = [pa.array(full.astype(np.int32)), pa.array(np.full(len(full), -1, np.int32))]
        yield pa.RecordBatch.from_arrays([*held, pa.array(bytes_[full]), pa.array(rows[full]), *none], names)

    names = ["at", "slot", "bytes", "n", "luck", "key"]
    found = keyed.mapInArrow(run, "at int, slot int, bytes long, n long, luck long, key binary")
    # At most one row for each interval, and OFFERS for each open one.
    found = found.groupBy("at", "slot").agg(
        F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), F.min(F.struct("luck", "key")).alias("best")
    )
    counts, offers = [(0, 0)] * (len(probes) + 1), {}
    for r in found.collect():
        if r["slot"] < 0:
            counts[r["at"]] = (r["bytes"], r["n"])
        else:
            offers.setdefault(r["at"], []).append(bytes(r["best"]["key"]))
    return counts, offers


def splitters(keyed: DataFrame, targets: list[int], tolerance: int) -> list[tuple[bytes, int, int]]:
    """For each target of bytes, a key with about that many bytes below it: ``key, bytes, rows`` below."""
    low, high = b"\0" * KEY, b"\xff" * KEY
    known = {low: (0, 0)}  # exact bytes and rows below each probe so far
    found, probes, open_ = {}, [], [0]
    total = None
    while True:
        counts, offers = _counted(keyed, probes, open_)
        run_b = run_n = 0
        for p, (b, n) in zip(probes, counts):
            run_b, run_n = run_b + b, run_n + n
            known[p] = (run_b, run_n)
        if total is None:
            total = run_b + counts[-1][0]
            known[high] = (total, run_n + counts[-1][1])
        marks = sorted(known)
        ask = {}
        for i, t in enumerate(targets):
            if i in found:
                continue
            j = np.searchsorted([known[m][0] for m in marks], t, side="right") - 1
            j = min(int(j), len(marks) - 2)
            a, b = marks[j], marks[j + 1]
            near = [m for m in (a, b) if abs(known[m][0] - t) <= tolerance]
            whole = [m for m in near if m[8:] == b"\0" * (KEY - 8) or m in (low, high)]
            if whole:
                found[i] = min(whole, key=lambda m: abs(known[m][0] - t))
            elif known[b][1] - known[a][1] <= 1:
                found[i] = min((a, b), key=lambda m: abs(known[m][0] - t))
            else:
                ask.setdefault((a, b), []).append(i)
        if not ask:
            break
        # Keys offered by the intervals in question, cut down to the start of their text where that lies inside.
        pool = sorted(k for keys in offers.values() for k in keys)
        new = set()
        for (a, b), waiting in ask.items():
            inside = [k for k in pool if a < k < b]
            heads = sorted({h for h in (k[:8] + b"\0" * (KEY - 8) for k in inside) if a < h < b})
            if heads:
                new.update(heads)
            elif inside:
                for i in waiting:
                    # Within one text the tolerance decides.
                    near = [m for m in (a, b) if abs(known[m][0] - targets[i]) <= tolerance]
                    if near:
                        found[i] = min(near, key=lambda m: abs(known[m][0] - targets[i]))
                if any(i not in found for i in waiting):
                    new.update(inside)
        probes = sorted({*new, *(m for pair in ask for m in pair if m not in (low, high))})
        edges = [low, *probes, high]
        open_ = [k for k, (x, y) in enumerate(zip(edges, edges[1:])) if any(a <= x and y <= b for a, b in ask)]
    return [(found[i], *known[found[i]]) for i in range(len(targets))]


def shard(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", carry=None, tolerance: float = TOLERANCE
) -> DataFrame:
    """``row`` (the columns, or those of ``carry``, in a struct), ``size, shard, slot`` for every row.

    ``slot`` counts from 0 within a shard, in key order, without gaps.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("__a"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("__b"),
        F.monotonically_increasing_id().alias("__c"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("__size"),
        (F.struct(*carry) if carry else pack_row(docs)).alias("__row"),
    )
    rows = cut(rows.withColumn("__luck", F.xxhash64("__a", "__b", "__c")), "shard")
    keyed = rows.select("__a", "__b", "__c", "__size", "__luck")
    total, n = rows.agg(F.coalesce(F.sum("__size"), F.lit(0)), F.count(F.lit(1))).first()
    per = max(1, -(-total // shards // STRETCH_BYTES), -(-n // shards // 1_000_000))
    targets = [total * i // (shards * per) for i in range(1, shards * per)]
    marks = splitters(keyed, targets, int(total / shards * tolerance)) if n else []
    keys = [k for k, _, _ in marks]
    starts = [0, *(r for _, _, r in marks)]

    def placed(batches):
        for batch in batches:
            at = _below(_keys(batch), keys).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], [*batch.schema.names, "__at"])

    schema = rows.drop("__luck").schema.add("__at", T.IntegerType())
    rows = rows.drop("__luck").mapInArrow(placed, schema)
    # A shard's first row, and so a stretch's place in its shard, is known from the counts.
    first = F.array(*[F.lit(int(starts[i] - starts[i // per * per])) for i in range(len(starts))])
    order = Window.partitionBy("__at").orderBy("__a", "__b", "__c")
    return rows.select(
        F.col("__row").alias("row"),
        F.col("__size").alias("size"),
        F.expr(f"cast(__at div {per} as int)").alias("shard"),
        (F.row_number().over(order) - 1 + F.element_at(first, F.col("__at") + 1)).cast("long").alias("slot"),
    )
