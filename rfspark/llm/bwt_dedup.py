"""Suffix-array dedup by merging Burrows-Wheeler transforms of shards.

Only stretches of text that can hold a repeated string are indexed. Every string of
``length`` bytes holds one minimal gram (the least hash of its ``GRAM``-byte grams,
the first of equals); equal strings hold it at the same place. So a text falls into
runs of starts that share a gram, and two equal strings lie in runs with the same gram. Runs
whose gram occurs once are done with; of the others equal stretches are kept once, with their
number, and sent to their gram's task.

There, shards of stretches are each sorted and transformed. A symbol is a block of
``length / ROUNDS`` bytes, so a stretch is as many strings as a symbol has bytes, one
per phase. The transforms are merged by refining their interleave: a round reads
the symbols before all suffixes in the order so far and deals the suffixes' shards
into buckets by symbol, which orders them by one symbol more. Borders between
suffixes that appear in round ``r`` mean a common prefix of ``r - 1`` symbols; what
is still together after the last round is a repeated interval. No suffix of the
union is sorted again, and an interval counts with the numbers of its stretches.

Grams in more different stretches than a task should hold are settled by counting their
strings one by one in a plain aggregation, which has no groups.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rfspark.llm.common import cut, mix64, ship, stretches

GRAM = 64
ROUNDS = 4
PIECE = 1 << 20  # bytes of text looked at together; longer texts are taken in overlapping pieces
CHUNK = 2 << 20  # bytes of stretches merged together, unless one gram has more
SHARD = 256 << 10  # bytes of stretches in one transform
CROWD = 4096  # different stretches of one gram that a task merges
BASE = 0x9E3779B97F4A7C15 | 5
RUNS = "h1 bigint, h2 bigint, id bigint, lo int, off int, span int, key bigint, full bigint"
NO_ID = -(1 << 63)  # stands for a null id


@functools.lru_cache(1)
def _table() -> np.ndarray:
    """A value of 64 bits for each byte."""
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


_grown: list = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _powers(size: int) -> list[np.ndarray]:
    """Powers of ``BASE`` and of its inverse modulo 2**64, ``size`` or more of them."""
    if len(_grown[0]) < size:
        size = 1 << max(16, (size - 1).bit_length())
        for k, b in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            _grown[k] = np.multiply.accumulate(x)
    return _grown


class Hashes:
    """Hashes of any stretches of a buffer, from sums of bytes times powers modulo 2**64."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_table()[data] * power[: len(data)], out=self.sums[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (self.sums[hi] - self.sums[lo]) * self.inverse[lo]

    def every(self, size: int) -> np.ndarray:
        """The hash of each stretch of ``size`` bytes."""
        n = max(len(self.sums) - size, 0)
        return (self.sums[size : size + n] - self.sums[:n]) * self.inverse[:n]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values, from minima running through blocks in both directions."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    square = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def runs_of(data: np.ndarray, starts: np.ndarray, length: int, gram: int):
    """Runs of starts that share a minimal gram: row, lo, place of the gram from lo, starts after lo, gram's and stretch's hashes.

    ``starts`` are the borders of texts in ``data`` (one more than texts).
    """
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int32, np.int32, np.int32, np.int64, np.int64))
    if len(data) < length:
        return none
    h = Hashes(data)
    grams = h.every(gram)
    place = np.arange(len(grams), dtype=np.uint64)
    least = _least((mix64(grams) & np.uint64(0xFFFFFFFF00000000)) | place, length - gram + 1)
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(starts)
    row = np.repeat(np.arange(len(sizes)), np.maximum(sizes - length + 1, 0))
    if not len(row):
        return none
    first = np.cumsum(np.maximum(sizes - length + 1, 0)) - np.maximum(sizes - length + 1, 0)
    s = np.arange(len(row)) - first[row] + starts[row]
    at = at[s]
    new = np.ones(len(s), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(s)) - 1
    lo, hi, p, r = s[begin], s[end], at[begin], row[begin]
    key = mix64(h.of(p, p + gram))
    full = mix64(h.of(lo, hi + length) + (hi - lo).astype(np.uint64))
    return (
        r,
        (lo - starts[r]).astype(np.int32),
        (p - lo).astype(np.int32),
        (hi - lo).astype(np.int32),
        key.view(np.int64),
        full.view(np.int64),
    )


def _find_runs(batches, length, gram):
    """Runs of a task's texts; a batch is worked on in parts, a long text in overlapping pieces."""
    for batch in batches:
        for part in stretches(batch, 3, PIECE):
            text = part.column(3)
            offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
            data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
            offsets -= offsets[0]
            if len(text) > 1 or len(data) <= 2 * PIECE:
                cuts = [(data, offsets, 0)]
            else:
                cuts = [
                    (d := data[a : a + PIECE + length - 1], np.array([0, len(d)]), a) for a in range(0, len(data), PIECE)
                ]
            for piece, borders, base in cuts:
                r, lo, off, span, key, full = runs_of(piece, borders, length, gram)
                rows = pa.array(r)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(rows) for c in range(3)] + [pa.array(x) for x in (lo + np.int32(base), off, span, key, full)],
                    ["h1", "h2", "id", "lo", "off", "span", "key", "full"],
                )


CUT = "key bigint, full bigint, fulls bigint, n bigint, stretch binary"


def _cut_stretches(batches, length):
    """The bytes of the asked stretches of each text."""
    for batch in batches:
        for row in range(batch.num_rows):
            text = batch.column("body")[row].as_buffer()
            asked = batch.column("asked")[row].values
            lo = asked.field("lo").to_numpy()
            hi = lo + asked.field("span").to_numpy() + length
            view = memoryview(text) if text is not None else b""
            for a in range(0, len(lo), 4096):
                parts = [bytes(view[x:y]) for x, y in zip(lo[a : a + 4096].tolist(), hi[a : a + 4096].tolist())]
                own = asked.slice(a, 4096)
                yield pa.RecordBatch.from_arrays(
                    [own.field(c) for c in ("key", "full", "fulls", "n")] + [pa.array(parts, pa.binary())],
                    ["key", "full", "fulls", "n", "stretch"],
                )


def _laid_out(parts: list[bytes], length: int):
    """Stretches one after another with a slot more each (its end), and their first slots and sizes."""
    sizes = np.array([len(p) for p in parts], np.int64)
    base = np.concatenate([[0], np.cumsum(sizes + 1)])
    data = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
    return data, base, sizes


def transform(code: np.ndarray, left: np.ndarray, before: np.ndarray, step: int):
    """A shard's suffixes ordered by their first four symbols, and the symbol before each (0: none).

    ``code`` has the symbol at each slot (0: too near the end), ``left`` the number of whole
    symbols from there on, ``before`` the symbol that ends at the slot.
    """
    def pair(first, gap, enough):
        then = np.zeros(len(first), np.int64)
        then[:-gap] = first[gap:]
        return first * (int(first.max()) + 1) + np.where(enough, then, 0)

    def dense(key):
        order = np.argsort(key)
        ranks = np.empty(len(key), np.int64)
        ranks[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        return ranks

    two = dense(pair(code, step, left >= 1))
    order = np.argsort(pair(two, 2 * step, left >= 2))
    return order, before[order]


def merge(transforms: list[np.ndarray], ends: np.ndarray, rounds: int):
    """Interleave transforms by refinement: the shard of each place, and the number of its block of equal prefixes.

    ``transforms`` hold the symbols before the suffixes in each shard's order, 0
    where there is none; ``ends`` counts the empty suffixes of each shard, which
    come first. Suffixes in one block agree in their first ``rounds`` symbols.
    """
    symbols = np.concatenate(transforms).astype(np.uint64)
    shards = np.repeat(np.arange(len(transforms), dtype=np.uint16), [len(t) for t in transforms])
    empty = np.repeat(np.arange(len(transforms), dtype=np.uint16), ends)
    block = np.zeros(len(shards), np.int32)
    for _ in range(rounds):
        # In each shard the suffixes keep their order: its transform is read on from place to place.
        seen = np.empty(len(shards), np.uint64)
        seen[np.argsort(shards, kind="stable")] = symbols
        at = np.flatnonzero(seen)
        dealt = np.sort((seen[at] << np.uint64(32)) | at.astype(np.uint64))
        source = (dealt & np.uint64(0xFFFFFFFF)).astype(np.int64)
        symbol, own = dealt >> np.uint64(32), block[source]
        border = np.ones(len(source), bool)
        border[1:] = (symbol[1:] != symbol[:-1]) | (own[1:] != own[:-1])
        shards = np.concatenate([empty, shards[source]])
        block = np.concatenate([np.zeros(len(empty), np.int32), np.cumsum(border, dtype=np.int32)])
    return shards, block


def repeated_starts(parts: list[bytes], numbers: np.ndarray, length: int, rounds: int = ROUNDS):
    """Which starts in the stretches begin a string of ``length`` bytes that begins twice or more: (stretch, start) pairs.

    A stretch counts ``numbers`` times. Shards of stretches are transformed, and the transforms merged.
    """
    step = length // rounds
    data, base, sizes = _laid_out(parts, length)
    slot = np.arange(len(data)) - np.repeat(base[:-1], sizes + 1)
    left = (np.repeat(sizes, sizes + 1) - slot) // step
    hashes = Hashes(data).every(step)
    hashes = np.append(hashes, np.zeros(len(data) - len(hashes), np.uint64))
    _, code = np.unique(hashes, return_inverse=True)
    code = np.where(left > 0, code.astype(np.int64) + 1, 0)
    before = np.zeros(len(code), np.int64)
    before[step:] = code[:-step]
    before[slot < step] = 0
    cuts = np.unique(np.searchsorted(base[1:], np.arange(0, base[-1], SHARD)))
    borders = np.append(cuts, len(parts))
    orders, transforms, ends = [], [], []
    for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
        lo, hi = int(base[a]), int(base[b])
        order, symbols = transform(code[lo:hi], left[lo:hi], before[lo:hi], step)
        orders.append(order + lo)
        transforms.append(symbols)
        ends.append(step * (b - a))
    shards, block = merge(transforms, np.array(ends), rounds)
    slots = np.empty(len(data), np.int64)
    slots[np.argsort(shards, kind="stable")] = np.concatenate(orders)
    owner = np.repeat(np.arange(len(parts)), sizes + 1)
    starts = left[slots] >= rounds
    weight = np.where(starts, numbers[owner[slots]], 0)
    total = np.bincount(block, weights=weight)
    hit = np.sort(slots[starts & (total[block] >= 2)])
    return owner[hit], slot[hit]


SPANS = "key bigint, full bigint, begin array<int>, end array<int>"


def _merge_chunks(batches, length):
    """Repeated spans of a task's stretches, which come by key; only whole keys are merged together."""
    held, size = [], 0

    def spans():
        keys, fulls, numbers, parts = (
            [x for b in held for x in b[0]],
            [x for b in held for x in b[1]],
            np.array([x for b in held for x in b[2]], np.int64),
            [x for b in held for x in b[3]],
        )
        owner, start = repeated_starts(parts, numbers, length)
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(owner)) - 1
        who, at = np.unique(owner[begin], return_index=True)
        offsets = pa.array(np.append(at, len(begin)).astype(np.int32) if len(who) else [0], pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([keys[w] for w in who], pa.int64()),
                pa.array([fulls[w] for w in who], pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(start[begin].astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array((start[end] + length).astype(np.int32))),
            ],
            ["key", "full", "begin", "end"],
        )

    last = None
    for batch in batches:
        keys = batch.column("key").to_numpy()
        borders = np.append(np.flatnonzero(np.diff(keys)) + 1, len(keys)).tolist()
        lo = 0
        for hi in borders:
            if hi == lo:
                continue
            if size >= CHUNK and keys[lo] != last:
                yield spans()
                held, size = [], 0
            own = batch.slice(lo, hi - lo)
            parts = own.column("stretch").to_pylist()
            held.append((own.column("key").to_pylist(), own.column("full").to_pylist(), own.column("n").to_pylist(), parts))
            size += sum(map(len, parts))
            last, lo = keys[hi - 1], hi
    if held:
        yield spans()


WINDOWS = "key bigint, full bigint, n bigint, at int, w1 bigint, w2 bigint"


def _windows(batches, length):
    """Every string of ``length`` bytes of the stretches, as two hashes."""
    for batch in batches:
        for part in stretches(batch, 4, CHUNK // 4):
            data, base, sizes = _laid_out(part.column(4).to_pylist(), length)
            count = sizes - length + 1
            owner = np.repeat(np.arange(len(sizes)), count)
            at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            h = Hashes(data)
            lo = base[owner] + at
            half = length // 2
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [part.column(c).take(rows) for c in (0, 1, 3)]
                + [
                    pa.array(at.astype(np.int32)),
                    pa.array(mix64(h.of(lo, lo + half)).view(np.int64)),
                    pa.array(mix64(h.of(lo + half, lo + length)).view(np.int64)),
                ],
                ["key", "full", "n", "at", "w1", "w2"],
            )


def _crowded(stretches_: DataFrame, length: int) -> DataFrame:
    """Repeated spans of stretches whose gram is in too many others: strings counted one by one."""
    rows = cut(stretches_.mapInArrow(lambda b: _windows(b, length), WINDOWS), "bwt")
    again = rows.groupBy("w1", "w2").agg(F.sum("n").alias("n")).where("n >= 2").select("w1", "w2")
    hit = rows.join(again, ["w1", "w2"], "left_semi").groupBy("key", "full").agg(F.array_sort(F.collect_list("at")).alias("at"))
    # A string each; the removal joins what overlaps.
    return hit.select("key", "full", F.col("at").alias("begin"), F.transform("at", lambda x: x + length).alias("end"))


def repeated(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, body, begins, ends``: every row with the byte spans of its text (null without any) that lie in repeated strings.

    Spans can overlap. ``length`` must be a multiple of ``ROUNDS``. Rows with equal ids,
    or null ones, are rows of their own; equal texts repeat each other. A null text is empty. Only the two named columns are read.
    """
    if length % ROUNDS or length < 2 * ROUNDS:
        raise ValueError(f"length must be a multiple of {ROUNDS}")
    ship(docs.sparkSession)
    gram = max(1, min(GRAM, length // 4))
    body = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), body.alias("body"))
    names = [F.xxhash64("body").alias("h1"), F.xxhash64(F.lit(length), "body").alias("h2")]
    known = F.coalesce(F.col("id").cast("bigint"), F.lit(NO_ID)).alias("id")
    named = rows.select(*names, known, "body")
    runs = cut(named.mapInArrow(lambda b: _find_runs(b, length, gram), RUNS), "bwt")
    often = runs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("key")
    # Equal texts are one text, its number beside it.
    places = runs.join(often, "key", "left_semi").groupBy("key", "full", "h1", "h2", "lo", "off", "span")
    places = cut(places.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")), "bwt")
    kinds = places.groupBy("key", "full").agg(
        F.sum("n").alias("n"), F.min(F.struct("h1", "h2", "id", "lo", "span")).alias("one")
    )
    kinds = cut(kinds, "bwt")
    fulls = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("fulls"))
    asked = kinds.join(fulls, "key").groupBy("one.h1", "one.h2", "one.id").agg(
        F.collect_list(F.struct("one.lo", "one.span", "key", "full", "fulls", "n")).alias("asked")
    )
    cuts = named.join(asked, ["h1", "h2", "id"]).select("body", "asked")
    parts = cut(cuts.mapInArrow(lambda b: _cut_stretches(b, length), CUT).dropDuplicates(["key", "full"]), "bwt")
    merged = (
        parts.where(F.col("fulls") <= CROWD)
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(lambda b: _merge_chunks(b, length), SPANS)
    )
    spans = cut(merged.unionByName(_crowded(parts.where(F.col("fulls") > CROWD), length)), "bwt")
    found = (
        places.join(spans, ["key", "full"])
        .select("h1", "h2", "lo", F.explode(F.arrays_zip("begin", "end")).alias("s"))
        .groupBy("h1", "h2")
        .agg(F.collect_set(F.struct((F.col("lo") + F.col("s.begin")).alias("b"), (F.col("lo") + F.col("s.end")).alias("e"))).alias("s"))
        .select("h1", "h2", F.col("s.b").alias("begins"), F.col("s.e").alias("ends"))
    )
    return rows.select(*names, "id", "body").join(found, ["h1", "h2"], "left").select("id", "body", "begins", "ends")


REMOVED = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]


def remove(docs: DataFrame, length: int = 400, keep_text: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256[, kept]``: texts without the bytes that lie in repeated strings.

    ``kept`` is binary, as a cut can split a character. A null text is an empty one; an empty table gives no rows.
    """
    rows = repeated(docs, length, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()

    def cut_out(batches):
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                body = batch.column("body")[row].as_buffer()
                begins, ends = batch.column("begins")[row].values, batch.column("ends")[row].values
                view, removed, spans, kept, at = memoryview(body), 0, 0, [], 0
                if begins is not None:
                    b, e = begins.to_numpy(), ends.to_numpy()
                    order = np.argsort(b)
                    b, e = b[order], np.maximum.accumulate(e[order])
                    new = np.append(True, b[1:] > e[:-1])
                    stop = np.append(e[:-1][new[1:]], e[-1])
                    for x, y in zip(b[new].tolist(), stop.tolist()):
                        kept.append(view[at:x])
                        at, removed, spans = y, removed + y - x, spans + 1
                kept.append(view[at:])
                digest = hashlib.sha256()
                for k in kept:
                    digest.update(k)
                out.append((body.size, removed, spans, digest.hexdigest()) + ((b"".join(kept),) if keep_text else ()))
            columns = list(zip(*out)) or [()] * (5 if keep_text else 4)
            arrays = [batch.column("id")]
            arrays += [pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(columns[3], pa.string())]
            arrays += [pa.array(columns[4], pa.binary())] if keep_text else []
            yield pa.RecordBatch.from_arrays(
                arrays, ["id", *[n for n, _ in REMOVED], "kept_sha256", *(["kept"] if keep_text else [])]
            )

    schema = f"id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return rows.mapInArrow(cut_out, schema + (", kept binary" if keep_text else ""))
