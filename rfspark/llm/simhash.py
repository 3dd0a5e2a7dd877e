"""SimHash near-dedup by a generalised pigeonhole search.

A text's fingerprint has a bit set where more than half of its shingles' hashes
have it set. Texts link when fingerprints differ in at most ``k`` bits.

Search: bits that vary together are grouped into partitions (so that values of
different partitions are nearly independent). If thresholds t_1..t_m sum to
``k - m + 1``, two fingerprints within ``k`` bits agree to within t_i bits on
some partition i; a threshold of -1 leaves a partition out. Each fingerprint
gets its own thresholds: a dynamic program over the partitions minimises the
candidates to be expected, from exact counts of the fingerprint's own value and
estimates for its neighbours. It then probes every value within t_i bits, and
candidates are verified by their full distance inside the join.

With a similarity asked for, fingerprints only propose pairs: neighbours in
tables sorted by partition. They decide nothing, as a pair at the limit of the
similarity often differs in more than ``k`` bits. What they leave apart is found by
a prefix search, which is exact. Sets of shingles are put in one order, frequent shingles
last; two sets at the similarity or above share a shingle among the first
``size - ceil(similarity * size) + 1`` of both. Only how frequent shingles are is
taken from a sample, and any order would find the same links. First all nodes
under a shingle meet one of them, so that a crowd becomes one component and not
all its pairs; then pairs between components are tried. A set has an odd sketch
(the parity of its shingles in 512 cells; a large one has another of 4096). Two sketches differ in at most as many
bits as there are shingles in one set only, so most pairs fall without their texts,
and of the texts only those of pairs that are left are exchanged.

Equal fingerprints are one node, so copies never become pairs; a fingerprint has
a bounded number of neighbours within ``k`` bits whatever the number of rows.

A null text is empty. A text with fewer words than a shingle has one shingle,
the whole sequence; without words the fingerprint is zero, linked like any other.
Repeated rows share their fingerprint and component. Null ids are never the
smallest id of a component that has another; a component of null ids has null, and
``dedup`` keeps one row of it.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from rfspark.llm.common import cut, mix64, stretches, tidied, words_of
from rfspark.llm.graph import components

SEED = 42
PROBE = 10.0  # what a probe costs, against a candidate
SAMPLE = 20_000  # fingerprints at most, for grouping bits; texts about, for what is frequent
FREQUENT = 500_000  # shingles at most that are put last
NEXT = (1, 2, 4, 8)  # places back, in a shingle's order, of the nodes that one meets


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included; none if there are no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(b" ".join(words), SEED)] if words else [], np.uint64)
    return np.array([digest(b" ".join(x), SEED) for x in zip(*(words[i:] for i in range(width)))], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have, as an unsigned 64-bit value."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The set of shingles of each text, as sorted hashes of 64 bits; the words are hashed once, then summed up by place."""
    codes, words, starts = words_of(texts)
    word = np.array([xxhash.xxh64_intdigest(w, SEED) for w in words.to_pylist()], np.uint64)[codes]
    factors = mix64(np.arange(1, width + 2, dtype=np.uint64)) | np.uint64(1)
    sums = np.zeros(len(word), np.uint64)
    for j in range(min(width, len(word))):
        sums[: len(word) - j] += word[j:] * factors[j]
    sums = mix64(sums)
    out = []
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if 0 < hi - lo < width:
            whole = (word[lo:hi] * factors[: hi - lo]).sum(dtype=np.uint64, keepdims=True) + factors[width:] * np.uint64(hi - lo)
            out.append(mix64(whole))
        else:
            out.append(np.unique(sums[lo : max(lo, hi - width + 1)]))
    return out


def _set_name(shingles: np.ndarray) -> int:
    """One value for a set of shingles."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), SEED)).astype(np.int64))


def odd_sketch(shingles: np.ndarray, power: int = 9) -> np.ndarray:
    """The parity of the number of shingles in each of ``2**power`` cells, as longs."""
    odd = np.bincount((shingles >> np.uint64(64 - power)).astype(np.int64), minlength=1 << power) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, copies: bool = False
) -> DataFrame:
    """``id, fp, node`` for every row; ``fp`` is the fingerprint's 64 bits as a long, and ``node`` too.

    With ``copies`` also ``copy``, which only rows that repeat both id and text share.
    """
    named = ["id", "fp", "node", *(["copy"] if copies else [])]

    def run(batches):
        for batch in (p for b in batches for p in stretches(b, 1, TEXT_BYTES)):
            fps = np.array([fingerprint(shingle_hashes(t, width)) for t in batch.column(1).to_pylist()], np.uint64)
            made = pa.array(fps.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), made, made, *batch.columns[2:]], named)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.select("id", "text", _copy("id", "text")) if copies else rows
    return rows.mapInArrow(tidied(run), ", ".join(f"{c} long" for c in named))


SKETCH = [f"s{i}" for i in range(8)]
LONG = 640  # shingles from which a set has a sketch of 4096 cells, too


def _sets(docs: DataFrame, width: int, votes: int) -> DataFrame:
    """``id, copy, fp, node, size`` and a sketch for every row; ``node`` names the set of shingles of ``width`` words.

    The fingerprint is of the set of shingles of ``votes`` words.
    """

    def run(batches):
        for batch in (p for b in batches for p in stretches(b, 1, TEXT_BYTES)):
            sets = shingle_sets(batch.column(1), width)
            fps = np.array([fingerprint(x) for x in shingle_sets(batch.column(1), votes)], np.uint64).view(np.int64)
            sketches = np.array([odd_sketch(x) for x in sets]).T
            made = [fps, np.array([_set_name(x) for x in sets], np.int64), np.array([len(x) for x in sets], np.int32), *sketches]
            made = [pa.array(np.ascontiguousarray(x)) for x in made]
            made.append(pa.array([odd_sketch(x, 12) if len(x) >= LONG else None for x in sets], pa.list_(pa.int64())))
            names = ["id", "copy", "fp", "node", "size", *SKETCH, "cells"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *made], names)

    schema = "id long, copy long, fp long, node long, size int, " + ", ".join(f"{x} long" for x in SKETCH) + ", cells array<long>"
    return docs.select("id", "text", _copy("id", "text")).mapInArrow(tidied(run), schema)


def _copy(id_col: str, text_col: str) -> Column:
    """What only rows that repeat both id and text share."""
    id, text = F.col(id_col).cast("long"), F.col(text_col)
    return F.xxhash64(id, text, id.isNull(), text.isNull()).alias("copy")


def grouped_bits(sample: np.ndarray, m: int) -> list[list[int]]:
    """64 bits in ``m`` groups of near-equal size; a bit joins the group it correlates with most."""
    bits = np.unpackbits(sample.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, ::-1].astype(np.float64)
    if len(bits) < 2:
        return [list(range(64))[i::m] for i in range(m)]
    bits -= bits.mean(axis=0)
    spread = np.sqrt((bits**2).mean(axis=0))
    together = np.abs((bits.T @ bits) / len(bits)) / np.maximum(np.outer(spread, spread), 1e-9)
    np.fill_diagonal(together, 0)
    room = [64 // m + (i < 64 % m) for i in range(m)]
    groups, free = [], set(range(64))
    for size in room:
        first = max(sorted(free), key=lambda b: together[b, sorted(free)].sum())
        group = [first]
        free.remove(first)
        while len(group) < size:
            best = max(sorted(free), key=lambda b: together[b, group].sum())
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def part_value(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bits of one partition, packed."""
    out = np.zeros(len(fps), np.uint64)
    for at, bit in enumerate(bits):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(at)
    return out


def ball(width: int, radius: int) -> np.ndarray:
    """Masks with at most ``radius`` of ``width`` bits set."""
    if radius < 0:
        return np.zeros(0, np.uint64)
    masks = [sum(1 << b for b in x) for r in range(radius + 1) for x in itertools.combinations(range(width), r)]
    return np.array(masks, np.uint64)


def allocated(own: np.ndarray, crowd: np.ndarray, widths: list[int], k: int) -> np.ndarray:
    """Thresholds per query and partition, of least expected cost, that sum to k - m + 1.

    ``own``: rows with the query's own value, per query and partition. ``crowd``:
    rows to be expected for another value, per partition. A candidate counts one,
    a probe ``PROBE``. ``cost[q, s]`` is the least cost of the partitions so far
    when their thresholds, each counted from -1, sum to ``s``.
    """
    n, m = own.shape
    need = k + 1  # the sum of (t_i + 1)
    cost = np.full((n, need + 1), np.inf)
    cost[:, 0] = 0
    chosen = np.zeros((m, n, need + 1), np.int8)
    for i in range(m):
        size = [0] + [len(ball(widths[i], t)) for t in range(k + 1)]
        step = np.full((n, need + 1), np.inf)
        for up in range(min(need, k + 1) + 1):
            price = np.zeros(n) if up == 0 else own[:, i] + size[up] * PROBE + (size[up] - 1) * crowd[i]
            for s in range(up, need + 1):
                total = cost[:, s - up] + price
                better = total < step[:, s]
                step[better, s] = total[better]
                chosen[i, better, s] = up
        cost = step
    out, left = np.zeros((n, m), np.int64), np.full(n, need)
    for i in range(m - 1, -1, -1):
        up = chosen[i, np.arange(n), left]
        out[:, i] = up.astype(np.int64) - 1
        left = left - up
    return out


def _partitions(sample: np.ndarray, n: int, k: int) -> list[list[int]]:
    """The groups of bits that cost least for the sample's fingerprints."""
    best = None
    for m in range(1, k + 2):
        groups = grouped_bits(sample, m)
        widths = [len(g) for g in groups]
        if sum(math.comb(max(widths), r) for r in range(-(-(k + 1) // m))) > 5000:
            continue
        crowd = np.array([n / 2.0**w for w in widths])
        own = np.ones((len(sample), m))
        for i, g in enumerate(groups):
            _, back, count = np.unique(part_value(sample, g), return_inverse=True, return_counts=True)
            own[:, i] = 1 + (count[back] - 1) * (n / max(len(sample), 1)) + crowd[i]
        chosen = allocated(own, crowd, widths, k)
        cost = PROBE * m
        for i in range(m):
            size = np.array([0] + [len(ball(widths[i], t)) for t in range(k + 1)])[chosen[:, i] + 1]
            cost += float(np.mean(size * PROBE + np.maximum(size - 1, 0) * crowd[i] + (size > 0) * own[:, i])) if len(sample) else 0
        if best is None or cost < best[0]:
            best = (cost, groups)
    return best[1]


def _grouped(nodes: DataFrame, n: int, k: int) -> list[list[int]]:
    kept = F.pmod(F.xxhash64("fp", F.lit(7)), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(n, 1)) * (1 << 30)) + 1
    sample = [r[0] for r in nodes.where(kept).select("fp").limit(SAMPLE).collect()]
    return _partitions(np.array(sample, np.int64).view(np.uint64), n, k)


def _index(nodes: DataFrame, groups) -> DataFrame:
    m = len(groups)

    def indexed(batches):
        for batch in batches:
            fps = np.asarray(batch.column(1))
            values = [part_value(fps.view(np.uint64), g).view(np.int64) for g in groups]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(m, dtype=np.int32), len(fps))),
                    pa.array(np.concatenate(values)),
                    pa.array(np.tile(np.asarray(batch.column(0)), m)),
                    pa.array(np.tile(fps, m)),
                ],
                ["part", "value", "node", "fp"],
            )

    return nodes.select("node", "fp").mapInArrow(tidied(indexed), "part int, value long, node long, fp long")


def _probes(counts: DataFrame, groups, n: int, k: int) -> DataFrame:
    m, widths = len(groups), [len(g) for g in groups]
    crowd = np.array([n / 2.0**w for w in widths])

    def probed(batches):
        balls = {}
        for batch in batches:
            node, fps = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            counted = np.column_stack([np.asarray(batch.column(2 + i)) for i in range(m)]).astype(np.float64)
            chosen = allocated(counted, crowd, widths, k)
            for i in range(m):
                values = part_value(fps.view(np.uint64), groups[i])
                for t in np.unique(chosen[:, i][chosen[:, i] >= 0]):
                    if (i, t) not in balls:
                        balls[i, t] = ball(widths[i], int(t))
                    masks, at = balls[i, t], np.flatnonzero(chosen[:, i] == t)
                    room = max(1, 500_000 // len(masks))
                    for s in range(0, len(at), room):
                        some = at[s : s + room]
                        probes = (values[some, None] ^ masks[None, :]).ravel()
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(probes), i, np.int32)),
                                pa.array(probes.view(np.int64)),
                                pa.array(np.repeat(node[some], len(masks))),
                                pa.array(np.repeat(fps[some], len(masks))),
                            ],
                            ["part", "value", "q", "q_fp"],
                        )

    return counts.mapInArrow(tidied(probed), "part int, value long, q long, q_fp long")


def linked(nodes: DataFrame, k: int) -> DataFrame:
    """``node, component`` for nodes (``node, fp``; ``node`` distinct) with a link of at most ``k`` bits.

    A crowded value is not paired out. First every probe meets only the smallest
    node under the value it probes, which joins a crowd of near copies through
    its hub. Then only values that still hold nodes of different components are
    searched, and only for pairs between components.
    """
    n = nodes.count()
    groups = _grouped(nodes, n, k)
    m = len(groups)

    index = cut(_index(nodes, groups), "simhash")
    values = index.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("node", "fp")).alias("hub"))
    values = cut(values, "simhash")
    counts = index.join(values, ["part", "value"]).groupBy("node", "fp")
    counts = counts.agg(*[F.max(F.when(F.col("part") == i, F.col("n"))).alias(f"n{i}") for i in range(m)])
    # A value under which nothing lies needs no row: the join with the values drops it.
    probes = cut(_probes(counts, groups, n, k).join(values.drop("n"), ["part", "value"]), "simhash")

    near = F.bit_count(F.col("q_fp").bitwiseXOR(F.col("hub.fp"))) <= k
    hubs = probes.where((F.col("q") != F.col("hub.node")) & near)
    hubs = cut(_pairs(hubs.select(F.col("q").alias("a"), F.col("hub.node").alias("b"))), "simhash")
    joined = cut(components(hubs), "simhash")

    def named(df, column):
        known = joined.select(F.col("node").alias(column), F.col("component").alias("c"))
        return df.join(known, column, "left").withColumn("c", F.coalesce("c", column))

    asked = named(probes.select("part", "value", "q", "q_fp"), "q").withColumnRenamed("c", "q_c")
    found = named(index, "node")
    # Searched on: values whose probes and entries are not all of one component.
    sides = asked.select("part", "value", F.col("q_c").alias("c")).unionByName(found.select("part", "value", "c"))
    mixed = sides.groupBy("part", "value").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi")
    mixed = cut(mixed.select("part", "value"), "simhash")
    asked = asked.join(mixed, ["part", "value"], "left_semi")
    found = found.join(mixed, ["part", "value"], "left_semi")
    met = asked.alias("p").join(
        found.alias("x"),
        (F.col("p.part") == F.col("x.part"))
        & (F.col("p.value") == F.col("x.value"))
        & (F.col("q_c") != F.col("c"))
        & (F.col("q") < F.col("node"))
        & (F.bit_count(F.col("q_fp").bitwiseXOR(F.col("fp"))) <= k),
    )
    rest = _pairs(met.select(F.col("q").alias("a"), F.col("node").alias("b")))
    stars = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(stars.unionByName(rest))


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


TEXT_BYTES = 4 << 20  # bytes of text taken out of a batch at a time


SLOTS = 1 << 26  # bits at most of the table of ids whose texts are asked for


def _asked(ids: DataFrame) -> tuple[int, np.ndarray]:
    """The number of slots, and a bit for each that an id of ``ids`` falls on."""
    slots = 1 << 15
    while slots < min(SLOTS, 16 * ids.count()):
        slots *= 2
    at = ids.select(_slot("id", slots).alias("slot"))
    found = at.groupBy(F.expr("slot div 32768").alias("block")).agg(F.expr("bitmap_construct_agg(slot % 32768)").alias("bits")).toArrow()
    bits = np.zeros((slots >> 15, 4096), np.uint8)
    for block, held in zip(found["block"].to_pylist(), found["bits"].to_pylist()):
        bits[block] = np.frombuffer(held, np.uint8)
    return slots, bits.ravel()


def _slot(column: str, slots: int):
    return F.pmod(F.xxhash64(column), F.lit(slots))


def _near(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sizes and sketches allow the similarity."""
    for end in "ab":
        own = nodes.select(F.col("node").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in ("size", *SKETCH, "cells")])
        pairs = pairs.join(own, end)
    cells = F.zip_with("a_cells", "b_cells", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.greatest(_differ(), F.aggregate(cells, F.lit(0), lambda x, y: x + y))  # which passes a null over
    sizes = F.least("a_size", "b_size") >= F.greatest("a_size", "b_size") * similarity - 1e-6
    return pairs.where(sizes & _few(differ, similarity)).select("a", "b")


def _differ():
    """Bits in which the smaller sketches of ``a_`` and ``b_`` differ."""
    return sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in SKETCH[1:]), F.bit_count(F.expr("a_s0 ^ b_s0")))


def _few(differ, similarity: float):
    """Whether sets that differ in so many shingles at least can have the similarity."""
    return differ * (1 + similarity) <= (F.col("a_size") + F.col("b_size")) * (1 - similarity) + 1e-6


def _alike(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, width: int, similarity: float) -> DataFrame:
    """Those of some pairs of nodes whose shingle sets have at least this Jaccard similarity."""
    pairs = cut(_near(pairs, nodes, similarity), "simhash")
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    slots, bits = _asked(nodes.join(ends, "node", "left_semi").select(F.col("least").alias("id")))
    asked = docs.sparkSession.sparkContext.broadcast(bits)

    def own(batches):
        for batch in batches:
            slot = np.asarray(batch.column(0))
            held = asked.value[slot >> 3] >> (slot & 7).astype(np.uint8) & 1
            for part in stretches(batch.filter(pa.array(held.astype(bool))), 1, TEXT_BYTES):
                sets = shingle_sets(part.column(1), width)
                made = [pa.array([_set_name(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(made, ["node", "shingles"])

    sets = docs.select(_slot("id", slots).alias("slot"), "text").mapInArrow(tidied(own), "node long, shingles binary")
    sets = cut(sets.join(ends, "node", "left_semi").dropDuplicates(["node"]), "simhash")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b")

    def alike(batches):
        for batch in batches:
            held = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                shared = len(np.intersect1d(a, b, assume_unique=True))
                held.append(shared >= similarity * (len(a) + len(b) - shared))
            yield batch.select([0, 1]).filter(pa.array(held, pa.bool_()))

    return both.select("a", "b", "of_a", "of_b").mapInArrow(tidied(alike), "a long, b long")


def _neighbours(nodes: DataFrame, k: int) -> DataFrame:
    """``a, b``: nodes next to each other under a value of a partition, in order of their fingerprints, within ``k`` bits."""
    index = _index(nodes, _grouped(nodes, nodes.count(), k))
    order = Window.partitionBy("part", "value").orderBy("fp", "node")
    index = index.select("node", "fp", F.lag("node").over(order).alias("next"), F.lag("fp").over(order).alias("next_fp"))
    index = index.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("next_fp"))) <= k)
    return index.select(F.col("node").alias("a"), F.col("next").alias("b"))


def _frequent(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several texts of a sample, in order of value, and how many texts have each."""
    n = docs.count()
    part = int(min(1.0, SAMPLE / max(n, 1)) * (1 << 30)) + 1
    kept = F.pmod(F.xxhash64("id", F.xxhash64("text"), F.lit(9)), F.lit(1 << 30)) < part

    def shingles(batches):
        for batch in batches:
            found = [x for part in stretches(batch, 0, TEXT_BYTES) for x in shingle_sets(part.column(0), width)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["key"])

    counts = docs.where(kept).select("text").mapInArrow(tidied(shingles), "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    most = counts.where("n > 2").orderBy(F.desc("n"), "key").limit(FREQUENT).toArrow()
    keys, seen = np.asarray(most["key"]).astype(np.int64).view(np.uint64), np.asarray(most["n"]).astype(np.int64)
    order = np.argsort(keys)
    return keys[order], seen[order]


def prefix(shingles: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first of some distinct shingles, rare ones first: as many as any similar set must share one of."""
    keys, seen = frequent
    n = np.zeros(len(shingles), np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
        n = np.where(keys[at] == shingles, seen[at], 0)
    size = len(shingles)
    return shingles[np.lexsort((shingles, n))][: size - math.ceil(similarity * size - 1e-9) + 1]


def _prefixes(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """``key, node, size, place, hub``: the prefixes' shingles that several nodes have; ``hub`` is one of those nodes."""
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs, width))

    def run(batches):
        for part in (p for batch in batches for p in stretches(batch, 0, TEXT_BYTES)):
            columns = [[], [], [], []]
            for shingles in shingle_sets(part.column(0), width):
                if not len(shingles):
                    continue
                first = prefix(shingles, frequent.value, similarity)
                columns[0].append(first.view(np.int64))
                columns[1].append(np.full(len(first), _set_name(shingles), np.int64))
                columns[2].append(np.full(len(first), len(shingles), np.int32))
                columns[3].append(np.arange(len(first), dtype=np.int32))
            if columns[0]:
                made = [pa.array(np.concatenate(x)) for x in columns]
                yield pa.RecordBatch.from_arrays(made, ["key", "node", "size", "place"])

    rows = docs.select("text").mapInArrow(tidied(run), "key long, node long, size int, place int")
    # Nearly all shingles are of one node only; one exchange drops them.
    whole = Window.partitionBy("key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("hub", F.min(F.struct("node", "size", "place")).over(whole)).withColumn("hi", F.max("node").over(whole))
    return rows.where("hub.node <> hi").drop("hi").distinct()


def _enough(a: str | Column, b: str | Column, similarity: float):
    """Whether two sets can have the similarity, if a shingle at these places is the first that they share.

    A side is a struct, or what its columns' names begin with.
    """
    (a_size, a_place), (b_size, b_place) = (
        [F.col(f"{x}{n}") if isinstance(x, str) else x[n] for n in ("size", "place")] for x in (a, b)
    )
    return F.least(a_size - a_place, b_size - b_place) * (1 + similarity) >= (a_size + b_size) * similarity - 1e-6


def _named(df: DataFrame, joined: DataFrame, column: str, c: str) -> DataFrame:
    """``df`` with the component of a node as ``c``."""
    known = joined.select(F.col("node").alias(column), F.col("component").alias(c))
    return df.join(known, column, "left").withColumn(c, F.coalesce(c, column))


def _mixed(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """The rows, with components ``c``, under shingles that nodes of several components have."""
    rows = cut(_named(rows.drop("hub"), joined, "node", "c"), "simhash")
    mixed = rows.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("key")
    return cut(rows.join(mixed, "key", "left_semi"), "simhash")


def _beside(rows: DataFrame, joined: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: nodes of different components near each other under a shingle, in an order drawn for each shingle.

    Crowds that link densely are joined by a few pairs of each node; no shingle gives more than ``NEXT`` pairs a row.
    """
    order = Window.partitionBy("key").orderBy(F.xxhash64("node", "key"), "node")
    near = F.array(*[F.lag(F.struct("node", "size", "place", "c"), n).over(order) for n in NEXT])
    apart = lambda x: (x["c"] != F.col("c")) & _enough("", x, similarity)
    met = _mixed(rows, joined).withColumn("near", near).select("node", F.explode(F.filter("near", apart)).alias("x"))
    return _pairs(met.select(F.col("node").alias("a"), F.col("x.node").alias("b")))


def _between(rows: DataFrame, nodes: DataFrame, joined: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: nodes of different components of ``joined`` with a shingle that allows the similarity in both prefixes.

    Their sketches allow it, too: what they rule out never leaves the join.
    """
    rows = cut(_mixed(rows, joined).join(nodes.select("node", *SKETCH), "node"), "simhash")
    names = ("node", "size", "place", "c", *SKETCH)
    x, y = (rows.select("key", *[F.col(n).alias(f"{side}_{n}") for n in names]) for side in "ab")
    # Of the pair's common shingles the first has all others behind it in both sets.
    apart = (F.col("a_node") < F.col("b_node")) & (F.col("a_c") != F.col("b_c"))
    met = x.join(y, "key").where(apart & _enough("a_", "b_", similarity) & _few(_differ(), similarity))
    return met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def _linked_sets(docs: DataFrame, nodes: DataFrame, width: int, similarity: float, k: int) -> DataFrame:
    """``node, component`` for nodes with a link of the similarity."""
    rows = cut(_prefixes(docs, width, similarity), "simhash")
    hubs = rows.where((F.col("node") != F.col("hub.node")) & _enough("", "hub.", similarity))
    hubs = hubs.select(F.col("node").alias("a"), F.col("hub.node").alias("b"))
    tried = cut(_pairs(hubs.unionByName(_neighbours(nodes, k))), "simhash")
    joined = cut(components(_alike(docs, nodes, tried, width, similarity)), "simhash")
    for step in (lambda: _beside(rows, joined, similarity), lambda: _between(rows, nodes, joined, similarity)):
        asked = cut(step().join(tried, ["a", "b"], "left_anti"), "simhash")
        stars = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
        joined = cut(components(stars.unionByName(_alike(docs, nodes, asked, width, similarity))), "simhash")
        tried = tried.unionByName(asked)
    return joined


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    k: int = 8,
    similarity: float | None = 0.8,
    votes: int = 2,
) -> DataFrame:
    """``id, fp, component`` for every row; ``component`` is the smallest id reachable by links.

    With ``similarity``, texts link when their sets of shingles of ``width`` words
    have at least that Jaccard similarity. Neighbours whose fingerprints, of sets of
    shingles of ``votes`` words, differ in at most ``k`` bits are tried first; the
    result does not depend on ``votes`` and ``k``. Without it, texts link when
    fingerprints of shingles of ``width`` words, repeats included, differ in at
    most ``k`` bits.
    """
    return _rooted(docs, id_col, text_col, width, k, similarity, votes).select("id", "fp", "component")


def _rooted(
    docs: DataFrame, id_col: str, text_col: str, width: int, k: int, similarity: float | None, votes: int, copies: bool = False
) -> DataFrame:
    """``near_groups`` with ``root``, which tells components without an id apart, too, and ``copy`` as in ``fingerprints``."""
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    as_sets = similarity is not None
    rows = cut(_sets(texts, width, votes) if as_sets else fingerprints(docs, id_col, text_col, width, copies), "simhash")
    of_node = [F.first(c).alias(c) for c in ("size", *SKETCH, "cells")] if as_sets else []
    nodes = cut(rows.groupBy("node", "fp").agg(F.min("id").alias("least"), *of_node), "simhash")
    joined = _linked_sets(texts, nodes, width, similarity, k) if as_sets else linked(nodes.select("node", "fp"), k)
    named = nodes.join(joined, "node", "left").withColumn("root", F.coalesce("component", "node"))
    named = cut(named.select("node", "root", "least"), "simhash")
    smallest = cut(named.groupBy("root").agg(F.min("least").alias("component")), "simhash")
    named = cut(named.join(smallest, "root").select("node", "root", "component"), "simhash")
    return rows.join(named, "node").select("id", *(["copy"] if copies else []), "fp", "root", "component")


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    k: int = 8,
    similarity: float | None = 0.8,
    votes: int = 2,
) -> DataFrame:
    """The rows that stay: of each group, one with the smallest id; without any id, one.

    An id that stays with one of its texts keeps the texts that fell into groups of
    smaller ids, too. Rows that repeat both id and text are one.
    """
    rows = _rooted(docs, id_col, text_col, width, k, similarity, votes, copies=True)
    rows = cut(rows.groupBy("id", "copy", "root", "component").agg(F.count(F.lit(1)).alias("n")), "simhash")
    own = F.col("id").eqNullSafe(F.col("component"))
    first = cut(rows.where(own).groupBy("root").agg(F.min("copy").alias("copy"), F.first("id").alias("stays")), "simhash")
    others = rows.join(first.select("copy"), "copy", "left_anti")
    ids = first.select(F.col("stays").alias("id")).where("id is not null").distinct()
    gone = others.where(own).unionByName(others.where(~own).join(ids, "id", "left_anti")).select(F.col("copy").alias("__copy"))
    kept = docs.withColumn("__copy", _copy(f"`{id_col}`", f"`{text_col}`")).join(gone, "__copy", "left_anti")
    if not rows.where("n > 1").isEmpty():
        nth = F.row_number().over(Window.partitionBy("__copy").orderBy("__copy"))
        kept = kept.withColumn("__nth", nth).where("__nth = 1")
    return kept.select([F.col(f"`{c}`") for c in docs.columns])
