"""Ranked lexical search: Block-Max MaxScore over sharded inverted lists.

``build`` cuts the documents into shards of bounded bytes and writes one inverted
index per shard: per term, blocks of postings (compressed) beside what can be read
without decompressing them: each block's last place, its highest count and its
shortest document. ``search`` reads the shards and ranks every query in each of
them. A list's bound over all its blocks decides whether it is essential: lists
whose bounds together cannot lift a document over the worst of the best ``k`` are
not. Only essential lists propose documents; a document is dropped as soon as its
score so far plus the block maxima of the other lists at its place stays behind,
before those blocks are decompressed. Heaps of a task's shards are carried on, and
the tasks' heaps are merged by a partial maximum per query.

Scores are 64-bit integers: ``w * ((1000000000*tf) div (1000*tf + 20*m))`` with
``w = floor(1000*ln((2N+2)/(2df+1)))`` and ``m = 50 + (50*n*N) div L``. The factor
after ``w`` rises with ``tf`` and falls with ``m``, so a block's bound is the factor
of its highest count in its shortest document.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rfspark.llm.common import LOWER, UPPER, cut, ship, stretches

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWERING = str.maketrans(UPPER, LOWER)
SHARD = 8 << 20  # bytes of text in a shard
BLOCK = 128  # postings in a block
QUERIES = 2048  # queries ranked in one pass over the index
QUERY_BYTES = 8 << 20  # and their text
NO_ID = (1 << 63) - 1  # stands for a null id in a heap, so that it comes last among equals
HEAP = pa.schema([("q", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])

LISTS = (
    "array<struct<term:string,df:int,last:array<int>,max_tf:array<int>,min_n:array<int>,ends:array<int>,data:binary>>"
)
INDEX = f"shard string, ids array<bigint>, tokens bigint, filled bigint, lists {LISTS}"
ARROW_LISTS = pa.list_(
    pa.struct(
        [
            ("term", pa.string()),
            ("df", pa.int32()),
            ("last", pa.list_(pa.int32())),
            ("max_tf", pa.list_(pa.int32())),
            ("min_n", pa.list_(pa.int32())),
            ("ends", pa.list_(pa.int32())),
            ("data", pa.binary()),
        ]
    )
)


def terms_of(text: str | None) -> list[str]:
    """A text's terms in order, A-Z lower-cased; none for a null text."""
    return TERM.findall(text.translate(LOWERING)) if text else []


def build(docs: DataFrame, terms: set[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per shard: its documents' ids, token counts and inverted lists.

    A null or empty text has no terms; the same id on several rows is several
    documents, and so is a null id. ``terms`` limits the
    lists, never the counts, to the terms that will be asked for. An empty table
    gives no shard. Only the two named columns are read.
    """
    ship(docs.sparkSession)
    asked = None if terms is None else {t: k for k, t in enumerate(sorted(terms))}
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(lambda batches: _shards(batches, asked), INDEX)


def _shards(batches, asked):
    """Collect a task's documents into shards of about ``SHARD`` bytes."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    count, held, size = itertools.count(), [], 0
    for batch in batches:
        for piece in stretches(batch, 1, 1 << 20):
            coded = _coded(piece.column(0).to_pylist(), piece.column(1).to_pylist(), asked)
            held.append(coded)
            size += piece.nbytes
            if size >= SHARD:
                yield _shard(held, f"{part}-{next(count)}")
                held, size = [], 0
    if held:
        yield _shard(held, f"{part}-{next(count)}")


def _coded(ids, texts, asked):
    """Terms of some documents as distinct (document, term) pairs with counts, and the documents' lengths."""
    names: dict[str, int] = {} if asked is None else asked
    codes, lengths = [], []
    for text in texts:
        found = terms_of(text)
        lengths.append(len(found))
        if asked is None:
            codes.append(np.fromiter((names.setdefault(t, len(names)) for t in found), np.int64, len(found)))
        else:
            codes.append(np.fromiter((names.get(t, -1) for t in found), np.int64, len(found)))
    lengths = np.array(lengths, np.int64)
    code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    place = np.repeat(np.arange(len(texts)), lengths)
    known = code >= 0
    pair, tf = np.unique(place[known] * max(len(names), 1) + code[known], return_counts=True)
    return ids, lengths, pair // max(len(names), 1), pair % max(len(names), 1), tf, list(names)


def _shard(held, name):
    """One index row of the coded documents of a shard."""
    vocabulary: dict[str, int] = {}
    ids, places, codes, counts, lengths, base = [], [], [], [], [], 0
    for own, n, place, code, tf, names in held:
        used = np.unique(code)
        to = np.zeros(len(names) + 1, np.int64)
        to[used] = [vocabulary.setdefault(names[c], len(vocabulary)) for c in used.tolist()]
        ids += own
        lengths.append(n)
        places.append(place + base)
        codes.append(to[code])
        counts.append(tf)
        base += len(own)
    place, code, tf, n = (np.concatenate(x) for x in (places, codes, counts, lengths))
    order = np.lexsort((place, code))
    place, code, tf = place[order], code[order], tf[order]
    starts = np.searchsorted(code, np.arange(len(vocabulary) + 1))
    lists = [
        _list(term, place[starts[c] : starts[c + 1]], tf[starts[c] : starts[c + 1]], n) for term, c in vocabulary.items()
    ]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name]),
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([int(n.sum())], pa.int64()),
            pa.array([int((n > 0).sum())], pa.int64()),
            pa.array([lists], pa.list_(ARROW_LISTS.value_type)),
        ],
        ["shard", "ids", "tokens", "filled", "lists"],
    )


def _list(term, place, tf, n):
    """A term's postings (place, count, document length) in compressed blocks with their maxima beside them."""
    first = np.arange(0, len(place), BLOCK)
    own = n[place]
    data, ends, size = [], [], 0
    for lo in first.tolist():
        block = np.concatenate([place[lo : lo + BLOCK], tf[lo : lo + BLOCK], own[lo : lo + BLOCK]]).astype("<i4")
        data.append(zlib.compress(block.tobytes(), 1))
        size += len(data[-1])
        ends.append(size)
    return {
        "term": term,
        "df": len(place),
        "last": place[np.minimum(first + BLOCK, len(place)) - 1].tolist(),
        "max_tf": np.maximum.reduceat(tf, first).tolist(),
        "min_n": np.minimum.reduceat(own, first).tolist(),
        "ends": ends,
        "data": b"".join(data),
    }


class Posting:
    """One term's list in a shard; blocks are decompressed when first asked for."""

    def __init__(self, row, w, total_docs, total_terms):
        self.w, self.n_docs, self.n_terms = w, total_docs, total_terms
        self.last = np.asarray(row["last"], np.int64)
        self.ends, self.data, self.read = row["ends"], row["data"], {}
        self.bounds = w * factor(np.asarray(row["max_tf"], np.int64), np.asarray(row["min_n"], np.int64), total_docs, total_terms)
        self.bound = int(self.bounds.max())

    def block(self, k: int):
        """Places and scores of the postings of block ``k``."""
        if k not in self.read:
            raw = zlib.decompress(self.data[self.ends[k - 1] if k else 0 : self.ends[k]])
            place, tf, n = np.frombuffer(raw, "<i4").astype(np.int64).reshape(3, -1)
            self.read[k] = place, self.w * factor(tf, n, self.n_docs, self.n_terms)
        return self.read[k]

    def maxima(self, places: np.ndarray) -> np.ndarray:
        """The block maxima at some places, known without decompressing; 0 behind the last posting."""
        at = np.searchsorted(self.last, places)
        return np.where(at < len(self.last), self.bounds[np.minimum(at, len(self.last) - 1)], 0)

    def scores(self, places: np.ndarray) -> np.ndarray:
        """The list's scores at ascending places, 0 where it has no posting; only blocks hit are decompressed."""
        out = np.zeros(len(places), np.int64)
        at = np.searchsorted(self.last, places)
        for k in np.unique(at[at < len(self.last)]).tolist():
            lo, hi = np.searchsorted(at, [k, k + 1])
            own, score = self.block(k)
            spot = np.minimum(np.searchsorted(own, places[lo:hi]), len(own) - 1)
            out[lo:hi] = np.where(own[spot] == places[lo:hi], score[spot], 0)
        return out


def factor(tf: np.ndarray, n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    """``(1000000000*tf) div (1000*tf + 20*m)`` in 64-bit integers."""
    if int(n.max(initial=0)) * total_docs < 1 << 56:
        m = 50 + (50 * n * total_docs) // total_terms
    else:  # beyond 64 bits the one product is taken in whole numbers of any size
        m = np.array([50 + 50 * int(x) * total_docs // total_terms for x in n], np.int64)
    return (1000000000 * tf) // (1000 * tf + 20 * m)


def rank(lists: list[Posting], ids: np.ndarray, heap: list, k: int, wave: int = 4096) -> None:
    """Add a shard's best documents for one query to ``heap`` (``(score, -id)``, worst first, ``k`` at most).

    ``ids`` are the shard's ids, with which ties are decided: of equal scores the
    smaller id wins, so a document that can only reach the worst score is still
    looked at.
    """
    lists = sorted(lists, key=lambda p: p.bound)
    reach = np.cumsum([p.bound for p in lists])  # what lists 0..j can give together
    lo = 0
    while lo < len(ids):
        floor = heap[0][0] if len(heap) == k else 1
        # The first list with which the floor can be met begins the essential ones.
        first = int(np.searchsorted(reach, floor))
        if first == len(lists):
            return
        essential, rest = lists[first:], lists[:first]
        hi = min(lo + wave, len(ids))
        own = [_between(p, lo, hi) for p in essential]
        places = np.unique(np.concatenate([x for x, _ in own]))
        score = np.zeros(len(places), np.int64)
        for x, s in own:
            score[np.searchsorted(places, x)] += s
        for j in range(first - 1, -1, -1):
            p = rest[j]
            below = int(reach[j - 1]) if j else 0
            # All other lists by their block maxima first, then this one by its own.
            alive = score + reach[j] >= floor
            places, score = places[alive], score[alive]
            alive = score + p.maxima(places) + below >= floor
            if j:
                ahead = sum(q.maxima(places) for q in rest[: j + 1])
                alive &= score + ahead >= floor
            places, score = places[alive], score[alive]
            if not len(places):
                break
            score = score + p.scores(places)
        best = score >= floor
        places, score = places[best], score[best]
        if len(score) > k:
            worst = np.partition(score, len(score) - k)[len(score) - k]
            places, score = places[score >= worst], score[score >= worst]
        for at, s in zip(ids[places].tolist(), score.tolist()):
            item = (s, -at)
            if len(heap) < k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)
        lo = hi


def _between(p: Posting, lo: int, hi: int):
    """Places from ``lo`` up to ``hi`` of an essential list, with their scores."""
    a, b = np.searchsorted(p.last, [lo, hi - 1])
    blocks = [p.block(k) for k in range(a, min(b, len(p.last) - 1) + 1)]
    if not blocks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.concatenate([x for x, _ in blocks])
    score = np.concatenate([s for _, s in blocks])
    kept = (place >= lo) & (place < hi)
    return place[kept], score[kept]


def weights(index: DataFrame, terms: set[str]) -> tuple[int, int, dict[str, int]]:
    """Documents with a term, all terms, and the weight of each asked term that a document holds."""
    n_docs, n_terms = index.agg(F.sum("filled"), F.sum("tokens")).first()
    if not n_docs:
        return 0, 0, {}
    asked = index.sparkSession.createDataFrame([(t,) for t in sorted(terms)], "term string")
    held = (
        index.select(F.explode(F.arrays_zip("lists.term", "lists.df")).alias("x"))
        .groupBy(F.col("x.term").alias("term"))
        .agg(F.sum(F.col("x.df").cast("bigint")).alias("df"))
        .join(asked, "term", "left_semi")
    )
    found = {
        r["term"]: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1))) for r in held.toLocalIterator()
    }
    return int(n_docs), int(n_terms), found


def search(docs: DataFrame, queries: DataFrame, k: int = 50, query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """``query, rank, id, score``: each query's ``k`` best documents with a score above 0.

    Queries are taken in blocks of bounded number and bytes; each block is one pass over
    the written index. Equal scores are ranked by ascending id, a null id last; repeated
    ids each take a place. A query without terms, or whose terms no document holds,
    has no row; a repeated query id is one query per row. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = queries.select(F.col(f"`{query_id}`").alias("query"), F.col(f"`{query_text}`").alias("text"))
    blocks, out = _blocks(rows), None
    index = None
    for block in blocks:
        terms = {t for _, own in block for t in own}
        if index is None and len(block) < QUERIES:
            index = cut(build(docs, terms), "ranked")  # the only block: its terms are all that is asked
        elif index is None:
            index = cut(build(docs), "ranked")
        part = cut(_ranked(spark, index, block, terms, k), "ranked")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "query bigint, rank int, id bigint, score bigint")
    return out


def _blocks(rows: DataFrame):
    """The queries as (id, distinct terms), in blocks of bounded number and bytes."""
    block, size = [], 0
    for row in rows.toLocalIterator():
        own = sorted(set(terms_of(row["text"])))
        if own:
            block.append((row["query"], own))
            size += sum(map(len, own))
        if len(block) == QUERIES or size > QUERY_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _ranked(spark: SparkSession, index: DataFrame, block, terms, k: int) -> DataFrame:
    """One block of queries ranked over all shards."""
    n_docs, n_terms, weight = weights(index, terms)
    asked = [(q, [t for t in own if weight.get(t)]) for q, own in block]
    sent = spark.sparkContext.broadcast((n_docs, n_terms, weight, [own for _, own in asked]))

    def best(batches):
        total, size, w, terms = sent.value
        heaps = defaultdict(list)
        for batch in batches:
            for shard in range(batch.num_rows):
                ids = batch.column("ids")[shard].values.fill_null(NO_ID).to_numpy()
                lists = batch.column("lists")[shard].values
                wanted = [k for k, t in enumerate(lists.field("term").to_pylist()) if w.get(t)]
                rows = lists.take(pa.array(wanted, pa.int64())).to_pylist()
                known = {r["term"]: Posting(r, w[r["term"]], total, size) for r in rows}
                for q, own in enumerate(terms):
                    found = [known[t] for t in own if t in known]
                    if found:
                        rank(found, ids, heaps[q], k)
        flat = [(q, s, None if -i == NO_ID else -i) for q, heap in heaps.items() for s, i in heap]
        yield pa.RecordBatch.from_pylist([dict(zip(HEAP.names, x)) for x in flat], schema=HEAP)

    heaps = index.select("ids", "lists").mapInArrow(best, "q int, score bigint, id bigint")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    names = spark.createDataFrame([(n, q) for n, (q, _) in enumerate(asked)], "q int, query bigint")
    merged = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return merged.join(names, "q").select("query", "rank", "id", "score")
