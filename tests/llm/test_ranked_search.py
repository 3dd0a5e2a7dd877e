"""Block-Max MaxScore against scoring every document by every term."""

import math
import random
from collections import Counter

import pytest

from rfspark.llm import ranked_search as rs

DOCS = "doc_id bigint, text string, rank int, q string, ids int"


def brute(docs, queries, k):
    held = [(d, Counter(rs.terms_of(t))) for d, t in docs]
    n_docs = sum(1 for _, c in held if c)
    n_terms = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for q, text in queries:
        scored = []
        for d, c in held:
            s = 0
            for t in set(rs.terms_of(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 50 + 50 * sum(c.values()) * n_docs // n_terms
                    s += w * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        for place, (s, _, _, d) in enumerate(sorted(scored)[:k], 1):
            out.append((q, place, d, -s))
    return sorted(out, key=repr)


def words(rng, n):
    return " ".join(f"w{min(int(rng.paretovariate(0.6)), 400)}" for _ in range(n))


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(rs, "SHARD", 6000)
    monkeypatch.setattr(rs, "BLOCK", 8)


def run(spark, docs, queries, k):
    d = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], DOCS).repartition(3)
    q = spark.createDataFrame(queries, "item_id bigint, text string")
    return sorted((tuple(r) for r in rs.search(d, q, k).collect()), key=repr)


def test_equals_brute_force(spark, small):
    rng = random.Random(3)
    docs = [(i, words(rng, rng.choice([3, 20, 200]))) for i in range(900)]
    docs += [(1000 + i, "Tie, tie; broken by id") for i in range(40)] + [(None, "tie w1"), (7, None), (8, ""), (5, "w1 w1 w7")]
    docs += [(2000, words(rng, 30000)), (2001, "ÄÖ über\x00w3 Über")]
    queries = [(q, words(rng, rng.choice([1, 4, 30]))) for q in range(40)]
    queries += [(100, "TIE broken"), (101, None), (102, ""), (103, "nowhere"), (104, "über w3"), (105, "tie"), (105, "tie w1")]
    assert run(spark, docs, queries, 10) == brute(docs, queries, 10)


def test_blocks_of_queries_share_one_index(spark, small, monkeypatch):
    monkeypatch.setattr(rs, "QUERIES", 3)
    rng = random.Random(4)
    docs = [(i, words(rng, 25)) for i in range(200)]
    queries = [(q, words(rng, 5)) for q in range(8)]
    assert run(spark, docs, queries, 5) == brute(docs, queries, 5)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")], 5) == []
    assert run(spark, [(1, "a")], [], 5) == []
    assert run(spark, [(1, None)], [(1, "a")], 5) == []


def test_blocks_are_rejected_before_decompression(monkeypatch):
    import numpy as np

    # A weak list everywhere, a strong one in a few places: most weak blocks stay compressed.
    place = np.arange(4000)
    n = np.full(4000, 50)
    weak = rs.Posting(rs._list("weak", place, np.ones(4000, np.int64), n), 10, 4000, 200000)
    strong = rs.Posting(rs._list("strong", place[::500], np.full(8, 5), n), 5000, 4000, 200000)
    heap = [(strong.bound, 0)] * 3
    rs.rank([weak, strong], place, heap, 3, wave=256)
    assert max(heap)[0] > strong.bound and len(weak.read) <= 8 < len(weak.last)
