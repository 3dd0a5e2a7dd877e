"""Merged transforms against looking up every string of every text."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rfspark.llm import bwt_dedup as bd


def brute(texts, length):
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(10, 60)) for _ in range(6)]
    texts = [prose(rng.randint(0, 80)) for _ in range(60)]
    for _ in range(120):
        parts = [prose(rng.randint(0, 20)), rng.choice(passages), prose(rng.randint(0, 20))]
        texts.append(" ".join(parts))
    for t in rng.sample(texts, 30):  # near copies
        at = rng.randint(0, len(t))
        texts.append(t[:at] + rng.choice(["", "X", " zz "]) + t[at:])
    texts += [texts[70]] * 20 + [None, "", "a" * 300, "ab" * 200, "é" * 90, passages[0], passages[1][:39], "a" * 39]
    texts.append(" ".join(prose(300) + rng.choice(passages) for _ in range(8)))  # a very long one
    return texts


def check(spark, texts, length, ids=None):
    ids = ids or list(range(len(texts)))
    df = spark.createDataFrame(list(zip(ids, texts, ["x"] * len(ids), [1] * len(ids))), "doc_id bigint, text string, body string, n int")
    rows = bd.remove(df.repartition(5), length).collect()
    got = sorted((tuple(r) for r in rows), key=repr)
    assert got == sorted(((i, *b) for i, b in zip(ids, brute(texts, length))), key=repr)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(bd, "PIECE", 700)
    monkeypatch.setattr(bd, "CHUNK", 4000)
    monkeypatch.setattr(bd, "SHARD", 600)


def test_equals_brute_force(spark, small):
    texts = corpus(random.Random(1))
    ids = [i if i % 7 else None for i in range(len(texts))]
    ids[20:24] = [5, 5, 5, 5]
    check(spark, texts, 40, ids)


def test_crowded_grams(spark, small, monkeypatch):
    monkeypatch.setattr(bd, "CROWD", 2)
    check(spark, corpus(random.Random(2)), 40)


def test_empty_table_and_nothing_repeated(spark):
    check(spark, [], 40)
    check(spark, ["one text of its own that is long enough to hold a string of forty bytes", None, ""], 40)


def test_merge_orders_like_sorting_the_union():
    rng = random.Random(3)
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(16, 60))) for _ in range(30)]
    for shard in (20, 200, 10**6):
        bd.SHARD, kept = shard, bd.SHARD
        try:
            owner, start = bd.repeated_starts(parts, np.ones(30, np.int64), 16)
        finally:
            bd.SHARD = kept
        seen = Counter(p[i : i + 16] for p in parts for i in range(len(p) - 15))
        want = [(k, i) for k, p in enumerate(parts) for i in range(len(p) - 15) if seen[p[i : i + 16]] > 1]
        assert list(zip(owner.tolist(), start.tolist())) == want


def test_transform_and_interleave():
    # Two shards of one string each: the interleave is the order of the union's suffixes by two symbols.
    a, b = np.array([1, 2, 1, 2, 0]), np.array([2, 1, 2, 1, 0])

    def shard(code):
        n = len(code)
        left = np.arange(n - 1, -1, -1)
        before = np.concatenate([[0], code[:-1]])
        return bd.transform(code, left, before, 1)

    (oa, ta), (ob, tb) = shard(a), shard(b)
    shards, block = bd.merge([ta, tb], np.array([1, 1]), 2)
    suffixes = [(tuple(c[i : i + 2]), s) for s, c in ((0, a), (1, b)) for i in range(5)]
    want = sorted((tuple(x for x in k if x), s) for k, s in suffixes)
    assert shards.tolist() == [s for _, s in want]
    assert [block[i] == block[i - 1] for i in range(1, 10)] == [want[i][0] == want[i - 1][0] for i in range(1, 10)]
