"""Exact dedup and SimHash against brute force, and on odd inputs."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from rfspark.llm import exact_dedup, graph, simhash
from rfspark.llm.common import ship

SCHEMA = "doc_id long, text string, length string, __row int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


ROWS = [
    (1, "Same text", "x", 0),
    (2, "same TEXT", "y", None),
    (3, "same texu", None, 1),
    (4, None, "z", 2),
    (5, "", "z", 2),
    (6, "É", "z", 2),
    (7, "é", "z", 2),
    (None, "same text", "n", 3),
    (2, "same TEXT", "y", None),
    (8, "long " * 50_000, "l", 4),
    (9, "LONG " * 50_000, "l", 4),
]


def test_exact_groups_equal_brute_force(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted((tuple(r) for r in exact_dedup.groups(docs, digest_all=True).collect()), key=repr)
    want = []
    for i, t, *_ in ROWS:
        same = [r[0] for r in ROWS if lower(r[1]) == lower(t)]
        keep = max((x for x in same if x is not None), default=None)
        want.append((i, len((t or "").encode()), keep, len(same), i == keep))
    assert sorted(((r[0], r[1], r[3], r[4], r[5]) for r in got), key=repr) == sorted(want, key=repr)


def test_exact_dedup_keeps_one_row_with_all_columns(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5, 6, 7, 9]
    assert exact_dedup.dedup(docs.limit(0)).count() == 0 and exact_dedup.groups(docs.limit(0)).count() == 0


def test_full_hash_only_where_it_was_needed(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    hashed = {r["id"] for r in exact_dedup.groups(docs).where("sha256 is not null").collect()}
    assert 3 not in hashed and {1, 2, 4, 5, 8, 9} <= hashed


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        lo, hi = sorted((find(a), find(b)))
        parent[hi] = lo
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    pairs = [p for p in pairs if p[0] != p[1]]
    want = roots(pairs, {x for p in pairs for x in p})
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text, width):
    words = lower(text).encode().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_is_the_plain_one():
    rng = random.Random(1)
    for text in ["", None, "one", "One two", "a b c", " x\x0by\tz\n"] + [" ".join(rng.choices("abcdef", k=9)) for _ in range(20)]:
        assert simhash.fingerprint(simhash.shingle_hashes(text, 3)) == plain_fingerprint(text, 3)


@pytest.mark.parametrize("k", [2, 5])
def test_linked_equals_brute_force_with_a_crowd(spark, k):
    rng = np.random.default_rng(k)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = set(rng.integers(0, 2**63, 150, dtype=np.uint64).tolist())
    for b in base.tolist():
        for _ in range(25):
            for bit in rng.choice(64, rng.integers(0, k + 2), replace=False).tolist():
                b ^= 1 << bit
            fps.add(b)
    # A crowd of near copies around one value.
    fps |= {7 ^ (1 << i) ^ (1 << j) for i, j in itertools.combinations(range(12), 2)}
    fps = sorted(np.array(list(fps), np.uint64).view(np.int64).tolist())
    nodes = spark.createDataFrame([(f, f) for f in fps], "node long, fp long")
    got = {r["node"]: r["component"] for r in simhash.linked(nodes, k).collect()}
    pairs = [(a, b) for a, b in itertools.combinations(fps, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= k]
    assert {f: got.get(f, f) for f in fps} == roots(pairs, fps)


@pytest.mark.parametrize("k,m", [(2, 2), (3, 5), (8, 3)])
def test_thresholds_satisfy_the_pigeonhole_and_are_cheapest(k, m):
    rng = np.random.default_rng(0)
    widths, own, crowd = [64 // m] * m, rng.integers(1, 5000, (20, m)).astype(float), rng.random(m)
    chosen = simhash.allocated(own, crowd, widths, k)
    assert (chosen.sum(axis=1) == k - m + 1).all() and chosen.min() >= -1

    def cost(q, t):
        size = [len(simhash.ball(w, x)) for w, x in zip(widths, t)]
        return sum(own[q, i] + s * simhash.PROBE + (s - 1) * crowd[i] for i, s in enumerate(size) if s)

    if k <= 3:
        for q in range(len(own)):
            options = (t for t in itertools.product(range(-1, k + 1), repeat=m) if sum(t) == k - m + 1)
            assert cost(q, chosen[q]) == pytest.approx(min(cost(q, t) for t in options))


def test_bits_are_all_grouped_once():
    sample = np.random.default_rng(1).integers(0, 2**63, 500, dtype=np.uint64)
    groups = simhash.grouped_bits(sample, 5)
    assert sorted(b for g in groups for b in g) == list(range(64))


def words(rng, n):
    return ["".join(rng.choices("abcdefghij", k=5)) for _ in range(n)]


def test_near_groups_by_similarity(spark):
    rng = random.Random(5)
    rows, base = [], words(rng, 300)
    for i in range(6):
        w = list(base)
        w[10 + i] = f"changed{i}"
        rows.append((i, " ".join(w)))
    rows += [(10, " ".join(words(rng, 300))), (11, " ".join(words(rng, 300)))]
    # Half of it is shared: below the similarity.
    rows.append((12, " ".join(base[:150] + words(rng, 150))))
    rows += [(20, None), (21, ""), (22, "one two"), (23, "One TWO"), (None, "one two"), (3, rows[3][1])]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, component string")
    got = {r["id"]: r["component"] for r in simhash.near_groups(docs).collect()}
    assert [got[i] for i in range(6)] == [0] * 6
    assert got[10] == 10 and got[11] == 11 and got[12] == 12
    assert got[20] == got[21] == 20 and got[22] == got[23] == got[None] == 22
    left = simhash.dedup(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 10, 11, 12, 20, 22]
    assert simhash.near_groups(docs.limit(0)).count() == 0


def test_an_id_with_two_texts_is_not_lost_with_one_of_them(spark):
    rng = random.Random(6)
    first, other = " ".join(words(rng, 60)), " ".join(words(rng, 60))
    docs = spark.createDataFrame([(1, first), (2, first), (2, other)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.dedup(docs).collect()) == [1, 2, 2]


def test_near_copies_without_an_id_or_with_one_id_are_dropped_too(spark):
    rng = random.Random(1)
    first, second, third = (words(rng, 80) for _ in range(3))
    changed = lambda w: " ".join([*w[:40], "changed", *w[41:]])
    rows = [(None, " ".join(first)), (None, changed(first)), (None, " ".join(first))]
    rows += [(7, " ".join(second)), (7, changed(second)), (9, " ".join(third)), (9, " ".join(third)), (None, changed(third))]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, `a.b` int")
    for how in ({}, {"similarity": None, "k": 2}):
        left = simhash.dedup(docs.where("doc_id = 9") if how else docs, **how)
        assert left.columns == docs.columns
        got = left.collect()
        assert sorted((r["doc_id"] or 0) for r in got) == ([9] if how else [0, 7, 9])
        assert all(tuple(r) in [(*x, i) for i, x in enumerate(rows)] for r in got)


def test_near_copies_with_added_and_removed_passages_are_all_found(spark):
    rng = random.Random(8)
    common, texts = words(rng, 40), []
    for similarity in (0.78, 0.801, 0.85, 0.9, 0.95):
        for i in range(40):
            base = common + words(rng, 260)
            more = int(296 * (1 / similarity - 1))
            if i % 2:
                other = base + words(rng, more)
            else:
                base, other = base + words(rng, more), base
            texts += [" ".join(base), " ".join(other)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["component"] for r in simhash.near_groups(docs).collect()}
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert len(pairs) >= 160 and got == roots(pairs, range(len(texts)))


def test_any_order_of_shingles_leaves_a_common_one_in_both_prefixes():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        both = rng.integers(0, 2**63, n, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**63, int(rng.integers(0, n // 8 + 2)), dtype=np.uint64)])) for _ in "ab")
        seen = np.unique(np.concatenate([both[::2], a[::3]]))
        frequent = (seen, rng.integers(3, 9, len(seen)))
        if len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)):
            firsts = (simhash.prefix(x, frequent, 0.8) for x in (a, b))
            assert len(np.intersect1d(*firsts))


def test_sets_of_a_batch_are_the_plain_ones():
    """Words are hashed once a batch; sets are equal, and as large, as those of whole shingles."""
    rng = random.Random(2)
    texts = ["", None, "one", "One two", "one two ", "two one", "a b c d e", "a b c d", " x\x0by\tz\n"]
    texts += [" ".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(200)]
    for width in (2, 5):
        plain = [frozenset(simhash.shingle_hashes(t, width).tolist()) for t in texts]
        sets = [frozenset(x.tolist()) for x in simhash.shingle_sets(pa.array(texts), width)]
        assert [len(x) for x in sets] == [len(x) for x in plain]
        assert all((sets[i] == sets[j]) == (plain[i] == plain[j]) for i, j in itertools.combinations(range(len(texts)), 2))


@pytest.mark.parametrize("power", [9, 12])
def test_sketches_differ_in_no_more_bits_than_sets_in_shingles(power):
    rng = np.random.default_rng(power)
    for _ in range(200):
        a, b = (rng.integers(0, 2**64, int(rng.integers(0, 900)), dtype=np.uint64) for _ in "ab")
        both = rng.integers(0, 2**64, 300, dtype=np.uint64)
        a, b = np.unique(np.append(a, both)), np.unique(np.append(b, both))
        differ = np.bitwise_count((simhash.odd_sketch(a, power) ^ simhash.odd_sketch(b, power)).view(np.uint64)).sum()
        assert differ <= len(np.setxor1d(a, b))


def test_a_crowd_is_not_paired_out_and_no_texts_but_the_asked_are_exchanged(spark, monkeypatch):
    """Near copies of one text meet one of them; texts like no other are not among those whose shingles are exchanged."""
    rng, tables = random.Random(9), {}
    base, rows = words(rng, 300), []
    for i in range(120):
        # Words far apart are changed, so that fingerprints differ; any two stay above the similarity.
        w = list(base)
        w[2 * i + 20], w[290 - i // 2] = f"changed{i}", f"other{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(words(rng, 900))) for i in range(60)]
    # Over the size from which sets have a finer sketch; a link at 0.81 and none at 0.78.
    long = words(rng, 2000)
    rows += [(2000, " ".join(long)), (2001, " ".join(long + words(rng, 460))), (2002, " ".join(words(rng, 560) + long))]
    real = simhash.cut

    def cut(df, purpose):
        out = real(df, purpose)
        tables.setdefault(",".join(df.columns), []).append(out.count())
        return out

    monkeypatch.setattr(simhash, "cut", cut)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: r["component"] for r in simhash.near_groups(docs).collect()}
    assert got == {i: 0 if i < 120 else 2000 if i == 2001 else i for i, _ in rows}
    # All pairs of the crowd are 7140.
    assert max(tables["a,b"]) < 1000 and max(tables["node,shingles"]) <= 123


def test_pairs_that_share_rare_shingles_but_little_else_stay_in_the_join(spark, monkeypatch):
    """Families with a phrase of their own among common sentences: the sketches tell them apart before a pair is listed."""
    rng = random.Random(8)
    sentence = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    common, texts = [sentence(8) for _ in range(30)], []
    for _ in range(8):
        phrase = sentence(7)
        texts += [" ".join([phrase, *rng.sample(common, 12)]) for _ in range(10)]
    for t in texts[::9]:  # and some that do link
        words = t.split()
        words[50] = "changed"
        texts.append(" ".join(words))
    listed, plain = [], simhash._between

    def counted(*given):
        pairs = plain(*given)
        listed.append(pairs.count())
        return pairs

    monkeypatch.setattr(simhash, "_between", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["component"] for r in simhash.near_groups(docs, width=5, similarity=0.8).collect()}
    sets = [set(simhash.shingle_sets(pa.array([t]), 5)[0].tolist()) for t in texts]
    want = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and want[i] != want[j]:
                lo, hi = sorted((want[i], want[j]))
                want = [lo if w == hi else w for w in want]
    assert got == dict(enumerate(want)) and len(set(want)) == 80
    assert len(listed) == 1 and listed[0] <= 20
