"""Block-matrix whitening against numpy on the whole matrix."""

import numpy as np

from rfspark.llm import whitening as wh

SCHEMA = "vec_id bigint, embedding array<float>, at int, n int"


def frame(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in vectors], schema).repartition(3)


def brute(vectors):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1000000
    n, s = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    c = x - s / n
    value, vector = np.linalg.eigh(c.T @ c / n)
    return n, deviation, c, value[::-1], vector[:, ::-1]


def test_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(wh, "BLOCK_ROWS", 64)  # many blocks
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(700, 12)) * np.linspace(3, 0.5, 12)).astype(np.float32).tolist()
    bad = [(9000, None), (9001, [None] + [0.0] * 11), (9002, [float("nan")] * 12), (9003, [float("inf")] * 12), (9004, [1.0]), (9005, [])]
    rows = wh.whiten(frame(spark, list(enumerate(vectors)) + bad), components=8).collect()
    n, deviation, c, value, vector = brute(vectors)
    assert len(rows) == n * 8 and {r["n"] for r in rows} == {n}
    got = np.zeros((n, 8))
    for r in rows:
        got[r["id"], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviation[r["id"]]
        assert abs(r["explained"] - value[r["component"] - 1] / value.sum()) < 1e-9
    want = c @ vector[:, :8] / np.sqrt(value[:8])
    assert np.abs(got - want * np.sign((got * want).sum(axis=0))).max() < 1e-8
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and rows[0]["identity_error"] < 1e-9


def test_ranks_ties_and_repeats(spark):
    rows = wh.whiten(frame(spark, [(1, [1.0, 2.0, 5.0]), (1, [2.0, 4.0, 5.0]), (None, [3.0, 6.0, 5.0]), (2, [3.0, 6.0, 5.0])])).collect()
    assert len(rows) == 12 and {r["component"] for r in rows} == {1, 2, 3}
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in rows)
    assert {round(r["explained"], 12) for r in rows} == {0.0, 1.0} and rows[0]["identity_error"] < 1e-12


def test_nothing_varies_or_nothing_there(spark):
    one = wh.whiten(frame(spark, [(1, [0.5, 0.25])])).collect()
    assert [tuple(r) for r in one] == [(1, 1, 1, 0, None, None, None), (1, 2, 1, 0, None, None, None)]
    assert wh.whiten(frame(spark, [])).collect() == [] and wh.whiten(frame(spark, [(1, None)])).collect() == []


def test_deviation_beyond_a_long_is_null(spark):
    rows = wh.whiten(frame(spark, [(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [0.0, 2.0])])).collect()
    x = {1: (64 * 10**9, 0), 2: (-64 * 10**9, 64), 3: (0, 128)}
    s = [sum(v[k] for v in x.values()) for k in (0, 1)]
    for r in rows:
        want = sum((3 * a - b) ** 2 for a, b in zip(x[r["id"]], s))
        assert r["deviation"] == (want if want < 1 << 63 else None)
