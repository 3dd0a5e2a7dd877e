import numpy as np
import pytest
from pyspark.sql import functions as F

from rfspark.operators import blocks as bl, spectral as sp, transmit
from rfspark.operators.quantile import quantile
from rfspark.operators.scan import ordered_scan, salted_join, total


def test_quantile_is_exact(spark):
    rng = np.random.default_rng(4)
    v = np.round(rng.normal(size=5000), 2)
    df = spark.createDataFrame([(int(k % 7 == 0), float(x)) for k, x in enumerate(v)], "g int, v double")
    for q in (0.0, 0.1, 0.5, 0.93, 1.0):
        got = {r.g: r.quantile for r in quantile(df, "g", "v", q, 0.25).collect()}
        for g in (0, 1):
            assert got[g] == pytest.approx(np.percentile(v[[(k % 7 == 0) == bool(g) for k in range(5000)]], 100 * q))


def test_salted_join_keeps_every_row_once(spark):
    big = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    assert salted_join(big, small, "k").count() == 667
    assert salted_join(big, small, "k", "left").filter("name is null").count() == 333


def test_bursts_follow_the_recurrence(spark):
    rng = np.random.default_rng(6)
    rows = [(int(k % 2), k, float(rng.integers(0, 500)), float(rng.integers(1, 9)), 0.5) for k in range(400)]
    out = transmit.schedule_bursts(spark.createDataFrame(rows, "stream_id long, seq long, desired double, duration double, guard double"), 37)
    got = {r.seq: r.start for r in out.collect()}
    free = {}
    for s, k, desired, duration, guard in rows:
        start = max(desired, free.get(s, float("-inf")))
        assert got[k] == pytest.approx(start)
        free[s] = start + duration + guard


def test_lag_search_finds_the_shift(spark):
    rng = np.random.default_rng(7)
    a = rng.normal(size=(2, 200))
    b = np.roll(a, 5, axis=1)
    row = [(1, a[0].tolist(), a[1].tolist(), b[0].tolist(), b[1].tolist())]
    pairs = spark.createDataFrame(row, "pair long, ai array<double>, aq array<double>, bi array<double>, bq array<double>")
    assert bl.best_lag(bl.correlate(pairs, 20)).first().lag == 5


def test_blocks_end_with_their_run(spark):
    rows = [(1, 0, 0, k, 30 * k, 30) for k in range(5)] + [(1, 1, 150, 5, 150, 10)]
    df = spark.createDataFrame(rows, "stream_id long, epoch_id long, epoch_first long, seq long, first_sample long, n int").withColumns(
        {"i": F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda k: (k + F.col("first_sample")).cast("float")), "q": F.array_repeat(F.lit(0.0).cast("float"), F.col("n"))}
    )
    out = bl.reblock(df, 64).orderBy("first_sample").collect()
    assert [(r.first_sample, r.n) for r in out] == [(0, 64), (64, 64), (128, 22), (150, 10)]
    assert [x for r in out for x in r.i] == [float(k) for k in range(160)]


def test_carrier_and_mirrored_spectrum(spark):
    rate, n, offset = 3.84e6, 4096, 300e3
    t = np.arange(n * 10) / rate
    rng = np.random.default_rng(8)
    x = 0.5 * np.exp(2j * np.pi * offset * t) + 1e-3 * (rng.normal(size=t.size) + 1j * rng.normal(size=t.size))
    rows = [(1, k * n, n, x[k * n : (k + 1) * n].real.tolist(), x[k * n : (k + 1) * n].imag.tolist(), n * 10) for k in range(10)]
    df = spark.createDataFrame(rows, "stream_id long, first_sample long, n int, i array<float>, q array<float>, run_end long")
    segs = sp.segments_of(df, n)
    assert segs.count() == 9
    psd = sp.mean_psd(segs, n).withColumn("hz", bl.fft_bin_hz(F.col("bin"), n, F.lit(rate), F.lit(0.0)))
    c = sp.find_carrier(psd, offset).first()
    assert abs(c.carrier_hz - offset) < rate / n and c.snr_db > 10
    floor = sp.noise_floor(segs, n).orderBy("bin").collect()
    win = np.hanning(n)
    power = [np.abs(np.fft.fftshift(np.fft.fft(x[k * n : (k + 1) * n].astype(np.complex64) * win))) ** 2 for k in range(9)]
    want = 10 * np.log10(np.percentile(power, 10, axis=0) + 1e-30)
    np.testing.assert_allclose([r.psd_db for r in floor], want, atol=1e-6)


def test_filter_does_not_see_block_borders(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=640)
    df = spark.createDataFrame([(1, k, 64 * k, x[64 * k : 64 * k + 64].tolist()) for k in range(10)], "stream_id long, seq long, first_sample long, x array<double>")
    out = sp.decimate(df, 5, block=3).orderBy("seq").collect()
    want = np.convolve(x, sp.low_pass(5))[:640][::5]
    np.testing.assert_allclose(np.concatenate([r.y for r in out]), want, atol=1e-12)


def test_a_hot_key_is_spread(spark):
    """A third of all rows under one key still go to many tasks."""
    df = spark.range(60000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("stream_id"), F.col("id").alias("seq"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = ordered_scan(df, "stream_id", "seq", {"n": total(F.lit(1))}, 1000)
        placed = out.select("n", F.spark_partition_id().alias("p"))
        sizes = placed.groupBy("p").agg(F.count("*").alias("rows"), F.max("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(sizes) == 16 and max(r.rows for r in sizes) < 60000 / 16 * 2.5
