import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rfspark.operators import continuity as ct, kernels

SCHEMA = (
    "stream_id long, connection_id long, seq long, payload string, start_time double, end_time double, "
    "samples long, center_hz double, rate_hz double"
)


def stream(rows, spark, stream_id=1):
    """Rows of (start, end, samples, rate[, payload, center, connection])."""
    full = []
    for k, r in enumerate(rows):
        start, end, samples, rate, payload, center, conn = (*r, *("iq", 1e9, 0)[len(r) - 4 :])
        full.append((stream_id, conn, k, payload, float(start), float(end), samples, float(center), float(rate)))
    return spark.createDataFrame(full, SCHEMA)


def classes(df):
    return [r.gap_class for r in df.orderBy("stream_id", "seq").collect()]


def breaks(df, spark, cap=1e-3):
    rows = ct.classify_gaps_adaptive(df, cap_s=cap)
    log = ct.break_log(ct.with_epochs(ct.mark_retunes(rows)))
    return [(r.at_sample, r.kind) for r in log.orderBy("at_sample", "place").collect()]


def test_fixed_tolerance_drop(spark):
    df = stream([(100.0, 100.001, 16, 1e6), (100.1, 100.101, 16, 1e6)], spark)
    rows = ct.classify_gaps(df, tolerance=1e-3).orderBy("seq").collect()
    assert [r.gap_class for r in rows] == ["first", "drop"]
    assert rows[1].gap == pytest.approx(0.099)


def paced(n, samples=16384, rate=61.44e6, t0=1783032873.0, skip=()):
    step = samples / rate
    return [(round(t0 + k * step, 6), round(t0 + (k + 1) * step, 6), samples, rate) for k in range(n) if k not in skip]


def test_one_lost_packet_shows(spark):
    rows = ct.classify_gaps_adaptive(stream(paced(10, skip=(8,)), spark)).orderBy("seq").collect()
    drops = [r for r in rows if r.gap_class == "drop"]
    assert len(drops) == 1 and drops[0].gap == pytest.approx(266.7e-6, abs=2e-6)


@pytest.mark.parametrize("samples", [1024, 16384, 65536])
def test_rounded_times_raise_no_drop(spark, samples):
    done = ct.with_jitter(ct.classify_gaps_adaptive(stream(paced(20000, samples), spark), block=4096), block=4096)
    assert done.filter("gap_class in ('drop', 'backward')").count() == 0
    assert done.agg(F.max("jitter")).first()[0] <= 1.5e-6


def test_jitter_calibrates_the_tolerance(spark):
    step = 16384 / 61.44e6
    calm = [(100 + k * step, 100 + (k + 1) * step, 16384, 61.44e6) for k in range(20)]
    gap = calm[-1][1] + 150e-6
    assert classes(ct.classify_gaps_adaptive(stream([*calm, (gap, gap + step, 16384, 61.44e6)], spark)))[-1] == "drop"
    t, shaky = 100.0, []
    for k in range(100):
        start = t + (50e-6 if k % 2 else -50e-6)
        shaky.append((start, start + step, 16384, 61.44e6))
        t += step
    end = shaky[-1][1]
    assert classes(ct.classify_gaps_adaptive(stream([*shaky, (end + 150e-6, end + 150e-6 + step, 16384, 61.44e6)], spark)))[-1] == "continuous"
    lost = end + step
    assert classes(ct.classify_gaps_adaptive(stream([*shaky, (lost, lost + step, 16384, 61.44e6)], spark)))[-1] == "drop"


def test_cap_for_long_packets(spark):
    step = 16.384e-3
    for extra, kind in ((0.9e-3, "continuous"), (1.1e-3, "drop")):
        start = 100 + step + extra
        df = stream([(100, 100 + step, 16384, 1e6), (start, start + step, 16384, 1e6)], spark)
        assert classes(ct.classify_gaps_adaptive(df))[1] == kind


def test_step_back(spark):
    step = 16384 / 61.44e6
    rows = [(100 + k * step, 100 + (k + 1) * step, 16384, 61.44e6) for k in range(5)]
    back = rows[-1][1] - step - 150e-6
    done = ct.with_jitter(ct.classify_gaps_adaptive(stream([*rows, (back, back + step, 16384, 61.44e6)], spark)))
    out = done.orderBy("seq").collect()
    assert out[-1].gap_class == "backward" and out[-1].jitter == pytest.approx(out[-2].jitter)
    assert ct.gap_stats(done).first().drops == 0


def end_to_end(n, rate, t0=100.0, gap=0.0, payloads=None):
    step, t, out = 16 / rate, t0, []
    for k in range(n):
        out.append((t, t + step, 16, rate, payloads[k] if payloads else "iq"))
        t += step + gap
    return out


def test_retune_is_marked_at_its_sample(spark):
    first = end_to_end(1, 15.36e6)
    second = end_to_end(1, 7.68e6, first[-1][1])
    assert breaks(stream(first + second, spark), spark) == [(0, "initial"), (16, "retune")]


def test_creeping_rate_is_seen_against_the_announced_one(spark):
    t, rows = 100.0, []
    for rate in (15.36e6, 14.6e6, 13.9e6, 13.2e6):
        rows.append((t, t + 16 / rate, 16, rate))
        t += 16 / rate
    marks = [r.geometry_change for r in ct.detect_retunes(stream(rows, spark)).orderBy("seq").collect()]
    assert marks == ["initial", None, None, "retune"]


def test_gaps_between_packets(spark):
    assert breaks(stream(end_to_end(3, 15.36e6, gap=0.01), spark), spark) == [(0, "initial"), (16, "gap"), (32, "gap")]


def test_undecodable_iq_is_a_gap_where_it_sat(spark):
    df = stream(end_to_end(3, 15.36e6, payloads=["iq", "lost", "iq"]), spark)
    assert breaks(df, spark) == [(0, "initial"), (16, "gap")]
    assert ct.gap_stats(ct.classify_gaps(df)).first().drops == 0
    assert ct.stream_accounting(df).first().lost_to_parse_errors == 1


def test_skipped_spectra_leave_no_gap(spark):
    rows = end_to_end(2, 15.36e6)
    df = stream([rows[0], (*rows[0][:4], "spectra"), rows[1]], spark)
    assert breaks(df, spark) == [(0, "initial")]


def test_mixed_mission(spark):
    iq = end_to_end(3, 15.36e6)
    mixed = [iq[0], (*iq[0][:4], "spectra"), iq[1], (*iq[1][:4], "spectra"), iq[2]]
    a = ct.stream_accounting(stream(mixed, spark)).first()
    assert (a.iq_samples, a.non_iq_skipped, a.lost_to_parse_errors) == (48, 2, 0)


def test_new_connection_is_a_gap(spark):
    rows = end_to_end(2, 15.36e6)
    df = stream([(*rows[0], 1e9, 0), (*rows[1], 1e9, 1)], spark)
    assert breaks(df, spark) == [(0, "initial"), (16, "gap")]


def noisy(seed, n, streams=3):
    """Random packets: one stream has two thirds of them; gaps sit around the open range."""
    rng, rows, t = random.Random(seed), [], {s: 1000.0 for s in range(streams)}
    for seq in range(n):
        s = 0 if rng.random() < 0.67 else rng.randrange(1, streams)
        length = rng.choice([1.0, 1.2, 2.0])
        t[s] += rng.choice([0.0, 0.1, 0.55, 0.6, 0.7, -0.3, 5.0]) * rng.random()
        payload = rng.choices(["iq", "lost", "spectra"], [0.9, 0.04, 0.06])[0]
        rate = 1e6 * (1 + 0.03 * rng.randrange(6))
        rows.append((s, seq // 700, seq, payload, t[s], t[s] + length, rng.randrange(1, 9), 1e9 + rng.choice([0.0, 0.6, 1.2, 1.8]), rate))
        t[s] += length
    return rows


def by_hand(rows, cap=float("inf")):
    """The rules as one loop over a stream."""
    out, state = {}, {}
    for s, conn, seq, payload, start, end, n, center, rate in rows:
        x = state.setdefault(s, {"end": None, "dur": None, "jit": 0.0, "conn": None, "geo": None})
        if payload not in ("iq", "lost"):
            continue
        if x["conn"] is not None and x["conn"] != conn:
            x["end"] = x["dur"] = None
        x["conn"] = conn
        if payload == "lost":
            x["end"] = x["dur"] = None
            continue
        dur, kind = end - start, "first"
        if x["end"] is not None:
            gap, least = start - x["end"], min(dur, x["dur"])
            tol = min(cap, max(4e-6, 0.5 * least, min(4 * x["jit"], 0.75 * least)))
            kind = "drop" if gap > tol else "backward" if -gap > tol else "continuous"
            if kind == "continuous":
                x["jit"] = max(x["jit"] * 0.999, abs(gap))
        x["end"], x["dur"], change = end, dur, None
        if x["geo"] is None:
            change = "initial"
        elif abs(x["geo"][0] - center) > 1 or abs(rate - x["geo"][1]) / x["geo"][1] > 0.1:
            change = "retune"
        if change:
            x["geo"] = (center, rate)
        out[seq] = (kind, change)
    return out


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_blocks_agree_with_one_loop(spark, block):
    rows = noisy(block, 4000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    done = ct.mark_retunes(ct.classify_gaps_adaptive(df, cap_s=None, block=block), block)
    got = {r.seq: (r.gap_class, r.geometry_change) for r in done.collect()}
    assert got == by_hand(rows)


@pytest.mark.parametrize("block", [13, 500, None])
def test_index_does_not_depend_on_blocks(spark, block):
    rows = noisy(1, 3000)
    got = {r.seq: r.first_sample for r in ct.with_sample_index(spark.createDataFrame(rows, SCHEMA), block).collect()}
    want, at = {}, {}
    for s, _, seq, payload, *_, n, _, _ in rows:
        if payload == "iq":
            want[seq] = at.get(s, 0)
            at[s] = want[seq] + n
    assert got == want


def test_runs_cover_all_samples(spark):
    df = spark.createDataFrame(noisy(3, 3000), SCHEMA)
    runs = ct.epochs(ct.continuity(df, block=256)).orderBy("stream_id", "first_sample").collect()
    at = {}
    for r in runs:
        assert r.first_sample == at.get(r.stream_id, 0)
        at[r.stream_id] = r.first_sample + r.n_samples
    want = {r[0]: r[1] for r in df.filter("payload = 'iq'").groupBy("stream_id").agg(F.sum("samples")).collect()}
    assert at == want


@pytest.mark.parametrize("seed", range(6))
def test_jitter_by_stretches_is_the_jitter_row_by_row(seed):
    """Sizes in whole steps, so that many lie on a limit; bounds that move; nulls; every cut into blocks."""
    rng = np.random.default_rng(seed)
    n, margin, decay = 400, 4.0, (0.5, 0.995)[seed % 2]
    size = rng.integers(0, 40, n).astype(float) * rng.choice([0, 1, 4, 0.25], n)
    size[rng.random(n) < 0.03] = np.nan
    low = rng.choice([1.0, 3.0, 0.5], n)
    high = low * rng.choice([1, 20, np.inf], n)

    def loop(jitter, part):
        ok = []
        for s, lo, hi in zip(size[part], low[part], high[part]):
            kind = "first"
            if not np.isnan(s):
                kind, jitter = kernels.judge(jitter, s, lo, hi, margin, decay)
            ok.append(kind == "continuous")
        return ok, jitter

    for jitter in (0.0, 1.0, 7.5, 1e4):
        got = kernels.accepted(jitter, size, low, high, margin, decay)
        assert got.tolist() == loop(jitter, slice(None))[0]
    for step in (1, 7, 64, n):
        jitter = true = 0.0
        for at in range(0, n, step):
            part = slice(at, at + step)
            r = kernels.JitterReport(margin, decay)
            _, opened, count, top = kernels.between_open(size[part], low[part], high[part], decay)
            for s, c, ahead in zip(size[part][opened].tolist(), count.tolist(), top.tolist()):
                r.close_gaps(c, ahead)
                r.open_gap(s)
            r.close_gaps(int(count[-1]), float(top[-1]))
            true = loop(true, part)[1]
            jitter = kernels.leave(jitter, *zip(*r.pieces), decay)
            assert jitter == pytest.approx(true, rel=1e-9)
