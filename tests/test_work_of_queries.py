"""What queries shuffle, sort and hold."""

from pyspark.sql import functions as F

from rfspark.operators import health as hl

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_readings_of_a_snapshot_need_no_shuffle_and_equal_those_of_its_rows(spark):
    from rfspark.plans.health import device_configs, device_health, snapshots

    trees = [df(spark, SF).localCheckpoint() for df in (snapshots, device_configs, device_health)]
    snaps, configs, health = ([f(t) for f in (hl.nested_tree, hl.flatten_tree)] for t in trees)
    text = lambda df: sorted(str(r) for r in df.withColumns({n: F.to_json(F.struct(n)) for n in df.columns}).collect())
    for read in (hl.block_health, hl.sensors, hl.gps_state):
        whole, rows = (read(t) for t in snaps)
        assert text(whole) == text(rows) and whole.columns == rows.columns
        assert not any(word in plan(whole) for word in ("Exchange", "Sort", "Aggregate"))
    whole, rows = (hl.capabilities(c, h) for c, h in zip(configs, health))
    assert text(whole) == text(rows)
    assert "Aggregate" not in plan(whole)


def test_blocks_bounds_move_no_samples(spark):
    from rfspark.operators import blocks as bl
    from rfspark.plans import registry

    rows = [("s", 1, 0, k * 37, 37, [float(k)] * 37, [0.0] * 37) for k in range(9)]
    df = spark.createDataFrame(rows, "stream_id string, epoch_id long, epoch_first long, first_sample long, n int, i array<float>, q array<float>")
    bounds = ["stream_id", "epoch_id", "block", "first_sample", "n"]
    whole, lean = bl.reblock(df, 64), bl.reblock(df.drop("i", "q"), 64, arrays=())
    assert sorted(whole.select(bounds).collect()) == sorted(lean.select(bounds).collect())
    assert whole.schema["n"].dataType == lean.schema["n"].dataType
    assert "collect_list" not in plan(registry.queries()["r3_reblock_packets"](spark, SF))


def test_overlaps_list_each_packet_once_where_it_begins(spark):
    import random

    from rfspark.operators import blocks as bl

    rng = random.Random(5)
    made = lambda n: [(k, k % 2, s, s + rng.choice([0, 1, 7, 40, -3])) for k in range(n) for s in [rng.randrange(200)]]
    left, right = made(120), made(130)
    want = sorted((a[0], b[0], min(a[3], b[3]) - max(a[2], b[2]), b[2] - a[2]) for a in left for b in right if a[1] == b[1] and a[2] < b[3] and b[2] < a[3])
    a, b = (spark.createDataFrame(rows, "key long, pair int, start_time long, end_time long") for rows in (left, right))
    for salts in (1, 3):
        out = bl.overlap_join(a, b, 10, on=["pair"], salts=salts)
        assert sorted(map(tuple, out.select("a_key", "b_key", "overlap", "offset").collect())) == want
        assert "BroadcastHashJoin" not in plan(out)


def test_overlaps_exchange_a_packet_once_for_each_stretch_it_touches(spark):
    """Each side went through two joins, and under every bucket through one of them."""
    from rfspark.operators import blocks as bl

    made = lambda n, step: spark.createDataFrame([(k, k * step, k * step + 60) for k in range(n)], "key long, start_time long, end_time long")
    out = bl.overlap_join(made(200, 7), made(300, 5), 10)
    assert plan(out).count("SortMergeJoin") == 1 and plan(out).count("Exchange") == 2
    want = {(i, j) for i in range(200) for j in range(300) if 7 * i < 5 * j + 60 and 5 * j < 7 * i + 60}
    got = [(r.a_key, r.b_key) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want


class Held:
    """A state store of one key: what the processors ask of it."""

    value = None

    def getValueState(self, *_):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_breaks_leave_in_stretches(monkeypatch):
    import pandas as pd
    import pytest

    from rfspark.streaming import continuity as live

    def run(stretch):
        monkeypatch.setattr(live, "STRETCH", stretch, raising=False)
        made = live.ContinuityProcessor(float("inf"), 0.0, None, None)
        made.init(Held())
        n, kinds = 1000, ["iq", "spectra", "iq", "lost", None]
        rows = pd.DataFrame({
            "seq": range(n), "connection_id": [k // 300 for k in range(n)], "payload": [kinds[k % 5] for k in range(n)], "start_time": [k * 2.0 for k in range(n)],
            "end_time": [k * 2.0 + 1 for k in range(n)], "samples": 5, "center_hz": [float(k // 50) * 100 for k in range(n)], "rate_hz": 1e6,
        })
        parts = rows.sample(frac=1, random_state=3)
        return list(made.handleInputRows((7,), iter([parts[:400], parts[400:]]), None)), made.state.value

    (whole, end), (parts, other) = run(10**6), run(64)
    assert len(whole) == 1 and len(parts) > 10 and max(map(len, parts)) <= 3 * 64
    pd.testing.assert_frame_equal(pd.concat(parts, ignore_index=True), whole[0])
    assert end == other and end[0] == 999


def test_waiting_breaks_of_a_device_are_many_states(spark, tmp_path):
    import random

    from rfspark.plans.feeds import run
    from rfspark.sources import feed
    from rfspark.streaming import stats

    rng, age = random.Random(8), 100 * 10**6
    made = lambda n: [(rng.randint(1, 2), k, rng.randrange(9000 * 10**6), False) for k in range(n)]
    b, h = made(400), [(*r, rng.choice([True, False, None])) for r in made(120)]
    types = "device_id bigint, seq bigint, us bigint, closed boolean"
    ends = [(d, 10**6, None, True) for d in (1, 2)]
    sides = []
    for name, rows, more in (("b", b + ends, ""), ("h", h + [(*e, None) for e in ends], ", losing_nothing boolean")):
        df = spark.createDataFrame(rows, types + more).withColumn("ts", F.timestamp_micros("us")).drop("us")
        df.coalesce(1).write.parquet(str(tmp_path / name))
        sides.append(feed.read_packet_stream(spark, str(tmp_path / name), df.schema, rows_per_trigger=1000))
    rows = stats.with_health(*sides, "3 hours", age)
    got = {(r.device_id, r.seq): r.blame for r in run(rows, spark, "as-of", rocks=True).collect()}

    def blame(device, us):
        known = [(r[2], -r[1], r[4]) for r in h if r[0] == device and r[2] <= us]
        last = max(known, key=lambda k: k[:2], default=None)
        return "unknown" if last is None or last[2] is None or us >= last[0] + age else "downstream" if last[2] else "device"

    assert got == {(d, seq): blame(d, us) for d, seq, us, _ in b} and len(set(got.values())) == 3
    assert "slot" in rows._jdf.queryExecution().analyzed().toString()
