import datetime
import os
import random
import time

from pyspark.sql import functions as F

from rfspark.operators import continuity as ct
from rfspark.operators.linkbudget import stream_rates
from rfspark.plans.feeds import run
from rfspark.sources import feed
from rfspark.sources.landing import LandingReader
from rfspark.streaming import continuity as live, stats
from test_continuity import SCHEMA, noisy


def test_stream_finds_the_breaks_of_the_batch(spark, tmp_path):
    rows = noisy(11, 3000)
    for k in range(4):
        part = rows[len(rows) * k // 4 : len(rows) * (k + 1) // 4]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path))
    source = feed.read_packet_stream(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema, 1)
    got = run(live.continuity_stream(source, cap_s=None, stall_s=None), spark, "t1", rocks=True)
    batch = ct.classify_gaps_adaptive(spark.createDataFrame(rows, SCHEMA), cap_s=None, block=128)
    want = ct.break_log(ct.with_epochs(ct.mark_retunes(batch, 128), 128))
    columns = ["stream_id", "at_sample", "place", "kind", "center_hz", "rate_hz"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))


def test_late_packets_are_set_aside(spark, tmp_path):
    rows = noisy(12, 200, streams=2)
    for part in (rows[:100] + rows[150:], rows[100:150]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path))
    source = feed.read_packet_stream(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema, 1)
    got = run(live.continuity_stream(source, cap_s=None, stall_s=None), spark, "late", rocks=True)
    assert got.filter(F.col("kind") == "late").count() == 50


def test_a_quiet_stream_stalls(spark, tmp_path):
    rows = noisy(13, 60, streams=2)
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows[:30], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    source = feed.read_packet_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, 1)
    store = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        breaks = live.continuity_stream(source, cap_s=None, stall_s=1.0)
        query = feed.start_stream(breaks, out, str(tmp_path / "checkpoint"), continuous="1 second")
        try:
            # The engine keeps running batches for its timers, so there is no "all" to wait for.
            until = time.time() + 60
            while time.time() < until:
                time.sleep(1)
                if not os.path.isdir(f"{out}/_spark_metadata"):
                    continue
                done = spark.read.schema(breaks.schema).parquet(out)
                if done.filter("kind = 'stall'").select("stream_id").distinct().count() == 2:
                    break
        finally:
            query.stop()
    finally:
        spark.conf.unset(store)
    assert spark.read.schema(breaks.schema).parquet(out).filter("kind = 'stall'").count() == 2


LIVE = "stream_id bigint, seq bigint, ts timestamp, payload string, samples bigint, bytes bigint"


def at(second):
    return datetime.datetime.fromtimestamp(second, datetime.timezone.utc)


def land(spark, folder, *slices, schema=LIVE):
    for rows in slices:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.createDataFrame([], schema).schema


def test_one_giant_file_is_many_bounded_batches(spark, tmp_path):
    rows = [(k % 3, k, at(k), "iq", 1, 4) for k in range(1000)]
    schema = land(spark, tmp_path / "in", rows)
    for more in ([], [(9, 1000, at(1000), "iq", 1, 4)]):
        if more:
            land(spark, tmp_path / "in", more)
        source = feed.read_packet_stream(spark, str(tmp_path / "in"), schema, rows_per_trigger=150)
        query = feed.start_stream(source, str(tmp_path / "out"), str(tmp_path / "checkpoint"), continuous="0 seconds")
        try:
            query.processAllAvailable()
            taken = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
        finally:
            query.stop()
        # A trigger takes a range of the file; a restart goes on where the last one ended.
        assert len(taken) == (1 if more else 7)
        got = spark.read.schema(schema).parquet(str(tmp_path / "out"))
        assert sorted(r.seq for r in got.collect()) == list(range(1000 + len(more)))


def test_bytes_bound_a_batch_and_a_huge_row_goes_alone(spark, tmp_path):
    schema = land(spark, tmp_path, [(1, k, at(k), "iq" + "x" * 5000 * (k % 2), 1, 4) for k in range(6)])
    reader = LandingReader({"path": str(tmp_path), "bytespertrigger": "1"})
    offset, taken = reader.initialOffset(), []
    while True:
        ranges, end = reader.read(offset)
        ranges = list(ranges)
        assert ranges == list(reader.readBetweenOffsets(offset, end)) if ranges else offset == end
        if not ranges:
            break
        taken += [r[1:] for r in ranges]
        offset = end
    assert taken == [(k, 1) for k in range(6)] and "payload" in schema.names


def closed_feed(rng):
    """Packets a little out of order; stream 1 ends early, stream 2 late, stream 3 never."""
    rows = []
    for stream, until in ((1, 300), (2, 900), (3, 900)):
        now = 0.0
        while now < until:
            now += rng.choice([0.2, 0.5, 1, 2, 11, 25]) + rng.randint(1, 99999) / 10**6  # no silence of exactly the gap, where the two differ
            rows.append([stream, 0, now + rng.choice([0, 0, 3]), "iq", rng.randint(1, 50), rng.randint(1, 9)])
    rows.sort(key=lambda r: r[2] + rng.random())
    rows = [(s, k, at(1000 + t), p, n, b) for k, (s, _, t, p, n, b) in enumerate(rows)]
    ends = [(1, 10**6, [r for r in rows if r[0] == 1][-1][2], "closed", None, None), (2, 10**6, rows[-1][2], "closed", None, None)]
    place = max(k for k, r in enumerate(rows) if r[0] == 1) + 1
    return rows, rows[:place] + ends[:1] + rows[place:] + ends[1:]


def test_open_windows_and_sessions_come_out_with_the_marker(spark, tmp_path):
    rows, landed = closed_feed(random.Random(6))
    schema = land(spark, tmp_path, *(landed[len(landed) * k // 5 : len(landed) * (k + 1) // 5] for k in range(5)))
    source = lambda: feed.read_packet_stream(spark, str(tmp_path), schema, rows_per_trigger=90)
    batch = spark.createDataFrame(rows, LIVE)
    shape = lambda df: sorted(map(str, df.filter("stream_id < 3").collect()))
    for slide in (None, "10 seconds"):
        got = run(stats.closed_stats(source(), "40 seconds", "30 seconds", slide), spark, "windows", rocks=True)
        assert shape(got) == shape(stream_rates(batch, "30 seconds", slide))
        # A stream without a marker keeps what the watermark has not passed, and nothing else.
        last = batch.agg(F.max("ts")).first()[0].timestamp()
        passed = stream_rates(batch, "30 seconds", slide).filter("stream_id = 3").filter(F.unix_micros("window_end") <= int((last - 41) * 1e6))
        third = got.filter("stream_id = 3")
        assert passed.count() > 10 and passed.exceptAll(third).isEmpty() and third.exceptAll(stream_rates(batch, "30 seconds", slide)).isEmpty()
        assert third.count() < stream_rates(batch, "30 seconds", slide).filter("stream_id = 3").count()
    got = run(stats.closed_sessions(source(), "40 seconds", "10 seconds"), spark, "sessions", rocks=True)
    want = batch.groupBy("stream_id", F.session_window("ts", "10 seconds").alias("s")).agg(
        F.count("*").alias("packets"), F.sum("samples").alias("samples")
    )
    assert shape(got) == shape(want.select("stream_id", F.col("s.start").alias("opened"), F.col("s.end").alias("closed"), "packets", "samples"))


def test_breaks_meet_the_reading_before_them_and_their_bands(spark, tmp_path):
    breaks = "device_id bigint, seq bigint, ts timestamp, closed boolean, center_hz double"
    health = "device_id bigint, seq bigint, ts timestamp, closed boolean, losing_nothing boolean"
    b = [(1, 1, at(10), False, 5.0), (1, 2, at(20), False, 15.0), (1, 3, at(21), False, 14.0), (1, 4, at(500), False, None), (2, 1, at(30), False, 99.0), (3, 1, at(40), False, 1.0)]
    h = [(1, 1, at(20), False, False), (1, 2, at(20), False, True), (1, 3, at(21), False, True), (2, 1, at(25), False, None)]
    left = land(spark, tmp_path / "b", b, [(d, 9, None, True, None) for d in (1, 2, 3)], schema=breaks)
    right = land(spark, tmp_path / "h", h[:2], h[2:], [(d, 9, at(600), True, None) for d in (1, 2, 3)], schema=health)
    bands = spark.createDataFrame([("low", 0.0, 15.0), ("mid", 14.5, 20.0)], "band string, band_start double, band_end double")
    read = lambda name, schema: feed.read_packet_stream(spark, str(tmp_path / name), schema, rows_per_trigger=2)
    out = run(stats.enrich_live(read("b", left), read("h", right), bands, "5 seconds", 100 * 10**6, 4.0), spark, "live", rocks=True)
    got = sorted((r.device_id, r.seq, r.blame, r.band or "") for r in out.collect())
    assert got == [
        (1, 1, "unknown", "low"), (1, 2, "device", "low"), (1, 2, "device", "mid"), (1, 3, "downstream", "low"),
        (1, 4, "unknown", ""), (2, 1, "unknown", ""), (3, 1, "unknown", "low"),
    ]
