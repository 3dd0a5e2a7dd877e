"""Time the headline queries: prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rfspark.plans import registry  # noqa: E402
from rfspark.session import local_session  # noqa: E402

HEADLINE = [
    "g9_epochs",
    "g1_gap_classes",
    "g2_adaptive_tolerance",
    "g4_gap_stats",
    "g5_retunes_announced_baseline",
    "g7_sample_index",
    "g8_break_log",
    "g14_gap_attribution",
    "s3_parse_headers",
    "s6_decode_float32",
    "s9_decompress_spectra",
    "s15_schedule_bursts",
    "m3_band_join",
    "r3_reblock_packets",
    "r7_receiver_overlaps",
    "p1_trace_detectors",
    "p5_channel_power",
    "p8_iq_statistics",
    "p9_noise_floor",
    "l3_throughput",
    "l8_stream_rates",
    "h1_flatten_tree",
    "s10_load_iq",
]


# One packet of 32 Ki pairs per vector, as receivers send them: what decoding costs without the start-up.
PAIRS = 32
REPEATS = 1024


def long_packets(spark, sf):
    """Packets of 32 Ki pairs, written once; each is a vector's 32 pairs over and over."""
    from pyspark.sql import functions as F

    from rfspark.plans.headers import _wire
    from rfspark.session import cut

    wire = _wire(spark, sf, "int16", 4096.0).withColumn("payload", F.expr(f"unhex(repeat(hex(payload), {REPEATS}))"))
    return cut(wire.repartition(4 * spark.sparkContext.defaultParallelism), "long-packets")


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench", partitions=int(cpus) if cpus.isdigit() else 8)
    queries = registry.queries()
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        best = None
        # The first run also compiles; the second is what a warm session takes.
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    rates = {}
    if not sys.argv[1:]:
        from rfspark.operators import decode

        packets = long_packets(spark, sf)
        samples = packets.count() * PAIRS * REPEATS
        best = None
        for _ in range(2):
            start = time.perf_counter()
            decode.decode_iq(packets).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        rates["decode_int16_ms_per_s"] = round(samples / best / 1e6, 1)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline queries, warm", "value": total, "unit": "sec", "queries": times, "rates": rates, "sf": sf.rstrip("/").split("/")[-1]}))


if __name__ == "__main__":
    main()
