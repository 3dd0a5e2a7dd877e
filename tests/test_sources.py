"""Sources: any store, cut files, and nothing dropped without a row."""

import json
import os
import random
import struct

import numpy as np
from pyarrow import fs
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In

from rfspark.plans import captures as cp
from rfspark.session import ship
from rfspark.sources import chunks as ch, dumps, files, samples


def header(n):
    return json.dumps({"startTime": 1.0, "endTime": 2.0, "startFrequency": 1.0, "endFrequency": 2.0, "samples": n, "unit": "volt",
                       "payload": "iq", "minPower": -1, "maxPower": 0, "sampleSize": 2}).encode()


def packets(spark, tmp_path, data, **how):
    (tmp_path / "dump.bin").write_bytes(data)
    return dumps.scan_stream_dumps(spark, str(tmp_path), "int16", **how).orderBy("seq").collect()


def test_fine_stretches_of_dumps_share_tasks_and_none_is_left_out(tmp_path):
    """One task a stretch took 180 ms each whatever the stretch held."""
    body = b"".join(header(4) + b"\n" + bytes(16) for _ in range(400))
    for i in range(3):
        (tmp_path / f"{i}.dump").write_bytes(body * (i + 1))
    (tmp_path / "none.dump").write_bytes(b"")
    reader = dumps.DumpReader({"path": str(tmp_path), "splitbytes": "100", "format": "int16"})
    parts = reader.partitions()
    assert len(parts) <= 2 * dumps.TASKS < 6 * len(body) // 100
    cuts = [x for p in parts for x in p.parts]
    whole = [(str(tmp_path / f"{i}.dump"), a, min(len(body) * (i + 1), a + 100)) for i in range(3) for a in range(0, len(body) * (i + 1), 100)]
    assert cuts == whole
    rows = [(r["file"], r["seq"]) for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert len(rows) == len(set(rows)) == 6 * 400


def test_names_keep_the_store_they_were_listed_in(tmp_path, monkeypatch):
    (tmp_path / "caps" / "deep").mkdir(parents=True)
    for name in ("caps/a.rf", "caps/deep/b.rf", "caps/_skipped.rf"):
        (tmp_path / name).write_bytes(b"x")
    store = fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())
    monkeypatch.setattr(files, "filesystem", lambda p: (store, p.split("://bucket/")[1]))
    found = files.listed("mock://bucket/caps", ".rf")
    assert found == [("mock://bucket/caps/a.rf", 1), ("mock://bucket/caps/deep/b.rf", 1)]
    assert files.listed("mock://bucket/caps/a.rf") == [("mock://bucket/caps/a.rf", 1)]
    for name, _ in found:
        system, inner = files.filesystem(name)
        assert system.open_input_file(inner).read() == b"x"


def test_junk_beyond_the_header_cap_costs_no_packet(spark, tmp_path):
    good = (header(1) + b"\n\x1eabcd") * 3
    rows = packets(spark, tmp_path, b"{" + b"j" * (11 << 20) + b"\n" + good)
    assert [r.error for r in rows] == ["no header ends within the cap", None, None, None]
    assert [bytes(r.payload) for r in rows[1:]] == [b"abcd"] * 3
    rows = packets(spark, tmp_path, good + b"{" * (12 << 20) + b"\n" + good)
    assert sum(r.error is None for r in rows) == 6


def test_a_dump_that_ends_early_says_so(spark, tmp_path):
    rows = packets(spark, tmp_path, header(1) + b"\n\x1eabcd" + header(2) + b"\n\x1eabcde")
    assert [(bytes(r.payload), r.error) for r in rows] == [(b"abcd", None), (b"abcde", "payload shorter than declared")]
    rows = packets(spark, tmp_path, header(1) + b"\n\x1eabcd" + header(2)[:50])
    assert [r.error for r in rows] == [None, "header cut short by the end of the file"]


def ranges(spark, path, rows):
    return spark.createDataFrame([(path, *r) for r in rows], "file string, at long, n int, int16 boolean, scale double")


def test_a_range_past_the_end_gives_what_there_is_and_an_error(spark, tmp_path):
    ship(spark)
    path = tmp_path / "iq.bin"
    path.write_bytes(np.arange(40, dtype="<f4").tobytes() + b"\1\2\3")
    rows = samples.read_pairs(ranges(spark, str(path), [(0, 4, False, 1.0), (128, 8, False, 1.0), (900, 2, False, 1.0)])).collect()
    assert [(r.n, r.read_error is None) for r in rows] == [(4, True), (4, False), (0, False)]


def test_batches_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(samples, "BATCH_BYTES", 100)
    batch = pa.RecordBatch.from_arrays([pa.array(range(9))], ["k"])
    parts = list(samples._parts(batch, [40] * 4 + [500] + [10] * 4))
    assert [v for p in parts for v in p.column(0).to_pylist()] == list(range(9)) and len(parts) >= 4


def test_chunks_of_one_file_go_to_many_tasks(spark):
    # Small test data would be put together again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many_tasks(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def many_tasks(spark):
    index = spark.range(2000).select(F.lit("one").alias("file"), (F.col("id") * 1000).alias("chunk_offset"), F.lit(64).alias("num_samples"))
    cut = samples._pieces(index, F.col("num_samples"), 65536)
    assert cut.select(F.spark_partition_id()).distinct().count() > 1
    far = spark.range(2000).select(F.lit("one").alias("file"), (F.col("id") * (8 << 20)).alias("at"))
    assert samples._spread(far).select(F.spark_partition_id()).distinct().count() > 1


def test_compressed_chunks_never_become_zeros(spark, tmp_path):
    ship(spark)
    path = tmp_path / "caps.bin"
    path.write_bytes(b"\0" * 200)
    rows = [
        (0, 64, 64),  # nothing after the header
        (0, 64 + samples.MAX_COMPRESSED_BYTES + 1, 64),  # over the cap
        (100, 64 + 500, 64),  # cut short
    ]
    df = spark.createDataFrame(
        [(str(path), at, size, hs, 3, 5, 2, 1, 8) for at, size, hs in rows],
        "file string, chunk_offset long, size long, header_size int, payload_type int, sample_type int, compression int, "
        "num_samples long, sample_size long",
    )
    got = samples.load_compressed_spectra(df).collect()
    assert len(got) == 3 and all(r.values is None and r.decode_error for r in got)


def tricky_file(rng, n):
    """Chunks of many sizes whose samples hold what looks like chunks, noise between them, bad sizes and a cut at the end."""
    out = b""
    for k in range(n):
        kind = rng.choice(["SAMP", "SAMP", "STRM", "DSFH", "noise", "bad"])
        if kind == "noise":
            out += bytes(rng.randrange(256) for _ in range(rng.randrange(40)))
        elif kind == "bad":
            out += struct.pack("<4sIIHH", b"STRT", 3, 0, 1, 16)
        elif kind == "SAMP":
            fake = struct.pack("<4sIIHH", rng.choice([b"DSFH", b"SAMP"]), rng.choice([24, 40, 200]), 0, 1, 64)
            body = b"".join(rng.choice([fake, b"abcd"]) for _ in range(rng.choice([2, 10, 120])))
            out += cp.chunk("SAMP", struct.pack("<QIBBBbddIIII", 7, 1, 5, 19, 2, 0, 0.0, 1.0, 0, 2, 1, 1) + body, 64)
        else:
            out += cp.chunk(kind, struct.pack("<Qdqd", 7, 1.0, 0, 2.0) if kind == "STRM" else struct.pack("<d", 1.0))
    return out[: len(out) - rng.choice([0, 7])]


def test_one_file_read_by_many_tasks_gives_the_rows_of_one_pass(spark, tmp_path):
    rng = random.Random(8)
    for k in range(4):
        (tmp_path / f"file-{k}.rf").write_bytes(tricky_file(rng, 60))
    (tmp_path / "front.rf").write_bytes(cp.capture_bytes(3, [[0.5] * 64] * 40))
    (tmp_path / "noise.rf").write_bytes(b"\1\2" * 4000)
    whole = sorted(map(str, ch.scan_chunks(spark, str(tmp_path), ".rf").collect()))
    assert sum("size of no chunk" in r for r in whole) > 3 and any("no chunk in this file" in r for r in whole)
    for split in (700, 3000):
        assert sorted(map(str, ch.scan_chunks(spark, str(tmp_path), ".rf", split_bytes=split).collect())) == whole


def test_filters_choose_files_and_kinds_before_they_are_read(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"file-{k}.rf").write_bytes(cp.capture_bytes(k, [[0.5] * 64] * 9))
    chunks, name = ch.scan_chunks(spark, str(tmp_path), ".rf"), str(tmp_path / "file-1.rf")
    wanted = chunks.filter((F.col("id") == "SSTR") & (F.col("file") == name))
    assert [r.file for r in wanted.collect()] == [name, name]
    reader = ch.ChunkReader({"path": str(tmp_path), "suffix": ".rf"})
    assert list(reader.pushFilters([EqualTo(("id",), "SSTR"), In(("file",), (name,)), EqualTo(("size",), 3)])) == [EqualTo(("size",), 3)]
    assert [p.names for p in reader.partitions()] == [[name]]
    # Bodies of other kinds are not read.
    taken = []
    with open(name, "rb") as f:
        class Counted:
            seek, tell = f.seek, f.tell

            def read(self, n):
                data = f.read(n)
                taken.append(len(data))
                return data

        end = os.path.getsize(name)
        few = sum(1 for _ in ch._chunks_between(Counted(), name, 0, end, end, {"SSTR"}))
        read_few, taken[:] = sum(taken), []
        assert few == sum(1 for _ in ch._chunks_between(Counted(), name, 0, end, end)) and read_few < sum(taken) / 3


def test_one_scan_read_under_several_filters(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"file-{k}.rf").write_bytes(cp.capture_bytes(k, [[0.5] * 64] * 9))
    chunks, names = ch.scan_chunks(spark, str(tmp_path), ".rf"), [str(tmp_path / f"file-{k}.rf") for k in range(3)]
    kinds = chunks.filter("id = 'SAMP'").unionByName(chunks.filter("id = 'SSTR'"))
    assert sorted(map(tuple, kinds.groupBy("id").count().collect())) == [("SAMP", 27), ("SSTR", 6)]
    both = chunks.filter(F.col("file") == names[0]).unionByName(chunks.filter(F.col("file") == names[1]))
    assert sorted(r.file for r in both.select("file").distinct().collect()) == names[:2]
    assert chunks.filter("id = 'DSFH'").count() == 3 and chunks.select("file").distinct().count() == 3
    for split in (ch.SPLIT_BYTES, 700):
        few = ch.scan_chunks(spark, str(tmp_path), ".rf", split, files=names[1:], kinds=["SSTR", "STRM"])
        want = sorted(map(str, chunks.filter(F.col("file").isin(*names[1:]) & F.col("id").isin("SSTR", "STRM")).collect()))
        assert len(want) == 6 and sorted(map(str, few.collect())) == want
