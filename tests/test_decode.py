import json
import os
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rfspark.operators import decode, headers as hd
from rfspark.sources import dumps

def test_code_table():
    for byte, want in zip(bytes.fromhex("8090A0B0C0D0E0F0"), (0, 0, 1, -1, 2, -2, 3, -3)):
        assert decode.rice_values(bytes([byte]))[0] == want
    for byte, want in zip(bytes.fromhex("40414243"), (4, -4, 5, -5)):
        assert decode.rice_values(bytes([byte]))[0] == want
    assert decode.rice_values(b"").size == 0


def loop_values(data):
    bits = "".join(f"{b:08b}" for b in data)
    at, out = 0, []
    while at < len(bits):
        stop = bits.find("1", at)
        if stop < 0 or stop - at > 9:
            break
        tier = stop - at
        end = stop + 1 + 3 * (tier + 1)
        if end > len(bits):
            break
        code = int(bits[stop + 1 : end], 2)
        size = (code >> 1) + sum(2 ** (3 * k + 2) for k in range(tier))
        out.append(-size if code & 1 else size)
        at = end
    return out


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=200))
def test_codes_agree_with_a_bit_loop(data):
    assert decode.rice_values(data).tolist() == loop_values(data)


def loop_unfold(grid):
    rows, cols = grid.shape
    x, half = grid.astype(np.float32).copy(), np.float32(np.sqrt(np.float32(0.5)))
    step = 1
    while rows % (2 * step) == 0:
        step *= 2
    while cols % (2 * step) == 0:
        step *= 2
    while step > 1:
        step //= 2
        for axis, size in ((1, cols), (0, rows)):
            if size % (2 * step):
                continue
            for r in range(0, rows, step if axis else 2 * step):
                for c in range(0, cols, 2 * step if axis else step):
                    r2, c2 = (r, c + step) if axis else (r + step, c)
                    if r2 < rows and c2 < cols:
                        a, b = x[r, c], x[r2, c2]
                        x[r, c], x[r2, c2] = half * (a + b), half * (a - b)
    return x


@pytest.mark.parametrize("shape", [(1, 2), (4, 8), (16, 16), (8, 4), (3, 12), (16, 6), (5, 7)])
def test_transform_agrees_with_nested_loops(shape):
    grid = np.random.default_rng(1).normal(size=shape).astype(np.float32)
    np.testing.assert_allclose(decode.unfold(grid[None].copy())[0], loop_unfold(grid), rtol=1e-6, atol=1e-6)


BLOCK = "seq int, payload binary, kind string, compression int, samples int, sampleSize int, sampleDepth int"


def test_block_golden_and_limits(spark):
    rows = [
        (0, b"\xad", "spectra", 2, 1, 2, 1),
        (1, b"\xad", "spectra", 32, 1, 2, 1),
        (2, b"\xad", "spectra", 0, 1, 2, 1),
        (3, b"\xad", "spectra", 2, 0, 2, 1),
        (4, b"\xad", "spectra", 2, 17, 2, 1),
        (5, b"\xad", "histogram", 2, 1, 2, 1),
        (6, b"\xad", "spectra", 31, 1, 2, None),
        (7, b"\xad", "spectra", 2, 1, 4, 1),
    ]
    out = {r.seq: r for r in decode.decompress_spectra(spark.createDataFrame(rows, BLOCK)).collect()}
    root = 0.5**0.5
    assert out[0]["values"] == pytest.approx([-0.2 * root, 0.6 * root], abs=1e-6)
    assert all(out[k].decode_error for k in (1, 2, 3, 4, 5)) and not out[6].decode_error
    assert len(out[7]["values"]) == 4


def test_formats_and_scales(spark):
    raw = np.array([100, -200, 32767, -32768], "<i2").tobytes() + b"\x01"
    rows = [
        ("a", raw, "int16", 100.0),
        ("b", raw, "INT16", None),
        ("c", np.array([0.5, np.nan, np.inf, -2.0], "<f2").tobytes(), "float16", None),
        ("d", np.array([1.5, -np.inf], "<f4").tobytes() + b"abc", "float32", None),
        ("e", b"", "float32", None),
    ]
    df = spark.createDataFrame(rows, "name string, payload binary, format string, scale double").coalesce(1)
    out = {r.name: r for r in decode.decode_iq(df).collect()}
    assert out["a"].i == pytest.approx([1.0, 327.67], rel=1e-6) and out["a"].q == pytest.approx([-2.0, -327.68])
    assert out["b"].i == pytest.approx([100 / 32768, 32767 / 32768])
    assert (out["c"].i, out["c"].q) == ([0.5, 0.0], [0.0, -2.0])
    assert (out["d"].i, out["d"].q) == ([1.5], [0.0])
    assert out["e"].n == 0
    assert decode.decode_iq(df.drop("scale"), scale=50.0).filter("name = 'a'").first().i[0] == pytest.approx(2.0)


def test_int16_round_trip_stays_within_a_step(spark):
    rng = np.random.default_rng(2)
    i, q = rng.uniform(-1, 1, 500).tolist(), rng.uniform(-1, 1, 500).tolist()
    df = spark.createDataFrame([(0, i, q)], "seq int, i array<float>, q array<float>")
    wire = decode.encode_iq(df, "int16", 4096.0).withColumns({"format": F.lit("int16"), "scale": F.lit(4096.0)})
    back = decode.decode_iq(wire).first()
    np.testing.assert_allclose(back.i, i, atol=0.5 / 4096 + 1e-7)
    np.testing.assert_allclose(back.q, q, atol=0.5 / 4096 + 1e-7)


def header(n, **more):
    h = {"startTime": 1.0, "endTime": 2.0, "startFrequency": 1.0, "endFrequency": 2.0, "samples": n, "unit": "volt",
         "payload": "iq", "minPower": -1, "maxPower": 0, "sampleSize": 2, **more}
    return json.dumps(h).encode()


def write(path, data):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "dump.bin"), "wb") as f:
        f.write(data)
    return str(path)


@pytest.mark.parametrize("separator", [b"\n\x1e", b"\x1e", b"\n"])
def test_separators_and_awkward_payloads(spark, tmp_path, separator):
    first = b"\x1e\x0a\x1e\x0a" if separator != b"\n" else b"\x0a\x1e\x0a\x1e"
    data = b"noise{" + header(1) + separator + first + header(2) + separator + b"{\x1e\n{abcd"
    got = dumps.scan_stream_dumps(spark, write(tmp_path, data), "int16").orderBy("seq").collect()
    assert [bytes(r.payload) for r in got] == [first, b"{\x1e\n{abcd"]
    assert got[0].rejected == 1


def test_any_cut_gives_the_same_packets(spark, tmp_path):
    rng, data, want = random.Random(5), b"", []
    for k in range(300):
        body = rng.randbytes(4 * (k % 50))
        if k % 13 == 0:
            data += b'{"startTime":1,{\n'
        want.append((len(data), body))
        data += header(k % 50, scale=float(k + 1)) + rng.choice([b"\n\x1e", b"\x1e"]) + body
    path = write(tmp_path, data)
    for cut in (1 << 30, 5000, 777):
        rows = dumps.scan_stream_dumps(spark, path, "int16", split_bytes=cut).orderBy("seq").collect()
        assert [(r.seq, bytes(r.payload)) for r in rows] == want


def test_compressed_packet_costs_only_itself(spark, tmp_path):
    spectra = header(1, payload="spectra", compression=3, sampleSize=64)
    data = header(1) + b"\n\x1eabcd" + spectra + b"\n\x1e" + b"\x00\x01\x02" + header(1) + b"\n\x1eefgh"
    scanned = dumps.scan_stream_dumps(spark, write(tmp_path, data), "int16")
    sized = hd.with_expected_bytes(hd.parse_headers(scanned.withColumn("format", F.lit("int16"))))
    out = [r.outcome for r in hd.with_outcome(sized).orderBy("seq").collect()]
    assert out == ["packet", "skipped", "packet"]


@pytest.mark.parametrize("n, count", [(5, 5), (5.0, 5), ([1, 2, 3], 3), (-1, None), ("x", None)])
def test_samples_in_either_form(spark, n, count):
    row = hd.parse_headers(spark.createDataFrame([(header(n).decode(),)], "header string")).first()
    assert row.samples == count and (row.header_error is None) == (count is not None)


def test_oversized_payload_is_lost(spark):
    df = spark.createDataFrame([(header(1 << 40).decode(), b"", "int16"), (header(1 << 62).decode(), b"", "int16")], "header string, payload binary, format string")
    out = hd.with_outcome(hd.with_expected_bytes(hd.parse_headers(df))).collect()
    assert [r.outcome for r in out] == ["lost", "lost"]
