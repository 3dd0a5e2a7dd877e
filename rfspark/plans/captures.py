"""A lake of capture files written from the vectors, for the queries that read files.

Each file holds fifty vectors as sample chunks: 32 I/Q pairs a chunk, every third
one 16-bit. Every fourth file has its samples in front and no sample chunks.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession, functions as F

from rfspark.plans.views import table
from rfspark.session import shared_folder
from rfspark.sources.files import filesystem

PER_FILE = 50
NOISE = b"\x01{\n\x02\x03"
_written: dict = {}


def chunk(ident: str, body: bytes, header_size: int = 0, flags: int = 0) -> bytes:
    return struct.pack("<4sIIHH", ident.encode(), 16 + len(body), flags, 1, header_size or 16) + body


def samp_chunk(values: np.ndarray, sub: int, short: bool, start: float, end: float) -> bytes:
    data = np.round(values * 32768).clip(-32768, 32767).astype("<i2") if short else values.astype("<f4")
    fields = struct.pack("<QIBBBbddIIII", 7, sub, 2 if short else 5, 19, 2, 0, start, end, 0, 2, 1, values.size // 2)
    return chunk("SAMP", fields + data.tobytes(), 64)


def name128(text: str) -> bytes:
    return text.encode().ljust(128, b"\0")


def type_definition() -> bytes:
    leaf = lambda kind: struct.pack("<QBII", 0, kind, 0, 0)
    tags = struct.pack("<QBII", 3, 6, 0, 4) + name128("tag") + struct.pack("<I", 0) + leaf(4)
    fields = name128("gain") + struct.pack("<I", 0) + leaf(3) + name128("tags") + struct.pack("<I", 0) + tags
    return struct.pack("<QBII", 1, 7, 0, 2) + fields


def sstr_chunk(sub: int, before: int, step: float, name: str) -> bytes:
    fields = struct.pack(
        "<QI4xqddddddII128sQQ", 7, sub, before, 1e9 + sub, step, 8e5, -1.0, 1.0, 0.0, 0, 0, name128(name), 1, 1
    )
    return chunk("SSTR", fields)


def capture_bytes(number: int, vectors: list) -> bytes:
    """One capture file. ``number`` decides its shape."""
    start = 1.7e9 + number
    head = chunk("DSFH", struct.pack("<d", start * 1e6 if number % 2 else start))
    strm = chunk("STRM", struct.pack("<Qdqd", 7, start, 0, 2.0))
    if number % 4 == 3:
        raw = b"".join(np.asarray(v, "<f4").tobytes() for v in vectors)
        tail = chunk("STRT", struct.pack("<qqqQQIII4xdqq", len(raw), 0, 0, 0, 0, 0, 0, 0, 0.0, 0, 0))
        return raw + head + strm + tail + chunk("DSFT", struct.pack("<dqI", start + 9, len(raw), 1))
    out = head + strm
    for k, v in enumerate(vectors):
        out += samp_chunk(np.asarray(v, np.float32), 1 + (k % 3 == 2), k % 3 == 2, start + k, start + k + 1)
        if k % 10 == 9:
            out += NOISE
    first = len(out)
    out += sstr_chunk(1, 0, 1e6, "main")
    second = len(out)
    out += sstr_chunk(2, first, -1.0 if number % 3 == 0 else 5e5, "" if number % 3 == 1 else "aux")
    antenna = len(out)
    matrix = np.eye(4, dtype="<f4").tobytes()
    out += chunk("ANTA", struct.pack("<Qq128sddII", 1, 0, name128("dish"), 48.0, 11.0 * (number % 2), 1, number % 2) + matrix + bytes(16))
    out += chunk("SSCA", name128("band") + struct.pack("<I4Bdd", 1 + number % 2 * 2, 1, 2, 3, 4, 1e9, 1.1e9))
    types = len(out)
    out += chunk("MDTT", struct.pack("<Qq", 1, 0) + type_definition())
    preview = len(out)
    used = min(16, len(vectors))
    out += chunk(
        "SPRV",
        struct.pack("<BB6x", 0, used)
        + struct.pack("<16q", *([0] * 16))
        + struct.pack("<16d", *[start + 2.0 * k for k in range(16)])
        + struct.pack("<16Q", *[64 * k for k in range(16)]),
    )
    foot = len(out)
    samples = 32 * len(vectors)
    length = -1.0 if number % 5 == 4 else 2.0
    out += chunk("STRT", struct.pack("<qqqQQIII4xdqq", 24, second, preview, samples, 8 * samples, 1, 1, 1, length, antenna, types))
    return out + chunk("DSFT", struct.pack("<dqI", start + 9, foot, 1))


def survey_bytes(number: int, vectors: list) -> bytes:
    """One file of spectra: a frame of 64 bins a chunk, every second one compressed, and chains of links behind them."""
    out = chunk("DSFH", struct.pack("<d", 1.7e9 + number)) + chunk("STRM", struct.pack("<Qdqd", 7, 1.7e9, 0, 2.0))
    for k, v in enumerate(vectors):
        v = np.asarray(v, np.float32)
        if k % 2:
            c = np.floor(v.astype(float) * 8 + 0.5).clip(-3, 3).astype(int)
            data = bytes.fromhex("".join(f"{8 + 2 * abs(x) + (x < 0):x}" for x in c.tolist()))
        else:
            data = v.astype("<f4").tobytes()
        fields = struct.pack("<QIBBBbddIIII", 7, 1, 5, 19, 3, 3 * (k % 2), float(k), k + 1.0, 0, 64, 1, 1)
        out += chunk("SAMP", fields + data, 64)
    last = {}
    for k in range(number % 3 + 1):
        last["antenna"], before = len(out), last.get("antenna", 0)
        fields = struct.pack("<Qq128sddII", k, before, name128("dish"), 48.0, 11.0, 1, 1)
        out += chunk("ANTA", fields + bytes(64) + bytes(16))
    for k in range(number % 4 + 1):
        last["types"], before = len(out), last.get("types", 0)
        out += chunk("MDTT", struct.pack("<Qq", k, before) + type_definition())
    for k in range(number % 5 + 1):
        last["preview"], before = len(out), last.get("preview", 0)
        fields = struct.pack("<BB6x16q16d16Q", k, 1, before, *[0] * 15, *[0.0] * 16, *[0] * 16)
        out += chunk("SPRV", fields)
    foot = len(out)
    out += chunk("STRT", struct.pack("<qqqQQIII4xdqq", 24, 0, last["preview"], 50, 8, 1, 1, 1, 2.0, last["antenna"], last["types"]))
    return out + chunk("DSFT", struct.pack("<dqI", 1.7e9, foot, 1))


def broken_bytes(number: int, vectors: list) -> bytes:
    """Noise, nothing at all, or a file that ends inside a chunk."""
    cut = chunk("DSFH", struct.pack("<d", 1.7e9)) + chunk("STRM", struct.pack("<Qdqd", 7, 1.7e9, 0, 2.0))
    fields = struct.pack("<QIBBBbddIIII", 7, 1, 5, 19, 2, 0, 0.0, 1.0, 0, 2, 1, 32)
    cut += struct.pack("<4sIIHH", b"SAMP", 100_000, 0, 1, 64) + fields + np.asarray(vectors[0], "<f4").tobytes()
    return (NOISE * (number + 10), b"", cut)[number % 3]


def survey_lake(spark: SparkSession, sf: str) -> str:
    return lake(spark, sf, "survey", survey_bytes)


def broken_lake(spark: SparkSession, sf: str) -> str:
    return lake(spark, sf, "broken", broken_bytes)


def capture_lake(spark: SparkSession, sf: str) -> str:
    return lake(spark, sf, "capture", capture_bytes)


def lake(spark: SparkSession, sf: str, kind: str, made) -> str:
    """Folder of one kind of file of a scale, written once per session."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key in _written:
        return _written[key]
    folder = shared_folder(spark, f"{kind}s")
    system, inner = filesystem(folder)
    system.create_dir(inner, recursive=True)

    def write(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")
        number = group.column("number")[0].as_py()
        data = made(number, group.column("embedding").to_pylist())
        fs, base = filesystem(folder)
        name = f"{base}/{kind}-{number}.rf"
        # A retried task writes the same bytes, and a reader never sees half a file.
        with fs.open_output_stream(name + ".part") as f:
            f.write(data)
        fs.move(name + ".part", name)
        return pa.table({"number": pa.array([number], pa.int64()), "bytes": pa.array([len(data)], pa.int64())})

    v = table(spark, sf, "embeddings").select("vec_id", "embedding", F.expr(f"vec_id div {PER_FILE}").alias("number"))
    v.groupBy("number").applyInArrow(write, "number bigint, bytes bigint").agg(F.sum("bytes")).collect()
    _written[key] = folder
    return folder
