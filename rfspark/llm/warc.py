"""WARC archives with a two-level capture index.

Writing: each task writes the records of its rows to archives of its own, one
gzip member per record, and reports where each record lies. Of records with
equal payloads of at least ``REVISIT_BYTES`` bytes the one with the smallest id
is a response, the others are revisits that refer to it.

Index: captures are sorted by (URL key with the host reversed, id), cut into
gzip blocks of ``BLOCK_LINES`` lines, and each index file ends with a sparse
directory of its blocks: first key, offset, length. Level one tells which index
file holds a key: one line per file, as many as the index has partitions.

Look-up: the keys asked for are sent to the index file that may hold them; a
task binary-searches that file's directory, range-reads the block, and finds the
line. Records are then read by range from the archives, in order of place.

Archives and index files go to the shared folder through its own file system.
Names are new for every attempt of a task, and only what the attempt that
counted reports is read, so a lost executor leaves at most a stray file.

A null payload is empty, a null URL gets a key and a target of its own. A null
id sorts first and is written as an empty name. Rows that repeat id and payload
are captures of their own; those with the smallest id are all responses. Other
columns are not looked at. An empty table gives no archives.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rfspark.llm.common import cut, stretches
from rfspark.session import shared_folder
from rfspark.sources.files import filesystem

REVISIT_BYTES = 100
BLOCK_LINES = 2000
ARCHIVE_BYTES = 1 << 30
TEXT_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"  # of captures whose table has no time


def url_key(url: str | None) -> str:
    """The URL with its host reversed (``com,example)/path``), lower-case, without scheme, port 80/443 and fragment.

    Spaces and control characters are escaped: in the index, a key ends at its first space, the lowest character of all.
    """
    if not url:
        return "-"
    rest = url.split("://", 1)[-1].split("#", 1)[0].lower()
    cut_at = min((rest.find(c) for c in "/?" if c in rest), default=len(rest))
    host, path = rest[:cut_at], rest[cut_at:] or "/"
    host = host.rsplit("@", 1)[-1]
    name, _, port = host.partition(":")
    name = ",".join(reversed(name.removeprefix("www.").split(".")))
    key = name + (f":{port}" if port not in ("", "80", "443") else "") + ")" + path
    return re.sub("[\0-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", key)


def _place(key: str, row) -> str:
    """What the index is sorted by: the key and the id, at fixed width."""
    return f"{key} {'' if row is None else format(row + (1 << 63), '020d')}"


def _name(row) -> str:
    return f"<urn:uuid:{uuid.UUID(int=(row or 0) & (1 << 64) - 1)}>" if row is not None else "<urn:uuid:->"


def record(row, url, payload: bytes, digest: str, refers: int | None, refers_url: str | None) -> bytes:
    """One WARC record. A revisit holds the headers of the response, not its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: {_name(row)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_line(url) if url else 'urn:none:' + str(row)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_name(refers)}",
            f"WARC-Refers-To-Target-URI: {_line(refers_url) if refers_url else 'urn:none:' + str(refers)}",
            f"WARC-Refers-To-Date: {DATE}",
        ]
        payload = b""
    lines.append(f"Content-Length: {len(http) + len(payload)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def _line(url: str) -> str:
    return url.replace("\r", "%0D").replace("\n", "%0A")


def parsed(raw: bytes) -> tuple[dict, dict, bytes]:
    """A record's headers, the HTTP headers inside, and the payload it holds."""
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    inner, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in inner.decode().split("\r\n")[1:]), payload


def _id_of(name: str) -> int | None:
    text = name.removeprefix("<urn:uuid:").removesuffix(">")
    if text == "-":
        return None
    value = uuid.UUID(text).int
    return value - (1 << 64) if value >> 63 else value


def write(pages: DataFrame, id_col="page_id", url_col="url", payload_col="html") -> DataFrame:
    """Write every row as a record; gives ``id, key, file, offset, length`` of each, as a written table."""
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    sized = rows.where(F.octet_length("payload") >= REVISIT_BYTES)
    same = sized.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("id").alias("i"), F.col("url").alias("u"))).alias("first")
    )
    # Written, so that the join's two sides are plain shuffles, whose hot keys Spark can split.
    same = cut(same.where("n > 1").select("digest", "first"), "warc")
    rows = rows.join(same, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first.i")) & F.col("first.i").isNotNull()
    rows = rows.select("id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers"))
    folder = shared_folder(pages.sparkSession, "warc")

    def run(batches):
        system, inner = filesystem(folder)
        system.create_dir(inner, recursive=True)
        out, name, at = None, None, 0
        try:
            for batch in batches:
                for part in stretches(batch, 2, TEXT_BYTES):
                    made = []
                    for row in part.to_pylist():
                        if out is None or at >= ARCHIVE_BYTES:
                            if out is not None:
                                out.close()
                            name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                            out = system.open_output_stream(f"{inner}/{name}", compression=None)
                        first = row["refers"] or {}
                        raw = record(row["id"], row["url"], row["payload"], row["digest"], first.get("i"), first.get("u"))
                        packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                        raw = packer.compress(raw) + packer.flush()
                        out.write(raw)
                        made.append((row["id"], url_key(row["url"]), name, at, len(raw)))
                        at += len(raw)
                    columns = list(zip(*made))
                    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
        finally:
            if out is not None:
                out.close()

    names = ["id", "key", "file", "offset", "length"]
    placed = cut(rows.mapInArrow(run, "id long, key string, file string, offset long, length long"), "warc")
    return placed.withColumn("folder", F.lit(folder))


def build_index(captures: DataFrame) -> DataFrame:
    """Index files over captures; gives level one: ``shard, first, file, directory, length`` of each file, written."""
    spark = captures.sparkSession
    folder = shared_folder(spark, "warc-index")
    rows = captures.select("key", "id", "folder", "file", "offset", "length")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartitionByRange(parts, "key", "id").sortWithinPartitions("key", "id", "file", "offset")

    def run(batches):
        system, inner = filesystem(folder)
        lines, first, blocks, at, out, name = [], None, [], 0, None, None

        def flush():
            nonlocal lines, at
            raw = gzip.compress("\n".join(lines).encode("utf-8", "surrogatepass"), 6, mtime=0)
            out.write(raw)
            blocks.append((lines[0].rsplit(" ", 1)[0], at, len(raw)))
            at += len(raw)
            lines = []

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    system.create_dir(inner, recursive=True)
                    name = f"{uuid.uuid4().hex}.cdx.gz"
                    out = system.open_output_stream(f"{inner}/{name}", compression=None)
                    first = _place(row["key"], row["id"])
                where = json.dumps([row["folder"], row["file"], row["offset"], row["length"]], separators=(",", ":"))
                lines.append(f"{_place(row['key'], row['id'])} {where}")
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        directory = gzip.compress(json.dumps(blocks).encode(), 6, mtime=0)
        out.write(directory)
        out.close()
        columns = [[first], [f"{folder}/{name}"], [at], [len(directory)]]
        types = (pa.string(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    names = ["first", "file", "directory", "length"]
    return cut(rows.mapInArrow(run, "first string, file string, directory long, length long"), "warc-index")


def look_up(asked: DataFrame, index: DataFrame) -> DataFrame:
    """``id, key, archive, offset, length`` for every (``id``, ``key``) asked for that the index holds.

    A pair that the index holds several times comes back as often for each asking.
    """
    level_one = sorted((r["first"], r["file"], r["directory"], r["length"]) for r in index.collect())
    firsts = [x[0] for x in level_one]

    def routed(batches):
        for batch in batches:
            places = [_place(k, i) for i, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            # Captures equal in key and id may go on in the next files.
            lo = [max(0, bisect.bisect_left(firsts, p) - 1) for p in places]
            hi = [bisect.bisect_right(firsts, p) for p in places]
            rows = np.repeat(np.arange(len(places)), [b - a for a, b in zip(lo, hi)])
            shard = [s for a, b in zip(lo, hi) for s in range(a, b)]
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(shard, pa.int32())], ["id", "key", "shard"])

    rows = asked.select("id", "key").mapInArrow(routed, "id long, key string, shard int")
    parts = max(1, int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # A file that is asked for much is searched by several tasks.
    rows = rows.repartitionByRange(parts, "shard", "key", "id").sortWithinPartitions("shard", "key", "id")

    def searched(batches):
        shard, blocks, starts, source, held = None, None, None, None, (None, None, None)
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    shard = row["shard"]
                    _, file, directory, length = level_one[shard]
                    system, inner = filesystem(file)
                    source = system.open_input_file(inner)
                    blocks = json.loads(gzip.decompress(source.read_at(length, directory)))
                    starts = [b[0] for b in blocks]
                    held = (None, None, None)
                place = _place(row["key"], row["id"])
                k = max(0, bisect.bisect_left(starts, place) - 1)
                while k < len(blocks) and starts[k] <= place:
                    if held[0] != (shard, k):
                        raw = gzip.decompress(source.read_at(blocks[k][2], blocks[k][1])).decode("utf-8", "surrogatepass")
                        lines = raw.split("\n")
                        held = ((shard, k), [x.rsplit(" ", 1)[0] for x in lines], lines)
                    at = bisect.bisect_left(held[1], place)
                    while at < len(held[1]) and held[1][at] == place:
                        folder, name, offset, size = json.loads(held[2][at].rsplit(" ", 1)[1])
                        made.append((row["id"], row["key"], f"{folder}/{name}", offset, size))
                        at += 1
                    k += 1
            columns = list(zip(*made)) or [()] * 5
            types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    names = ["id", "key", "archive", "offset", "length"]
    return rows.mapInArrow(searched, "id long, key string, archive string, offset long, length long")


def read(places: DataFrame) -> DataFrame:
    """The records at ``archive, offset, length``: ``id, record_type, target, payload_bytes, payload_digest, refers_to, payload``.

    A response's digest is taken from its payload; one that differs from its
    header is an error. A revisit has no payload of its own (null).
    """
    parts = max(1, int(places.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = places.select("archive", "offset", "length")
    rows = rows.repartitionByRange(parts, "archive", "offset").sortWithinPartitions("archive", "offset")

    def run(batches):
        archive, source = None, None
        for batch in batches:
            made, size = [], 0
            for row in batch.to_pylist():
                if row["archive"] != archive:
                    archive = row["archive"]
                    system, inner = filesystem(archive)
                    source = system.open_input_file(inner)
                fields, inside, payload = parsed(gzip.decompress(source.read_at(row["length"], row["offset"])))
                digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                kind, refers = fields["WARC-Type"], fields.get("WARC-Refers-To")
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"{fields['WARC-Record-ID']} in {archive} is damaged")
                made.append(
                    (
                        _id_of(fields["WARC-Record-ID"]),
                        kind,
                        fields["WARC-Target-URI"],
                        int(inside["Content-Length"]),
                        digest,
                        _id_of(refers) if refers else None,
                        payload if kind == "response" else None,
                    )
                )
                size += len(payload)
                if size >= TEXT_BYTES:
                    yield _records(made)
                    made, size = [], 0
            if made:
                yield _records(made)

    return rows.mapInArrow(run, ", ".join(f"{n} {t}" for n, t, _ in RECORD))


RECORD = [
    ("id", "long", pa.int64()),
    ("record_type", "string", pa.string()),
    ("target", "string", pa.string()),
    ("payload_bytes", "long", pa.int64()),
    ("payload_digest", "string", pa.string()),
    ("refers_to", "long", pa.int64()),
    ("payload", "binary", pa.binary()),
]


def _records(made) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, (_, _, t) in zip(zip(*made), RECORD)]
    return pa.RecordBatch.from_arrays(columns, [n for n, _, _ in RECORD])


def keys_of(pages: DataFrame, id_col="page_id", url_col="url") -> DataFrame:
    """``id, key`` of every row, to ask an index for."""

    def run(batches):
        for batch in batches:
            keys = [url_key(u) for u in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.string())], ["id", "key"])

    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").alias("url"))
    return rows.mapInArrow(run, "id long, key string")
