"""Capture files as a table of chunks, and typed views of each kind.

A file is hopped through by chunk sizes, so only headers are read, never
samples. The driver lists paths and nothing else.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In

from rfspark.functions.tables import CHUNK_IDS, MAX_CHUNK_BYTES
from rfspark.session import shared_folder
from rfspark.sources.files import Files, filesystem, listed, packed

SCHEMA = (
    "file string, offset bigint, id string, size bigint, flags bigint, version int, header_size int, "
    "fields string, error string"
)
HEADER = struct.Struct("<4sIIHH")
KNOWN = re.compile(b"|".join(i.encode() for i in CHUNK_IDS))
SEARCH_BYTES = 1 << 20
TAIL_BYTES = 1024
SPLIT_BYTES = 1 << 30
MAX_TYPE_DEPTH = 32
MAX_TYPE_FIELDS = 4096
MAX_TYPE_BYTES = 16 << 20
TYPE_NAMES = ["none", "bool", "integer", "float", "string", "vector", "array", "object"]

# Fixed layouts after the 16-byte header: names, struct format, smallest chunk size.
# 128-byte names end at the first zero bytes; an underscore is padding.
LAYOUTS = {
    "DSFH": ("<d", ["creation_time"], 24),
    "DSFT": ("<dqI", ["completion_time", "stream_offset", "num_streams"], 36),
    "STRM": ("<Qdq", ["stream_id", "start_time", "stream_offset"], 40),
    "SSTR": (
        "<QI4xqddddddII128sQQ",
        [
            "stream_id", "sub_stream_id", "sub_stream_offset", "frequency_start", "frequency_step",
            "frequency_span", "value_minimum", "value_maximum", "direction", "antenna_index",
            "num_categories", "name", "antenna_id", "metadata_id",
        ],
        240,
    ),
    "SSCA": ("<128sI4Bdd", ["name", "flags", "red", "green", "blue", "alpha", "start_frequency", "end_frequency"], 168),
    "ANTA": (
        "<Qq128sddII16f16s",
        ["antenna_id", "antenna_offset", "name", "latitude", "longitude", "flags", "num_segments"]
        + [f"t{k}" for k in range(16)]
        + ["uuid"],
        264,
    ),
    "ANTS": ("<128s4fI", ["name", "o0", "o1", "o2", "o3", "id"], 164),
    "MDTT": ("<Qq", ["metadata_id", "metadata_offset"], 32),
    "SPRV": (
        "<BB6x16q16d16Q",
        ["level", "count"] + [f"{n}{k}" for n in ("offset", "time", "sample") for k in range(16)],
        408,
    ),
    "STRT": (
        "<qqqQQIII4xd",
        [
            "stream_offset", "sub_stream_offset", "preview_offset", "num_samples", "payload_size",
            "preview_levels", "num_previews", "num_preview_segments", "end_time",
        ],
        80,
    ),
    "SAMP": (
        "<QIBBBbddIIII",
        [
            "stream_id", "sub_stream_id", "sample_type", "unit", "payload_type", "compression", "start_time",
            "end_time", "packet_flags", "sample_size", "sample_depth", "num_samples",
        ],
        64,
    ),
}
MAX_CAPTURE_START_S = 3.2e8


def _text(raw: bytes) -> str:
    return raw.rstrip(b"\0").decode("utf-8", "replace")


def _types(data: bytes) -> list:
    """A nested type definition as flat rows of path, type and count."""
    rows = []

    def take(at, path, depth):
        if depth > MAX_TYPE_DEPTH:
            raise ValueError("type definition nested too deep")
        ident, kind, flags, count = struct.unpack_from("<QBII", data, at)
        if kind >= len(TYPE_NAMES):
            raise ValueError(f"unknown type {kind}")
        rows.append({"path": path, "type_id": ident, "type": TYPE_NAMES[kind], "flags": flags, "count": count, "depth": depth})
        at += 17
        if kind == 7 and count > MAX_TYPE_FIELDS:
            raise ValueError("too many fields")
        for _ in range(count if kind == 7 else 1 if kind in (5, 6) else 0):
            name = _text(data[at : at + 128])
            at = take(at + 132, f"{path}/{name}", depth + 1)
        return at

    take(0, "", 0)
    return rows


def parse_fields(ident: str, size: int, body: bytes) -> dict:
    """Named fields of one chunk; raises ``ValueError`` or ``struct.error`` for a bad one."""
    layout, names, least = LAYOUTS[ident]
    if size < least:
        raise ValueError(f"{ident} chunk of {size} bytes is smaller than {least}")
    out = dict(zip(names, struct.unpack_from(layout, body)))
    if "name" in out:
        out["name"] = _text(out["name"])
    if "uuid" in out:
        out["uuid"] = out["uuid"].hex()
    end = struct.calcsize(layout)
    if ident == "DSFT":
        out["stream_offset"] = max(0, out["stream_offset"])
    elif ident == "STRM" and size == 48:
        start = struct.unpack_from("<d", body, end)[0]
        out["capture_start"] = start if 0 <= start < MAX_CAPTURE_START_S else None
    elif ident == "STRT":
        for k, name in enumerate(("antenna_offset", "metadata_offset")):
            room = size - 16 >= end + 8 * (k + 1)
            out[name] = struct.unpack_from("<q", body, end + 8 * k)[0] if room else 0
    elif ident == "MDTT":
        if size - 32 > MAX_TYPE_BYTES:
            raise ValueError("type definition too large")
        out["types"] = _types(body[16:]) if size > 32 else []
    elif ident == "SPRV":
        out = {
            "level": out["level"],
            "count": out["count"],
            **{f"{n}s": [out[f"{n}{k}"] for k in range(16)] for n in ("offset", "time", "sample")},
        }
    return out


def _resync(f, at: int, end: int) -> int:
    """Place of the first known chunk id from ``at`` on, or the end.

    Read straight on; the last three bytes are kept, as an id may lie across two reads.
    """
    f.seek(at)
    kept = b""
    while block := f.read(SEARCH_BYTES):
        window = kept + block
        if hit := KNOWN.search(window):
            return min(at - len(kept) + hit.start(), end)
        at, kept = at + len(block), window[-3:]
    return end


def _first_chunk(f, end: int) -> int:
    """Where to start. A file that opens with raw samples says in its tail where its chunks are."""
    f.seek(0)
    if KNOWN.match(f.read(4)):
        return 0
    start = max(0, end - TAIL_BYTES)
    f.seek(start)
    tail = f.read(end - start)
    at = tail.rfind(b"DSFT")
    if at >= 0 and len(tail) - at >= 32:
        offset = struct.unpack_from("<q", tail, at + 24)[0]
        if 0 < offset < end:
            return _resync(f, max(0, offset - TAIL_BYTES), end)
    return _resync(f, 0, end)


def _chunks_between(f, path: str, at: int, stop: int, end: int, wanted=None):
    """Rows of the chunks that begin from ``at`` on and before ``stop``; returns the first sound chunk's place after.

    A place where a chunk should be but whose size cannot be one is a row with an
    ``error``, as is a chunk that the file ends inside of (its fields are kept).
    Fields are read of ``wanted`` kinds only, of all where it is None.
    """
    expected = False
    while at < end:
        f.seek(at)
        head = f.read(HEADER.size)
        if len(head) < HEADER.size:
            return end
        raw, size, flags, version, header_size = HEADER.unpack(head)
        known = KNOWN.fullmatch(raw)
        if not known or not 16 <= size <= MAX_CHUNK_BYTES:
            if known and expected:
                yield path, at, raw.decode(), size, flags, version, header_size, None, "size of no chunk"
            at, expected = _resync(f, at + 1, end), False
            continue
        if at >= stop:
            return at
        ident, fields, error = raw.decode(), None, None
        if wanted is None or ident in wanted:
            body = size - 16 if ident == "MDTT" else 512
            try:
                if ident == "SAMP" and not 64 <= header_size <= size:
                    raise ValueError("SAMP header size is invalid")
                fields = json.dumps(parse_fields(ident, size, f.read(min(size - 16, body, MAX_TYPE_BYTES + 16))))
                if at + size > end:
                    error = "the file ends inside this chunk"
            except (ValueError, struct.error) as e:
                error = str(e)
        yield path, at, ident, size, flags, version, header_size, fields, error
        at, expected = at + size, True
    return end


def _nothing(path: str, end: int):
    """The one row of a file without a chunk, so that no file is missing from a table of chunks."""
    return path, 0, "none", end, 0, 0, 0, None, "no chunk in this file" if end else "empty file"


def chunks_of(path: str, wanted=None):
    """Rows of one file's chunks, in file order; one row of id ``none`` where it has no chunk."""
    system, inner = filesystem(path)
    with system.open_input_file(inner) as f:
        end, found = f.size(), False
        for row in _chunks_between(f, path, _first_chunk(f, end), end, end, wanted):
            found = True
            if wanted is None or row[2] in wanted:
                yield row
        if not found and (wanted is None or "none" in wanted):
            yield _nothing(path, end)


def _batches(rows, schema: str):
    """Arrow batches of a few thousand rows."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]
    rows = iter(rows)
    while some := list(itertools.islice(rows, 4096)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=names)


class ChunkReader(DataSourceReader):
    """Whole files, a group of small ones to a task.

    Filters on ``file`` choose the files to list, filters on ``id`` the kinds whose bodies are read. Spark reads by a ``ChunkScan``.
    """

    def __init__(self, options):
        options = {k.lower(): v for k, v in options.items()}
        self.path, self.suffix = options["path"], options.get("suffix", "")
        self.below = int(options.get("below", 1 << 62))
        self.files = self.kinds = None

    def pushFilters(self, filters):
        for one in filters:
            values = {one.value} if isinstance(one, EqualTo) else set(one.value) if isinstance(one, In) else None
            if values is not None and one.attribute == ("file",):
                self.files = values if self.files is None else self.files & values
            elif values is not None and one.attribute == ("id",):
                self.kinds = values if self.kinds is None else self.kinds & values
            else:
                yield one

    def partitions(self):
        files = [x for x in listed(self.path, self.suffix) if x[1] <= self.below and (self.files is None or x[0] in self.files)]
        return packed(files) or [Files([])]

    def read(self, partition):
        return _batches((row for name in partition.names for row in chunks_of(name, self.kinds)), SCHEMA)


class ChunkScan(DataSourceReader):
    """A ``ChunkReader`` whose files and kinds are chosen by the options ``file`` and ``id`` (JSON lists).

    Spark keeps one reader for all scans of a frame: filters that it pushed into one of
    them would hold in the others, too. So it is shown none to push.
    """

    def __init__(self, options):
        chosen = [(k.lower(), v) for k, v in options.items() if k.lower() in ("file", "id")]
        self.chunks = ChunkReader(options)
        list(self.chunks.pushFilters([In((k,), tuple(json.loads(v))) for k, v in chosen]))

    def partitions(self):
        return self.chunks.partitions()

    def read(self, partition):
        return self.chunks.read(partition)


class ChunkSource(DataSource):
    """``spark.read.format("rf_chunks").load(path)``."""

    @classmethod
    def name(cls):
        return "rf_chunks"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ChunkScan(self.options)


def scan_chunks(
    spark: SparkSession, path: str, suffix: str = "", split_bytes: int = SPLIT_BYTES, files=None, kinds=None
) -> DataFrame:
    """Chunks of all files. A file of more than ``split_bytes`` is read by a task per stretch of that size.

    ``files`` are the only ones that are opened and ``kinds`` the only ones whose bodies are read; None is all.
    """
    spark.dataSource.register(ChunkSource)
    chosen = {k: json.dumps(sorted(v)) for k, v in (("file", files), ("id", kinds)) if v is not None}
    small = spark.read.format("rf_chunks").options(suffix=suffix, below=split_bytes, **chosen).load(path)
    large = [x for x in listed(path, suffix) if x[1] > split_bytes and (files is None or x[0] in files)]
    if not large:
        return small
    rows = _scan_stretches(spark, large, split_bytes)
    return small.unionByName(rows if kinds is None else rows.filter(F.col("id").isin(*kinds)))


STRETCH = "file string, size bigint, start bigint, stop bigint, entry bigint"
FOUND = SCHEMA + ", start bigint, entry bigint, exit bigint"


def _read_stretches(batches):
    """Chunks of each stretch, and a row without an id that says where its chain began and left it."""
    for batch in batches:
        for path, size, start, stop, entry in zip(*(c.to_pylist() for c in batch.columns)):
            yield from _batches(_stretch(path, size, start, stop, entry), FOUND)


def _stretch(path, size, start, stop, entry):
    system, inner = filesystem(path)
    with system.open_input_file(inner) as f:
        if entry is None:
            # A guess: the first place that looks like a sound chunk.
            places = _chunks_between(f, path, start if start else _first_chunk(f, size), 0, size, ())
            entry = _drained(places)
        chain = _chunks_between(f, path, entry, stop, size)
        while True:
            try:
                row = next(chain)
            except StopIteration as done:
                yield *(path, entry, None, 0, 0, 0, 0, None, None), start, entry, done.value
                return
            yield *row, start, entry, None


def _drained(places):
    try:
        while True:
            next(places)
    except StopIteration as done:
        return done.value


def _scan_stretches(spark: SparkSession, files: list, split: int) -> DataFrame:
    """Chunks of large files, every stretch of a file read by its own task.

    A task guesses where the first chunk in its stretch is and hops on from there, so
    a stretch is a map from one entry to one exit. The true entry is where the
    stretch before was left; following that from the front of each file tells
    which guesses hold, which stretches lie inside one chunk, and which must be read again from
    another entry (samples that look like a chunk, at the very border). The driver holds
    three numbers a stretch, 100 000 of them for 100 TB.
    """
    todo = [(name, size, at, min(at + split, size), None) for name, size in files for at in range(0, size, split)]
    stops = {(t[0], t[2]): t[3] for t in todo}
    known: dict = {}
    tables, chosen = [], []
    while todo:
        ask = spark.createDataFrame(todo, STRETCH).repartition(len(todo), "file", "start")
        found = ask.mapInArrow(_read_stretches, FOUND)
        folder = shared_folder(spark, "stretches")
        found.write.parquet(folder)
        table = spark.read.schema(found.schema).parquet(folder)
        tables.append(table)
        for r in table.filter("id is null").select("file", "start", "entry", "exit").toLocalIterator():
            known[r["file"], r["start"]] = (r["entry"], r["exit"])
        todo, chosen = [], []
        for name, size in files:
            entry = known[name, 0][0]
            for at in range(0, size, split):
                if entry >= stops[name, at]:
                    continue
                if known[name, at][0] != entry:
                    todo.append((name, size, at, stops[name, at], entry))
                    break
                chosen.append((name, at, entry))
                entry = known[name, at][1]
    used = spark.createDataFrame(chosen, "file string, start bigint, entry bigint")
    rows = functools.reduce(DataFrame.unionByName, tables).filter("id is not null")
    rows = rows.join(used, ["file", "start", "entry"], "left_semi").select(*[c.split()[0] for c in SCHEMA.split(", ")])
    empty = [_nothing(name, size) for name, size in files if known[name, 0][0] >= size]
    return rows.unionByName(spark.createDataFrame(empty, SCHEMA)) if empty else rows


def chunk_table(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """The chunks of all files as a written table, partitioned by kind.

    The files are hopped through once; a view of a kind then reads that kind only.
    """
    folder = shared_folder(spark, "chunks")
    found = scan_chunks(spark, path, suffix)
    found.write.partitionBy("id").parquet(folder)
    return spark.read.schema(found.schema).parquet(folder).select(*found.columns)


VIEWS = {
    "DSFH": "creation_time double",
    "DSFT": "completion_time double, stream_offset bigint, num_streams bigint",
    "STRM": "stream_id bigint, start_time double, stream_offset bigint, capture_start double",
    "SSTR": (
        "stream_id bigint, sub_stream_id bigint, sub_stream_offset bigint, frequency_start double, "
        "frequency_step double, frequency_span double, value_minimum double, value_maximum double, "
        "direction double, antenna_index bigint, num_categories bigint, name string, antenna_id bigint, metadata_id bigint"
    ),
    "SSCA": "name string, flags bigint, red int, green int, blue int, alpha int, start_frequency double, end_frequency double",
    "ANTA": (
        "antenna_id bigint, antenna_offset bigint, name string, latitude double, longitude double, flags bigint, "
        "num_segments bigint, uuid string, " + ", ".join(f"t{k} float" for k in range(16))
    ),
    "ANTS": "name string, o0 float, o1 float, o2 float, o3 float, id bigint",
    "MDTT": (
        "metadata_id bigint, metadata_offset bigint, "
        "types array<struct<path:string,type_id:bigint,type:string,flags:bigint,count:bigint,depth:int>>"
    ),
    "SPRV": "level int, count int, offsets array<bigint>, times array<double>, samples array<bigint>",
    "STRT": (
        "stream_offset bigint, sub_stream_offset bigint, preview_offset bigint, num_samples bigint, "
        "payload_size bigint, preview_levels bigint, num_previews bigint, num_preview_segments bigint, "
        "end_time double, antenna_offset bigint, metadata_offset bigint"
    ),
    "SAMP": (
        "stream_id bigint, sub_stream_id bigint, sample_type int, unit int, payload_type int, compression int, "
        "start_time double, end_time double, packet_flags bigint, sample_size bigint, sample_depth bigint, num_samples bigint"
    ),
}


def view(chunks: DataFrame, kind: str) -> DataFrame:
    """Chunks of one kind with typed columns."""
    one = chunks.filter((F.col("id") == kind) & F.col("fields").isNotNull())
    fields = F.from_json("fields", VIEWS[kind])
    base = one.select("file", F.col("offset").alias("chunk_offset"), "size", "header_size", F.explode(F.array(fields)).alias("f"))
    return base.select("file", "chunk_offset", "size", "header_size", "f.*")
