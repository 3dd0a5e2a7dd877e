"""Raw dumps of a packet stream as a table of framed packets.

A packet is a JSON header, a separator (LF RS, RS or LF) and its payload. Framing
goes through a file in order; a large file is cut into stretches, each framed
from the first header in it. That gives the same packets unless a payload holds
a whole valid header of its own right at a cut. A task takes several stretches, so
how fine files are cut does not set the number of tasks.
"""

from __future__ import annotations

import io
import json
import re
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from rfspark.functions.tables import IQ_BYTES, MAX_HEADER_BYTES, MAX_PAYLOAD_BYTES
from rfspark.operators.headers import PAYLOADS, REQUIRED
from rfspark.sources.files import filesystem, listed

SCHEMA = "file string, seq bigint, header string, payload binary, rejected bigint, error string"
RECORD, LINE = 0x1E, 0x0A
OPENING = re.compile(rb'\{[ \t\r\n]*["}]')
READ_BYTES = 1 << 20
BATCH_BYTES = 32 << 20
TASK_BYTES = 32 << 20  # in a task, unless one stretch is longer
TASKS = 64  # among which fewer bytes are shared out


@dataclass
class Stretch(InputPartition):
    """Headers that begin in ``start..stop`` of a file, for several such stretches."""

    parts: list

    def __init__(self, parts):
        super().__init__(0)
        self.parts = parts


def header_of(raw: bytes):
    """A parsed header, or nothing if the bytes are none."""
    try:
        h = json.loads(raw)
    except ValueError:
        return None
    if not isinstance(h, dict) or h.get("payload") not in PAYLOADS:
        return None
    numbers = [h.get(n) for n in REQUIRED if n != "unit"]
    if not isinstance(h.get("unit"), str) or not all(isinstance(x, (int, float)) and not isinstance(x, bool) for x in numbers):
        return None
    n = h.get("samples")
    good = isinstance(n, list) or (isinstance(n, (int, float)) and not isinstance(n, bool) and 0 <= n < 2**64)
    return h if good else None


def payload_bytes(h: dict, width: int):
    """Declared payload size, or nothing where it has none."""
    n = len(h["samples"]) if isinstance(h["samples"], list) else int(h["samples"])
    if h["payload"] == "iq":
        return n * width
    if h["payload"] == "categories":
        c = h.get("categories")
        return max(n, 1) * (len(c) if c is not None else h["sampleSize"]) * (width // 2)
    if (h.get("compression") or 0) > 0:
        return None
    return n * h["sampleSize"] * max(h.get("sampleDepth") or 1, 1) * (width // 2)


class Framer:
    """Packets of one stretch of one file."""

    def __init__(self, f, start: int, stop: int, width):
        self.f, self.base, self.stop, self.width = f, start, stop, width
        self.buf, self.pos = bytearray(), 0
        f.seek(start)

    def more(self) -> bool:
        if self.pos > READ_BYTES:
            del self.buf[: self.pos]
            self.base, self.pos = self.base + self.pos, 0
        got = self.f.read(READ_BYTES)
        self.buf += got
        return bool(got)

    def terminator(self, at: int) -> int:
        """Place of the separator after ``at``; -1 at the end of the file, -2 if none is near enough for a header."""
        look = at
        while True:
            ends = [e for e in (self.buf.find(RECORD, look), self.buf.find(LINE, look)) if e >= 0]
            if ends:
                return min(ends)
            look, shift = len(self.buf), self.pos
            if look - at > MAX_HEADER_BYTES:
                return -2
            if not self.more():
                return -1
            at, look = at - (shift - self.pos), look - (shift - self.pos)

    def packets(self):
        rejected = 0
        while True:
            at = self.buf.find(b"{", self.pos)
            if at < 0:
                self.pos = len(self.buf)
                if self.base + self.pos >= self.stop or not self.more():
                    return
                continue
            if self.base + at >= self.stop:
                return
            self.pos = at
            end = self.terminator(at)
            at, header = self.pos, None
            if end == -1:
                yield self.base + at, None, b"", rejected, "header cut short by the end of the file"
                return
            if end == -2:
                yield self.base + at, None, b"", rejected, "no header ends within the cap"
                # Nor does one that begins earlier than the cap before what was searched.
                self.pos = max(at + 1, len(self.buf) - MAX_HEADER_BYTES)
                rejected = 0
                continue
            while 0 <= at < end and self.base + at < self.stop:
                # Braces that cannot open a header are passed over without a look at what follows.
                opens = OPENING.search(self.buf, at, end)
                here = opens.start() if opens else end
                rejected += self.buf.count(b"{", at, here)
                at = here
                if at >= end or self.base + at >= self.stop:
                    break
                raw = bytes(self.buf[at:end])
                header = header_of(raw)
                if header is not None:
                    break
                rejected += 1
                at = self.buf.find(b"{", at + 1, end)
            if header is None:
                self.pos = end + 1
                continue
            place = self.base + at
            if end + 1 >= len(self.buf):
                self.pos = at
                shift = self.pos
                self.more()
                end -= shift - self.pos
            body = end + 1
            if self.buf[end] == LINE and self.buf[body : body + 1] == bytes([RECORD]):
                body += 1
            self.pos = body
            size = payload_bytes(header, self.width) if self.width else 0
            error = None
            if size is None:
                size, error = 0, "compressed payload carries no byte length"
            elif size > MAX_PAYLOAD_BYTES:
                size, error = 0, "payload size over the cap"
            while len(self.buf) - self.pos < size:
                if not self.more():
                    error = error or "payload shorter than declared"
                    break
            payload = bytes(self.buf[self.pos : self.pos + size])
            self.pos += len(payload)
            yield place, raw.decode("utf-8", "replace"), payload, rejected, error
            rejected = 0


class DumpReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.suffix = options["path"], options.get("suffix", "")
        self.width = IQ_BYTES.get(options.get("format", "int16").lower())
        self.split = int(options.get("splitbytes", 1 << 30))

    def partitions(self):
        files = listed(self.path, self.suffix)
        most = min(TASK_BYTES, sum(n for _, n in files) // TASKS)
        out, held, size = [], [], 0
        for name, n in files:
            for start in range(0, n, self.split):
                stop = min(n, start + self.split)
                if held and size + stop - start > most:
                    out.append(Stretch(held))
                    held, size = [], 0
                held.append((name, start, stop))
                size += stop - start
        return out + ([Stretch(held)] if held else [])

    def read(self, partition):
        rows, held = [], 0
        for name, parts in groupby(partition.parts, key=lambda x: x[0]):
            system, inner = filesystem(name)
            # Stretches end in the middle of what was read; the next one begins in the buffer.
            with io.BufferedReader(system.open_input_file(inner), 4 * READ_BYTES) as f:
                framed = (p for _, start, stop in parts for p in Framer(f, start, stop, self.width).packets())
                for seq, header, payload, rejected, error in framed:
                    rows.append((name, seq, header, payload, rejected, error))
                    held += len(payload) + len(header or "")
                    if held > BATCH_BYTES:
                        yield self.batch(rows)
                        rows, held = [], 0
        if rows:
            yield self.batch(rows)

    @staticmethod
    def batch(rows):
        types = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


class DumpSource(DataSource):
    """``spark.read.format("rf_dumps").option("format", "int16").load(path)``."""

    @classmethod
    def name(cls):
        return "rf_dumps"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return DumpReader(self.options)


def scan_stream_dumps(spark: SparkSession, path: str, fmt: str, suffix: str = "", split_bytes: int = 1 << 30) -> DataFrame:
    """Framed packets of dump files. ``seq`` is the header's place in its file."""
    spark.dataSource.register(DumpSource)
    reader = spark.read.format("rf_dumps").option("format", fmt).option("suffix", suffix)
    return reader.option("splitBytes", split_bytes).load(path)
