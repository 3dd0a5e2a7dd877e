"""A landing folder as a stream with bounded micro-batches.

The stream itself carries ranges of rows, never rows: a trigger admits so many rows
and bytes, wherever that falls in a file, and tasks read the ranges. One giant file
or a whole backlog is so many micro-batches. Offsets name a file and the rows taken
from it, so a restart goes on where the last committed batch ended.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rfspark.session import ship
from rfspark.sources.files import filesystem

RANGE = "file string, first bigint, rows bigint"
RANGE_ROWS = 1 << 16
BYTES_PER_TRIGGER = 256 << 20


def _landed(path: str) -> list:
    """The folder's files in the order they landed: time, then name."""
    system, inner = filesystem(path)
    base = inner.rstrip("/")
    found = system.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True))
    return sorted(
        (f.mtime_ns or 0, path.rstrip("/") + f.path[len(base) :])
        for f in found
        if f.is_file and f.path.endswith(".parquet") and not f.path[len(base) :].lstrip("/").startswith((".", "_"))
    )


def _measured(name: str) -> tuple[int, float]:
    """A file's rows, and the bytes of one on average."""
    system, inner = filesystem(name)
    with system.open_input_file(inner) as f:
        footer = pq.read_metadata(f)
    size = sum(footer.row_group(k).total_byte_size for k in range(footer.num_row_groups))
    return footer.num_rows, size / max(footer.num_rows, 1)


class LandingReader(SimpleDataSourceStreamReader):
    """Ranges of rows from one offset on, as many as a trigger admits."""

    def __init__(self, options):
        self.path = options["path"]
        self.rows = int(options.get("rowspertrigger", 1 << 62))
        self.bytes = int(options.get("bytespertrigger", BYTES_PER_TRIGGER))

    def initialOffset(self) -> dict:
        return {"time": 0, "file": "", "row": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        out, end, rows, held = [], start, self.rows, float(self.bytes)
        for time, name in _landed(self.path):
            if (time, name) < (start["time"], start["file"]):
                continue
            total, each = _measured(name)
            at = start["row"] if (time, name) == (start["time"], start["file"]) else 0
            # At least a row a trigger, so that a row larger than the bound goes through alone.
            while at < total and rows > 0 and (held >= each or not out):
                n = min(total - at, rows, RANGE_ROWS, max(int(held // each) if each else RANGE_ROWS, 1))
                out.append((name, at, n))
                at, rows, held = at + n, rows - n, held - n * each
            if at:
                end = {"time": time, "file": name, "row": at}
            if at < total:
                break
        return iter(out), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """A batch that was planned before a restart, again."""
        for time, name in _landed(self.path):
            if not (start["time"], start["file"]) <= (time, name) <= (end["time"], end["file"]):
                continue
            at = start["row"] if (time, name) == (start["time"], start["file"]) else 0
            stop = end["row"] if (time, name) == (end["time"], end["file"]) else _measured(name)[0]
            for first in range(at, stop, RANGE_ROWS):
                yield name, first, min(RANGE_ROWS, stop - first)

    def commit(self, end: dict) -> None:
        pass


class LandingSource(DataSource):
    """``readStream.format("rf_landing").option("rowsPerTrigger", n).load(folder)``: ranges of rows."""

    @classmethod
    def name(cls):
        return "rf_landing"

    def schema(self):
        return RANGE

    def simpleStreamReader(self, schema):
        return LandingReader({k.lower(): v for k, v in self.options.items()})


def _fetch(batches, schema: pa.Schema):
    """The rows of each range; only row groups and columns that it needs are read."""
    for batch in batches:
        for name, first, rows in zip(*(batch.column(c).to_pylist() for c in range(3))):
            system, inner = filesystem(name)
            with system.open_input_file(inner) as f:
                file, at = pq.ParquetFile(f), 0
                for group in range(file.metadata.num_row_groups):
                    size = file.metadata.row_group(group).num_rows
                    if at < first + rows and at + size > first:
                        place = at
                        for part in file.iter_batches(4096, row_groups=[group], columns=schema.names):
                            lo, hi = max(first - place, 0), min(first + rows - place, part.num_rows)
                            place += part.num_rows
                            if lo < hi:
                                own = part.slice(lo, hi - lo)
                                yield pa.RecordBatch.from_arrays([own.column(n).cast(schema.field(n).type) for n in schema.names], schema.names)
                    at += size


def read_bounded(
    spark: SparkSession, path: str, schema: StructType, rows_per_trigger: int | None = None, bytes_per_trigger: int | None = None
) -> DataFrame:
    """Rows of a Parquet landing folder, so many rows and bytes (256 MB) a micro-batch.

    Files are taken in the order of their times, so a file must land whole (by a
    rename). Drive it with a processing-time trigger: Spark asks a Python source
    only once under ``availableNow``, which is one bounded batch.
    """
    ship(spark)
    spark.dataSource.register(LandingSource)
    reader = spark.readStream.format("rf_landing")
    if rows_per_trigger:
        reader = reader.option("rowsPerTrigger", rows_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("bytesPerTrigger", bytes_per_trigger)
    arrow = to_arrow_schema(schema)
    ranges = reader.load(path).repartition("file", "first")
    return ranges.mapInArrow(lambda batches: _fetch(batches, arrow), schema)
