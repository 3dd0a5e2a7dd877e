"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rfspark.session import cut, ship

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

__all__ = ["UPPER", "LOWER", "cut", "ship", "lowered", "table", "pack_row", "unpack_row", "words_of", "mix64", "crc_bucket"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lowered(text: Column) -> Column:
    """The text with A-Z, and nothing else, in lower case."""
    return F.translate(text, UPPER, LOWER)


def crc_bucket(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def pack_row(df: DataFrame) -> Column:
    """All columns of a row in one struct, so that no column name can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")


def unpack_row(df: DataFrame, schema) -> DataFrame:
    """The rows that ``pack_row`` packed, with their names."""
    return df.select(*[F.col("__row").getField(f.name).alias(f.name) for f in schema.fields])


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Lower-cased (A-Z) words, split at ASCII white space, of a batch of texts.

    Gives the code of each word, the distinct words as bytes, and for each text
    the place where its words begin (one place more than texts). A null text has
    no words.
    """
    texts = texts.take(pa.array(np.arange(len(texts)))).fill_null("")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
    flat, starts = split.flatten(), np.asarray(split.offsets)
    starts = starts - starts[0]
    full = np.asarray(pc.not_equal(pc.binary_length(flat), 0))
    if not full.all():
        before = np.concatenate([[0], np.cumsum(full)])
        starts, flat = before[starts], flat.filter(pa.array(full))
    coded = flat.cast(pa.large_binary()).dictionary_encode()
    return np.asarray(coded.indices).astype(np.int64), coded.dictionary, starts.astype(np.int64)


def stretches(batch: pa.RecordBatch, column: int, size: int):
    """A batch in parts of about ``size`` bytes of a text column at most (a longer text is a part of its own).

    Parts are copies that begin at the start of their buffers, which not every
    Arrow function on strings takes for granted rightly.
    """
    lengths = np.asarray(pc.binary_length(batch.column(column)).fill_null(0)).astype(np.int64) + 1
    ends = np.cumsum(lengths)
    if not len(ends):
        return
    cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1], size)))
    for lo, hi in zip(cuts, [*cuts[1:], len(ends)]):
        yield batch.take(pa.array(np.arange(lo, hi)))


remembered: dict[str, dict] = {}


def tidied(run, keep: str | None = None):
    """A map over batches that leaves little in the worker it ran in.

    Spark uses a worker for the next task again, of whatever stage. What other
    operators remember there (``remembered``, by operator) is dropped first, and what Arrow
    and the allocator hold of freed memory goes back to the system at the end.
    """

    def whole(batches):
        for name, values in remembered.items():
            if name != keep:
                values.clear()
        _give_back()
        try:
            yield from run(batches)
        finally:
            _give_back()

    return whole


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of unsigned 64-bit values (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def as_json(value) -> str:
    return json.dumps(value, sort_keys=True)
