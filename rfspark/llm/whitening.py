"""Embedding whitening with MLlib's distributed block matrices.

Entries become whole numbers, so that the sums that centre them are exact. Centred
rows get gapless indexes and form a ``BlockMatrix``; its transpose times itself is
the scatter, whose inner dimension is split over tasks (``numMidDimSplits``), so no
task sees more than a few blocks. Only that matrix of dimensions by dimensions comes to
the driver for the eigenvectors; a second block product projects the rows.

MLlib lays a matrix of one block column over about the square root of the row
partitions it is made from, and lists the ids of its blocks in the driver: blocks
are of 1024 rows, and of more (64 MB at most) from a billion rows on, which keeps
that list at about a million.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window, functions as F

from rfspark.llm.common import cut, ship

SCALE, SHIFT = 64, 1000000
LIMIT = float(1 << 40)  # entries of this size or more have no exact long
DIMENSIONS = 4096  # the driver solves a matrix of this many rows at most
BLOCK_ROWS, BLOCK_IDS, BLOCK_BYTES = 1024, 1 << 20, 64 << 20
BLOCK_COLUMNS = 1024
CENTRED = "at bigint, id bigint, deviation bigint, c array<double>"


def whole(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``at, id, x``: the usable rows with entries as ``floor(64*c) + 1000000``, numbered without gaps from 0.

    Rows are dropped whose vector is null, or holds a null, a NaN, or an entry of
    2**40 or more in size, infinite ones included. Of several lengths only the most frequent stays (of equally
    frequent ones the greatest): other vectors have no covariance with it.
    """
    v = F.col(f"`{vec_col}`")
    good = v.isNotNull() & ~F.coalesce(F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) >= LIMIT)), F.lit(True))
    x = F.transform(v, lambda e: F.floor(e.cast("double") * SCALE) + SHIFT)
    rows = vectors.where(good).select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), x.alias("x"), F.monotonically_increasing_id().alias("mono")
    )
    rows = cut(rows, "whitening")
    size = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if size is None or size["d"] == 0:
        return rows.where(F.lit(False)).select(F.col("mono").alias("at"), "id", "x")
    rows = rows.where(F.size("x") == size["d"])
    # A row's number within its writing task, plus the rows of all tasks before.
    place = rows.withColumn("task", F.shiftright("mono", 33))
    counts = place.groupBy("task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("task").orderBy("mono")) - 1
    placed = place.withColumn("within", within).join(starts, "task")
    return cut(placed.select((F.col("start") + F.col("within")).alias("at"), "id", "x"), "whitening")


def centred(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """``at, id, deviation, c``: ``x - S/n`` and the exact sum of ``(n*x - S)**2`` (null beyond a long)."""
    quotient = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)

    def centre(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) - quotient
            size = n * (int(np.abs(x).max(initial=0)) + 1)
            if size < 1 << 53 and size * size * x.shape[1] < 1 << 63:
                y = n * x - rest
                deviation = (y * y).sum(axis=1).tolist()
                c = y / n
            else:
                y = n * x.astype(object) - rest.astype(object)
                deviation = [t if t < 1 << 63 else None for t in (y * y).sum(axis=1).tolist()]
                c = (y / n).astype(np.float64)
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * c.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("at"),
                    batch.column("id"),
                    pa.array(deviation, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(c.ravel())),
                ],
                ["at", "id", "deviation", "c"],
            )

    return rows.mapInArrow(centre, CENTRED)


def blocks(rows: DataFrame, n: int, d: int) -> BlockMatrix:
    """``at, c`` as a block matrix of ``n`` rows."""
    indexed = rows.select(F.col("at").alias("index"), array_to_vector("c").alias("vector"))
    indexed = MLUtils.convertVectorColumnsFromML(indexed, "vector")
    height = max(BLOCK_ROWS, min(math.ceil(n / BLOCK_IDS), BLOCK_BYTES // (8 * d)))
    return IndexedRowMatrix(indexed, n, d).toBlockMatrix(height, min(d, BLOCK_COLUMNS))


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix, with the inner dimension split so that a task takes about 16 blocks."""
    flat = matrix.transpose()
    splits = max(1, math.ceil(matrix.numRowBlocks / 16))
    # The wrapper's own multiply() has no argument for the splits.
    product = flat._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def project(matrix: BlockMatrix, whitening: np.ndarray) -> DataFrame:
    """``at, y``: the matrix's rows times ``whitening``."""
    sc = matrix._java_matrix_wrapper._sc
    step, k = matrix.colsPerBlock, whitening.shape[1]
    parts = [whitening[lo : lo + step] for lo in range(0, len(whitening), step)]
    cells = [((i, 0), Matrices.dense(len(p), k, p.ravel(order="F"))) for i, p in enumerate(parts)]
    # MLlib takes the root of the larger side's partitions again: empty ones here keep the product spread.
    wide = min(sc.defaultParallelism**2, 4096)
    right = BlockMatrix(sc.parallelize(cells, max(wide, len(cells))), step, k, len(whitening), k)
    rows = matrix.multiply(right).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", rows._java_matrix_wrapper._java_model)
    return found.select(F.col("index").alias("at"), vector_to_array("vector").alias("y"))


def _sums(rows: DataFrame, column: str):
    """Sums of an array column by place."""
    by_place = rows.select(F.posexplode(column)).groupBy("pos").agg(F.sum("col").alias("s"))
    return [r["s"] for r in by_place.orderBy("pos").collect()]


def whiten(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: a row per usable vector and component.

    ``whitened`` is the centred row on the component's unit eigenvector over the
    root of its eigenvalue; components are numbered by falling eigenvalue. A
    component without variance (beyond the rank of the data; all of them for one
    row or equal rows) has ``whitened`` null and ``explained`` 0 (null if nothing varies), and ``identity_error``
    covers the others (null if there are none). Null and repeated ids are rows
    like any other. A table without usable rows gives none.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = whole(vectors, id_col, vec_col)
    n = rows.count()
    schema = "id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not n:
        return spark.createDataFrame([], schema)
    sums = [int(s) for s in _sums(rows.select(F.transform("x", lambda e: e.cast("decimal(20,0)")).alias("x")), "x")]
    d = len(sums)
    if d > DIMENSIONS:
        raise ValueError(f"{d} dimensions; the driver solves {DIMENSIONS} at most")
    table = cut(centred(rows, n, sums), "whitening")
    matrix = blocks(table, n, d)
    value, vector = np.linalg.eigh(scatter(matrix) / n)
    value, vector = value[::-1], vector[:, ::-1]
    used = int((value[:components] > value[0] * d * np.finfo(float).eps).sum()) if value[0] > 0 else 0
    asked = min(components, d)
    total = float(value.clip(0).sum())
    explained = [float(max(v, 0.0) / total) if total else None for v in value[:asked]]
    error = None
    if used:
        seen = cut(project(matrix, vector[:, :used] / np.sqrt(value[:used])), "whitening")
        means = F.array(*[F.lit(s / n) for s in _sums(seen, "y")])
        again = seen.select("at", F.zip_with("y", means, lambda a, b: a - b).alias("c"))
        error = float(np.abs(scatter(blocks(again, n, used)) / n - np.eye(used)).max())
    else:
        seen = table.select("at", F.array().cast("array<double>").alias("y"))
    shares = F.array(*[F.lit(e).cast("double") for e in explained])
    joined = table.select("at", "id", "deviation").join(seen, "at")
    return joined.select("id", "deviation", "y", F.posexplode(shares).alias("place", "explained")).select(
        "id",
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        F.get("y", F.col("place")).alias("whitened"),
        "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )
