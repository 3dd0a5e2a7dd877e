"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Each level only looks at what the level before could not tell apart. Lengths are
counted first; the hash of a prefix is taken where a length occurs twice; the
whole text is normalised and hashed only where length and prefix both occur
twice. Everything is DataFrame functions.

Two texts are equal when they are the same after lower-casing A-Z (which changes
no length). Null counts as empty. Of equal texts the row with the largest id
stays; a null id loses against any other. Rows that repeat both id and text are
one document: ``groups`` gives each the same decision, ``dedup`` returns one.
An empty table gives an empty result. Other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rfspark.llm.common import cut, lowered, pack_row, unpack_row

PREFIX_CHARS = 64


def _signed(docs: DataFrame, id_col: str, text_col: str, carry) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(
        F.col(f"`{id_col}`").alias("__id"),
        *carry,
        text.alias("__text"),
        F.octet_length(text).alias("__len"),
        F.substring(text, 1, PREFIX_CHARS).alias("__head"),
    )


def _prefix_hash():
    return F.xxhash64(lowered(F.col("__head")))


def _refined(rows: DataFrame, digest_all: bool) -> DataFrame:
    """Rows with ``__suspect`` (length and prefix occur twice or more) and ``__sha`` where it was needed."""
    counted = rows.groupBy("__len", _prefix_hash().alias("__prefix")).count()
    lengths = counted.groupBy("__len").agg(F.sum("count").alias("n")).where("n > 1").select("__len")
    prefixes = (
        counted.join(lengths, "__len", "left_semi")
        .where("count > 1")
        .select("__len", "__prefix", F.lit(True).alias("__suspect"))
    )
    # Written first, so that the join's two sides are plain shuffles, whose hot keys Spark can split.
    prefixes = cut(prefixes, "exact")
    rows = rows.withColumn("__prefix", _prefix_hash()).drop("__head").join(prefixes, ["__len", "__prefix"], "left")
    suspect = F.coalesce("__suspect", F.lit(False))
    digest = F.sha2(lowered(F.col("__text")), 256)
    return rows.withColumn("__suspect", suspect).withColumn("__sha", digest if digest_all else F.when(suspect, digest))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """One row per document: ``id, length, sha256, keep_id, group_size, kept``.

    ``sha256`` is null where length or prefix already told the text apart from
    all others, unless ``digest_all`` asks for it everywhere.
    """
    rows = _refined(_signed(docs, id_col, text_col, []), digest_all)
    return _decided(cut(rows.select("__id", "__len", "__sha", "__suspect"), "exact"), []).select(
        F.col("__id").alias("id"),
        F.col("__len").cast("long").alias("length"),
        F.col("__sha").alias("sha256"),
        F.col("__keep").alias("keep_id"),
        F.col("__n").alias("group_size"),
        F.col("__id").eqNullSafe(F.col("__keep")).alias("kept"),
    )


def _decided(rows: DataFrame, carry) -> DataFrame:
    same = (
        rows.where("__suspect")
        .groupBy("__len", "__sha")
        .agg(F.max("__id").alias("__keep"), F.count(F.lit(1)).alias("__n"))
    )
    same = cut(same, "exact")
    names = ["__id", "__len", "__sha", *carry]
    alone = rows.where("not __suspect").select(*names, F.col("__id").alias("__keep"), F.lit(1).cast("long").alias("__n"))
    shared = rows.where("__suspect").join(same, ["__len", "__sha"]).select(*names, "__keep", "__n")
    return alone.unionByName(shared)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with the columns they came with."""
    rows = _refined(_signed(docs, id_col, text_col, [pack_row(docs)]), False)
    rows = cut(rows.select("__id", "__row", "__len", "__sha", "__suspect"), "exact")
    same = rows.where("__suspect").groupBy("__len", "__sha").agg(F.max("__id").alias("__keep"))
    same = cut(same, "exact")
    kept = (
        rows.where("__suspect")
        .join(same, ["__len", "__sha"])
        .where(F.col("__id").eqNullSafe(F.col("__keep")))
        .dropDuplicates(["__len", "__sha"])
    )
    return unpack_row(rows.where("not __suspect").select("__row").unionByName(kept.select("__row")), docs.schema)
