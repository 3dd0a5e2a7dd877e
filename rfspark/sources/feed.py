"""Live packets in, blocks and breaks out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rfspark.sources.landing import read_bounded


def read_packet_stream(
    spark: SparkSession,
    path: str,
    schema,
    files_per_trigger: int | None = None,
    rows_per_trigger: int | None = None,
    bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Packets of a Parquet landing folder as a stream, oldest file first.

    With ``rows_per_trigger`` or ``bytes_per_trigger`` a micro-batch is bounded
    inside files too; see ``landing.read_bounded`` for what that asks of the trigger.
    """
    if rows_per_trigger or bytes_per_trigger:
        return read_bounded(spark, path, schema, rows_per_trigger, bytes_per_trigger)
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def closing(packets: DataFrame) -> DataFrame:
    """One marker row per stream, ``payload = 'closed'``, behind its last packet: its feed has ended.

    ``packets`` have ``stream_id, seq, ts``; other columns of the marker are null.
    """
    last = packets.groupBy("stream_id").agg((F.max("seq") + 1).alias("seq"), F.max("ts").alias("ts"))
    known = {"stream_id", "seq", "ts", "payload"}
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in packets.schema.fields if f.name not in known]
    return last.select("stream_id", "seq", "ts", F.lit("closed").alias("payload"), *rest).select(packets.columns)


def write_blocks(df: DataFrame, path: str, time: str = "ts", mode: str = "append") -> None:
    """Blocks, runs or breaks by stream and day, in stream order inside a file.

    Rows are spread by stream, day and hour, so that a busy stream's day is
    written by as many tasks as it has hours.
    """
    dated = df.withColumn("day", F.to_date(time))
    spread = dated.repartition("stream_id", "day", F.hour(time))
    spread.sortWithinPartitions("stream_id", "day", time).write.mode(mode).partitionBy("stream_id", "day").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def start_stream(df: DataFrame, path: str, checkpoint: str, mode: str = "append", continuous: str | None = None):
    """Run a stream into Parquet: over what is there now, or for good every ``continuous``."""
    writer = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    return writer.start(path)


def drain(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream into Parquet, batch after bounded batch, until nothing is left that has landed."""
    query = start_stream(df, path, checkpoint, mode, continuous="0 seconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def to_arrow(df: DataFrame):
    """Hand a result that fits one machine to Arrow and NumPy."""
    return df.toArrow()
