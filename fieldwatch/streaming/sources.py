"""Streaming sources (S1, S2, S3) and the topic naming of the file stand-in.

Topics are Kafka topics in production (``format("kafka")``); without a broker,
a folder of NDJSON files per topic stands in (:mod:`fieldwatch.sources.topics`). Both
give a ``value`` string column and an arrival ``seq``, and both have offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.sources.topics import FORMAT, PARTITION_BITS, register


def topic_file(topic: str) -> str:
    """N6 naming: a topic's NDJSON file name ('.' -> '_')."""
    return topic.replace(".", "_") + ".ndjson"


def topic_stream(spark: SparkSession, topic: str, *, kafka: str | None = None, folder: str | None = None,
                 starting_offsets: str = "latest", max_per_trigger: int | None = None,
                 max_bytes: int | None = None) -> DataFrame:
    """A topic as a stream of ``value`` strings with an arrival ``seq``.

    With ``kafka`` set this subscribes to the topic, otherwise ``folder`` holds the
    topic's line files (:mod:`fieldwatch.sources.topics`). Both start at
    ``starting_offsets`` (``latest``, ``earliest`` or JSON; the reference's jobs use
    ``latest``, its notifier ``earliest``). A micro-batch takes at most
    ``max_per_trigger`` offsets (Kafka) or about ``max_bytes`` (folders; only for
    triggers that go on).
    """
    if kafka:
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", kafka)
             .option("subscribe", topic).option("startingOffsets", starting_offsets))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        df = r.load()
        return df.select(F.col("value").cast("string").alias("value"),
                         (F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")).alias("seq"))
    if folder is None:
        raise ValueError("either kafka or folder is required")
    return topic_lines(spark, folder, max_bytes, starting_offsets, topic)


def topic_lines(spark: SparkSession, folder: str, max_bytes: int | None = None, starting_offsets: str = "earliest",
                topic: str | None = None) -> DataFrame:
    """The lines of a topic folder as a stream of ``value`` with their arrival ``seq``:
    files as they are found (those found together by modification time and name), lines
    by their place in the file, partitions side by side. Empty lines are left out."""
    register(spark)
    r = spark.readStream.format(FORMAT).option("path", folder).option("startingOffsets", starting_offsets)
    if topic:
        r = r.option("topic", topic)
    if max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    return _arrived(r.load())


def _arrived(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("value").cast("string").alias("value"),
                       (F.col("offset") * F.lit(1 << PARTITION_BITS) + F.col("partition")).alias("seq"))


LINES_PER_FILE = 1 << 20


def file_lines(spark: SparkSession, folder: str, max_per_trigger: int | None = None) -> DataFrame:
    """The lines of a folder of finished files (a gateway's readings, no topic) as a stream
    of ``value`` with their arrival ``seq``: files by modification time, lines by their
    place in the file. A file is read as one row, so producers must roll files (a few MB)
    and give each its own time. Unlike a topic's, its batches go on under
    ``availableNow`` until the watermark has passed what they hold."""
    r = spark.readStream.format("text").option("wholetext", True)
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    mtime = F.unix_millis(F.col("_metadata.file_modification_time"))
    lines = r.load(folder).select(mtime.alias("at"), F.posexplode(F.split("value", "\r?\n")).alias("pos", "value"))
    return (lines.filter(F.length("value") > 0)
            .select("value", (F.col("at") * LINES_PER_FILE + F.col("pos")).alias("seq")))


def topic_batch(spark: SparkSession, topic: str, *, kafka: str | None = None, folder: str | None = None,
                starting_offsets: str = "earliest", ending_offsets: str = "latest") -> DataFrame:
    """S3: a topic read as a bounded table (the notifier reads from the start)."""
    if kafka:
        df = (spark.read.format("kafka").option("kafka.bootstrap.servers", kafka).option("subscribe", topic)
              .option("startingOffsets", starting_offsets).option("endingOffsets", ending_offsets).load())
        return df.select(F.col("value").cast("string").alias("value"))
    register(spark)
    rows = (spark.read.format(FORMAT).option("path", folder).option("topic", topic)
            .option("startingOffsets", starting_offsets).option("endingOffsets", ending_offsets).load())
    return rows.select(F.col("value").cast("string").alias("value"))
