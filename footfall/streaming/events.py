"""Event feed: JSON or CSV messages in, typed rows out, and back.

The parse and encode steps are plain DataFrame functions, so they serve batch
and streaming inputs, a Kafka topic as well as a folder of text files. Reading a
topic needs Spark's Kafka connector on the class path.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

# The fields of a message, in CSV column order.
EVENT = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("payload", T.StringType()),
    ]
)
# ISO-8601 in UTC with milliseconds.
TIME_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSX", "timeZone": "UTC"}

BAD_MESSAGE = "bad_message"


# What a topic tells about a message besides its value.
METADATA = ["key", "partition", "offset"]
LOAD_TIME = "load_time"


def parse_events(messages: DataFrame, fmt: str = "json", value: str = "value", keep: Sequence[str] | None = None) -> DataFrame:
    """Typed events from messages; what cannot be read is kept in ``bad_message``.

    ``keep`` are columns of the message to carry along, by default those of
    ``METADATA`` that it has.
    """
    keep = [c for c in METADATA if c in messages.columns] if keep is None else list(keep)
    schema = T.StructType([*EVENT.fields, T.StructField(BAD_MESSAGE, T.StringType())])
    text = F.rtrim(F.col(value).cast("string"), F.lit("\r\n"))
    options = {**TIME_FORMAT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_MESSAGE}
    if fmt == "json":
        parsed = F.from_json(text, schema, options)
    elif fmt == "csv":
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        parsed = F.from_csv(text, F.lit(ddl), options)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    kept = [F.col(c).cast("string").alias(c) if c == "key" else F.col(c) for c in keep]
    return messages.select(*kept, parsed.alias("event")).select(*keep, "event.*")


def once_each(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop messages that were delivered before, by partition and offset.

    A stream remembers a message for ``delay`` of event time, so its state is
    bounded; later redeliveries are not recognised. Messages without an event
    time cannot be ordered and are compared by partition and offset all the same.
    """
    if not events.isStreaming:
        return events.dropDuplicates(["partition", "offset"])
    return events.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["partition", "offset"])


def encode_events(events: DataFrame, fmt: str = "json", key: Column | None = None) -> DataFrame:
    """Messages (``value`` and, if given, ``key``) from typed events."""
    row = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT.fields])
    if fmt == "json":
        message = F.to_json(row, {**TIME_FORMAT, "ignoreNullFields": "false"})
    elif fmt == "csv":
        message = F.to_csv(row, TIME_FORMAT)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    keys = [] if key is None else [key.cast("string").alias("key")]
    return events.select(*keys, message.alias("value"))


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of a Kafka topic. Tasks share its partitions, so there is no group to set."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def read_folder(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of the lines of text files as they arrive in a folder."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def ingest_events(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "json",
    once: bool = True,
    interval: str = "1 minute",
    distinct_within: str | None = None,
) -> StreamingQuery:
    """Parse a message stream into Parquet files by event date, stamped with the load time.

    The file sink and the checkpoint write every message exactly once, over
    restarts too. What the feed itself delivers twice, with the same partition
    and offset, is dropped if ``distinct_within`` says for how long to look back.
    ``once`` takes what is there and stops.
    """
    events = parse_events(messages, fmt)
    if distinct_within:
        events = once_each(events, distinct_within)
    events = events.withColumn(LOAD_TIME, F.current_timestamp()).withColumn("event_date", F.to_date("event_time"))
    writer = (
        events.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("event_date")
    )
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def topic_options(
    servers: str, topic: str, acks: str = "all", compression: str = "lz4", linger_ms: int = 50,
    idempotent: bool = False,
) -> dict[str, str]:
    """Options of the Kafka sink. Delivery is at least once, so readers de-duplicate."""
    options = {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all" if idempotent else acks,
        "kafka.compression.type": compression,
        "kafka.linger.ms": str(linger_ms),
    }
    if idempotent:
        options["kafka.enable.idempotence"] = "true"
    return options


def publish_events(
    events: DataFrame, options: dict[str, str], checkpoint: str | None = None,
    fmt: str = "json", key: Column | None = None,
) -> StreamingQuery | None:
    """Write events to a Kafka topic. Equal keys stay in order within a partition.

    A stream needs a checkpoint: without one it would start over when restarted.
    """
    if events.isStreaming and not checkpoint:
        raise ValueError("a stream needs a checkpoint folder")
    messages = encode_events(events, fmt, key)
    if not events.isStreaming:
        messages.write.format("kafka").options(**options).save()
        return None
    return (
        messages.writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def publish_once(
    events: DataFrame, sink: Callable[[DataFrame, int], None], ledger: str, checkpoint: str, fmt: str = "json",
    key: Column | None = None,
) -> StreamingQuery:
    """Hand the messages of what is there to ``sink``, batch by batch, and note each batch in a ledger when it is out.

    After a failure Spark plays the last batch again under its old number. If the ledger has it, it is
    not handed over again; if not, ``sink`` gets the same rows with the same number and has to replace
    what it may have written of them, as ``folder_sink`` does. A topic cannot replace: there a batch that
    failed between its last message and the ledger is delivered twice, under its number.
    """
    spark = events.sparkSession

    def publish(batch: DataFrame, number: int) -> None:
        if number not in published_batches(spark, ledger):
            sink(encode_events(batch, fmt, key).withColumn("batch", F.lit(number).cast("long")), number)
            spark.range(1).select(F.lit(number).cast("long").alias("batch")).coalesce(1).write.mode("overwrite").parquet(f"{ledger}/{number}")

    writer = events.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def published_batches(spark: SparkSession, ledger: str) -> set[int]:
    """Numbers of the batches that are out: one small file a batch."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return set()
    noted = spark.read.schema("batch long").option("recursiveFileLookup", True).parquet(ledger)
    return {r[0] for r in noted.collect()}


def folder_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Messages as Parquet, a folder for each batch, replaced whole."""
    return lambda messages, number: messages.write.mode("overwrite").parquet(f"{path}/{number}")


def read_published(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """What ``folder_sink`` has of the batches that are out, and nothing of one that is not."""
    numbers = sorted(published_batches(spark, ledger))
    if not numbers:
        raise ValueError(f"nothing is published in {path}")
    return spark.read.parquet(*(f"{path}/{n}" for n in numbers))
