"""The event model and the logs it is read from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    ]
)

# An entity is a topic and a key: equal keys on two topics are two entities.
ENTITY = ["topic", "key"]
POSITION = ["topic", "partition", "offset"]


def select_topics(events: DataFrame, topics: str | Sequence[str]) -> DataFrame:
    """Events of one topic, several topics, or a regex that starts with ``^``."""
    if isinstance(topics, str):
        if topics.startswith("^"):
            return events.filter(F.col("topic").rlike(f"^(?:{topics[1:].removesuffix('$')})$"))
        topics = [topics]
    if not topics:
        raise ValueError("subscribed_topics: at least one topic is required")
    return events.filter(F.col("topic").isin(*topics))


def read_log(
    spark: SparkSession,
    path: str,
    topics: str | Sequence[str] | None = None,
    *,
    stream: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """An event log kept as parquet, whole or as a stream of new files."""
    if stream:
        reader = spark.readStream.schema(EVENT_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        events = reader.parquet(path)
    else:
        events = spark.read.schema(EVENT_SCHEMA).parquet(path)
    return events if topics is None else select_topics(events, topics)


def read_kafka(
    spark: SparkSession,
    bootstrap_servers: str,
    topics: str | Sequence[str],
    *,
    stream: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Subscribe to Kafka topics; needs the Kafka connector on the class path."""
    reader = (spark.readStream if stream else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", bootstrap_servers)
    if isinstance(topics, str) and topics.startswith("^"):
        reader = reader.option("subscribePattern", topics)
    else:
        names = [topics] if isinstance(topics, str) else list(topics)
        reader = reader.option("subscribe", ",".join(names))
    raw = reader.option("includeHeaders", "true").options(**(options or {})).load()
    return decode_kafka(raw)


def decode_kafka(raw: DataFrame) -> DataFrame:
    """Kafka source rows as events: text key and payload, headers as a map."""
    entries = F.coalesce("headers", F.array().cast("array<struct<key:string,value:binary>>"))
    names = F.array_distinct(F.transform(entries, lambda h: h["key"]))

    def last_value(name):
        same = F.filter(entries, lambda h: h["key"] == name)
        return F.element_at(same, -1)["value"].cast("string")

    # A record may repeat a header name; the last value stands.
    headers = F.map_from_arrays(names, F.transform(names, last_value))
    return raw.select(
        "topic", "partition", "offset", "timestamp",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("payload"),
        headers.alias("headers"),
    )
