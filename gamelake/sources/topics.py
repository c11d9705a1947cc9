"""Topic records: Kafka sources, their offline twins of the same columns, and the offsets ledger.

The Kafka connector is added at deployment (``--packages``); without it the file twins serve.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC_SCHEMA = "topic string, partition int, offset long, timestamp timestamp, value string"
EARLIEST = -2


def read_topic_batch(spark: SparkSession, servers: str, topic: str, start: str = "earliest", end: str = "latest") -> DataFrame:
    """A bounded scan; data that has expired is tolerated."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("failOnDataLoss", "false")
    return _records(reader.option("startingOffsets", start).option("endingOffsets", end).load())


def read_topic_stream(spark: SparkSession, servers: str, topic: str, start: str = "latest", per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("failOnDataLoss", "false").option("startingOffsets", start)
    return _records((reader.option("maxOffsetsPerTrigger", per_trigger) if per_trigger else reader).load())


def _records(df: DataFrame) -> DataFrame:
    return df.select("topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))


def read_topic_files(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """The batch twin: Parquet files with the record columns."""
    df = spark.read.schema(TOPIC_SCHEMA).parquet(path)
    return df.filter(F.col("topic") == topic) if topic else df


def stream_topic_files(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """The stream twin: new files in a folder."""
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def next_offsets(df: DataFrame) -> DataFrame:
    """The offset after the last one read, for each topic and partition."""
    return df.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def partition_offsets(offsets: DataFrame) -> DataFrame:
    """One row per topic: {"partition": next offset} as the Kafka source takes it."""
    entries = F.sort_array(F.collect_list(F.struct("partition", "next_offset")))
    inner = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["partition"].cast("string"), e["next_offset"])))
    return offsets.groupBy("topic").agg(F.to_json(inner).alias("partition_offsets"))


def save_offsets(offsets: DataFrame, ledger: str, batch_id: int) -> None:
    """Append to the ledger. Write the data first: a crash in between reads it again, and the
    deduplication downstream takes the repeats."""
    partition_offsets(offsets).withColumn("id", F.lit(batch_id).cast("long")).coalesce(1).write.mode("append").parquet(ledger)


def load_offsets(spark: SparkSession, ledger: str) -> DataFrame:
    """The newest entry of each topic."""
    return newest_offsets(spark.read.parquet(ledger))


def newest_offsets(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("topic").agg(F.max_by("partition_offsets", "id").alias("partition_offsets"))


def starting_offsets(newest: Mapping[str, Mapping[str, int]], topic: str, partitions: Sequence[int]) -> str:
    """The Kafka option for a topic: stored offsets, and the earliest one for partitions not seen before."""
    import json

    known = newest.get(topic, {})
    return json.dumps({topic: {str(p): int(known.get(str(p), EARLIEST)) for p in partitions}})


def resume(records: DataFrame, offsets: DataFrame) -> DataFrame:
    """Records from the stored next offset on; all of a partition that has none. The ledger has a row
    per partition of a topic, which Spark broadcasts if it measures it as small."""
    return records.join(offsets, ["topic", "partition"], "left").filter(F.col("offset") >= F.coalesce("next_offset", F.lit(0))).drop("next_offset")
