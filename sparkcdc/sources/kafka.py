"""Kafka legs. The connector jar is the cluster's to bring; shape and options live here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SCHEMA = (
    "topic string, partition int, offset bigint, key binary, value binary,"
    " headers array<struct<key:string,value:binary>>, timestamp timestamp"
)

# Reader and writer options of the delivery contract.
READ_OPTIONS = {
    "startingOffsets": "earliest",
    "failOnDataLoss": "true",
    "kafka.isolation.level": "read_committed",
    "includeHeaders": "true",
}
WRITE_OPTIONS = {"kafka.acks": "all", "kafka.enable.idempotence": "true", "includeHeaders": "true"}


def read_topic(spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None, stream: bool = True) -> DataFrame:
    reader = (spark.readStream if stream else spark.read).format("kafka")
    options = dict(READ_OPTIONS)
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return reader.options(**options).option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()


def write_topic(records: DataFrame, servers: str) -> None:
    out = records.select("topic", "key", "value", "headers")
    out.write.format("kafka").options(**WRITE_OPTIONS).option("kafka.bootstrap.servers", servers).save()


def as_records(df: DataFrame, topic: Column, key: Column, value: Column, headers: Column, offset: Column, at: Column) -> DataFrame:
    """Rows in the shape the Kafka source delivers, for files and tests."""
    return df.select(
        topic.alias("topic"),
        F.lit(0).alias("partition"),
        offset.cast("bigint").alias("offset"),
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        headers.cast("array<struct<key:string,value:binary>>").alias("headers"),
        at.alias("timestamp"),
    )
