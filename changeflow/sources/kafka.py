"""Change events through Kafka, by Spark's connector (a package the cluster must provide)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators.filters import drop_empty
from changeflow.operators.offsets import order_changes, row_key
from changeflow.sources.codec import decode_changes, encode_changes


def write_options(brokers: list[str], topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": ",".join(brokers), "topic": topic, "kafka.acks": "all"}


def message_key() -> Column:
    """Table and row, so that the changes of a row share a topic partition and keep their order."""
    return F.concat_ws(".", "db", "table", row_key())


def messages_of(changes: DataFrame, key: str | None = None,
                encoder: Callable[[DataFrame], DataFrame] | None = None, with_ordinal: bool = True) -> DataFrame:
    """What is sent: ``value``, and ``key`` if ``key="primary"``; keyless messages go to any partition. Keyed messages
    of a batch come in log order, with all changes of a row in one task, as tasks send side by side."""
    if key not in (None, "primary"):
        raise ValueError(f"key must be None or 'primary', not {key!r}")
    keyed = order_changes(changes, whole_rows=True).withColumn("key", message_key()) if key else changes
    encoded = drop_empty(encode_changes(keyed, encoder, with_ordinal))
    return encoded.select(*(["key"] if key else []), "value")


def write_changes_kafka(changes: DataFrame, brokers: list[str], topic: str, checkpoint: str | None = None,
                        **how) -> StreamingQuery | None:
    """Sends with acks from all replicas. ``how`` goes to :func:`messages_of`."""
    options = write_options(brokers, topic)

    def send(batch: DataFrame, batch_id: int = 0) -> None:
        messages_of(batch, **how).write.format("kafka").options(**options).save()

    if not changes.isStreaming:
        send(changes)
        return None
    if checkpoint is None:
        raise ValueError("a stream to Kafka needs a checkpoint")
    if how.get("key"):  # a micro-batch is put in order before it is sent
        return changes.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint).start()
    return (messages_of(changes, **how).writeStream.format("kafka").options(**options)
            .option("checkpointLocation", checkpoint).start())


def read_options(brokers: list[str], topic: str, start: str = "latest",
                 max_per_trigger: int | None = None) -> dict[str, str]:
    """``start``: ``earliest``, ``latest`` or the JSON of ``starting_offsets_json``. A stream's checkpoint
    beats it."""
    options = {"kafka.bootstrap.servers": ",".join(brokers), "subscribe": topic, "startingOffsets": start}
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_changes_kafka(spark: SparkSession, brokers: list[str], topic: str, start: str = "latest",
                       stream: bool = True, max_per_trigger: int | None = None) -> DataFrame:
    """Change events with their ``topic, partition, offset``."""
    reader = spark.readStream if stream else spark.read
    messages = reader.format("kafka").options(**read_options(brokers, topic, start, max_per_trigger)).load()
    return decode_changes(messages.select("topic", "partition", "offset", "value"))
