"""Change logs and SQL logs as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow import schema as S
from changeflow.sources.codec import decode_changes

#: A log is laid out by these, so reads of some servers or files skip the rest.
LAYOUT = ("server_id", "log_name")


def write_changes_files(changes: DataFrame, path: str, mode: str = "append") -> None:
    changes.select(*S.CHANGE_COLUMNS).write.mode(mode).partitionBy(*LAYOUT).parquet(path)


def read_changes_files(spark: SparkSession, path: str, stream: bool = False, file_format: str = "parquet",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """A log as files: Parquet with the columns of a change event, or ``json`` / ``text`` with one message a
    line. ``max_files_per_trigger`` holds a stream back."""
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_format == "parquet":
        # An empty file name is a null partition on disk.
        return (reader.schema(S.CHANGE_SCHEMA).parquet(path)
                .withColumn("log_name", F.coalesce("log_name", F.lit(""))).select(*S.CHANGE_COLUMNS))
    if file_format in ("json", "text"):
        return decode_changes(reader.text(path))
    raise ValueError(f"unknown file format {file_format!r}")


def write_sql_log(lines: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery | None:
    """SQL lines as text files, every one of them. On a stream ``checkpoint`` is needed, and the query is returned."""
    text = lines.select("line")
    if text.isStreaming:
        if checkpoint is None:
            raise ValueError("a stream to files needs a checkpoint")
        return text.writeStream.format("text").option("checkpointLocation", checkpoint).start(path)
    text.write.text(path)
    return None
