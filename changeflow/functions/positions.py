"""Log positions: file name + byte offset, and the order among them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def log_seq(log_name: Column) -> Column:
    """Number of a log file (``mysql-bin.000012`` -> 12); -1 when there is none."""
    return F.coalesce(F.substring_index(log_name, ".", -1).try_cast("bigint"), F.lit(-1).cast("bigint"))


def log_number(log_name: str) -> int:
    """As :func:`log_seq`, of a name at hand."""
    number = log_name.rpartition(".")[2]
    return int(number) if number.isdigit() else -1


def position_key(log_name: Column, log_pos: Column) -> Column:
    """Comparable position. File numbers are compared as numbers, so .1000000 follows .999999."""
    return F.struct(log_seq(log_name).alias("log_seq"), log_pos.cast("bigint").alias("log_pos"))


def position_str(log_name: Column, log_pos: Column) -> Column:
    return F.concat_ws(":", log_name, log_pos.cast("string"))


def compare_positions(left: Column, right: Column) -> Column:
    """-1, 0 or 1, for two results of :func:`position_key`."""
    return F.when(left < right, -1).when(left == right, 0).otherwise(1)


def event_order() -> Column:
    """The full order of events within a server, as one comparable value."""
    return F.struct("server_id", log_seq(F.col("log_name")).alias("log_seq"), "log_pos", "row_ordinal")
