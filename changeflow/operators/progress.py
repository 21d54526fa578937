"""Saved positions: how far a server's log has been handled."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changeflow import schema as S
from changeflow.functions.numbers import floor_div, span_of
from changeflow.functions.positions import log_seq
from changeflow.operators.ordered import with_previous

DEFAULT_SAVE_SECONDS = 3

#: Saves of one server that share a window partition, in seconds of log time.
SPAN_SECONDS = 86_400


def save_seconds_or_default(seconds: float) -> float:
    return seconds if seconds >= 1 else DEFAULT_SAVE_SECONDS


def save_points(changes: DataFrame, seconds: float = DEFAULT_SAVE_SECONDS) -> DataFrame:
    """``server_id, saved_at, log_name, log_pos``: the newest position at the end of each interval with
    events, and at each rotate and ddl event.

    Aggregated first by file, in longs, so that the hash aggregate shrinks the log map-side; what is left
    per interval is a row per file.
    """
    width = int(save_seconds_or_default(seconds))
    tick = (floor_div(F.col("timestamp"), width) + 1) * width
    forced = F.col("event_type").isin(S.ROTATE, S.DDL)
    at = F.explode(F.when(forced, F.array(tick, F.col("timestamp"))).otherwise(F.array(tick))).alias("saved_at")
    by_file = (changes.select("server_id", "log_name", "log_pos", at)
               .groupBy("server_id", "saved_at", "log_name").agg(F.max("log_pos").alias("log_pos")))
    newest = F.max(F.struct(log_seq(F.col("log_name")).alias("seq"), "log_pos", "log_name")).alias("p")
    return by_file.groupBy("server_id", "saved_at").agg(newest).select(
        "server_id", "saved_at", "p.log_name", "p.log_pos")


def drop_unchanged(points: DataFrame, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """Save points whose position differs from that of the one before."""
    position = F.struct("log_name", "log_pos")
    span = span_of(F.col("saved_at"), span_seconds)
    steps = with_previous(points, ["server_id"], span, [F.col("saved_at")], position, "_prev")
    return steps.where(~F.col("_prev").eqNullSafe(position)).drop("_prev")


def progress(changes: DataFrame, seconds: float = DEFAULT_SAVE_SECONDS) -> DataFrame:
    """The positions a saver would have written, unchanged ones left out."""
    return drop_unchanged(save_points(changes, seconds))
