"""Replication health from position samples.

A sample compares where the log was read to (``file_seq, file_pos``) with where the server stands
(``db_seq, db_pos``); ``db_error`` is set where the server could not be asked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from changeflow import schema as S
from changeflow.functions.numbers import floor_div, span_of
from changeflow.functions.positions import log_seq
from changeflow.operators.ordered import as_of, span_ends, with_previous

DEFAULT_CHECK_SECONDS = 10
DEFAULT_THRESHOLD = 10_000
MIN_THRESHOLD = 1_000
GRACE_SECONDS = 5

#: Samples of one server that share a window partition, in seconds.
SPAN_SECONDS = 3_600


def check_seconds_or_default(seconds: float) -> float:
    return seconds if seconds >= 1 else DEFAULT_CHECK_SECONDS


def threshold_or_default(threshold: int) -> int:
    return threshold if threshold >= MIN_THRESHOLD else DEFAULT_THRESHOLD


def _start_pos() -> Column:
    """Where the unread part of the server's current file starts: at 0 if an older file is being read."""
    return F.when(F.col("file_seq") == F.col("db_seq"), F.col("file_pos")).otherwise(F.lit(0).cast("bigint"))


def lag_bytes(samples: DataFrame) -> DataFrame:
    """Adds ``lag_bytes``, the distance within the server's current file, and ``files_behind``."""
    return samples.withColumns({
        "lag_bytes": F.col("db_pos") - _start_pos(), "files_behind": F.col("db_seq") - F.col("file_seq")})


def _file() -> Column:
    return F.struct("file_seq", "file_pos")


def _db() -> Column:
    return F.struct("db_seq", "db_pos")


def _saved(saved: DataFrame, rows: DataFrame, at_ms: Column, name: str, span_seconds: int) -> DataFrame:
    """``rows`` with the saved position as of a time: the struct (file_seq, file_pos), -1 and 0 before the first save."""
    place = F.struct(log_seq(F.col("log_name")).alias("file_seq"), F.col("log_pos").alias("file_pos"))
    known = as_of(rows, saved, ["server_id"], at_ms, F.col("saved_at") * 1000, place, name, span_seconds * 1000)
    none = F.struct(F.lit(-1).cast("bigint").alias("file_seq"), F.lit(0).cast("bigint").alias("file_pos"))
    return known.withColumn(name, F.coalesce(name, none))


def position_samples(saved: DataFrame, db_positions: DataFrame, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """Samples from the engine's own state: each of ``db_positions`` (``server_id, ts, db_seq, db_pos, db_error``) with the
    position saved last before it (``server_id, saved_at, log_name, log_pos``, as :mod:`progress` gives it)."""
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    met = _saved(saved, db_positions, at, "_file", span_seconds)
    return met.select("server_id", "ts", "_file.file_seq", "_file.file_pos", "db_seq", "db_pos", "db_error",
                      *(c for c in db_positions.columns if c not in ("server_id", "ts", "db_seq", "db_pos", "db_error")))


def recheck(samples: DataFrame, grace_seconds: float = GRACE_SECONDS, span_seconds: int = SPAN_SECONDS,
            saved: DataFrame | None = None) -> DataFrame:
    """Adds ``last`` (file and db position of the server's previous sample, of itself for the first one) and
    ``grew``: whether the file position grew within the grace period after the sample. Where the saved positions are
    given, that is looked up in them, as samples may be further apart than the grace period.

    A server's samples are cut into spans of time; the samples that a span needs from the next one (those of
    its first seconds) are copied over to it.
    """
    grace_ms, span_ms = int(grace_seconds * 1000), span_seconds * 1000
    if saved is not None:
        later = _saved(saved, samples, F.unix_millis(F.col("ts").cast("timestamp")) + grace_ms, "_later", span_seconds)
        now = recheck(later, 0, span_seconds)
        return now.withColumn("grew", F.col("_later") > _file()).drop("_later")
    pair = F.struct(_file().alias("file"), _db().alias("db"))
    timed = samples.withColumn("_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    span = span_of(F.col("_ms"), span_ms)
    # Every span a grace period after which the sample can lie in, its own first.
    reach = F.sequence(span, floor_div(F.col("_ms") - grace_ms, span_ms), F.lit(-1).cast("bigint"))
    spanned = timed.withColumn("_own", span).withColumn("_span", F.explode(reach))
    order = [F.col("_ms"), F.col("file_seq"), F.col("file_pos"), F.col("db_seq"), F.col("db_pos")]

    carried = span_ends(timed.withColumn("_span", span), ["server_id"], "_span", order, pair)
    inside = Window.partitionBy("server_id", "_span").orderBy(*order)
    after = Window.partitionBy("server_id", "_span").orderBy("_ms").rangeBetween(1, grace_ms)
    return (spanned.join(carried, ["server_id", "_span"])
            .withColumns({
                "last": F.coalesce(F.lag(pair).over(inside), F.col("_carried"), pair),
                "_best": F.max(_file()).over(after)})
            .where(F.col("_own") == F.col("_span"))
            .withColumn("grew", F.coalesce(F.col("_best") > _file(), F.lit(False)))
            .drop("_ms", "_own", "_span", "_carried", "_best"))


def level_name(level: Column) -> Column:
    return F.get(F.array(*map(F.lit, S.LEVELS)), level)


def level_of(status: Column) -> Column:
    """green 0, yellow 1, red 2; anything else counts as green."""
    return F.greatest(F.array_position(F.array(*map(F.lit, S.LEVELS)), status) - 1, F.lit(0)).cast("int")


def verdict(threshold: int = DEFAULT_THRESHOLD) -> dict[str, Column]:
    """``level`` and ``reasons`` from a sample with ``last`` and ``grew``: the worst of all rules that apply."""
    failed = F.length("db_error") > 0
    late = _start_pos() + threshold_or_default(threshold) < F.col("db_pos")
    file_stuck = (_file() == F.col("last.file")) & ~F.col("grew")
    db_still = _db() == F.col("last.db")
    apart = (F.col("file_seq") != F.col("db_seq")) | (F.col("file_pos") != F.col("db_pos"))
    both_stopped, sync_stopped = db_still & file_stuck & apart, ~db_still & file_stuck
    level = (F.when(failed | both_stopped | sync_stopped, 2).when(late, 1).otherwise(0))
    reasons = F.when(failed, F.array(F.concat(F.lit(S.REASON_NO_DB_POSITION), F.col("db_error")))).otherwise(
        F.array_compact(F.array(
            F.when(late, F.lit(S.REASON_THRESHOLD)),
            F.when(both_stopped, F.lit(S.REASON_BOTH_STOPPED)),
            F.when(sync_stopped, F.lit(S.REASON_SYNC_STOPPED)))))
    return {"level": level, "reasons": reasons}


def message(threshold: int, check_seconds: float) -> dict[str, Column]:
    """What a verdict is reported with."""
    return {"status": level_name(F.col("level")),
            "threshold": F.lit(threshold_or_default(threshold)).cast("bigint"),
            "check_seconds": F.lit(check_seconds_or_default(check_seconds)).cast("double")}


def health(samples: DataFrame, threshold: int = DEFAULT_THRESHOLD, grace_seconds: float = GRACE_SECONDS,
           span_seconds: int = SPAN_SECONDS, check_seconds: float = DEFAULT_CHECK_SECONDS, saved: DataFrame | None = None) -> DataFrame:
    """Adds ``level``, ``status`` and ``reasons`` to each sample, and the settings it was judged by. ``saved``: the saved
    positions, in which growth after a stuck sample is looked up."""
    judged = recheck(samples, grace_seconds, span_seconds, saved).withColumns(verdict(threshold)).drop("last", "grew")
    return judged.withColumns(message(threshold, check_seconds))


def worst_status(statuses: DataFrame, keys: list[str]) -> DataFrame:
    """The worst ``level`` of each group, and its name."""
    return (statuses.groupBy(*keys).agg(F.max("level").alias("level"))
            .withColumn("status", level_name(F.col("level"))))


def alerts(judged: DataFrame, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """Samples whose status changed to one that is not green; adds ``last_status``, "" before the first."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    order = [F.col("ts"), F.col("file_seq"), F.col("file_pos"), F.col("db_seq"), F.col("db_pos")]
    span = span_of(ms, span_seconds * 1000)
    steps = with_previous(judged, ["server_id"], span, order, F.struct("status"), "_prev")
    last = F.coalesce(F.col("_prev.status"), F.lit(""))
    return (steps.withColumn("last_status", last).drop("_prev")
            .where((F.col("status") != F.col("last_status")) & (F.col("level") > 0)))
