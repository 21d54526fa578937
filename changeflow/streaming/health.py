"""Health on a stream of position samples."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from changeflow.operators.health import DEFAULT_CHECK_SECONDS, DEFAULT_THRESHOLD, GRACE_SECONDS, message, verdict
from changeflow.streaming.runner import OnBatch, run

# Times travel as microseconds, so that no time zone of a Python worker can touch them.
_SAMPLE = "us bigint, file_seq bigint, file_pos bigint, db_seq bigint, db_pos bigint, db_error string"
_FLAT_LAST = "last_file_seq bigint, last_file_pos bigint, last_db_seq bigint, last_db_pos bigint"
_CHECKED = f"server_id bigint, {_SAMPLE}, {_FLAT_LAST}, grew boolean, late boolean"
_FIELDS = ("file_seq", "file_pos", "db_seq", "db_pos")
_CheckedRow = Row("server_id", "us", *_FIELDS, "db_error", *(f"last_{f}" for f in _FIELDS), "grew", "late")
_AlertRow = Row("server_id", "us", *_FIELDS, "db_error", "level", "reasons", "status", "threshold", "check_seconds",
                "last_status")


def _in_order(rows: Iterator[Row]) -> list[Row]:
    return sorted(rows, key=lambda r: (r.us, *(r[f] for f in _FIELDS)))


class Recheck(StatefulProcessor):
    """Puts the previous sample of the server beside each sample, and holds samples whose file position did not
    move until it grew or the grace period is over. Samples are judged in the order of their time.

    Samples wait ``wait_seconds`` of their own time for older ones. What comes after a newer sample was judged is given out as late, without
    a previous sample. Once ``delay_seconds`` have passed by the clock, nothing waits any longer.

    The state of a server is its last sample, and the samples of the grace period and of the wait.
    """

    def __init__(self, grace_seconds: float, wait_seconds: float = 0, delay_seconds: float = 0):
        self.grace_ms, self.wait_us, self.delay_ms = int(grace_seconds * 1000), int(wait_seconds * 1_000_000), int(delay_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us bigint, file_seq bigint, file_pos bigint, db_seq bigint, db_pos bigint, newest bigint")
        self.held = handle.getListState("held", f"{_SAMPLE}, {_FLAT_LAST}, grew boolean")
        self.waiting = handle.getListState("waiting", _SAMPLE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        came = list(rows)
        arrived = max(r.arrived for r in came)
        yield from self._go_on(key[0], [(r.us, *(r[f] for f in _FIELDS), r.db_error) for r in came], False)
        self._wake(arrived + self.delay_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._go_on(key[0], [], True)

    def _go_on(self, server: int, came: list[tuple], over: bool) -> Iterator[Row]:
        """Judges what can be judged; all of it if the time is over."""
        held = [list(r) for r in self.held.get()] if self.held.exists() else []
        *last, newest = tuple(self.last.get()) if self.last.exists() else (None, None)
        waiting = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        newest = max([s[0] for s in came] + ([] if newest is None else [newest]), default=None)
        left = []
        for sample in sorted(waiting + came, key=lambda s: s[:5]):
            us, *place, error = sample
            if last[0] is not None and us < last[0]:
                yield _CheckedRow(server, us, *place, error, *place, False, True)
                continue
            if not over and us > newest - self.wait_us:
                left.append(sample)
                continue
            now = us // 1000
            file = tuple(place[:2])
            for h in held:
                if 1 <= now - h[0] // 1000 <= self.grace_ms and file > (h[1], h[2]):
                    h[-1] = True
            held.append([us, *place, error, *(place if last[0] is None else last[1:]), False])
            last = [us, *place]
            # Released at once: what is held stays within the grace period, however long the batch is.
            done = self._settled(held, now)
            yield from (_CheckedRow(server, *h, False) for h in held[:done])
            del held[:done]
        if over:
            yield from (_CheckedRow(server, *h, False) for h in held)
            held = []
        if last[0] is not None or newest is not None:
            self.last.update((*(last if last[0] is not None else [None] * 5), newest))
        for state, value in ((self.held, held), (self.waiting, left)):
            if value:
                state.put([tuple(v) for v in value])
            else:
                state.clear()

    def _settled(self, held: list[list], now_ms: int) -> int:
        """How many of the first held samples can be judged."""
        for n, h in enumerate(held):
            if (h[1], h[2]) == (h[6], h[7]) and not h[-1] and h[0] // 1000 + self.grace_ms >= now_ms:
                return n
        return len(held)

    def _wake(self, at_ms: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if self.held.exists() or self.waiting.exists():
            self.handle.registerTimer(at_ms)

    def close(self) -> None:
        pass


class Changed(StatefulProcessor):
    """Lets through samples whose status is not the last one and not green."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.status = handle.getValueState("status", "status string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = self.status.get()[0] if self.status.exists() else ""
        for row in _in_order(rows):
            if row.status != last and row.level > 0:
                yield _AlertRow(*row, last)
            last = row.status
        self.status.update((last,))

    def close(self) -> None:
        pass


def health_stream(samples: DataFrame, threshold: int = DEFAULT_THRESHOLD, grace_seconds: float = GRACE_SECONDS,
                  *, delay: str, wait_seconds: float = 0, check_seconds: float = DEFAULT_CHECK_SECONDS) -> DataFrame:
    """As ``health``, live: only the memory of a server is state, the verdict is the batch one. Every sample comes out once.

    Samples may be out of order by ``wait_seconds``: they are judged that much later. Older ones come out with ``late`` true and no verdict.
    A stuck sample is judged when a sample of its server shows that the grace period is over. Without newer samples, what is held and
    waits is judged ``delay`` after it arrived, as soon as any server's samples arrive then: state is told by the time of arrival, so
    Spark drops nothing.
    """
    ts = F.col("ts").cast("timestamp")
    processor = Recheck(grace_seconds, wait_seconds, pd.Timedelta(delay).total_seconds())
    checked = (samples.select("server_id", F.unix_micros(ts).alias("us"), *_FIELDS, "db_error")
               .withColumn("arrived_at", F.current_timestamp()).withColumn("arrived", F.unix_millis("arrived_at"))
               .withWatermark("arrived_at", "1 second").groupBy("server_id")
               .transformWithState(processor, _CHECKED, "append", "eventTime"))
    last = F.struct(
        F.struct(F.col("last_file_seq").alias("file_seq"), F.col("last_file_pos").alias("file_pos")).alias("file"),
        F.struct(F.col("last_db_seq").alias("db_seq"), F.col("last_db_pos").alias("db_pos")).alias("db"))
    in_time = ~F.col("late")
    judged = checked.withColumn("last", last).withColumns({c: F.when(in_time, v) for c, v in verdict(threshold).items()})
    told = judged.withColumns({c: F.when(in_time, v) for c, v in message(threshold, check_seconds).items()})
    return told.select("server_id", F.timestamp_micros("us").alias("ts"), *_FIELDS, "db_error", "level", "reasons", "status",
                       "threshold", "check_seconds", "late")


def alerts_stream(judged: DataFrame) -> DataFrame:
    """As ``alerts``, on the result of :func:`health_stream`; late samples raise none."""
    schema = (f"server_id bigint, {_SAMPLE}, level int, reasons array<string>, status string, threshold bigint, "
              "check_seconds double, last_status string")
    timed = judged.where(~F.col("late")).withColumn("us", F.unix_micros("ts")).drop("ts", "late")
    raised = (timed.select("server_id", "us", *(c for c in timed.columns if c not in ("server_id", "us")))
              .groupBy("server_id").transformWithState(Changed(), schema, "append", "none"))
    return raised.withColumn("us", F.timestamp_micros("us")).withColumnRenamed("us", "ts")


def run_alerts(samples: DataFrame, on_alert: OnBatch, checkpoint: str, threshold: int = DEFAULT_THRESHOLD, *, delay: str,
               **how) -> StreamingQuery:
    """Calls ``on_alert`` with the new alerts of each micro-batch that has any."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        # Kept, so that the stateful plan below runs once and to its end, whatever the handler reads of it.
        raised = batch.persist()
        try:
            if raised.count():
                on_alert(raised, batch_id)
        finally:
            raised.unpersist()

    return run(alerts_stream(health_stream(samples, threshold, delay=delay)), handle, checkpoint, **how)
