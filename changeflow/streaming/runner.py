"""Handlers on a stream of change events.

A handler is a function of a micro-batch. If it raises, the query stops and the batch is not committed, so a
restart from the checkpoint hands it over again: at least once, nothing skipped.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from changeflow.operators.offsets import latest_offsets, order_changes
from changeflow.operators.progress import drop_unchanged, save_points
from changeflow.streaming.state import Newest

OnBatch = Callable[[DataFrame, int], None]


def run(changes: DataFrame, on_batch: OnBatch, checkpoint: str, seconds: float | None = None,
        available_now: bool = False, name: str | None = None) -> StreamingQuery:
    """Starts the handler on a stream. ``seconds`` is the time between batches (the flush interval);
    ``available_now`` handles what is there and ends. The checkpoint folder is the saved position."""
    writer = changes.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif seconds is not None:
        writer = writer.trigger(processingTime=f"{int(seconds * 1000)} milliseconds")
    return writer.start()


def per_event(on_event: Callable[[Row], None], ordered: bool = True) -> OnBatch:
    """A handler of single events as a handler of batches. It is called in the tasks, not on the driver. The changes of a row
    are in one task, in log order; tasks run side by side. ``ordered=False`` saves the shuffle and keeps no order."""
    def each(rows: Iterable[Row]) -> None:
        for row in rows:
            on_event(row)

    return lambda batch, _: (order_changes(batch, whole_rows=True) if ordered else batch).foreachPartition(each)


class _Closing(StreamingQueryListener):
    """Waits for the ends of queries. It listens before they start, so an early end is not missed, and knows them by run,
    so a restart from the same checkpoint is another matter."""

    def __init__(self, spark: SparkSession, on_close: Callable[[str | None], None]):
        self.spark, self.on_close = spark, on_close
        self.lock = threading.Lock()
        self.ended: dict[str, str | None] = {}
        self.queries: dict[str, StreamingQuery] | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended[str(event.runId)] = event.exception
        self._look()

    def watch(self, queries: list[StreamingQuery]) -> None:
        with self.lock:
            self.queries = {str(q.runId): q for q in queries}
        self._look()

    def _look(self) -> None:
        with self.lock:
            if not self.queries or not (ended := self.queries.keys() & self.ended.keys()):
                return
            others = [q for run, q in self.queries.items() if run not in ended]
            if not others:
                error = next((self.ended[run] for run in self.queries if self.ended[run]), None)
                self.queries = None
        # Not from the thread that brings the events, which the calls below would wait for.
        if others:
            threading.Thread(target=lambda: [q.stop() for q in others], daemon=True).start()
        else:
            threading.Thread(target=lambda: (self.spark.streams.removeListener(self), self.on_close(error)), daemon=True).start()


def notify_close(spark: SparkSession, start: Callable[[], StreamingQuery | list[StreamingQuery]],
                 on_close: Callable[[str | None], None]) -> list[StreamingQuery]:
    """Starts what ``start`` starts and calls ``on_close`` once when it has ended, with the error text or None. Of several
    queries the end of one stops the others."""
    listener = _Closing(spark, on_close)
    spark.streams.addListener(listener)
    try:
        queries = start()
    except BaseException:
        spark.streams.removeListener(listener)
        raise
    queries = queries if isinstance(queries, list) else [queries]
    listener.watch(queries)
    return queries


OFFSET_SCHEMA = "topic string, partition int, offset bigint"


def stored_offsets(spark: SparkSession, path: str) -> Newest:
    """Offsets of the last handled messages: ``read()`` is what ``starting_offsets`` and ``resume_messages`` take."""
    return Newest(spark, path, OFFSET_SCHEMA, ["topic", "partition"], order="offset")


def handle_messages(messages: DataFrame, on_batch: OnBatch, offsets: str, checkpoint: str, **how) -> StreamingQuery:
    """A handler on messages (with ``topic, partition, offset``) that keeps their offsets in a table, for readers
    other than the checkpoint. An offset is stored once the handler succeeded. ``how`` goes to :func:`run`."""
    table = stored_offsets(messages.sparkSession, offsets)

    def handle(batch: DataFrame, batch_id: int) -> None:
        on_batch(batch, batch_id)
        table.put(latest_offsets(batch), batch_id)

    return run(messages, handle, checkpoint, **how)


SAVED_SCHEMA = "server_id bigint, saved_at bigint, log_name string, log_pos bigint"


def save_progress(changes: DataFrame, path: str, checkpoint: str, save_seconds: float = 3, **how) -> StreamingQuery:
    """Keeps the saved positions of a stream at ``path``: :func:`saved_history` has every save, :func:`saved_positions` the newest of each
    server."""
    newest = saved_positions(changes.sparkSession, path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        points = save_points(batch, save_seconds).select("server_id", "saved_at", "log_name", "log_pos")
        marked = points.selectExpr("*", "true as fresh").unionByName(newest.before(batch_id).selectExpr("*", "false as fresh"))
        saves = drop_unchanged(marked).where("fresh").drop("fresh").persist()
        try:
            saves.write.mode("overwrite").parquet(f"{path}/history/batch_id={batch_id}")
            newest.put(saves, batch_id)
        finally:
            saves.unpersist()

    return run(changes, handle, checkpoint, **how)


def saved_positions(spark: SparkSession, path: str) -> Newest:
    return Newest(spark, f"{path}/newest", SAVED_SCHEMA, ["server_id"], order="saved_at")


def saved_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SAVED_SCHEMA).parquet(f"{path}/history").select("server_id", "saved_at", "log_name", "log_pos")
