"""The three ways a change log is used, end to end. Each works on a batch and on a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow import schema as S
from changeflow.operators.bulk import DEFAULT_BULK_SIZE, DEFAULT_FLUSH_SECONDS, bulk_errors
from changeflow.operators.docs import latest_requests
from changeflow.operators.mapping import Rule, check_rules, rules_frame, to_requests
from changeflow.operators.sqllog import sql_log
from changeflow.sources.bulk import send_settled, write_bulk, write_bulk_stream
from changeflow.sources.files import write_sql_log
from changeflow.sources.kafka import read_changes_kafka, write_changes_kafka
from changeflow.streaming.health import run_alerts
from changeflow.streaming.runner import OnBatch, handle_messages, notify_close, per_event, run


class BulkFailed(RuntimeError):
    """The index refused requests."""


def trace(changes: DataFrame, path: str, checkpoint: str | None = None, **how) -> StreamingQuery | None:
    """Change events as SQL lines; ``how`` goes to ``sql_log``."""
    return write_sql_log(sql_log(changes, **how), path, checkpoint)


def search_requests(changes: DataFrame, rules: Iterable[Rule], skip_no_pk: bool = True, **how) -> DataFrame:
    """Checked rules applied to changes."""
    rules = list(rules)
    check_rules(rules, skip_no_pk)
    return to_requests(changes, rules_frame(changes.sparkSession, rules), skip_no_pk, **how)


def settled_requests(requests: DataFrame) -> DataFrame:
    """One request per document that leaves the index as all of them would: a put of the last image, a delete,
    or an update where there were only updates. Puts are sent as ``index``, so sending twice is harmless."""
    last = latest_requests(requests, addressed_only=False).select("*", "version.*")
    put = F.col("whole") & (F.col("action") != S.DELETE)
    return last.withColumn("action", F.when(put, F.lit(S.INDEX)).otherwise(F.col("action")))


def send_requests(requests: DataFrame, transport: Callable[[str], tuple[int, str]],
                  bulk_size: int = DEFAULT_BULK_SIZE, **retry) -> None:
    """Sends settled requests in bodies of at most ``bulk_size``; raises if any was refused to the end. ``retry`` (``attempts``,
    ``backoff_seconds``) is how refused requests are sent again, by themselves.

    A document is in one body only, so bodies go out side by side, each packed in the task that has its requests.
    """
    refused = bulk_errors(send_settled(settled_requests(requests), transport, bulk_size, **retry), body="response").agg(
        F.count("*").alias("n"), F.min("message").alias("first")).first()
    if refused["n"]:
        raise BulkFailed(f"{refused['n']} requests refused, such as: {refused['first']}")


def search_files(changes: DataFrame, rules: Iterable[Rule], path: str, bulk_size: int = DEFAULT_BULK_SIZE,
                 checkpoint: str | None = None, seconds: float = DEFAULT_FLUSH_SECONDS, **how) -> StreamingQuery | None:
    """Changes as bulk files, on a stream one folder per flush; ``how`` goes to :func:`search_requests`."""
    requests = search_requests(changes, rules, **how)
    if not requests.isStreaming:
        write_bulk(requests, path, bulk_size)
        return None
    if checkpoint is None:
        raise ValueError("a stream to files needs a checkpoint")
    return write_bulk_stream(requests, path, checkpoint, bulk_size, seconds=seconds)


def search_sync(changes: DataFrame, rules: Iterable[Rule], transport: Callable[[str], tuple[int, str]], checkpoint: str,
                bulk_size: int = DEFAULT_BULK_SIZE, seconds: float = DEFAULT_FLUSH_SECONDS, skip_no_pk: bool = True, **how) -> StreamingQuery:
    """A stream of changes kept in step with an index; a refused request stops it before the batch is committed."""
    requests = search_requests(changes, rules, skip_no_pk)
    return run(requests, lambda batch, _: send_requests(batch, transport, bulk_size), checkpoint, seconds, **how)


def pipe(changes: DataFrame, brokers: list[str], topic: str, checkpoint: str | None = None, **how) -> StreamingQuery | None:
    """Change events into a topic; ``how`` goes to ``write_changes_kafka``."""
    return write_changes_kafka(changes, brokers, topic, checkpoint, **how)


def consume(spark: SparkSession, brokers: list[str], topic: str, on_batch: OnBatch, checkpoint: str,
            start: str = "latest", offsets: str | None = None, **how) -> StreamingQuery:
    """A handler on the events of a topic. The checkpoint moves on once it succeeded; with ``offsets``, a table at
    that path does too. ``how`` goes to ``run``."""
    events = read_changes_kafka(spark, brokers, topic, start)
    if offsets is None:
        return run(events, on_batch, checkpoint, **how)
    return handle_messages(events, on_batch, offsets, checkpoint, **how)


def start(changes: DataFrame, samples: DataFrame, on_event: Callable[[Row], None], on_alert: OnBatch, on_close: Callable[[str | None], None],
          checkpoint: str, *, delay: str, seconds: float | None = None, available_now: bool = False) -> list[StreamingQuery]:
    """One handler for events, alerts and the end. Events of a row come in log order; alerts as micro-batches. If either handler
    raises, or one of the two queries ends, the other is stopped, and ``on_close`` is called once with the error
    or None. ``delay`` is how far servers' samples may be apart."""
    how = {"seconds": seconds, "available_now": available_now}

    def both() -> list[StreamingQuery]:
        queries = [run(changes, per_event(on_event), f"{checkpoint}/events", **how)]
        try:
            return [*queries, run_alerts(samples, on_alert, f"{checkpoint}/alerts", delay=delay, **how)]
        except BaseException:
            queries[0].stop()
            raise

    return notify_close(changes.sparkSession, both, on_close)
