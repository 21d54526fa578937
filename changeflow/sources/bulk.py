"""Bulk bodies to files or through a transport."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators.bulk import DEFAULT_BULK_SIZE, DEFAULT_FLUSH_SECONDS, bulk_size_or_default
from changeflow.operators.mapping import bulk_line
from changeflow.sources import bulk_files

#: How often a refused request is sent at most, and the first pause before it is sent again.
DEFAULT_ATTEMPTS = 3
DEFAULT_BACKOFF_SECONDS = 0.5


def write_bulk(requests: DataFrame, path: str, bulk_size: int = DEFAULT_BULK_SIZE, bodies_per_file: int = 0,
               mode: str = "error") -> None:
    """Newline-delimited JSON files (see :mod:`changeflow.sources.bulk_files`): one per shard and part of the log, or for every
    ``bodies_per_file`` bodies of at most ``bulk_size`` requests. Sorted by name and posted so, a document gets its requests in log
    order; any file is a valid body again. The requests are computed once and shuffled once.

    ``mode`` is ``error`` (if there are files), ``overwrite`` or ``append``.
    """
    if mode == "error" and bulk_files.Folder(path).files():
        raise FileExistsError(f"there are files in {path}")
    bulk_files.register(requests.sparkSession)
    (bulk_files.bulk_rows(requests).write.format("bulk").mode("overwrite" if mode == "overwrite" else "append")
     .option("bulkSize", bulk_size).option("bodiesPerFile", bodies_per_file).save(path))


def write_bulk_stream(requests: DataFrame, path: str, checkpoint: str, bulk_size: int = DEFAULT_BULK_SIZE, bodies_per_file: int = 0,
                      seconds: float = DEFAULT_FLUSH_SECONDS, available_now: bool = False) -> StreamingQuery:
    """As :func:`write_bulk`, a folder per micro-batch. A micro-batch that is repeated leaves no file twice."""
    bulk_files.register(requests.sparkSession)
    writer = (bulk_files.bulk_rows(requests).writeStream.format("bulk").option("bulkSize", bulk_size).option("bodiesPerFile", bodies_per_file)
              .option("checkpointLocation", checkpoint).option("path", path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{int(seconds * 1000)} milliseconds")
    return writer.start()


def refused_places(code: int, response: str, requests: int) -> tuple[list[int], list[dict]] | None:
    """Places of the refused requests in a body, and the items of its answer. None if the answer does not tell of each request: then
    nothing is known of any, and sending the body again would be a guess."""
    try:
        items = json.loads(response).get("items")
    except (ValueError, AttributeError):
        return None
    if not isinstance(items, list) or len(items) != requests or not all(isinstance(x, dict) and x for x in items):
        return None
    return [i for i, item in enumerate(items) if any(isinstance(told, dict) and told.get("error") for told in item.values())], items


def post_lines(lines: list[str], transport: Callable[[str], tuple[int, str]], attempts: int = DEFAULT_ATTEMPTS,
               backoff_seconds: float = DEFAULT_BACKOFF_SECONDS) -> tuple[int, str, int]:
    """(code, answer, bodies sent) of a body of request lines. Requests that the answer names as refused, and only these, are sent again, up
    to ``attempts`` times with twice the pause each time; the answer is that of the whole body, with each request's last item."""
    code, response = transport("\n".join(lines) + "\n")
    told = refused_places(code, response, len(lines))
    sent = 1
    if told is None or not told[0]:
        return code, response, sent
    left, items = told
    while left and sent < attempts:
        time.sleep(backoff_seconds * 2 ** (sent - 1))
        again, text = transport("\n".join(lines[i] for i in left) + "\n")
        sent += 1
        told = refused_places(again, text, len(left))
        if told is None:
            break
        for i, item in zip(left, told[1]):
            items[i] = item
        left = [left[k] for k in told[0]]
    return (200 if not left else code), json.dumps({"took": 0, "errors": bool(left), "items": items}), sent


def send_settled(requests: DataFrame, transport: Callable[[str], tuple[int, str]], bulk_size: int = DEFAULT_BULK_SIZE,
                 attempts: int = DEFAULT_ATTEMPTS, backoff_seconds: float = DEFAULT_BACKOFF_SECONDS) -> DataFrame:
    """``requests, code, response, sent`` for each body. For one request per document (``latest_requests``): as
    their order does not matter, each task packs what it has into full bodies, without a window or a shuffle, and refused
    requests can be sent again after others (:func:`post_lines`)."""
    size = bulk_size_or_default(bulk_size)
    line = bulk_line(*(F.col(c) for c in ("action", "index", "id", "parent", "pipeline", "data")))

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[str] = []

        def post(lines: list[str]) -> pd.DataFrame:
            code, response, sent = post_lines(lines, transport, attempts, backoff_seconds)
            return pd.DataFrame({"requests": [len(lines)], "code": [code], "response": [response], "sent": [sent]})

        for frame in frames:
            held += frame["line"].tolist()
            while len(held) >= size:
                yield post(held[:size])
                held = held[size:]
        if held:
            yield post(held)

    return requests.select(line.alias("line")).mapInPandas(send, "requests bigint, code int, response string, sent int")


def send_bulk(bodies: DataFrame, transport: Callable[[str], tuple[int, str]]) -> DataFrame:
    """``batch, code, response``: what ``transport(body) -> (code, response text)`` gave for each body.

    Runs in the tasks, a batch at a time; an exception fails the job and Spark retries the task, so a body
    may be sent twice. Tasks run side by side: send the result of ``latest_requests``, one request per
    document, where the order of a document's requests matters. Feed the result to ``bulk_errors``.
    """
    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = [transport(body) for body in frame["body"]]
            yield pd.DataFrame({"batch": frame["batch"], "code": [a[0] for a in answers],
                                "response": [a[1] for a in answers]})

    batch = bodies.schema["batch"].dataType.simpleString()
    return bodies.select(F.to_json("batch").alias("batch"), "body").mapInPandas(
        send, "batch string, code int, response string").withColumn("batch", F.from_json("batch", batch))
