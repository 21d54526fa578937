"""Requests in batches, batches as bodies, and what came back for them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from changeflow import schema as S
from changeflow.functions.numbers import floor_div
from changeflow.functions.positions import log_seq
from changeflow.operators.mapping import bulk_line

DEFAULT_BULK_SIZE = 128
DEFAULT_FLUSH_SECONDS = 3
DEFAULT_SHARDS = 64

#: A batch never crosses a block of this many log bytes, which bounds the rows numbered by one task.
BLOCK_BYTES = 64 * 1024 * 1024


def bulk_size_or_default(size: int) -> int:
    return size if size > 0 else DEFAULT_BULK_SIZE


def flush_seconds_or_default(seconds: float) -> float:
    return seconds if seconds >= 1 else DEFAULT_FLUSH_SECONDS


def shard_of(shards: int = DEFAULT_SHARDS) -> Column:
    """Requests of one document share a shard; those without an id are spread by their place in the log."""
    document = F.when(F.length("id") > 0, F.xxhash64("index", "id")).otherwise(F.xxhash64(*S.ORDER_COLUMNS))
    return F.pmod(document, F.lit(shards))


def log_block(block_bytes: int = BLOCK_BYTES) -> list[Column]:
    """The part of the log a request comes from: server, file and block of the file."""
    return [F.col("server_id"), log_seq(F.col("log_name")).alias("log_seq"),
            floor_div(F.col("log_pos"), block_bytes).alias("log_block")]


def batch_requests(requests: DataFrame, bulk_size: int = DEFAULT_BULK_SIZE, shard: Column | None = None,
                   span: Sequence[Column] | None = None) -> DataFrame:
    """Adds ``batch``: the struct (shard, span fields, no) of the batch a request is sent in, and ``seq``, its
    place there. Batches hold at most ``bulk_size`` requests.

    A batch is flushed when it is full or when its span ends. Spans (default: blocks of the log) follow each
    other, so the order of a document's requests is (span, no, seq); and as a span bounds the rows of a window
    partition, neither a hot document nor a hot server ends up in one task. Copies of an event share its place
    in the log: drop them before (``dedup_changes``).
    """
    size = bulk_size_or_default(bulk_size)
    span = log_block() if span is None else list(span)
    parts = {f"_span{i}": column for i, column in enumerate(span)}
    names = [requests.select(column).columns[0] for column in span]
    marked = requests.withColumns({"_shard": shard_of() if shard is None else shard, **parts})
    place = Window.partitionBy("_shard", *parts).orderBy(
        "server_id", log_seq(F.col("log_name")), "log_pos", "row_ordinal")
    number = (F.row_number().over(place) - 1).cast("bigint")
    key = F.struct(F.col("_shard").alias("shard"), *(F.col(p).alias(n) for p, n in zip(parts, names)),
                   floor_div(F.col("_number"), size).alias("no"))
    return (marked.withColumn("_number", number)
            .withColumns({"batch": key, "seq": F.col("_number") % size})
            .drop("_shard", "_number", *parts))


def batch_by_time(requests: DataFrame, seconds: float = DEFAULT_FLUSH_SECONDS) -> DataFrame:
    """Adds ``flush_at``: the end of the flush interval the request is sent at. No shuffle.

    For a flush by size within each interval pass ``span=[col("flush_at"), *log_block()]`` to
    :func:`batch_requests`. On a stream the interval is the trigger.
    """
    width = flush_seconds_or_default(seconds)
    at = F.window(F.timestamp_seconds("timestamp"), f"{int(width * 1000)} milliseconds")
    # ``window`` must stand alone in a projection, so it gets a column of its own first.
    return (requests.withColumn("_flush", at)
            .withColumn("flush_at", F.unix_seconds(F.col("_flush")["end"]))
            .drop("_flush"))


def bulk_bodies(batched: DataFrame) -> DataFrame:
    """``batch, requests, body``: one row per batch, its requests as newline-delimited JSON in order.

    The lists are bounded by the bulk size, and the batches of a window partition are still together, so
    nothing is shuffled again.
    """
    line = bulk_line(*(F.col(c) for c in ("action", "index", "id", "parent", "pipeline", "data")))
    fields = [f.name for f in batched.schema["batch"].dataType]
    flat = batched.select(*(F.col(f"batch.{f}").alias(f) for f in fields), F.struct("seq", line.alias("line")).alias("r"))
    ordered = F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"])
    bodies = flat.groupBy(*fields).agg(
        F.count("*").alias("requests"), F.concat(F.array_join(ordered, "\n"), F.lit("\n")).alias("body"))
    return bodies.select(F.struct(*fields).alias("batch"), "requests", "body")


# --- fixed values: error texts of a bulk answer ---------------------------------
WHOLE_ERROR = "bulk request failed with status "
ITEM_ERROR = (" index: ", ", type: ", ", id: ", ", status: ", ", error: ")
# ------------------------------------------------------------------------------
UNREADABLE = "unreadable bulk response with status "

RESPONSE_SCHEMA = (
    "_malformed string, took bigint, errors boolean, items array<map<string, struct<_index: string, _type: string, _id: string, "
    "_version: bigint, status: bigint, error: string, found: boolean>>>"
)


def bulk_errors(responses: DataFrame, code: str = "code", body: str = "body") -> DataFrame:
    """One row per failed item, and one per response that failed as a whole (not 2xx, no item error) or that cannot be
    read (cut off, no JSON, or without items): what it says of its requests is not known.

    Keeps the other columns of ``responses``; adds ``action, index, type, id, status, error, message``.
    """
    kept = [c for c in responses.columns if c != body]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    parsed = responses.select(*kept, F.from_json(body, RESPONSE_SCHEMA, options).alias("_r"))
    unreadable = F.col("_r").isNull() | F.col("_r._malformed").isNotNull() | F.col("_r.items").isNull()
    items = F.flatten(F.transform(F.coalesce(F.col("_r.items"), F.array()), lambda item: F.transform(
        F.map_entries(item), lambda e: F.struct(
            e["key"].alias("action"), e["value"]["_index"].alias("index"), e["value"]["_type"].alias("type"),
            e["value"]["_id"].alias("id"), e["value"]["status"].alias("status"), e["value"]["error"].alias("error")))))
    failed = F.filter(items, lambda i: F.length(i["error"]) > 0)
    not_ok = F.coalesce((F.col(code) < 200) | (F.col(code) >= 300), F.lit(True))
    whole = F.array(F.struct(
        F.lit("").alias("action"), F.lit("").alias("index"), F.lit("").alias("type"), F.lit("").alias("id"),
        F.col(code).cast("bigint").alias("status"),
        F.concat(F.when(not_ok, F.lit(WHOLE_ERROR)).otherwise(F.lit(UNREADABLE)), F.coalesce(F.col(code).cast("string"), F.lit("none"))).alias("error")))
    rows = F.transform(F.array(failed), lambda f: F.when((F.size(f) == 0) & (not_ok | unreadable), whole).otherwise(f))[0]
    action, index, kind, id_, status, error = (
        F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("action", "index", "type", "id", "status", "error"))
    parts = (index, kind, id_, status, error)
    message = F.concat(action, *(x for text, part in zip(ITEM_ERROR, parts) for x in (F.lit(text), part)))
    return parsed.select(*kept, F.inline(rows)).withColumn("message", message)
