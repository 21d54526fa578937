"""Topic offsets, repeats and order."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from changeflow import schema as S
from changeflow.functions.cells import cell_text, sorted_entries
from changeflow.functions.positions import log_seq

PARTITION = ["topic", "partition"]


def configured_offset(use_oldest: bool = False, offset: int | None = None) -> int:
    """The oldest flag beats an explicit offset, which beats newest."""
    if use_oldest:
        return S.OLDEST_OFFSET
    return S.NEWEST_OFFSET if offset is None else offset


def starting_offsets(partitions: DataFrame, stored: DataFrame, use_oldest: bool = False,
                     offset: int | None = None) -> DataFrame:
    """``topic, partition, start``: a stored offset (``topic, partition, offset``) beats the configured one."""
    known = stored.select(*PARTITION, F.col("offset").alias("_stored"))
    default = F.lit(configured_offset(use_oldest, offset)).cast("bigint")
    return (partitions.select(*PARTITION).distinct().join(known, PARTITION, "left")
            .select(*PARTITION, F.coalesce("_stored", default).alias("start")))


def starting_offsets_json(starts: DataFrame) -> str:
    """The ``startingOffsets`` option text. One number per topic partition, so small enough for the driver."""
    by_topic = starts.groupBy("topic").agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct(F.col("partition").cast("string"), "start")))).alias("p"))
    row = by_topic.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct("topic", F.to_json("p").alias("p")))))).alias("j")).first()
    return json.dumps({topic: json.loads(p) for topic, p in json.loads(row["j"]).items()})


def latest_offsets(messages: DataFrame) -> DataFrame:
    """``topic, partition, offset``: the last handled offset, as it is stored."""
    return messages.groupBy(*PARTITION).agg(F.max("offset").alias("offset"))


def resume_messages(messages: DataFrame, stored: DataFrame, default: int = 0, inclusive: bool = True) -> DataFrame:
    """Messages from the stored offset of their partition on, else from ``default``: an offset, ``OLDEST_OFFSET`` for all, or
    ``NEWEST_OFFSET`` for those to come, which is none of ``messages``. The stored offset is that of the last handled
    message, which ``inclusive`` delivers again."""
    known = stored.select(*PARTITION, F.col("offset").alias("_stored"))
    offset = F.col("offset")
    after = (offset >= F.col("_stored")) if inclusive else (offset > F.col("_stored"))
    return (messages.join(known, PARTITION, "left")
            .where(F.coalesce(after, F.lit(False) if default == S.NEWEST_OFFSET else offset >= default))
            .select(*messages.columns))


#: What tells events apart. Position alone does not: a header position is shared by the rows of a statement, by the tables
#: it names, and by the schema change itself.
EVENT_KEY = ["server_id", "log_name", "log_pos", "row_ordinal", "event_type", "db", "table"]


def placed() -> Column:
    """Whether the event says which log file it is from. Without, two events cannot be known to be one."""
    return F.length(F.coalesce("log_name", F.lit(""))) > 0


def dedup_changes(changes: DataFrame) -> DataFrame:
    """One of each event delivered more than once. Copies meet in the task that reads them first. Events without a
    known log file are all kept: they are counted by content, and come out as often as they came in."""
    content = F.when(~placed(), F.to_json(F.struct(*(F.col(f"`{c}`") for c in changes.columns))))
    rest = [c for c in changes.columns if c not in EVENT_KEY]
    one = changes.withColumn("_content", content).groupBy(*EVENT_KEY, "_content").agg(
        *(F.first(F.col(f"`{c}`")).alias(c) for c in rest), F.count("*").alias("_copies"))
    copies = F.when(F.col("_content").isNull(), 1).otherwise(F.col("_copies")).cast("int")
    return one.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*changes.columns)


def dedup_stream(changes: DataFrame, delay: str) -> DataFrame:
    """As :func:`dedup_changes`, on a stream: copies that arrive within ``delay`` of each other. ``arrived_at`` is added, the time
    of the micro-batch: state is dropped by it, so an event is never too late, however old it is."""
    timed = changes.withColumns({"arrived_at": F.current_timestamp(), "_alone": F.when(~placed(), F.uuid())})
    return timed.withWatermark("arrived_at", delay).dropDuplicatesWithinWatermark([*EVENT_KEY, "_alone"]).drop("_alone")


#: Events that a task sorts at once where the number of partitions follows the input: some 200 MB.
EVENTS_IN_PARTITION = 400_000


def row_key() -> Column:
    """Key values of the changed row, as text; the whole image where a table has no key."""
    image = F.when(F.size("after") > 0, F.col("after")).otherwise(F.col("before"))
    keyed = F.transform("primary", lambda n: F.element_at(image, n))
    cells = F.when(F.size("primary") > 0, keyed).otherwise(F.transform(sorted_entries(image), lambda e: e["value"]))
    return F.array_join(F.transform(cells, cell_text), ":", "")


def order_changes(changes: DataFrame, partitions: int | None = None, whole_rows: bool = False) -> DataFrame:
    """Changes of a row in log order, as partitions that follow each other.

    Ranges of (server, table, row, position), sorted inside: the changes of a row are in order within a
    partition and from one partition to the next, and a hot row is cut by position, not kept in one task. That
    suits files. Where tasks act side by side (handlers, senders), ``whole_rows`` keeps all changes of a row in one
    task; use it within a micro-batch, whose size ``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger`` bounds.
    Copies of an event share its place: drop them before (:func:`dedup_changes`).
    """
    order = [F.col("server_id"), F.col("db"), F.col("table"), F.col("_key"), F.col("_seq"), F.col("log_pos"),
             F.col("row_ordinal")]
    keyed = changes.withColumns({"_key": row_key(), "_seq": log_seq(F.col("log_name"))})
    dealt = order[:4] if whole_rows else order
    ranged = keyed.repartitionByRange(partitions, *dealt) if partitions else keyed.repartitionByRange(*dealt)
    return ranged.sortWithinPartitions(*order).drop("_key", "_seq")


def partitions_for(changes: DataFrame, least: int = 1, events: int = EVENTS_IN_PARTITION) -> int:
    """How many partitions keep a partition at a bounded number of events, however many changes there are. Counts them, in a pass that reads no images."""
    return max(least, -(-changes.count() // events))


def _neighbours(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """For each row but the first: whether it comes before the row it lies behind, and whether it is equal to that, as Spark compares, nulls first."""
    n = len(columns[0]) - 1
    falls, same = np.zeros(n, bool), np.ones(n, bool)
    for column in columns:
        filled = pc.fill_null(column, 0 if pa.types.is_integer(column.type) else "")
        for x in (pc.cast(column.is_valid(), pa.int8()), filled) if column.null_count else (column,):
            falls |= same & pc.greater(x[:-1], x[1:]).to_numpy(zero_copy_only=False)
            same &= pc.equal(x[:-1], x[1:]).to_numpy(zero_copy_only=False)
    return falls, same


def _breaks_inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per server and table of a partition: events, those that come before the one they lie behind, first and last event with their places."""
    found: dict[tuple, list] = {}
    before, part, schema = None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        schema, part = batch.schema, batch.column("_part")[0].as_py()
        key, server, table, place = (batch.column(c) for c in ("_key", "server_id", "table", "_place"))
        behind = key if before is None else pa.concat_arrays([before, key])
        falls = _neighbours(behind.flatten())[0]
        falls = np.append(False, falls) if before is None else falls
        before = key[-1:]
        starts = np.append(0, np.flatnonzero(~_neighbours([server, table])[1]) + 1)
        ends = np.append(starts[1:], batch.num_rows)
        for at, to, breaks in zip(starts.tolist(), ends.tolist(), np.add.reduceat(falls.astype(np.int64), starts).tolist()):
            of = server[at].as_py(), table[at].as_py()
            if (row := found.get(of)) is None:
                row = found[of] = [0, 0, place[at].as_py(), key[at].as_py(), None, None]
            row[0] += to - at
            row[1] += breaks
            row[4], row[5] = key[to - 1].as_py(), place[to - 1].as_py()
    if found:
        names = ["_part", "server_id", "table", "events", "breaks", "at", "first", "last", "to"]
        types = [*(schema.field(c).type for c in names[:3]), *[pa.int64()] * 3, *[schema.field("_key").type] * 2, pa.int64()]
        rows = [(part, *of, *row) for of, row in found.items()]
        yield pa.RecordBatch.from_arrays([pa.array(column, t) for column, t in zip(zip(*rows), types)], names=names)


def order_breaks(ordered: DataFrame) -> DataFrame:
    """``server_id, table, events, breaks``: how often an event of the DataFrame, taken as it lies, comes before the one it lies behind, in the
    order of :func:`order_changes`. No breaks prove the order of the whole, from partition to partition.

    Each partition is compared within itself, in one pass that keeps a batch of events and moves none; what is left is a row per
    partition and table with its first and last event, and the borders are compared on these."""
    key = F.struct("server_id", "db", "table", row_key().alias("key"), log_seq(F.col("log_name")).alias("seq"), "log_pos", "row_ordinal")
    lying = ordered.select("server_id", "table", key.alias("_key"), F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place"))
    types = {f.name: f.dataType for f in lying.schema}
    schema = T.StructType([T.StructField(name, types[of]) for name, of in (
        ("_part", "_part"), ("server_id", "server_id"), ("table", "table"), ("events", "_place"), ("breaks", "_place"), ("at", "_place"),
        ("first", "_key"), ("last", "_key"), ("to", "_place"))])
    parts = lying.mapInArrow(_breaks_inside, schema)
    before = Window.orderBy("at")
    # The event before a partition's first one is the last that lies in any partition before it.
    edge = F.max(F.struct("to", "last")).over(before.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.lag("_part").over(before) != F.col("_part"), F.lit(False))
    border = (opens & (edge["last"] > F.col("first"))).cast("bigint")
    return (parts.withColumn("_border", F.coalesce(border, F.lit(0))).groupBy("server_id", "table")
            .agg(F.sum("events").alias("events"), (F.sum("breaks") + F.sum("_border")).alias("breaks")))
