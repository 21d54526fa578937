"""Raw log events -> change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from changeflow import schema as S
from changeflow.functions.numbers import span_of

#: Events of one file that share a window partition. ``event_seq`` is unique within a file, so this bounds
#: the rows of a task however large a file or a server is.
SPAN_EVENTS = 1_000_000


def zip_fields(columns: Column, values: Column) -> Column:
    """Column names x row values, by index. Fewer values than columns leave the last columns out."""
    return F.map_from_arrays(F.slice(columns, F.lit(1), F.size(values)), values)


def pk_names(columns: Column, pk_idx: Column) -> Column:
    """Names at the key's column indexes, in key order."""
    return F.transform(pk_idx, lambda i: F.get(columns, i))


def _image(ordinal: Column, before: Column, after: Column) -> Column:
    return F.struct(ordinal.cast("bigint").alias("row_ordinal"), before.alias("before"), after.alias("after"))


def _images(action: Column, columns: Column, rows: Column) -> Column:
    """Array of (row_ordinal, before, after): updates hold pairs of rows, inserts and deletes single ones. An action of another
    name gives one event without images."""
    none = S.empty_cells()
    inserted = F.transform(rows, lambda r, i: _image(i, none, zip_fields(columns, r)))
    deleted = F.transform(rows, lambda r, i: _image(i, zip_fields(columns, r), none))
    pairs = F.filter(F.transform(rows, lambda r, i: F.struct(
        i.alias("i"), r.alias("old"), F.get(rows, i + 1).alias("new"))), lambda p: p["i"] % 2 == 0)
    updated = F.transform(pairs, lambda p: _image(
        F.floor(p["i"] / 2), zip_fields(columns, p["old"]), zip_fields(columns, p["new"])))
    return F.when(action == S.INSERT, inserted).when(action == S.DELETE, deleted).when(action == S.UPDATE, updated).otherwise(
        F.array(_image(F.lit(0), none, none)))


def row_images(raw: DataFrame) -> DataFrame:
    """One row per changed row: ``row_ordinal, before, after`` for each row (pair) of a row event."""
    rows = raw.where(F.col("event_kind") == "row")
    return rows.select("*", F.inline(_images(F.col("action"), F.col("columns"), F.col("rows")))).drop("rows")


def carry_position(raw: DataFrame, start: DataFrame | None = None, span_events: int = SPAN_EVENTS) -> DataFrame:
    """Adds ``log_name, next_pos, gtid_set``: where the log stands after each event.

    File name and position move together: a rotate, schema change or commit moves both, and only if it names the
    file; an event of another kind is in the file named last. The GTID is held until the next one. ``start`` (``server_id, log_name, log_pos,
    gtid_set``, one row per server) is where an earlier run ended.

    A forward fill within spans of one file, plus one summary row per span carried over the spans of a
    server: no window holds a whole file or server.
    """
    kind, seq, pos = F.col("event_kind"), F.col("event_seq"), F.col("log_pos")
    named = kind.isin(S.ROTATE, S.DDL, S.XID) & (F.length("next_log") > 0) & (pos != 0)
    marks = raw.withColumns({
        "_span": span_of(seq, span_events),
        "_name": F.when(named, F.col("next_log")),
        # Row, table and GTID events come with a position in the file named last; the others move only with a name.
        "_pos": F.when((pos != 0) & (named | ~kind.isin(S.ROTATE, S.DDL, S.XID)), pos),
        "_gtid": F.when(kind.isin(S.GTID, S.DDL) & (F.length("gtid") > 0), F.col("gtid")),
    })
    key = ["server_id", "file_no", "_span"]

    ends = marks.groupBy(*key).agg(
        F.max_by("_name", F.when(F.col("_name").isNotNull(), seq)).alias("name_end"),
        F.min(F.when(F.col("_name").isNotNull(), seq)).alias("named_at"),
        F.max_by("_pos", F.when(F.col("_pos").isNotNull(), seq)).alias("pos_end"),
        F.max_by("_gtid", F.when(F.col("_gtid").isNotNull(), seq)).alias("gtid_end"))
    if start is None:
        ends = ends.withColumns({c: F.lit(None).cast(t) for c, t in (
            ("name0", "string"), ("pos0", "bigint"), ("gtid0", "string"))})
    else:
        known = F.length("log_name") > 0
        ends = ends.join(start.select(
            "server_id", F.when(known, F.col("log_name")).alias("name0"),
            F.when(known, F.col("log_pos")).alias("pos0"),
            F.when(F.length("gtid_set") > 0, F.col("gtid_set")).alias("gtid0")), "server_id", "left")

    spans = Window.partitionBy("server_id").orderBy("file_no", "_span")
    before = spans.rowsBetween(Window.unboundedPreceding, -1)
    up_to = spans.rowsBetween(Window.unboundedPreceding, 0)
    # A position counts only once a file is known.
    known_pos = F.when(F.coalesce(F.last("name_end", True).over(up_to), F.col("name0")).isNotNull(), F.col("pos_end"))
    carried = (ends.withColumn("known_pos", known_pos).select(
        *key, "named_at",
        F.coalesce(F.last("name_end", True).over(before), "name0").alias("_name_in"),
        F.coalesce(F.last("known_pos", True).over(before), "pos0").alias("_pos_in"),
        F.coalesce(F.last("gtid_end", True).over(before), "gtid0").alias("_gtid_in")))

    inside = Window.partitionBy(*key).orderBy("event_seq").rowsBetween(Window.unboundedPreceding, 0)
    in_file = F.col("_name_in").isNotNull() | (seq >= F.col("named_at"))
    return (marks.join(carried, key)
            .withColumns({
                "log_name": F.coalesce(F.last("_name", True).over(inside), "_name_in", F.lit("")),
                "next_pos": F.coalesce(F.last(F.when(in_file, F.col("_pos")), True).over(inside),
                                       "_pos_in", F.lit(0).cast("bigint")),
                "gtid_set": F.coalesce(F.last("_gtid", True).over(inside), "_gtid_in", F.lit("")),
            })
            .drop("_span", "_name", "_pos", "_gtid", "_name_in", "_pos_in", "_gtid_in", "named_at"))


def carried_ends(carried: DataFrame) -> DataFrame:
    """The ``start`` of the next run: where each server's log stands after the last event."""
    place = F.struct("file_no", "event_seq")
    return (carried.groupBy("server_id")
            .agg(F.max_by(F.struct("log_name", F.col("next_pos").alias("log_pos"), "gtid_set"), place).alias("e"))
            .select("server_id", "e.*"))


def changes_of_carried(carried: DataFrame) -> DataFrame:
    """All event kinds in one pass: a ``when`` per field, rows of row events unfolded."""
    kind = F.col("event_kind")
    is_row = kind == "row"
    single = F.array(_image(F.lit(0), S.empty_cells(), S.empty_cells()))
    images = F.when(is_row, _images(F.col("action"), F.col("columns"), F.col("rows"))).otherwise(single)
    has_db = is_row | kind.isin(S.DDL, S.TABLE_CHANGE)
    has_table = is_row | (kind == S.TABLE_CHANGE)
    has_gtid = ~kind.isin(S.XID, S.ROTATE)
    blank = F.lit("")
    return carried.where(is_row | kind.isin(S.DDL, S.GTID, S.XID, S.ROTATE, S.TABLE_CHANGE)).select(
        F.when(is_row, F.col("action")).otherwise(kind).alias("event_type"),
        "server_id", "log_name", F.col("next_pos").alias("log_pos"),
        F.when(has_db, F.coalesce("db", blank)).otherwise(blank).alias("db"),
        F.when(has_table, F.coalesce("table", blank)).otherwise(blank).alias("table"),
        F.when(kind == S.DDL, F.coalesce("query", blank)).otherwise(blank).alias("sql"),
        F.when(has_gtid, F.col("gtid_set")).otherwise(blank).alias("gtid_set"),
        F.when(is_row, pk_names(F.col("columns"), F.coalesce("pk_idx", F.array().cast("array<int>"))))
        .otherwise(S.empty_names()).alias("primary"),
        "timestamp",
        F.inline(images),
    ).select(*S.CHANGE_COLUMNS)


def normalise(raw: DataFrame, start: DataFrame | None = None, span_events: int = SPAN_EVENTS) -> DataFrame:
    """Raw events -> change events (:data:`changeflow.schema.CHANGE_SCHEMA`)."""
    return changes_of_carried(carry_position(raw, start, span_events))
