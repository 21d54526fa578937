"""Change events -> bulk index requests, through per-table rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changeflow import schema as S
from changeflow.functions.cells import cell_text, cells_json
from changeflow.operators.filters import keep_fields, match_rules, only_types, rename_fields, skip_no_pk as with_pk

REQUEST_COLUMNS = (*S.ORDER_COLUMNS, "timestamp", "action", "index", "id", "parent", "pipeline", "data")


@dataclass(frozen=True)
class Rule:
    """How the rows of one table become documents. ``index`` defaults to the table name; ``filter`` lists the
    fields to keep by their new names, None keeps all; ``actions`` maps insert / update / delete to a bulk action."""

    db: str
    table: str
    index: str | None = None
    parent: str = ""
    id_field: str = ""
    field_mapping: Mapping[str, str] = field(default_factory=dict)
    filter: Sequence[str] | None = None
    pipeline: str = ""
    actions: Mapping[str, str] = field(default_factory=dict)


def rules_frame(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """Rules as a DataFrame: one per table, the last one given wins.

    Made from an Arrow table, which Spark keeps as a local relation of known size, so joins can broadcast it.
    """
    last = {(r.db, r.table): r for r in rules}.values()
    text, text_map = pa.string(), pa.map_(pa.string(), pa.string())
    columns = {
        "db": pa.array([r.db for r in last], text),
        "table": pa.array([r.table for r in last], text),
        "index": pa.array([r.table if r.index is None else r.index for r in last], text),
        "parent": pa.array([r.parent for r in last], text),
        "id_field": pa.array([r.id_field for r in last], text),
        "field_mapping": pa.array([list(r.field_mapping.items()) for r in last], text_map),
        "filter": pa.array([None if r.filter is None else list(r.filter) for r in last], pa.list_(text)),
        "pipeline": pa.array([r.pipeline for r in last], text),
        "action_mapping": pa.array([list(r.actions.items()) for r in last], text_map),
    }
    return spark.createDataFrame(pa.table(columns))


def default_rules(changes: DataFrame) -> DataFrame:
    """A rule per table seen in the log: index = table name, no renaming, no filter."""
    tables = changes.where(S.is_row_event()).select("db", "table").distinct()
    text_map = "map<string,string>"
    return tables.select(
        "db", "table", F.col("table").alias("index"), F.lit("").alias("parent"), F.lit("").alias("id_field"),
        F.create_map().cast(text_map).alias("field_mapping"), F.lit(None).cast("array<string>").alias("filter"),
        F.lit("").alias("pipeline"), F.create_map().cast(text_map).alias("action_mapping"))


def check_rules(rules: Iterable[Rule], skip_no_pk: bool) -> None:
    """Unless tables without a key are skipped, every rule must name its id field."""
    if not skip_no_pk:
        nameless = [f"{r.db}.{r.table}" for r in rules if not r.id_field]
        if nameless:
            raise ValueError(f"rules without an id field, while skip_no_pk is off: {', '.join(nameless)}")


def doc_id(id_field: Column, primary: Column, image: Column) -> Column:
    """Text of the id field, else the key values joined by ``:``; "" where one is missing or NULL."""
    keys = F.when(F.length(id_field) > 0, F.array(id_field)).otherwise(primary)
    single = cell_text(F.element_at(image, F.get(keys, F.lit(0))))
    many = F.transform(keys, lambda k: cell_text(F.element_at(image, k)))
    joined = F.when(F.exists(many, lambda v: v.isNull()), F.lit("")).otherwise(F.array_join(many, ":"))
    return F.when(F.size(keys) <= 1, F.coalesce(single, F.lit(""))).otherwise(joined)


def row_image(before: Column, after: Column) -> Column:
    return F.when(F.size(after) > 0, after).otherwise(before)


def doc_action(event_type: Column, actions: Column) -> Column:
    """insert -> create, update -> update, delete -> delete, unless the rule maps the event to another."""
    plain = F.lit(None).cast("string")
    for event, action in S.ACTION_OF_EVENT.items():
        plain = F.when(event_type == event, F.lit(action)).otherwise(plain)
    return F.coalesce(F.element_at(actions, event_type), plain)


def doc_data(event_type: Column, before: Column, after: Column, field_mapping: Column, names: Column) -> Column:
    """The row image, renamed and then filtered."""
    image = F.when(event_type == S.DELETE, before).otherwise(after)
    return keep_fields(rename_fields(image, field_mapping), names)


def to_requests(changes: DataFrame, rules: DataFrame, skip_no_pk: bool = True, move_keys: bool = False) -> DataFrame:
    """Row events -> one bulk request each. ``move_keys`` also deletes the old document of a changed key."""
    rows = only_types(changes, S.ROW_TYPES)
    matched = match_rules(with_pk(rows) if skip_no_pk else rows, rules)
    kind, before, after, rule = F.col("event_type"), F.col("before"), F.col("after"), F.col("rule")
    requests = matched.select(
        *S.ORDER_COLUMNS, "timestamp",
        doc_action(kind, rule["action_mapping"]).alias("action"),
        rule["index"].alias("index"),
        doc_id(rule["id_field"], F.col("primary"), row_image(before, after)).alias("id"),
        F.coalesce(rule["parent"], F.lit("")).alias("parent"),
        F.coalesce(rule["pipeline"], F.lit("")).alias("pipeline"),
        doc_data(kind, before, after, rule["field_mapping"], rule["filter"]).alias("data"),
        *([F.when(kind == S.UPDATE, doc_id(rule["id_field"], F.col("primary"), before)).alias("_old_id")]
          if move_keys else []))
    if not move_keys:
        return requests

    def request(action: Column, id_: Column, data: Column) -> Column:
        return F.struct(action.alias("action"), id_.alias("id"), data.alias("data"))

    put = request(F.col("action"), F.col("id"), F.col("data"))
    gone = request(F.lit(S.DELETE), F.col("_old_id"), S.empty_cells())
    moved = (F.length("_old_id") > 0) & (F.col("_old_id") != F.col("id"))
    both = F.when(moved, F.array(gone, put)).otherwise(F.array(put))
    return (requests.select(*S.ORDER_COLUMNS, "timestamp", "index", "parent", "pipeline", F.inline(both))
            .select(*REQUEST_COLUMNS))


def index_requests(requests: DataFrame, index: str) -> DataFrame:
    """Requests addressed to one index; a request's own index wins."""
    own = F.when(F.length("index") > 0, F.col("index"))
    return requests.withColumn("index", F.coalesce(own, F.lit(index)))


def bulk_line(action: Column, index: Column, id_: Column, parent: Column, pipeline: Column, data: Column) -> Column:
    """A request as bulk text: the action line with its non-empty fields, and the body below it."""
    def given(column: Column) -> Column:
        return F.when(F.length(column) > 0, column)

    meta = F.to_json(F.create_map(action, F.struct(
        given(id_).alias("_id"), given(index).alias("_index"), given(parent).alias("_parent"),
        given(pipeline).alias("pipeline"))))
    body = cells_json(data)
    return (F.when(action == S.DELETE, meta)
            .when(action == S.UPDATE, F.concat(meta, F.lit('\n{"doc":'), body, F.lit("}")))
            .otherwise(F.concat(meta, F.lit("\n"), body)))


def bulk_lines(requests: DataFrame) -> DataFrame:
    """``server_id, log_name, log_pos, row_ordinal, line``."""
    line = bulk_line(*(F.col(c) for c in ("action", "index", "id", "parent", "pipeline", "data")))
    return requests.select(*S.ORDER_COLUMNS, line.alias("line"))
