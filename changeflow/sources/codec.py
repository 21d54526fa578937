"""Change events as JSON messages."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from changeflow import schema as S
from changeflow.functions.cells import cells_json, cells_of_variants, decode_base64, encode_base64

WIRE_SCHEMA = (
    "event_type string, server_id bigint, log_name string, log_pos bigint, db string, `table` string, sql string, "
    "gtid_set string, primary array<string>, before map<string,variant>, after map<string,variant>, "
    "timestamp bigint, row_ordinal bigint, _malformed string"
)


def decode_changes(messages: DataFrame, value: str = "value", binary_fields: Iterable[str] = ()) -> DataFrame:
    """Adds the columns of a change event, parsed once, in place of ``value``. Text that is no event gives an
    event of nulls with the text in ``malformed`` ("" for a null message); filter on it, nothing is dropped here."""
    text = F.col(value).cast("string")
    event = F.from_json(text, WIRE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"})
    kept = [c for c in messages.columns if c != value]
    parsed = messages.select(*kept, event.alias("_e"), text.alias("_text"))
    bad = F.col("_e").isNull() | F.col("_e._malformed").isNotNull()
    names = list(binary_fields)

    def image(field: str) -> Column:
        cells = cells_of_variants(F.coalesce(F.col(f"_e.{field}"), F.create_map().cast("map<string,variant>")))
        return (decode_base64(cells, names) if names else cells).alias(field)

    plain = ("event_type", "server_id", "log_name", "log_pos", "db", "table", "sql", "gtid_set")
    return parsed.select(
        *kept, *(F.col(f"_e.{c}").alias(c) for c in plain),
        F.coalesce("_e.primary", S.empty_names()).alias("primary"), image("before"), image("after"),
        F.col("_e.timestamp").alias("timestamp"),
        F.coalesce("_e.row_ordinal", F.lit(0).cast("bigint")).alias("row_ordinal"),
        F.when(bad, F.coalesce("_text", F.lit(""))).alias("malformed"))


def encode_value(with_ordinal: bool = True, binary_fields: Iterable[str] = ()) -> Column:
    """JSON text of a change event, fields in their fixed order, keys of the images sorted. ``with_ordinal``
    adds the row's place in its event, which readers need to tell the rows of one event apart; leave it off only for
    readers that know no such field."""
    names = list(binary_fields)
    scalars = F.to_json(F.struct(
        "event_type", "server_id", "log_name", "log_pos", "db", "table", "sql", "gtid_set",
        F.coalesce("primary", S.empty_names()).alias("primary")), {"ignoreNullFields": "false"})

    def image(field: str) -> Column:
        cells = F.coalesce(F.col(field), S.empty_cells())
        return cells_json(encode_base64(cells, names) if names else cells)

    tail = [F.lit(',"timestamp":'), F.coalesce(F.col("timestamp").cast("string"), F.lit("null"))]
    if with_ordinal:
        tail += [F.lit(',"row_ordinal":'), F.col("row_ordinal").cast("string")]
    return F.concat(scalars.substr(F.lit(1), F.length(scalars) - 1), F.lit(',"before":'), image("before"),
                    F.lit(',"after":'), image("after"), *tail, F.lit("}"))


def encode_changes(changes: DataFrame, encoder: Callable[[DataFrame], DataFrame] | None = None,
                   with_ordinal: bool = True, binary_fields: Iterable[str] = ()) -> DataFrame:
    """Adds ``value``, the message of each event. ``encoder`` (changes -> DataFrame with ``value``) replaces
    the JSON form; it may give null or "" to drop an event (see ``drop_empty``)."""
    if encoder is not None:
        return encoder(changes)
    return changes.withColumn("value", encode_value(with_ordinal, binary_fields))
