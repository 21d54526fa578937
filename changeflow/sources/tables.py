"""Any table as change events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from changeflow import schema as S
from changeflow.functions.cells import cells_json, cells_of, typed_cell
from changeflow.operators.bulk import BLOCK_BYTES


#: Rows of a snapshot that should share a block of the log.
BLOCK_ROWS = 1_000_000


def table_as_inserts(df: DataFrame, primary: Sequence[str], db: str, table: str, server_id: int = 0,
                     timestamp: int = 0, blocks: int | None = None) -> DataFrame:
    """One insert event per row, before any position of a log (the file name is empty).

    The offset is a hash of the row, so that rows are told apart and reruns agree; offsets spread over ``blocks`` blocks of
    the log, by default one for every million rows, so that batches are cut in as many groups as the size asks for."""
    blank = F.lit("")
    if blocks is None:
        blocks = 1 + (0 if df.isStreaming else df.count() // BLOCK_ROWS)
    image = cells_of(df)
    place = F.pmod(F.xxhash64(cells_json(image)), F.lit(blocks * BLOCK_BYTES))
    return df.select(
        F.lit(S.INSERT).alias("event_type"), F.lit(server_id).cast("bigint").alias("server_id"),
        blank.alias("log_name"), place.alias("log_pos"),
        F.lit(db).alias("db"), F.lit(table).alias("table"), blank.alias("sql"), blank.alias("gtid_set"),
        F.array(*map(F.lit, primary)).cast("array<string>").alias("primary"),
        S.empty_cells().alias("before"), image.alias("after"),
        F.lit(timestamp).cast("bigint").alias("timestamp"), F.lit(0).cast("bigint").alias("row_ordinal"))


def typed_rows(changes: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The changes with ``before_row`` and ``after_row``: the images as structs of a schema, in place of cell maps. A field that an
    image lacks is null; an empty image is a null struct."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def row(image: str):
        fields = (typed_cell(F.element_at(image, F.lit(f.name)), f.dataType).alias(f.name) for f in schema.fields)
        return F.when(F.size(image) > 0, F.struct(*fields))

    return changes.withColumns({"before_row": row("before"), "after_row": row("after")}).drop("before", "after")
