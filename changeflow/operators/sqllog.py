"""The SQL log: a mixed stream of change events as SQL lines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from changeflow import schema as S
from changeflow.functions import sqltext
from changeflow.functions.positions import log_seq
from changeflow.operators.filters import only_dbs, only_types


def sql_log(changes: DataFrame, dbs: Iterable[str] = (), entire_fields: bool = False, show_tx: bool = False,
            highlight: bool = False, escape: bool = True, ordered: bool = False) -> DataFrame:
    """``server_id, log_name, log_pos, row_ordinal, line``: one SQL line per event that has one.

    ``ordered`` sorts the whole log; leave it off unless the order of the output matters.
    """
    kind, db, table = F.col("event_type"), F.col("db"), F.col("table")
    before, after = F.col("before"), F.col("after")
    types = [*S.ROW_TYPES, S.DDL] + ([S.GTID, S.XID] if show_tx else [])
    events = only_types(only_dbs(changes, dbs), types)
    line = (F.when(kind == S.INSERT, sqltext.sql_insert(db, table, after, highlight, escape))
            .when(kind == S.UPDATE, sqltext.sql_update(
                db, table, before, after, not entire_fields, highlight, escape, drop_unchanged=True))
            .when(kind == S.DELETE, sqltext.sql_delete(db, table, before, highlight, escape))
            .when(kind == S.DDL, F.col("sql"))
            .otherwise(sqltext.sql_tx_mark(kind, F.col("gtid_set"), F.col("log_name"), F.col("log_pos"))))
    # A filter on ``line`` would be pushed below the projection and render each line twice.
    kept = F.explode(F.filter(F.array(line), lambda text: F.length(text) > 0)).alias("line")
    lines = events.select(*S.ORDER_COLUMNS, kept)
    if ordered:
        lines = lines.orderBy("server_id", log_seq(F.col("log_name")), "log_pos", "row_ordinal")
    return lines
