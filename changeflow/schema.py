"""Schemas and fixed values shared by every operator."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values: event kinds ------------------------------------------------
INSERT = "insert"
UPDATE = "update"
DELETE = "delete"
DDL = "ddl"
GTID = "gtid"
XID = "xid"
ROTATE = "rotate"
TABLE_CHANGE = "table_change"
# ------------------------------------------------------------------------------

ROW_TYPES = (INSERT, UPDATE, DELETE)

# --- fixed values: bulk actions and the action of each row event --------------
CREATE = "create"
INDEX = "index"
ACTION_OF_EVENT = {"insert": "create", "update": "update", "delete": "delete"}
# ------------------------------------------------------------------------------

# --- fixed values: health levels, worst last ----------------------------------
LEVELS = ("green", "yellow", "red")
# ------------------------------------------------------------------------------

# --- fixed values: health reasons ---------------------------------------------
REASON_NO_DB_POSITION = "failed to get db-pos."
REASON_THRESHOLD = "The diff between db-pos and file-pos exceeds the threshold."
REASON_BOTH_STOPPED = "both of db-pos and file-pos make no progress, but file-pos still behind db-pos."
REASON_SYNC_STOPPED = "db-pos makes progress while file-pos not."
# ------------------------------------------------------------------------------

# --- fixed values: Kafka start offsets ----------------------------------------
OLDEST_OFFSET = -2
NEWEST_OFFSET = -1
# ------------------------------------------------------------------------------

#: One change event. ``before`` / ``after`` are cell maps: column name -> JSON text
#: of a scalar (``"x"`` with its quotes, ``12.5``, ``true``), SQL null for NULL.
CHANGE_SCHEMA = (
    "event_type string, server_id bigint, log_name string, log_pos bigint, "
    "db string, `table` string, sql string, gtid_set string, primary array<string>, "
    "before map<string,string>, after map<string,string>, timestamp bigint, row_ordinal bigint"
)
CHANGE_COLUMNS = (
    "event_type", "server_id", "log_name", "log_pos", "db", "table", "sql", "gtid_set",
    "primary", "before", "after", "timestamp", "row_ordinal",
)

#: The order of events: the columns that say where an event stands in its log.
ORDER_COLUMNS = ("server_id", "log_name", "log_pos", "row_ordinal")

#: Raw events as a log connector delivers them. ``file_no`` / ``event_seq`` say which
#: file the event came from and its place in it; ``rows`` hold cell texts.
RAW_SCHEMA = (
    "server_id bigint, file_no bigint, event_seq bigint, event_kind string, action string, "
    "log_pos bigint, next_log string, gtid string, db string, `table` string, "
    "columns array<string>, pk_idx array<int>, rows array<array<string>>, query string, timestamp bigint"
)

#: Mapping rules. ``filter`` null keeps every field; maps may be null.
RULE_SCHEMA = (
    "db string, `table` string, index string, parent string, id_field string, "
    "field_mapping map<string,string>, filter array<string>, pipeline string, "
    "action_mapping map<string,string>"
)

#: One row per health check.
SAMPLE_SCHEMA = (
    "server_id bigint, ts timestamp, file_seq bigint, file_pos bigint, "
    "db_seq bigint, db_pos bigint, db_error string"
)


def is_row_event(event_type: Column | None = None) -> Column:
    column = F.col("event_type") if event_type is None else event_type
    return column.isin(*ROW_TYPES)


def empty_cells() -> Column:
    return F.create_map().cast("map<string,string>")


def empty_names() -> Column:
    return F.array().cast("array<string>")
