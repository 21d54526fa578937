"""One query per operator, each with the SQL that must give the same rows.

``register(name, oracle)`` takes a function ``(spark, sf_dir) -> DataFrame``. Results hold plain columns
only: maps and arrays are returned as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog import views as V
from catalog.views import with_views
from changeflow import schema as S
from changeflow.functions import cells as C, positions as P, sqltext as Q
from changeflow.operators import (
    bulk, docs, filters, health as H, mapping as M, normalise as N, offsets as O, progress as G, sqllog)
from changeflow.sources import codec, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ID = list(S.ORDER_COLUMNS)
ID_SQL = "server_id, log_name, log_pos, row_ordinal"


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return query
    return add


def lit(sql: str) -> str:
    """SQL literal of a text column, quotes escaped by a backslash."""
    return (f"case when {sql} is null then 'NULL' else "
            f"concat(chr(39), replace({sql}, chr(39), concat(chr(92), chr(39))), chr(39)) end")


def where_sql(side: str) -> str:
    """WHERE text of an order image; ``side`` is b (before) or a (after)."""
    return (f"concat('`o_custkey`=', c, ' AND ', case when {side}_note is null then '`o_note` IS NULL' else "
            f"concat('`o_note`=', {lit(side + '_note')}) end, ' AND `o_orderkey`=', k, ' AND `o_orderstatus`=', "
            f"{lit(side + '_st')}, ' AND `o_totalprice`=', num)")


INSERT_SQL = (
    "concat('INSERT INTO `shop`.`orders`(`o_custkey`, `o_note`, `o_orderkey`, `o_orderstatus`, `o_totalprice`) VALUES (', "
    f"c, ', ', {lit('a_note')}, ', ', k, ', ', {lit('a_st')}, ', ', num, ');')")
UPDATE_CHANGED_SQL = (
    f"concat('UPDATE `shop`.`orders` SET `o_note`=', {lit('a_note')}, ', `o_orderstatus`=', {lit('a_st')}, "
    f"' WHERE ', {where_sql('b')}, ' LIMIT 1;')")
UPDATE_FULL_SQL = (
    f"concat('UPDATE `shop`.`orders` SET `o_custkey`=', c, ', `o_note`=', {lit('a_note')}, ', `o_orderkey`=', k, "
    f"', `o_orderstatus`=', {lit('a_st')}, ', `o_totalprice`=', num, ' WHERE ', {where_sql('b')}, ' LIMIT 1;')")
DELETE_SQL = f"concat('DELETE FROM `shop`.`orders` WHERE ', {where_sql('b')}, ' LIMIT 1;')"

# ------------------------------------------------------------- messages, tables


@register("decode_changes", with_views(["messages"], """
select topic, "partition", "offset", event_type, server_id, log_name, log_pos, db, tbl "table", sql_text "sql", gtid_set,
  pk "primary", before_json, after_json, ts_sec "timestamp" from messages"""))
def decode_changes(spark, sf_dir):
    decoded = codec.decode_changes(V.messages(spark, sf_dir)).where(F.col("malformed").isNull())
    return decoded.select(
        "topic", "partition", "offset", "event_type", "server_id", "log_name", "log_pos", "db", "table", "sql", "gtid_set",
        F.array_join("primary", ",").alias("primary"), C.cells_json(F.col("before")).alias("before_json"),
        C.cells_json(F.col("after")).alias("after_json"), "timestamp")


VALUE_SQL = """concat('{"event_type":"', event_type, '","server_id":', server_id, ',"log_name":"', log_name,
    '","log_pos":', log_pos, ',"db":"', db, '","table":"', tbl, '","sql":"', sql_text, '","gtid_set":"', gtid_set,
    '","primary":[', case when pk = '' then '' else concat('"', pk, '"') end, '],"before":', before_json,
    ',"after":', after_json, ',"timestamp":', ts_sec, ',"row_ordinal":', row_ordinal, '}')"""


@register("encode_changes", with_views(["orders_log"], f"select {ID_SQL}, {VALUE_SQL} as value from orders_log"))
def encode_changes(spark, sf_dir):
    return codec.encode_changes(V.orders(spark, sf_dir)).select(*ID, "value")


@register("custom_encoder", with_views(["orders_log"], f"""
select {ID_SQL}, concat(event_type, '|', db, '|', tbl) as value from orders_log where event_type <> 'gtid'"""))
def custom_encoder(spark, sf_dir):
    def encoder(changes: DataFrame) -> DataFrame:
        text = F.concat_ws("|", "event_type", "db", "table")
        return changes.withColumn("value", F.when(F.col("event_type") == S.GTID, "").otherwise(text))

    return filters.drop_empty(codec.encode_changes(V.orders(spark, sf_dir), encoder)).select(*ID, "value")


@register("drop_empty", with_views(["orders_log"], f"""
select {ID_SQL}, sql_text as value from orders_log where sql_text <> ''"""))
def drop_empty(spark, sf_dir):
    encoded = V.orders(spark, sf_dir).withColumn("value", F.col("sql"))
    return filters.drop_empty(encoded).select(*ID, "value")


@register("table_as_inserts", """
select 'insert' event_type, 'shop' db, 'customer' "table", 'c_custkey' "primary",
  concat('{"c_acctbal":', rtrim(rtrim(cast(c_acctbal as varchar), '0'), '.'), ',"c_custkey":', c_custkey,
    ',"c_mktsegment":"', c_mktsegment, '","c_name":"', c_name, '","c_nationkey":', c_nationkey, '}') after_json
from customer""")
def table_as_inserts(spark, sf_dir):
    inserts = tables.table_as_inserts(V.table(spark, sf_dir, "customer"), ["c_custkey"], "shop", "customer")
    return inserts.select("event_type", "db", "table", F.array_join("primary", ",").alias("primary"),
                          C.cells_json(F.col("after")).alias("after_json"))


@register("typed_rows", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def typed_rows(spark, sf_dir):
    customers = V.table(spark, sf_dir, "customer")
    inserts = tables.table_as_inserts(customers, ["c_custkey"], "shop", "customer")
    return tables.typed_rows(inserts, customers.schema).select("after_row.*").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")

# ------------------------------------------------------------------ normalising

EVENT_SQL = "server_id, file_no, event_seq"
EVENT = ["server_id", "file_no", "event_seq"]


@register("zip_fields", with_views(["order_rows"], f"""
select {EVENT_SQL}, row_ordinal * case when action = 'update' then 2 else 1 end place, before_json fields from order_rows where action <> 'insert'
union all
select {EVENT_SQL}, case when action = 'update' then row_ordinal * 2 + 1 else row_ordinal end, after_json from order_rows where action <> 'delete'"""))
def zip_fields(spark, sf_dir):
    raw = V.order_rows_raw(spark, sf_dir).select(*EVENT, "columns", F.posexplode("rows").alias("place", "row"))
    return raw.select(*EVENT, F.col("place").cast("bigint"), C.cells_json(N.zip_fields(F.col("columns"), F.col("row"))).alias("fields"))


@register("pk_names", with_views(["order_rows"], f"""
select {EVENT_SQL}, 'o_orderkey,o_line' pk from order_rows where row_ordinal = 0"""))
def pk_names(spark, sf_dir):
    raw = V.order_rows_raw(spark, sf_dir)
    return raw.select(*EVENT, F.array_join(N.pk_names(F.col("columns"), F.col("pk_idx")), ",").alias("pk"))


@register("row_images", with_views(["order_rows"], f"""
select {EVENT_SQL}, action, row_ordinal, before_json, after_json from order_rows"""))
def row_images(spark, sf_dir):
    images = N.row_images(V.order_rows_raw(spark, sf_dir))
    return images.select(*EVENT, "action", "row_ordinal", C.cells_json(F.col("before")).alias("before_json"),
                         C.cells_json(F.col("after")).alias("after_json"))


@register("carry_position", with_views(["orders_log"], f"""
select {EVENT_SQL}, event_type event_kind, log_name, log_pos next_pos, concat('u', server_id, ':', k) gtid_set from orders_log
union all
select server_id, file_no, -1, 'rotate', log_name, 4, '' from orders_log where file_no < 4 and event_seq = 0"""))
def carry_position(spark, sf_dir):
    # Spans of 64 events, so that carrying between spans is at work on small tables too.
    carried = N.carry_position(V.orders_raw(spark, sf_dir), span_events=64)
    kind = F.coalesce("action", "event_kind").alias("event_kind")
    return carried.select(*EVENT, kind, "log_name", "next_pos", "gtid_set")


@register("normalise_events", with_views(["orders_log"], f"""
select event_type, {ID_SQL}, db, tbl "table", sql_text "sql", gtid_set, pk "primary", before_json, after_json, ts_sec "timestamp"
from orders_log
union all
select 'rotate', server_id, log_name, 4, 0, '', '', '', '', '', '{{}}', '{{}}', ts_sec from orders_log where file_no < 4 and event_seq = 0"""))
def normalise_events(spark, sf_dir):
    changes = N.normalise(V.orders_raw(spark, sf_dir))
    return changes.select(
        "event_type", *ID, "db", "table", "sql", "gtid_set", F.array_join("primary", ",").alias("primary"),
        C.cells_json(F.col("before")).alias("before_json"), C.cells_json(F.col("after")).alias("after_json"), "timestamp")


@register("position_str", with_views(["orders_log"], f"""
select {ID_SQL}, concat(log_name, ':', log_pos) position from orders_log"""))
def position_str(spark, sf_dir):
    text = P.position_str(F.col("log_name"), F.col("log_pos")).alias("position")
    return V.orders_log(spark, sf_dir).select(*ID, text)


@register("position_order", with_views(["orders_log"], f"""
select {ID_SQL}, cast(right(log_name, 6) as bigint) log_seq,
  cast(case when cast(right(log_name, 6) as bigint) < 2 or (cast(right(log_name, 6) as bigint) = 2 and log_pos < 100154) then -1
    when cast(right(log_name, 6) as bigint) = 2 and log_pos = 100154 then 0 else 1 end as int) cmp
from orders_log"""))
def position_order(spark, sf_dir):
    key = P.position_key(F.col("log_name"), F.col("log_pos"))
    other = P.position_key(F.lit("mysql-bin.000002"), F.lit(100154))
    return V.orders_log(spark, sf_dir).select(*ID, key["log_seq"].alias("log_seq"), P.compare_positions(key, other).alias("cmp"))

# ---------------------------------------------------------------------- filters


@register("only_dbs", with_views(["orders_log", "turns_log"], f"""
select {ID_SQL}, event_type, db from turns_log
union all select {ID_SQL}, event_type, db from orders_log where event_type not in ('insert', 'update', 'delete')"""))
def only_dbs(spark, sf_dir):
    both = V.orders(spark, sf_dir).unionByName(V.turns(spark, sf_dir))
    return filters.only_dbs(both, ["CHAT"]).select(*ID, "event_type", "db")


@register("only_types", with_views(["orders_log"], f"""
select {ID_SQL}, event_type from orders_log where event_type in ('insert', 'ddl')"""))
def only_types(spark, sf_dir):
    return filters.only_types(V.orders(spark, sf_dir), [S.INSERT, S.DDL]).select(*ID, "event_type")


@register("match_rules", with_views(["orders_log", "turns_log", "lineitem_log"], f"""
select {ID_SQL}, event_type, db, tbl "table", 'orders_idx' idx from orders_log where tbl = 'orders'
union all select {ID_SQL}, event_type, db, tbl, 'turns' from turns_log
union all select {ID_SQL}, event_type, db, tbl, 'lineitem' from lineitem_log"""))
def match_rules(spark, sf_dir):
    logs = V.orders(spark, sf_dir).unionByName(V.turns(spark, sf_dir)).unionByName(V.lineitem(spark, sf_dir))
    matched = filters.match_rules(logs, M.rules_frame(spark, V.RULES))
    return matched.select(*ID, "event_type", "db", "table", F.col("rule.index").alias("idx"))


@register("skip_no_pk", with_views(["orders_log", "lineitem_log"], f"""
select {ID_SQL}, event_type, tbl "table" from orders_log where pk <> ''
union all select {ID_SQL}, event_type, tbl from lineitem_log where pk <> ''"""))
def skip_no_pk(spark, sf_dir):
    both = V.orders(spark, sf_dir).unionByName(V.lineitem(spark, sf_dir))
    return filters.skip_no_pk(both).select(*ID, "event_type", "table")


NOTE_JSON = "case when {0}_note is null then 'null' else concat('\"', {0}_note, '\"') end"


@register("keep_fields", with_views(["orders_log"], f"""
select {ID_SQL}, concat('{{"o_note":', {NOTE_JSON.format('a')}, ',"o_orderkey":', k, '}}') fields
from orders_log where event_type in ('insert', 'update')"""))
def keep_fields(spark, sf_dir):
    rows = filters.only_types(V.orders(spark, sf_dir), [S.INSERT, S.UPDATE])
    names = F.array(F.lit("o_orderkey"), F.lit("o_note"), F.lit("no_such_field"))
    return rows.select(*ID, C.cells_json(filters.keep_fields(F.col("after"), names)).alias("fields"))


# Two fields get the name o_orderkey; the one that had it stands later in name order.
@register("rename_fields", with_views(["orders_log"], f"""
select {ID_SQL}, concat('{{"o_note":', {NOTE_JSON.format('a')}, ',"o_orderkey":', k, ',"o_totalprice":', num, ',"status":"', a_st, '"}}') fields
from orders_log where event_type in ('insert', 'update')"""))
def rename_fields(spark, sf_dir):
    rows = filters.only_types(V.orders(spark, sf_dir), [S.INSERT, S.UPDATE])
    mapping = F.create_map(F.lit("o_orderstatus"), F.lit("status"), F.lit("o_custkey"), F.lit("o_orderkey"))
    return rows.select(*ID, C.cells_json(filters.rename_fields(F.col("after"), mapping)).alias("fields"))


@register("changes_since", with_views(["orders_log"], f"""
select {ID_SQL}, event_type from orders_log
where (server_id = 1 and (cast(right(log_name, 6) as bigint) > 4 or (log_name = 'mysql-bin.000004' and log_pos > 100154)))
   or (server_id = 2 and (cast(right(log_name, 6) as bigint) > 1 or (log_name = 'mysql-bin.000001' and log_pos > 154)))"""))
def changes_since(spark, sf_dir):
    since = filters.changes_since(V.orders(spark, sf_dir), V.saved_positions(spark))
    return since.select(*ID, "event_type")

# ---------------------------------------------------------------------- SQL log


@register("sql_literal", with_views(["orders_log"], f"""
with v as (select * from orders_log where event_type in ('insert', 'update'))
select {ID_SQL}, 'o_custkey' field, cast(c as varchar) literal from v
union all select {ID_SQL}, 'o_note', {lit('a_note')} from v
union all select {ID_SQL}, 'o_orderkey', cast(k as varchar) from v
union all select {ID_SQL}, 'o_orderstatus', {lit('a_st')} from v
union all select {ID_SQL}, 'o_totalprice', num from v"""))
def sql_literal(spark, sf_dir):
    rows = filters.only_types(V.orders(spark, sf_dir), [S.INSERT, S.UPDATE])
    fields = rows.select(*ID, F.explode("after").alias("field", "cell"))
    return fields.select(*ID, "field", Q.sql_literal(F.col("cell")).alias("literal"))


@register("sql_where", with_views(["orders_log"], f"""
select {ID_SQL}, {where_sql('b')} line from orders_log where event_type in ('update', 'delete')"""))
def sql_where(spark, sf_dir):
    rows = filters.only_types(V.orders(spark, sf_dir), [S.UPDATE, S.DELETE])
    return rows.select(*ID, Q.sql_where(F.col("before")).alias("line"))


@register("changed_fields", with_views(["orders_log"], f"""
select {ID_SQL}, concat('{{"o_note":', {NOTE_JSON.format('a')}, ',"o_orderstatus":"', a_st, '"}}') fields
from orders_log where event_type = 'update'"""))
def changed_fields(spark, sf_dir):
    rows = filters.only_types(V.orders(spark, sf_dir), [S.UPDATE])
    return rows.select(*ID, C.cells_json(Q.changed_fields(F.col("before"), F.col("after"))).alias("fields"))


DB, TABLE, BEFORE, AFTER = "db", "table", "before", "after"


@register("sql_insert", with_views(["orders_log"], f"select {ID_SQL}, {INSERT_SQL} line from orders_log where event_type = 'insert'"))
def sql_insert(spark, sf_dir):
    rows = filters.only_types(V.orders(spark, sf_dir), [S.INSERT])
    return rows.select(*ID, Q.sql_insert(F.col(DB), F.col(TABLE), F.col(AFTER)).alias("line"))


@register("sql_update_changed", with_views(["orders_log"], f"select {ID_SQL}, {UPDATE_CHANGED_SQL} line from orders_log where event_type = 'update'"))
def sql_update_changed(spark, sf_dir):
    rows = filters.only_types(V.orders(spark, sf_dir), [S.UPDATE])
    return rows.select(*ID, Q.sql_update(F.col(DB), F.col(TABLE), F.col(BEFORE), F.col(AFTER)).alias("line"))


@register("sql_update_full", with_views(["orders_log"], f"select {ID_SQL}, {UPDATE_FULL_SQL} line from orders_log where event_type = 'update'"))
def sql_update_full(spark, sf_dir):
    rows = filters.only_types(V.orders(spark, sf_dir), [S.UPDATE])
    line = Q.sql_update(F.col(DB), F.col(TABLE), F.col(BEFORE), F.col(AFTER), changed_only=False)
    return rows.select(*ID, line.alias("line"))


@register("sql_delete", with_views(["orders_log"], f"select {ID_SQL}, {DELETE_SQL} line from orders_log where event_type = 'delete'"))
def sql_delete(spark, sf_dir):
    rows = filters.only_types(V.orders(spark, sf_dir), [S.DELETE])
    return rows.select(*ID, Q.sql_delete(F.col(DB), F.col(TABLE), F.col(BEFORE)).alias("line"))


TX_SQL = """case event_type when 'gtid' then concat('/* GTID: ', gtid_set, ' */') when 'xid' then concat('/* XID: ', log_name, ':', log_pos, ' */') end"""


@register("sql_tx_marks", with_views(["orders_log"], f"select {ID_SQL}, {TX_SQL} line from orders_log where event_type in ('gtid', 'xid')"))
def sql_tx_marks(spark, sf_dir):
    rows = filters.only_types(V.orders(spark, sf_dir), [S.GTID, S.XID])
    mark = Q.sql_tx_mark(F.col("event_type"), F.col("gtid_set"), F.col("log_name"), F.col("log_pos"))
    return rows.select(*ID, mark.alias("line"))


@register("sql_ddl", with_views(["orders_log"], f"select {ID_SQL}, sql_text line from orders_log where event_type = 'ddl'"))
def sql_ddl(spark, sf_dir):
    return sqllog.sql_log(filters.only_types(V.orders(spark, sf_dir), [S.DDL]))


ANY_SQL = (f"case event_type when 'insert' then {INSERT_SQL} when 'update' then {UPDATE_CHANGED_SQL} "
           f"when 'delete' then {DELETE_SQL} when 'ddl' then sql_text else {TX_SQL} end")
SQL_TYPES = "('insert', 'update', 'delete', 'ddl', 'gtid', 'xid')"


@register("sql_log", with_views(["orders_log"], f"select {ID_SQL}, {ANY_SQL} line from orders_log where event_type in {SQL_TYPES}"))
def sql_log(spark, sf_dir):
    both = V.orders(spark, sf_dir).unionByName(V.turns(spark, sf_dir))
    return sqllog.sql_log(both, dbs=["Shop"], show_tx=True)


TEXT_SQL = "concat(chr(39), replace(replace({}, chr(92), concat(chr(92), chr(92))), chr(39), concat(chr(92), chr(39))), chr(39))"
TURN_WHERE_SQL = "concat('`conv_id`=', conv_id, ' AND `n_chars`=', n_chars, ' AND `role`=', {}, ' AND `text`=', {}, ' AND `turn`=', turn)".format(
    TEXT_SQL.format("role"), TEXT_SQL.format("text"))


@register("sql_log_text", with_views(["turns_log"], f"""
select {ID_SQL}, case event_type when 'insert' then concat('INSERT INTO `Chat`.`turns`(`conv_id`, `n_chars`, `role`, `text`, `turn`) VALUES (',
    conv_id, ', ', n_chars, ', ', {TEXT_SQL.format("role")}, ', ', {TEXT_SQL.format("text")}, ', ', turn, ');')
  else concat('DELETE FROM `Chat`.`turns` WHERE ', {TURN_WHERE_SQL}, ' LIMIT 1;') end line from turns_log"""))
def sql_log_text(spark, sf_dir):
    return sqllog.sql_log(V.turns(spark, sf_dir))


@register("resume_newest", with_views(["messages"], """
select topic, "partition", "offset" from messages where ("partition" = 0 and "offset" >= 1000) or ("partition" = 1 and "offset" >= 20)"""))
def resume_newest(spark, sf_dir):
    messages = V.messages(spark, sf_dir)
    return O.resume_messages(messages, V.stored_offsets(spark), S.NEWEST_OFFSET).select("topic", "partition", "offset")


@register("dedup_statement_rows", with_views(["order_rows"], f"""
select server_id, file_no, event_seq, action event_type, row_ordinal, before_json, after_json from order_rows"""))
def dedup_statement_rows(spark, sf_dir):
    """Rows of one statement, delivered twice, with insert, update and delete at one header position."""
    raw = V.order_rows_raw(spark, sf_dir)
    log_name = F.concat(F.lit("mysql-bin."), F.lpad(F.col("file_no").cast("string"), 6, "0"))
    rows = N.row_images(raw).withColumns({"event_type": F.col("action"), "log_name": log_name})
    once = O.dedup_changes(rows.unionByName(rows))
    return once.select(*EVENT, "event_type", F.col("row_ordinal").cast("bigint"), C.cells_json(F.col("before")).alias("before_json"), C.cells_json(F.col("after")).alias("after_json"))


COLOURED_SQL = f"""
with plain as (select *, {ANY_SQL} t from orders_log where event_type in {SQL_TYPES}),
esc as (select *, chr(27) || '[' e, chr(27) || '[0m' z from plain)
select {ID_SQL}, case event_type
  when 'insert' then replace(replace(replace(t, 'INSERT INTO', concat(e, '32mINSERT INTO', z)), '`orders`', concat('`', e, '30;46morders', z, '`')), ' VALUES ', concat(' ', e, '32mVALUES', z, ' '))
  when 'update' then replace(replace(replace(replace(t, 'UPDATE', concat(e, '33mUPDATE', z)), '`orders`', concat('`', e, '30;46morders', z, '`')), ' SET ', concat(' ', e, '33mSET', z, ' ')), ' WHERE ', concat(' ', e, '33mWHERE', z, ' '))
  when 'delete' then replace(replace(replace(t, 'DELETE FROM', concat(e, '31mDELETE FROM', z)), '`orders`', concat('`', e, '30;46morders', z, '`')), ' WHERE ', concat(' ', e, '31mWHERE', z, ' '))
  else t end line
from esc"""


@register("sql_log_highlight", with_views(["orders_log"], COLOURED_SQL))
def sql_log_highlight(spark, sf_dir):
    return sqllog.sql_log(V.orders(spark, sf_dir), show_tx=True, highlight=True)

# ---------------------------------------------------------------- index mapping


def _requests(spark, sf_dir, rules=V.RULES):
    return M.to_requests(V.orders(spark, sf_dir), M.rules_frame(spark, rules))


# What the rule of ``orders`` makes of an event: status renamed, updates sent as index.
ACTION_SQL = "case event_type when 'insert' then 'create' when 'update' then 'index' else 'delete' end"
DATA_SQL = """case when event_type = 'delete' then replace(before_json, '"o_orderstatus":', '"status":') else replace(after_json, '"o_orderstatus":', '"status":') end"""
# The same with its keys in order: the renamed one comes last.
SORTED_DATA_SQL = f"""case event_type when 'delete'
  then concat('{{"o_custkey":', c, ',"o_note":', {NOTE_JSON.format('b')}, ',"o_orderkey":', k, ',"o_totalprice":', num, ',"status":"', b_st, '"}}')
  else concat('{{"o_custkey":', c, ',"o_note":', {NOTE_JSON.format('a')}, ',"o_orderkey":', k, ',"o_totalprice":', num, ',"status":"', a_st, '"}}') end"""
ROW_SQL = "event_type in ('insert', 'update', 'delete')"


@register("default_rules", with_views(["orders_log", "lineitem_log", "turns_log"], f"""
select distinct db, tbl "table", tbl idx from (
  select db, tbl from orders_log where {ROW_SQL} union all select db, tbl from lineitem_log union all select db, tbl from turns_log)"""))
def default_rules(spark, sf_dir):
    logs = V.orders(spark, sf_dir).unionByName(V.turns(spark, sf_dir)).unionByName(V.lineitem(spark, sf_dir))
    return M.default_rules(logs).select("db", "table", F.col("index").alias("idx"))


@register("doc_id", with_views(["orders_log", "turns_log"], f"""
select {ID_SQL}, cast(k as varchar) id from orders_log where {ROW_SQL}
union all select {ID_SQL}, concat(conv_id, ':', turn) from turns_log"""))
def doc_id(spark, sf_dir):
    rows = filters.only_types(V.orders(spark, sf_dir).unionByName(V.turns(spark, sf_dir)), S.ROW_TYPES)
    id_ = M.doc_id(F.lit(""), F.col("primary"), M.row_image(F.col("before"), F.col("after")))
    return rows.select(*ID, id_.alias("id"))


@register("doc_action", with_views(["orders_log"], f"select {ID_SQL}, {ACTION_SQL} action from orders_log where {ROW_SQL}"))
def doc_action(spark, sf_dir):
    rows = filters.only_types(V.orders(spark, sf_dir), S.ROW_TYPES)
    return rows.select(*ID, M.doc_action(F.col("event_type"), F.create_map(F.lit("update"), F.lit("index"))).alias("action"))


@register("doc_data", with_views(["orders_log"], f"""
select {ID_SQL}, case event_type when 'delete' then concat('{{"o_orderkey":', k, ',"status":"', b_st, '"}}')
  else concat('{{"o_orderkey":', k, ',"status":"', a_st, '"}}') end data from orders_log where {ROW_SQL}"""))
def doc_data(spark, sf_dir):
    rows = filters.only_types(V.orders(spark, sf_dir), S.ROW_TYPES)
    mapping = F.create_map(F.lit("o_orderstatus"), F.lit("status"))
    names = F.array(F.lit("status"), F.lit("o_orderkey"))
    data = M.doc_data(F.col("event_type"), F.col("before"), F.col("after"), mapping, names)
    return rows.select(*ID, C.cells_json(data).alias("data"))


@register("to_requests", with_views(["orders_log", "turns_log"], f"""
select {ID_SQL}, {ACTION_SQL} action, 'orders_idx' idx, cast(k as varchar) id, '' pipeline, {SORTED_DATA_SQL} data from orders_log where {ROW_SQL}
union all
select {ID_SQL}, case event_type when 'insert' then 'create' else 'delete' end, 'turns', concat(conv_id, ':', turn), 'clean',
  case event_type when 'insert' then after_json else before_json end from turns_log"""))
def to_requests(spark, sf_dir):
    logs = V.orders(spark, sf_dir).unionByName(V.turns(spark, sf_dir)).unionByName(V.lineitem(spark, sf_dir))
    requests = M.to_requests(logs, M.rules_frame(spark, V.RULES))
    return requests.select(*ID, "action", F.col("index").alias("idx"), "id", "pipeline", C.cells_json(F.col("data")).alias("data"))


@register("bulk_lines", with_views(["orders_log", "turns_log"], f"""
select {ID_SQL}, concat('{{"', {ACTION_SQL}, '":{{"_id":"', k, '","_index":"orders_idx"}}}}',
  case when event_type <> 'delete' then concat(chr(10), {SORTED_DATA_SQL}) end) line
from orders_log where {ROW_SQL}
union all
select {ID_SQL}, case event_type when 'insert' then concat('{{"create":{{"_id":"', conv_id, ':', turn, '","_index":"turns","pipeline":"clean"}}}}', chr(10), after_json)
  else concat('{{"delete":{{"_id":"', conv_id, ':', turn, '","_index":"turns","pipeline":"clean"}}}}') end from turns_log"""))
def bulk_lines(spark, sf_dir):
    logs = V.orders(spark, sf_dir).unionByName(V.turns(spark, sf_dir))
    return M.bulk_lines(M.to_requests(logs, M.rules_frame(spark, V.RULES)))


@register("bulk_lines_update", with_views(["orders_log"], f"""
select {ID_SQL}, concat('{{"update":{{"_id":"', k, '","_index":"orders"}}}}', chr(10), '{{"doc":', after_json, '}}') line
from orders_log where event_type = 'update'"""))
def bulk_lines_update(spark, sf_dir):
    updates = filters.only_types(V.orders(spark, sf_dir), [S.UPDATE])
    return M.bulk_lines(M.to_requests(updates, M.rules_frame(spark, [M.Rule("shop", "orders")])))


@register("index_requests", with_views(["orders_log"], f"""
select {ID_SQL}, 'archive' idx, cast(k as varchar) id from orders_log where {ROW_SQL}"""))
def index_requests(spark, sf_dir):
    requests = _requests(spark, sf_dir, [M.Rule("shop", "orders", index="")])
    return M.index_requests(requests, "archive").select(*ID, F.col("index").alias("idx"), "id")


@register("batch_requests", with_views(["orders_log"], f"""
with r as (
  select *, k % 8 shard, cast(right(log_name, 6) as bigint) log_seq, cast(floor(log_pos / 65536) as bigint) log_block from orders_log where {ROW_SQL}),
n as (select *, row_number() over (partition by shard, server_id, log_seq, log_block order by log_pos, row_ordinal) - 1 num0 from r)
select {ID_SQL}, cast(k as varchar) id, shard, log_seq, log_block, cast(floor(num0 / 16) as bigint) batch_no, cast(num0 % 16 as bigint) seq from n"""))
def batch_requests(spark, sf_dir):
    batched = bulk.batch_requests(
        _requests(spark, sf_dir), 16, shard=F.pmod(F.col("id").cast("bigint"), F.lit(8)), span=bulk.log_block(65536))
    return batched.select(*ID, "id", "batch.shard", "batch.log_seq", "batch.log_block", F.col("batch.no").alias("batch_no"), "seq")


@register("bulk_bodies", with_views(["orders_log"], f"""
with r as (
  select *, k % 8 shard, cast(right(log_name, 6) as bigint) log_seq, cast(floor(log_pos / 65536) as bigint) log_block,
    concat('{{"', {ACTION_SQL}, '":{{"_id":"', k, '","_index":"orders_idx"}}}}', case when event_type <> 'delete' then concat(chr(10), {SORTED_DATA_SQL}) end) line
  from orders_log where {ROW_SQL}),
n as (select *, row_number() over (partition by shard, server_id, log_seq, log_block order by log_pos, row_ordinal) - 1 num0 from r)
select shard, server_id, log_seq, log_block, cast(floor(num0 / 16) as bigint) batch_no, count(*) requests,
  concat(string_agg(line, chr(10) order by num0), chr(10)) body
from n group by all"""))
def bulk_bodies(spark, sf_dir):
    batched = bulk.batch_requests(
        _requests(spark, sf_dir), 16, shard=F.pmod(F.col("id").cast("bigint"), F.lit(8)), span=bulk.log_block(65536))
    return bulk.bulk_bodies(batched).select(
        "batch.shard", "batch.server_id", "batch.log_seq", "batch.log_block", F.col("batch.no").alias("batch_no"), "requests", "body")


@register("batch_by_time", with_views(["orders_log"], f"""
select {ID_SQL}, cast(floor(ts_sec / 3) * 3 + 3 as bigint) flush_at from orders_log where {ROW_SQL}"""))
def batch_by_time(spark, sf_dir):
    return bulk.batch_by_time(_requests(spark, sf_dir)).select(*ID, "flush_at")


@register("bulk_errors", """
with answers as (select o_orderkey, o_orderkey % 901 = 0 cut, if(o_orderkey % 700 = 0, 503, 200) code, o_orderkey % 300 = 0 and o_orderkey % 901 <> 0 item from orders)
select o_orderkey req_id, cast(code as int) code,
  if(item, 'create', '') action, if(item, 'orders_idx', '') idx,
  if(item, cast(o_orderkey as varchar), '') id, cast(if(item, 409, code) as bigint) status,
  case when item then concat('create index: orders_idx, type: _doc, id: ', o_orderkey, ', status: 409, error: {"type":"version_conflict"}')
    when code = 503 then ' index: , type: , id: , status: 503, error: bulk request failed with status 503'
    else ' index: , type: , id: , status: 200, error: unreadable bulk response with status 200' end message
from answers where cut or item or code = 503""")
def bulk_errors(spark, sf_dir):
    errors = bulk.bulk_errors(V.bulk_responses(spark, sf_dir))
    return errors.select("req_id", "code", "action", F.col("index").alias("idx"), "id", "status", "message")

# --------------------------------------------------------------------- documents

DOC_SQL = """concat('{"o_custkey":', o_custkey, ',"o_note":', case when o_orderkey % 3 = 0 then 'null' when o_orderkey % 11 = 0 then concat('"it', chr(39), 's"') else concat('"note ', o_orderkey, '"') end,
  ',"o_orderkey":', o_orderkey, ',"o_totalprice":', rtrim(rtrim(cast(cast(o_totalprice as decimal(15,2)) as varchar), '0'), '.'),
  ',"status":"', case when o_orderkey % 3 = 0 then 'N' else o_orderstatus end, '"}')"""
VERSION_SQL = "154 + o_orderkey % 500 * 800 + case when o_orderkey % 3 = 0 then 100 else 200 end"


def _docs(spark, sf_dir):
    return docs.current_docs(_requests(spark, sf_dir))


def _doc_columns():
    return [F.col("index").alias("idx"), "id", C.cells_json(F.col("data")).alias("data")]


@register("current_docs", f"""
select 'orders_idx' idx, cast(o_orderkey as varchar) id, {DOC_SQL} data, {VERSION_SQL} log_pos from orders where o_orderkey % 7 <> 0""")
def current_docs(spark, sf_dir):
    return _docs(spark, sf_dir).select(*_doc_columns(), F.col("version.log_pos").alias("log_pos"))


PLAIN_UPDATES = [M.Rule("shop", "orders", index="orders_idx", field_mapping={"o_orderstatus": "status"})]


@register("merge_docs", f"""
select 'orders_idx' idx, cast(o_orderkey as varchar) id, {DOC_SQL} data, {VERSION_SQL} log_pos from orders where o_orderkey % 7 <> 0""")
def merge_docs(spark, sf_dir):
    # Updates reduced to what they change, as a log of partial images would hold them.
    changes = V.orders(spark, sf_dir)
    partial = changes.withColumn("after", F.when(
        F.col("event_type") == S.UPDATE, Q.changed_fields(F.col("before"), F.col("after"))).otherwise(F.col("after")))
    by_key = partial.withColumn("primary", F.array(F.lit("o_orderkey")))
    # The key is not among the changed fields, so it is taken from the old image.
    requests = M.to_requests(by_key.where(S.is_row_event()).withColumn("after", F.map_concat(
        F.col("after"), F.when(F.col("event_type") == S.UPDATE, F.create_map(
            F.lit("o_orderkey"), F.element_at("before", "o_orderkey"))).otherwise(S.empty_cells()))),
        M.rules_frame(spark, PLAIN_UPDATES))
    return docs.merge_docs(requests).select(*_doc_columns(), F.col("version.log_pos").alias("log_pos"))


def _ids(spark, sf_dir, condition="true", shift=0):
    return V.table(spark, sf_dir, "orders").where(condition).select(
        F.lit("orders_idx").alias("index"), (F.col("o_orderkey") + shift).cast("string").alias("id"))


@register("get_docs", f"""
with docs as (select cast(o_orderkey as varchar) id, {DOC_SQL} data from orders where o_orderkey % 7 <> 0),
ids as (select cast(o_orderkey + 100 as varchar) id from orders)
select 'orders_idx' idx, ids.id, docs.id is not null found, docs.data from ids left join docs using (id)""")
def get_docs(spark, sf_dir):
    found = docs.get_docs(_docs(spark, sf_dir), _ids(spark, sf_dir, shift=100))
    return found.select(F.col("index").alias("idx"), "id", "found", C.cells_json(F.col("data")).alias("data"))


@register("docs_exist", """
with docs as (select o_orderkey from orders where o_orderkey % 7 <> 0)
select 'orders_idx' idx, cast(o.o_orderkey + 100 as varchar) id, d.o_orderkey is not null found
from orders o left join docs d on d.o_orderkey = o.o_orderkey + 100""")
def docs_exist(spark, sf_dir):
    found = docs.docs_exist(_docs(spark, sf_dir), _ids(spark, sf_dir, shift=100))
    return found.select(F.col("index").alias("idx"), "id", "found")


@register("put_docs", f"""
select 'orders_idx' idx, cast(o_orderkey as varchar) id,
  case when o_orderkey % 5 = 0 then concat('{{"o_orderkey":', o_orderkey, '}}') else {DOC_SQL} end data
from orders where o_orderkey % 7 <> 0 or o_orderkey % 5 = 0""")
def put_docs(spark, sf_dir):
    new = _ids(spark, sf_dir, "o_orderkey % 5 = 0").withColumn("data", F.create_map(F.lit("o_orderkey"), F.col("id")))
    return docs.put_docs(_docs(spark, sf_dir), new).select(*_doc_columns())


@register("delete_docs", f"""
select 'orders_idx' idx, cast(o_orderkey as varchar) id, {DOC_SQL} data from orders where o_orderkey % 7 <> 0 and o_orderkey % 5 <> 0""")
def delete_docs(spark, sf_dir):
    return docs.delete_docs(_docs(spark, sf_dir), _ids(spark, sf_dir, "o_orderkey % 5 = 0")).select(*_doc_columns())


@register("doc_fields", f"""
with d as (select cast({DOC_SQL} as json) j from orders where o_orderkey % 7 <> 0),
f as (select j, unnest(json_keys(j)) field from d),
k as (select field, case json_type(j, concat('$."', field, '"')) when 'NULL' then 0 when 'BOOLEAN' then 1 when 'VARCHAR' then 3 when 'OBJECT' then 4 when 'ARRAY' then 4 else 2 end kind from f),
g as (select field, count(*) docs, coalesce(min(kind) filter (where kind > 0), 0) low, max(kind) high from k group by field),
n as (select *, ['null', 'boolean', 'number', 'string', 'object'] names from g)
select 'orders_idx' idx, field, docs, case when low = high then names[low + 1] else concat(names[low + 1], '|', names[high + 1]) end "type" from n""")
def doc_fields(spark, sf_dir):
    return docs.doc_fields(_docs(spark, sf_dir)).select(F.col("index").alias("idx"), "field", "docs", "type")

# ----------------------------------------------------------------------- offsets


def _decoded(spark, sf_dir):
    return codec.decode_changes(V.messages(spark, sf_dir))


@register("starting_offsets", with_views(["messages"], """
select distinct topic, "partition", cast(case "partition" when 0 then 1000 when 1 then 20 else -2 end as bigint) "start" from messages"""))
def starting_offsets(spark, sf_dir):
    return O.starting_offsets(V.messages(spark, sf_dir), V.stored_offsets(spark), use_oldest=True)


@register("latest_offsets", with_views(["messages"], """
select topic, "partition", max("offset") "offset" from messages group by 1, 2"""))
def latest_offsets(spark, sf_dir):
    return O.latest_offsets(V.messages(spark, sf_dir))


@register("resume_messages", with_views(["messages"], """
select topic, "partition", "offset", event_type from messages
where "offset" >= case "partition" when 0 then 1000 when 1 then 20 else 500 end"""))
def resume_messages(spark, sf_dir):
    resumed = O.resume_messages(V.messages(spark, sf_dir), V.stored_offsets(spark), default=500)
    return codec.decode_changes(resumed).select("topic", "partition", "offset", "event_type")


@register("dedup_changes", with_views(["orders_log"], f"select {ID_SQL}, event_type, after_json from orders_log"))
def dedup_changes(spark, sf_dir):
    return O.dedup_changes(_decoded(spark, sf_dir)).select(*ID, "event_type", C.cells_json(F.col("after")).alias("after_json"))


@register("order_changes", with_views(["orders_log", "lineitem_log"], f"""
select {ID_SQL}, event_type, tbl "table", before_json, after_json from orders_log
union all select {ID_SQL}, event_type, tbl, before_json, after_json from lineitem_log"""))
def order_changes(spark, sf_dir):
    both = V.orders(spark, sf_dir).unionByName(V.lineitem(spark, sf_dir))
    return O.order_changes(both).select(*ID, "event_type", "table", C.cells_json(F.col("before")).alias("before_json"),
                                        C.cells_json(F.col("after")).alias("after_json"))


@register("order_breaks", with_views(["orders_log", "lineitem_log"], """
select server_id, tbl "table", count(*) events, 0 breaks from orders_log group by all
union all select server_id, tbl, count(*), 0 from lineitem_log group by all"""))
def order_breaks(spark, sf_dir):
    both = V.orders(spark, sf_dir).unionByName(V.lineitem(spark, sf_dir))
    return O.order_breaks(O.order_changes(both, O.partitions_for(both, 8)))


# ------------------------------------------------------------ progress and health


@register("progress", with_views(["orders_log"], """
with points as (
  select server_id, cast(floor(ts_sec / 3) * 3 + 3 as bigint) saved_at, log_name, log_pos from orders_log
  union all select server_id, ts_sec, log_name, log_pos from orders_log where event_type in ('rotate', 'ddl')),
n as (select *, row_number() over (partition by server_id, saved_at order by cast(right(log_name, 6) as bigint) desc, log_pos desc) r from points),
p as (select *, lag(log_name) over w l_name, lag(log_pos) over w l_pos from n where r = 1 window w as (partition by server_id order by saved_at))
select server_id, saved_at, log_name, log_pos from p where l_name is distinct from log_name or l_pos is distinct from log_pos"""))
def progress(spark, sf_dir):
    return G.progress(V.orders(spark, sf_dir))


@register("lag_bytes", with_views(["position_samples"], """
select server_id, event_id, db_pos - case when file_seq = db_seq then file_pos else 0 end lag_bytes, db_seq - file_seq files_behind from position_samples"""))
def lag_bytes(spark, sf_dir):
    return H.lag_bytes(V.position_samples(spark, sf_dir)).select("server_id", "event_id", "lag_bytes", "files_behind")


def _judged(spark, sf_dir):
    return H.health(V.position_samples(spark, sf_dir))


@register("health", with_views(["judged"], "select server_id, event_id, level, status, reasons from judged"))
def health(spark, sf_dir):
    return _judged(spark, sf_dir).select("server_id", "event_id", "level", "status", F.array_join("reasons", "|").alias("reasons"))


@register("health_recheck", with_views(["judged"], """
select server_id, event_id, grew, coalesce(l_file_seq, file_seq) last_file_seq, coalesce(l_file_pos, file_pos) last_file_pos from judged"""))
def health_recheck(spark, sf_dir):
    checked = H.recheck(V.position_samples(spark, sf_dir))
    return checked.select("server_id", "event_id", "grew", F.col("last.file.file_seq").alias("last_file_seq"),
                          F.col("last.file.file_pos").alias("last_file_pos"))


@register("worst_status", with_views(["judged"], """
select server_id, strftime(ts, '%Y-%m-%d') "day", max(level) level, case max(level) when 2 then 'red' when 1 then 'yellow' else 'green' end status
from judged group by 1, 2"""))
def worst_status(spark, sf_dir):
    days = _judged(spark, sf_dir).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return H.worst_status(days, ["server_id", "day"])


@register("alerts", with_views(["judged"], """
with s as (select *, coalesce(lag(status) over (partition by server_id order by ms, file_seq, file_pos, db_seq, db_pos), '') last_status from judged)
select server_id, event_id, status, last_status, reasons from s where status <> last_status and status <> 'green'"""))
def alerts(spark, sf_dir):
    raised = H.alerts(_judged(spark, sf_dir))
    return raised.select("server_id", "event_id", "status", "last_status", F.array_join("reasons", "|").alias("reasons"))


# ------------------------------------------------------- health from saved positions

SAVED_SQL = """saved as (select user_id server_id, cast(floor(epoch(cast(ts as timestamp))) as bigint) saved_at,
    max(struct_pack(q := cast(floor(event_id / 5000) as bigint), p := event_id * 16)) s from events where event_id % 3 = 0 group by 1, 2),
db as (select user_id server_id, event_id, cast(ts as timestamp) ts, epoch_ms(cast(ts as timestamp)) ms,
    cast(floor(event_id / 5000) as bigint) db_seq, event_id * 16 db_pos from events)"""


def _saved_and_db(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Every third event is a save of its server's position; every event asks the server where it stands."""
    events = V.table(spark, sf_dir, "events")
    saved = events.where("event_id % 3 = 0").selectExpr(
        "user_id server_id", "unix_seconds(cast(ts as timestamp)) saved_at",
        "concat('mysql-bin.', lpad(cast(floor(event_id / 5000) as string), 6, '0')) log_name", "event_id * 16 log_pos")
    db = events.selectExpr("user_id server_id", "event_id", "cast(ts as timestamp) ts", "cast(floor(event_id / 5000) as bigint) db_seq",
                           "event_id * 16 db_pos", "'' db_error")
    return saved, db


@register("position_samples", f"""
with {SAVED_SQL}
select db.server_id, db.event_id, coalesce(s.s.q, -1) file_seq, coalesce(s.s.p, 0) file_pos, db_seq, db_pos
from db asof left join saved s on db.server_id = s.server_id and db.ms >= s.saved_at * 1000""")
def position_samples(spark, sf_dir):
    samples = H.position_samples(*_saved_and_db(spark, sf_dir))
    return samples.select("server_id", "event_id", "file_seq", "file_pos", "db_seq", "db_pos")


@register("health_saved", f"""
with {SAVED_SQL},
now_ as (select db.*, coalesce(s.s.q, -1) fq, coalesce(s.s.p, 0) fp from db asof left join saved s on db.server_id = s.server_id and db.ms >= s.saved_at * 1000),
late_ as (select n.*, coalesce(s.s.q, -1) lq, coalesce(s.s.p, 0) lp, n.ms + 86400000 later from now_ n asof left join saved s on n.server_id = s.server_id and n.ms + 86400000 >= s.saved_at * 1000)
select server_id, event_id, (lq > fq or (lq = fq and lp > fp)) grew from late_""")
def health_saved(spark, sf_dir):
    """The grace period is a day, as the events of a server are far apart."""
    saved, db = _saved_and_db(spark, sf_dir)
    samples = H.position_samples(saved, db)
    return H.recheck(samples, 86_400, saved=saved).select("server_id", "event_id", "grew")
