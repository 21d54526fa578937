"""Change logs derived from the driver's tables: as DataFrames for Spark, as SQL for the oracle.

Both forms follow FIXTURES.md. The DataFrames unfold the events of a row with ``explode`` and so read a table
once; the SQL is portable and reads it once per event kind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from changeflow import schema as S
from changeflow.functions.cells import parse_cells
from changeflow.operators.mapping import Rule

# ---------------------------------------------------------------- DataFrames


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_image(status: str, note: str) -> str:
    return (f"""concat('{{"o_custkey":', c, ',"o_note":', coalesce(concat('"', {note}, '"'), 'null'), """
            f"""',"o_orderkey":', k, ',"o_orderstatus":"', {status}, '","o_totalprice":', tp, '}}')""")


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey k", "cast(floor(o_orderkey / 500) as bigint) f", "o_custkey c", "o_orderstatus st",
        "cast(cast(o_totalprice as decimal(15,2)) as string) tp",
        "if(o_orderkey % 11 = 0, concat('it', chr(39), 's'), concat('note ', o_orderkey)) note")
    events = base.selectExpr("*", """explode(array_compact(array(
        0, 1, if(k % 3 <> 0, 2, null), if(k % 7 = 0, 3, null), 4,
        if(k % 1000 = 0, 5, null), if(k % 1000 = 0, 6, null), if(k % 500 = 499, 7, null)))) as s""")
    images = events.selectExpr(
        "*",
        "element_at(array('gtid','insert','update','delete','xid','table_change','ddl','rotate'), s + 1) event_type",
        "case s when 2 then 'N' when 3 then if(k % 3 <> 0, st, 'N') end b_st",
        "case s when 1 then 'N' when 2 then st end a_st",
        "if(s = 3 and k % 3 <> 0, note, null) b_note", "if(s = 2, note, null) a_note")
    return images.selectExpr(
        "event_type", "1 + f % 4 server_id", "f file_no", "k % 500 * 10 + s event_seq",
        "concat('mysql-bin.', lpad(cast(if(s = 7, f + 4, f) as string), 6, '0')) log_name",
        "if(s = 7, 4L, 154 + k % 500 * 800 + s * 100) log_pos", "0L row_ordinal",
        "if(s in (0, 4, 7), '', 'shop') db", "if(s in (0, 4, 6, 7), '', 'orders') tbl",
        "if(s = 6, concat('ALTER TABLE `orders` ADD COLUMN `c', k, '` int'), '') sql_text",
        "if(s in (4, 7), '', concat('u', 1 + f % 4, ':', k)) gtid_set",
        "if(s in (1, 2, 3), 'o_orderkey', '') pk",
        f"if(s in (2, 3), {_order_image('b_st', 'b_note')}, '{{}}') before_json",
        f"if(s in (1, 2), {_order_image('a_st', 'a_note')}, '{{}}') after_json",
        "1700000000 + k * 10 + s ts_sec", "k", "s")


def _line_image(flag: str) -> str:
    return (f"""concat('{{"l_extendedprice":', p, ',"l_linenumber":', n, ',"l_orderkey":', k, ',"l_quantity":', q, """
            f"""',"l_returnflag":"', {flag}, '"}}')""")


def lineitem_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey k", "l_linenumber n", "cast(floor(l_orderkey / 500) as bigint) f", "l_returnflag rf",
        "cast(cast(l_quantity as decimal(15,2)) as string) q",
        "cast(cast(l_extendedprice as decimal(15,2)) as string) p",
        "(l_partkey * 10000 + l_suppkey) * 100 + cast(l_quantity as bigint) row_ordinal")
    events = base.selectExpr("*", """explode(array_compact(array(
        1, if(n % 2 = 0, 2, null), if(n % 5 = 0, 3, null)))) as s""")
    images = events.selectExpr(
        "*", "element_at(array('insert','update','delete'), s) event_type",
        "case s when 2 then 'N' when 3 then if(n % 2 = 0, rf, 'N') end b_rf",
        "case s when 1 then 'N' when 2 then rf end a_rf")
    return images.selectExpr(
        "event_type", "1 + f % 4 server_id", "f file_no",
        "concat('mysql-bin.', lpad(cast(f as string), 6, '0')) log_name",
        "154 + k % 500 * 8000 + n * 1000 + s * 100 log_pos", "row_ordinal", "'shop' db", "'lineitem' tbl",
        "'' sql_text", "'' gtid_set", "'' pk",
        f"if(s = 1, '{{}}', {_line_image('b_rf')}) before_json", f"if(s = 3, '{{}}', {_line_image('a_rf')}) after_json",
        "1700000000 + k * 10 + s ts_sec", "k", "s")


def turns_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", "role", "length(text) n_chars", """substring(to_json(struct(text)), 9, length(to_json(struct(text))) - 9) quoted""",
        "explode(if(turn % 5 = 4, array(1, 3), array(1))) as s")
    image = """concat('{"conv_id":', conv_id, ',"n_chars":', n_chars, ',"role":"', role, '","text":', quoted, ',"turn":', turn, '}')"""
    return events.selectExpr(
        "if(s = 1, 'insert', 'delete') event_type", "9L server_id", "0L file_no", "'mysql-bin.000000' log_name",
        "154 + conv_id * 100000 + turn * 1000 + s * 100 log_pos", "0L row_ordinal", "'Chat' db", "'turns' tbl",
        "'' sql_text", "'' gtid_set", "'conv_id,turn' pk",
        f"if(s = 1, '{{}}', {image}) before_json", f"if(s = 1, {image}, '{{}}') after_json",
        "1700000000 + conv_id * 10 + turn ts_sec", "conv_id k", "s")


def as_changes(log: DataFrame) -> DataFrame:
    """A flat log as change events."""
    return log.select(
        "event_type", "server_id", "log_name", "log_pos", "db", F.col("tbl").alias("table"),
        F.col("sql_text").alias("sql"), "gtid_set",
        F.when(F.length("pk") > 0, F.split("pk", ",")).otherwise(S.empty_names()).alias("primary"),
        parse_cells(F.col("before_json")).alias("before"), parse_cells(F.col("after_json")).alias("after"),
        F.col("ts_sec").alias("timestamp"), "row_ordinal")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_changes(orders_log(spark, sf_dir))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_changes(lineitem_log(spark, sf_dir))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_changes(turns_log(spark, sf_dir))


_ORDER_COLUMNS = ("o_custkey", "o_note", "o_orderkey", "o_orderstatus", "o_totalprice")


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders_log`` as a connector would deliver it: GTIDs only on gtid events, file names on rotate events, schema
    changes and commits, rows as value arrays. Each server's first file starts with a rotate event of its own."""
    log = orders_log(spark, sf_dir)
    columns = F.array(*map(F.lit, _ORDER_COLUMNS))
    before, after = parse_cells(F.col("before_json")), parse_cells(F.col("after_json"))
    values = lambda cells: F.transform(columns, lambda c: F.element_at(cells, c))
    kind = F.col("event_type")
    is_row = S.is_row_event()
    rows = (F.when(kind == "insert", F.array(values(after))).when(kind == "delete", F.array(values(before)))
            .when(kind == "update", F.array(values(before), values(after))))
    # The opening rotate comes with the first event of a server's first file.
    opens = (F.col("file_no") < 4) & (F.col("event_seq") == 0)
    copies = F.explode(F.when(opens, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("opening")
    both = log.select("*", copies)
    opening = F.col("opening")
    event = both.select(
        "server_id", "file_no", F.when(opening, F.lit(-1)).otherwise(F.col("event_seq")).cast("bigint").alias("event_seq"),
        F.when(opening, "rotate").when(is_row, "row").otherwise(kind).alias("event_kind"),
        F.when(is_row & ~opening, kind).alias("action"),
        F.when(opening, F.lit(4).cast("bigint")).otherwise(F.col("log_pos")).alias("log_pos"),
        F.when(opening | kind.isin("rotate", "ddl", "xid"), F.col("log_name")).alias("next_log"),
        F.when((kind == "gtid") & ~opening, F.col("gtid_set")).alias("gtid"),
        F.when(opening, "").otherwise(F.col("db")).alias("db"),
        F.when(opening, "").otherwise(F.col("tbl")).alias("table"),
        F.when(is_row & ~opening, columns).alias("columns"),
        F.when(is_row & ~opening, F.array(F.lit(2))).alias("pk_idx"),
        F.when(~opening, rows).alias("rows"),
        F.when(opening, "").otherwise(F.col("sql_text")).alias("query"), F.col("ts_sec").alias("timestamp"))
    return event


def order_rows_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row events that hold several rows: an insert of ``1 + k % 3`` rows per order, an update of ``1 + k % 2``
    pairs for two orders in three, a delete of one row for one in seven. The key is (order, line)."""
    base = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey k", "o_orderstatus st", "cast(floor(o_orderkey / 500) as bigint) f",
        """explode(array_compact(array('insert', if(o_orderkey % 3 <> 0, 'update', null),
                                       if(o_orderkey % 7 = 0, 'delete', null)))) as action""")
    row = """array(cast(i as string), cast(k as string), {})"""
    new, old = row.format("concat('\"', st, '\"')"), row.format("'\"N\"'")
    return base.selectExpr(
        "1 + f % 4 server_id", "f file_no",
        "k % 500 * 10 + case action when 'insert' then 1 when 'update' then 2 else 3 end event_seq",
        "'row' event_kind", "action",
        "154 + k % 500 * 800 + 100 log_pos", "cast(null as string) next_log", "cast(null as string) gtid",
        "'shop' db", "'order_lines' `table`",
        "array('o_line', 'o_orderkey', 'o_status') columns", "array(1, 0) pk_idx",
        f"""case action
            when 'insert' then transform(sequence(0L, k % 3), i -> {old})
            when 'update' then flatten(transform(sequence(0L, k % 2), i -> array({old}, {new})))
            else transform(array(0L), i -> {new}) end rows""",
        "'' query", "1700000000 + k * 10 timestamp")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic as a table: every 50th transaction is delivered twice."""
    log = orders_log(spark, sf_dir)
    value = F.expr("""concat('{"event_type":"', event_type, '","server_id":', server_id, ',"log_name":"', log_name,
        '","log_pos":', log_pos, ',"db":"', db, '","table":"', tbl, '","sql":"', sql_text, '","gtid_set":"', gtid_set,
        '","primary":[', if(pk = '', '', concat('"', pk, '"')), '],"before":', before_json, ',"after":', after_json,
        ',"timestamp":', ts_sec, '}')""")
    copies = F.expr("explode(if(k % 50 = 0, array(0, 10), array(0))) as copy")
    return log.select("k", "s", value.alias("value"), copies).selectExpr(
        "'binlog' topic", "cast(k % 3 as int) partition", "cast(floor(k / 3) as bigint) * 20 + copy + s offset", "value")


def stored_offsets(spark: SparkSession) -> DataFrame:
    return spark.sql("select * from values ('binlog', 0, 1000L), ('binlog', 1, 20L) t(topic, partition, offset)")


def saved_positions(spark: SparkSession) -> DataFrame:
    """Server 3 has an empty position and server 4 none: both start at the latest."""
    return spark.sql("""select * from values (1L, 'mysql-bin.000004', 100154L), (2L, 'mysql-bin.000001', 154L),
        (3L, '', 0L) t(server_id, log_name, log_pos)""")


RULES = (
    Rule("shop", "orders", index="orders_idx", field_mapping={"o_orderstatus": "status"}, actions={"update": "index"}),
    Rule("shop", "lineitem", id_field="l_orderkey"),
    Rule("Chat", "turns", pipeline="clean"),
)


def bulk_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer per order; some name a failed item, some failed as a whole, some are cut off."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey req_id", "if(o_orderkey % 700 = 0, 503, 200) code",
        """concat('{"took":3,"errors":', if(o_orderkey % 300 = 0, 'true', 'false'),
            ',"items":[{"create":{"_index":"orders_idx","_type":"_doc","_id":"', o_orderkey, '","_version":1,"status":',
            if(o_orderkey % 300 = 0, '409,"error":{"type":"version_conflict"}', '201'),
            '}},{"update":{"_index":"orders_idx","_type":"_doc","_id":"', o_orderkey + 1,
            '","_version":2,"status":200}}]}') answer""").selectExpr(
        "req_id", "code", "if(req_id % 901 = 0, substring(answer, 1, 30), answer) body")


def position_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id`` plays the server. An error event is a failed query, a purchase is behind, a view is stuck for
    long spans, a signup sits in the previous file."""
    return table(spark, sf_dir, "events").selectExpr(
        "user_id server_id", "event_id", "cast(ts as timestamp) ts", "cast(floor(event_id / 5000) as bigint) db_seq",
        "if(event_type = 'error', 0L, 4 + cast(floor(event_id / 300) as bigint) * 5000) db_pos",
        "if(event_type = 'error', 'timeout', '') db_error",
        "if(event_type = 'signup', greatest(cast(floor(event_id / 5000) as bigint) - 1, 0L), "
        "cast(floor(event_id / 5000) as bigint)) file_seq",
        """case event_type when 'purchase' then greatest(4 + cast(floor(event_id / 300) as bigint) * 5000 - 20000, 4L)
            when 'view' then 4 + cast(floor(event_id / 3000) as bigint) * 50000
            else 4 + cast(floor(event_id / 300) as bigint) * 5000 end file_pos""")


# ----------------------------------------------------------------------- SQL

_DUCK: dict[str, str] = {}

_DUCK["orders_log"] = """
with base as (
  select o_orderkey k, cast(floor(o_orderkey / 500) as bigint) f, o_custkey c, o_orderstatus st,
         cast(cast(o_totalprice as decimal(15,2)) as varchar) tp,
         case when o_orderkey % 11 = 0 then concat('it', chr(39), 's') else concat('note ', o_orderkey) end note
  from orders),
ev as (
  select k, f, c, tp, 0 s, 'gtid' event_type, cast(null as varchar) b_st, cast(null as varchar) a_st, cast(null as varchar) b_note, cast(null as varchar) a_note from base
  union all select k, f, c, tp, 1, 'insert', null, 'N', null, null from base
  union all select k, f, c, tp, 2, 'update', 'N', st, null, note from base where k % 3 <> 0
  union all select k, f, c, tp, 3, 'delete', case when k % 3 <> 0 then st else 'N' end, null, case when k % 3 <> 0 then note end, null from base where k % 7 = 0
  union all select k, f, c, tp, 4, 'xid', null, null, null, null from base
  union all select k, f, c, tp, 5, 'table_change', null, null, null, null from base where k % 1000 = 0
  union all select k, f, c, tp, 6, 'ddl', null, null, null, null from base where k % 1000 = 0
  union all select k, f, c, tp, 7, 'rotate', null, null, null, null from base where k % 500 = 499),
nums as (select *, rtrim(rtrim(tp, '0'), '.') num from ev)
select event_type, 1 + f % 4 server_id, f file_no, k % 500 * 10 + s event_seq,
  concat('mysql-bin.', lpad(cast(case when event_type = 'rotate' then f + 4 else f end as varchar), 6, '0')) log_name,
  case when event_type = 'rotate' then 4 else 154 + k % 500 * 800 + s * 100 end log_pos,
  cast(0 as bigint) row_ordinal,
  case when event_type in ('gtid', 'xid', 'rotate') then '' else 'shop' end db,
  case when event_type in ('gtid', 'xid', 'rotate', 'ddl') then '' else 'orders' end tbl,
  case when event_type = 'ddl' then concat('ALTER TABLE `orders` ADD COLUMN `c', k, '` int') else '' end sql_text,
  case when event_type in ('xid', 'rotate') then '' else concat('u', 1 + f % 4, ':', k) end gtid_set,
  case when event_type in ('insert', 'update', 'delete') then 'o_orderkey' else '' end pk,
  case when event_type in ('update', 'delete') then concat('{"o_custkey":', c, ',"o_note":', case when b_note is null then 'null' else concat('"', b_note, '"') end, ',"o_orderkey":', k, ',"o_orderstatus":"', b_st, '","o_totalprice":', num, '}') else '{}' end before_json,
  case when event_type in ('insert', 'update') then concat('{"o_custkey":', c, ',"o_note":', case when a_note is null then 'null' else concat('"', a_note, '"') end, ',"o_orderkey":', k, ',"o_orderstatus":"', a_st, '","o_totalprice":', num, '}') else '{}' end after_json,
  1700000000 + k * 10 + s ts_sec, k, s, f, c, num, b_st, a_st, b_note, a_note
from nums"""

_DUCK["lineitem_log"] = """
with base as (
  select l_orderkey k, l_linenumber n, cast(floor(l_orderkey / 500) as bigint) f, l_returnflag rf,
    rtrim(rtrim(cast(cast(l_quantity as decimal(15,2)) as varchar), '0'), '.') q,
    rtrim(rtrim(cast(cast(l_extendedprice as decimal(15,2)) as varchar), '0'), '.') p,
    (l_partkey * 10000 + l_suppkey) * 100 + cast(l_quantity as bigint) row_ordinal
  from lineitem),
ev as (
  select *, 1 s, 'insert' event_type, cast(null as varchar) b_rf, 'N' a_rf from base
  union all select *, 2, 'update', 'N', rf from base where n % 2 = 0
  union all select *, 3, 'delete', case when n % 2 = 0 then rf else 'N' end, null from base where n % 5 = 0)
select event_type, 1 + f % 4 server_id, f file_no, concat('mysql-bin.', lpad(cast(f as varchar), 6, '0')) log_name,
  154 + k % 500 * 8000 + n * 1000 + s * 100 log_pos, row_ordinal, 'shop' db, 'lineitem' tbl, '' sql_text, '' gtid_set, '' pk,
  case when event_type = 'insert' then '{}' else concat('{"l_extendedprice":', p, ',"l_linenumber":', n, ',"l_orderkey":', k, ',"l_quantity":', q, ',"l_returnflag":"', b_rf, '"}') end before_json,
  case when event_type = 'delete' then '{}' else concat('{"l_extendedprice":', p, ',"l_linenumber":', n, ',"l_orderkey":', k, ',"l_quantity":', q, ',"l_returnflag":"', a_rf, '"}') end after_json,
  1700000000 + k * 10 + s ts_sec, k, n, s
from ev"""

_DUCK["turns_log"] = """
with ev as (
  select conv_id, turn, role, text, length(text) n_chars, 1 s, 'insert' event_type from conversations
  union all select conv_id, turn, role, text, length(text), 3, 'delete' from conversations where turn % 5 = 4),
im as (select *, concat('{"conv_id":', conv_id, ',"n_chars":', n_chars, ',"role":"', role, '","text":', cast(to_json(text) as varchar), ',"turn":', turn, '}') j from ev)
select event_type, cast(9 as bigint) server_id, cast(0 as bigint) file_no, 'mysql-bin.000000' log_name,
  154 + conv_id * 100000 + turn * 1000 + s * 100 log_pos, cast(0 as bigint) row_ordinal,
  'Chat' db, 'turns' tbl, '' sql_text, '' gtid_set, 'conv_id,turn' pk,
  case when event_type = 'insert' then '{}' else j end before_json,
  case when event_type = 'insert' then j else '{}' end after_json,
  1700000000 + conv_id * 10 + turn ts_sec, conv_id, turn, role, text, n_chars, s
from im"""

_DUCK["messages"] = """
select 'binlog' topic, cast(k % 3 as int) "partition", cast(floor(k / 3) as bigint) * 20 + s "offset", l.* from orders_log l
union all
select 'binlog', cast(k % 3 as int), cast(floor(k / 3) as bigint) * 20 + 10 + s, l.* from orders_log l where k % 50 = 0"""

_DUCK["order_rows"] = """
with base as (
  select o_orderkey k, o_orderstatus st, cast(floor(o_orderkey / 500) as bigint) f from orders),
ev as (
  select k, f, 1 s, 'insert' action, i, cast(null as varchar) b, 'N' a from base, unnest(range(0, 1 + k % 3)) u(i)
  union all select k, f, 2, 'update', i, 'N', st from base, unnest(range(0, 1 + k % 2)) u(i) where k % 3 <> 0
  union all select k, f, 3, 'delete', 0, st, null from base where k % 7 = 0)
select 1 + f % 4 server_id, f file_no, k % 500 * 10 + s event_seq, action, cast(i as bigint) row_ordinal,
  case when b is null then '{}' else concat('{"o_line":', i, ',"o_orderkey":', k, ',"o_status":"', b, '"}') end before_json,
  case when a is null then '{}' else concat('{"o_line":', i, ',"o_orderkey":', k, ',"o_status":"', a, '"}') end after_json
from ev"""

_DUCK["position_samples"] = """
select user_id server_id, event_id, ts, epoch_ms(ts) ms, cast(floor(event_id / 5000) as bigint) db_seq,
  case when event_type = 'error' then 0 else 4 + cast(floor(event_id / 300) as bigint) * 5000 end db_pos,
  case when event_type = 'error' then 'timeout' else '' end db_error,
  case when event_type = 'signup' then greatest(cast(floor(event_id / 5000) as bigint) - 1, 0) else cast(floor(event_id / 5000) as bigint) end file_seq,
  case event_type when 'purchase' then greatest(4 + cast(floor(event_id / 300) as bigint) * 5000 - 20000, 4)
    when 'view' then 4 + cast(floor(event_id / 3000) as bigint) * 50000
    else 4 + cast(floor(event_id / 300) as bigint) * 5000 end file_pos
from events"""

_DUCK["judged"] = """
with w as (
  select *, lag(file_seq) over o l_file_seq, lag(file_pos) over o l_file_pos, lag(db_seq) over o l_db_seq, lag(db_pos) over o l_db_pos,
    max(file_seq * 1000000000 + file_pos) over (partition by server_id order by ms range between 1 following and 5000 following) best
  from position_samples
  window o as (partition by server_id order by ms, file_seq, file_pos, db_seq, db_pos)),
r as (
  select *, db_error <> '' failed,
    case when file_seq = db_seq then file_pos else 0 end + 10000 < db_pos late,
    coalesce(best > file_seq * 1000000000 + file_pos, false) grew,
    file_seq = coalesce(l_file_seq, file_seq) and file_pos = coalesce(l_file_pos, file_pos) file_still,
    db_seq = coalesce(l_db_seq, db_seq) and db_pos = coalesce(l_db_pos, db_pos) db_still,
    file_seq <> db_seq or file_pos <> db_pos apart
  from w),
v as (
  select *, db_still and file_still and apart and not grew both_stopped, not db_still and file_still and not grew sync_stopped from r)
select *, cast(case when failed or both_stopped or sync_stopped then 2 when late then 1 else 0 end as int) level,
  case when failed or both_stopped or sync_stopped then 'red' when late then 'yellow' else 'green' end status,
  case when failed then 'failed to get db-pos.timeout' else concat_ws('|',
    case when late then 'The diff between db-pos and file-pos exceeds the threshold.' end,
    case when both_stopped then 'both of db-pos and file-pos make no progress, but file-pos still behind db-pos.' end,
    case when sync_stopped then 'db-pos makes progress while file-pos not.' end) end reasons
from v"""

_NEEDS = {"messages": ("orders_log",), "judged": ("position_samples",)}


def with_views(names: list[str], select: str) -> str:
    """The select with the named views put before it as CTEs; it may have CTEs of its own."""
    ordered: list[str] = []
    for name in names:
        for needed in (*_NEEDS.get(name, ()), name):
            if needed not in ordered:
                ordered.append(needed)
    views = "with " + ",\n".join(f"{name} as ({_DUCK[name]})" for name in ordered)
    select = select.strip()
    if select.startswith("with "):
        return views + ",\n" + select.removeprefix("with ")
    return views + "\n" + select
