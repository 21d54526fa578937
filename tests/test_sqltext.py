from pyspark.sql import functions as F

from changeflow.functions import sqltext as Q
from changeflow.operators.sqllog import sql_log
from tests.helpers import changes_of, one


def literals(spark, cells, **how):
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    return [r.l for r in df.select(Q.sql_literal(F.col("c"), **how).alias("l")).collect()]


def test_literals(spark):
    cells = [None, '"x"', "12", "1.5", "true", '"null"', '"it\'s"', '"a\\\\b"', "[1,2]", '{"a":1}']
    assert literals(spark, cells) == [
        "NULL", "'x'", "12", "1.5", "true", "'null'", "'it\\'s'", "'a\\\\b'",
        "[InvalidFieldValue]: '[1,2]'", "[InvalidFieldValue]: '{\"a\":1}'"]


def test_literals_without_escapes(spark):
    assert literals(spark, ['"it\'s"'], escape=False) == ["'it's'"]


def test_null_in_where_and_set(spark):
    changes = changes_of(spark, [{"event_type": "update", "before": {"a": None, "b": "1"}, "after": {"a": '"x"', "b": None}}])
    row = one(changes.select(Q.sql_update(F.col("db"), F.col("table"), F.col("before"), F.col("after")).alias("q")))
    assert row.q == "UPDATE `shop`.`t` SET `a`='x', `b`=NULL WHERE `a` IS NULL AND `b`=1 LIMIT 1;"


def test_changed_fields_looks_at_fields_of_after_only(spark):
    changes = changes_of(spark, [
        {"before": {"a": "1", "gone": "2"}, "after": {"a": "1", "new": "3", "nil": None}},
        {"before": {"a": "1", "b": "2"}, "after": {"a": None, "b": "2"}}])
    rows = changes.select(Q.changed_fields(F.col("before"), F.col("after")).alias("m")).collect()
    assert [r.m for r in rows] == [{"new": "3"}, {"a": None}]


def test_update_without_change(spark):
    rows = [{"event_type": "update", "before": {"a": "1"}, "after": {"a": "1"}}]
    changes = changes_of(spark, rows)
    text = one(changes.select(Q.sql_update(F.col("db"), F.col("table"), F.col("before"), F.col("after")).alias("q"))).q
    assert text == "UPDATE `shop`.`t` SET  WHERE `a`=1 LIMIT 1;"
    assert sql_log(changes).count() == 0
    assert one(sql_log(changes, entire_fields=True)).line == "UPDATE `shop`.`t` SET `a`=1 WHERE `a`=1 LIMIT 1;"


MIXED = [
    {"event_type": "gtid", "log_pos": 1, "db": "", "table": "", "gtid_set": "u:1"},
    {"event_type": "insert", "log_pos": 2, "db": "Shop", "after": {"id": "1"}},
    {"event_type": "delete", "log_pos": 3, "db": "other", "before": {"id": "1"}},
    {"event_type": "ddl", "log_pos": 4, "db": "other", "table": "", "sql": "DROP TABLE x"},
    {"event_type": "xid", "log_pos": 5, "db": "", "table": ""},
    {"event_type": "rotate", "log_pos": 6, "db": "", "table": ""},
    {"event_type": "table_change", "log_pos": 7},
]


def test_log_of_mixed_events(spark):
    lines = [r.line for r in sql_log(changes_of(spark, MIXED), dbs=["sHOP"], show_tx=True, ordered=True).collect()]
    assert lines == ["/* GTID: u:1 */", "INSERT INTO `Shop`.`t`(`id`) VALUES (1);", "DROP TABLE x", "/* XID: mysql-bin.000001:5 */"]


def test_log_without_marks_has_no_marks(spark):
    lines = [r.line for r in sql_log(changes_of(spark, MIXED), ordered=True).collect()]
    assert lines == ["INSERT INTO `Shop`.`t`(`id`) VALUES (1);", "DELETE FROM `other`.`t` WHERE `id`=1 LIMIT 1;", "DROP TABLE x"]


def test_log_is_ordered_by_file_number(spark):
    rows = [{"event_type": "ddl", "log_name": f"bin.{n}", "log_pos": 4, "sql": n} for n in ("999999", "1000000", "000002")]
    assert [r.line for r in sql_log(changes_of(spark, rows), ordered=True).collect()] == ["000002", "999999", "1000000"]


def test_line_is_rendered_once(spark):
    """The emptiness check must not become a filter with a second copy of the rendering below."""
    plan = sql_log(changes_of(spark, MIXED))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("INSERT INTO") == 1, plan
