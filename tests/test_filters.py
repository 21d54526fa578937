from pyspark.sql import functions as F

from changeflow.functions.positions import compare_positions, log_seq, position_key
from changeflow.operators import filters
from changeflow.operators.mapping import Rule, rules_frame
from changeflow.sources import codec
from tests.helpers import changes_of, one


def test_log_numbers(spark):
    df = spark.createDataFrame([("mysql-bin.000012",), ("mysql-bin.1000000",), ("",), ("odd",)], "n string")
    assert [r.s for r in df.select(log_seq(F.col("n")).alias("s")).collect()] == [12, 1000000, -1, -1]


def test_positions_compare_by_number(spark):
    df = spark.createDataFrame([("b.999999", 9, "b.1000000", 4), ("b.2", 4, "b.2", 4), ("b.3", 4, "b.2", 9)], "a string, p long, b string, q long")
    cmp = compare_positions(position_key(F.col("a"), F.col("p")), position_key(F.col("b"), F.col("q")))
    assert [r.c for r in df.select(cmp.alias("c")).collect()] == [-1, 0, 1]


def test_dbs_in_any_case_and_row_events_only(spark):
    changes = changes_of(spark, [{"db": "Shop", "log_pos": 1}, {"db": "x", "log_pos": 2}, {"db": "x", "event_type": "ddl", "log_pos": 3}])
    assert sorted(r.log_pos for r in filters.only_dbs(changes, ["SHOP"]).collect()) == [1, 3]
    assert filters.only_dbs(changes, []).count() == 3


def test_rules_are_broadcast(spark):
    changes = changes_of(spark, [{}])
    plan = filters.match_rules(changes, rules_frame(spark, [Rule("shop", "t")]))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_later_rule_of_a_table_wins(spark):
    rules = rules_frame(spark, [Rule("shop", "t", index="a"), Rule("shop", "u"), Rule("shop", "t", index="b")])
    assert sorted((r["table"], r["index"]) for r in rules.collect()) == [("t", "b"), ("u", "u")]


def cells(spark, m):
    return spark.createDataFrame([(m,)], "m map<string,string>")


def test_keep_fields(spark):
    df = cells(spark, {"a": "1", "b": None})
    keep = lambda names: one(df.select(filters.keep_fields(F.col("m"), names).alias("m"))).m
    assert keep(F.lit(None).cast("array<string>")) == {"a": "1", "b": None}
    assert keep(F.array().cast("array<string>")) == {}
    assert keep(F.array(F.lit("b"))) == {"b": None}


def test_two_fields_of_one_name(spark):
    mapping = F.create_map(F.lit("a"), F.lit("x"), F.lit("b"), F.lit("x"))
    got = one(cells(spark, {"b": "2", "a": "1", "c": "3"}).select(filters.rename_fields(F.col("m"), mapping).alias("m"))).m
    assert got == {"x": "2", "c": "3"}
    empty = one(cells(spark, {}).select(filters.rename_fields(F.col("m"), mapping).alias("m"))).m
    assert empty == {}


def test_since_without_saved_position_is_latest(spark):
    changes = changes_of(spark, [{"server_id": s, "log_pos": p, "log_name": f"b.{n}"} for s in (1, 2, 3) for n in (9, 10) for p in (5, 9)])
    saved = spark.createDataFrame([(1, "b.9", 5), (2, "", 7), (4, "b.1", 0)], "server_id long, log_name string, log_pos long")
    got = sorted((r.server_id, r.log_name, r.log_pos) for r in filters.changes_since(changes, saved).collect())
    assert got == [(1, "b.10", 5), (1, "b.10", 9), (1, "b.9", 9)]
    assert filters.changes_since(changes, saved, latest=True).count() == 0
    listed = filters.changes_since(changes, [tuple(r) for r in saved.collect()])
    assert sorted((r.server_id, r.log_name, r.log_pos) for r in listed.collect()) == got
    assert filters.changes_since(changes, [(2, "", 7)]).count() == 0


def test_resume_reads_from_the_saved_files_on(spark, tmp_path):
    from changeflow.sources.files import read_changes_files, write_changes_files
    rows = [{"server_id": s, "log_name": f"b.00000{n}", "log_pos": p} for s in (1, 2) for n in range(6) for p in (5, 9)]
    write_changes_files(changes_of(spark, rows), str(tmp_path / "log"))
    since = filters.changes_since(read_changes_files(spark, str(tmp_path / "log")), [(1, "b.000004", 5)])
    assert sorted((r.log_name, r.log_pos) for r in since.collect()) == [("b.000004", 9), ("b.000005", 5), ("b.000005", 9)]
    scan = since._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "substring_index(" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_malformed_messages_are_kept_aside(spark):
    rows = spark.createDataFrame([('{"event_type":"xid","server_id":1,"log_pos":4}',), ("{broken",), ("[]",), (None,)], "value string")
    got = codec.decode_changes(rows).select("event_type", "primary", "before", "row_ordinal", "malformed").collect()
    assert tuple(got[0]) == ("xid", [], {}, 0, None)
    assert [r.malformed for r in got[1:]] == ["{broken", "[]", ""]


def test_wire_form(spark):
    changes = changes_of(spark, [{"before": {}, "after": {"b": None, "a": '"x"'}, "log_pos": 7, "gtid_set": "u:1", "timestamp": 9}])
    assert one(codec.encode_changes(changes)).value == (
        '{"event_type":"insert","server_id":1,"log_name":"mysql-bin.000001","log_pos":7,"db":"shop","table":"t","sql":"",'
        '"gtid_set":"u:1","primary":["id"],"before":{},"after":{"a":"x","b":null},"timestamp":9,"row_ordinal":0}')


def test_row_ordinal_on_the_wire(spark):
    changes = changes_of(spark, [{"row_ordinal": 3, "after": {"id": "1"}}])
    again = codec.decode_changes(codec.encode_changes(changes, with_ordinal=True).select("value"))
    assert one(again).row_ordinal == 3


def test_db_filter_reaches_the_scan(spark, tmp_path):
    from changeflow.sources.files import read_changes_files, write_changes_files
    write_changes_files(changes_of(spark, [{"log_pos": 1}, {"server_id": 2, "log_pos": 2}]), str(tmp_path / "log"))
    log = read_changes_files(spark, str(tmp_path / "log"))
    plan = filters.only_types(log, ["insert"]).where("server_id = 2").select("log_pos")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(server_id" in plan and "EqualTo(event_type,insert)" in plan
    assert "before" not in plan.split("ReadSchema")[1]
