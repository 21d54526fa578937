import random

import pytest
from pyspark.sql import functions as F

from changeflow import schema as S
from changeflow.operators import normalise as N

RAW_NAMES = [c.split()[0].strip("`") for c in S.RAW_SCHEMA.split(", ")]


def raw_of(spark, rows):
    blank = {"server_id": 1, "file_no": 0, "log_pos": 0, "db": "", "table": "", "query": "", "timestamp": 0}
    full = [{**dict.fromkeys(RAW_NAMES), **blank, "event_seq": i, **r} for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[n] for n in RAW_NAMES) for r in full], S.RAW_SCHEMA)


def fold(rows, start=("", 0, "")):
    """The carry rule, one event at a time."""
    out, state = {}, {}
    for r in sorted(rows, key=lambda r: (r["server_id"], r["file_no"], r["event_seq"])):
        name, pos, gtid = state.get(r["server_id"], start)
        kind = r["event_kind"]
        new_name = r["next_log"] if kind in ("rotate", "ddl", "xid") else name
        if new_name and r["log_pos"]:
            name, pos = new_name, r["log_pos"]
        if kind in ("gtid", "ddl") and r["gtid"]:
            gtid = r["gtid"]
        state[r["server_id"]] = (name, pos, gtid)
        out[(r["server_id"], r["file_no"], r["event_seq"])] = (name, pos, gtid)
    return out


def random_log(seed, events=300):
    rnd = random.Random(seed)
    rows = []
    for i in range(events):
        kind = rnd.choice(["row", "row", "row", "gtid", "xid", "ddl", "rotate", "table_change"])
        rows.append({
            "server_id": rnd.choice([1, 2]), "file_no": i // 100, "event_seq": i % 100, "event_kind": kind,
            "action": "insert" if kind == "row" else None, "log_pos": rnd.choice([0, i + 1, i + 1]),
            "next_log": rnd.choice([None, "", f"bin.{i:06d}"]) if kind in ("rotate", "ddl", "xid") else rnd.choice([None, "no"]),
            "gtid": rnd.choice([None, "", f"u:{i}"]), "columns": ["a"], "pk_idx": [0], "rows": [["1"]]})
    return rows


@pytest.mark.parametrize("seed,span", [(1, 1_000_000), (2, 7), (3, 1), (4, 33)])
def test_carry_equals_fold(spark, seed, span):
    rows = random_log(seed)
    carried = N.carry_position(raw_of(spark, rows), span_events=span)
    got = {(r.server_id, r.file_no, r.event_seq): (r.log_name, r.next_pos, r.gtid_set) for r in carried.collect()}
    assert got == fold(rows)


def test_carry_goes_on_from_a_start(spark):
    rows = random_log(9, 400)
    first, second = [r for r in rows if r["file_no"] < 2], [r for r in rows if r["file_no"] >= 2]
    start = N.carried_ends(N.carry_position(raw_of(spark, first), span_events=10))
    carried = N.carry_position(raw_of(spark, second), start, span_events=10)
    got = {(r.server_id, r.file_no, r.event_seq): (r.log_name, r.next_pos, r.gtid_set) for r in carried.collect()}
    want = fold(rows)
    assert got == {k: v for k, v in want.items() if k[1] >= 2}


def test_no_window_over_a_whole_log(spark):
    plan = N.carry_position(raw_of(spark, random_log(1)))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_six_kinds(spark):
    rows = [
        {"event_kind": "rotate", "next_log": "bin.000001", "log_pos": 4},
        {"event_kind": "gtid", "gtid": "u:1", "log_pos": 10},
        {"event_kind": "ddl", "db": "shop", "table": "ignored", "query": "DROP TABLE x", "gtid": "u:2", "next_log": "bin.000001", "log_pos": 20},
        {"event_kind": "table_change", "db": "shop", "table": "t", "log_pos": 30},
        {"event_kind": "row", "action": "insert", "db": "shop", "table": "t", "columns": ["a", "id"], "pk_idx": [1],
         "rows": [["1", "2"]], "log_pos": 40},
        {"event_kind": "xid", "next_log": "bin.000001", "log_pos": 50},
        {"event_kind": "heartbeat", "log_pos": 60},
    ]
    got = [tuple(r) for r in N.normalise(raw_of(spark, rows)).orderBy("log_pos").select(
        "event_type", "log_name", "log_pos", "db", "table", "sql", "gtid_set", "primary", "before", "after").collect()]
    name = "bin.000001"
    assert got == [
        ("rotate", name, 4, "", "", "", "", [], {}, {}),
        ("gtid", name, 10, "", "", "", "u:1", [], {}, {}),
        ("ddl", name, 20, "shop", "", "DROP TABLE x", "u:2", [], {}, {}),
        ("table_change", name, 30, "shop", "t", "", "u:2", [], {}, {}),
        ("insert", name, 40, "shop", "t", "", "u:2", ["id"], {}, {"a": "1", "id": "2"}),
        ("xid", name, 50, "", "", "", "", [], {}, {}),
    ]


def test_events_with_several_rows(spark):
    rows = [
        {"event_kind": "row", "action": "insert", "columns": ["id"], "pk_idx": [0], "rows": [["1"], ["2"], ["3"]]},
        {"event_kind": "row", "action": "update", "columns": ["id", "v"], "pk_idx": [0], "rows": [["1", None], ["1", '"x"'], ["2", None], ["2", '"y"']]},
        {"event_kind": "row", "action": "delete", "columns": ["id"], "pk_idx": None, "rows": [["1"]]},
    ]
    got = [tuple(r) for r in N.row_images(raw_of(spark, rows)).orderBy("event_seq", "row_ordinal").select(
        "action", "row_ordinal", "before", "after").collect()]
    assert got == [
        ("insert", 0, {}, {"id": "1"}), ("insert", 1, {}, {"id": "2"}), ("insert", 2, {}, {"id": "3"}),
        ("update", 0, {"id": "1", "v": None}, {"id": "1", "v": '"x"'}),
        ("update", 1, {"id": "2", "v": None}, {"id": "2", "v": '"y"'}),
        ("delete", 0, {"id": "1"}, {})]


def test_fewer_values_than_columns(spark):
    df = spark.createDataFrame([(["a", "b"], ["1"])], "c array<string>, v array<string>")
    assert df.select(N.zip_fields(F.col("c"), F.col("v")).alias("m")).first().m == {"a": "1"}


def test_an_unknown_action_is_an_event_without_images(spark):
    row = {**random_log(1, 1)[0], "event_kind": "row", "action": "truncate"}
    [event] = N.normalise(raw_of(spark, [row])).collect()
    assert (event.event_type, event.before, event.after, event.row_ordinal) == ("truncate", {}, {}, 0)
