import pytest
from pyspark.sql import functions as F

from changeflow.operators import bulk as B, mapping as M
from changeflow.operators.mapping import Rule, rules_frame
from tests.helpers import changes_of, one


def requests_of(spark, rows, rule, **how):
    return M.to_requests(changes_of(spark, rows), rules_frame(spark, [rule]), **how)


def test_rules_need_an_id_unless_tables_without_key_are_skipped():
    M.check_rules([Rule("a", "b")], skip_no_pk=True)
    M.check_rules([Rule("a", "b", id_field="id")], skip_no_pk=False)
    with pytest.raises(ValueError, match="a.b"):
        M.check_rules([Rule("a", "b")], skip_no_pk=False)


@pytest.mark.parametrize("row,rule,want", [
    ({"after": {"id": "7"}}, Rule("shop", "t"), "7"),
    ({"after": {"id": '"x y"'}}, Rule("shop", "t"), "x y"),
    ({"event_type": "delete", "before": {"id": "7"}}, Rule("shop", "t"), "7"),
    ({"primary": ["b", "a"], "after": {"a": "1", "b": '"z"'}}, Rule("shop", "t"), "z:1"),
    ({"primary": ["b", "a"], "after": {"a": "1", "b": None}}, Rule("shop", "t"), ""),
    ({"after": {"id": "7", "name": '"n"'}}, Rule("shop", "t", id_field="name"), "n"),
    ({"after": {"id": "7"}}, Rule("shop", "t", id_field="name"), ""),
    ({"after": {"id": "7", "name": None}}, Rule("shop", "t", id_field="name"), ""),
])
def test_ids(spark, row, rule, want):
    assert one(requests_of(spark, [row], rule)).id == want


def test_tables_without_key(spark):
    row = {"primary": [], "after": {"id": "7"}}
    assert requests_of(spark, [row], Rule("shop", "t", id_field="id")).count() == 0
    assert one(requests_of(spark, [row], Rule("shop", "t", id_field="id"), skip_no_pk=False)).id == "7"
    assert one(requests_of(spark, [row], Rule("shop", "t"), skip_no_pk=False)).id == ""


def test_names_of_rules_compare_exactly(spark):
    assert requests_of(spark, [{"after": {"id": "1"}}], Rule("Shop", "t")).count() == 0


def test_actions(spark):
    rows = [{"event_type": t, "before": {"id": "1"}, "after": {} if t == "delete" else {"id": "1"}, "log_pos": i}
            for i, t in enumerate(["insert", "update", "delete", "ddl", "table_change"])]
    plain = requests_of(spark, rows, Rule("shop", "t")).orderBy("log_pos").collect()
    assert [r.action for r in plain] == ["create", "update", "delete"]
    mapped = requests_of(spark, rows, Rule("shop", "t", actions={"insert": "index", "delete": "update"})).orderBy("log_pos")
    assert [r.action for r in mapped.collect()] == ["index", "update", "update"]


def test_filter_sees_new_names(spark):
    rule = Rule("shop", "t", field_mapping={"title": "my_title"}, filter=["my_title"])
    got = one(requests_of(spark, [{"after": {"id": "1", "title": '"x"'}}], rule))
    assert got.data == {"my_title": '"x"'}
    rule = Rule("shop", "t", field_mapping={"title": "my_title"}, filter=["title"])
    assert one(requests_of(spark, [{"after": {"id": "1", "title": '"x"'}}], rule)).data == {}


def test_moved_key(spark):
    rows = [{"event_type": "update", "before": {"id": "1"}, "after": {"id": "2"}},
            {"event_type": "update", "before": {"id": "3", "v": "1"}, "after": {"id": "3", "v": "2"}}]
    kept = requests_of(spark, rows, Rule("shop", "t"))
    assert sorted((r.action, r.id) for r in kept.collect()) == [("update", "2"), ("update", "3")]
    moved = requests_of(spark, rows, Rule("shop", "t"), move_keys=True)
    assert moved.columns == list(M.REQUEST_COLUMNS)
    assert sorted((r.action, r.id) for r in moved.collect()) == [("delete", "1"), ("update", "2"), ("update", "3")]


def lines(spark, rows):
    df = spark.createDataFrame(rows, "action string, index string, id string, parent string, pipeline string, data map<string,string>")
    cols = [F.col(c) for c in df.columns]
    return [r.line for r in df.select(M.bulk_line(*cols).alias("line")).collect()]


def test_bulk_shapes(spark):
    got = lines(spark, [
        ("create", "test2", "03", "", "", {"name": '"name3"', "id": "3", "text": '"qqq"'}),
        ("update", "test2", "02", "", "", {"name": '"n"'}),
        ("delete", "test2", "02", "p", "clean", {"name": '"n"'}),
        ("index", "", "", "", "", {})])
    assert got == [
        '{"create":{"_id":"03","_index":"test2"}}\n{"id":3,"name":"name3","text":"qqq"}',
        '{"update":{"_id":"02","_index":"test2"}}\n{"doc":{"name":"n"}}',
        '{"delete":{"_id":"02","_index":"test2","_parent":"p","pipeline":"clean"}}',
        '{"index":{}}\n{}']


def test_index_of_a_request_wins(spark):
    rows = [{"after": {"id": "1"}, "table": "t"}, {"after": {"id": "2"}, "table": "u"}]
    requests = M.to_requests(changes_of(spark, rows), rules_frame(spark, [Rule("shop", "t"), Rule("shop", "u", index="")]))
    assert sorted((r.id, r["index"]) for r in M.index_requests(requests, "all").collect()) == [("1", "t"), ("2", "all")]


def test_default_rules_work_as_rules(spark):
    changes = changes_of(spark, [{"after": {"id": "1"}}, {"event_type": "ddl"}])
    got = one(M.to_requests(changes, M.default_rules(changes)))
    assert (got["index"], got.id, got.data) == ("t", "1", {"id": "1"})


def many_requests(spark, n, same_id=False):
    rows = [{"log_pos": i * 10, "after": {"id": "1" if same_id else str(i)}} for i in range(n)]
    return requests_of(spark, rows, Rule("shop", "t"))


def test_batches_are_bounded_and_in_order(spark):
    batched = B.batch_requests(many_requests(spark, 500, same_id=True), 16, span=B.log_block(1000)).collect()
    groups = {}
    for r in batched:
        groups.setdefault(tuple(r.batch), []).append((r.seq, r.log_pos))
    assert sum(map(len, groups.values())) == 500
    assert len({key[0] for key in groups}) == 1, "a document has one shard"
    for members in groups.values():
        assert len(members) <= 16
        assert sorted(members) == sorted(members, key=lambda m: m[1])
        assert [s for s, _ in sorted(members)] == list(range(len(members)))
    in_order = [p for key in sorted(groups) for _, p in sorted(groups[key])]
    assert in_order == sorted(in_order), "batches of a document follow the log"


def test_requests_without_id_are_spread(spark):
    rows = [{"log_pos": i, "primary": [], "after": {"id": str(i)}} for i in range(300)]
    batched = B.batch_requests(requests_of(spark, rows, Rule("shop", "t"), skip_no_pk=False))
    assert batched.select("batch.shard").distinct().count() > 30


def test_sizes_and_intervals():
    assert [B.bulk_size_or_default(n) for n in (-1, 0, 1, 500)] == [128, 128, 1, 500]
    assert [B.flush_seconds_or_default(s) for s in (0, 0.5, 1, 10)] == [3, 3, 1, 10]


def test_flush_by_time_then_size(spark):
    rows = [{"log_pos": i, "timestamp": i, "after": {"id": "1"}} for i in range(12)]
    timed = B.batch_by_time(requests_of(spark, rows, Rule("shop", "t")), 3)
    batched = B.batch_requests(timed, 2, span=[F.col("flush_at"), *B.log_block()])
    sizes = batched.groupBy("batch").count().collect()
    assert len(sizes) == 8 and all(r["count"] <= 2 for r in sizes)


def test_bodies_need_no_second_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        bodies = B.bulk_bodies(B.batch_requests(many_requests(spark, 100), 10))
        plan = bodies._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    got = bodies.collect()
    assert sum(r.requests for r in got) == 100
    assert all(r.body.endswith("}\n") and r.body.count("\n") == 2 * r.requests for r in got)


def test_errors_of_responses(spark):
    ok = '{"took":1,"errors":false,"items":[{"create":{"_index":"i","_id":"1","status":201}}]}'
    bad = ('{"took":1,"errors":true,"items":[{"create":{"_index":"i","_type":"_doc","_id":"1","status":409,"error":{"type":"x"}}},'
           '{"update":{"_index":"i","_id":"2","status":200}}]}')
    df = spark.createDataFrame([(1, 200, ok), (2, 200, bad), (3, 503, ok), (4, 500, bad), (5, 502, "<html>"), (6, 503, None)],
                               "n int, code int, body string")
    got = [(r.n, r.status, r.message) for r in B.bulk_errors(df).orderBy("n").collect()]
    item = 'create index: i, type: _doc, id: 1, status: 409, error: {"type":"x"}'
    whole = " index: , type: , id: , status: {0}, error: bulk request failed with status {0}"
    assert got == [(2, 409, item), (3, 503, whole.format(503)), (4, 409, item), (5, 502, whole.format(502)), (6, 503, whole.format(503))]
