import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from changeflow.operators import docs as D

SCHEMA = ("server_id long, log_name string, log_pos long, row_ordinal long, action string, index string, id string, "
          "parent string, pipeline string, data map<string,string>")


def requests_of(spark, steps):
    return spark.createDataFrame(
        [(1, "b.1", pos, 0, action, "i", id_, "", "", data) for pos, (action, id_, data) in enumerate(steps)], SCHEMA)


def fold(steps, merge):
    """What an index does with the requests, one at a time."""
    index = {}
    for action, id_, data in steps:
        if action == "delete":
            index.pop(id_, None)
        elif action == "update" and merge:
            index[id_] = {**index.get(id_, {}), **data}
        else:
            index[id_] = dict(data)
    return {k: v for k, v in index.items() if k}


def result(docs):
    return {r.id: r.data for r in docs.collect()}


step = st.tuples(st.sampled_from(["create", "index", "update", "delete"]), st.sampled_from(["", "1", "2", "3"]),
                 st.dictionaries(st.sampled_from(["a", "b", "c"]), st.sampled_from(["1", '"x"', None]), max_size=3))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(step, min_size=1, max_size=25), st.integers(0, 99))
def test_docs_equal_a_fold(spark, steps, seed):
    requests = requests_of(spark, steps)
    assert result(D.merge_docs(requests)) == fold(steps, merge=True)
    assert result(D.current_docs(requests)) == fold(steps, merge=False)
    # In another order, and with repeats.
    rows = requests.collect()
    rows += random.Random(seed).sample(rows, len(rows) // 2)
    random.Random(seed).shuffle(rows)
    mixed = spark.createDataFrame(rows, SCHEMA)
    assert result(D.merge_docs(mixed)) == fold(steps, merge=True)
    assert result(D.current_docs(mixed)) == fold(steps, merge=False)


def test_one_hot_document(spark):
    steps = [("update", "1", {"a": str(i), f"f{i % 3}": str(i)}) for i in range(2000)] + [("create", "2", {})]
    requests = requests_of(spark, steps).repartition(8)
    assert result(D.merge_docs(requests)) == fold(steps, merge=True)
    assert result(D.current_docs(requests)) == fold(steps, merge=False)


def test_latest_keeps_requests_without_id(spark):
    requests = requests_of(spark, [("create", "", {"a": "1"}), ("create", "", {"a": "2"}), ("create", "1", {}), ("update", "1", {}),
                                   ("update", "2", {})])
    assert sorted((r.id, r.action, r.whole) for r in D.latest_requests(requests).collect()) == [
        ("1", "update", True), ("2", "update", False)]
    assert D.latest_requests(requests, addressed_only=False).count() == 4


DOCS = "index string, id string, data map<string,string>"


@pytest.fixture()
def stored(spark):
    return spark.createDataFrame([("i", "1", {"a": "1"}), ("i", "2", {"a": "2"}), ("j", "1", {"a": "3"})], DOCS)


def test_lookups(spark, stored):
    ids = spark.createDataFrame([("i", "1"), ("i", "9"), ("i", "1")], "index string, id string")
    got = sorted((r.id, r.found, r.data) for r in D.get_docs(stored, ids).collect())
    assert got == [("1", True, {"a": "1"}), ("1", True, {"a": "1"}), ("9", False, None)]
    assert sorted((r.id, r.found) for r in D.docs_exist(stored, ids).collect()) == [("1", True), ("9", False)]


def test_put_and_delete(spark, stored):
    new = spark.createDataFrame([("i", "2", {"b": "9"}), ("i", "3", {})], DOCS)
    put = sorted((r["index"], r.id, r.data) for r in D.put_docs(stored, new).collect())
    assert put == [("i", "1", {"a": "1"}), ("i", "2", {"b": "9"}), ("i", "3", {}), ("j", "1", {"a": "3"})]
    ids = spark.createDataFrame([("i", "1"), ("i", "1"), ("i", "7")], "index string, id string")
    assert sorted((r["index"], r.id) for r in D.delete_docs(stored, ids).collect()) == [("i", "2"), ("j", "1")]


def test_field_types(spark):
    docs = spark.createDataFrame([
        ("i", "1", {"n": "1", "s": '"x"', "mix": "true", "nil": None, "sometimes": None}),
        ("i", "2", {"n": "-2.5", "s": '"y"', "mix": '"z"', "nil": None, "sometimes": "[1]"})], DOCS)
    got = {r.field: (r.docs, r.type) for r in D.doc_fields(docs).collect()}
    assert got == {"n": (2, "number"), "s": (2, "string"), "mix": (2, "boolean|string"), "nil": (2, "null"),
                   "sometimes": (2, "object")}


def test_field_types_run_in_a_hash_aggregate(spark, stored):
    plan = D.doc_fields(stored)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
