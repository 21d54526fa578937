import json

import pytest
from pyspark.sql import functions as F

from catalog import views as V
from changeflow.operators import offsets as O
from changeflow.sources import kafka
from tests.helpers import changes_of

PARTS = "topic string, partition int, offset long"


@pytest.mark.parametrize("oldest,offset,want", [(True, 7, -2), (True, None, -2), (False, 7, 7), (False, 0, 0), (False, None, -1)])
def test_configured_offset(oldest, offset, want):
    assert O.configured_offset(oldest, offset) == want


def test_stored_offset_beats_all(spark):
    messages = spark.createDataFrame([("t", 0, 5), ("t", 0, 6), ("t", 3, 1), ("u", 1, 1)], PARTS)
    stored = spark.createDataFrame([("t", 3, 40), ("t", 9, 1)], PARTS)
    starts = O.starting_offsets(messages, stored, use_oldest=True)
    assert json.loads(O.starting_offsets_json(starts)) == {"t": {"0": -2, "3": 40}, "u": {"1": -2}}


def test_latest_and_resume(spark):
    messages = spark.createDataFrame([("t", p, o) for p in (0, 1) for o in range(5)], PARTS)
    stored = O.latest_offsets(messages.where("partition = 0 and offset < 3"))
    assert [tuple(r) for r in stored.collect()] == [("t", 0, 2)]
    again = O.resume_messages(messages, stored, default=4)
    assert sorted((r.partition, r.offset) for r in again.collect()) == [(0, 2), (0, 3), (0, 4), (1, 4)]
    after = O.resume_messages(messages, stored, default=4, inclusive=False)
    assert sorted((r.partition, r.offset) for r in after.collect()) == [(0, 3), (0, 4), (1, 4)]


def test_repeats_go_but_rows_of_one_event_stay(spark):
    rows = [{"log_pos": 1, "row_ordinal": 0}, {"log_pos": 1, "row_ordinal": 1}, {"log_pos": 1, "row_ordinal": 0}, {"log_pos": 2}]
    got = sorted((r.log_pos, r.row_ordinal) for r in O.dedup_changes(changes_of(spark, rows)).collect())
    assert got == [(1, 0), (1, 1), (2, 0)]


def test_order_of_a_hot_row(spark):
    rows = [{"log_pos": p, "log_name": f"b.{f}", "after": {"id": "1" if p % 3 else str(p)}} for f in (9, 10) for p in range(1000)]
    ordered = O.order_changes(changes_of(spark, rows).repartition(7, F.rand(1)), 4)
    # In partition order, as a reader of the written files would see it.
    got = ordered.withColumn("part", F.spark_partition_id()).collect()
    assert [r.part for r in got] == sorted(r.part for r in got)
    hot = [(int(r.log_name[2:]), r.log_pos) for r in got if r.after["id"] == "1"]
    assert hot == sorted(hot) and len(hot) == 1332
    assert len({r.part for r in got if r.after["id"] == "1"}) > 1, "a hot row is not kept in one task"


def test_kafka_options():
    assert kafka.write_options(["a:1", "b:2"], "t") == {"kafka.bootstrap.servers": "a:1,b:2", "topic": "t", "kafka.acks": "all"}
    assert kafka.read_options(["a:1"], "t") == {"kafka.bootstrap.servers": "a:1", "subscribe": "t", "startingOffsets": "latest"}
    assert kafka.read_options(["a:1"], "t", '{"t":{"0":5}}', 100)["maxOffsetsPerTrigger"] == "100"


def test_messages(spark):
    changes = changes_of(spark, [{"after": {"id": "1"}, "log_pos": 1}, {"after": {"id": '"x"'}, "log_pos": 2}])
    assert kafka.messages_of(changes).columns == ["value"]
    keyed = kafka.messages_of(changes, key="primary")
    assert sorted(r.key for r in keyed.collect()) == ["shop.t.1", "shop.t.x"]
    with pytest.raises(ValueError):
        kafka.messages_of(changes, key="other")
    empty = kafka.messages_of(changes, encoder=lambda df: df.withColumn("value", F.when(F.col("log_pos") == 2, "two")))
    assert [r.value for r in empty.collect()] == ["two"]


def test_a_stream_to_kafka_needs_a_checkpoint(spark):
    stream = spark.readStream.format("rate").load().selectExpr("cast(value as string) value")
    with pytest.raises(ValueError, match="checkpoint"):
        kafka.write_changes_kafka(stream, ["a:1"], "t", encoder=lambda df: df)


def test_order_is_proved_from_border_to_border(spark, sf_dir):
    events = V.orders(spark, sf_dir).limit(400).persist()
    total = lambda df: {c: sum(r[c] for r in O.order_breaks(df).collect()) for c in ("events", "breaks")}
    ordered = O.order_changes(events, 5)
    assert ordered.rdd.getNumPartitions() > 1 and total(ordered) == {"events": 400, "breaks": 0}
    # The borders alone are wrong: each partition is in order, but they do not follow each other.
    dealt = O.order_changes(events, 5).repartition(3, "log_pos").sortWithinPartitions("server_id", "db", "table", O.row_key(), "log_name", "log_pos", "row_ordinal")
    assert 1 <= total(dealt)["breaks"] <= 2 * 3
    assert total(events.orderBy(F.rand(7)))["breaks"] > 50
    assert total(events.where("false")) == {"events": 0, "breaks": 0}


def test_breaks_are_found_without_a_task_that_holds_a_partition(spark):
    places = [(9, 5, "a"), (9, 5, None), (10, 1, "a"), (10, 0, None), (9, 7, "b")]
    rows = [{"log_name": f"b.{f}", "log_pos": p, "db": db, "after": {"id": "1"}} for f, p, db in places] * 5000
    lying = changes_of(spark, rows).repartition(3, "log_pos").coalesce(1)
    want = [(r["db"] is not None, r["db"] or "", int(r["log_name"][2:]), r["log_pos"]) for r in lying.select("db", "log_name", "log_pos").collect()]
    result = O.order_breaks(lying)
    (got,) = result.collect()
    assert (got.events, got.breaks) == (25_000, sum(a > b for a, b in zip(want, want[1:]))) and got.breaks > 1000
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1, "only the borders are compared in a window"


def test_partitions_follow_the_input(spark):
    events = changes_of(spark, [{"log_pos": p} for p in range(90)])
    assert [O.partitions_for(events, 8), O.partitions_for(events, 8, events=10), O.partitions_for(events.where("false"))] == [8, 9, 1]
