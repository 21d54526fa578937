import json
import os
import random
import time

import pytest
from pyspark.sql import Row, functions as F

from catalog import views as V
from changeflow import schema as S
from changeflow.operators import docs as D, health as H, mapping as M, normalise as N, offsets as O, progress as G
from changeflow.operators.filters import changes_since
from changeflow.operators.sqllog import sql_log
from changeflow.plans import sync
from changeflow.functions.cells import cells_json
from changeflow.sources.bulk import send_bulk, send_settled, write_bulk
from changeflow.sources.files import read_changes_files, write_changes_files, write_sql_log
from changeflow.sources.codec import decode_changes, encode_changes
from changeflow.sources.tables import table_as_inserts
from changeflow.operators.bulk import batch_requests, bulk_bodies, bulk_errors
from changeflow.streaming import runner
from changeflow.streaming.health import Recheck, health_stream, run_alerts
from changeflow.streaming.state import Newest
from tests.helpers import changes_of

KEYS = ["event_type", "server_id", "log_name", "log_pos", "row_ordinal"]


@pytest.fixture(scope="module")
def log(spark, sf_dir, tmp_path_factory):
    """The log of ``orders`` as files."""
    path = str(tmp_path_factory.mktemp("log"))
    write_changes_files(V.orders(spark, sf_dir), path, "overwrite")
    return path


def stream(spark, path):
    return read_changes_files(spark, path, stream=True, max_files_per_trigger=1)


def finish(query):
    query.awaitTermination(240)
    assert not query.isActive
    return query


def rows(df, columns=KEYS):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_handler_gets_every_event_once(spark, log, tmp_path):
    out = str(tmp_path / "out")
    finish(runner.run(stream(spark, log), lambda b, i: b.write.mode("overwrite").parquet(f"{out}/b={i}"),
                      str(tmp_path / "cp"), available_now=True))
    assert len(os.listdir(out)) > 1
    assert rows(spark.read.parquet(out)) == rows(read_changes_files(spark, log))


def test_failed_batch_is_handed_over_again(spark, log, tmp_path):
    out, cp, closed = str(tmp_path / "out"), str(tmp_path / "cp"), []

    def fails_once(batch, batch_id):
        if batch_id == 1 and not os.path.exists(f"{out}/failed"):
            open(f"{out}/failed", "w").close()
            raise RuntimeError("handler gave up")
        batch.write.mode("overwrite").parquet(f"{out}/b={batch_id}")

    [query] = runner.notify_close(spark, lambda: runner.run(stream(spark, log), fails_once, cp, available_now=True), closed.append)
    with pytest.raises(Exception, match="handler gave up"):
        query.awaitTermination(240)
    for _ in range(200):
        if closed:
            break
        time.sleep(0.1)
    finish(runner.run(stream(spark, log), fails_once, cp, available_now=True))
    got = spark.read.option("basePath", out).parquet(*[f"{out}/{d}" for d in os.listdir(out) if d.startswith("b=")])
    assert rows(got) == rows(read_changes_files(spark, log))
    assert len(closed) == 1 and "handler gave up" in closed[0]


def test_single_events_are_handled_in_the_tasks(spark, log, tmp_path):
    seen = str(tmp_path / "seen")
    os.mkdir(seen)

    def touch(row):
        open(f"{seen}/{row.server_id}-{row.log_name}-{row.log_pos}", "w").close()

    finish(runner.run(stream(spark, log), runner.per_event(touch), str(tmp_path / "cp"), available_now=True))
    assert len(os.listdir(seen)) == read_changes_files(spark, log).count()


def test_sql_log_of_a_stream(spark, log, tmp_path):
    out = str(tmp_path / "sql")
    query = sync.trace(stream(spark, log), out, str(tmp_path / "cp"), show_tx=True)
    query.processAllAvailable()
    query.stop()
    want = sql_log(read_changes_files(spark, log), show_tx=True)
    assert sorted(r.value for r in spark.read.text(out).collect()) == sorted(r.line for r in want.collect())


def test_sql_log_of_a_batch(spark, log, tmp_path):
    lines = sql_log(read_changes_files(spark, log).where("event_type = 'ddl'"))
    write_sql_log(lines, str(tmp_path / "sql"))
    assert spark.read.text(str(tmp_path / "sql")).count() == lines.count() == 2
    with pytest.raises(ValueError):
        write_sql_log(sql_log(stream(spark, log)), str(tmp_path / "x"))


def test_messages_as_text_files(spark, log, tmp_path):
    encode_changes(read_changes_files(spark, log)).select("value").write.text(str(tmp_path / "m"))
    again = read_changes_files(spark, str(tmp_path / "m"), file_format="json")
    assert rows(again.where("malformed is null")) == rows(read_changes_files(spark, log))
    with pytest.raises(ValueError):
        read_changes_files(spark, log, file_format="csv")


def test_repeats_on_a_stream(spark, log, tmp_path):
    twice = str(tmp_path / "twice")
    both = read_changes_files(spark, log)
    write_changes_files(both.unionByName(both.where("log_pos % 3 = 0")), twice)
    query = (O.dedup_stream(stream(spark, twice), "10 minutes").drop("arrived_at").writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out")))
    finish(query)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(both)


def test_progress_of_a_stream(spark, log, tmp_path):
    path = str(tmp_path / "saved")
    finish(runner.save_progress(stream(spark, log), path, str(tmp_path / "cp"), available_now=True))
    saved = runner.saved_positions(spark, path)
    newest = G.progress(read_changes_files(spark, log)).groupBy("server_id").agg(
        F.max_by(F.struct("log_name", "log_pos"), "saved_at").alias("p")).select("server_id", "p.*")
    columns = ["server_id", "log_name", "log_pos"]
    assert rows(saved.read(), columns) == rows(newest, columns)
    # The positions saved here are what a restart begins after.
    assert changes_since(read_changes_files(spark, log), saved.read()).where(S.is_row_event()).count() == 0


def test_offsets_move_only_with_the_handler(spark, sf_dir, tmp_path):
    path, offsets, cp = str(tmp_path / "topic"), str(tmp_path / "offsets"), str(tmp_path / "cp")
    messages = V.messages(spark, sf_dir)
    # One file per topic partition, the last one makes the handler fail.
    for part in (0, 1, 2):
        messages.where(F.col("partition") == part).coalesce(1).write.parquet(f"{path}/{part}")

    def source():
        return (spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1)
                .option("recursiveFileLookup", "true").parquet(path))

    def refuses(batch, batch_id):
        if batch_id == 2:
            raise RuntimeError("not now")

    query = runner.handle_messages(source(), refuses, offsets, cp, available_now=True)
    with pytest.raises(Exception, match="not now"):
        query.awaitTermination(240)
    stored = runner.stored_offsets(spark, offsets)
    assert stored.read().count() == 2
    left = O.resume_messages(messages, stored.read(), inclusive=False)
    assert left.select("partition").distinct().count() == 1
    finish(runner.handle_messages(source(), lambda b, i: None, offsets, cp, available_now=True))
    columns = ["topic", "partition", "offset"]
    assert rows(stored.read(), columns) == rows(O.latest_offsets(messages), columns)


def test_newest_rows_of_two_turns(spark, tmp_path):
    table = Newest(spark, str(tmp_path / "t"), "k long, v string, n long", ["k"], "n")
    assert table.read().count() == 0 and table.before(0).count() == 0
    put = lambda rows, n: table.put(spark.createDataFrame([(*r, n) for r in rows], "k long, v string, n long"), n)
    put([(1, "a"), (2, "a")], 0)
    put([(1, "b")], 1)
    put([(1, "c")], 2)
    put([(1, "c"), (3, "c")], 2)  # a repeat
    assert rows(table.read(), ["k", "v"]) == [(1, "c"), (2, "a"), (3, "c")]
    assert rows(table.before(2), ["k", "v"]) == [(1, "b"), (2, "a")]
    for n in range(3, 30):
        put([(n % 5, str(n))], n)
    assert len(table.read().inputFiles()) == 2
    assert rows(table.read(), ["k", "v"]) == [(k, str(25 + k)) for k in range(5)]


# ------------------------------------------------------------------------ bulk


def accepts(body):
    return 200, '{"took":1,"errors":false,"items":[]}'


def test_bulk_files(spark, log, tmp_path):
    requests = M.to_requests(read_changes_files(spark, log), M.rules_frame(spark, V.RULES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_bulk(requests, str(tmp_path / "bulk"), 100, bodies_per_file=20)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(f for f in os.listdir(tmp_path / "bulk") if f.endswith(".txt"))
    assert len({f[:10] for f in files}) > 1
    text = "".join(open(tmp_path / "bulk" / f).read() for f in files)
    bodies = bulk_bodies(batch_requests(requests, 100))
    assert sorted(text.splitlines()) == sorted(line for r in bodies.collect() for line in r.body.splitlines())
    # Posted file by file, the documents end as they should.
    held, lines = {}, iter(text.splitlines())
    for line in lines:
        [(action, place)] = json.loads(line).items()
        key = (place["_index"], place["_id"])
        if action == "delete":
            held.pop(key, None)
        else:
            held[key] = json.loads(next(lines))
    want = {(r["index"], r.id): json.loads(r.data) for r in D.current_docs(requests).select("index", "id", cells_json(F.col("data")).alias("data")).collect()}
    assert held == want


def test_nothing_is_dropped(spark, sf_dir, tmp_path):
    """Events that share a position, or have none, stay apart; sinks and senders get every row."""
    customers = V.table(spark, sf_dir, "customer")
    n = customers.count()
    inserts = table_as_inserts(customers, ["c_custkey"], "shop", "customer")
    assert O.dedup_changes(inserts).count() == n
    assert inserts.select("log_pos").distinct().count() == n
    assert table_as_inserts(customers, [], "shop", "customer", blocks=5).selectExpr(f"log_pos div {64 << 20} b").distinct().count() == 5

    rows_ = [{"row_ordinal": i, "log_pos": 9} for i in range(3)] + [{"row_ordinal": i, "log_pos": 9, "table": "u"} for i in range(2)]
    sent = encode_changes(changes_of(spark, rows_)).select("value")
    assert O.dedup_changes(decode_changes(sent.union(sent))).count() == 5
    dropped = [{"event_type": t, "table": x, "log_pos": 4} for t, x in (("table_change", "a"), ("table_change", "b"), ("ddl", ""), ("rotate", ""))]
    assert O.dedup_changes(changes_of(spark, dropped + dropped)).count() == 4
    assert O.dedup_changes(changes_of(spark, [{"log_name": "", "log_pos": 0}] * 5)).count() == 5

    bare = M.to_requests(table_as_inserts(customers, [], "shop", "customer"), M.rules_frame(spark, [M.Rule("shop", "customer", id_field="none")]), skip_no_pk=False)
    assert sync.settled_requests(bare).count() == n

    lines = spark.range(100).selectExpr("cast(id as string) line")
    write_sql_log(lines, str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).count() == 100

    answers = spark.createDataFrame([(200, '{"took":3,"items":[{"in'), (200, "<html>"), (200, accepts("")[1]), (503, "")], "code int, body string")
    assert sorted(r.message for r in bulk_errors(answers).collect()) == [
        " index: , type: , id: , status: 200, error: unreadable bulk response with status 200"] * 2 + [
        " index: , type: , id: , status: 503, error: bulk request failed with status 503"]

    nameless = changes_of(spark, [{"log_name": "", "log_pos": 1}])
    write_changes_files(nameless, str(tmp_path / "log"))
    assert read_changes_files(spark, str(tmp_path / "log")).first().log_name == ""


def test_a_lagging_server_loses_nothing(spark, tmp_path):
    late = [{"server_id": s, "log_pos": p, "timestamp": 1_700_000_000 + t} for s, p, t in ((1, 1, 90_000), (2, 1, 100), (1, 2, 200_000), (2, 2, 200), (2, 2, 200))]
    for i, r in enumerate(late):
        changes_of(spark, [r]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / str(i)))
    source = (spark.readStream.schema(S.CHANGE_SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")))
    finish(O.dedup_stream(source, "10 minutes").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
           .trigger(availableNow=True).start(str(tmp_path / "out")))
    assert rows(spark.read.parquet(str(tmp_path / "out")), ["server_id", "log_pos"]) == [(1, 1), (1, 2), (2, 1), (2, 2)]


def test_changes_of_a_row_are_in_one_task(spark, log):
    dealt = O.order_changes(read_changes_files(spark, log).where(S.is_row_event()), 8, whole_rows=True).withColumn("task", F.spark_partition_id())
    keyed = dealt.select("server_id", "table", O.row_key().alias("key"), "task")
    assert keyed.groupBy("server_id", "table", "key").agg(F.countDistinct("task").alias("n")).where("n > 1").isEmpty()


def test_settled_requests_fill_their_bodies(spark, log):
    requests = M.to_requests(read_changes_files(spark, log), M.rules_frame(spark, V.RULES))
    sent = send_settled(sync.settled_requests(requests), accepts, 100)
    sizes = [r.requests for r in sent.collect()]
    assert sum(sizes) == D.latest_requests(requests, addressed_only=False).count()
    assert sum(s < 100 for s in sizes) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_live_health_is_linear(spark):
    recheck = Recheck(5)

    class Held:
        def __init__(self):
            self.value = None

        exists = lambda self: self.value is not None
        get = lambda self: self.value
        put = update = lambda self, value: setattr(self, "value", value)
        clear = lambda self: setattr(self, "value", None)

    class Handle:
        listTimers = lambda self: []
        registerTimer = lambda self, ms: None

    recheck.handle, recheck.last, recheck.held, recheck.waiting = Handle(), Held(), Held(), Held()
    sample = Row("us", "file_seq", "file_pos", "db_seq", "db_pos", "db_error", "arrived")
    start = time.time()
    out = list(recheck.handleInputRows((1,), [sample(i * 1_000_000, 1, i // 50, 1, i, "", 0) for i in range(100_000)], None))
    assert time.time() - start < 30 and len(out) > 99_980


def test_sending(spark, log, tmp_path):
    requests = M.to_requests(read_changes_files(spark, log), M.rules_frame(spark, V.RULES))
    sent = str(tmp_path / "sent")
    os.mkdir(sent)

    def keep(body):
        import uuid
        with open(f"{sent}/{uuid.uuid4()}", "w") as f:
            f.write(body)
        return accepts(body)

    sync.send_requests(requests, keep, 50)
    text = "".join(open(f"{sent}/{f}").read() for f in os.listdir(sent))
    puts, gone = text.count('{"index":'), text.count('{"delete":')
    assert (puts, gone) == (D.current_docs(requests).count(), D.latest_requests(requests).where("action = 'delete'").count())

    def refuse(body):
        return 200, '{"took":1,"errors":true,"items":[{"index":{"_index":"i","_type":"t","_id":"5","status":400,"error":"bad"}}]}'

    with pytest.raises(sync.BulkFailed, match="error: bad"):
        sync.send_requests(requests, refuse, 50)
    answers = send_bulk(bulk_bodies(batch_requests(requests, 50)), lambda body: (503, ""))
    assert bulk_errors(answers, body="response").count() == answers.count()


def test_only_updates_stay_an_update(spark):
    rows = [{"event_type": "update", "before": {"id": "1"}, "after": {"id": "1", "v": "2"}, "log_pos": 1},
            {"event_type": "insert", "after": {"id": "2"}, "log_pos": 2},
            {"event_type": "update", "before": {"id": "2"}, "after": {"id": "2", "v": "2"}, "log_pos": 3},
            {"event_type": "insert", "after": {"id": "3"}, "log_pos": 4},
            {"event_type": "delete", "before": {"id": "3"}, "log_pos": 5}]
    requests = sync.search_requests(changes_of(spark, rows), [M.Rule("shop", "t")])
    got = sorted((r.id, r.action, r.data.get("v")) for r in sync.settled_requests(requests).collect())
    assert got == [("1", "update", "2"), ("2", "index", "2"), ("3", "delete", None)]
    with pytest.raises(ValueError):
        sync.search_requests(changes_of(spark, rows), [M.Rule("shop", "t")], skip_no_pk=False)


def test_index_kept_in_step_with_a_stream(spark, log, tmp_path):
    sent = str(tmp_path / "sent")
    os.mkdir(sent)

    def keep(body):
        import uuid
        with open(f"{sent}/{uuid.uuid4()}", "w") as f:
            f.write(body)
        return accepts(body)

    query = sync.search_sync(stream(spark, log), V.RULES, keep, str(tmp_path / "cp"), available_now=True)
    finish(query)
    assert os.listdir(sent)
    broken = sync.search_sync(stream(spark, log), V.RULES, lambda body: (503, ""), str(tmp_path / "cp2"), available_now=True)
    with pytest.raises(Exception, match="refused"):
        broken.awaitTermination(240)


# ---------------------------------------------------------------------- health


@pytest.fixture(scope="module")
def samples(spark, tmp_path_factory):
    """Random samples of two servers, as files in the order of time."""
    from tests.test_health import random_samples, samples_of
    path = str(tmp_path_factory.mktemp("samples"))
    all_rows = sorted(random_samples(11, 400), key=lambda r: r[1])
    for i in range(4):
        part = [r for r in all_rows if i * len(all_rows) // 4 <= all_rows.index(r) < (i + 1) * len(all_rows) // 4]
        samples_of(spark, part).coalesce(1).write.mode("append").parquet(f"{path}/{i}")
    return path


def sample_stream(spark, path):
    return (spark.readStream.schema(S.SAMPLE_SCHEMA).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(path))


def batch_samples(spark, path):
    return spark.read.schema(S.SAMPLE_SCHEMA).option("recursiveFileLookup", "true").parquet(path)


def test_health_of_a_stream(spark, samples, tmp_path):
    judged = health_stream(sample_stream(spark, samples), delay="10 days")
    query = (judged.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(availableNow=True).start(str(tmp_path / "out")))
    finish(query)
    columns = ["server_id", "ts", "status", "reasons"]
    got, want = rows(spark.read.parquet(str(tmp_path / "out")), columns), rows(H.health(batch_samples(spark, samples)), columns)
    # Only a server's last samples may still wait for the end of their grace period.
    last = {server: max(w for w in want if f"server_id={server}," in str(w) or w[0] == server) for server in {w[0] for w in want}}
    missing = [w for w in want if w not in got]
    assert all(w in want for w in got) and len(got) + len(missing) == len(want)
    assert all((last[w[0]][1] - w[1]).total_seconds() <= H.GRACE_SECONDS for w in missing)


def test_late_samples_come_out(spark, tmp_path):
    """Samples in any order over many micro-batches: each comes out once. What waited long enough has the verdict of the batch, what came
    after a newer one was judged is marked."""
    from tests.test_health import random_samples, samples_of
    rnd = random.Random(5)
    every = sorted(random_samples(17, 160), key=lambda r: r[1])
    near = sorted(range(len(every)), key=lambda i: i + rnd.randint(0, 12))  # each is moved by some places
    far = [near.pop(0) for _ in range(3)]
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    order = near + far
    for k in range(5):
        samples_of(spark, [every[i] for i in order[k * len(order) // 5:(k + 1) * len(order) // 5]]).coalesce(1).write.parquet(f"{path}/{k}")
    judged = health_stream(sample_stream(spark, path), delay="1 second", wait_seconds=(every[-1][1] - every[0][1]) / 5)
    query = judged.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).start(out)
    query.processAllAvailable()
    time.sleep(2.5)
    # Another server's sample, later by the clock, lets nothing wait any longer.
    other = samples_of(spark, [(99, *every[-1][1:])])
    for k in (5, 6):
        other.coalesce(1).write.parquet(f"{path}/{k}")
        query.processAllAvailable()
        time.sleep(2.5)
    query.stop()
    got = spark.read.parquet(out).where("server_id <> 99")
    key = ["server_id", "ts", "file_seq", "file_pos", "db_seq", "db_pos"]
    assert rows(got, key) == rows(samples_of(spark, every), key)
    late = got.where("late")
    assert 0 < late.count() <= 10 and late.where("level is not null").count() == 0
    in_time = got.where("not late")
    kept = in_time.select(*key, "db_error")
    assert rows(in_time, [*key, "status", "reasons"]) == rows(H.health(kept), [*key, "status", "reasons"])


def test_alerts_of_a_stream(spark, samples, tmp_path):
    out = str(tmp_path / "out")

    def on_alert(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/b={batch_id}")

    finish(run_alerts(sample_stream(spark, samples), on_alert, str(tmp_path / "cp"), delay="10 days", available_now=True))
    columns = ["server_id", "ts", "status", "last_status"]
    got = rows(spark.read.parquet(out), columns)
    want = rows(H.alerts(H.health(batch_samples(spark, samples))), columns)
    assert got == [w for w in want if w in got] and len(want) - len(got) <= 4 and len(got) > 20


def test_bulk_files_of_a_stream(spark, log, tmp_path):
    query = sync.search_files(stream(spark, log), V.RULES, str(tmp_path / "bulk"), checkpoint=str(tmp_path / "cp"), seconds=1)
    query.processAllAvailable()
    query.stop()
    lines = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "bulk"))
    requests = M.to_requests(read_changes_files(spark, log), M.rules_frame(spark, V.RULES))
    want = M.bulk_lines(requests).select(F.explode(F.split("line", "\n")).alias("line"))
    assert sorted(r.value for r in lines.collect()) == sorted(r.line for r in want.collect())


def test_one_handler_for_events_alerts_and_the_end(spark, log, samples, tmp_path):
    seen, closed = str(tmp_path / "seen"), []
    os.mkdir(seen)

    def touch(row):
        open(f"{seen}/{row.server_id}-{row.log_name}-{row.log_pos}", "w").close()

    def fails(batch, batch_id):
        raise RuntimeError("no alerts wanted")

    queries = sync.start(stream(spark, log), sample_stream(spark, samples), touch, fails, closed.append, str(tmp_path / "cp"), delay="10 days", seconds=0)
    for _ in range(600):
        if closed:
            break
        time.sleep(0.1)
    assert not any(q.isActive for q in queries) and len(closed) == 1 and "no alerts wanted" in closed[0]


def test_a_file_that_moves_in_the_grace_period_is_green(spark):
    start = 1_700_000_000
    db = spark.createDataFrame([(1, start + 10 * i, 1, 500, "") for i in range(4)], "server_id long, t long, db_seq long, db_pos long, db_error string")
    db = db.withColumn("ts", F.timestamp_seconds("t")).drop("t")
    saves = [(1, start, "b.000001", 100), (1, start + 13, "b.000001", 200)]  # stuck at the check after 10 seconds, moved 3 seconds later
    saved = spark.createDataFrame(saves, "server_id long, saved_at long, log_name string, log_pos long")
    judged = H.health(H.position_samples(saved, db), saved=saved).orderBy("ts").collect()
    assert [r.status for r in judged] == ["red", "green", "green", "red"]
