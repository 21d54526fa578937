"""Streams with state: documents, and raw events to change events, next to their batch forms."""

import glob
import os
import random
import time

import pytest
from pyspark.sql import Window, functions as F

from catalog import views as V
from changeflow.operators import docs as D, mapping as M, normalise as N
from changeflow.sources.files import read_changes_files, write_changes_files
from changeflow.streaming import runner
from changeflow.streaming.docs import follow_requests, read_docs
from changeflow.streaming.normalise import normalise_stream

KEYS = ["event_type", "server_id", "log_name", "log_pos", "row_ordinal", "gtid_set", "sql", "db", "table"]
REQUESTS = ("server_id long, log_name string, log_pos long, row_ordinal long, timestamp long, action string, index string, id string, parent string, "
            "pipeline string, data map<string,string>")


@pytest.fixture(autouse=True)
def one_partition(spark):
    """Small streams need few tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def finish(query):
    query.awaitTermination(400)
    assert not query.isActive


def docs(df):
    return sorted((r["index"], r.id, sorted(r.data.items(), key=str), tuple(r.version)) for r in df.collect())


def rows(df, columns=KEYS):
    return sorted(map(str, df.select(*columns, F.to_json("before"), F.to_json("after")).collect()))


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


def test_documents_follow_a_stream(spark, sf_dir, tmp_path):
    log, cp = str(tmp_path / "log"), str(tmp_path / "cp")
    write_changes_files(V.orders(spark, sf_dir), log)
    rules = M.rules_frame(spark, V.RULES)
    told = []
    finish(follow_requests(M.to_requests(read_changes_files(spark, log, stream=True, max_files_per_trigger=2), rules), cp,
                           lambda b, i: told.append(b.count()), available_now=True))
    want = docs(D.current_docs(M.to_requests(read_changes_files(spark, log), rules)))
    assert docs(read_docs(spark, cp)) == want and len(told) > 1 and sum(told) >= len(want)


def random_requests(rnd, n):
    """Requests on a few documents, with deletions, whole puts, partial updates and NULL cells, each at a place of its own."""
    out = []
    for k in range(n):
        action = rnd.choice(["create", "index", "update", "update", "update", "delete"])
        cells = {} if action == "delete" else {f: rnd.choice([None, f'"{k}"']) for f in rnd.sample("abcde", rnd.randint(0, 4))}
        out.append((rnd.choice([1, 1, 2]), f"bin.{9 + k // 40:06d}", rnd.choice([k % 40, k % 40, None]) if k % 17 else None, k, k, action, rnd.choice("xy"), rnd.choice(["1", "2", "3", "4", ""]), "", "", cells))
    return out


@pytest.mark.parametrize("merge", [False, True])
def test_late_and_repeated_requests_in_any_order(spark, tmp_path, merge):
    rnd = random.Random(11)
    requests = random_requests(rnd, 160)
    path, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    want = docs((D.merge_docs if merge else D.current_docs)(spark.createDataFrame(requests, REQUESTS)))
    shuffled = requests + rnd.sample(requests, 40)
    rnd.shuffle(shuffled)
    for part in range(4):  # half the micro-batches, a restart, the rest
        spark.createDataFrame(shuffled[part::4], REQUESTS).coalesce(1).write.parquet(f"{path}/{part}")
        if part in (1, 3):
            finish(follow_requests(stream_of(spark, path, REQUESTS), cp, merge=merge, available_now=True))
    assert docs(read_docs(spark, cp, merge)) == want and want


def test_changed_documents_are_told_once(spark, tmp_path):
    path, cp, told = str(tmp_path / "in"), str(tmp_path / "cp"), []
    at = lambda n, action, cells: (1, "bin.000001", n, 0, 0, action, "x", "1", "", "", cells)
    for n, part in enumerate([[at(5, "create", {"a": "1", "b": "2"})], [at(9, "update", {"b": None}), at(5, "create", {"a": "1", "b": "2"})], [at(7, "update", {"b": "3"})], [at(11, "delete", {}), at(10, "update", {"c": "4"})], [at(3, "create", {"z": "0"})]]):
        spark.createDataFrame(part, REQUESTS).coalesce(1).write.parquet(f"{path}/{n}")
        finish(follow_requests(stream_of(spark, path, REQUESTS), cp, lambda b, i: told.extend((r.action, dict(r.data), r.version.log_pos) for r in b.collect()),
                               merge=True, available_now=True))
    assert told == [("create", {"a": "1", "b": "2"}, 5), ("update", {"a": "1", "b": None}, 9), ("delete", {}, 11)]
    assert read_docs(spark, cp, merge=True).count() == 0


def test_a_query_that_forgets(spark, tmp_path):
    path, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    gone = (1, "bin.000001", 9, 0, 0, "delete", "x", "1", "", "", {})
    old = (1, "bin.000001", 5, 0, 0, "create", "x", "1", "", "", {"a": "1"})
    spark.createDataFrame([gone], REQUESTS).coalesce(1).write.parquet(f"{path}/0")
    with pytest.raises(ValueError):
        follow_requests(stream_of(spark, path, REQUESTS), cp, forget_seconds=1, available_now=True)
    query = follow_requests(stream_of(spark, path, REQUESTS), cp, forget_seconds=1, seconds=1)

    def handled(n):
        return sum(p["numInputRows"] for p in query.recentProgress) >= n

    try:
        waited = time.time()
        while not handled(1) and time.time() < waited + 60:
            time.sleep(0.2)
        time.sleep(2)
        spark.createDataFrame([old], REQUESTS).coalesce(1).write.parquet(f"{path}/1")
        while not handled(2) and time.time() < waited + 60:
            time.sleep(0.2)
    finally:
        query.stop()
    assert [r.id for r in read_docs(spark, cp).collect()] == ["1"]


def test_files_read_do_not_grow_with_micro_batches(spark, tmp_path):
    """The state holds one row per document, whatever came before."""
    path, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    for n in range(12):
        rows_ = [(1, "bin.000001", n * 10 + k, 0, 0, "index", "x", str(k), "", "", {"n": str(n)}) for k in range(3)]
        spark.createDataFrame(rows_, REQUESTS).coalesce(1).write.parquet(f"{path}/{n:03d}")
    finish(follow_requests(stream_of(spark, path, REQUESTS), cp, available_now=True))
    assert len(glob.glob(f"{cp}/commits/[0-9]*")) == 12
    found = read_docs(spark, cp)
    assert docs(found) == [("x", str(k), [("n", "11")], (1, 1, 110 + k, 0)) for k in range(3)]
    assert found.rdd.getNumPartitions() == 2


def test_raw_events_of_a_stream(spark, sf_dir, tmp_path):
    """Many micro-batches with a restart, events in any order within each, equal the batch; no folder of state but the checkpoint."""
    raw = V.orders_raw(spark, sf_dir).persist()
    path, cp, out = str(tmp_path / "raw"), str(tmp_path / "cp"), str(tmp_path / "out")
    # Parts of the log one after the other: cut by file and place.
    place = F.percent_rank().over(Window.partitionBy("server_id").orderBy("file_no", "event_seq"))
    parts = raw.withColumn("part", F.floor(place * 19.999)).repartition(1, "part").persist()
    handle = lambda b, i: b.write.mode("overwrite").parquet(f"{out}/b={i}")
    for first, last in ((0, 7), (8, 19)):
        for n in range(first, last + 1):
            parts.where(F.col("part") == n).drop("part").orderBy(F.rand(3)).coalesce(1).write.parquet(f"{path}/{n:03d}")
        finish(runner.run(normalise_stream(stream_of(spark, path, raw.schema)), handle, cp, available_now=True))
    assert len(os.listdir(out)) == 20
    assert rows(spark.read.parquet(out)) == rows(N.normalise(raw))
    # Another stream takes up where one ended.
    carried = N.carry_position(raw)
    cut = carried.where(F.col("file_no") < 2)
    rest = str(tmp_path / "rest")
    raw.where(F.col("file_no") >= 2).coalesce(1).write.parquet(rest)
    finish(runner.run(normalise_stream(stream_of(spark, rest, raw.schema), N.carried_ends(cut)), lambda b, i: b.write.parquet(str(tmp_path / "again")),
                      str(tmp_path / "cp2"), available_now=True))
    assert rows(spark.read.parquet(str(tmp_path / "again"))) == rows(N.normalise(raw.where(F.col("file_no") >= 2), N.carried_ends(cut)))
