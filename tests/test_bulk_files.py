"""The bulk sink: names, order, one plan, and what failures leave behind."""

import json
import os

import pytest
from pyspark.sql import functions as F

from catalog import views as V
from changeflow.functions.cells import cells_json
from changeflow.operators import docs as D, mapping as M
from changeflow.plans import sync
from changeflow.sources import bulk_files as B
from changeflow.sources.bulk import write_bulk, write_bulk_stream
from changeflow.sources.files import read_changes_files, write_changes_files
from tests.helpers import changes_of


@pytest.fixture(scope="module")
def requests(spark, sf_dir):
    return M.to_requests(V.orders(spark, sf_dir), M.rules_frame(spark, V.RULES)).persist()


def texts(folder):
    return {f: open(f"{folder}/{f}").read() for f in sorted(os.listdir(folder)) if f.endswith(".txt")}


def lines_of(requests):
    return sorted(line for r in M.bulk_lines(requests).collect() for line in r.line.splitlines())


def posted(bodies):
    """Documents after all bodies, in the order they are given."""
    held = {}
    lines = iter("".join(bodies).splitlines())
    for line in lines:
        [(action, place)] = json.loads(line).items()
        if action == "delete":
            held.pop((place["_index"], place["_id"]), None)
        else:
            held[place["_index"], place["_id"]] = json.loads(next(lines))
    return held


def wanted(requests):
    return {(r["index"], r.id): json.loads(r.data) for r in D.current_docs(requests).select("index", "id", cells_json(F.col("data")).alias("data")).collect()}


def test_computed_and_shuffled_once(spark, sf_dir):
    rows = B.bulk_rows(M.to_requests(V.orders(spark, sf_dir), M.rules_frame(spark, V.RULES)))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    once = M.to_requests(V.orders(spark, sf_dir), M.rules_frame(spark, V.RULES))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == once.count("Exchange hashpartitioning") + 1
    assert "rangepartitioning" not in plan and "Window" not in plan.replace("WindowGroup", "")


def test_modes_of_a_batch(spark, requests, tmp_path):
    path = str(tmp_path / "bulk")
    write_bulk(requests, path, 100)
    first = texts(path)
    assert sorted("".join(first.values()).splitlines()) == lines_of(requests) and os.path.exists(f"{path}/_SUCCESS")
    assert posted(first.values()) == wanted(requests) and not os.path.exists(f"{path}/_temporary/x")
    with pytest.raises(FileExistsError):
        write_bulk(requests, path, 100)
    write_bulk(requests.where("action = 'delete'"), path, 100, mode="append")
    assert set(first) < set(texts(path))
    write_bulk(requests, path, 10, bodies_per_file=1, mode="overwrite")
    many = texts(path)
    assert len(many) > len(first) and sorted("".join(many.values()).splitlines()) == lines_of(requests)
    assert all(sum("_index" in json.loads(x).get(next(iter(json.loads(x))), {}) for x in t.splitlines() if next(iter(json.loads(x))) in ("create", "update", "delete")) <= 10 for t in many.values())
    assert posted(many.values()) == wanted(requests)


def test_a_batch_under_one_id_is_replaced(spark, requests, tmp_path):
    path = str(tmp_path / "bulk")
    B.register(spark)
    for part in (requests, requests, requests.where("action <> 'create'")):
        B.bulk_rows(part).write.format("bulk").mode("append").option("batchId", "b7").save(path)
    assert sorted("".join(texts(path).values()).splitlines()) == lines_of(requests.where("action <> 'create'"))


def test_rows_of_a_file_stay_together(spark, requests, tmp_path):
    B.register(spark)
    rows = B.bulk_rows(requests)
    for bad in (rows.repartition(7), rows.drop("line"), rows.coalesce(1).orderBy(F.desc("log_pos"))):
        with pytest.raises(Exception, match="bulk_rows"):
            bad.write.format("bulk").mode("append").save(str(tmp_path / "bulk"))
    assert not os.path.exists(tmp_path / "bulk") or not texts(tmp_path / "bulk")


def test_a_failed_job_leaves_what_was_there(spark, requests, tmp_path):
    path = str(tmp_path / "bulk")
    write_bulk(requests, path, 100)
    before = texts(path)
    broken = requests.withColumn("id", F.when(F.col("action") == "delete", F.raise_error(F.lit("gave up"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="gave up"):
        write_bulk(broken, path, 100, mode="overwrite")
    assert texts(path) == before and not os.listdir(f"{path}/_temporary")


def test_unplaced_requests_and_empty_ones(spark, tmp_path):
    rows = [{"log_name": "", "log_pos": 0, "after": {"id": "1"}}, {"log_name": "b.9", "log_pos": 5 << 30, "after": {"id": "2"}}, {"log_name": "b.10", "log_pos": 1, "after": {}}]
    requests = M.to_requests(changes_of(spark, rows), M.rules_frame(spark, [M.Rule("shop", "t")]))
    write_bulk(requests, str(tmp_path / "few"))
    assert sorted("".join(texts(tmp_path / "few").values()).splitlines()) == lines_of(requests) and len(texts(tmp_path / "few")) == 3
    write_bulk(requests.where("false"), str(tmp_path / "none"))
    assert texts(tmp_path / "none") == {} and os.path.exists(tmp_path / "none" / "_SUCCESS")


def test_a_repeated_micro_batch_leaves_no_file_twice(spark, sf_dir, tmp_path):
    """The commit is lost after files were moved, so the micro-batch runs again; then the mark of the sink is there, but not Spark's."""
    log, path, cp = str(tmp_path / "log"), str(tmp_path / "bulk"), str(tmp_path / "cp")
    write_changes_files(V.orders(spark, sf_dir), log)
    rules = M.rules_frame(spark, V.RULES)

    def run():
        stream = read_changes_files(spark, log, stream=True, max_files_per_trigger=2)
        query = write_bulk_stream(M.to_requests(stream, rules), path, cp, 100, available_now=True)
        query.awaitTermination(240)

    run()
    requests = M.to_requests(read_changes_files(spark, log), rules)
    everything = lambda: sorted(r.value for r in B.read_bulk_stream(spark, path).collect())
    assert everything() == lines_of(requests)
    batches = sorted(os.listdir(f"{path}/_committed"))
    assert len(batches) > 1 and not os.path.exists(f"{path}/_temporary")
    last = str(int(batches[-1]))
    files = {f: os.stat(f"{path}/batch_id={batches[-1]}/{f}").st_mtime_ns for f in texts(f"{path}/batch_id={batches[-1]}")}

    def forget():
        for name in (last, f".{last}.crc"):
            os.remove(f"{cp}/commits/{name}")

    # Spark does not know that the last micro-batch was committed: it is handed over again, and found to be there.
    forget()
    run()
    assert {f: os.stat(f"{path}/batch_id={batches[-1]}/{f}").st_mtime_ns for f in files} == files
    # The sink did not get to its mark either: some files were moved, with a stale one among them.
    forget()
    os.remove(f"{path}/_committed/{batches[-1]}")
    os.remove(f"{path}/batch_id={batches[-1]}/{sorted(files)[0]}")
    open(f"{path}/batch_id={batches[-1]}/stale.txt", "w").write("{}\n")
    os.makedirs(f"{path}/_temporary/dead/task")
    run()
    assert set(texts(f"{path}/batch_id={batches[-1]}")) == set(files) and not os.path.exists(f"{path}/_temporary")
    assert everything() == lines_of(requests)
    bodies = [t for b in batches for t in texts(f"{path}/batch_id={b}").values()]
    assert sum(len(b.splitlines()) for b in bodies) == len(lines_of(requests))


def test_a_stream_needs_a_checkpoint(spark, sf_dir, tmp_path):
    write_changes_files(V.orders(spark, sf_dir), str(tmp_path / "log"))
    with pytest.raises(ValueError):
        sync.search_files(read_changes_files(spark, str(tmp_path / "log"), stream=True), V.RULES, str(tmp_path / "bulk"))
