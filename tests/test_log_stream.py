"""The log as a stream by position: where it starts, what it opens, restarts, renames and bounds."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from catalog import views as V
from changeflow.functions.positions import log_number
from changeflow.operators.filters import changes_since
from changeflow.sources.files import read_changes_files, write_changes_files
from changeflow.sources.log_stream import read_changes_log
from changeflow.streaming import runner
from tests.helpers import changes_of

KEYS = ["event_type", "server_id", "log_name", "log_pos", "row_ordinal"]


@pytest.fixture
def log(spark, sf_dir, tmp_path):
    """The log of ``orders``, cut into some files per server."""
    path = str(tmp_path / "log")
    events = V.orders(spark, sf_dir)
    width = events.agg(F.max("log_pos")).first()[0] // 3
    files = events.withColumn("log_name", F.format_string("mysql-bin.%06d", 9 + F.floor(F.col("log_pos") / width))).withColumn("log_pos", F.col("log_pos") % width)
    write_changes_files(files.repartition(3), path, "overwrite")
    return path


def rows(df):
    return sorted(map(str, df.select(*KEYS, F.to_json("before"), F.to_json("after"), F.to_json("primary"), "timestamp").collect()))


def run(df, tmp_path, name, **how):
    """Runs to the end of what is there; the events of each micro-batch."""
    out = str(tmp_path / name)
    query = runner.run(df, lambda b, i: b.write.mode("overwrite").parquet(f"{out}/b={i}"), str(tmp_path / f"{name}-cp"), **how)
    query.processAllAvailable() if not how else query.awaitTermination(240)
    query.stop()
    return out


def saved(spark, log, part=0.5):
    """A position inside each server's log."""
    events = read_changes_files(spark, log).where("log_pos > 0 and log_name <> ''").select("server_id", "log_name", "log_pos").distinct().collect()
    out = []
    for server in sorted({r.server_id for r in events}):
        mine = sorted((log_number(r.log_name), r.log_pos, r.log_name) for r in events if r.server_id == server)
        _, pos, name = mine[int(len(mine) * part)]
        out.append((server, name, pos))
    return out


def test_all_of_a_log(spark, log, tmp_path):
    got = run(read_changes_log(spark, log), tmp_path, "out", available_now=True)
    assert rows(spark.read.parquet(got)) == rows(read_changes_files(spark, log))


def test_after_saved_positions_nothing_before_is_opened(spark, log, tmp_path):
    positions = saved(spark, log)
    want = rows(changes_since(read_changes_files(spark, log), positions))
    before = 0
    for server, name, _ in positions:
        for folder in glob.glob(f"{log}/server_id={server}/log_name=*"):
            if log_number(folder.split("=")[-1]) < log_number(name):
                for file in glob.glob(f"{folder}/*.parquet"):
                    open(file, "wb").write(b"cannot be read")
                    before += 1
    assert before
    got = run(read_changes_log(spark, log, positions), tmp_path, "out", available_now=True)
    assert rows(spark.read.parquet(got)) == want and want


def test_servers_without_a_position_begin_now(spark, log, tmp_path):
    (server, name, pos), *rest = saved(spark, log)
    df = read_changes_log(spark, log, [(server, name, pos)] + [(s, "", 0) for s, _, _ in rest])
    want = rows(changes_since(read_changes_files(spark, log), [(server, name, pos)]))
    got = run(df, tmp_path, "out", available_now=True)
    assert rows(spark.read.parquet(got)) == want
    # What comes after the start is read, of servers without a position and of new ones.
    more = changes_of(spark, [{"server_id": s, "log_name": "mysql-bin.999999", "log_pos": 7, "after": {"id": "1"}} for s in (server, *(r[0] for r in rest), 77)])
    write_changes_files(more, log)
    run(df, tmp_path, "out", available_now=True)
    assert rows(spark.read.parquet(got)) == sorted(want + rows(more))


def test_restart_after_part_files_were_renamed(spark, log, tmp_path):
    df = read_changes_log(spark, log)
    got = run(df, tmp_path, "out", available_now=True)
    first = rows(spark.read.parquet(got))
    for file in glob.glob(f"{log}/*/*/*.parquet"):
        os.rename(file, file.replace("part-", "moved-"))
    run(df, tmp_path, "out", available_now=True)
    assert rows(spark.read.parquet(got)) == first
    tail = changes_of(spark, [{"log_name": "mysql-bin.999999", "log_pos": p, "row_ordinal": o} for p in (4, 9) for o in (0, 1)])
    write_changes_files(tail, log)
    run(df, tmp_path, "out", available_now=True)
    assert rows(spark.read.parquet(got)) == sorted(first + rows(tail))
    # The same file goes on behind the position reached.
    more = changes_of(spark, [{"log_name": "mysql-bin.999999", "log_pos": 12}, {"log_name": "mysql-bin.1000000", "log_pos": 1}])
    write_changes_files(more, log)
    run(df, tmp_path, "out", available_now=True)
    assert rows(spark.read.parquet(got)) == sorted(first + rows(tail) + rows(more))


def test_bounded_micro_batches_with_a_restart(spark, log, tmp_path):
    every = read_changes_files(spark, log)
    width = every.groupBy("server_id", "log_name").agg(F.max("log_pos").alias("n")).agg(F.max("n")).first()[0]
    limit = max(1, width // 3)
    with pytest.raises(ValueError):
        read_changes_log(spark, log, max_log_bytes=limit)
    df = read_changes_log(spark, log, max_log_bytes=limit, progress=str(tmp_path / "progress"))
    out, seen = str(tmp_path / "out"), []

    def handle(batch, batch_id):
        if batch_id == 2 and len(seen) < 3:
            seen.append("failed")
            raise RuntimeError("gave up")
        seen.append(batch_id)
        batch.write.mode("overwrite").parquet(f"{out}/b={batch_id}")

    with pytest.raises(Exception, match="gave up"):
        runner.run(df, handle, str(tmp_path / "cp")).processAllAvailable()
    query = runner.run(df, handle, str(tmp_path / "cp"))
    query.processAllAvailable()
    query.stop()
    assert seen[:4] == [0, 1, "failed", 2] and len(seen) > 4
    assert rows(spark.read.parquet(out)) == rows(every)
    # No server went further than the bound: a batch spans less than two files.
    spans = spark.read.parquet(out).groupBy("b", "server_id", "log_name").agg((F.max("log_pos") - F.min("log_pos")).alias("n"))
    assert spans.agg(F.max("n")).first()[0] <= limit
    # A restart after a batch that was committed goes on from there, within the bound.
    tail = changes_of(spark, [{"log_name": "mysql-bin.999999", "log_pos": p * limit} for p in range(1, 6)])
    write_changes_files(tail, log)
    done = len(seen)
    query = runner.run(df, handle, str(tmp_path / "cp"))
    query.processAllAvailable()
    query.stop()
    assert len(seen) >= done + 5
    # With the folder of progress lost, nothing is read again.
    lost = runner.run(read_changes_log(spark, log, max_log_bytes=limit, progress=str(tmp_path / "another")), handle, str(tmp_path / "cp"))
    lost.processAllAvailable()
    lost.stop()
    assert rows(spark.read.parquet(out)) == sorted(rows(every) + rows(tail))


def test_events_without_a_file_or_position(spark, tmp_path):
    log = str(tmp_path / "log")
    odd = changes_of(spark, [{"log_name": "", "log_pos": 0}, {"log_name": "", "log_pos": None}, {"log_name": "b.2", "log_pos": None}, {"log_name": "b.2", "log_pos": 0}, {"log_name": "a:b.3", "log_pos": 5}])
    write_changes_files(odd, log)
    got = run(read_changes_log(spark, log), tmp_path, "out", available_now=True)
    assert rows(spark.read.parquet(got)) == rows(read_changes_files(spark, log))
