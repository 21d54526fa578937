"""Times the main operators over change logs derived from the driver's tables; prints one JSON line.

The logs are first written as Parquet files (not timed): a job reads its log from storage, and the derivation
is no part of the operators. Every query runs to a sink that takes all rows and columns.

    BENCH_SF_DIR  tables, default /root/testdata/sf0.1
    BENCH_CPUS    cores, default 8
    BENCH_RUNS    timed runs per query after one warm-up, default 3; the median counts
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog import views as V
from changeflow.functions.cells import cells_json, parse_cells
from changeflow.operators import bulk, docs, filters, health, mapping, normalise, offsets, progress, sqllog
from changeflow.plans import sync
from changeflow.session import with_settings
from changeflow.sources import codec
from changeflow.sources.bulk import send_settled

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
FILES = 2 * CPUS


def session() -> SparkSession:
    spark = with_settings(SparkSession.builder.master(f"local[{CPUS}]").appName("changeflow-bench"), **{
        "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.sql.shuffle.partitions": str(2 * CPUS),
        "spark.ui.showConsoleProgress": "false"}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch(spark: SparkSession) -> str:
    """A new folder for the logs: in the cluster's shared one where it names one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return f"{shared}/changeflow-bench-{uuid.uuid4()}" if shared else tempfile.mkdtemp(prefix="changeflow-bench-")


def stored(spark: SparkSession, root: str, name: str, df: DataFrame) -> DataFrame:
    path = f"{root}/{name}"
    df.repartition(FILES).write.parquet(path)
    return spark.read.parquet(path)


def bench_queries(spark: SparkSession, root: str) -> tuple[dict[str, callable], dict[str, int]]:
    lines = stored(spark, root, "lineitem_log", V.lineitem_log(spark, SF_DIR))
    orders = stored(spark, root, "orders_log", V.orders_log(spark, SF_DIR))
    raw = stored(spark, root, "orders_raw", V.orders_raw(spark, SF_DIR))
    messages = stored(spark, root, "messages", V.messages(spark, SF_DIR))
    samples = stored(spark, root, "samples", V.position_samples(spark, SF_DIR))
    line_rule = [mapping.Rule("shop", "lineitem", id_field="l_orderkey", field_mapping={"l_returnflag": "flag"})]
    rows = {"lineitem_log": lines.count(), "orders_log": orders.count(), "orders_raw": raw.count(),
            "messages": messages.count(), "samples": samples.count()}

    def requests() -> DataFrame:
        return mapping.to_requests(V.as_changes(lines), mapping.rules_frame(spark, line_rule), skip_no_pk=False)

    return {
        "parse_cells": lambda: lines.select(parse_cells(F.col("before_json")), parse_cells(F.col("after_json"))),
        "decode_changes": lambda: codec.decode_changes(messages),
        "encode_changes": lambda: codec.encode_changes(V.as_changes(orders)).select("value"),
        "sql_log": lambda: sqllog.sql_log(V.as_changes(lines)),
        "to_requests": requests,
        "bulk_lines": lambda: mapping.bulk_lines(requests()),
        "batch_requests": lambda: bulk.batch_requests(requests()),
        "current_docs": lambda: docs.current_docs(requests()),
        "merge_docs": lambda: docs.merge_docs(requests()),
        "carry_position": lambda: normalise.carry_position(raw),
        "normalise": lambda: normalise.normalise(raw),
        "dedup_changes": lambda: offsets.dedup_changes(codec.decode_changes(messages)),
        "order_changes": lambda: offsets.order_changes(V.as_changes(orders)),
        "progress": lambda: progress.progress(V.as_changes(orders)),
        "health": lambda: health.health(samples),
        "alerts": lambda: health.alerts(health.health(samples)),
        "bulk_bodies": lambda: bulk.bulk_bodies(bulk.batch_requests(requests())),
        "send_settled": lambda: send_settled(sync.settled_requests(requests()), lambda body: (200, '{"took":1,"items":[]}')),
        "changes_since": lambda: filters.changes_since(V.as_changes(orders), V.saved_positions(spark)).select(
            cells_json(F.col("after"))),
    }, rows


def run(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    queries, rows = bench_queries(spark, scratch(spark))
    only = os.environ.get("BENCH_ONLY")
    seconds = {}
    for name, query in queries.items():
        if only and name not in only.split(","):
            continue
        run(query())
        seconds[name] = round(statistics.median(run(query()) for _ in range(RUNS)), 3)
    print(json.dumps({"metric": "change_log_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")), "cpus": CPUS, "rows": rows}))
    spark.stop()


if __name__ == "__main__":
    main()
