import datetime
import random

import pytest
from pyspark.sql import functions as F

from changeflow import schema as S
from changeflow.operators import health as H, progress as G
from tests.helpers import changes_of

START = datetime.datetime(2024, 1, 1, 11, 59, 30)


def samples_of(spark, rows):
    """Rows of (server, seconds, (file, pos), (db file, pos), error)."""
    return spark.createDataFrame(
        [(s, START + datetime.timedelta(seconds=t), f[0], f[1], d[0], d[1], e) for s, t, f, d, e in rows], S.SAMPLE_SCHEMA)


def statuses(spark, rows, **how):
    judged = H.health(samples_of(spark, rows), **how).orderBy("server_id", "ts").collect()
    return [(r.status, r.reasons) for r in judged]


LATE, BOTH, SYNC = S.REASON_THRESHOLD, S.REASON_BOTH_STOPPED, S.REASON_SYNC_STOPPED
A, B, FAR = (1, 100), (1, 200), (1, 50_000)


# The eight rules: (last db, last file, db, file, error) -> status and reasons.
@pytest.mark.parametrize("last_db,last_file,db,file,error,want", [
    (A, A, B, A, "timeout", ("red", [S.REASON_NO_DB_POSITION + "timeout"])),   # no db position
    (A, A, B, (1, 150), "", ("green", [])),                                    # both move, within the threshold
    (A, A, FAR, (1, 150), "", ("yellow", [LATE])),                             # beyond the threshold
    (A, A, A, A, "", ("green", [])),                                           # both still and equal
    (B, A, B, A, "", ("red", [BOTH])),                                         # both still, the file behind
    (A, B, A, B, "", ("red", [BOTH])),                                         # both still, not equal: the file ahead
    (B, A, B, (1, 150), "", ("green", [])),                                    # db still, file moves
    (A, A, B, A, "", ("red", [SYNC])),                                         # db moves, file still
    (A, A, FAR, A, "", ("red", [LATE, SYNC])),                                 # two reasons at once
    (FAR, A, FAR, A, "", ("red", [LATE, BOTH])),
])
def test_eight_rules(spark, last_db, last_file, db, file, error, want):
    assert statuses(spark, [(1, 0, last_file, last_db, ""), (1, 10, file, db, error)])[1] == want


def test_first_sample_compares_with_itself(spark):
    assert statuses(spark, [(1, 0, A, B, "")]) == [("red", [BOTH])]
    assert statuses(spark, [(1, 0, A, A, "")]) == [("green", [])]


def test_older_file_counts_from_zero(spark):
    rows = [(1, 0, (1, 90), (2, 4), ""), (1, 10, (1, 99_000), (2, 10_000), ""), (1, 20, (1, 99_100), (2, 10_001), "")]
    assert [s for s, _ in statuses(spark, rows)] == ["red", "green", "yellow"]
    lag = H.lag_bytes(samples_of(spark, rows)).orderBy("ts").collect()
    assert [(r.lag_bytes, r.files_behind) for r in lag] == [(4, 1), (10_000, 1), (10_001, 1)]


@pytest.mark.parametrize("gap,file,want", [(4, B, "green"), (5, B, "green"), (6, B, "red"), (4, A, "red"), (4, (1, 50), "red")])
def test_recheck(spark, gap, file, want):
    """Server 1 is stuck at second 10; it passes if the file position grew within five seconds."""
    rows = [(1, 0, A, A, ""), (1, 10, A, B, ""), (1, 10 + gap, file, B, "")]
    assert statuses(spark, rows)[1][0] == want


def test_recheck_looks_into_the_next_span(spark):
    # The noon border lies 30 seconds after START.
    rows = [(1, 0, A, A, ""), (1, 28, A, B, ""), (1, 31, B, B, "")]
    assert [s for s, _ in statuses(spark, rows, span_seconds=3600)] == ["green", "green", "green"]
    assert [s for s, _ in statuses(spark, rows, span_seconds=1)] == ["green", "green", "green"]


def test_settings():
    assert [H.check_seconds_or_default(s) for s in (0, 0.9, 1, 5)] == [10, 10, 1, 5]
    assert [H.threshold_or_default(n) for n in (0, 999, 1000, 3000)] == [10_000, 10_000, 1000, 3000]
    assert [G.save_seconds_or_default(s) for s in (0, 1, 5)] == [3, 1, 5]


def fold(rows, threshold=10_000, grace=5):
    """Status and alerts by going through the samples one at a time."""
    out, last, last_status = [], {}, {}
    for s, t, f, d, e in sorted(rows, key=lambda r: (r[0], r[1])):
        lf, ld = last.get(s, (f, d))
        grew = any(s2 == s and t < t2 <= t + grace and f2 > f for s2, t2, f2, _, _ in rows)
        level = 0
        if (f[1] if f[0] == d[0] else 0) + threshold < d[1]:
            level = 1
        if ld == d:
            if lf == f and d != f and not grew:
                level = 2
        elif lf == f and not grew:
            level = 2
        if e:
            level = 2
        status = S.LEVELS[level]
        out.append((s, t, status, last_status.get(s, "") != status and level > 0))
        last[s], last_status[s] = (f, d), status
    return out


def random_samples(seed, n=300):
    rnd, rows = random.Random(seed), []
    for s in (1, 2):
        t, f, d = 0, [1, 100], [1, 100]
        for _ in range(n // 2):
            t += rnd.choice([1, 2, 4, 5, 6, 10])
            if rnd.random() < 0.5:
                d[1] += rnd.choice([100, 9_000, 20_000])
            if rnd.random() < 0.1:
                d = [d[0] + 1, 4]
            if rnd.random() < 0.6:
                f = list(d) if rnd.random() < 0.7 else [f[0], min(f[1] + 50, d[1]) if f[0] == d[0] else f[1] + 50]
            rows.append((s, t, tuple(f), tuple(d), "gone" if rnd.random() < 0.05 else ""))
    return rows


@pytest.mark.parametrize("seed,span", [(1, 3600), (2, 60), (3, 7), (4, 2)])
def test_health_and_alerts_equal_a_fold(spark, seed, span):
    rows = random_samples(seed)
    judged = H.health(samples_of(spark, rows), span_seconds=span)
    seconds = ((F.unix_millis("ts") - F.lit(int(START.replace(tzinfo=datetime.timezone.utc).timestamp() * 1000))) / 1000).cast("int").alias("t")
    local = judged.select("server_id", "ts", "status", seconds)
    base = min(r.ts for r in local.collect()) - datetime.timedelta(seconds=min(r[1] for r in rows))
    at = lambda r: round((r.ts - base).total_seconds())
    want = fold(rows)
    assert sorted((r.server_id, at(r), r.status) for r in judged.collect()) == [w[:3] for w in want]
    raised = H.alerts(judged, span_seconds=span)
    assert sorted((r.server_id, at(r)) for r in raised.collect()) == [w[:2] for w in want if w[3]]


def test_settings_travel_with_the_verdict(spark):
    judged = H.health(samples_of(spark, [(1, 0, A, (1, 5000), "")]), threshold=3000, check_seconds=0)
    assert [(r.status, r.threshold, r.check_seconds) for r in judged.collect()] == [("red", 3000, 10.0)]
    assert H.health(samples_of(spark, [(1, 0, A, A, "")]), threshold=5).first().threshold == 10_000


def test_worst(spark):
    df = spark.createDataFrame([("a", 0), ("a", 2), ("b", 1), ("b", 0), ("c", 0)], "k string, level int")
    assert sorted((r.k, r.status) for r in H.worst_status(df, ["k"]).collect()) == [("a", "red"), ("b", "yellow"), ("c", "green")]


def test_level_of_names(spark):
    df = spark.createDataFrame([("green",), ("yellow",), ("red",), ("odd",), ("",)], "s string")
    assert [r.l for r in df.select(H.level_of(F.col("s")).alias("l")).collect()] == [0, 1, 2, 0, 0]


def test_progress(spark):
    rows = [{"timestamp": t, "log_name": f"b.{n}", "log_pos": p, "event_type": k, "server_id": 1} for t, n, p, k in [
        (0, 1, 10, "insert"), (1, 1, 20, "insert"), (2, 1, 30, "xid"),      # saved at 3
        (3, 1, 30, "xid"),                                                    # nothing new at 6
        (7, 1, 40, "ddl"), (8, 1, 50, "insert"),                             # saved at 7 and at 9
        (100_000, 2, 4, "rotate")]]                                           # saved at once; the tick repeats it
    got = sorted((r.saved_at, r.log_name, r.log_pos) for r in G.progress(changes_of(spark, rows)).collect())
    assert got == [(3, "b.1", 30), (7, "b.1", 40), (9, "b.1", 50), (100_000, "b.2", 4)]


def test_progress_aggregates_by_hash(spark):
    plan = G.save_points(changes_of(spark, [{}]))._jdf.queryExecution().executedPlan().toString()
    first = plan.rindex("Aggregate(keys=[server_id")
    assert plan[first - 4:first] == "Hash", plan
