"""Small change logs for tests."""

from changeflow import schema as S


def changes_of(spark, rows):
    """Change events from dicts; fields left out get their blank."""
    blank = {"event_type": "insert", "server_id": 1, "log_name": "mysql-bin.000001", "log_pos": 0, "db": "shop",
             "table": "t", "sql": "", "gtid_set": "", "primary": ["id"], "before": {}, "after": {}, "timestamp": 0,
             "row_ordinal": 0}
    full = [{**blank, **r} for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in S.CHANGE_COLUMNS) for r in full], S.CHANGE_SCHEMA)


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]

