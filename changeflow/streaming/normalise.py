"""Raw log events of a stream to change events, with the position of each server as state."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from changeflow import schema as S
from changeflow.operators.normalise import changes_of_carried

_RAW = tuple(column.split()[0].strip("`") for column in S.RAW_SCHEMA.split(", "))
_CARRIED = f"{S.RAW_SCHEMA}, log_name string, next_pos bigint, gtid_set string"
_CarriedRow = Row(*_RAW, "log_name", "next_pos", "gtid_set")
_MOVES = (S.ROTATE, S.DDL, S.XID)


class Position(StatefulProcessor):
    """Puts where a server's log stands after each event beside it: the rules of ``carry_position``, with what the last micro-batch
    ended with as state. The state of a server is one row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stands = handle.getValueState("stands", "log_name string, log_pos bigint, gtid_set string")

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803 - Spark's names
        known = bool(initialState.log_name)
        self.stands.update((initialState.log_name if known else None, initialState.log_pos if known else None, initialState.gtid_set or None))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        name, pos, gtid = self.stands.get() if self.stands.exists() else (None, None, None)
        for r in sorted(rows, key=lambda r: (r.file_no, r.event_seq)):
            moves = r.event_kind in _MOVES
            named = moves and bool(r.next_log) and bool(r.log_pos)
            if named:
                name = r.next_log
            # A position counts only once a file is known.
            if r.log_pos and (named or not moves) and name is not None:
                pos = r.log_pos
            if r.event_kind in (S.GTID, S.DDL) and r.gtid:
                gtid = r.gtid
            yield _CarriedRow(*(r[c] for c in _RAW), name or "", pos or 0, gtid or "")
        self.stands.update((name, pos, gtid))

    def close(self) -> None:
        pass


def normalise_stream(raw: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """As :func:`changeflow.operators.normalise.normalise`, on a stream. A micro-batch goes on where the servers' logs stood after the last
    one: that is state of the query, kept with its checkpoint. ``start`` (``server_id, log_name, log_pos, gtid_set``, one row per server) is
    where another reader ended.

    The events of a server come in the order of its log from one micro-batch to the next, and in any order within. A server's part of a
    micro-batch is sorted in one task; what bounds a micro-batch (``maxFilesPerTrigger``, ``max_log_bytes``) bounds it."""
    initial = None if start is None else start.select("server_id", "log_name", "log_pos", "gtid_set").groupBy("server_id")
    carried = raw.select(*(F.col(f"`{c}`") for c in _RAW)).groupBy("server_id").transformWithState(Position(), _CARRIED, "append", "none", initialState=initial)
    return changes_of_carried(carried)
