"""Documents that follow a stream of requests, one by one as state of the query.

The table of documents is the state itself, kept by Spark's state store beside the checkpoint and read from there. A micro-batch touches its own
documents only, and a reader opens what the store keeps of each partition, however many micro-batches there were."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from changeflow import schema as S
from changeflow.functions.positions import log_seq
from changeflow.streaming.runner import OnBatch, run

_AT = ("server_id", "log_seq", "log_pos", "row_ordinal")
_AT_COLUMNS = ", ".join(f"{c} bigint" for c in _AT)
_VERSION = f"struct<{', '.join(f'{c}: bigint' for c in _AT)}>"
_CHANGED = f"index string, id string, action string, parent string, pipeline string, data map<string,string>, {_AT_COLUMNS}"
_ChangedRow = Row("index", "id", "action", "parent", "pipeline", "data", *_AT)


def _order(at: tuple) -> tuple:
    """Places in the log compare as in SQL: unknown comes first."""
    return tuple((x is not None, x or 0) for x in at)


def _place(row: Row) -> tuple:
    return tuple(row[c] for c in _AT)


class _Forgetful(StatefulProcessor):
    """Keeps the version of a deleted document, so that an older request that comes late cannot revive it: for ever, or for a time."""

    def __init__(self, forget_seconds: float | None):
        self.forget_ms = None if forget_seconds is None else int(forget_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.gone = handle.getValueState("gone", _AT_COLUMNS, self.forget_ms)

    def close(self) -> None:
        pass


class LastRequest(_Forgetful):
    """The last request of a document by its place in the log. The state of a document is that request."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.doc = handle.getValueState("doc", f"action string, parent string, pipeline string, data map<string,string>, version {_VERSION}")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803 - Spark's names
        last = None
        for row in rows:
            if last is None or _order(_place(row)) >= _order(_place(last)):
                last = row
        known = [tuple(self.doc.get()[-1])] if self.doc.exists() else []
        known += [tuple(self.gone.get())] if self.gone.exists() else []
        at = _place(last)
        if any(_order(k) > _order(at) for k in known):
            return
        if last.action == S.DELETE:
            self.doc.clear()
            self.gone.update(at)
        else:
            self.gone.clear()
            self.doc.update((last.action, last.parent, last.pipeline, dict(last.data or ()), at))
        yield _ChangedRow(*key, last.action, last.parent, last.pipeline, dict(last.data or ()), *at)


class Fields(_Forgetful):
    """The fields of a document whose updates change some of them, each with its place in the log. The state of a document is an entry per
    field, the last request, and the last one that put or deleted the whole."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.fields = handle.getMapState("fields", "field string", f"value string, at {_VERSION}")
        self.doc = handle.getValueState("doc", f"action string, parent string, pipeline string, version {_VERSION}, whole {_VERSION}")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        action, parent, pipeline, end, whole = self.doc.get() if self.doc.exists() else (None, None, None, None, None)
        if end is None and self.gone.exists():
            action, end = S.DELETE, self.gone.get()
            whole = end
        came_in = end
        held = {k[0]: (v[0], tuple(v[1])) for k, v in self.fields.iterator()}
        before = dict(held)
        for row in rows:
            at = _place(row)
            if row.action != S.UPDATE and (whole is None or _order(at) >= _order(whole)):
                whole = at
            if row.action != S.DELETE:
                for field, value in dict(row.data or ()).items():
                    if field not in held or _order(at) >= _order(held[field][1]):
                        held[field] = (value, at)
            if end is None or _order(at) >= _order(end):
                action, parent, pipeline, end = row.action, row.parent, row.pipeline, at
        held = {f: v for f, v in held.items() if whole is None or _order(v[1]) >= _order(whole)}
        for field in before.keys() - held.keys():
            self.fields.removeKey((field,))
        for field, value in held.items():
            if before.get(field) != value:
                self.fields.updateValue((field,), value)
        if action == S.DELETE:
            self.doc.clear()
            self.gone.update(tuple(end))
        else:
            self.gone.clear()
            self.doc.update((action, parent, pipeline, tuple(end), None if whole is None else tuple(whole)))
        if before != held or came_in is None or tuple(came_in) != tuple(end):
            yield _ChangedRow(*key, action, parent, pipeline, {f: held[f][0] for f in sorted(held)}, *end)


def document_changes(requests: DataFrame, merge: bool = False, forget_seconds: float | None = None) -> DataFrame:
    """``index, id, action, parent, pipeline, data, version`` of each document that a micro-batch changed, after it. Order, repeats and late
    requests do not matter, as versions decide. ``merge`` is for partial images, as ``merge_docs``: ``data`` is the whole document.

    Deleted documents stay as tombstones, with ``forget_seconds`` for that time only: state stays in proportion to what exists, and a
    request older than a deletion must not come later than that. Requests without an id belong to no document."""
    places = requests.where(F.length("id") > 0).select(
        "index", "id", "action", "parent", "pipeline", "data", F.col("server_id").cast("bigint"), log_seq(F.col("log_name")).alias("log_seq"),
        F.col("log_pos").cast("bigint"), F.col("row_ordinal").cast("bigint"))
    processor = (Fields if merge else LastRequest)(forget_seconds)
    changed = places.groupBy("index", "id").transformWithState(processor, _CHANGED, "append", "none" if forget_seconds is None else "processingTime")
    return changed.select("index", "id", "action", "parent", "pipeline", "data", F.struct(*_AT).alias("version"))


def follow_requests(requests: DataFrame, checkpoint: str, on_batch: OnBatch | None = None, merge: bool = False, forget_seconds: float | None = None,
                    **how) -> StreamingQuery:
    """Keeps the documents of a stream of requests; :func:`read_docs` reads them. ``on_batch`` gets the documents that changed.
    ``how`` goes to :func:`changeflow.streaming.runner.run`. A query that forgets wakes up by the clock, so it does not end by itself."""
    if forget_seconds is not None and how.get("available_now"):
        raise ValueError("a query that forgets by the clock does not end by itself")
    changed = document_changes(requests, merge, forget_seconds)

    def all_of_it(batch: DataFrame, _: int) -> None:
        batch.write.format("noop").mode("append").save()

    return run(changed, _once(on_batch) if on_batch else all_of_it, checkpoint, **how)


def _once(on_batch: OnBatch) -> Callable[[DataFrame, int], None]:
    def handle(batch: DataFrame, batch_id: int) -> None:
        # The stateful plan runs once and to its end, whatever the handler reads of it.
        changed = batch.persist()
        try:
            changed.count()
            on_batch(changed, batch_id)
        finally:
            changed.unpersist()

    return handle


def _state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)


def read_docs(spark: SparkSession, checkpoint: str, merge: bool = False) -> DataFrame:
    """``index, id, data, version`` of the documents that exist after the last micro-batch of :func:`follow_requests`."""
    docs = _state(spark, checkpoint, "doc").select("key.index", "key.id", "value.*")
    if not merge:
        return docs.select("index", "id", "data", "version")
    entries = F.sort_array(F.collect_list(F.struct("user_map_key.field", "user_map_value.value")))
    fields = _state(spark, checkpoint, "fields").groupBy("key.index", "key.id").agg(F.map_from_entries(entries).alias("data"))
    return docs.join(fields, ["index", "id"], "left").select("index", "id", F.coalesce("data", S.empty_cells()).alias("data"), "version")
