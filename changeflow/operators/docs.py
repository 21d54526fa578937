"""What an index holds: documents folded from requests, and lookups on them.

A document table has ``index, id, data`` (and, where it was folded here, ``version``: the position of the
request that made it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changeflow import schema as S
from changeflow.functions.positions import event_order

KEY = ["index", "id"]
#: For grouping: the id first, because sorts compare the first column's prefix and an index has many ids.
BY_ID = ["id", "index"]


def _addressed() -> Column:
    """Whether a group's requests have an id. As an aggregate, because a filter on ``id`` would be pushed below
    the mapping and compute every id twice."""
    return F.max(F.length("id") > 0).alias("_addressed")


def latest_requests(requests: DataFrame, addressed_only: bool = True) -> DataFrame:
    """The last request of each document, deletes included: ``index, id, action, parent, pipeline, data,
    version`` and ``whole``, whether it rests on a create, index or delete (else all were updates).

    An aggregate with map-side partials: a hot document is one row per task before the shuffle. The last
    request decides because row images are full. Requests without an id belong to no document; they are left
    out, or each kept by itself: told apart by position, or, where their log file is not known, kept all.
    """
    at = event_order()
    key = list(BY_ID)
    if not addressed_only:
        alone = F.length("id") == 0
        requests = requests.withColumns({
            "_alone": F.when(alone, F.struct(at, "db", "table")) if {"db", "table"} <= set(requests.columns) else F.when(alone, at),
            "_unplaced": F.when(alone & (F.length(F.coalesce("log_name", F.lit(""))) == 0), F.monotonically_increasing_id())})
        key += ["_alone", "_unplaced"]
    kept = F.struct("action", "parent", "pipeline", "data", F.col("_at").alias("version"))
    last = requests.withColumn("_at", at).groupBy(*key).agg(
        F.max_by(kept, "_at").alias("r"), F.max(F.col("action") != S.UPDATE).alias("whole"), _addressed())
    return (last.where("_addressed") if addressed_only else last).select(*KEY, "r.*", "whole")


def current_docs(requests: DataFrame) -> DataFrame:
    """``index, id, data, version`` of the documents that exist after all requests. A create of an existing
    document puts it; order of arrival and repeats do not matter."""
    return latest_requests(requests).where(F.col("action") != S.DELETE).select(*KEY, "data", "version")


def merge_docs(requests: DataFrame) -> DataFrame:
    """As :func:`current_docs` for partial images: an update changes just its fields of the document.

    Two layers: the last whole put or delete of a document, kept in one piece, and over it the last value of each field that later updates
    changed. Only updates are unfolded. Partial aggregation shrinks a hot document to a row per changed field and task; a
    document has no more entries in the second step than fields.
    """
    at = event_order()
    text_map = "map<string,string>"
    # Sorts before every field name; its value is the action. The last one of a whole put carries the image.
    marker = F.struct(F.lit(None).cast("string").alias("field"), F.col("action").alias("value"))
    fields = F.transform(F.map_entries("data"), lambda e: F.struct(e["key"].alias("field"), e["value"].alias("value")))
    update = F.col("action") == S.UPDATE
    image = F.when(update | (F.col("action") == S.DELETE), F.lit(None).cast(text_map)).otherwise(F.col("data"))
    rows = (requests
            .select(*KEY, "action", at.alias("at"), image.alias("image"), F.inline(F.when(update, F.concat(F.array(marker), fields)).otherwise(F.array(marker)))))
    is_marker = F.col("field").isNull()
    last = rows.groupBy(*BY_ID, "field").agg(
        F.max(F.struct("at", "value")).alias("last"),
        F.max_by(F.struct("at", "image"), F.when(F.col("action") != S.UPDATE, F.col("at"))).alias("whole"))
    entries = F.collect_list(F.when(~is_marker, F.struct("field", "last")))
    docs = last.groupBy(*BY_ID).agg(
        entries.alias("entries"), F.first("whole", True).alias("whole"),
        F.max(F.when(is_marker, F.col("last"))).alias("end"), _addressed())
    later = F.filter("entries", lambda e: F.col("whole").isNull() | (e["last"]["at"] >= F.col("whole.at")))
    over = F.transform(later, lambda e: F.struct(e["field"].alias("key"), e["last"]["value"].alias("value")))
    layered = docs.where(F.col("_addressed") & (F.col("end.value") != S.DELETE)).withColumn("over", over)
    names = F.transform("over", lambda e: e["key"])
    under = F.filter(F.map_entries(F.coalesce("whole.image", S.empty_cells())), lambda e: ~F.array_contains(names, e["key"]))
    data = F.map_from_entries(F.sort_array(F.concat(under, F.col("over"))))
    return layered.select(*KEY, data.alias("data"), F.col("end.at").alias("version"))


def get_docs(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Each row of ``ids`` (``index, id``) with the document's columns and ``found``. Documents are unique by
    id, so an id asked for very often is split by Spark's skew join like any hot key of its larger side."""
    stored = docs.withColumn("_found", F.lit(True))
    return (ids.join(stored, KEY, "left")
            .withColumn("found", F.coalesce("_found", F.lit(False))).drop("_found"))


def docs_exist(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``index, id, found``: one row per asked id, however often it is asked for."""
    keys = docs.select(*KEY, F.lit(True).alias("_found"))
    return (ids.select(*KEY).distinct().join(keys, KEY, "left")
            .select(*KEY, F.coalesce("_found", F.lit(False)).alias("found")))


def put_docs(docs: DataFrame, new_docs: DataFrame) -> DataFrame:
    """Create or replace whole documents by id. ``new_docs`` has one row per id."""
    kept = docs.join(new_docs.select(*KEY), KEY, "left_anti")
    return kept.unionByName(new_docs, allowMissingColumns=True)


def delete_docs(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Drop documents by id; ids that are not there are fine."""
    return docs.join(ids.select(*KEY).distinct(), KEY, "left_anti")


# Kinds of cells. The codes order the kinds, so min and max run on integers in a hash aggregate.
KINDS = ("null", "boolean", "number", "string", "object")


def cell_kind(cell: Column) -> Column:
    first = F.substring(cell, 1, 1)
    return (F.when(cell.isNull(), 0).when(first.isin("t", "f"), 1).when(first == '"', 3)
            .when(first.isin("{", "["), 4).otherwise(2))


def doc_fields(docs: DataFrame) -> DataFrame:
    """``index, field, docs, type``: the fields of each index. ``type`` names both kinds where documents
    differ; NULLs count only for a field that never has a value."""
    cells = docs.select("index", F.explode("data").alias("field", "cell"))
    kinds = (cells.select("index", "field", cell_kind(F.col("cell")).alias("kind"))
             .groupBy("index", "field").agg(
                 F.count("*").alias("docs"),
                 F.min(F.when(F.col("kind") > 0, F.col("kind"))).alias("low"), F.max("kind").alias("high")))
    names = F.array(*map(F.lit, KINDS))
    low, high = F.get(names, F.coalesce("low", F.lit(0))), F.get(names, F.col("high"))
    return kinds.select("index", "field", "docs",
                        F.when(low == high, low).otherwise(F.concat_ws("|", low, high)).alias("type"))
