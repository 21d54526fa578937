"""Filters and projections on change events."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from changeflow import schema as S
from changeflow.functions.cells import once
from changeflow.functions.positions import log_number, log_seq, position_key

#: Server, log file, offset.
Position = tuple[int, str, int]


def only_dbs(changes: DataFrame, dbs: Iterable[str]) -> DataFrame:
    """Row events of the listed databases, in any letter case; an empty list keeps all. Other events pass."""
    names = sorted({d.lower() for d in dbs})
    if not names:
        return changes
    return changes.where(~S.is_row_event() | F.lower("db").isin(*names))


def only_types(changes: DataFrame, types: Iterable[str]) -> DataFrame:
    return changes.where(F.col("event_type").isin(*types))


def skip_no_pk(changes: DataFrame) -> DataFrame:
    return changes.where(F.size("primary") > 0)


def match_rules(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds the struct ``rule`` of the event's table; events without a rule are dropped.

    Names compare exactly. No broadcast hint: rules made from a list or a small file have a known size,
    so Spark broadcasts them; a rules table beyond the threshold is joined by shuffling.
    """
    others = [c for c in rules.columns if c not in ("db", "table")]
    return changes.join(rules.select("db", "table", F.struct(*others).alias("rule")), ["db", "table"])


def keep_fields(cells: Column, names: Column) -> Column:
    """Null list keeps every field, an empty one none."""
    return F.when(names.isNull(), cells).otherwise(
        F.map_filter(cells, lambda k, v: F.array_contains(names, k)))


def rename_fields(cells: Column, mapping: Column) -> Column:
    """Renamed where ``mapping`` has the name. Of two fields with one new name, the last in name order wins."""
    def new_name(name: Column) -> Column:
        return F.coalesce(F.element_at(mapping, name), name)

    def settled() -> Column:
        entries = F.transform(F.sort_array(F.map_entries(cells)), lambda e: F.struct(
            new_name(e["key"]).alias("key"), e["value"].alias("value")))
        return once(entries, lambda all_: F.map_from_entries(F.filter(all_, lambda e, i: ~F.exists(
            F.slice(all_, i + 2, F.size(all_)), lambda later: later["key"] == e["key"]))))

    def renamed(names: Column) -> Column:
        clash = F.size(F.array_distinct(names)) < F.size(names)
        return F.when(clash, settled()).otherwise(F.map_from_arrays(names, F.map_values(cells)))

    none = mapping.isNull() | (F.size(mapping) == 0)
    return F.when(none, cells).otherwise(once(F.transform(F.map_keys(cells), new_name), renamed))


def drop_empty(encoded: DataFrame, value: str = "value") -> DataFrame:
    """Drops events for which an encoder gave no bytes."""
    return encoded.where(F.length(value) > 0)


def changes_since(changes: DataFrame, positions: DataFrame | Sequence[Position], latest: bool = False) -> DataFrame:
    """Events after the saved position of their server (``server_id, log_name, log_pos``).

    ``latest``, no saved position, an empty name or offset 0 mean "from now on": no rows of a batch.

    Positions given as a list become a plain filter, so that a log laid out by server and file is read from the
    saved files on; fit for some hundred servers. A DataFrame is joined on ``server_id``, which prunes by server.
    """
    if latest:
        return changes.where(F.lit(False))
    seq = log_seq(F.col("log_name"))
    if not isinstance(positions, DataFrame):
        known = [(server, name, pos) for server, name, pos in positions if name and pos]
        if not known:
            return changes.where(F.lit(False))
        files, events = [], []
        for server, name, pos in known:
            at = log_number(name)
            files.append((F.col("server_id") == server) & (seq >= at))
            events.append((F.col("server_id") == server) & ((seq > at) | ((seq == at) & (F.col("log_pos") > pos))))
        return changes.where(reduce(or_, files)).where(reduce(or_, events))
    saved = (positions.where((F.length("log_name") > 0) & (F.col("log_pos") != 0))
             .select("server_id", position_key(F.col("log_name"), F.col("log_pos")).alias("_saved")))
    return (changes.join(saved, "server_id")
            .where(position_key(F.col("log_name"), F.col("log_pos")) > F.col("_saved"))
            .select(*changes.columns))
