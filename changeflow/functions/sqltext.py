"""Change events as SQL text. Fields are always in name order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from changeflow.functions.cells import is_nested, is_string, once, sorted_entries, unquote
from changeflow.functions.positions import position_str

# --- fixed values: statement formats ------------------------------------------
PLAIN = {
    "insert": "INSERT INTO `%s`.`%s`(%s) VALUES (%s);",
    "update": "UPDATE `%s`.`%s` SET %s WHERE %s LIMIT 1;",
    "delete": "DELETE FROM `%s`.`%s` WHERE %s LIMIT 1;",
}
HIGHLIGHT = {
    "insert": "\u001B[32mINSERT INTO\u001B[0m `%s`.`\u001B[30;46m%s\u001B[0m`(%s) \u001B[32mVALUES\u001B[0m (%s);",
    "update": "\u001B[33mUPDATE\u001B[0m `%s`.`\u001B[30;46m%s\u001B[0m` \u001B[33mSET\u001B[0m %s \u001B[33mWHERE\u001B[0m %s LIMIT 1;",
    "delete": "\u001B[31mDELETE FROM\u001B[0m `%s`.`\u001B[30;46m%s\u001B[0m` \u001B[31mWHERE\u001B[0m %s LIMIT 1;",
}
INVALID_VALUE = "[InvalidFieldValue]: '%s'"
GTID_MARK = "/* GTID: %s */"
XID_MARK = "/* XID: %s */"
# ------------------------------------------------------------------------------


def _fill(template: str, *values: Column) -> Column:
    """The template with its %s replaced in order; plain concatenation, no format parsing per row."""
    parts: list[Column] = []
    texts = template.split("%s")
    for text, value in zip(texts, (*values, None)):
        parts.append(F.lit(text))
        if value is not None:
            parts.append(value)
    return F.concat(*parts)


def _formats(highlight: bool) -> dict[str, str]:
    return HIGHLIGHT if highlight else PLAIN


def sql_literal(cell: Column, escape: bool = True) -> Column:
    """SQL literal of a cell. Values that are no scalars get the invalid marker."""
    text = unquote(cell)
    if escape:
        text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return (F.when(cell.isNull(), F.lit("NULL"))
            .when(is_string(cell), F.concat(F.lit("'"), text, F.lit("'")))
            .when(is_nested(cell), _fill(INVALID_VALUE, cell))
            .otherwise(cell))


def sql_equal(name: Column, cell: Column, in_where: bool, escape: bool = True) -> Column:
    equal = F.concat(F.lit("`"), name, F.lit("`="), sql_literal(cell, escape))
    if not in_where:
        return equal
    return F.when(cell.isNull(), F.concat(F.lit("`"), name, F.lit("` IS NULL"))).otherwise(equal)


def sql_set(cells: Column, escape: bool = True) -> Column:
    return F.array_join(F.transform(
        sorted_entries(cells), lambda e: sql_equal(e["key"], e["value"], False, escape)), ", ")


def sql_where(cells: Column, escape: bool = True) -> Column:
    return F.array_join(F.transform(
        sorted_entries(cells), lambda e: sql_equal(e["key"], e["value"], True, escape)), " AND ")


def changed_fields(before: Column, after: Column) -> Column:
    """Fields of ``after`` whose value differs from ``before``; a field missing there counts as NULL.

    The two maps are matched by hashing (``map_zip_with``), so wide rows do not cost a search per field.
    """
    joined = F.map_zip_with(before, after, lambda k, b, a: F.struct(a.alias("a"), (~b.eqNullSafe(a)).alias("d")))
    # Only a changed-to-NULL field can be one that ``after`` lacks: look it up just then.
    changed = F.map_filter(joined, lambda k, v: v["d"] & (v["a"].isNotNull() | F.map_contains_key(after, k)))
    return F.transform_values(changed, lambda k, v: v["a"])


def sql_insert(db: Column, table: Column, after: Column, highlight: bool = False, escape: bool = True) -> Column:
    def text(entries: Column) -> Column:
        names = F.array_join(F.transform(entries, lambda e: F.concat(F.lit("`"), e["key"], F.lit("`"))), ", ")
        values = F.array_join(F.transform(entries, lambda e: sql_literal(e["value"], escape)), ", ")
        return _fill(_formats(highlight)["insert"], db, table, names, values)
    return once(sorted_entries(after), text)


def sql_update(db: Column, table: Column, before: Column, after: Column, changed_only: bool = True,
               highlight: bool = False, escape: bool = True, drop_unchanged: bool = False) -> Column:
    """``drop_unchanged`` gives an empty text where there is nothing to set."""
    fields = changed_fields(before, after) if changed_only else after
    template = _formats(highlight)["update"]

    def text(assignments: Column) -> Column:
        return _fill(template, db, table, assignments, sql_where(before, escape))

    if not drop_unchanged:
        return text(sql_set(fields, escape))
    return once(sql_set(fields, escape), lambda s: F.when(F.length(s) == 0, F.lit("")).otherwise(text(s)))


def sql_delete(db: Column, table: Column, before: Column, highlight: bool = False, escape: bool = True) -> Column:
    return _fill(_formats(highlight)["delete"], db, table, sql_where(before, escape))


def sql_tx_mark(event_type: Column, gtid_set: Column, log_name: Column, log_pos: Column) -> Column:
    """Begin / commit marks; null for every other event."""
    return (F.when(event_type == "gtid", _fill(GTID_MARK, gtid_set))
            .when(event_type == "xid", _fill(XID_MARK, position_str(log_name, log_pos))))
