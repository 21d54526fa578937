"""Cells: JSON texts of scalars, the one form in which row values travel.

Every number and string text is made here, so that all operators agree on them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from changeflow import schema as S

_NEEDS_ESCAPE = r'["\\\x00-\x1f]'


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated a single time, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def quote(text: Column) -> Column:
    """Text as a JSON string."""
    array = F.to_json(F.array(text))
    return F.when(text.rlike(_NEEDS_ESCAPE), array.substr(F.lit(2), F.length(array) - 2)).otherwise(
        F.concat(F.lit('"'), text, F.lit('"')))


def unquote(cell: Column) -> Column:
    """Text of a JSON string. Only cells with an escape in them are parsed."""
    return F.when(F.instr(cell, "\\") == 0, cell.substr(F.lit(2), F.length(cell) - 2)).otherwise(
        F.try_parse_json(cell).cast("string"))


def is_string(cell: Column) -> Column:
    return F.startswith(cell, F.lit('"'))


def is_nested(cell: Column) -> Column:
    return F.startswith(cell, F.lit("{")) | F.startswith(cell, F.lit("["))


def cell_text(cell: Column) -> Column:
    """Plain text of a cell: strings without quotes, everything else as it is, null for NULL."""
    return F.when(is_string(cell), unquote(cell)).otherwise(cell)


def cells_of_variants(values: Column) -> Column:
    """``map<string,variant>`` -> cell map. A JSON null becomes NULL, the string "null" does not."""
    return F.transform_values(values, lambda _, v: F.when(~F.is_variant_null(v), F.to_json(v)))


def parse_cells(text: Column) -> Column:
    """JSON object text -> cell map; null or malformed text gives null."""
    return F.when(text == "{}", S.empty_cells()).otherwise(cells_of_variants(F.from_json(text, "map<string,variant>")))


def sorted_entries(cells: Column) -> Column:
    return F.sort_array(F.map_entries(cells))


def sorted_cells(cells: Column) -> Column:
    return F.map_from_entries(sorted_entries(cells))


def cells_json(cells: Column) -> Column:
    """Cell map -> JSON object text with its keys sorted."""
    pairs = lambda name: F.array_join(F.transform(sorted_entries(cells), lambda e: F.concat(
        name(e["key"]), F.lit(":"), F.coalesce(e["value"], F.lit("null")))), ",")
    # One look at all names tells whether any needs an escape; most do not.
    plain = pairs(lambda key: F.concat(F.lit('"'), key, F.lit('"')))
    return F.concat(F.lit("{"), F.when(F.size(cells) == 0, "").when(
        F.array_join(F.map_keys(cells), "").rlike(_NEEDS_ESCAPE), pairs(quote)).otherwise(plain), F.lit("}"))


def _trim_zeros(text: Column) -> Column:
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def cell_of(column: Column, dtype: T.DataType) -> Column:
    """Cell of a typed column."""
    text = column.cast("string")
    if isinstance(dtype, T.DecimalType):
        return _trim_zeros(text) if dtype.scale > 0 else text
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        plain = F.when(text.contains("E"), text).otherwise(_trim_zeros(text))
        return F.when(text.isin("NaN", "Infinity", "-Infinity"), quote(text)).otherwise(plain)
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return text
    if isinstance(dtype, T.BinaryType):
        return quote(F.decode(column, "UTF-8"))
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(column)
    return quote(text)


def cells_of(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """Cell map of a row's typed columns, keys in name order."""
    names = sorted(df.columns if columns is None else columns)
    pairs: list[Column] = []
    for name in names:
        pairs += [F.lit(name), cell_of(df[f"`{name}`"], df.schema[name].dataType)]
    return F.create_map(*pairs).cast("map<string,string>")


def typed_cell(cell: Column, dtype: T.DataType) -> Column:
    """The value of a cell in a type; null where it does not fit."""
    text = F.when(cell.startswith('"'), unquote(cell)).otherwise(cell)
    if isinstance(dtype, T.BinaryType):
        return F.encode(text, "UTF-8")
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(cell, dtype)
    return text.try_cast(dtype)


def decode_base64(cells: Column, names: Iterable[str]) -> Column:
    """Binary cells arrive as base64 strings on the wire; turn the named ones into their text."""
    wanted = list(names)
    return F.transform_values(cells, lambda k, v: F.when(
        k.isin(*wanted) & v.isNotNull(), quote(F.decode(F.unbase64(unquote(v)), "UTF-8"))).otherwise(v))


def encode_base64(cells: Column, names: Iterable[str]) -> Column:
    """The reverse of :func:`decode_base64`."""
    wanted = list(names)
    return F.transform_values(cells, lambda k, v: F.when(
        k.isin(*wanted) & v.isNotNull(),
        F.concat(F.lit('"'), F.base64(F.encode(unquote(v), "UTF-8")), F.lit('"'))).otherwise(v))
