"""Compare-with-previous over long histories, without one task per key.

A plain window partitioned by the key puts the whole history of a hot key into one task. Here each
history is cut into spans of the order column; a span's rows are one window partition, and the value that
enters a span comes from a summary with one row per span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from changeflow.functions.numbers import span_of


def span_ends(df: DataFrame, keys: Sequence[str], span: str, order: Sequence[Column], values: Column) -> DataFrame:
    """``(*keys, span, _carried)``: ``values`` of the last row before each span, null for a key's first."""
    last = (df.groupBy(*keys, span)
            .agg(F.max_by(values, F.struct(*order)).alias("_last")))
    spans = Window.partitionBy(*keys).orderBy(span)
    return last.select(*keys, span, F.lag("_last").over(spans).alias("_carried"))


def as_of(rows: DataFrame, known: DataFrame, keys: Sequence[str], at: Column, known_at: Column, values: Column, name: str, span_length: int) -> DataFrame:
    """Adds ``name``: the struct ``values`` of the key's last row in ``known`` whose ``known_at`` is not after ``at``, null before the
    first. Both times are whole numbers. Of several known at one time the greatest struct counts.

    Rows and what is known are merged in spans of time; what is known at a span's start comes from a summary with a row per span."""
    at_once = known.select(*keys, known_at.alias("_at"), values.alias("_known")).groupBy(*keys, "_at").agg(F.max("_known").alias("_known"))
    row = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    both = rows.select(*keys, at.alias("_at"), row.alias("_row")).unionByName(at_once, allowMissingColumns=True)
    both = both.withColumn("_span", span_of(F.col("_at"), span_length))
    ends = both.groupBy(*keys, "_span").agg(F.max_by("_known", F.when(F.col("_known").isNotNull(), F.col("_at"))).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_span", F.last("_end", True).over(before).alias("_carried"))
    inside = Window.partitionBy(*keys, "_span").orderBy("_at", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    met = both.join(carried, [*keys, "_span"]).withColumn(name, F.coalesce(F.last("_known", True).over(inside), F.col("_carried")))
    return met.where(F.col("_row").isNotNull()).select("_row.*", name)


def with_previous(df: DataFrame, keys: Sequence[str], span: Column, order: Sequence[Column],
                  values: Column, name: str) -> DataFrame:
    """Adds ``name``: the struct ``values`` of the previous row of the same key, null for its first row.

    ``order`` must be total within a key and ``span`` must not decrease along it.
    """
    spanned = df.withColumn("_span", span)
    carried = span_ends(spanned, keys, "_span", order, values)
    inside = Window.partitionBy(*keys, "_span").orderBy(*order)
    return (spanned.join(carried, [*keys, "_span"])
            .withColumn(name, F.coalesce(F.lag(values).over(inside), F.col("_carried")))
            .drop("_span", "_carried"))
