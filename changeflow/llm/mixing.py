"""Mixing sources to target weights by Pareto order sampling, by DataFrame functions only.

The mix is as large as the corpus. Weights give each source a target, capped at a multiple of its size; what a cap leaves over is
shared again by weight. Within its source every document is due target / size copies: the whole ones are certain, and
the rest is a sample of fixed size in words. For it the documents are ranked by the odds of a random number, divided by
the odds of inclusion (which differ from source to source), and taken from the top until the target is reached. The last
place goes to the document that fits the gap best.

No source is sorted as a whole: the rank at which it is full is found in a histogram of ranks, then in a finer one within one
bar, and at last among the few rows of one bar of that. Random numbers come from hashes of id and text, so reruns agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from changeflow.llm import common as C

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source is repeated so often at most.
MAX_COPIES = 3
_BITS, _BAR = 52, 14


def word_count(text: Column) -> Column:
    return F.size(C.word_array(F.coalesce(text.cast("string"), F.lit("")))).cast("long")


def uniform(id_: Column, text: Column, seed: int) -> Column:
    """A number in (0, 1) from the id and the text."""
    name = F.concat_ws("|", F.lit(str(seed)), F.coalesce(id_.cast("string"), F.lit("")), F.md5(F.coalesce(text.cast("string"), F.lit(""))))
    return (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << _BITS))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from rows (source, size). Sources are few, one row each; the windows see only those.

    Sources reach their cap in the order of size by weight. One is capped if the level of what is left, without the
    caps before it, is above its own; the first that is not sets the level of all that follow."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int"))
    full = Window.orderBy("by_weight", F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (sizes.withColumn("weight", weight.cast("double")).withColumn("cap", (F.col("source_size") * max_copies).cast("double"))
              .withColumn("by_weight", F.col("cap") / F.col("weight"))
              .withColumn("left", F.sum("source_size").over(Window.partitionBy()).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("weights", F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("level", F.col("left") / F.col("weights")).withColumn("capped", F.col("level") >= F.col("by_weight")))
    level = F.min(F.when(~F.col("capped"), F.struct("by_weight", "source", "level"))).over(Window.partitionBy())["level"]
    return ranked.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(level * F.col("weight")).alias("target"))


def _rank(u: Column, share: Column) -> Column:
    """Pareto rank as a whole number: the odds of ``u`` over the odds of inclusion, brought from (0, inf) to (0, 2^52)."""
    odds = u / (1 - u) * ((1 - share) / share)
    return F.floor(odds / (1 + odds) * float(1 << _BITS)).cast("long")


def _filled(bars: DataFrame, bar: str) -> DataFrame:
    """(source, bar, before) of the bar in which a source's words first exceed ``rest``; none where they never do."""
    w = Window.partitionBy("source").orderBy(bar)
    upto = bars.withColumn("upto", F.sum("words").over(w))
    return upto.where("upto > rest").groupBy("source").agg(F.min_by(F.struct(bar, (F.col("upto") - F.col("words")).alias("before"), "rest"), bar).alias("f")).select("source", "f.*")


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target, whole, share, cut, extra): how to take from each source. A row gets ``whole`` copies, and
    one more if its rank is below ``cut`` or equal to ``extra``."""
    base = targets(rows, weights, max_copies)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    base = base.withColumn("whole", whole.cast("long")).withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    base = base.withColumn("share", F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")).otherwise(0.0))
    ranked = _meet(rows, base.select("source", "rest", "share")).where("share > 0").select("source", "size", "rest", _rank(F.col("u"), F.col("share")).alias("rank"))
    wide = F.shiftright("rank", _BITS - _BAR)
    fine = F.shiftright("rank", _BITS - 2 * _BAR)
    one = _filled(ranked.groupBy("source", "rest", wide.alias("bar")).agg(F.sum("size").alias("words")), "bar")
    inside = _meet(ranked.drop("rest"), one).where(wide == F.col("bar")).withColumn("rest", F.col("rest") - F.col("before"))
    two = _filled(inside.groupBy("source", "rest", fine.alias("fine")).agg(F.sum("size").alias("words")), "fine")
    last = _meet(inside.select("source", "rank", "size"), two).where(fine == F.col("fine")).withColumn("rest", F.col("rest") - F.col("before"))
    three = _filled(last.groupBy("source", "rest", "rank").agg(F.sum("size").alias("words")), "rank")
    cut = three.select(F.col("source").alias("s"), F.col("rank").alias("cut"), (F.col("rest") - F.col("before")).alias("gap"))
    # The rows of the first rank that does not fit stay out; the document whose size is nearest to the gap fills it.
    out = _meet(ranked.select("source", "rank", "size"), cut.withColumnRenamed("s", "source")).where((F.col("rank") >= F.col("cut")) & (F.col("size") > 0))
    extra = out.groupBy("source").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "rank", "gap")).alias("e")).where("e.off < e.gap")
    extra = extra.select(F.col("source").alias("x"), F.col("e.rank").alias("extra"))
    # Without a cut all rows fit: nothing is ranked beyond them.
    return base.join(cut.drop("gap"), base.source.eqNullSafe(F.col("s")), "left").join(extra, base.source.eqNullSafe(F.col("x")), "left").select(
        "source", "source_size", "target", "whole", "share", F.when(F.col("share") > 0, F.coalesce("cut", F.lit(1 << 53))).otherwise(0).alias("cut"), "extra")


def _meet(rows: DataFrame, few: DataFrame) -> DataFrame:
    """Rows with what is known of their source. A row per source is small; Spark sees its size, and splits a hot source
    if it does not broadcast."""
    few = few.withColumnRenamed("source", "of_source")
    return rows.join(few, rows.source.eqNullSafe(few.of_source)).drop("of_source")


def _copies() -> Column:
    rank = F.when(F.col("share") > 0, _rank(F.col("u"), F.col("share")))
    return F.col("whole") + F.coalesce((rank < F.col("cut")) | (rank == F.coalesce("extra", F.lit(-1))), F.lit(False)).cast("long")


def _units(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    return [F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), uniform(F.col(id_col), F.col(text_col), seed).alias("u")]


def mix_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
              max_copies: int = MAX_COPIES, seed: int = 7) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) for each row of ``docs``; ``taken`` is words, repeats counted.

    A null or empty text has no words and takes none. A null source is a source, the last by name. Rows alike in id and text share
    their random number, so they are taken alike. Null ids are an id like any other. Other columns are not looked at. No rows
    give no rows."""
    folder = C.workdir(docs.sparkSession, "mixing")
    rows = C.saved(docs.select(F.col(id_col).alias("id"), *_units(docs, id_col, text_col, source_col, seed)), folder, "sizes")
    return _meet(rows, C.saved(plan(rows, weights, max_copies), folder, "plan")).withColumn("copies", _copies()).select(
        "id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
        max_copies: int = MAX_COPIES, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as ``mix_sizes`` takes it. Texts are not shuffled."""
    folder = C.workdir(docs.sparkSession, "mixing")
    rows = C.saved(docs.select(*_units(docs, id_col, text_col, source_col, seed)), folder, "sizes")
    known = C.saved(plan(rows, weights, max_copies).select(F.struct("source", "whole", "share", "cut", "extra").alias("mix_plan")), folder, "plan")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    held = docs.select(row.alias("row"), F.col(source_col).cast("string").alias("source"), uniform(F.col(id_col), F.col(text_col), seed).alias("u"))
    met = held.join(known, held.source.eqNullSafe(F.col("mix_plan.source"))).select("row", "u", "mix_plan.*")
    return met.withColumn("n", F.explode(F.array_repeat(F.lit(0), _copies().cast("int")))).select("row.*")
