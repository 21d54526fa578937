"""Quality rules with adaptive thresholds, by DataFrame functions only.

Every document gets a few counts in one pass over its text. In place of fixed cutoffs, each language and source gets thresholds
from quantile sketches of the corpus itself: logarithmic histograms with a bounded relative error, kept as rows
(group, metric, bucket, count). Sketches merge by adding counts, in any order and with the same result: a hot source is a few
hundred rows per task before the shuffle. The sketch of a language is merged into that of each of its sources with a fixed weight, and
that of all into that of each language, so a small group follows its language and a large one itself, without a switch between
them. A document is rejected where it lies far outside the middle half of its group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from changeflow.llm import common as C

SYMBOLS = "[^#*$%&|<>]+"

#: Relative error of a quantile.
ERROR = 0.01
#: Values below it count as zero.
LEAST = 1e-4
#: Documents that the sketch of a language counts for in that of its sources, and the sketch of all in that of a language.
PRIOR_DOCS = 100
#: Distance from the nearer quartile, in spreads, beyond which a document is an outlier.
FENCE = 4.0

#: Metric, least spread between the quartiles to reckon with, and whether low values are outliers too.
METRICS = {
    "symbols_per_word": (0.05, False),
    "chars_per_word": (0.75, True),
    "dup_line_share": (0.1, False),
    "repeat_word_share": (0.1, False),
}


def _with(value: Column, f) -> Column:
    """``f`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words covered by runs of three words that are found twice or more; runs are told apart by 64-bit hashes.
    Only texts with a repeated run have their runs sorted."""
    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def starts(ordered: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(ordered, j)["run"] == x["run"], F.lit(False))
        return F.sort_array(F.transform(F.filter(ordered, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["at"]))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)

    def of_runs(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("run"), i.alias("at")))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _with(_with(F.sort_array(placed), starts), covered)).otherwise(0)

    return F.when(n >= 4, _with(runs, of_runs)).otherwise(0)


def counts(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words; null counts as empty."""

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
                        _repeat_words(words).cast("long").alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    text = F.coalesce(text.cast("string"), F.lit(""))
    words = C.word_array(text)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(_with(words, of_words).alias("w"), _with(lines, of_lines).alias("l"),
                    F.char_length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"))


def measured(docs: DataFrame, text_col: str, keys: list[Column]) -> DataFrame:
    """``keys`` and the counts of each document."""
    return docs.select(*keys, counts(F.col(text_col)).alias("c")).select(
        "*", F.col("c.w.n_words").alias("n_words"), F.col("c.w.word_chars").alias("word_chars"), F.col("c.n_symbols").alias("n_symbols"),
        F.col("c.l.n_lines").alias("n_lines"), F.col("c.l.n_dup_lines").alias("n_dup_lines"), F.col("c.w.n_repeat_words").alias("n_repeat_words")).drop("c")


def _metric(name: str) -> Column:
    """The metric ``name`` of a document; null for one without words or lines, in ANSI mode too. Spark may compute it for rows that fail without it."""
    part, whole = {"symbols_per_word": ("n_symbols", "n_words"), "chars_per_word": ("word_chars", "n_words"),
                   "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_word_share": ("n_repeat_words", "n_words")}[name]
    return F.try_divide(F.col(part), F.col(whole))


_STEP = (1 + ERROR) / (1 - ERROR)


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n): quantile sketches per language and source, of documents with words."""
    each = F.array(*(F.struct(F.lit(m).alias("metric"), _metric(m).alias("value")) for m in METRICS))
    values = rows.where("n_words > 0").select("lang", "source", F.inline(each))
    bucket = F.when(F.col("value") < LEAST, F.lit(-10_000)).otherwise(F.ceil(F.log(F.col("value")) / F.log(F.lit(_STEP))).cast("int"))
    return values.groupBy("lang", "source", "metric", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, docs, fences per metric) of merged sketches; a window sees the buckets of one group and metric."""
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "metric")
    ranked = merged.withColumn("upto", F.sum("n").over(w.orderBy("bucket"))).withColumn("docs", F.max("upto").over(w))
    value = F.when(F.col("bucket") == -10_000, 0.0).otherwise(F.pow(F.lit(_STEP), F.col("bucket")) * 2 / (1 + _STEP))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("docs"), value))  # noqa: E731  values grow with the buckets
    per = ranked.groupBy(*keys, "metric").agg(F.max("docs").alias("docs"), at(0.25).alias("q1"), at(0.75).alias("q3"))
    least = F.create_map(*(x for m, (spread, _) in METRICS.items() for x in (F.lit(m), F.lit(spread))))
    spread = F.greatest(F.col("q3") - F.col("q1"), least[F.col("metric")])
    per = per.select(*keys, "metric", "docs", (F.col("q1") - FENCE * spread).alias("low"), (F.col("q3") + FENCE * spread).alias("high"))
    return per.groupBy(*keys).agg(F.max("docs").alias("docs"), *(
        F.max(F.when(F.col("metric") == m, F.struct("low", "high"))).alias(m) for m in METRICS))


def _blended(sketch: DataFrame, keys: list[str], parent: DataFrame, prior_docs: int) -> DataFrame:
    """(keys, metric, bucket, n, share): sketches of the groups ``keys`` with ``parent`` merged in, which then weighs ``prior_docs`` documents.
    ``parent`` has the keys but the last, and ``share``, the part of its documents in a bucket. A sum has one whole number and one
    part of the parent, so it is the same in any order."""
    above = parent.select(*(F.col(k).alias(f"of_{k}") for k in keys[:-1]), F.col("metric").alias("of_metric"), "bucket", "share")
    groups = sketch.select(*keys, "metric").distinct()
    met = F.col("metric") == F.col("of_metric")
    for k in keys[:-1]:
        met &= F.col(k).eqNullSafe(F.col(f"of_{k}"))
    given = groups.join(above, met).select(*keys, "metric", "bucket", F.lit(0).cast("long").alias("n"), "share")
    both = sketch.select(*keys, "metric", "bucket", "n", F.lit(0.0).alias("share")).unionByName(given)
    merged = both.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"), F.max("share").alias("share"))
    docs = F.sum("n").over(Window.partitionBy(*keys, "metric"))
    weight = F.col("n") + prior_docs * F.col("share")
    return merged.select(*keys, "metric", "bucket", weight.alias("n"), (weight / (docs + prior_docs)).alias("share"))


def thresholds(sketch: DataFrame, prior_docs: int = PRIOR_DOCS) -> DataFrame:
    """(lang, source, fences per metric): a row for each group, from its sketch with those of its language and of all merged in."""
    of_all = sketch.groupBy("metric", "bucket").agg(F.sum("n").alias("n"))
    of_all = of_all.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("metric")))
    of_lang = _blended(sketch.groupBy("lang", "metric", "bucket").agg(F.sum("n").alias("n")), ["lang"], of_all, prior_docs)
    got = _quartiles(_blended(sketch, ["lang", "source"], of_lang, prior_docs), ["lang", "source"])
    return got.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), F.struct(*METRICS).alias("t"))


def judged(rows: DataFrame, prior_docs: int = PRIOR_DOCS) -> DataFrame:
    """``rows`` of ``measured`` (with lang and source) and base_failed, kept."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    outside = lambda m: (_metric(m) > F.col(f"t.{m}.high")) | (F.lit(METRICS[m][1]) & (_metric(m) < F.col(f"t.{m}.low")))
    odd = F.greatest(*(F.coalesce(outside(m), F.lit(False)) for m in METRICS))
    limits = thresholds(sketches(rows), prior_docs)
    met = rows.join(limits, rows.lang.eqNullSafe(limits.t_lang) & rows.source.eqNullSafe(limits.t_source), "left")
    return met.withColumn("base_failed", base).withColumn("kept", ~base & ~odd).drop("t_lang", "t_source", "t")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
            prior_docs: int = PRIOR_DOCS) -> DataFrame:
    """(id, lang, source, mark, counts, base_failed, kept) for each row of ``docs``. ``mark`` is a hash of the text.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated runs of three. ``kept``: not
    ``base_failed``, and no metric outside the fences of its language and source. Null languages and sources are groups like others; a null
    text counts as empty and fails. Ids are passed through, repeated rows are judged alike. Other columns are
    not looked at. No rows give no rows."""
    folder = C.workdir(docs.sparkSession, "quality")
    keys = [F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"),
            text_mark(F.col(text_col)).alias("mark")]
    return judged(C.saved(measured(docs, text_col, keys), folder, "counts"), prior_docs)


def text_mark(text: Column) -> Column:
    return F.xxhash64(text)


def filter_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns."""
    good = quality(docs, id_col, text_col, lang_col, source_col).where("kept").select("id", "lang", "source", "mark").distinct()
    same = lambda a, b: a.eqNullSafe(b)
    return docs.join(good, same(docs[id_col], good.id) & same(docs[lang_col].cast("string"), good.lang)
                     & same(docs[source_col].cast("string"), good.source) & same(text_mark(docs[text_col]), good.mark), "left_semi")
