"""Spelling variants by pivotal grams.

Two words are near if one inserted, deleted or replaced code point makes one of the other. All pairs of bigrams with their places have a
total order, rare bigrams first. A word's gram prefix is its three first bigrams (and what ties with the third), its pivots are the two
disjoint ones of these with the smallest counts, chosen by dynamic programming. One edit destroys one of two disjoint bigrams at most, so of
two near words, the one whose prefix ends earlier has a pivot that stands in the other's prefix, moved by one place at most.

Pivots meet prefixes in a join. The position limit is made part of the key: the edit lies on one side of the pivot, so on the other side the
words are equal, and the pivot has the same distance to that end in both. The key holds that side's letters, and where they are few,
also one half of the rest: the edit spares the first or the last half. So a key is shared by words with most of their letters in common,
a frequent bigram is no hot group, and candidates grow with the words. Each candidate is verified by its edit distance."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.llm import common as C

#: Code points of a word, its occurrences, and how many times as frequent as a word its form is, at least.
MIN_LETTERS = 6
MIN_COUNT = 5
RATIO = 5
#: Letters, as pattern.
LETTERS = r"[A-Za-zÀ-ÿ]+"
#: Bigrams are counted in this many classes, a bound for what is broadcast whatever the alphabet.
GRAM_CLASSES = 1 << 16
#: Letters on the equal side that make a key on their own.
PLAIN_SIDE = 6

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS) -> DataFrame:
    """(id, word) for each maximal run of at least ``min_letters`` letters, A-Z in lower case. Null and empty texts have none."""
    run = F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(LETTERS), F.lit(0)))
    return (docs.select(F.col(id_col).alias("id"), run.alias("word")).where(F.char_length("word") >= min_letters)
            .withColumn("word", F.translate("word", _UPPER, _LOWER)))


def gram_class(gram: str) -> int:
    return zlib.crc32(gram.encode()) % GRAM_CLASSES


def prefix_and_pivots(word: str, counts: dict[int, int]) -> tuple[list[int], list[int]]:
    """Places of the bigrams in the word's prefix, and of its two pivots."""
    grams = [word[i:i + 2] for i in range(len(word) - 1)]
    cost = [counts.get(gram_class(g), 0) for g in grams]
    order = sorted(range(len(grams)), key=lambda i: (cost[i], grams[i], i))
    last = order[2]
    prefix = sorted(i for i in order if (cost[i], grams[i]) <= (cost[last], grams[last]))
    # From left to right: the cheapest bigram that ends before this one, and the cheapest two disjoint ones so far.
    cheapest, pair, waiting = None, None, []
    for i in prefix:
        while waiting and waiting[0] <= i - 2:
            j = waiting.pop(0)
            if cheapest is None or cost[j] < cost[cheapest]:
                cheapest = j
        if cheapest is not None and (pair is None or cost[cheapest] + cost[i] < cost[pair[0]] + cost[pair[1]]):
            pair = [cheapest, i]
        waiting.append(i)
    return prefix, pair


def gram_keys(word: str, i: int, pivot: bool) -> Iterator[str]:
    """Keys of the bigram at ``i``: what words that are near and keep it share. ``pivot`` tells on which side of the join the word stands."""
    for side, equal, rest in (("<", word[:i + 2], word[i + 2:]), (">", word[i:], word[:i])):
        if len(equal) >= PLAIN_SIDE:
            yield f"{side}{equal}"
            continue
        for longer in (-1, 0, 1):
            # How much longer the pivot's word is; both sides of the join cut the rest of the shorter one in halves.
            shorter = len(rest) - max(0, longer if pivot else -longer)
            if shorter < 0:
                continue
            half = shorter // 2
            start = f"{side}{longer}{equal}"
            yield f"{start}<{shorter}{rest[:half]}"
            yield f"{start}>{shorter}{rest[len(rest) - (shorter - half):]}"


def spelling_variants(words: DataFrame, word_col: str = "word", min_count: int = MIN_COUNT, min_letters: int = MIN_LETTERS,
                      ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each distinct word of ``words`` (one row per occurrence) that has at least ``min_letters`` (4 or
    more) code points and occurs ``n >= min_count`` times.

    ``n_near`` is how many others of these words differ by exactly one inserted, deleted or replaced code point. ``form`` is the most frequent
    of them, the first in code-point order among equals, if it occurs ``ratio`` (2 or more) times as often as the word, else null; ``root`` is where
    forms lead to, the word itself without a form. Words are compared as they are: letter case counts.

    Null and short words are left out. Other columns are not looked at. No rows give no rows."""
    if min_letters < 4 or ratio < 2:
        raise ValueError("words have 4 letters at least, and forms are at least twice as frequent")
    folder = C.workdir(words.sparkSession, "spelling")
    word = F.col(word_col).cast("string")
    known = C.saved(words.select(word.alias("word")).where(F.char_length("word") >= min_letters).groupBy("word").agg(F.count("*").alias("n"))
                    .where(F.col("n") >= min_count), folder, "words")
    grams = known.select(F.explode(F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.substr("word", i, F.lit(2)))).alias("gram"))
    counted = grams.groupBy((F.crc32("gram") % GRAM_CLASSES).alias("class")).count()
    # At most GRAM_CLASSES rows.
    counts = {r["class"]: r["count"] for r in counted.collect()}

    def keyed(pivot: bool):
        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = ([], [], [])
                for w, n in zip(*(c.to_pylist() for c in batch.columns)):
                    prefix, pivots = prefix_and_pivots(w, counts)
                    told = {k for i in (pivots if pivot else prefix) for k in gram_keys(w, i, pivot)}
                    out[0].extend(told)
                    out[1].extend([w] * len(told))
                    out[2].extend([n] * len(told))
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())],
                                                 names=["key", "word", "n"])

        return known.mapInArrow(keys, "key string, word string, n long")

    # All joins by shuffle: Spark takes keys for as small as the words they are made of, and files for as small as they are compressed.
    a, b = keyed(True).alias("a"), keyed(False).hint("merge").alias("b")
    met = a.join(b, F.col("a.key") == F.col("b.key")).where(F.levenshtein("a.word", "b.word", 1) == 1)
    swap = F.col("a.word") > F.col("b.word")
    mine, other = F.struct("a.word", "a.n"), F.struct("b.word", "b.n")
    links = met.select(F.when(swap, other).otherwise(mine).alias("x"), F.when(swap, mine).otherwise(other).alias("y")).distinct()
    both = links.select("x", "y").union(links.select("y", "x"))
    best = F.min(F.when(F.col("y.n") >= ratio * F.col("x.n"), F.struct((-F.col("y.n")).alias("n"), F.col("y.word").alias("form"))))
    near = C.saved(both.groupBy("x").agg(F.count("*").alias("n_near"), best.alias("best"))
                   .select("x.word", "n_near", F.col("best.form").alias("form"), (-F.col("best.n")).alias("form_n")), folder, "near")
    roots = _roots(near.where("form is not null").select("word", F.col("form").alias("root")), folder)
    return (known.join(near.hint("merge"), "word", "left").join(roots.hint("merge"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))


def _roots(forms: DataFrame, folder: str) -> DataFrame:
    """The last word that forms lead to. Each round doubles the steps; a form is more frequent than its word by the ratio, so there is
    no circle and the rounds grow with the logarithm of the logarithm of the largest count."""
    step = 0
    while True:
        onward = forms.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = C.saved(forms.join(onward.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                          folder, f"roots-{step}")
        forms, step = further.select("word", "root"), step + 1
        if further.where("moved").isEmpty():
            return forms
