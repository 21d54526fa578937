"""Toxicity by averaged subword embeddings and a linear softmax.

A text is the average of the embeddings of all its subwords: the character n-grams of each word between ``<`` and ``>``, and the word itself,
each hashed to a row of the embedding table. A softmax over a linear layer of that average gives the label. Embeddings and layer are trained
jointly by stochastic gradient descent in numpy, so a misspelling that was never seen shares most of its n-grams with words that were.

Training takes a bounded sample of labelled rows, in one task. Two classes need the difference of the two rows of the layer only, so what a
subword adds to a text's score is one number: the table that is broadcast has one number per row, whatever the width of the embeddings.
Scores are made where the texts are, without a shuffle."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from changeflow.llm import common as C

#: Code points of the n-grams, with the marks at both ends of a word.
SIZES = (3, 4, 5, 6)
#: Rows of the embedding table (a power of two), and width of an embedding.
ROWS = 1 << 18
WIDTH = 8
#: Labelled rows to learn from at most, and bytes of their texts: the first ones by a hash of the id. Whole texts only.
MAX_LABELLED = 6_000
MAX_BYTES = 12 << 20
EPOCHS = 6
BATCH = 32
RATE = 2.5
LAYER_RATE = np.float32(0.4)
LONG = 16.0


class Subwords(NamedTuple):
    """A block's texts as subwords: for each pair of a text and one of its distinct words, the text, the word and how much it counts there,
    which is
    one more than the logarithm of its occurrences, so that a text of one phrase over and over has no longer bag than others; rows of the embedding table of all distinct words end to end, and where each word's begin."""

    text: np.ndarray
    word: np.ndarray
    times: np.ndarray
    rows: np.ndarray
    first: np.ndarray
    counts: np.ndarray


def subwords(texts: C.Texts) -> Subwords:
    words = C.Words(texts, hashes=False)
    codes, distinct = C.word_codes(texts, words)
    owner = np.repeat(np.arange(len(texts)), words.counts())
    pairs, counts = np.unique(owner * max(1, len(distinct)) + codes, return_counts=True)
    times = 1 + np.log(counts)
    letters = pc.utf8_lower(distinct.cast(pa.large_string()))
    lengths = pc.utf8_length(letters).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    ends = np.cumsum(lengths)
    begins = ends - lengths
    # All words end to end as code points, each between its marks.
    points = np.empty(int(lengths.sum()), np.uint64)
    inner = np.ones(len(points), bool)
    inner[begins], inner[ends - 1] = False, False
    points[begins], points[ends - 1] = ord("<"), ord(">")
    points[inner] = np.frombuffer("".join(letters.to_pylist()).encode("utf-32-le"), "<u4")
    values = C.mix(points + np.uint64(0x10FFFF))
    # A word has its n-grams of each size, then itself.
    sizes = np.stack([np.maximum(lengths - n + 1, 0) for n in SIZES] + [np.ones_like(lengths)]) if len(lengths) else np.zeros((len(SIZES) + 1, 0), np.int64)
    counts = sizes.sum(0)
    first = np.cumsum(counts) - counts
    rows = np.empty(int(counts.sum()), np.int32)
    to = first.copy()
    shift = np.uint64(65 - ROWS.bit_length())
    for n, some in zip(SIZES, sizes):
        if some.any():
            rows[C.ranges(to, some)] = (C.rolling_hashes(values, n)[C.ranges(begins, some)] >> shift).astype(np.int32)
        to += some
    if len(lengths):
        rows[to] = (C.span_hashes(values, begins, ends) >> shift).astype(np.int32)
    return Subwords(pairs // max(1, len(distinct)), pairs % max(1, len(distinct)), times, rows, first, counts)


class Bags(NamedTuple):
    """Texts as rows of the embedding table with how often each stands in the text; ``bounds`` cuts them by text."""

    rows: np.ndarray
    times: np.ndarray
    bounds: np.ndarray


def bags(texts: C.Texts) -> Bags:
    found = subwords(texts)
    sizes = found.counts[found.word]
    rows = found.rows[C.ranges(found.first[found.word], sizes)]
    pairs, where = np.unique(np.repeat(found.text, sizes) * ROWS + rows, return_inverse=True)
    times = np.bincount(where, weights=np.repeat(found.times, sizes), minlength=len(pairs))
    return Bags((pairs % ROWS).astype(np.int32), times.astype(np.float32), np.searchsorted(pairs // ROWS, np.arange(len(texts) + 1)))


class Model(NamedTuple):
    """What each row of the embedding table weighs in an average, what it adds to the log-odds of label 1 there, and what these are without it."""

    weight: np.ndarray
    gain: np.ndarray
    bias: float

    def log_odds(self, texts: C.Texts) -> np.ndarray:
        found = subwords(texts)
        if not len(found.first):
            return np.full(len(texts), self.bias)
        of_word = [np.add.reduceat(x[found.rows].astype(np.float64), found.first)[found.word] * found.times for x in (self.weight * self.gain, self.weight)]
        gain, weight = (np.bincount(found.text, weights=x, minlength=len(texts)) for x in of_word)
        return self.bias + gain / np.sqrt(np.where(weight > 0, weight, 1.0))


def _sums(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owner, weights=values[:, j], minlength=n) for j in range(values.shape[1])], 1).astype(np.float32)


def train(parts: list[Bags], labels: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = 5) -> Model:
    """The model of texts with labels 0 and 1, both of which must be there; they weigh as much as each other, however rare one is.

    Embeddings start at zero, so that subwords never seen add nothing. A subword weighs the less the more texts it stands in. An average is
    taken as many times as the root of its weight, as the mean of many subwords strays less: long and short texts learn at one rate."""
    rnd = np.random.default_rng(seed)
    rows, times = (np.concatenate([x[k] for x in parts]) for k in (0, 1))
    bounds = np.concatenate([[0], *(np.diff(x.bounds) for x in parts)]).cumsum()
    n = len(labels)
    weight = np.log((n + 1) / (np.bincount(rows, minlength=ROWS) + 1)).astype(np.float32)
    parts_of = np.repeat(np.arange(n), np.diff(bounds))
    times = times * weight[rows]
    times /= np.sqrt(np.maximum(np.bincount(parts_of, weights=times, minlength=n), 1e-9)).astype(np.float32)[parts_of]
    norm = np.bincount(parts_of, weights=times * times, minlength=n)
    table = np.zeros((ROWS, WIDTH), np.float32)
    layer = rnd.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    # A text with a long bag takes no longer steps than others.
    cost = ((0.5 * n / np.bincount(labels, minlength=2))[labels] / np.maximum(1, norm / LONG)).astype(np.float32)
    target = np.eye(2, dtype=np.float32)[labels]
    batches = -(-n // batch)
    for step in range(epochs * batches):
        if step % batches == 0:
            order = np.array_split(rnd.permutation(n), batches)
        some, now = order[step % batches], np.float32(rate * (1 - step / (epochs * batches)))
        sizes = bounds[some + 1] - bounds[some]
        at = C.ranges(bounds[some], sizes)
        owner, here, share = np.repeat(np.arange(len(some)), sizes), rows[at], times[at][:, None]
        mean = _sums(owner, table[here] * share, len(some))
        odds = mean @ layer + bias
        odds = np.exp(odds - odds.max(1, keepdims=True))
        error = (odds / odds.sum(1, keepdims=True) - target[some]) * cost[some][:, None] / np.float32(len(some))
        back = error @ layer.T
        distinct, where = np.unique(here, return_inverse=True)
        table[distinct] -= now * _sums(where, back[owner] * share, len(distinct))
        layer -= LAYER_RATE * now * (mean.T @ error)
        bias -= LAYER_RATE * now * error.sum(0)
    return Model(weight, table @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def held_out_by_crc(doc_id: Column, parts: int = 5) -> Column:
    """Whether the crc32 of the id, written as text, is divisible by ``parts``."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str, held_out, max_labelled: int, max_bytes: int) -> DataFrame:
    """(rank, label, text) of the labelled texts to learn from, by rank."""
    told = (labels.select(F.col(label_id).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
            .where(F.col("label").isin(0, 1) & F.col("id").isNotNull()).where(~held_out(F.col("id"))).distinct()
            .orderBy(F.xxhash64("id"), "id", "label").limit(max_labelled))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # At most max_labelled rows of two numbers.
    found = (texts.join(F.broadcast(told), "id").withColumn("bytes", F.octet_length("text")).where(F.col("bytes") <= max_bytes // 8)
             .select(F.xxhash64("id", "text", "label").alias("rank"), "label", "text", "bytes"))
    first = found.groupBy("rank").agg(F.max("bytes").alias("bytes")).orderBy("rank").limit(max_labelled).collect()
    total, last = 0, None
    for r in first:
        total += r["bytes"]
        if total > max_bytes:
            break
        last = r["rank"]
    return found.where(F.col("rank") <= F.lit(last).cast("long")).dropDuplicates(["rank"]).select("rank", "label", "text")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic",
        held_out=held_out_by_crc, max_labelled: int = MAX_LABELLED, max_bytes: int = MAX_BYTES, epochs: int = EPOCHS) -> Model:
    """A model of the rows of ``docs`` that ``labels`` has a label 0 or 1 for and that are not held out: at most ``max_labelled`` texts with
    ``max_bytes`` together, the first ones by a hash; texts above an eighth of that are not learned from. Other labels and null ids are
    passed over; repeated rows count once. Without labels, or with one label only, the model gives that label (or 0) to every text."""
    sample = _sample(docs, labels, id_col, text_col, label_id, label_col, held_out, max_labelled, max_bytes)

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held)
        y = rows["label"].to_numpy().astype(np.int64)
        if len(np.unique(y)) == 2:
            model = train([bags(t) for t in C.texts_of(iter(rows.select(["rank", "text"]).to_batches()), C.CHUNK_BYTES)], y, epochs)
        else:
            model = Model(np.zeros(ROWS, np.float32), np.zeros(ROWS, np.float32), np.inf if y[0] else -np.inf)
        yield pa.RecordBatch.from_pydict({"weight": [model.weight.tobytes()], "gain": [model.gain.astype(np.float32).tobytes()], "bias": [float(model.bias)]})

    # A bounded sample, hence one task; its result has ROWS numbers twice.
    told = sample.repartition(1).sortWithinPartitions("rank").mapInArrow(trained, "weight binary, gain binary, bias double").collect()
    if not told:
        return Model(np.zeros(ROWS, np.float32), np.zeros(ROWS, np.float32), -np.inf)
    return Model(np.frombuffer(told[0].weight, np.float32), np.frombuffer(told[0].gain, np.float32), told[0].bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = C.CHUNK_BYTES) -> DataFrame:
    """(id, score, predicted) for each row of ``docs``: the probability of label 1 of the whole text, and 1 if it is 0.5 or more, else 0.

    Null texts are empty, and empty texts have the score of the bias. Ids may be null or repeated and are not looked at, nor are other
    columns; repeated rows give repeated rows. No rows give no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in C.texts_of(batches, chunk_bytes):
            odds = np.clip(shared.value.log_odds(texts), -700, 700)
            share = 1 / (1 + np.exp(-odds))
            yield pa.RecordBatch.from_arrays([pa.array(texts.ids), pa.array(share), pa.array((share >= 0.5).astype(np.int32))], names=["id", "score", "predicted"])

    return C.text_column(docs, id_col, text_col).mapInArrow(scored, "id long, score double, predicted int").withColumn("id", C.id_or_null())
