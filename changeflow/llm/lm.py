"""LM scoring with a weighted backoff automaton.

The model is a smoothed n-gram model in automaton form. A state is a history of words; an arc for a word that followed it
carries its log-probability and leads to the next history; a failure arc carries the backoff weight to the shorter history. At the
root every word has an arc, unseen words share one. Smoothing is a Dirichlet prior: a history seen h times
gives the next word (count + K * shorter) / (h + K), so its failure arc weighs K / (h + K), and only counts of n-grams
are needed: every count is a sum that meets in map-side sums.

The automaton of a whole corpus fits no executor. It is laid out by hash over the shuffle's buckets; each block of documents asks for
the arcs that its own texts can take, which are the n-grams in them, and builds that part of the automaton. All its
texts are then traversed side by side from left to right, each once, carrying a state and adding log-probabilities."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.llm import common as C

#: Words of an n-gram, and the weight of the shorter history.
ORDER = 2
PRIOR = 50.0
#: Bytes of text in a block: larger blocks share more n-grams and ask for less.
LM_BLOCK_BYTES = 6 << 20
#: Every text ends with this token, and starts in this history.
END, START = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC3A5C85C97CB3127)


def held_out_by_crc(ids: np.ndarray, parts: int = 7, part: int = 2) -> np.ndarray:
    """Whether the crc32 of the id, written as text, leaves ``part`` when divided by ``parts``."""
    return np.array([i != C.NULL_ID and zlib.crc32(str(i).encode()) % parts == part for i in ids.tolist()], bool)


class Grams:
    """Tokens of a block's texts, with the end of each, and the keys of the n-grams that end at each token."""

    def __init__(self, texts: C.Texts, order: int):
        words = C.Words(texts, lower=True)
        counts = words.counts()
        self.sizes = counts + 1
        self.first = np.cumsum(self.sizes) - self.sizes
        tokens = np.empty(int(self.sizes.sum()), np.uint64)
        tokens[np.repeat(self.first, counts) + C.ranges(np.zeros(len(counts), np.int64), counts)] = words.hashes
        tokens[self.first + counts] = END
        self.tokens = tokens
        self.place = C.ranges(np.zeros(len(counts), np.int64), self.sizes)
        # keys[n] is of the n + 1 tokens up to a place; before the first word stands the start, and before it nothing.
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[self.first] = START
        self.keys = [C.mix(tokens ^ np.uint64(0x51ED270B))]
        shifted = before
        for n in range(1, order):
            longer = C.mix(self.keys[-1] * np.uint64(0x9E3779B97F4A7C15) ^ shifted ^ np.uint64(n))
            # A history cannot reach beyond the start.
            self.keys.append(np.where(self.place >= n - 1, longer, np.uint64(0)))
            held = shifted
            shifted = np.empty_like(held)
            shifted[1:] = held[:-1]
            shifted[self.first] = 0


def _asked(grams: Grams, training: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of all n-grams of a block, and how often each is in its training texts."""
    in_training = np.repeat(training, grams.sizes)
    keys = np.concatenate([k[k != 0] for k in grams.keys])
    known = np.concatenate([in_training[k != 0] for k in grams.keys])
    values, where = np.unique(keys, return_inverse=True)
    return values, np.bincount(where, weights=known, minlength=len(values)).astype(np.int64)


def _small(counts: np.ndarray) -> bytes:
    """Counts in as few bytes as the largest needs."""
    width = next(w for w in (1, 2, 4, 8) if not len(counts) or int(counts.max()) < 1 << (8 * w))
    return bytes([width]) + pa.Codec("zstd", compression_level=1).compress(counts.astype(f"<u{width}"), asbytes=True) if len(counts) else b""


def _counts(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    width = blob[0]
    return np.frombuffer(pa.Codec("zstd").decompress(blob[1:], decompressed_size=n * width, asbytes=True), f"<u{width}").astype(np.int64)


def _summed(rows: list[dict]) -> list[bytes]:
    """The corpus counts of each row's keys."""
    keys = [C.unpacked_keys(r["keys"]) for r in rows]
    sizes = [len(k) for k in keys]
    own = np.concatenate([_counts(r["counts"], n) for r, n in zip(rows, sizes)])
    every, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(where, weights=own, minlength=len(every)).astype(np.int64)[where]
    return [_small(x) for x in np.split(total, np.cumsum(sizes)[:-1])]


class Automaton:
    """The part of the model that a block's texts can reach.

    For each place and length of history: whether the history is a state, the weight of its failure arc, and the weight of its arc
    for the place's token, if there is one. The state that a traversal carries to a place is the longest history
    before it that is a state; it depends on the last tokens only, so numpy finds the states of all places in
    one pass over the texts, in place of a loop over tokens."""

    def __init__(self, counts: list[np.ndarray], grams: Grams, n_texts: int, total: int, distinct: int, prior: float):
        self.grams = grams
        self.root = np.log10((counts[0] + 1) / (total + distinct + 1))
        self.states, self.failures, self.arcs = [], [], []
        weight = self.root
        for n in range(1, len(counts)):
            history = np.empty(len(grams.tokens), np.int64)
            history[1:] = counts[n - 1][:-1]
            # Before a text's first token stands the start, seen once per training text; no longer history reaches there.
            history[grams.first] = n_texts if n == 1 else 0
            state = (grams.keys[n] != 0) & (history > 0)
            known = state & (counts[n] > 0)
            fail = np.where(state, np.log10(prior / (history + prior)), 0.0)
            arc = np.full(len(weight), -np.inf)
            np.log10((counts[n] + prior * np.power(10.0, weight)) / (history + prior), where=known, out=arc)
            self.states.append(state)
            self.failures.append(fail)
            self.arcs.append(np.where(known, arc, -np.inf))
            weight = np.where(known, arc, fail + weight)

    def traverse(self) -> np.ndarray:
        """log10 probability of every token: of the arc from the carried state, after the failure arcs that lead to a state with one."""
        out = np.zeros(len(self.root))
        moving = np.ones(len(self.root), bool)
        for state, fail, arc in zip(reversed(self.states), reversed(self.failures), reversed(self.arcs)):
            taken = moving & np.isfinite(arc)
            out[taken] += arc[taken]
            moving &= ~taken
            failing = moving & state
            out[failing] += fail[failing]
        out[moving] += self.root[moving]
        return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, prior: float = PRIOR, held_out=held_out_by_crc,
          block_bytes: int = LM_BLOCK_BYTES) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    Scores are log10 probabilities of all lower-cased words of the text and one end; ``base_score`` is of the model of single words with one
    added to every count and to one unknown word, ``score`` of the n-gram automaton. Counts come from the texts that
    ``held_out`` (of an array of ids) does not choose. Null texts are empty: one token, the end. Null ids train.
    Repeated rows count as often as they stand. Other columns are not looked at. No rows give no rows."""
    folder = C.workdir(docs.sparkSession, "lm")

    def digest(texts: C.Texts) -> dict:
        training = ~held_out(texts.ids)
        words = C.Words(texts).counts()
        return {"n_texts": int(training.sum()), "n_tokens": int((words[training] + 1).sum())}

    packed = C.blocks(C.text_column(docs, id_col, text_col), folder, pa.schema([("n_texts", pa.int64()), ("n_tokens", pa.int64())]),
                      "n_texts long, n_tokens long", digest, block_bytes)
    totals = packed.agg(F.count("*").alias("blocks"), F.sum("n_texts").alias("texts"), F.sum("n_tokens").alias("tokens")).first()
    bits = C.key_bits(totals.blocks)
    packed = packed.drop("n_texts", "n_tokens")

    def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Made again here and not kept with the blocks: the keys are larger than the texts.
        schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("single", pa.binary())])
        for row in C.rows_of(batches):
            texts = C.unpack(row)
            grams = Grams(texts, order)
            keys, counts = _asked(grams, ~held_out(texts.ids), order)
            single = np.isin(keys, np.unique(grams.keys[0]), assume_unique=True)
            yield C.rows_batch([{"bucket": b, "block": row["block"], "keys": C.packed_keys(keys[at:to]), "counts": _small(counts[at:to]),
                                 "single": np.packbits(single[at:to]).tobytes()} for b, at, to in C.bucket_slices(keys, bits)], schema)

    def answer(rows: list[dict]) -> list[bytes]:
        told = _summed(rows)
        keys = [C.unpacked_keys(r["keys"]) for r in rows]
        # The first row's reply also says how many different words of the bucket are in training texts.
        known = [k[np.unpackbits(np.frombuffer(r["single"], np.uint8), count=len(k)).astype(bool) & (_counts(t, len(k)) > 0)] for r, k, t in zip(rows, keys, told)]
        distinct = len(np.unique(np.concatenate(known)))
        return [(distinct if i == 0 else 0).to_bytes(8, "little") + t for i, t in enumerate(told)]

    asked = packed.mapInArrow(by_bucket, "bucket int, block long, keys binary, counts binary, single binary")
    model = C.replies(asked, answer, folder, "model")

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in C.rows_of(batches):
            yield pa.RecordBatch.from_pydict({"n": pa.array([sum(int.from_bytes(r["reply"][:8], "little") for r in row["replies"])], pa.int64())})

    distinct = model.select("replies").mapInArrow(distinct_words, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    tokens, n_texts = totals.tokens or 0, totals.texts or 0

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in C.rows_of(batches):
            texts = C.unpack(row)
            grams = Grams(texts, order)
            keys, _ = _asked(grams, np.zeros(len(texts), bool), order)
            told = {r["bucket"]: r["reply"][8:] for r in row["replies"]}
            counts = np.concatenate([_counts(told[b], to - at) for b, at, to in C.bucket_slices(keys, bits)])
            of = [np.where(k != 0, counts[np.minimum(np.searchsorted(keys, k), len(keys) - 1)], 0) for k in grams.keys]
            part = Automaton(of, grams, n_texts, tokens, distinct, prior)
            sums = lambda x: np.add.reduceat(x, grams.first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts.ids), pa.array(held_out(texts.ids)), pa.array(grams.sizes), pa.array(sums((of[0] > 0).astype(np.int64))),
                 pa.array(np.full(len(texts), tokens)), pa.array(sums(part.root)), pa.array(sums(part.traverse()))],
                names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    out = C.with_replies(packed, model).mapInArrow(
        scored, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumn("id", C.id_or_null())
