"""Substring dedup by suffix automata of reference shards.

The reference is the corpus itself, which no automaton can hold and no broadcast can carry. It is cut into shards by
content: each window of words belongs to its anchor, the smallest hash among the short word runs inside the window.
Equal windows have equal anchors, so a shard that gets all stretches of text around its anchors decides its windows for the whole
corpus. Anchors that occur once are dropped first, by exchanging their hashes only. The shard's automaton is built from its
distinct stretches, each counted as often as it occurs; every stretch is then streamed through it, and places whose matching
statistic reaches the window length end a repeated window. The documents get those back and remove the spans.

An anchor with very many stretches, such as the edge of a passage that stands in a third of all documents, would be one huge
automaton. Its windows are told apart by their 64-bit hashes instead, exchanged like anchors: each block sends each hash once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from changeflow.llm import common as C
from changeflow.llm.automaton import SuffixAutomaton

#: Words in a run that can be an anchor; windows shorter than it use the whole window.
ANCHOR_WORDS = 8
#: Shards for each bucket of anchors. An automaton takes some hundred times the bytes of its words, so shards are small.
SHARDS = 4
#: Stretches that an anchor may have in the corpus for an automaton; the windows of others meet by hash.
HOT = 1_000


class Anchored:
    """The windows of a block's texts, grouped in stretches: runs of window starts with one anchor."""

    def __init__(self, words: C.Words, window: int):
        self.words, self.window = words, window
        k = min(ANCHOR_WORDS, window)
        self.first, self.last, self.keys = C.stretches(C.window_hashes(words.hashes, k), words.windows(window), window - k + 1)

    def stretch_hashes(self) -> np.ndarray:
        return C.span_hashes(self.words.hashes, self.first, self.last + self.window)


def _distinct_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, counts = np.unique(keys, return_counts=True)
    return values, counts > 1


def _many(keys: np.ndarray) -> bytes:
    """(place, count) of the distinct keys that occur more than twice."""
    counts = np.unique(keys, return_counts=True)[1]
    at = np.flatnonzero(counts > 2)
    return np.stack([at, counts[at]], 1).astype("<u4").tobytes()


def _repeated_keys(hot: int):
    """As ``_repeated_windows``, followed by a bit for each key that tells whether it occurs more than ``hot`` times, if one does."""

    def answer(rows: list[dict]) -> list[bytes]:
        keys = [C.unpacked_keys(r["keys"]) for r in rows]
        times = [1 + np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=len(k)).astype(np.int64) for r, k in zip(rows, keys)]
        for r, n in zip(rows, times):
            many = np.frombuffer(r["many"], "<u4").reshape(-1, 2)
            n[many[:, 0]] = many[:, 1]
        _, where = np.unique(np.concatenate(keys), return_inverse=True)
        often = (np.bincount(where, weights=np.concatenate(times)) > hot)[where]
        parts = np.split(often, np.cumsum([len(k) for k in keys])[:-1])
        return [bits + (np.packbits(x).tobytes() if x.any() else b"") for bits, x in zip(_repeated_windows(rows), parts)]

    return answer


def _repeated_windows(rows: list[dict]) -> list[bytes]:
    """For each row's keys, a bit that tells whether the key occurs twice or more in the corpus."""
    keys = [C.unpacked_keys(r["keys"]) for r in rows]
    sizes = [len(k) for k in keys]
    twice = [np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=n).astype(bool) for r, n in zip(rows, sizes)]
    every, where = np.unique(np.concatenate(keys), return_inverse=True)
    often = np.bincount(where) > 1
    often[where[np.concatenate(twice)]] = True
    return [np.packbits(x).tobytes() for x in np.split(often[where], np.cumsum(sizes)[:-1])]


def _flags(found: list[dict] | None, counts: dict[int, int]) -> np.ndarray:
    """Bits of all replies in the order of their buckets."""
    told = sorted(found or [], key=lambda r: r["bucket"])
    parts = [np.unpackbits(np.frombuffer(r["reply"], np.uint8), count=counts[r["bucket"]]).astype(bool) for r in told]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def _hot_flags(found: list[dict] | None, counts: dict[int, int]) -> np.ndarray:
    """For each key, whether its anchor has too many stretches for an automaton."""
    rest = [{"bucket": r["bucket"], "reply": r["reply"][(counts[r["bucket"]] + 7) // 8:] or bytes((counts[r["bucket"]] + 7) // 8)} for r in found or []]
    return _flags(rest, counts)


def _shard_matches(window: int):
    """For each row's stretches, or for its hashes of windows in a bucket below 0, a bit per window that tells whether the window
    occurs elsewhere."""

    def answer(rows: list[dict]) -> list[bytes]:
        if rows[0]["bucket"] < 0:
            return _repeated_windows([{"keys": r["words"], "twice": r["twice"]} for r in rows])
        stretches, times = {}, {}
        for r in rows:
            words, sizes = np.frombuffer(r["words"], "<u8"), np.frombuffer(r["sizes"], "<u4")
            twice = np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=len(sizes))
            ends = np.cumsum(sizes)
            r["stretches"] = []
            for a, b, t in zip((ends - sizes).tolist(), ends.tolist(), twice.tolist()):
                content = words[a:b].tobytes()
                times[content] = times.get(content, 0) + 1 + t
                r["stretches"].append(content)
        shard = SuffixAutomaton()
        for content, n in times.items():
            shard.add(np.frombuffer(content, "<u8").tolist(), n)
        shard.finish()
        for content in times:
            matched = shard.matching(np.frombuffer(content, "<u8").tolist())
            stretches[content] = [m >= window for m in matched[window - 1:]]
        return [np.packbits(np.array([bit for s in r["stretches"] for bit in stretches[s]], bool)).tobytes() for r in rows]

    return answer


def _candidates(anchored: Anchored, found: list[dict] | None, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of one stretch for each distinct content whose anchor is repeated but not hot, ordered by anchor and content, for
    every stretch the place in that order (or -1), and the first words of the windows with hot anchors."""
    keys, _ = _distinct_keys(anchored.keys)
    counts = {b: to - at for b, at, to in C.bucket_slices(keys, bits)}
    hot = _hot_flags(found, counts)
    repeated = _flags(found, counts) & ~hot
    out = np.full(len(anchored.keys), -1)
    of_key = np.searchsorted(keys, anchored.keys)
    chosen = np.flatnonzero(repeated[of_key]) if len(keys) else np.zeros(0, np.int64)
    content = anchored.stretch_hashes()[chosen]
    order = np.lexsort((content, anchored.keys[chosen]))
    ordered = content[order]
    new = np.ones(len(order), bool)
    new[1:] = (ordered[1:] != ordered[:-1]) | (anchored.keys[chosen[order]][1:] != anchored.keys[chosen[order]][:-1])
    out[chosen[order]] = np.cumsum(new) - 1
    apart = np.flatnonzero(hot[of_key]) if len(keys) else np.zeros(0, np.int64)
    return chosen[order[new]], out, C.ranges(anchored.first[apart], anchored.last[apart] - anchored.first[apart] + 1)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                     block_bytes: int = C.BLOCK_BYTES, hot: int = HOT, layout: bool = False) -> DataFrame:
    """All rows and columns of ``docs``, with the text's words joined by one space and without each word that is
    covered by a run of ``window`` words that also starts anywhere else, in the same document or another, and with the columns
    ``n_words`` and ``n_removed``. Runs are judged on the texts as they come in.

    Null texts stay null and have no words; texts without words become empty. Repeated rows are documents of their own, so each
    loses what the other has. With ``layout`` the words are cut out of the text, each with the white space up to the next one, and all else
    stays as it is: line breaks, indentation, and every byte of a text that loses nothing. Ids are not used and may be null or repeated. New columns that clash get underscores.
    No rows give no rows."""
    folder = C.workdir(docs.sparkSession, "substrings")
    texts = C.text_column(docs, id_col, text_col, keep=True)

    def digest(block: C.Texts) -> dict:
        every = Anchored(C.Words(block), window).keys
        keys, twice = _distinct_keys(every)
        return {"keys": C.packed_keys(keys), "n_keys": len(keys), "twice": np.packbits(twice).tobytes(), "many": _many(every)}

    packed = C.blocks(texts, folder, pa.schema([("keys", pa.binary()), ("n_keys", pa.int64()), ("twice", pa.binary()), ("many", pa.binary())]),
                      "keys binary, n_keys long, twice binary, many binary", digest, block_bytes)
    bits = C.key_bits(packed.select("block").count())
    shard_bits = bits + SHARDS.bit_length() - 1

    def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("twice", pa.binary()), ("many", pa.binary())])
        for row in C.rows_of(batches):
            keys = C.unpacked_keys(row["keys"])
            twice = np.unpackbits(np.frombuffer(row["twice"], np.uint8), count=len(keys))
            many = np.frombuffer(row["many"], "<u4").reshape(-1, 2)
            part = lambda at, to: many[slice(*np.searchsorted(many[:, 0], [at, to]))] - np.array([at, 0], np.uint32)
            yield C.rows_batch([{"bucket": b, "block": row["block"], "keys": C.packed_keys(keys[at:to]), "twice": np.packbits(twice[at:to]).tobytes(), "many": part(at, to).astype("<u4").tobytes()}
                                for b, at, to in C.bucket_slices(keys, bits)], schema)

    asked = packed.where("n_keys > 0").select("block", "keys", "twice", "many").mapInArrow(by_bucket, "bucket int, block long, keys binary, twice binary, many binary")
    repeated = C.replies(asked, _repeated_keys(hot), folder, "anchors")

    def to_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("words", pa.binary()), ("sizes", pa.binary()), ("twice", pa.binary())])
        for row in C.rows_of(batches):
            anchored = Anchored(C.Words(C.unpack(row)), window)
            chosen, places, apart = _candidates(anchored, row["replies"], bits)
            twice = np.bincount(places[places >= 0], minlength=len(chosen)) > 1
            sizes = anchored.last[chosen] + window - anchored.first[chosen]
            yield C.rows_batch([
                {"bucket": b, "block": row["block"], "words": anchored.words.hashes[C.ranges(anchored.first[chosen[at:to]], sizes[at:to])].astype("<u8").tobytes(),
                 "sizes": sizes[at:to].astype("<u4").tobytes(), "twice": np.packbits(twice[at:to]).tobytes()}
                for b, at, to in C.bucket_slices(anchored.keys[chosen], shard_bits)], schema)
            if len(apart):
                keys, twice = _distinct_keys(C.span_hashes(anchored.words.hashes, apart, apart + window))
                yield C.rows_batch([{"bucket": -1 - b, "block": row["block"], "words": C.packed_keys(keys[at:to]), "sizes": b"", "twice": np.packbits(twice[at:to]).tobytes()}
                                    for b, at, to in C.bucket_slices(keys, bits)], schema)

    needed = packed.select("block", "ids", "offsets", "data", F.lit(None).cast("binary").alias("rest"))
    shards = C.with_replies(needed, repeated).where("replies is not null").mapInArrow(
        to_shards, "bucket int, block long, words binary, sizes binary, twice binary")
    matched = C.replies(shards, _shard_matches(window), folder, "matches")

    fields = C.rest_fields(docs, text_col)
    n_words = C.free_name(docs, "n_words")
    n_removed = C.free_name(docs, "n_removed")
    schema = T.StructType([T.StructField("kept", T.StringType()), T.StructField("total", T.LongType()), T.StructField("gone", T.LongType()),
                           T.StructField("rest", T.BooleanType()), *(T.StructField(name, kind) for name, kind, _ in fields)])
    told = C.with_replies(packed.drop("keys", "n_keys", "twice", "many"), repeated).join(
        matched.withColumnRenamed("replies", "matches").hint("merge"), "block", "left")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in C.rows_of(batches):
            texts = C.unpack(row)
            words = C.Words(texts)
            anchored = Anchored(words, window)
            gone = np.zeros(len(words) + 1, np.int64)
            chosen, places, apart = _candidates(anchored, row["replies"], bits)
            matches = row["matches"] or []
            if len(apart):
                hashes = C.span_hashes(words.hashes, apart, apart + window)
                keys, _ = _distinct_keys(hashes)
                counts = {b: to - at for b, at, to in C.bucket_slices(keys, bits)}
                flags = _flags([{"bucket": -1 - r["bucket"], "reply": r["reply"]} for r in matches if r["bucket"] < 0], counts)
                starts = apart[flags[np.searchsorted(keys, hashes)]]
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + window, -1)
            if len(chosen):
                n = anchored.last - anchored.first + 1
                counts = {b: int(n[chosen[at:to]].sum()) for b, at, to in C.bucket_slices(anchored.keys[chosen], shard_bits)}
                flags = _flags([r for r in matches if r["bucket"] >= 0], counts)
                begin = np.cumsum(n[chosen]) - n[chosen]
                some = np.flatnonzero(places >= 0)
                bit = C.ranges(begin[places[some]], n[some])
                starts = C.ranges(anchored.first[some], n[some])[flags[bit]]
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + window, -1)
            kept = np.cumsum(gone[:-1]) == 0
            yield from kept_rows(texts, words, kept, fields, layout)

    out = told.mapInArrow(removed, schema)
    by_name = {old: new for new, _, old in fields}
    return out.select(*(F.when(~F.col("rest"), F.col("kept")).alias(c) if c == text_col else F.col(by_name[c]).alias(c) for c in docs.columns),
                      F.col("total").alias(n_words), F.col("gone").alias(n_removed))


def kept_rows(texts: C.Texts, words: C.Words, kept: np.ndarray, fields: list, layout: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows of a block with the kept words joined by one space, or with the others cut out of the text."""
    bounds = np.concatenate([[0], np.cumsum(kept)])[words.bounds]
    out = _cut_out(texts, words, kept, np.diff(bounds) > 0) if layout else _joined(texts, words, kept, bounds)
    total = words.counts()
    yield from pa.Table.from_arrays(
        [pa.array(out, pa.binary()).cast(pa.string()), pa.array(total), pa.array(total - np.diff(bounds)),
         *texts.rest.columns], names=["kept", "total", "gone", "rest", *(f[0] for f in fields)]).combine_chunks().to_batches()


def _joined(texts: C.Texts, words: C.Words, kept: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    starts, lengths = words.starts[kept], (words.ends - words.starts)[kept]
    # Each word is written with a space after it; the last space of a text is left out.
    data = np.full(int(lengths.sum()) + len(lengths), 32, np.uint8)
    to = np.cumsum(lengths + 1) - lengths - 1
    data[C.ranges(to, lengths)] = texts.data[C.ranges(starts, lengths)]
    ends = np.append(to, len(data))[bounds]
    blob = data.tobytes()
    return [blob[a:b - 1] if b > a else b"" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _cut_out(texts: C.Texts, words: C.Words, kept: np.ndarray, some: np.ndarray) -> list[bytes]:
    """The texts without the bytes from each word that goes to the next one; the last word of a text goes alone. ``some``: texts that keep a word."""
    until = words.ends.copy()
    if len(until):
        until[:-1] = words.starts[1:]
        last = words.bounds[1:][words.counts() > 0] - 1
        until[last] = words.ends[last]
    cut = np.zeros(len(texts.data) + 1, np.int64)
    np.add.at(cut, words.starts[~kept], 1)
    np.add.at(cut, until[~kept], -1)
    stays = np.cumsum(cut[:-1]) == 0
    at = np.concatenate([[0], np.cumsum(stays)])[texts.offsets].tolist()
    blob = texts.data[stays].tobytes()
    # A text that loses all its words has none of its white space either.
    lost = (words.counts() > 0) & ~some
    return [b"" if gone else blob[a:b] for a, b, gone in zip(at[:-1], at[1:], lost.tolist())]
