"""Suffix-array dedup of bytes by a distributed difference-cover algorithm.

A byte goes if a run of ``length`` bytes that covers it also starts in a document with a smaller id. Only the first ``length`` bytes of
a suffix matter, so the suffix sort stops at that depth.

The suffixes are distributed so that those with equal prefixes meet: by their anchor, the smallest hash among the short runs of bytes
inside the prefix, which equal prefixes share. Anchors of one document only cannot take part and are dropped first, by exchanging
hashes. A shard gets the stretches of text around its anchors, each once per block with its smallest document, and sorts
their suffixes with the difference cover of 3: it sorts and names the runs at sampled places (1 and 2 modulo 3), recurses on triples of
names until they cover the depth, sorts the remaining suffixes by a symbol and a sampled rank, and merges. Then it compares
the prefixes of adjacent suffixes, by all their bytes, and finds the smallest document of every class of equal prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.llm import common as C

#: Bytes of a run that can be an anchor: so many that a run seldom repeats by chance, however large the corpus.
ANCHOR_BYTES = 24
#: Bytes of text in a block. A block has a row for each bucket, and there are as many buckets as blocks: rows grow with the square of their
#: number, so blocks are large.
SUFFIX_BLOCK_BYTES = 8 << 20
#: Bytes whose windows are hashed at once: the arrays, some two hundred times as large, stay in the processor's caches.
PART_BYTES = 1 << 17
#: Bytes of stretches whose suffixes are sorted at once, or those of one anchor.
SORT_BYTES = 1 << 19
#: Numbers up to this one have a cube that fits 64 bits.
MAX_CUBED = 1 << 21
#: Symbols of a run that is packed into one number, and the largest base for it.
RUN, MAX_IN_RUN = 7, 500
#: Anchors travel without these low bits: a false match only keeps a few suffixes more.
_DROPPED = np.uint64(16)


# The difference-cover suffix sort


def _packed(symbols: np.ndarray, base: int, count: int) -> np.ndarray:
    """A number for each run of ``count`` symbols (below ``base``), in the order of the runs; zeros follow the end."""
    out = symbols.copy()
    for k in range(1, count):
        out *= base
        out[:-k] += symbols[k:]
    return out


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``symbols`` (positive integers) in the order of their suffixes; suffixes that agree in ``depth`` symbols stand together,
    in any order. A suffix that ends counts as going on with zeros."""
    n = len(symbols)
    if n < 3 or depth <= 1:
        return np.lexsort((np.append(symbols[1:], 0)[:n], symbols))
    base = int(symbols.max()) + 1
    s = np.concatenate([symbols.astype(np.int64), np.zeros(3, np.int64)])
    sample = np.flatnonzero(np.arange(n) % 3 != 0)
    # Small symbols go into the first names by seven, as many as 63 bits hold.
    reach = RUN if base <= MAX_IN_RUN else 3
    names = np.unique(_packed(s, base, RUN)[sample], return_inverse=True)[1] if reach == RUN else _triple_names(s, base, sample, 1)
    # Names of runs follow each other in steps of 3, which stay in the sample; triples of names get names until these reach the depth.
    while reach < depth and int(names.max()) + 1 < len(sample):
        step = reach // 3 * 3
        rank = np.zeros(n + 2 * step, np.int64)
        rank[sample] = names + 1
        names = _triple_names(rank, len(sample) + 1, sample, step)
        reach += 2 * step
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = names + 1
    sampled = sample[np.argsort(names)]
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(s[rest] * len(rank) + rank[rest + 1])]
    return _merged(s, base, rank, sampled, rest)


def _triple_names(s: np.ndarray, base: int, at: np.ndarray, step: int) -> np.ndarray:
    """Numbers of the triples of symbols (below ``base``), ``step`` apart, at some places, in the order of the triples."""
    pairs = s[at] * base + s[at + step]
    if base > MAX_CUBED:
        # Pairs are named first: a name is below the number of places, so no product leaves 64 bits.
        pairs = np.unique(pairs, return_inverse=True)[1]
    return np.unique(pairs * base + s[at + 2 * step], return_inverse=True)[1]


def _merged(s: np.ndarray, base: int, rank: np.ndarray, sampled: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Merges two sorted lists of suffixes: every remaining suffix is placed among the sampled ones.

    Sampled places 1 modulo 3 are followed by a sampled one, so a symbol and a rank tell the order; places 2 modulo 3 are by a remaining
    and then a sampled one, so two symbols and a rank do. Both lists are in the order of these keys."""
    size = len(rank)
    ones, twos = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    pairs = lambda at: s[at] * base + s[at + 1]
    two_pairs, rest_pairs = pairs(twos), pairs(rest)
    if base * base * size >= 1 << 63:
        named = np.unique(np.concatenate([two_pairs, rest_pairs]), return_inverse=True)[1]
        two_pairs, rest_pairs = named[:len(twos)], named[len(twos):]
    low = np.searchsorted(s[ones] * size + rank[ones + 1], s[rest] * size + rank[rest + 1])
    low += np.searchsorted(two_pairs * size + rank[twos + 2], rest_pairs * size + rank[rest + 2])
    out = np.empty(len(sampled) + len(rest), np.int64)
    # Among suffixes that agree to the depth, places may come out of order; they stay among each other.
    to = np.maximum.accumulate(low) + np.arange(len(rest))
    out[to] = rest
    free = np.ones(len(out), bool)
    free[to] = False
    out[free] = sampled
    return out


def prefix_classes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A number for each start; the same for equal runs of ``length`` bytes. ``data`` may hold -1 as a separator."""
    is_start = np.zeros(len(data), bool)
    is_start[starts] = True
    symbols = data.astype(np.int64) + 2
    order = suffix_order(symbols, length)
    order = order[is_start[order]]
    # Adjacent prefixes are compared in runs of seven bytes, each a number; the last run may overlap the one before.
    count = min(RUN, length)
    runs = _packed(symbols, MAX_IN_RUN, count)
    new = np.ones(len(order), bool)
    new[1:] = False
    for at in [*range(0, length - count, count), length - count]:
        here = runs[order + at]
        new[1:] |= here[1:] != here[:-1]
    out = np.empty(len(data), np.int64)
    out[order] = np.cumsum(new) - 1
    return out[starts]


# Stretches of text, by block


class Anchored:
    """Windows of ``length`` bytes of a block's texts in stretches with one anchor, without texts that have no id. Stretches end where a part
    of the block does."""

    def __init__(self, texts: C.Texts, length: int, part_bytes: int = PART_BYTES):
        self.texts, self.length, self.part_bytes = texts, length, part_bytes
        found = [self._part(at, min(at + part_bytes, len(texts.data))) for at in range(0, max(1, len(texts.data)), part_bytes)]
        self.first, self.last, keys = map(np.concatenate, zip(*found))
        self.keys = keys >> _DROPPED << _DROPPED
        self.doc = texts.ids[np.searchsorted(texts.offsets, self.first, "right") - 1] if len(self.first) else np.zeros(0, np.int64)

    def _part(self, at: int, to: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The stretches of the windows that start at ``at`` or later and before ``to``."""
        offsets, k = self.texts.offsets, min(ANCHOR_BYTES, self.length)
        a, b = max(0, int(np.searchsorted(offsets, at, "right")) - 1), int(np.searchsorted(offsets[:-1], to))
        begin = np.maximum(offsets[a:b], at)
        end = np.minimum(offsets[a + 1:b + 1] - self.length + 1, to)
        counts = np.where(self.texts.ids[a:b] == C.NULL_ID, 0, np.maximum(end - begin, 0))
        runs = C.rolling_hashes(C.byte_values(self.texts.data[at:to + self.length - 1]), k)
        first, last, keys = C.stretches(runs, C.ranges(begin - at, counts), self.length - k + 1)
        return first + at, last + at, keys

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct anchors, whether one is in several documents, and the place of each stretch's anchor among them."""
        order = np.argsort(self.keys)
        keys, docs = self.keys[order], self.doc[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        place = np.empty(len(keys), np.int64)
        place[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        several = np.minimum.reduceat(docs, at) != np.maximum.reduceat(docs, at) if len(at) else np.zeros(0, bool)
        return keys[at], several, place

    def _contents(self, some: np.ndarray) -> np.ndarray:
        """Hashes of the bytes of some stretches, which come in order."""
        first, ends = self.first[some], self.last[some] + self.length
        cuts = np.unique(np.searchsorted(first, np.arange(0, len(self.texts.data) + self.part_bytes, self.part_bytes)))
        out = [np.zeros(0, np.uint64)]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            at, to = int(first[a]), int(ends[b - 1])
            out.append(C.span_hashes(C.byte_values(self.texts.data[at:to]), first[a:b] - at, ends[a:b] - at))
        return np.concatenate(out)

    def chosen(self, found: list[dict] | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """One stretch for each distinct content whose anchor is in several documents, the one of the smallest document, in the order of
        anchors; and for every stretch the place of its content in that order (or -1)."""
        keys, _, at = self.distinct()
        told = {r["bucket"]: r["reply"] for r in found or []}
        parts = [np.unpackbits(np.frombuffer(told[b], np.uint8), count=to - at).astype(bool) for b, at, to in C.bucket_slices(keys, bits)]
        repeated = np.concatenate(parts) if parts else np.zeros(0, bool)
        some = np.flatnonzero(repeated[at])
        content = self._contents(some)
        order = np.lexsort((self.doc[some], content, self.keys[some]))
        some, content = some[order], content[order]
        new = np.ones(len(some), bool)
        new[1:] = (content[1:] != content[:-1]) | (self.keys[some[1:]] != self.keys[some[:-1]])
        place = np.full(len(self.keys), -1)
        place[some] = np.cumsum(new) - 1
        return some[new], place


def _repeated(rows: list[dict]) -> list[bytes]:
    """For each row's anchors, a bit that tells whether the anchor is in several documents."""
    keys = [C.unpacked_keys(r["keys"]) for r in rows]
    sizes = [len(k) for k in keys]
    twice = [np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=n).astype(bool) for r, n in zip(rows, sizes)]
    every, where = np.unique(np.concatenate(keys), return_inverse=True)
    often = np.bincount(where) > 1
    often[where[np.concatenate(twice)]] = True
    return [np.packbits(x).tobytes() for x in np.split(often[where], np.cumsum(sizes)[:-1])]


def _slices(order: np.ndarray, group: np.ndarray, sizes: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Cuts ``order`` between groups, which are sorted, in slices of about ``limit`` bytes; a larger group is a slice of its own."""
    if not len(order):
        return
    at = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    part = (np.cumsum(np.add.reduceat(sizes, at)) - 1) // limit
    yield from np.split(order, at[np.flatnonzero(part[1:] != part[:-1]) + 1])


def _smaller(length: int, sort_bytes: int = SORT_BYTES):
    """For each row's stretches, a bit per window that tells whether the window also starts in a smaller document."""

    def answer(rows: list[dict]) -> list[bytes]:
        sizes = [np.frombuffer(r["sizes"], "<u4").astype(np.int64) for r in rows]
        docs = np.concatenate([np.frombuffer(r["docs"], "<i8") for r in rows])
        data = np.concatenate([np.frombuffer(pa.Codec("zstd").decompress(r["text"], decompressed_size=int(n.sum()), asbytes=True), np.uint8) for r, n in zip(rows, sizes)])
        size = np.concatenate(sizes)
        ends = np.cumsum(size)
        # Equal stretches of several blocks are one, with the smallest document.
        of: dict[bytes, int] = {}
        blob = data.tobytes()
        number = np.array([of.setdefault(blob[b - n:b], len(of)) for b, n in zip(ends.tolist(), size.tolist())], np.int64)
        least = np.full(len(of), np.iinfo(np.int64).max)
        np.minimum.at(least, number, docs)
        # Windows can only be equal to those around the same anchor. An anchor with one content has no others to be compared with.
        anchors = np.concatenate([np.frombuffer(r["anchors"], "<u4") for r in rows]).astype(np.int64)
        anchor_of = np.empty(len(of), np.int64)
        anchor_of[number] = anchors
        _, group, contents = np.unique(anchor_of, return_inverse=True, return_counts=True)
        several = contents[group] > 1
        texts = list(of)
        own = np.array([len(t) for t in texts], np.int64)
        windows = own - length + 1
        low = np.repeat(least, windows)
        before = np.cumsum(windows) - windows
        order = np.flatnonzero(several)
        order = order[np.argsort(group[order], kind="stable")]
        for some in _slices(order, group[order], own[order], sort_bytes):
            low[C.ranges(before[some], windows[some])] = _least_by_class([texts[i] for i in some.tolist()], least[some], length)
        counts = windows[number]
        bits = low[C.ranges(before[number], counts)] < np.repeat(docs, counts)
        row_of = np.repeat(np.arange(len(rows)), [len(x) for x in sizes])
        cuts = np.cumsum(np.bincount(row_of, weights=counts, minlength=len(rows)).astype(np.int64))
        return [np.packbits(x).tobytes() for x in np.split(bits, cuts[:-1])]

    return answer


def _least_by_class(texts: list[bytes], docs: np.ndarray, length: int) -> np.ndarray:
    """For each window of the texts, one text after the other, the smallest document of all texts that hold an equal window."""
    own = np.array([len(t) for t in texts], np.int64)
    if not len(own):
        return own
    joined = np.full(int(own.sum()) + len(own), -1, np.int16)
    begin = np.cumsum(own + 1) - own - 1
    joined[C.ranges(begin, own)] = np.frombuffer(b"".join(texts), np.uint8)
    windows = own - length + 1
    classes = prefix_classes(joined, C.ranges(begin, windows), length)
    low = np.full(int(classes.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(low, classes, np.repeat(docs, windows))
    return low[classes]


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, block_bytes: int = SUFFIX_BLOCK_BYTES) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept binary, spans array of (start, length)) for each row of ``docs``: the text's UTF-8 bytes without those
    covered by a run of ``length`` bytes that also starts in a document with a smaller id. Runs are judged on the texts as they come in
    and do not cross texts; ``spans`` are the maximal removed runs.

    Null texts are empty. Rows that share an id are not smaller than each other, so exact copies among them stay. Rows without id
    take no part and stay whole. Other columns are not looked at. No rows give no rows."""
    folder = C.workdir(docs.sparkSession, "suffixes")
    packed = C.blocks(C.text_column(docs, id_col, text_col), folder, pa.schema([]), "", lambda texts: {}, block_bytes)
    n_blocks = packed.select("block").count()
    bits, shard_bits = C.key_bits(n_blocks // 2), C.key_bits(n_blocks, C.MAX_SHARDS)

    def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("twice", pa.binary())])
        for row in C.rows_of(batches):
            keys, twice, _ = Anchored(C.unpack(row), length).distinct()
            yield C.rows_batch([{"bucket": b, "block": row["block"], "keys": C.packed_keys(keys[at:to] >> _DROPPED), "twice": np.packbits(twice[at:to]).tobytes()}
                                for b, at, to in C.bucket_slices(keys, bits)], schema)

    repeated = C.replies(packed.mapInArrow(by_bucket, "bucket int, block long, keys binary, twice binary"), _repeated, folder, "anchors")

    def to_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("text", pa.binary()), ("sizes", pa.binary()), ("docs", pa.binary()), ("anchors", pa.binary())])
        codec = pa.Codec("zstd", compression_level=3)
        for row in C.rows_of(batches):
            texts = C.unpack(row)
            anchored = Anchored(texts, length)
            some, _ = anchored.chosen(row["replies"], bits)
            first, sizes = anchored.first[some], anchored.last[some] + length - anchored.first[some]
            yield C.rows_batch([{"bucket": b, "block": row["block"], "text": codec.compress(texts.data[C.ranges(first[at:to], sizes[at:to])], asbytes=True),
                                 "sizes": sizes[at:to].astype("<u4").tobytes(), "docs": anchored.doc[some[at:to]].astype("<i8").tobytes(),
                                 "anchors": (anchored.keys[some[at:to]] >> _DROPPED).astype("<u4").tobytes()}
                                for b, at, to in C.bucket_slices(anchored.keys[some], shard_bits)], schema)

    shards = C.with_replies(packed, repeated).where("replies is not null").mapInArrow(
        to_shards, "bucket int, block long, text binary, sizes binary, docs binary, anchors binary")
    smaller = C.replies(shards, _smaller(length), folder, "smaller")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in C.rows_of(batches):
            texts = C.unpack(row)
            # The flagged windows that begin at a byte, less those that ended before it: one of each at most.
            gone = np.zeros(len(texts.data) + 1, np.int8)
            if row["replies"] is not None:
                anchored = Anchored(texts, length)
                some, place = anchored.chosen(row["replies"], bits)
                n = anchored.last - anchored.first + 1
                told = {r["bucket"]: r["reply"] for r in row["matches"] or []}
                parts = [np.unpackbits(np.frombuffer(told[b], np.uint8), count=int(n[some[at:to]].sum())).astype(bool) for b, at, to in C.bucket_slices(anchored.keys[some], shard_bits)]
                flags = np.concatenate(parts) if parts else np.zeros(0, bool)
                begin = np.cumsum(n[some]) - n[some]
                # Of one content in a block, the replies are about the smallest document; larger ones have that before them.
                every = np.flatnonzero(place >= 0)
                for mine in np.split(every, range(PART_BYTES, len(every), PART_BYTES)):
                    flagged = flags[C.ranges(begin[place[mine]], n[mine])]
                    flagged |= np.repeat(anchored.doc[mine] > anchored.doc[some][place[mine]], n[mine])
                    starts = C.ranges(anchored.first[mine], n[mine])[flagged]
                    gone[starts] += 1
                    gone[starts + length] -= 1
            kept = np.cumsum(gone[:-1], dtype=np.int32) == 0
            yield _rows(texts, kept)

    told = C.with_replies(packed, repeated).join(smaller.withColumnRenamed("replies", "matches").hint("merge"), "block", "left")
    out = told.mapInArrow(removed, "id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start:long,length:long>>")
    return out.withColumn("id", C.id_or_null())


def _rows(texts: C.Texts, kept: np.ndarray) -> pa.RecordBatch:
    offsets = texts.offsets
    bounds = np.append(0, np.cumsum(kept, dtype=np.int32))[offsets].astype(np.int64)
    blob = texts.data[kept].tobytes()
    # Removed runs, cut where texts begin.
    begins, ends, first = (np.zeros(len(kept) + 1, bool) for _ in range(3))
    first[offsets] = True
    begins[:-1] = ~kept
    begins[1:-1] &= kept[:-1] | first[1:-1] if len(kept) else True
    ends[1:] = ~kept
    ends[1:-1] &= kept[1:] | first[1:-1] if len(kept) else True
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends)
    owner = np.searchsorted(offsets, starts, "right") - 1
    counts = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    spans = pa.StructArray.from_arrays([pa.array(starts - offsets[owner]), pa.array(stops - starts)], names=["start", "length"])
    sizes = np.diff(offsets)
    return pa.RecordBatch.from_arrays(
        [pa.array(texts.ids), pa.array(sizes), pa.array(sizes - np.diff(bounds)), pa.array(counts),
         pa.array([blob[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary()),
         pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), spans)],
        names=["id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])
