"""Periodic run detection by Baier's grouping of suffixes.

A run is a maximal stretch of words that repeats with a smallest period. Every run has a root that is the longest Lyndon word
at its place, under some order of the words or under the reversed order, so the Lyndon arrays of both orders name all
candidates. Phase one of Baier's suffix sorting gives such an array directly: it refines groups of suffixes from the highest down, and the
context of a group, when its turn comes, is the longest Lyndon word at each of its places. Each root is then extended to
both sides by the longest common extension of its two ends, read off exact names of all stretches of a power of two words.

Documents are independent, so blocks of texts are handled in the tasks and nothing is shuffled. Within a block only the stretches
are grouped in which every short window of words occurs twice in its document: a run has no other windows, and prose has few such."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from changeflow.llm import common as C

#: A run has this many words and this many periods at least.
MIN_LENGTH = 6
MIN_EXPONENT = 4


def lyndon_lengths(symbols: np.ndarray) -> np.ndarray:
    """The length of the longest Lyndon word that starts at each place, by phase one of Baier's grouping.

    Symbols are positive; a 0 ends the word before it, belongs to none, and has length 0. The first must be a 0.

    Groups stand in a list from low to high. A place's parent is the nearest place before it in a lower group, that is the nearest one left
    in the list of places once its own group is taken out. A parent whose group has context u and which ``count`` places of the
    group with context v point at continues with v that often: it goes to a new group just above its old one, with context u v ... v."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    cuts = np.flatnonzero(np.diff(symbols[order])) + 1
    members = [part.tolist() for part in np.split(order, cuts)]
    group = np.empty(n, np.int64)
    group[order] = np.repeat(np.arange(len(members)), [len(m) for m in members])
    group = group.tolist()
    length = [1] * len(members)
    above, below = list(range(1, len(members) + 1)), list(range(-1, len(members) - 1))
    above[-1] = None
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    before.append(n - 1)
    out = [0] * n
    now = len(members) - 1
    while now > 0:
        context = length[now]
        parents = []
        for i in members[now]:
            if group[i] == now:
                out[i] = context
                parent, follower = before[i], after[i]
                after[parent], before[follower] = follower, parent
                parents.append(parent)
        moved = {}
        for parent, pointers in groupby(parents):
            if group[parent]:
                moved.setdefault((sum(1 for _ in pointers), group[parent]), []).append(parent)
        for (count, old), places in sorted(moved.items(), reverse=True):
            new = len(members)
            members.append(places)
            length.append(length[old] + count * context)
            above.append(above[old])
            below.append(old)
            if above[old] is not None:
                below[above[old]] = new
            above[old] = new
            for i in places:
                group[i] = new
        members[now] = ()
        now = below[now]
    return np.array(out)


class Extensions:
    """Longest common extensions in a row of symbols by names of all stretches of 1, 2, 4, ... symbols: equal names, equal stretches."""

    def __init__(self, symbols: np.ndarray):
        self.size = len(symbols)
        self.names = [symbols]
        while True:
            step = 1 << (len(self.names) - 1)
            last = self.names[-1]
            if len(last) <= step:
                return
            pair = last[:-step] * (int(last.max()) + 1) + last[step:]
            distinct, names = np.unique(pair, return_inverse=True)
            if len(distinct) == len(pair):
                return
            self.names.append(names)

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` on and from ``b`` on are equal."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names = self.names[k]
            at, to = a + out, b + out
            ok = np.flatnonzero(np.maximum(at, to) < len(names))
            ok = ok[names[at[ok]] == names[to[ok]]]
            out[ok] += 1 << k
        return out

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before ``a`` and before ``b`` are equal."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names = self.names[k]
            at, to = a - out - (1 << k), b - out - (1 << k)
            ok = np.flatnonzero(np.minimum(at, to) >= 0)
            ok = ok[names[at[ok]] == names[to[ok]]]
            out[ok] += 1 << k
        return out


def find_runs(symbols: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of the runs between the zeros of ``symbols``."""
    symbols = np.concatenate([[0], symbols, [0]])
    if symbols.max() == 0:
        return np.zeros((0, 3), np.int64)
    walls = np.flatnonzero(symbols == 0)
    reversed_order = np.where(symbols > 0, symbols.max() + 1 - symbols, 0)
    lengths = [lyndon_lengths(symbols), lyndon_lengths(reversed_order)]
    inside = np.flatnonzero(symbols)
    roots = np.unique(np.concatenate([np.stack([inside, x[inside]], 1) for x in lengths]), axis=0)
    start, period = roots.T
    # No two walls are equal, so that no extension passes one.
    named = symbols.copy()
    named[walls] = symbols.max() + 1 + np.arange(len(walls))
    # A root whose two ends agree on neither side is not repeated.
    some = (named[start] == named[start + period]) | (named[start - 1] == named[start + period - 1])
    start, period = start[some], period[some]
    extensions = Extensions(named)
    left = extensions.backward(start, start + period)
    right = extensions.forward(start, start + period)
    found = np.stack([start - left - 1, left + period + right, period], 1)
    return np.unique(found[found[:, 1] >= np.maximum(min_length, min_exponent * period)], axis=0)


def repeated_width(min_length: int, min_exponent: int) -> int:
    """The longest window for which every window inside a run occurs twice in the run, one period apart."""
    return min(max(min_length, min_exponent * q) - 2 * q + 1 for q in range(1, min_length + 1))


def _stretches(codes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of the stretches whose windows all occur twice in their document. Equal hashes only let a stretch in."""
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    starts = C.ranges(bounds[:-1], counts)
    if not len(starts):
        return starts, starts
    keys = C.rolling_hashes(C.mix(codes.astype(np.uint64) + np.uint64(1)), width)[starts]
    keys = C.mix(keys ^ C.mix(np.repeat(np.arange(1, len(counts) + 1), counts).astype(np.uint64)))
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return starts[:0], starts[:0]
    starts = starts[twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys]
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] != starts[:-1] + 1
    # Windows of one word are neighbours across documents.
    owner = np.searchsorted(bounds, starts, "right")
    new[1:] |= owner[1:] != owner[:-1]
    first = np.flatnonzero(new)
    return starts[first], np.diff(np.append(first, len(starts))) + width - 1


def block_runs(texts: C.Texts, words: C.Words, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of a block's texts: rows (first word in the block, length, period), and the text of each."""
    codes, _ = C.word_codes(texts, words)
    first, sizes = _stretches(codes, words.bounds, repeated_width(min_length, min_exponent))
    if not len(first):
        return np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
    # The stretches end to end, with a wall after each.
    places = C.ranges(first, sizes + 1)
    walls = np.cumsum(sizes + 1) - 1
    symbols = codes[np.minimum(places, len(codes) - 1)] + 1
    symbols[walls] = 0
    runs = find_runs(symbols, min_length, min_exponent)
    runs[:, 0] = places[runs[:, 0]]
    owner = np.searchsorted(words.bounds, runs[:, 0], "right") - 1
    order = np.lexsort((runs[:, 2], runs[:, 0]))
    return runs[order], owner[order]


def joined_words(texts: C.Texts, words: C.Words, kept: np.ndarray) -> pa.Array:
    """Each text's kept words, joined by one space."""
    bounds = np.concatenate([[0], np.cumsum(kept)])[words.bounds]
    starts, lengths = words.starts[kept], (words.ends - words.starts)[kept]
    data = np.full(int(lengths.sum()) + len(lengths), 32, np.uint8)
    to = np.cumsum(lengths + 1) - lengths - 1
    data[C.ranges(to, lengths)] = texts.data[C.ranges(starts, lengths)]
    ends = np.append(to, len(data))[bounds]
    blob = data.tobytes()
    return pa.array([blob[a:b - 1] if b > a else b"" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary()).cast(pa.string())


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT, chunk_bytes: int = C.CHUNK_BYTES) -> DataFrame:
    """(id, n_words, runs, collapsed) for each row of ``docs``.

    ``runs`` are all stretches of at least ``min_length`` words and ``min_exponent`` (2 or more) smallest periods that no neighbouring word
    extends, as (start, length, period) in words from 0, by start, then period. ``collapsed`` is the text's words joined by one
    space without those that stand in a run after its first period.

    Null and empty texts have no words, no runs and an empty ``collapsed``. Ids are passed through and may be null or repeated; repeated
    rows give repeated rows. Other columns are not looked at. Long texts are a block of their own; time is linear in the text but
    for the names of its repeated stretches, which add a logarithm. No rows give no rows."""
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in C.texts_of(batches, chunk_bytes):
            words = C.Words(texts, hashes=False)
            runs, owner = block_runs(texts, words, min_length, min_exponent)
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
            np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
            kept = np.cumsum(gone[:-1]) == 0
            told = pa.StructArray.from_arrays([pa.array(runs[:, 0] - words.bounds[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(_RUN))
            offsets = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts.ids), pa.array(words.counts()), pa.ListArray.from_arrays(pa.array(offsets), told), joined_words(texts, words, kept)],
                names=["id", "n_words", "runs", "collapsed"])

    out = C.text_column(docs, id_col, text_col).mapInArrow(
        found, "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return out.withColumn("id", C.id_or_null())
