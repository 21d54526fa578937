"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A text is cut by the vocabulary's added tokens and its pattern; each distinct piece is merged once per task while it stays in a bounded
cache. The merges of a piece run on a segment tree whose leaves are the ranks of adjacent pairs (with their places, so that the
leftmost of equal ranks is the smallest): the root is the next merge, and a merge changes three leaves and
the paths above them. All new pieces of one size class are merged side by side, each in its own row of numpy arrays.

The vocabulary is read by the driver and broadcast; its size does not depend on the data."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from changeflow.llm import common as C

#: Fixed value: the pattern of byte-level vocabularies of this format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces that a task keeps, in two generations of this size.
CACHE_PIECES = 200_000
_NONE = np.iinfo(np.int64).max
_PLACE = 32


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in vocabularies of this format: printable ones for themselves, the others, in
    order, for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class Vocabulary:
    """Ids, merges and added tokens of a tokenizer file with a byte-level BPE model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = (spec["model"]["type"], (spec["pre_tokenizer"] or {}).get("type"), spec["normalizer"])
        if kind != ("BPE", "ByteLevel", None) or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError(f"not a plain byte-level BPE vocabulary: {kind}")
        ids = spec["model"]["vocab"]
        letters = byte_letters()
        back = {x: b for b, x in letters.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*ids.values(), *self.added.values()])
        texts = [b""] * size
        for text, i in ids.items():
            texts[i] = bytes(back[x] for x in text)
        for text, i in self.added.items():
            texts[i] = text.encode()
        self.of_byte = np.array([ids[letters[b]] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([ids[a] * size + ids[b] for a, b in pairs], np.int64)
        self.size = size
        self.ranks = np.argsort(keys, kind="stable")
        self.keys = keys[self.ranks]
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of two tokens, ``_NONE`` where there is none or a token is missing (-1)."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], _NONE)


def merge_pieces(vocabulary: Vocabulary, pieces: list[bytes]) -> list[bytes]:
    """Ids of each piece as little-endian unsigned 32-bit integers."""
    out: list[bytes] = [b""] * len(pieces)
    sizes = np.array([len(p) for p in pieces])
    classes = np.maximum(2, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(int))
    for width in np.unique(classes).tolist():
        of_class = np.flatnonzero((classes == width) & (sizes > 0))
        step = max(1, (1 << 19) // width)
        for at in range(0, len(of_class), step):
            rows = of_class[at:at + step]
            for i, ids in zip(rows.tolist(), _merge_rows(vocabulary, [pieces[i] for i in rows], sizes[rows], width)):
                out[i] = ids
    return out


def _merge_rows(vocabulary: Vocabulary, pieces: list[bytes], sizes: np.ndarray, width: int) -> list[bytes]:
    """``_merge_rows`` keeps, per piece, tokens with links to their neighbours, and the segment tree: node 1 is the root, the leaf of
    the pair that starts at place p is node width + p."""
    n = len(pieces)
    ids = np.full((n, width + 2), -1, np.int64)  # places 1 to width; a missing token at both ends
    inside = np.arange(width) < sizes[:, None]
    ids[:, 1:-1][inside] = vocabulary.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
    after = np.tile(np.arange(1, width + 3), (n, 1))
    before = np.tile(np.arange(-1, width + 1), (n, 1))
    tree = np.full((n, 2 * width), _NONE)
    places = np.arange(width)
    ranks = vocabulary.rank(ids[:, 1:-1], ids[:, 2:])
    tree[:, width:] = np.where(ranks == _NONE, _NONE, (ranks << _PLACE) | places)
    level = width
    while level > 1:
        level //= 2
        tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
    rows = np.arange(n)
    while True:
        root = tree[rows, 1]
        rows = rows[root != _NONE]
        root = root[root != _NONE]
        if not len(rows):
            break
        place = (root & ((1 << _PLACE) - 1)) + 1
        right = after[rows, place]
        beyond, left = after[rows, right], before[rows, place]
        ids[rows, place] = vocabulary.merged[root >> _PLACE]
        ids[rows, right] = -1
        after[rows, place] = beyond
        before[rows, beyond] = place
        pair_left = np.stack([ids[rows, left], ids[rows, place]], 1)
        pair_right = np.stack([ids[rows, place], ids[rows, beyond]], 1)
        found = vocabulary.rank(pair_left, pair_right)
        start = np.stack([left, place], 1) - 1
        column = rows[:, None]
        # A pair that would start before the first place has no leaf; its value goes to the leaf that a merge empties.
        node = width + np.concatenate([np.where(start < 0, (right - 1)[:, None], start), (right - 1)[:, None]], 1)
        value = np.concatenate([np.where(found == _NONE, _NONE, (found << _PLACE) | np.maximum(start, 0)), np.full((len(rows), 1), _NONE)], 1)
        tree[column, node] = value
        while node[0, 0] > 1:
            node >>= 1
            tree[column, node] = np.minimum(tree[column, 2 * node], tree[column, 2 * node + 1])
    kept = ids[:, 1:-1] >= 0
    flat = ids[:, 1:-1][kept].astype("<u4").tobytes()
    ends = np.cumsum(kept.sum(1)) * 4
    return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


class Encoder:
    """Encodes texts, with the ids of pieces met before in a cache of bounded size."""

    def __init__(self, vocabulary: Vocabulary, cache_pieces: int = CACHE_PIECES):
        self.vocabulary, self.limit = vocabulary, cache_pieces
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pattern = regex.compile(PATTERN)
        added = sorted(vocabulary.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = [self._pieces(t) for t in texts]
        new: set[str] = set()
        for p in pieces:
            new.update(p)
        known = self._known(new)
        get = known.__getitem__
        return [b"".join(map(get, p)) for p in pieces]

    def _pieces(self, text: str) -> list[str]:
        if self.added is None or not any(a in text for a in self.vocabulary.added):
            return self.pattern.findall(text)
        out: list[str] = []
        for k, part in enumerate(self.added.split(text)):
            out.extend([part] if k % 2 else self.pattern.findall(part))
        return out

    def _known(self, wanted: set[str]) -> dict[str, bytes]:
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        missing = []
        for p in wanted:
            if p not in young:
                if p in old:
                    young[p] = old[p]
                else:
                    missing.append(p)
        if missing:
            for p, ids in zip(missing, merge_pieces(self.vocabulary, [p.encode() for p in missing])):
                young[p] = ids
            for text, i in self.vocabulary.added.items():
                young[text] = i.to_bytes(4, "little")
        return young


def decode(vocabulary: Vocabulary, ids: bytes) -> str:
    """The text of ids, added tokens included; bytes that are no UTF-8 become the replacement character."""
    tokens = np.frombuffer(ids, "<u4")
    return vocabulary.bytes[C.ranges(vocabulary.starts[tokens], vocabulary.lengths[tokens])].tobytes().decode("utf-8", "replace")


def encode(docs: DataFrame, vocabulary_path: str, text_col: str = "text", ids_name: str = "ids", decoded_name: str | None = None) -> DataFrame:
    """All rows and columns of ``docs`` and ``n_tokens``, the token ids (binary: little-endian unsigned 32-bit integers) and, if a name is
    given for it, the text decoded from them.

    Null and empty texts have no tokens and decode to the empty text. Added tokens in a text are tokens. New columns that clash with
    others get underscores. Rows are encoded one by one, so repeated rows, null ids and empty tables need no care."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))
    new = {"n_tokens": T.LongType(), ids_name: T.BinaryType()} | ({decoded_name: T.StringType()} if decoded_name else {})
    names = []
    for name in new:
        held = docs.select(*docs.columns, *(F.lit(None).alias(x) for x in names)) if names else docs
        names.append(C.free_name(held, name))
    rest = [f"rest_{i}" for i in range(len(docs.columns))]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("encoded_text")
    plain = docs.select(text, *(F.col(f"`{c}`").alias(r) for c, r in zip(docs.columns, rest)))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            for part in _parts(batch):
                ids = encoder.encode(part.column(0).to_pylist())
                columns = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                if decoded_name:
                    columns.append(pa.array([decode(vocabulary.value, x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *columns], names=[*rest, *names])

    schema = T.StructType([*(T.StructField(r, f.dataType) for r, f in zip(rest, docs.schema.fields)), *(T.StructField(n, t) for n, t in zip(names, new.values()))])
    out = plain.mapInArrow(encoded, schema)
    return out.select(*(F.col(r).alias(c) for c, r in zip(docs.columns, rest)), *names)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about a chunk of text each."""
    sizes = np.array(pa.compute.binary_length(batch.column(0)).to_pylist(), np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + C.CHUNK_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to
