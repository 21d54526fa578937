"""Shared helpers: where to keep intermediate tables, packed blocks of texts, words and hashes as numpy arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: White space between words, and a word, as patterns of Java, Python and DuckDB alike.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text in a packed block. A longer document has a block of its own.
BLOCK_BYTES = 2 << 20
#: Bytes of text handled at once where nothing is kept: the arrays stay in the processor's caches.
CHUNK_BYTES = 1 << 20
MAX_BUCKETS = 8192
#: Shards of text grow with the number of blocks; a block sends rows only to those it has stretches for.
MAX_SHARDS = 1 << 20

#: Stands for a null id inside the operators; results have null again.
NULL_ID = -(1 << 63)

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_ODD = 0x5851F42D4C957F2D
_HALF = np.uint64(32)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# Columns


def word_array(text: Column) -> Column:
    """The words of a text column that is not null."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


# Tables between steps


def workdir(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables: in ``spark.checkpoint.dir``, which all executors share. Only where that
    is unset, as in tests on one machine, a temporary folder is made and set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"file://{tempfile.mkdtemp(prefix='changeflow-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Writes ``df`` as Parquet and reads it back: cuts the lineage by a table that outlives lost executors."""
    path = f"{folder}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened by underscores until no column of ``df`` has it (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# Hashes


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
_POWERS = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        both = []
        for base in (_ODD, pow(_ODD, -1, 1 << 64)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
            both.append(p)
        _POWERS[size] = tuple(both)
    return _POWERS[size]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` (64-bit symbols) for each span, by prefix sums of a polynomial.

    For spans of up to some hundred symbols, which may overlap; modulo 2^64, longer ones can be built that agree (see ``word_hashes``)."""
    power, inverse = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[:len(values)], out=sums[1:])
    h = sums[ends] - sums[starts]
    h *= inverse[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) * _GOLDEN))


def _placed_value(byte: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix(_BYTE_VALUE[byte] + place.astype(np.uint64) * _GOLDEN)


#: Bytes at the first places of a word, mixed beforehand.
_NEAR = 64
_PLACED = _placed_value(np.tile(np.arange(256), _NEAR), np.repeat(np.arange(_NEAR), 256))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes ``data[start:end]`` for each of the spans, which follow each other and do not overlap.

    Every byte is mixed with its place in the span before the sum, so no two words agree by their structure, however long."""
    lengths = ends - starts
    place = ranges(np.zeros(len(starts), np.int64), lengths)
    inside = data[ranges(starts, lengths)]
    values = _PLACED[(np.minimum(place, _NEAR - 1) << 8) | inside]
    far = np.flatnonzero(place >= _NEAR)
    values[far] = _placed_value(inside[far], place[far])
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    to = np.cumsum(lengths)
    return mix((sums[to] - sums[to - lengths]) ^ (lengths.astype(np.uint64) * _GOLDEN))


def window_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of ``k`` symbols, in order; the window at i starts at i."""
    n = max(0, len(values) - k + 1)
    starts = np.arange(n)
    return span_hashes(values, starts, starts + k)


def rolling_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of ``k`` symbols, by doubling: cheaper than ``window_hashes`` where every window is wanted."""
    out, size, block, width, base = None, 0, values, 1, _ODD
    while k:
        if k & 1:
            n = len(values) - size - width + 1
            out = block if out is None else out[:max(n, 0)] * np.uint64(base) + block[size:size + max(n, 0)]
            size += width
        k >>= 1
        if k:
            n = max(len(block) - width, 0)
            block = block[:n] * np.uint64(base) + block[width:width + n]
            width, base = 2 * width, base * base % (1 << 64)
    return mix(out)


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return _LOWER[data]


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUE[data]


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each window of ``w`` values, by doubling."""
    out, size = values, 1
    while size * 2 <= w:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[:len(out) - (w - size)], out[w - size:]) if w > size else out


# Packed blocks


class Texts:
    """Texts of a block: ids, the bytes of all texts end to end, where each text starts, and the rows' other columns."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, rest: pa.Table | None = None):
        self.ids, self.data, self.offsets, self.rest = ids, data, offsets, rest

    def __len__(self) -> int:
        return len(self.ids)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def texts_of(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[Texts]:
    """Texts of at most ``limit`` bytes together (or one longer text) from batches of (id, text); null is empty.

    Batches of few rows are joined, large ones are cut, both in place in Arrow's buffers."""
    held, size = [], 0
    for batch in batches:
        texts = batch.column(1).cast(pa.large_string()) if not pa.types.is_large_string(batch.column(1).type) else batch.column(1)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
        at = 0
        while at < len(ids):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit - size, "right")) - 1)
            to = min(to, len(ids))
            more = int(offsets[to] - offsets[at])
            if held and size + more > limit:
                yield _joined(held)
                held, size = [], 0
                continue
            held.append((ids[at:to], data[offsets[at]:offsets[to]], np.diff(offsets[at:to + 1]), batch.slice(at, to - at)))
            size += more
            at = to
    if held:
        yield _joined(held)


def _joined(held: list) -> Texts:
    lengths = np.concatenate([x[2] for x in held])
    rest = pa.Table.from_batches([x[3] for x in held]).drop_columns(held[0][3].schema.names[:2]) if held[0][3].num_columns > 2 else None
    return Texts(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]),
                 np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), rest)


PACKED = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("offsets", pa.binary()), ("data", pa.binary()), ("rest", pa.binary())])
PACKED_COLUMNS = "block long, ids binary, offsets binary, data binary, rest binary"


def pack(block: int, texts: Texts) -> dict:
    """A block as one row: compressed text, and the other columns as an Arrow stream."""
    rest = None
    if texts.rest is not None:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, texts.rest.schema) as out:
            out.write_table(texts.rest)
        rest = sink.getvalue().to_pybytes()
    return {"block": block, "ids": texts.ids.astype("<i8").tobytes(), "offsets": texts.offsets.astype("<i8").tobytes(),
            "data": pa.Codec("zstd", compression_level=3).compress(texts.data, asbytes=True), "rest": rest}


def unpack(row: dict) -> Texts:
    offsets = np.frombuffer(row["offsets"], "<i8")
    data = pa.Codec("zstd").decompress(row["data"], decompressed_size=int(offsets[-1]), asbytes=True) if offsets[-1] else b""
    rest = pa.ipc.open_stream(row["rest"]).read_all() if row["rest"] is not None else None
    return Texts(np.frombuffer(row["ids"], "<i8"), np.frombuffer(data, np.uint8), offsets, rest)


def text_column(docs: DataFrame, id_col: str, text_col: str, keep: bool = False) -> DataFrame:
    """(id long with null as ``NULL_ID``, text string with null as empty); ``keep`` adds whether the text is null, and all
    columns but the text by their place, so that names cannot clash."""
    rest = [F.col(text_col).isNull().alias("rest"), *(F.col(f"`{c}`").alias(f"rest_{i}") for i, c in enumerate(docs.columns) if c != text_col)]
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *(rest if keep else []))


def rest_fields(docs: DataFrame, text_col: str) -> list[tuple[str, T.DataType, str]]:
    """(name within the operator, type, name in ``docs``) of the columns that ``text_column(keep=True)`` adds after the flag."""
    return [(f"rest_{i}", f.dataType, f.name) for i, f in enumerate(docs.schema.fields) if f.name != text_col]


def id_or_null(column: str = "id") -> Column:
    return F.nullif(F.col(column), F.lit(NULL_ID))


def blocks(docs: DataFrame, folder: str, extra: pa.Schema, columns: str, digest: Callable[[Texts], dict],
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The texts of ``text_column`` packed in blocks, with the columns that ``digest`` makes of each block, written to ``folder``
    and read back. A block's number holds the input partition and the place in it, so blocks of sorted partitions come in order."""
    schema = pa.schema([*PACKED, *extra])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for k, texts in enumerate(texts_of(batches, block_bytes)):
            yield rows_batch([pack(part + k, texts) | digest(texts)], schema)

    return saved(docs.mapInArrow(packed, f"{PACKED_COLUMNS}, {columns}" if columns else PACKED_COLUMNS), folder, "blocks")


def rows_batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


# Words


class Words:
    """Words of a block's texts: byte spans, hashes if wanted, and the range of words of each text."""

    def __init__(self, texts: Texts, lower: bool = False, hashes: bool = True):
        data = _LOWER[texts.data] if lower else texts.data
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~_IS_SPACE[data]
        begins = inside[1:] & ~inside[:-1]
        # A word ends where its text ends.
        cut = texts.offsets[:-1]
        cut = cut[cut < n]
        begins[cut] |= inside[1:][cut]
        ends = inside[:-1] & ~inside[1:]
        ends[texts.offsets] |= inside[:-1][texts.offsets]
        self.starts, self.ends = np.flatnonzero(begins[:n]), np.flatnonzero(ends)
        if hashes:
            self.hashes = word_hashes(data, self.starts, self.ends)
        self.bounds = np.searchsorted(self.starts, texts.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def windows(self, k: int) -> np.ndarray:
        """The first words of all windows of ``k`` words that lie in one text."""
        counts = np.maximum(self.counts() - k + 1, 0)
        return ranges(self.bounds[:-1], counts)


def word_codes(texts: Texts, words: Words, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, equal for equal words only, and the distinct words that the numbers stand for."""
    data = _LOWER[texts.data] if lower else texts.data
    ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int64)
    flat = data[~_IS_SPACE[data]]
    told = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(flat)]).dictionary_encode()
    return told.indices.to_numpy(zero_copy_only=False).astype(np.int64), told.dictionary


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count numbers) for each start, end to end."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before - starts, counts)


def stretches(runs: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups windows by their anchor: the leftmost of the ``width`` runs in a window with the smallest hash (of 32 bits).

    ``starts`` are the windows in order. Returns the first and last window of each stretch, which is a row of windows with one anchor,
    and a hash of the anchor. Equal windows have equal anchors at equal places."""
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # The place stands in the low half of a number whose high half is the hash, so the smallest number tells both.
    placed = runs >> _HALF
    placed <<= _HALF
    placed |= np.arange(len(runs), dtype=np.uint64)
    anchor = sliding_min(placed, width).astype(np.uint32)[starts]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    # The smallest of many hashes are small numbers; mixed again they spread evenly over the buckets.
    return starts[at], starts[np.append(at[1:], n) - 1], mix(runs[anchor[at]] ^ _GOLDEN)


# Exchange: what do other blocks know about my keys?


def key_bits(count: int, most: int = MAX_BUCKETS) -> int:
    """Bits that number the buckets for ``count`` blocks: as many buckets as blocks, 64 to ``most``."""
    return int(np.clip(max(1, count - 1).bit_length(), 6, most.bit_length() - 1))


def replies(asked: DataFrame, answer: Callable[[list[dict]], list[bytes]], folder: str, name: str) -> DataFrame:
    """Brings the rows (bucket, block, ...) of a bucket together, lets ``answer`` give bytes for each row, and returns them by
    block: (block, replies: array of (bucket, reply)).

    A block sends a key once, so a key that is everywhere costs a bucket one entry per block, and buckets are even."""
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("reply", pa.binary())])

    def answered(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        return pa.Table.from_pylist([{"bucket": r["bucket"], "block": r["block"], "reply": a} for r, a in zip(rows, answer(rows))], schema=schema)

    told = asked.groupBy("bucket").applyInArrow(answered, "bucket int, block long, reply binary")
    return saved(told.groupBy("block").agg(F.collect_list(F.struct("bucket", "reply")).alias("replies")), folder, name)


def with_replies(packed: DataFrame, told: DataFrame) -> DataFrame:
    """The blocks with their replies; blocks that asked nothing have null. Joined by shuffle at every size, so that what a larger
    input takes can be told from a smaller one."""
    return packed.join(told.hint("merge"), "block", "left")


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct 64-bit keys as differences, in as many bytes each as the largest needs."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=np.uint64(0))
    steps[0] = 0
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    low = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[1:, :width]
    return bytes([width]) + int(keys[0]).to_bytes(8, "little") + low.tobytes()


def unpacked_keys(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    width, first = blob[0], int.from_bytes(blob[1:9], "little")
    low = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(low) + 1, 8), np.uint8)
    steps[1:, :width] = low
    steps = steps.view("<u8").ravel()
    steps[0] = first
    return np.cumsum(steps, dtype=np.uint64)


def bucket_slices(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) over sorted keys; a bucket is a range of keys, given by their first ``bits`` bits."""
    edges = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    edges = np.append(edges, len(keys))
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), int(edges[b]), int(edges[b + 1])
