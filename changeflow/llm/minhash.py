"""MinHash near-dedup: circulant MinHash, banding, and exact Jaccard verification.

Two permutations of the 32-bit numbers make all coordinates of a signature: the first scatters the shingles; the second,
shifted around the circle by k, gives coordinate k as the smallest value that any shingle gets. Bands of coordinates are the
keys under which documents meet. Links between documents are confirmed on their full shingle sets.

Nothing here lists all pairs of a group. Documents with one shingle set are one class. In a first round the
members of each band key meet the key's smallest and largest class only, which connects groups of near copies. In a second
one, the keys whose members still lie in different components compare exactly those members across components.
What remains undecided then cannot change a component."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.llm import common as C
from changeflow.llm.components import components

#: 32 bands of 4: a pair at the threshold of 0.8 shares no band once in 2e7.
BANDS, BAND_ROWS = 32, 4
_M1, _M2 = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)
_CHUNK = 1 << 14
#: Documents in a block of the grid in which members are compared across components.
GRID = 2000


def _scatter(x: np.ndarray) -> np.ndarray:
    """The first permutation, of shingle hashes brought to 32 bits."""
    return (C.mix(x) >> np.uint64(32)).astype(np.uint32)


def _circled(x: np.ndarray, shift: int) -> np.ndarray:
    """The second permutation, of numbers moved around the circle by ``shift``."""
    y = x + np.uint32(shift)
    y ^= y >> np.uint32(16)
    y *= _M1
    y ^= y >> np.uint32(13)
    y *= _M2
    y ^= y >> np.uint32(16)
    return y


def shingle_sets(texts: C.Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of shingles of ``k`` lower-cased words, text after text, and how many each text has.
    With fewer words than ``k`` the whole sequence is one shingle; without words there is none."""
    words = C.Words(texts, lower=True)
    counts = words.counts()
    per_text = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    starts = C.ranges(words.bounds[:-1], per_text)
    owner = np.repeat(np.arange(len(texts)), per_text)
    lengths = np.minimum(k, counts)[owner]
    hashes = C.span_hashes(words.hashes, starts, starts + lengths)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.bincount(owner[new], minlength=len(texts))


def signatures(hashes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """One row of ``size`` coordinates per text; texts without shingles have no row."""
    counts = counts[counts > 0]
    out = np.empty((len(counts), size), np.uint32)
    scattered = _scatter(hashes)
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        base = ends[at] - counts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + _CHUNK, "right")))
        part = scattered[base:ends[to - 1]]
        starts = (ends[at:to] - counts[at:to] - base)
        for k in range(size):
            out[at:to, k] = np.minimum.reduceat(_circled(part, k), starts)
        at = to
    return out


def set_marks(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and a 128-bit hash of each text's set, as 64-bit integers."""
    some = np.flatnonzero(counts)
    out = np.zeros((2, len(counts)), np.uint64)
    if len(some):
        starts = (np.cumsum(counts) - counts)[some]
        for i, salt in enumerate((0, 0x5DEECE66D1CE4E5B)):
            out[i, some] = np.add.reduceat(C.mix(hashes ^ np.uint64(salt)), starts)
    return counts.astype(np.int64), out[0].view(np.int64), out[1].view(np.int64)


_SIG_SCHEMA = "id long, n_shingles long, set_a long, set_b long, keys binary, sketch binary"
_SIG_ARROW = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("keys", pa.binary()), ("sketch", pa.binary())])


def band_signatures(docs: DataFrame, id_col: str, text_col: str, k: int, bands: int, rows: int) -> DataFrame:
    """(id, n_shingles, a 128-bit hash of the set, one 64-bit key per band, the last byte of each coordinate) of each document."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in C.texts_of(batches, C.CHUNK_BYTES):
            hashes, counts = shingle_sets(texts, k)
            some = np.flatnonzero(counts)
            keys: list = [None] * len(texts)
            sketch: list = [None] * len(texts)
            n, set_a, set_b = set_marks(hashes, counts)
            if len(some):
                sig = signatures(hashes, counts, bands * rows)
                mixed = np.zeros((len(some), bands), np.uint64) + C.mix(np.arange(1, bands + 1, dtype=np.uint64))
                for r in range(rows):
                    mixed = C.mix(mixed ^ sig[:, r::rows])
                for i, row, low in zip(some, mixed, sig.astype(np.uint8)):
                    keys[i], sketch[i] = row.tobytes(), low.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(texts.ids), pa.array(n), pa.array(set_a), pa.array(set_b), pa.array(keys, pa.binary()),
                                              pa.array(sketch, pa.binary())], schema=_SIG_ARROW)

    return C.text_column(docs, id_col, text_col).mapInArrow(signed, _SIG_SCHEMA)


def band_rows(classes: DataFrame, bands: int) -> DataFrame:
    """(rep, n_shingles, key): a row per class and band."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            blob = b"".join(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rep, bands)), pa.array(np.repeat(n, bands)),
                                              pa.array(np.frombuffer(blob, np.int64))], names=["rep", "n_shingles", "key"])

    return classes.select("rep", "n_shingles", "keys").mapInArrow(spread, "rep long, n_shingles long, key long")


def across_parts(open_rows: DataFrame, texts: DataFrame, sketches: DataFrame, folder: str, k: int, percent: int, size: int) -> DataFrame:
    """Links (a, b) between members of keys whose members lie in different parts: enough to join all parts that any pair joins.

    Members that meet under any key are one pool. Those outside the pool's main part are compared with all of
    it, in blocks of a grid: a task holds two blocks of documents at most, and returns links, not pairs. Sizes and signatures rule
    most pairs out; the others are compared by their full sets, until their parts are joined."""
    # A pair at the threshold agrees in so few coordinates once in 3e7.
    share = percent / 100
    least = int(share * size - 5.4 * (share * (1 - share) * size) ** 0.5)
    low = open_rows.groupBy("key").agg(F.min("rep").alias("low"))
    pools = components(open_rows.join(low, "key").select(F.col("low").alias("a"), F.col("rep").alias("b")), folder, "pools")
    members = C.saved(open_rows.select("rep", "part").distinct().join(pools.select(F.col("node").alias("rep"), F.col("component").alias("pool")), "rep"), folder, "members")
    sizes = members.groupBy("pool", "part").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("pool").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.sum("n").alias("n"), F.max("n").alias("of_main")).select(
        "pool", "main", F.ceil(F.col("n") / GRID).cast("int").alias("all_blocks"), F.ceil((F.col("n") - F.col("of_main")) / GRID).cast("int").alias("other_blocks"))
    met = members.join(sizes, "pool").join(sketches, "rep").join(texts.select(F.col("id").alias("rep"), "t.size", "t.text"), "rep")
    met = C.saved(met, folder, "pooled")
    salt = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    kept = ["pool", "rep", "part", "sketch", "size", "text"]
    left = met.where("part != main").select(*kept, F.lit(True).alias("outer"), salt(F.col("other_blocks")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)).alias("j"))
    right = met.select(*kept, F.lit(False).alias("outer"), F.explode(F.sequence(F.lit(0), F.col("other_blocks") - 1)).alias("i"), salt(F.col("all_blocks")).alias("j"))

    def compared(group: pa.Table) -> pa.Table:
        rep, part = (group.column(c).to_numpy() for c in ("rep", "part"))
        outer = group.column("outer").to_numpy(zero_copy_only=False).astype(bool)
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(-1, size)
        hashes, counts = shingle_sets(_unpacked(group.column("size").to_pylist(), group.column("text").to_pylist()), k)
        ends = np.cumsum(counts)
        joined: dict[int, int] = {}

        def root(x: int) -> int:
            while joined.get(x, x) != x:
                x = joined[x]
            return x

        inner, found = np.flatnonzero(~outer), []
        for x in np.flatnonzero(outer):
            could = inner[(part[inner] != part[x]) & (100 * np.minimum(counts[inner], counts[x]) >= percent * np.maximum(counts[inner], counts[x]))]
            for y in could[(sketch[could] == sketch[x]).sum(1) >= least]:
                p, q = root(int(part[x])), root(int(part[y]))
                if p == q:
                    continue
                same = len(np.intersect1d(hashes[ends[x] - counts[x]:ends[x]], hashes[ends[y] - counts[y]:ends[y]], assume_unique=True))
                if 100 * same >= percent * (counts[x] + counts[y] - same):
                    joined[max(p, q)] = min(p, q)
                    found.append((int(rep[x]), int(rep[y])))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return C.saved(left.union(right).groupBy("pool", "i", "j").applyInArrow(compared, "a long, b long"), folder, "across")


def _unpacked(sizes: list[int], texts: list[bytes]) -> C.Texts:
    codec = pa.Codec("zstd")
    blobs = [codec.decompress(t, decompressed_size=n, asbytes=True) if n else b"" for n, t in zip(sizes, texts)]
    return C.Texts(np.arange(len(blobs)), np.frombuffer(b"".join(blobs), np.uint8), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))


def packed_texts(ids: DataFrame, docs: DataFrame, folder: str, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, t: n_shingles, set_a, set_b, size, compressed text) of the documents with these ids, of each the one with the smallest set."""

    def squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=3)
        for texts in C.texts_of(batches, C.CHUNK_BYTES):
            n, set_a, set_b = set_marks(*shingle_sets(texts, k))
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts.ids), pa.array(n), pa.array(set_a), pa.array(set_b), pa.array(np.diff(texts.offsets)),
                 pa.array([codec.compress(texts.text(i), asbytes=True) for i in range(len(texts))], pa.binary())],
                names=["id", "n_shingles", "set_a", "set_b", "size", "text"])

    # Joined by shuffle at every size, so that what a larger input takes can be told from a smaller one.
    texts = C.text_column(docs, id_col, text_col).join(ids.hint("merge"), "id", "left_semi").mapInArrow(
        squeezed, "id long, n_shingles long, set_a long, set_b long, size long, text binary").where("n_shingles > 0")
    return C.saved(texts.groupBy("id").agg(F.min(F.struct("n_shingles", "set_a", "set_b", "size", "text")).alias("t")), folder, "texts")


def verified(pairs: DataFrame, texts: DataFrame, folder: str, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough. The pair's first side, which may be one class with very many
    partners, is joined while rows are small."""
    one = pairs.join(texts.select(F.col("id").alias("a"), F.col("t").alias("ta")).hint("merge"), "a")
    two = one.join(texts.select(F.col("id").alias("b"), F.col("t").alias("tb")).hint("merge"), "b").select(
        "a", "b", "ta.size", "ta.text", F.col("tb.size").alias("size_b"), F.col("tb.text").alias("text_b"))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                n = part.num_rows
                hashes, counts = shingle_sets(_unpacked([x for i in (2, 4) for x in part.column(i).to_pylist()], [x for i in (3, 5) for x in part.column(i).to_pylist()]), k)
                ends = np.cumsum(counts)
                sets = [hashes[e - c:e] for e, c in zip(ends, counts)]
                same = np.array([len(np.intersect1d(sets[i], sets[n + i], assume_unique=True)) for i in range(n)], np.int64)
                union = counts[:n] + counts[n:] - same
                yield part.select([0, 1]).filter(pa.array((100 * same >= percent * union) & (union > 0)))

    return C.saved(two.mapInArrow(similar, "a long, b long"), folder, "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
                    bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of ``docs``: documents whose sets of ``k``-word shingles have
    a Jaccard similarity of at least ``percent`` / 100 are linked; a component is named by its smallest id, the one that is kept.

    Null and empty texts have no shingles and link with nothing. Rows with one id are one document; if their sets
    differ, the one with the fewest shingles (then the smaller hash) stands for it. Rows without id link with nothing,
    have no component and are kept. No rows give no rows. Other columns are not looked at."""
    folder = C.workdir(docs.sparkSession, "minhash")
    signed = C.saved(band_signatures(docs, id_col, text_col, k, bands, rows), folder, "signatures")
    some = signed.where((F.col("n_shingles") > 0) & (F.col("id") != C.NULL_ID))
    one = some.groupBy("id").agg(F.min(F.struct("n_shingles", "set_a", "set_b", "keys", "sketch")).alias("s")).select("id", "s.*")
    classes = C.saved(one.groupBy("n_shingles", "set_a", "set_b").agg(F.min("id").alias("rep"), F.min("keys").alias("keys"), F.min("sketch").alias("sketch"),
                                                                      F.count("*").alias("copies")), folder, "classes")
    shared = C.saved(_shared_keys(classes, bands), folder, "shared")

    ends = shared.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
    met = shared.join(ends, "key")
    first = met.select(F.col("low").alias("a"), F.col("rep").alias("b")).union(met.select("high", "rep"))
    first = C.saved(_ordered(first).distinct(), folder, "first")
    texts = packed_texts(shared.select(F.col("rep").alias("id")).distinct(), docs, folder, id_col, text_col, k)
    links = verified(first, texts, folder, k, percent)
    found = components(links, folder, "first-components")

    # Keys whose members are not all in one component: those members are compared across components.
    placed = shared.join(found, shared.rep == found.node, "left").select("key", "rep", F.coalesce("component", "rep").alias("part"))
    mixed = placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low != high").select("key")
    open_rows = C.saved(placed.join(mixed, "key"), folder, "open")
    more = across_parts(open_rows, texts, classes.select("rep", "sketch"), folder, k, percent, bands * rows)
    if not more.isEmpty():
        # What the first round has joined goes on as one edge per document.
        joined = found.select(F.col("component").alias("a"), F.col("node").alias("b"))
        found = components(joined.union(more), folder, "second-components")

    # Only documents with copies or links need a name; the others are their own component.
    named = classes.join(found, classes.rep == found.node, "left").where("copies > 1 or component is not null").select(
        "n_shingles", "set_a", "set_b", F.coalesce("component", "rep").alias("component_id"))
    placed = one.drop("keys", "sketch").join(named, ["n_shingles", "set_a", "set_b"]).select("id", "component_id")
    return signed.select("id", "n_shingles").join(placed, "id", "left").select(
        C.id_or_null().alias("id"), "n_shingles",
        F.when(F.col("id") != C.NULL_ID, F.coalesce("component_id", "id")).alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``near_duplicates`` keeps: one document of each component.

    Rows that share an id and a text (null is empty) are one document, of which one row stays. Rows that share an id only are documents of their
    own: each is compared, and stays unless its own text is in a component of another that stays. Rows without id all stay."""
    folder = C.workdir(docs.sparkSession, "minhash-kept")
    units = _units(docs, id_col, text_col, folder)
    found = C.saved(near_duplicates(units, "unit", "text", k, percent), folder, "kept")
    kept = found.where("kept and id is not null").groupBy("id").agg(F.count("*").alias("rows"))
    kept = kept.select(F.col("id").alias("kept_id"), "rows").hint("merge")
    met = units.join(kept, F.col("unit") == F.col("kept_id"))
    once = met.where("rows = 1").select("row.*")
    several = met.where("rows > 1").groupBy("unit").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*")
    return once.union(several).union(docs.where(F.col(id_col).isNull()))


def _units(docs: DataFrame, id_col: str, text_col: str, folder: str) -> DataFrame:
    """(row, unit, text): the id, or where rows with different texts share one, a number made of id and text. These numbers are below
    -2^62, out of the way of ids."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    held = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    shared = C.saved(held.where("id is not null").groupBy("id").agg(F.min(mark).alias("low"), F.max(mark).alias("high"))
                     .where("low != high").select(F.col("id").alias("shared_id")), folder, "shared-ids")
    if shared.isEmpty():
        return held.withColumnRenamed("id", "unit")
    apart = -F.lit(1 << 62) - 1 - F.shiftrightunsigned(F.xxhash64("id", F.coalesce("text", F.lit(""))), 3)
    return held.join(shared.hint("merge"), F.col("id") == F.col("shared_id"), "left").select(
        "row", F.when(F.col("shared_id").isNull(), F.col("id")).otherwise(apart).alias("unit"), "text")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _shared_keys(classes: DataFrame, bands: int) -> DataFrame:
    """(key, rep, n_shingles) for keys of more than one class."""
    spread = band_rows(classes, bands)
    several = spread.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return spread.join(several.hint("merge"), "key").select("key", "rep", "n_shingles")
