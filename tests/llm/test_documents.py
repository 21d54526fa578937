"""Operators on documents against brute force, over texts and rows of every awkward kind."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changeflow.llm import bpe, common as C, licenses, lm, minhash, mixing, quality, substrings, suffixes

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_suffix_order():
    rnd = random.Random(2)
    for _ in range(200):
        a = np.array([rnd.randint(1, 3) for _ in range(rnd.randint(1, 60))])
        depth = rnd.choice([2, 3, 5, 9, 20, 100])
        order = suffixes.suffix_order(a, depth).tolist()
        prefixes = [tuple((a.tolist() + [0] * depth)[i:i + depth]) for i in order]
        assert sorted(order) == list(range(len(a))) and prefixes == sorted(prefixes)


def test_suffix_order_of_many_symbols():
    """Triples of names above 2^21 have no product in 64 bits."""
    rnd = np.random.default_rng(8)
    for high in (3_000_000, 5_000_000, 1 << 31):
        pool = rnd.integers(1, high, 40)
        a = rnd.choice(pool, 400)
        order = suffixes.suffix_order(a, 50).tolist()
        tails = [[*a[i:i + 50].tolist(), *[0] * 50][:50] for i in order]
        assert sorted(order) == list(range(len(a))) and tails == sorted(tails)


def test_shards_grow_with_blocks():
    assert C.key_bits(1 << 17) == 13 and C.key_bits(1 << 17, C.MAX_SHARDS) == 17 and C.key_bits(500, C.MAX_SHARDS) == C.key_bits(500)


@pytest.mark.parametrize("part_bytes", [7, 64, 1000, 1 << 17])
@pytest.mark.parametrize("length", [1, 20, 50])
def test_stretches_of_parts(length, part_bytes):
    """Every window of a text with an id is in one stretch, whatever the parts; equal windows have one anchor."""
    rnd = random.Random(length)
    texts = ["".join(rnd.choices("ab", k=rnd.choice([0, 0, 1, 19, 49, 50, 51, 90, 400]))).encode() for _ in range(60)] + [b"", b"ab" * 700, b""]
    ids = np.array([C.NULL_ID if i % 9 == 4 else i // 2 for i in range(len(texts))])
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    block = C.Texts(ids, np.frombuffer(b"".join(texts), np.uint8), offsets)
    got = suffixes.Anchored(block, length, part_bytes)
    windows = [(int(w), int(d), int(k)) for f, t, d, k in zip(got.first, got.last, got.doc, got.keys) for w in range(f, t + 1)]
    want = [(int(o) + j, int(i)) for o, t, i in zip(offsets, texts, ids) if i != C.NULL_ID for j in range(len(t) - length + 1)]
    assert [w[:2] for w in windows] == want
    anchor = collections.defaultdict(set)
    for w, _, k in windows:
        anchor[bytes(block.data[w:w + length])].add(k)
    assert all(len(x) == 1 for x in anchor.values())
    keys, several, place = got.distinct()
    docs = {k: set(got.doc[got.keys == k].tolist()) for k in keys}
    assert (keys[place] == got.keys).all() and several.tolist() == [len(docs[k]) > 1 for k in keys] and (np.diff(keys.astype(object)) > 0).all()


@pytest.mark.parametrize("sort_bytes", [1, 300, 1 << 19])
def test_stretches_are_sorted_in_slices(sort_bytes):
    rnd = random.Random(9)
    length, rows, want = 10, [], []
    stretches = [(k % 7, rnd.randrange(20), bytes([97 + k % 7]) * 4 + bytes(rnd.choices(b"xy", k=rnd.randint(6, 9)))) for k in range(150)]
    smallest = {}
    for _, doc, t in stretches:
        for j in range(len(t) - length + 1):
            smallest[t[j:j + length]] = min(doc, smallest.get(t[j:j + length], doc))
    for part in (sorted(stretches[:90]), sorted(stretches[90:])):
        anchors, docs, texts = zip(*part)
        rows.append({"text": pa.Codec("zstd").compress(b"".join(texts), asbytes=True), "sizes": np.array([len(t) for t in texts], "<u4").tobytes(),
                     "docs": np.array(docs, "<i8").tobytes(), "anchors": np.array(anchors, "<u4").tobytes()})
        want.append(np.packbits([smallest[t[j:j + length]] < d for _, d, t in part for j in range(len(t) - length + 1)]).tobytes())
    assert suffixes._smaller(length, sort_bytes)(rows) == want


def test_rows_of_suffixes_grow_with_the_text(spark, monkeypatch):
    """A block has a row for each bucket: blocks are large, so that rows do not grow with the square of the text."""
    asked, replies = {}, C.replies
    monkeypatch.setattr(C, "replies", lambda df, answer, folder, name: asked.update({name: df.count()}) or replies(df, answer, folder, name))
    rnd = np.random.default_rng(3)
    texts = [bytes(rnd.integers(97, 123, 1 << 20, np.uint8)).decode() for _ in range(5)]
    docs = spark.createDataFrame(list(enumerate([*texts, texts[0]])), "doc_id long, text string").coalesce(1)
    got = {r.id: r.n_removed for r in suffixes.dedup_bytes(docs).collect()}
    assert got == {i: 0 for i in range(5)} | {5: 1 << 20}
    assert max(asked.values()) <= 64


@pytest.mark.parametrize("block_bytes", [1 << 21, 700])
def test_suffixes(edge, edge_rows, none, block_bytes):
    length, starts = 20, collections.defaultdict(set)
    for r in edge_rows:
        b = (r[1] or "").encode()
        if r[0] is not None:
            for j in range(len(b) - length + 1):
                starts[b[j:j + length]].add(r[0])
    want = []
    for r in edge_rows:
        b = (r[1] or "").encode()
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - length + 1):
            if r[0] is not None and min(starts[b[j:j + length]]) < r[0]:
                gone[j:j + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
        want.append((r[0], len(b), int(gone.sum()), len(edges) // 2, kept, [(int(x), int(y - x)) for x, y in edges.reshape(-1, 2)]))
    got = suffixes.dedup_bytes(edge, length=length, block_bytes=block_bytes).collect()
    same([(r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), [tuple(s) for s in r.spans]) for r in got], want)
    assert suffixes.dedup_bytes(none).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 21, 700])
def test_substrings(edge, edge_rows, none, block_bytes):
    window = 12
    counts = collections.Counter(tuple(w[j:j + window]) for r in edge_rows for w in [split(r[1])] for j in range(len(w) - window + 1))
    want = []
    for r in edge_rows:
        w = split(r[1])
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if counts[tuple(w[j:j + window])] > 1:
                gone[j:j + window] = [True] * window
        text = None if r[1] is None else " ".join(x for x, g in zip(w, gone) if not g)
        want.append((r[0], text, *r[2:], len(w), sum(gone)))
    got = substrings.dedup_substrings(edge, window=window, block_bytes=block_bytes)
    assert got.columns == [*edge.columns, "n_words", "n_removed"]
    same([tuple(r) for r in got.collect()], want)
    assert substrings.dedup_substrings(none).count() == 0
    clash = substrings.dedup_substrings(edge.withColumnRenamed("kept", "N_Words"), window=window)
    assert clash.columns[-2:] == ["n_words_", "n_removed"]


@pytest.mark.parametrize("hot, block_bytes", [(2, 700), (6, 700), (6, 1 << 21)])
def test_substrings_around_hot_anchors(spark, edge, edge_rows, hot, block_bytes):
    """Anchors with many stretches go by hashes of windows, with the same results, and no automaton gets their stretches."""
    whole, split_ = (sorted(map(str, substrings.dedup_substrings(edge, window=12, block_bytes=block_bytes, hot=h).collect())) for h in (10**9, hot))
    assert whole == split_
    keys = np.array([5, 9, 1 << 40], np.uint64)
    row = lambda n: {"keys": C.packed_keys(keys), "twice": np.packbits([0, 1, 1]).tobytes(), "many": np.array([[2, n]], "<u4").tobytes()}
    for reply in substrings._repeated_keys(6)([row(4), row(3)]):
        assert [np.unpackbits(np.array([x], np.uint8))[:3].tolist() for x in reply] == [[1, 1, 1], [0, 0, 1]]
    # The stretches of the passage in all of 40 texts are left to the exchange of windows.
    rnd = random.Random(6)
    text = lambda n: " ".join(str(rnd.random()) for _ in range(n))
    passage = text(30)
    anchored = substrings.Anchored(C.Words(next(C.texts_of([pa.record_batch({"id": list(range(40)), "text": [f"{text(9)} {passage} {text(9)}" for _ in range(40)]})]))), 12)
    keys, twice = substrings._distinct_keys(anchored.keys)
    asked = [{"bucket": b, "keys": C.packed_keys(keys[at:to]), "twice": np.packbits(twice[at:to]).tobytes(),
              "many": substrings._many(anchored.keys[np.isin(anchored.keys, keys[at:to])])} for b, at, to in C.bucket_slices(keys, 6)]
    found = [{"bucket": r["bucket"], "reply": substrings._repeated_keys(hot)([r])[0]} for r in asked]
    chosen, places, apart = substrings._candidates(anchored, found, 6)
    _, of_key, counts = np.unique(anchored.keys, return_inverse=True, return_counts=True)
    windows = anchored.last - anchored.first + 1
    assert counts.max() >= 40 and len(apart) == windows[counts[of_key] > hot].sum()
    assert (counts[of_key][chosen] <= hot).all() and (places[counts[of_key] > hot] == -1).all()


def shingles(text, k):
    w = split(lower(text))
    return frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(rows, k, percent):
    sets = {}
    for r in rows:
        s = shingles(r[1], k)
        if r[0] is not None and s:
            sets.setdefault(r[0], s)
    of = {r[0]: r[0] for r in rows}

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            of[max(x, y)] = min(x, y)
    return {i: find(i) for i in of if i is not None}


@pytest.mark.parametrize("k", [2, 5])
def test_minhash(edge, edge_rows, none, k):
    named = brute_components(edge_rows, k, 80)
    want = [(r[0], len(shingles(r[1], k)), named.get(r[0]), r[0] is None or named[r[0]] == r[0]) for r in edge_rows]
    same([tuple(r) for r in minhash.near_duplicates(edge, k=k).collect()], want)
    assert minhash.near_duplicates(none).count() == 0


def test_minhash_keeps_one_of_each_group(edge, edge_rows):
    named = brute_components(edge_rows, 5, 80)
    got = minhash.drop_near_duplicates(edge)
    assert got.columns == edge.columns
    ids = [r.doc_id for r in got.collect()]
    same(ids, [i for i in named if named[i] == i] + [None] * 3)


def test_minhash_second_round(spark):
    """A chain of near copies whose ends are far apart, and documents that share a passage without being alike."""
    rnd = random.Random(8)
    w = [f"w{rnd.randint(0, 10 ** 6)}" for _ in range(200)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(w)))
        w = w.copy()
        for j in rnd.sample(range(200), 6):
            w[j] = f"w{rnd.randint(0, 10 ** 6)}"
    shared = " ".join(f"p{i}" for i in range(70))
    rows += [(100 + i, shared + " " + " ".join(f"x{rnd.randint(0, 10 ** 6)}" for _ in range(20 + i % 7))) for i in range(60)]
    rnd.shuffle(rows)
    got = {r.id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()}
    assert got == brute_components(rows, 2, 80)


def test_bpe(edge, edge_rows, none):
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    got = bpe.encode(edge, path, decoded_name="decoded")
    assert got.columns == [*edge.columns, "n_tokens", "ids_", "decoded"]
    want = []
    for r in edge_rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((*r, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    same([(*r[:-2], bytes(r[-2]), r[-1]) for r in got.collect()], want)
    assert bpe.encode(none, path).count() == 0


def test_bpe_of_random_strings():
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    rnd, letters = random.Random(3), "abcdeABC  \n\t'sstthe 0129é日🙂\x1c\x1f\x85  ​　\x0b\x0c\r<|endoftext|>,.!?́؀²½"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(3000)] + ["x" * 5000, " " * 300 + "a", "<|endoftext|>" * 3]
    vocabulary = bpe.Vocabulary(path)
    library = tokenizers.Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    got = bpe.Encoder(vocabulary, cache_pieces=50).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [x.ids for x in library]
    assert [bpe.decode(vocabulary, g) for g in got] == texts


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm(edge, edge_rows, none, order):
    prior, counts = 50.0, collections.Counter()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    for r in edge_rows:
        if not held(r[0]):
            w = ["<s>", *split(lower(r[1])), "</s>"]
            counts[("<s>",)] += 1
            for j in range(1, len(w)):
                for n in range(min(order, j + 1)):
                    counts[tuple(w[j - n:j + 1])] += 1
    single = {k: c for k, c in counts.items() if len(k) == 1 and k != ("<s>",)}
    total = sum(single.values())

    def p(history, w):
        if not history:
            return (counts[(w,)] + 1) / (total + len(single) + 1)
        shorter, h = p(history[1:], w), counts[history]
        return (counts[(*history, w)] + prior * shorter) / (h + prior) if h else shorter

    got = collections.Counter()
    for r in lm.score(edge, order=order, prior=prior, block_bytes=3000).collect():
        got[(r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, f"{r.base_score:.6g}", f"{r.score:.6g}")] += 1
    want = collections.Counter()
    for r in edge_rows:
        w = ["<s>", *split(lower(r[1])), "</s>"]
        base = sum(math.log10(p((), x)) for x in w[1:])
        full = sum(math.log10(p(tuple(w[max(0, j - order + 1):j]), w[j])) for j in range(1, len(w)))
        want[(r[0], held(r[0]), len(w) - 1, sum((x,) in single for x in w[1:]), total, f"{base:.6g}", f"{full:.6g}")] += 1
    assert got == want
    assert lm.score(none).count() == 0


def test_quality_counts(edge, edge_rows, none):
    want = []
    for r in edge_rows:
        t, w = r[1] or "", split(r[1])
        runs = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        covered = {i + d for i in range(len(w) - 2) if runs[tuple(w[i:i + 3])] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want.append((r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed))
    got = quality.quality(edge)
    same([tuple(r) for r in got.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()], want)
    assert got.where("base_failed and kept").isEmpty()
    assert quality.quality(none).count() == 0
    kept = quality.filter_quality(edge)
    assert kept.columns == edge.columns and kept.count() == got.where("kept").count()


def test_quality_judges_texts_without_words(spark):
    rnd = random.Random(7)
    texts = [None, "", " ", "\n \n", "\t\x0b", "a b c", *(" ".join("".join(rnd.choices("abcdefgh", k=rnd.randint(2, 5))) for _ in range(80)) for _ in range(20))]
    docs = spark.createDataFrame([(i, t, lang, "s1") for i, t in enumerate(texts) for lang in ("en", None)], "doc_id long, text string, lang string, source string")
    got = {(r.id, r.lang): (r.n_words, r.base_failed, r.kept) for r in quality.quality(docs).collect()}
    want = {(i, lang): (len(split(t)), i < 6, i >= 6) for i, t in enumerate(texts) for lang in ("en", None)}
    assert got == want
    assert sorted(r.doc_id for r in quality.filter_quality(docs).collect()) == sorted(i for i, _ in want if i >= 6)


def test_quality_thresholds_follow_the_group(spark):
    """The same text is an outlier in one source and ordinary in another; quantiles stay within the sketch's error."""
    rnd = random.Random(1)
    body = lambda: " ".join(f"w{rnd.randint(0, 10 ** 6)}" for _ in range(100))
    rows = [(i, body(), "en", "plain") for i in range(400)] + [(1000 + i, body() + " |" * rnd.randint(40, 60), "en", "tables") for i in range(400)]
    rows += [(5000, body() + " |" * 50, "en", "plain"), (5001, body() + " |" * 50, "en", "tables"), (5002, body(), "xx", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.id: r.kept for r in quality.quality(docs, prior_docs=100).collect()}
    assert not got[5000] and got[5001] and got[5002] and sum(got.values()) == len(rows) - 1
    measured = quality.measured(docs, "text", [F.col("lang"), F.col("source")])
    limits = {(r.lang, r.source): r for r in quality._quartiles(quality.sketches(measured), ["lang", "source"]).collect()}
    values = sorted(r.v for r in measured.where("source = 'tables'").selectExpr("n_symbols / n_words v").collect())
    q1, q3 = values[len(values) // 4 - 1], values[len(values) * 3 // 4 - 1]
    spread = max(q3 - q1, quality.METRICS["symbols_per_word"][0])
    assert abs(limits[("en", "tables")].symbols_per_word.high - (q3 + quality.FENCE * spread)) < 0.08


def test_quality_thresholds_grow_out_of_the_parent(spark):
    """Fences of a source come near those of its own sketch as it grows, step by step; one document more changes little."""
    high = {}
    for n in (1, 299, 300, 100_000):
        rows = [("en", s, m, 0, k) for s, k in (("big", 3000), ("own", 0)) for m in quality.METRICS if k]
        rows += [("en", "own", m, b, n) for m in quality.METRICS for b in (20, 60)]
        sketch = spark.createDataFrame(rows, "lang string, source string, metric string, bucket int, n long")
        high[n] = {r.t_source: r.t.chars_per_word.high for r in quality.thresholds(sketch).collect()}
        again = quality.thresholds(sketch.repartition(7, "bucket", "metric")).collect()
        assert high[n] == {r.t_source: r.t.chars_per_word.high for r in again}
    alone = quality._quartiles(sketch.where("source = 'own'"), ["source"]).first().chars_per_word.high
    assert abs(high[1]["own"] - high[1]["big"]) < 1e-9 and abs(high[100_000]["own"] - alone) < 1e-9 and high[1]["own"] < alone
    assert abs(high[300]["own"] - high[299]["own"]) < 0.05 * alone


def test_words_built_alike_are_told_apart(spark):
    """Words whose polynomial hashes modulo 2^64 agree (Thue-Morse) are different words to all operators that compare hashes."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    other = one.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, f"{rest} {one}"), (2, f"x {other} y"), (4, f"x {one} z"), (5, other), (6, one)], "doc_id long, text string")
    words = C.Words(C.Texts(np.array([1]), np.frombuffer(f"{one} {other} {one}".encode(), np.uint8), np.array([0, 3 * 4096 + 2])))
    assert len(set(words.hashes.tolist())) == 2
    assert {r.n_removed for r in substrings.dedup_substrings(docs, window=2).collect()} == {0}
    assert {r.component_id for r in minhash.near_duplicates(docs, k=1, percent=90).collect()} == {1, 2, 4, 5, 6}
    known = {r.id: (r.n_tokens, r.n_known) for r in lm.score(docs, held_out=lambda ids: ids == 5).collect()}
    assert known[5] == (2, 2)
    known = {r.id: r.n_known for r in lm.score(docs.where("doc_id in (1, 4, 5)"), held_out=lambda ids: ids == 5).collect()}
    assert known[5] == 1


def test_quality_on_labels(spark, sf_dir):
    judged = quality.quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    met = judged.join(labels, judged.id == labels.doc_id)
    assert met.where("quality = 0 and kept").isEmpty() and met.where("quality = 1 and not base_failed and not kept").isEmpty()


def test_mixing(edge, edge_rows, none):
    got = mixing.mix_sizes(edge)
    sizes = collections.Counter()
    for r in edge_rows:
        sizes[r[3]] += len(split(r[1]))
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(3 * sizes[s] for s in capped)) / max(1, sum(weights[s] for s in free))
        over = {s for s in free if level * weights[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    want = {s: 3.0 * sizes[s] if s in capped else level * weights[s] for s in names}
    rows = got.collect()
    assert len(rows) == len(edge_rows)
    for s in names:
        mine = [r for r in rows if r.source == s]
        assert all(r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 and 0 <= r.taken <= 3 * r.size for r in mine)
        # Whole documents are taken, so a source can miss its target by half of its largest one.
        assert abs(sum(r.taken for r in mine) - want[s]) <= 1 + max(r.size for r in mine) / 2
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_sizes(edge.repartition(5)).collect()))
    mixed = mixing.mix(edge)
    assert mixed.columns == edge.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix_sizes(none).count() == 0 and mixing.mix(none).count() == 0


def test_mixing_follows_the_odds(spark, sf_dir):
    """Targets are met closely, and documents get in at the rate of their source."""
    rows = mixing.mix_sizes(spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("source", F.expr("if(doc_id % 3 = 0, 'a', 'b')"))).collect()
    for s in "ab":
        mine = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) < 0.01 * mine[0].target
        due = mine[0].target / mine[0].source_size
        assert abs(sum(r.copies for r in mine) / len(mine) - due) < 0.3 and {r.copies for r in mine if r.size} <= {math.floor(due), math.floor(due) + 1}


def test_licenses(edge, none, spark):
    notices = licenses.TEMPLATES
    rows = [(i, f"some words {t} and more\n", name) for i, (name, t) in enumerate(sorted(notices.items()))]
    rows += [(100, "x " + notices["MIT-permission"].replace("free of charge", "at no cost").replace("a copy", "one copy"), "MIT-permission"), (101, "nothing here", None), (102, None, None), (103, "", None)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, want string")).collect()
    for i, text, want in rows:
        mine = [r for r in got if r.id == i]
        assert want in {r.license for r in mine} if want else not mine
        for r in mine:
            span = text[r.start:r.end].lower()
            if r.coverage == 1:
                assert [w.strip('".,()') for w in span.split()] == [w.strip('".,()') for w in notices[r.license].lower().split()]
    assert licenses.scan(edge).count() == 0 and licenses.scan(none).count() == 0
    with pytest.raises(ValueError):
        licenses.Index({"short": "two words"})


def test_licenses_with_edits_and_repeats(spark):
    """A word left out, changed or added anywhere, as long as the coverage stays, and notices right after each other."""
    rows, want = [], []
    for name, text in licenses.TEMPLATES.items():
        words = text.split()
        texts = [words[:i] + new + words[i + old:] for i in range(len(words)) for new, old in (([], 1), (["xyzzy"], 1), (["xyzzy"], 0))]
        for t in texts:
            n = len(words) - (len(t) < len(words) or (len(t) == len(words) and "xyzzy" in t))
            if n >= 0.8 * len(words):
                want.append((len(rows), name, n, 1))
                rows.append((len(rows), "one two " + " ".join(t) + " three four"))
        want += [(len(rows), name, len(words), 2), (len(rows) + 1, name, len(words), 3)]
        rows += [(len(rows), f"{text} {text}"), (len(rows) + 1, f"a {text} b {text} c d {text}")]
    damaged = "Released under MIT License. Released under the MIT License."
    rows.append((len(rows), damaged))
    got = collections.defaultdict(list)
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.id, r.license].append(r)
    for i, name, n, times in want:
        assert [r.n_matched for r in got[i, name]] == [n] * times, (rows[i], name)
    assert [(r.n_matched, damaged[r.start:r.end]) for r in sorted(got[len(rows) - 1, "MIT"], key=lambda r: r.start)] == [
        (4, "Released under MIT License"), (5, "Released under the MIT License")]


def test_alignment_is_a_common_subsequence():
    rnd = random.Random(1)

    def common(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + (a[i] == b[j]))
        return best[-1][-1]

    for _ in range(200):
        a, b = (np.array([rnd.randint(0, 5) for _ in range(rnd.randint(3, 9))]) for _ in range(2))
        matched, first, last = licenses.align(a, b, 0, 20)
        assert matched == common(a, b) == (common(a, b[first:last + 1]) if matched else 0)


def test_contract_columns(spark, sf_dir):
    from changeflow.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op1_suffixes"](spark, sf_dir).where("n_removed = 0").collect():
        assert r.kept_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in QUERIES["op7_bpe"](spark, sf_dir).limit(50).collect():
        ids = library.encode(docs[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
