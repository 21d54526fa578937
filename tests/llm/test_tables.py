"""Chat formatting, embeddings, the components helper and the pipeline."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import chat, common as C, forest, quality
from changeflow.llm.components import components


def test_chat_round_trip(spark):
    rnd = random.Random(5)
    parts = ["###", " ", "### ", "</turn>", "\\", "\\s", "<", "/turn>", "#", "\n", "a", ":", ": ", "\\c", "<\\s/turn>", "#\\s## ", "é🙂", "</turn>\n"]
    text = lambda: "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 7)))
    rows = [(rnd.randint(0, 100), rnd.randint(0, 3), rnd.choice(["assistant", "user", text()]), text(), "x") for _ in range(1500)]
    rows += [rows[0], (None, None, None, None, None), (None, None, None, None, None), (500, 1, "assistant", "long " * 20000, "x")]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")).collect()
    source = collections.defaultdict(list)
    for conv, turn, role, body, _ in rows:
        source[conv].append(((turn is not None, turn or 0), role or "", body or ""))
    assert len(got) == len(source)
    for r in got:
        turns = sorted(source[r.id])
        assert r.exact and [(t.role, t.text) for t in r.turns] == [t[1:] for t in turns]
        assert [r.formatted[s.start:s.start + s.length] for s in r.spans] == [t.body for t in r.turns if t.role == "assistant"]
        assert not any("</turn>" in t.body or "### " in t.body for t in r.turns)
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chat_query(spark, sf_dir):
    from changeflow.llm.queries import QUERIES

    odd = r"\### Assistant: </turn> ok"
    turns = collections.defaultdict(list, {-7: [(0, "user", odd), (1, "assistant", odd)]})
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.conv_id: r for r in QUERIES["op3_chat"](spark, sf_dir).collect()}
    assert got.keys() == turns.keys()
    for i, rows in turns.items():
        rows.sort()
        learnt = "".join(t for _, role, t in rows if role == "assistant")
        assert tuple(got[i])[1:5] == (len(rows), sha("".join(f"{role}\n{t}\n" for _, role, t in rows)), len(learnt), sha(learnt))


def vectors_of(rnd, n, groups):
    rows = [(i, rnd.standard_normal(32).tolist()) for i in range(n)]
    for size in groups:
        center = rnd.standard_normal(32)
        rows += [(len(rows) + k, (center + 0.15 * rnd.standard_normal(32)).tolist()) for k in range(size)]
    return rows


def test_embeddings(spark):
    rnd = np.random.default_rng(3)
    rows = vectors_of(rnd, 1500, [300, 40, 5, 2])
    rows += [(9000 + k, rows[0][1]) for k in range(20)] + [(9100, [2.0 * x for x in rows[1][1]])]
    odd = [(9200, None), (9201, []), (9202, [0.0] * 32), (9203, [float("nan")] * 32), (9204, [None] * 32), (9205, [float("inf")] + [0.0] * 31),
           (9206, [1.0] * 16), (9207, [1.0] * 16), (None, rows[0][1]), (9000, rows[0][1])]
    got = forest.near_vectors(spark.createDataFrame([(*r, "x") for r in rows + odd], "vec_id long, embedding array<double>, node string"), sample=400, group=300).collect()
    every = [r for r in rows + odd if r[0] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    links = recall = 0
    named = {r[0]: r[0] for r in rows + odd if r[0] is not None}

    def find(x):
        while named[x] != x:
            x = named[x]
        return x

    degree = collections.Counter()
    by_size = collections.defaultdict(list)
    for r in every:
        by_size[len(r[1])].append(r)
    for same in by_size.values():
        m = np.array([r[1] for r in same])
        m /= np.linalg.norm(m, axis=1)[:, None]
        for i, j in zip(*np.nonzero(m @ m.T >= 0.9)):
            if i != j:
                degree[(same[i][0], i, len(same))] += 1
                x, y = find(same[i][0]), find(same[j][0])
                named[max(x, y)] = min(x, y)
    links, recall = sum(degree.values()), sum(r.n_links for r in got)
    assert len(got) == len(rows) + len(odd) and 0.98 * links <= recall <= links
    for r in got:
        assert (r.component_id, r.kept) == ((find(r.id), find(r.id) == r.id) if r.id is not None else (None, True))
    assert forest.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("noise, pack_bytes", [(0.15, 1 << 20), (0.15, 1 << 17), (0.32, 1 << 17)])
def test_links_of_dense_groups(spark, monkeypatch, noise, pack_bytes):
    """All links of near copies are counted, though a leaf holds a few of them; packs are decided by bounds at little noise and compared at more."""
    monkeypatch.setattr(forest, "PACK_BYTES", pack_bytes)
    rnd = np.random.default_rng(9)
    center = rnd.standard_normal(64)
    m = np.concatenate([center + noise * rnd.standard_normal((5000, 64)), rnd.standard_normal((300, 64))])
    rows = [(i, v) for i, v in enumerate(m.tolist())] + [(6000 + i, m[i].tolist()) for i in range(3)]
    m = np.concatenate([m, m[:3]])
    m /= np.linalg.norm(m, axis=1)[:, None]
    want = (m @ m.T >= 0.9).sum(1) - 1
    got = sorted(forest.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), sample=1000, group=2000).collect())
    found = np.array([r.n_links for r in got])
    assert (found <= want).all() and found.sum() >= 0.999 * want.sum() and (noise > 0.15 or (found == want).all())


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 500 + i) for i in range(50)] + [(rnd.randint(1000, 1100), rnd.randint(1000, 1100)) for _ in range(80)] + [(3, 3)]
    named = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while named[x] != x:
            x = named[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            named[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a long, b long"), C.workdir(spark, "test"))
    assert {r.node: r.component for r in got.collect()} == {x: find(x) for x in named}
    assert components(spark.createDataFrame([], "a long, b long"), C.workdir(spark, "test")).count() == 0


def test_components_join_fewer_edges_each_round(spark, tmp_path):
    # A dense group, a long path, and nodes in turn small and large, of which the large ones hook first.
    dense = [(a, b) for a in range(40) for b in range(a + 1, 40)]
    path = [(100 + k, 101 + k) for k in range(60)]
    turns = [(x, y) for k in range(30) for x, y in ((200 + k, 300 + k), (201 + k, 300 + k))]
    edges = dense + path + turns + [(39, 160)]
    folder = f"file://{tmp_path}/parts"
    got = {r.node: r.component for r in components(spark.createDataFrame(edges * 2, "a long, b long"), folder).collect()}
    assert got == {n: 200 if n >= 200 else 0 for e in edges for n in e}
    rounds = len(list((tmp_path / "parts").glob("components-edges-*")))
    counts = [spark.read.parquet(f"{folder}/components-edges-{k}").count() for k in range(rounds)]
    assert counts[0] == len(edges) and counts[-1] == 0 and sum(counts[1:]) < len(edges) / 4


def test_pipeline(spark, sf_dir):
    """Each stage keeps the columns and works on what is left; tokens decode to their texts."""
    pipeline = pytest.importorskip("corpus_pipeline")
    assert [f.__name__ for _, f in pipeline.STAGES] == ["quality_rules", "minhash_dedup", "substring_dedup", "mix_sources", "bpe_tokens"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = {r.id: r.kept for r in quality.quality(docs).collect()}
    before, columns = docs, docs.columns
    folder = C.workdir(spark, "test")
    for k, (name, stage) in enumerate(pipeline.STAGES):
        after = C.saved(stage(spark, before, sf_dir), folder, str(k))
        ids = {r.doc_id for r in after.collect()}
        assert ids and ids <= {r.doc_id for r in before.collect()}, name
        assert after.columns == columns or k == len(pipeline.STAGES) - 1
        if k == 0:
            assert ids == {i for i, kept in judged.items() if kept}
        before = after
    assert before.where("not round_trip").isEmpty()
    same = lambda df: sorted(map(str, df.select("doc_id", "n_tokens", F.md5("text")).collect()))
    assert same(pipeline.run(spark, sf_dir)) == same(before)
    empty = docs.limit(0)
    for _, stage in pipeline.STAGES:
        empty = stage(spark, empty, sf_dir)
        assert empty.count() == 0
