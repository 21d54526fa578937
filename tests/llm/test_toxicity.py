"""Toxicity: bags and scores against plain Python, held-out accuracy, unseen misspellings, and awkward tables."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changeflow.llm import common as C, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MEAN = ["gornak", "blistrup", "vexlime", "dromfast", "quilbane"]


def prose(rnd, n, mean=0.0):
    return " ".join(rnd.choice(MEAN) + rnd.choice(["", "s", "ing"]) if rnd.random() < mean else
                    "".join(rnd.choice("aeioustrnlmp") for _ in range(rnd.randint(2, 7))) for _ in range(n))


def texts_of(texts):
    batch = pa.record_batch({"id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.large_string())})
    return next(C.texts_of(iter([batch]), 1 << 30))


def grams(word):
    marked = f"<{word.lower()}>"
    return [marked[i:i + n] for n in toxicity.SIZES for i in range(len(marked) - n + 1)] + [marked]


def test_bags_hold_the_grams_of_each_word():
    """Equal grams have equal rows, wherever they stand, and rows count as often as their grams."""
    texts = ["Ünïcödé 🙂 the The  the", "", "a", "thé\nabcdef abcdef x", " "]
    found = toxicity.subwords(texts_of(texts))
    row_of = {}
    for t, text in enumerate(texts):
        mine = found.text == t
        words = WORD.findall(text)
        assert found.times[mine].sum() == pytest.approx(sum(1 + np.log(words.count(w)) for w in set(words)))
        told = sorted(zip(found.rows[found.first[w]:found.first[w] + found.counts[w]].tolist() for w in found.word[mine]), key=str)
        assert sorted(len(r[0]) for r in told) == sorted(len(grams(w)) for w in set(words))
    words = ["abcdef", "abcxef", "bcdef"]
    one = [toxicity.subwords(texts_of([w])) for w in words]
    for w, s in zip(words, one):
        for gram, row in zip(grams(w), s.rows.tolist()):
            assert row_of.setdefault(gram, row) == row
    assert len(set(row_of.values())) > 0.95 * len(row_of)


def test_log_odds_are_of_the_average():
    rnd = np.random.default_rng(3)
    model = toxicity.Model(rnd.random(toxicity.ROWS).astype(np.float32), rnd.normal(0, 1, toxicity.ROWS).astype(np.float32), 0.25)
    texts = ["one two two three", "", "x " * 50, "Ünïcödé"]
    for text, got in zip(texts, model.log_odds(texts_of(texts))):
        weight = gain = 0.0
        words = WORD.findall(text)
        for w in set(words):
            for r in toxicity.subwords(texts_of([w])).rows.tolist():
                share = float(model.weight[r]) * (1 + np.log(words.count(w)))
                weight, gain = weight + share, gain + share * float(model.gain[r])
        assert got == pytest.approx(0.25 + gain / weight * np.sqrt(weight) if weight else 0.25, rel=1e-6)


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(9)
    rows = [(i, prose(rnd, rnd.choice([5, 30, 200, 1500]), 0.04 if i % 6 == 0 else 0.0)) for i in range(900)]
    rows = [(i, t + " " + rnd.choice(MEAN) if i % 6 == 0 else t) for i, t in rows]
    labels = [(i, int(i % 6 == 0)) for i, _ in rows if i % 10] + [(None, 1), (5_000, 1), (7, None), (11, 3)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), {i: int(i % 6 == 0) for i, _ in rows}


def test_held_out_accuracy_and_misspellings(spark, tables):
    docs, labels, truth = tables
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).withColumn("held_out", toxicity.held_out_by_crc(F.col("id"))).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 100 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert np.mean([r.predicted == truth[r.id] for r in held]) > 0.95
    odd = spark.createDataFrame([(1, "soro gornac tine"), (2, "blisstrup pola"), (3, "so rolatine pola mena"), (4, "VEXLIMEE")], "doc_id long, text string")
    assert {r.id: r.predicted for r in toxicity.score(odd, model).collect()} == {1: 1, 2: 1, 3: 0, 4: 1}
    again = toxicity.fit(docs.repartition(7), labels.repartition(3))
    assert again.bias == model.bias and (again.gain == model.gain).all()


def test_held_out_rows_teach_nothing(spark, tables):
    docs, labels, _ = tables
    some = dict(held_out=lambda i: i % 3 == 0, max_labelled=120, epochs=1)
    model = toxicity.fit(docs, labels, **some)
    turned = labels.withColumn("toxic", F.when(F.col("doc_id") % 3 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = toxicity.fit(docs, turned, **some)
    assert (model.gain == other.gain).all() and model.bias == other.bias


def test_sample_is_bounded(tables):
    docs, labels, _ = tables
    sample = lambda n, size: toxicity._sample(docs, labels, "doc_id", "text", "doc_id", "toxic", toxicity.held_out_by_crc, n, size).collect()
    assert len(sample(50, 1 << 20)) == 50 - sum(r.label is None for r in sample(50, 1 << 20))
    few = sample(10_000, 50_000)
    assert few and sum(len(r.text.encode()) for r in few) <= 50_000 and len({r["rank"] for r in few}) == len(few)


def test_awkward_tables(spark, edge, edge_rows, none):
    blank = "doc_id long, toxic int, text string"
    nothing = toxicity.fit(edge, spark.createDataFrame([], blank))
    assert {(r.score, r.predicted) for r in toxicity.score(edge, nothing).collect()} == {(1 / (1 + np.exp(700.0)), 0)}
    ones = toxicity.fit(edge, spark.createDataFrame([(i, 1, None) for i in range(20)], blank))
    assert {r.predicted for r in toxicity.score(edge, ones).collect()} == {1}
    both = toxicity.fit(edge, spark.createDataFrame([(i, i % 2, "clash") for i in range(40)] + [(6, 1, None)] * 3, blank), held_out=lambda i: F.lit(False), epochs=2)
    for chunk in (C.CHUNK_BYTES, 300):
        got = toxicity.score(edge, both, chunk_bytes=chunk).collect()
        assert sorted(str(r.id) for r in got) == sorted(str(r[0]) for r in edge_rows)
        assert all(0 <= r.score <= 1 for r in got) and len({r.score for r in got if r.id in (0, 1, 2)}) == 1
    assert toxicity.score(none, both).count() == 0
    assert np.isinf(toxicity.fit(none, spark.createDataFrame([(1, 1, "x")], blank)).bias)
