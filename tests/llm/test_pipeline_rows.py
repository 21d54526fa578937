"""What the stages of the pipeline must not lose: other texts under one id, and the layout of texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from changeflow.llm import minhash, substrings
from tests.llm.conftest import words

SCHEMA = "doc_id long, text string, source string"


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    rnd = random.Random(3)
    one, two, three, four = (words(rnd, 80) for _ in range(4))
    rows = [(1, one, "a"), (1, two, "b"), (1, two, "b"), (2, two + " end", "c"), (3, three, "d"), (3, three, "e"), (4, None, "f"), (4, "", "g"),
            (4, four, "h"), (5, four + " end", "i"), (None, four, "j"), (None, four, "k")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(str, minhash.drop_near_duplicates(docs).collect()))
    texts = [r.text for r in minhash.drop_near_duplicates(docs).collect()]
    group = lambda base: [t for t in texts if t and t.startswith(base)]
    # Of each group of near copies one stays, whatever their ids; nothing goes that is a copy of nothing.
    assert group(one) == [one] and len(group(two)) == 1 and group(three) == [three] and len(group(four)) == 3
    assert len(texts) == 7 and sum(not t for t in texts) == 1
    assert sorted(map(str, minhash.drop_near_duplicates(docs.repartition(5)).collect())) == got


@pytest.mark.parametrize("block_bytes", [1 << 21, 300])
def test_layout_stays(spark, edge, edge_rows, block_bytes):
    rnd = random.Random(4)
    passage = words(rnd, 12)
    clean = "def f(x):\n\n    return  x\t# one\r\n  "
    texts = [clean, f"  start\n{passage}\n\tend\n", f"{passage} tail\n", f"head {passage}\n", "", None, " \n ", passage]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in substrings.dedup_substrings(docs, window=12, layout=True, block_bytes=block_bytes).collect()}
    assert got == {0: clean, 1: "  start\nend\n", 2: "tail\n", 3: "head \n", 4: "", 5: None, 6: " \n ", 7: ""}
    # The same words go as without the layout.
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    plain, laid = (sorted((str(r.doc_id), r.n_words, r.n_removed, split(r.text)) for r in substrings.dedup_substrings(
        edge, window=10, layout=how, block_bytes=block_bytes).collect()) for how in (False, True))
    assert plain == laid and any(r[2] for r in plain)
    same = {(str(r.doc_id), r.text) for r in substrings.dedup_substrings(edge, window=10, layout=True).where("n_removed = 0").collect()}
    assert same <= {(str(r[0]), r[1]) for r in edge_rows}


def test_pipeline_keeps_line_breaks(spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = pipeline.substring_dedup(spark, docs, sf_dir)
    lost = kept.alias("k").join(docs.alias("d"), "doc_id").where("k.n_chars = d.n_chars and k.text <> d.text")
    assert lost.isEmpty() and kept.where(F.contains("text", F.lit("\n"))).count() > 10
