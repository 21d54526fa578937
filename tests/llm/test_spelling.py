"""Spelling variants against brute force."""

import itertools
import random
from collections import Counter

import pytest

from changeflow.llm import spelling


def near(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def vocabulary(rnd, letters, least, n=60):
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randint(least, 11))) for _ in range(n)}
    for w in sorted(words):
        i = rnd.randrange(len(w))
        v = rnd.choice([w[:i] + w[i + 1:], w[:i] + rnd.choice(letters) + w[i:], w[:i] + rnd.choice(letters) + w[i + 1:]])
        words |= {v} if len(v) >= least else set()
    return sorted(words)


def brute(counts, least, min_count, ratio):
    words = {w: n for w, n in counts.items() if n >= min_count and len(w) >= least}
    close = {w: [v for v in words if near(w, v)] for w in words}
    form = {w: min((-words[v], v) for v in close[w])[1] if close[w] and max(words[v] for v in close[w]) >= ratio * words[w] else None for w in words}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return [(w, form[w], root(w), n, len(close[w]), words.get(form[w])) for w, n in words.items()]


def test_near_words_share_a_key():
    """Every pair one edit apart meets, pivots of the one with the prefix of the other, whatever the counts."""
    rnd = random.Random(1)
    for _ in range(60):
        letters = "abcdefghijklmnopqrstuvwxyzé🙂"[:rnd.choice([1, 2, 3, 5, 28])]
        words = vocabulary(rnd, letters, rnd.choice([4, 6]))
        counts = Counter(spelling.gram_class(w[i:i + 2]) for w in words for i in range(len(w) - 1))
        pivots, prefixes = {}, {}
        for w in words:
            prefix, pair = spelling.prefix_and_pivots(w, counts)
            cost = lambda i: counts[spelling.gram_class(w[i:i + 2])]
            assert set(pair) <= set(prefix) and pair[1] - pair[0] >= 2
            assert cost(pair[0]) + cost(pair[1]) == min(cost(i) + cost(j) for i in prefix for j in prefix if j - i >= 2)
            pivots[w] = {k for i in pair for k in spelling.gram_keys(w, i, True)}
            prefixes[w] = {k for i in prefix for k in spelling.gram_keys(w, i, False)}
        for a, b in itertools.combinations(words, 2):
            assert not near(a, b) or pivots[a] & prefixes[b] or pivots[b] & prefixes[a]


@pytest.mark.parametrize("least, min_count, ratio", [(6, 5, 5), (4, 1, 2)])
def test_spelling_variants(spark, least, min_count, ratio):
    rnd = random.Random(7)
    words = vocabulary(rnd, "abc", 3, 150) + vocabulary(rnd, "abcdefghijklmé", 4, 100)
    counts = {w: rnd.choice([1, 4, 5, 6, 25, 30, 130, 700]) for w in words}
    rows = [(w, 1) for w, n in counts.items() for _ in range(n)] + [(None, 1), ("", 1), ("ab", 1)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "word string, n int")
    got = spelling.spelling_variants(df, min_count=min_count, min_letters=least, ratio=ratio)
    want = brute(counts, least, min_count, ratio)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert any(r[1] != r[2] and r[1] for r in want)


def test_words_without_neighbours(spark):
    df = spark.createDataFrame([("alphabet",), ("notebook",), ("alphabet",)], "`Word` string")
    got = spelling.spelling_variants(df, "Word", min_count=1).collect()
    assert sorted(map(tuple, got)) == [("alphabet", None, "alphabet", 2, 0, None), ("notebook", None, "notebook", 1, 0, None)]
    assert spelling.spelling_variants(df.where("false"), "Word").count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(df, "Word", min_letters=3)


def test_letter_runs(edge, none, spark):
    docs = spark.createDataFrame([(1, "Straße-ÄRGER, naïve2x ABCDEFÀ x"), (None, "letters"), (2, None), (3, "")], "doc_id long, text string")
    assert sorted((r.id or 0, r.word) for r in spelling.letter_runs(docs).collect()) == [(0, "letters"), (1, "abcdefÀ"), (1, "straße")]
    assert sorted(r.word for r in spelling.letter_runs(docs, min_letters=5).where("id = 1").collect()) == ["abcdefÀ", "naïve", "straße", "Ärger"]
    assert spelling.letter_runs(none).count() == 0
    assert spelling.spelling_variants(spelling.letter_runs(edge)).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_no_join_is_broadcast(spark, monkeypatch):
    """Spark would take some words in a small file, whose keys are a hundred times as large, for a small table."""
    plans, saved = [], spelling.C.saved
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(spelling.C, "saved", lambda df, *at: plans.append(plan(df)) or saved(df, *at))
    counts = {"letters": 500, "lettres": 90, "lettters": 9, "letter": 7, "unrelated": 5}
    words = spark.createDataFrame([(w,) for w, n in counts.items() for _ in range(n)], "word string")
    done = spelling.spelling_variants(words)
    assert sorted(map(tuple, done.collect())) == sorted(brute(counts, 6, 5, 5))
    plans.append(plan(done))
    assert sum("SortMergeJoin" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)
