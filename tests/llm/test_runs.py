"""Runs and Lyndon arrays against brute force."""

import functools
import random

import numpy as np
import pytest

from changeflow.llm import common as C, runs

from tests.llm.test_documents import same, split


@functools.cache
def cached_runs(words, least):
    return brute_runs(words, *least)


def brute_runs(words, min_length, min_exponent):
    found = {}
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_length, min_exponent * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def rows(rnd):
    for _ in range(400):
        n, k = rnd.randint(1, 40), rnd.choice([1, 2, 3, 5])
        s = [rnd.randint(1, k) for _ in range(n)]
        if rnd.random() < 0.5:
            a, p = rnd.randrange(n), rnd.randint(1, max(1, n // 3))
            s = [s[i] if i < a else s[min(a + (i - a) % p, n - 1)] for i in range(n)]
        yield s


def test_lyndon_lengths():
    """Up to the next smaller suffix, under both orders, with walls between words."""
    rnd = random.Random(3)
    for s in rows(rnd):
        for t in (s, [max(s) + 1 - x for x in s]):
            want = [next((j for j in range(i + 1, len(t)) if t[j:] < t[i:]), len(t)) - i for i in range(len(t))]
            got = runs.lyndon_lengths(np.array([0, *t, 0, *t]))
            assert got.tolist() == [0, *want, 0, *want]


@pytest.mark.parametrize("least", [(6, 4), (2, 2), (4, 3), (12, 2)])
def test_find_runs(least):
    rnd = random.Random(5)
    for s in rows(rnd):
        assert sorted(map(tuple, runs.find_runs(np.array(s), *least).tolist()), key=lambda r: (r[0], r[2])) == brute_runs(s, *least)


def test_windows_of_runs_repeat():
    """No run is lost by grouping repeated windows only."""
    rnd = random.Random(6)
    for s in rows(rnd):
        for least in [(6, 4), (2, 2), (9, 3), (5, 2)]:
            first, sizes = runs._stretches(np.array(s), np.array([0, len(s)]), runs.repeated_width(*least))
            inside = [range(a, a + n) for a, n in zip(first.tolist(), sizes.tolist())]
            assert all(any(a in x and a + n - 1 in x for x in inside) for a, n, _ in brute_runs(s, *least))


def test_long_repeats():
    """Time stays near linear for one word, a long period, and a Fibonacci word, which has the most runs."""
    a, b = [1], [1, 2]
    while len(b) < 100_000:
        a, b = b, b + a
    assert runs.find_runs(np.ones(100_000, int)).tolist() == [[0, 100_000, 1]]
    assert [0, 100_000, 997] in runs.find_runs(np.arange(100_000) % 997 + 1).tolist()
    assert len(runs.find_runs(np.array(b), 2, 2)) > 0.5 * len(b)


@pytest.mark.parametrize("chunk_bytes", [C.CHUNK_BYTES, 500])
@pytest.mark.parametrize("least", [(6, 4), (2, 2)])
def test_periodic_runs(edge, edge_rows, none, least, chunk_bytes):
    want = []
    for r in edge_rows:
        words = split(r[1])
        found = cached_runs(tuple(words), least)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        want.append((r[0], len(words), found, " ".join(w for i, w in enumerate(words) if i not in gone)))
    got = runs.periodic_runs(edge, min_length=least[0], min_exponent=least[1], chunk_bytes=chunk_bytes).collect()
    same([(r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got], want)
    assert runs.periodic_runs(none).count() == 0


def test_runs_do_not_cross_documents(spark):
    docs = spark.createDataFrame([(i, "a b a b a b") for i in range(4)], "doc_id long, text string").coalesce(1)
    assert {len(r.runs) for r in runs.periodic_runs(docs).collect()} == {0}
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, min_exponent=1)
