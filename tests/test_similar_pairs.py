"""Pairs of similar texts against all pairs, and candidates that don't grow with what texts have in common."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from curlew.functions.shingles import signatures
from curlew.operators import dedup


def words(text):
    out, word = [], ""
    for c in text.lower() + " ":
        if c in "abcdefghijklmnopqrstuvwxyz0123456789":
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def shingles(text):
    w = words(text)
    return {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()


def brute(texts, t):
    sets = [(k, shingles(x)) for k, x in enumerate(texts) if x is not None]
    pairs = [(a, b, len(s & u), len(s | u)) for k, (a, s) in enumerate(sets) for b, u in sets[k + 1 :] if s and u]
    return sorted(p for p in pairs if p[2] >= t * p[3] - 1e-12)


def planted():
    rng = np.random.default_rng(5)
    texts = ["", "!?", None, "a b", "a b c", "one", "one two", "One, two!", "one two three", "averylongwordofmanyletters x y", "averylongwordofmanyletterz x y", "İi ß", "é1é2"]
    for size in (4, 5, 6, 7, 8, 9, 12, 20, 40, 90, 200, 600):
        base = [f"w{k}" for k in rng.integers(0, 5000, size)]
        for _ in range(12):
            w = list(base)
            for _ in range(rng.integers(0, max(2, size // 25 + 1))):
                w[rng.integers(0, len(w))] = f"n{rng.integers(0, 9)}"
            texts.append(" ".join(w[: len(w) - rng.integers(0, max(1, size // 12 + 1))]))
    return list(dict.fromkeys(texts))


@pytest.mark.parametrize("t", [0.55, 0.7, 0.85, 0.97, 1.0])
def test_equals_all_pairs(spark, t):
    texts = planted()
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, text string").repartition(3)
    got = sorted(tuple(r) for r in dedup.similar_pairs(df, t).collect())
    assert got == brute(texts, t) and got
    after = len(texts) // 2
    assert sorted(tuple(r) for r in dedup.similar_pairs(df, t, after=after).collect()) == [p for p in got if p[1] > after]


def test_common_shingles_make_no_candidates(spark):
    """Texts that share a third of their shingles with all others: the rarest-first prefix is what kept them apart before."""
    rng = np.random.default_rng(6)
    common = " ".join(f"c{k}" for k in range(40))
    texts = [common + " " + " ".join(f"w{k}" for k in rng.integers(0, 10**6, 80)) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, text string")
    assert dedup._meeting(signatures(df, F.col("text"), 0.85), 0.85).count() <= 20
