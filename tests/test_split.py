"""E2's test side against choose() over all clusters in one list."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from curlew.operators import split


def clusters(case):
    rng = np.random.default_rng(9)
    if case == "single records":
        return [1] * 3000
    if case == "with large ones":
        return [1] * 1500 + [int(n) for n in rng.integers(2, 900, 12)] + [3] * 200
    return [40] * 5  # every cluster over 1.5 times a small target


@pytest.mark.parametrize(("case", "ratio"), [("single records", 0.2), ("single records", 0.9), ("with large ones", 0.1), ("with large ones", 0.3), ("equal", 0.1), ("equal", 0.3)])
def test_side_of_many_clusters(spark, monkeypatch, case, ratio):
    monkeypatch.setattr(split, "FOLD", 50)
    sizes = {f"k{k}": n for k, n in enumerate(clusters(case))}
    rows = [(f"{key}-{j}", (key,), key) for key, n in sizes.items() for j in range(n)]
    df = spark.createDataFrame(rows, "id string, metadata struct<topic: string>, instruction string")
    train, test = split.split(df, ratio)
    got = Counter(r["instruction"] for r in test.collect())
    order = sorted(sizes, key=lambda key: (hashlib.sha256(f"{key}42".encode()).hexdigest(), key))
    want = split.choose([(key, sizes[key]) for key in order], len(rows), ratio)
    assert got == {key: sizes[key] for key in want}
    assert train.count() == len(rows) - sum(got.values())
