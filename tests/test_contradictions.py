"""Q23 against all pairs within a topic."""

import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from curlew.operators import audit
from curlew.queries.core import QUERIES


def brute(rows, low=0.3, high=0.85):
    sets = [(seq, topic, set(re.findall("[a-z0-9]+", (text or "").lower()))) for seq, topic, text in rows]
    sets = sorted(x for x in sets if x[1] is not None and x[2])
    out = set()
    for k, (a, topic, s) in enumerate(sets):
        for b, other, t in sets[k + 1 :]:
            if topic == other and low <= len(s & t) / len(s | t) < high:
                out.add((a, b))
    return out


def planted():
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in rng.integers(0, 3000, 60)]
    texts = [" ".join(base), "other opening " + " ".join(base[10:]), " ".join(base[::-1][:40]), "one", "one two three", None, "!!", " ".join(base)]
    texts += [" ".join([f"x{k}", *base[: int(n)], *(f"y{j}" for j in rng.integers(0, 300, 30))]) for k, n in enumerate(rng.integers(5, 60, 60))]
    return [(k, ("a", "b", None)[int(k % 7 == 1) + int(k % 23 == 22)], t) for k, t in enumerate(texts * 2)]


@pytest.mark.parametrize("words", [1_000_000, 700])
def test_equals_all_pairs(spark, monkeypatch, words):
    monkeypatch.setattr(audit, "BLOCK_WORDS", words)
    rows = planted()
    df = spark.createDataFrame(rows, "seq long, topic string, text string")
    got = [tuple(r) for r in audit.contradiction_candidates(df, F.col("topic"), F.col("text")).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows) and len(got) > 100


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    t = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "source", "text"]).to_pydict()
    got = [tuple(r) for r in QUERIES["Q23_contradictions"](spark, folder).select("a", "b").collect()]
    want = brute(list(zip(t["doc_id"], t["source"], t["text"], strict=True)))
    assert sorted(got) == sorted(want) and want
