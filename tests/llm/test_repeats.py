"""The suffix sort of op5 over many buckets, hot strings, odd texts and long ones, against plain versions."""

import brute
import numpy as np
import pytest

from curlew.llm import repeats


def same(spark, made, parts=7, **sizes):
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(parts)
    want = brute.removed_spans([(repeats.LAST if d is None else d, t) for d, t in made])
    got = repeats.find_repeats(docs, **sizes).collect()
    assert len(got) == len(made)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[repeats.LAST if r.doc_id is None else r.doc_id], r.doc_id


def test_many_buckets_and_hot_strings(spark):
    """A passage and a common run of words span several buckets; what precedes them differs in each document."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(300)]
    passage = " ".join(rng.choice(words, 25))
    made = []
    for k in range(150):
        own = [" ".join(rng.choice(words, 30)) for _ in range(2)]
        made.append((int(k * 7 % 151), f"{own[0]}{'xyz'[k % 3]}{passage if k % 2 else passage[:45]} {own[1]}"))
    blocks = repeats.store(repeats.blocks(spark.createDataFrame(made, "doc_id long, text string").repartition(7)), "blocks").df
    n = blocks.agg({"suffixes": "sum"}).first()[0]
    assert repeats.sampled(blocks, n, 400).hot
    same(spark, made, bucket_bytes=n * repeats.RECORD // 400, passes=3)


def test_copies_of_one_text(spark):
    """Nearly all suffixes are settled where they are read: the few that are left still go to several buckets."""
    rng = np.random.default_rng(7)
    text = " ".join(f"w{k}" for k in rng.integers(0, 500, 80))
    made = [(int(k), text + (f" own {k}" if k % 40 == 0 else "")) for k in rng.permutation(160)]
    same(spark, made, parts=2, bucket_bytes=repeats.RECORD * 40, passes=4)


def test_texts_without_words(spark):
    rng = np.random.default_rng(4)
    dense = "".join(rng.choice(list("日本語のé"), 400))
    same(spark, [(1, "a" * 200), (2, "b" + "a" * 120), (3, dense), (4, dense[30:200] + "終" + dense[200:]), (5, " " * 90), (6, " " * 70 + "x"), (None, dense), (8, None), (9, "ab" * 60), (10, "\n\t" * 60)])


def test_longer_than_a_segment(spark):
    rng = np.random.default_rng(5)
    words = np.array([f"w{k}" for k in range(5000)])
    long = " ".join(rng.choice(words, 260_000))
    assert len(long) > repeats.SEGMENT
    cut = long[repeats.SEGMENT - 200 : repeats.SEGMENT + 300]
    same(spark, [(2, long), (1, cut), (3, long[-400:] + " end"), (4, "x" * 30 + long[5000:5100])], parts=2, bucket_bytes=1 << 20)


def test_order_of_a_multikey_sort():
    rng = np.random.default_rng(6)
    data = rng.integers(0, 3, (500, 11)).astype(np.uint8)
    data[:, :8] = 1
    owner = rng.integers(0, 4, 500)
    rows, group = repeats.tied(repeats.characters(data), owner, np.arange(500), np.zeros(500, np.int64))
    keys = [data[r].tobytes() for r in rows]
    assert keys == sorted(keys)
    by = {}
    for k in range(500):
        by.setdefault(data[k].tobytes(), set()).add(int(owner[k]))
    assert set(rows.tolist()) == {k for k in range(500) if len(by[data[k].tobytes()]) > 1}
    assert [a == b for a, b in zip(keys, keys[1:])] == [bool(a == b) for a, b in zip(group, group[1:])]


@pytest.mark.parametrize("name", ["docs", "block", "spans"])
def test_columns_of_any_name(spark, name):
    docs = spark.createDataFrame([(1, "a word " * 20, 1.5), (2, "a word " * 20, None), (None, None, 2.0)], f"doc_id long, text string, {name} double")
    got = {r.doc_id: r for r in repeats.drop_repeats(docs).collect()}
    assert got[1].text == "a word " * 20 and got[2].text == "" and got[1][name] == 1.5 and got[None].text is None and got[None][name] == 2.0
