"""op4: vocabulary that grows with the corpus, scores against a plain forward pass, gradients against differences."""

import math
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import write
from pyspark.sql import functions as F

from curlew.llm import lm
from curlew.llm.queries import QUERIES


def figures(spark, made, parts=4, buckets=None):
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(parts)
    blocks = lm.store(lm.tokenised(docs, F.lit(False)), "blocks").df
    totals = lm.store(lm.counted(blocks, buckets or lm.bucket_count(blocks)), "counts").df
    return blocks, totals


@pytest.mark.parametrize("buckets", [1, 37])
def test_vocabulary_is_the_commonest_words(spark, buckets):
    """The same words whatever the buckets: as many as the root of the tokens allows, ties left out together."""
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(400) for _ in range(5 + 2000 // (k + 3))] + [f"rare{k}" for k in range(500)]
    rng.shuffle(words)
    made = [(k, " ".join(words[k::50])) for k in range(50)]
    vocab = lm.Vocabulary(figures(spark, made, buckets=buckets)[1])
    counts = Counter(w for _, t in made for w in [*t.split(), lm.END.decode()])
    assert vocab.tokens == sum(counts.values()) and vocab.distinct == len(counts)
    room = math.isqrt(vocab.tokens)
    steps = Counter(int(lm.rounded(np.array([n]))[0]) for n in counts.values() if n >= lm.LEAST)
    least = min(s for s in steps if sum(n for c, n in steps.items() if c >= s) <= room)
    want = {lm.word_key(w.encode()): n for w, n in counts.items() if n >= least} | {lm.word_key(lm.END): counts[lm.END.decode()]}
    assert dict(zip(vocab.keys.tolist(), vocab.counts.tolist())) == want and len(want) > room // 2


def plain(model, doc):
    """log10 probability of a document's model ids, one step after another in double precision."""
    p = {k: v.astype(np.float64) for k, v in model.p.items()}
    d, h, x, total = lm.HIDDEN, np.zeros(lm.HIDDEN), 0, 0.0
    sigma = lambda a: 1 / (1 + np.exp(-a))
    for y in doc.tolist():
        if x == 0:
            h = np.zeros(d)
        g, a = p["u"][x], h @ p["w"]
        z, r = sigma(g[:d] + a[:d]), sigma(g[d : 2 * d] + a[d : 2 * d])
        n = np.tanh(g[2 * d :] + r * a[2 * d :])
        h = (1 - z) * n + z * h
        top = h @ p["wc"] + p["bc"]
        c = int(np.searchsorted(model.edges, y, "right") - 1) if y < model.words else y - model.words + model.classes
        total += top[c] - np.log(np.exp(top).sum())
        if y < model.words:
            own = slice(model.edges[c], model.edges[c + 1])
            inner = p["wo"][own] @ h + p["bo"][own]
            total += inner[y - own.start] - np.log(np.exp(inner).sum())
        x = y
    return total / math.log(10)


def small_model(rng, words=60):
    class V:
        counts, rare_mass = np.sort(rng.integers(5, 500, words))[::-1].astype(np.int64), np.full(lm.RARE, 3.0)

    model = lm.Gru.start(V)
    for k, x in model.p.items():
        model.p[k] = (x + rng.normal(0, 0.3, x.shape)).astype(np.float32)
    return model


def test_scores_equal_a_plain_forward_pass():
    rng = np.random.default_rng(7)
    model = small_model(rng)
    docs = [np.append(rng.integers(1, model.words + lm.RARE, n), 0).astype(np.int32) for n in (0, 1, 5, 300, 17, 90)]
    got = lm.score(model, docs)
    assert np.allclose(got, [plain(model, d) for d in docs], rtol=2e-5, atol=1e-4)
    y = np.arange(model.words + lm.RARE)
    h = np.repeat(rng.normal(0, 1, (1, lm.HIDDEN)).astype(np.float32), len(y), axis=0)
    assert math.isclose(np.exp(model.output(h, y)).sum(), 1, abs_tol=1e-4)
    back = lm.Gru.frombytes(model.tobytes(), model.words)
    assert all((back.p[k] == model.p[k]).all() for k in model.NAMES)


def test_gradients_equal_differences():
    rng = np.random.default_rng(8)
    model = small_model(rng, 30)
    docs = [np.append(rng.integers(1, model.words + lm.RARE, n), 0).astype(np.int32) for n in (6, 9, 12)]
    x, y, _, ends = lm.side_by_side(docs, 2)

    def loss():
        states, _ = model.forward(x, np.zeros((len(ends), lm.HIDDEN), np.float32))
        ok = y.ravel() >= 0
        return -model.output(states.reshape(-1, lm.HIDDEN)[ok], y.ravel()[ok]).sum()

    kept, grads = {}, {}
    states, _ = model.forward(x, np.zeros((len(ends), lm.HIDDEN), np.float32), kept)
    ok = np.flatnonzero(y.ravel() >= 0)
    model.output(states.reshape(-1, lm.HIDDEN)[ok], y.ravel()[ok], grads)
    dh = np.zeros((y.size, lm.HIDDEN), np.float32)
    dh[ok] = grads.pop("h")
    model.backward(x, kept, dh.reshape(*x.shape, lm.HIDDEN), grads)
    full = {k: np.zeros_like(v) for k, v in model.p.items()}
    full["u"][grads["u_rows"]] = grads["u"]
    full |= {k: grads[k] for k in ("w", "wc", "bc", "wo", "bo")}
    for name, g in full.items():
        for at in [np.unravel_index(k, g.shape) for k in rng.choice(g.size, min(12, g.size), replace=False)]:
            was, step = model.p[name][at], np.float32(1e-2)
            model.p[name][at] = was + step
            up = loss()
            model.p[name][at] = was - step
            down = loss()
            model.p[name][at] = was
            assert math.isclose((up - down) / (2 * step), g[at], rel_tol=0.03, abs_tol=0.02), (name, at)


def test_whole_scores_equal_plain_ones(spark):
    """The operator's scores, over several blocks of which one document fills more than one, are the plain pass's."""
    rng = np.random.default_rng(9)
    made = [(k, " ".join(f"w{j}" for j in rng.zipf(1.4, 200) % 3000)) for k in range(40)] + [(40, None), (41, "never seen"), (42, "W1 w2 " * 3000)]
    blocks, totals = figures(spark, made)
    vocab = lm.Vocabulary(totals)
    model = lm.trained(blocks, vocab)
    got = {r.doc_id: r for r in lm.scored(blocks, totals, vocab, model, lm.bucket_count(blocks)).collect()}
    counts = Counter(w for _, t in made for w in [*(t or "").encode().lower().split(), lm.END])
    for k, t in made:
        words = [*(t or "").encode().lower().split(), lm.END]
        ids = vocab.ids(np.array([lm.word_key(w) for w in words], np.uint64))
        want = plain(model, ids) + vocab.rest(ids, np.array([counts[w] for w in words])).sum()
        assert math.isclose(got[k].score, want, rel_tol=1e-4, abs_tol=1e-3), k


def test_average_over_many_tasks(spark):
    """Copies are averaged by their tokens, however many steps of FAN that takes."""
    rng = np.random.default_rng(10)
    made = [(k, " ".join(f"w{j}" for j in rng.integers(0, 30, 20))) for k in range(120)]
    blocks, totals = figures(spark, made, parts=40)
    vocab = lm.Vocabulary(totals)
    vocab.tokens = 1 << 40  # as many tasks as there are cores
    model = lm.trained(blocks, vocab, rounds=1)
    assert np.isfinite(np.frombuffer(model.tobytes(), "<f4")).all() and any((model.p[k] != lm.Gru.start(vocab).p[k]).any() for k in ("w", "wc"))


def test_text_longer_than_a_block(spark, tmp_path):
    long = "some words of a text " * (lm.BLOCK // 20)
    folder = write(tmp_path / "t", [(1, long, "s"), (2, "some words", "s"), (3, None, "s"), (4, "other words " * 50, "s")])
    want = brute.base_scores([(1, long), (2, "some words"), (3, None), (4, "other words " * 50)])
    for r in QUERIES["op4_gru_lm"](spark, folder).collect():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4] and math.isclose(r.base_score, want[r.doc_id][4], rel_tol=1e-9) and np.isfinite(r.score)


def test_no_training_documents(spark, tmp_path):
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1)
    folder = write(tmp_path / "t", [(held, "a b", "s"), (held, None, "s")])
    got = sorted(QUERIES["op4_gru_lm"](spark, folder).collect(), key=lambda r: r.n_tokens)
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(1, 0, 0), (3, 0, 0)]
    assert all(math.isclose(r.base_score, 0, abs_tol=1e-9) and np.isfinite(r.score) for r in got)


def test_beats_the_base_on_held_out_text(spark):
    got = QUERIES["op4_gru_lm"](spark, "/root/testdata/sf0.01").filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).collect()[0]
    assert got.s > got.b
