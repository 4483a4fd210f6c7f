"""Operator 9: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

The features of a text are the n-grams of its characters (code points; NGRAMS lengths, A-Z in lower case, everything
in ASCII that is no letter or digit as a space) that occur in it, hashed to BUCKETS. From at most MAX_TRAIN labelled rows (in the
order of hashed ids, never held-out ones) come each feature's log-count ratio and whether the classes differ in
it by Z standard errors; only such features carry weight, so a long text's many neutral n-grams add nothing. A
logistic regression is fitted to the ratios of the features present, with a penalty on its weights, on the
driver: MAX_TRAIN rows of few features each. Every text is scored whole, without a shuffle.

Nulls: a null text scores as an empty one; unlabelled rows and null labels are not learnt from; several labels
of one doc_id count as toxic if one is. Without labels of both classes every score is the smoothed share of
toxic rows (0.5 without any). A null doc_id counts as held out. Repeated rows are scored as often as they
occur. Only doc_id and text are read; labels, lang and source never enter a score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.llm._common import table, utf8

NGRAMS = (4, 5)
BITS = 20
BUCKETS = 1 << BITS
#: The most labelled rows that a classifier is fitted on.
MAX_TRAIN = 20_000
Z = 4.0
MIN_TEXTS = 4
PENALTY = 0.1
#: ASCII characters in lower case, all but letters and digits as spaces.
_PLAIN = np.array([ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(128)], np.uint32)
_MUL = np.uint64(0x9E3779B97F4A7C15)


def features(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, hashed n-gram of characters) of every place; texts keep a space at either end."""
    texts = [f" {b.decode('utf-8', 'replace')} " for b in bodies]
    lens = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    plain = flat < 128
    x = np.where(plain, _PLAIN[np.where(plain, flat, 0)], flat).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lens)
    left = np.repeat(np.cumsum(lens), lens) - np.arange(len(owner))
    gram, whose, hashes = np.zeros(len(x), np.uint64), [], []
    for n in range(1, max(NGRAMS) + 1):
        gram = gram[: len(x) - n + 1] * _MUL + x[n - 1 :]
        if n in NGRAMS:
            ok = left[: len(gram)] >= n
            whose.append(owner[: len(gram)][ok])
            hashes.append((((gram[ok] ^ np.uint64(n)) * _MUL) >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(whose), np.concatenate(hashes)


def distinct(texts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(texts.astype(np.int64) << BITS | hashes)
    return (both >> BITS).astype(np.int32), (both & (BUCKETS - 1)).astype(np.int32)


class Model:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias  # one weight a bucket, 0 for most

    def score(self, bodies: list[bytes]) -> np.ndarray:
        out = np.full(len(bodies), self.bias, np.float64)
        for lo in range(0, len(bodies), 128):
            texts, hashes = features(bodies[lo : lo + 128])
            hit = self.weights[hashes] != 0
            texts, hashes = distinct(texts[hit], hashes[hit])
            out[lo : lo + 128] += np.bincount(texts, self.weights[hashes], minlength=len(bodies[lo : lo + 128]))
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


class Sums:
    """Sums of entries by key (0 to n - 1), for entries in the order of keys."""

    def __init__(self, keys: np.ndarray, n: int):
        self.n, self.head = n, np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.keys = keys[self.head]

    def of(self, entries: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        out[self.keys] = np.add.reduceat(entries, self.head)
        return out


def fit_logistic(rows: np.ndarray, cols: np.ndarray, ratio: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 1500, close: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated gradient descent from the classes' log odds.

    The matrix has ratio[col] where a text (row) has the feature (col); rows are in order. It ends after `steps`, or where
    the gradient is `close` times what it was at first.
    """
    n, k = len(y), len(ratio)
    by_col = np.argsort(cols, kind="stable")
    in_rows, in_cols, other = Sums(rows, n), Sums(cols[by_col], k), rows[by_col]
    ahead = lambda v: in_rows.of((ratio * v)[cols])
    back = lambda e: ratio * in_cols.of(e[other])
    w, b = np.zeros(k), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    # the step follows from the largest eigenvalue of X'X / n, by power iteration; the loss curves by a quarter of it
    v, top = np.ones(k), 1.0
    for _ in range(30):
        v = back(ahead(v)) / n
        top = float(np.sqrt((v * v).sum()))
        v /= max(top, 1e-12)
    rate = 4.0 / (1.1 * top + 1)
    vw, vb, pw, pb, first, t = w.copy(), b, w.copy(), b, None, 0
    for _ in range(steps):
        err = (1 / (1 + np.exp(-np.clip(ahead(vw) + vb, -50, 50))) - y) / n
        gw, gb = back(err) + penalty * vw / max(1, n) * 10, err.sum()
        size = float(np.sqrt((gw * gw).sum() + gb * gb))
        first = first or size
        w, b = vw - rate * gw, vb - rate * gb
        if size <= close * first:
            break
        # momentum starts anew where it carries uphill
        t = 0 if (gw * (w - pw)).sum() + gb * (b - pb) > 0 else t + 1
        m = max(0, t - 1) / (t + 2)
        vw, vb = w + m * (w - pw), b + m * (b - pb)
        pw, pb = w, b
    return w, b


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic, without the held-out ones."""
    spark = docs.sparkSession
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    # at most max_train rows of two numbers
    rows = docs.select("doc_id", utf8(F.col("text")).alias("body")).join(F.broadcast(chosen), "doc_id").select("y", "body")

    def count(batches):
        import pyarrow as pa

        seen, texts = np.zeros((2, BUCKETS), np.int64), [0, 0]
        for batch in batches:
            y = np.array(batch.column(0).to_pylist(), np.int64)
            for lo in range(0, len(y), 128):
                part = y[lo : lo + 128]
                t, h = distinct(*features(batch.column(1).slice(lo, 128).to_pylist()))
                for c in (0, 1):
                    seen[c] += np.bincount(h[part[t] == c], minlength=BUCKETS)
                    texts[c] += int((part == c).sum())
        at = np.flatnonzero(seen.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [BUCKETS]).astype(np.int32)), *(pa.array(np.append(seen[c][at], [texts[c]])) for c in (0, 1))], names=["h", "n0", "n1"])

    counted = rows.mapInArrow(count, "h int, n0 long, n1 long").groupBy("h").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    got = counted.filter((F.col("n0") + F.col("n1") >= MIN_TEXTS) | (F.col("h") == BUCKETS)).toPandas().sort_values("h")  # at most BUCKETS + 1 rows
    h, n0, n1 = (got[c].to_numpy(np.int64) for c in ("h", "n0", "n1"))
    total = h == BUCKETS
    t0, t1 = (int(n[total].sum()) for n in (n0, n1))
    prior = float(np.log((t1 + 1) / (t0 + 1)))
    weights = np.zeros(BUCKETS, np.float32)
    if not (t0 and t1):
        return Model(weights, prior)
    h, n0, n1 = h[~total], n0[~total], n1[~total]
    share = (n0 + n1 + 1) / (t0 + t1 + 2)
    z = np.abs(n1 / t1 - n0 / t0) / np.sqrt(share * (1 - share) * (1 / t0 + 1 / t1))
    keep = z >= Z
    h, n0, n1 = h[keep], n0[keep], n1[keep]
    if not len(h):
        return Model(weights, prior)
    ratio = np.log(((n1 + 1) / (t1 + 2)) / ((n0 + 1) / (t0 + 2)))
    place = np.full(BUCKETS, -1, np.int32)
    place[h] = np.arange(len(h))
    sent = spark.sparkContext.broadcast(place)

    def entries(batches):
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                t, g = features(part.column(1).to_pylist())
                hit = sent.value[g] >= 0
                t, g = distinct(t[hit], g[hit])
                cols = np.split(sent.value[g].astype("<i4"), np.searchsorted(t, np.arange(1, part.num_rows)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([c.tobytes() for c in cols], pa.binary())], names=["y", "cols"])

    sample = rows.mapInArrow(entries, "y int, cols binary").collect()  # at most max_train documents
    y = np.array([r["y"] for r in sample], np.float64)
    cols = [np.frombuffer(r["cols"], "<i4") for r in sample]
    row = np.repeat(np.arange(len(y)), [len(c) for c in cols])
    flat = np.concatenate(cols)
    if not len(flat):
        return Model(weights, prior)
    w, bias = fit_logistic(row, flat, ratio, y)
    weights[h] = w * ratio
    return Model(weights, bias)


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """keep and score (double) of every row."""
    from pyspark.sql import types as T

    sent = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.select(utf8(F.col("text")).alias("body"), *keep)
    schema = T.StructType([*base.schema.fields[1:], T.StructField("score", T.DoubleType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sent.value.score(batch.column(0).to_pylist()))], names=schema.names)

    return base.mapInArrow(run, schema)


def op9_nb_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0
    model = train(docs, labels.filter(~held))
    scored = score(docs, model, ["doc_id"])
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
