"""Operator 4: document log-likelihoods of a gated recurrent language model.

Words (bytes between ASCII white space, A-Z in lower case) and an end token are counted over all training
documents, exactly, by hashed word in buckets. The model is a GRU: the commonest words, as many as the square root
of the number of training tokens (as distinct words grow with a text; MOST at most, which bounds memory) that
occur LEAST times or more, and 16 groups of rarer words (by their last letters) have input vectors, and its
output is factored: first the class, then the word in its class; the number of classes and their sizes follow
the vocabulary, small classes for common words. A rare word's probability is its group's, given the state, times
its share of the group's counts; an unknown word takes the half count that the base score gives it too. Output
biases start at the counts' logarithms, so an untrained model is the counts' own.

Training is by truncated backpropagation in numpy over every training document: state is carried from window
to window and reset at each document's start, in training also after each STRETCH tokens of a long one. Each
task trains a copy on its documents, one pass in ROUNDS rounds; after a round the copies are averaged, part by
part of the model, FAN copies at a time. Documents are scored whole, state carried from their start to their
end, in lanes of many documents side by side.

Nulls: a null text is the end token alone; a null doc_id is trained on and not held out. Repeated rows count as
often as they occur. With no training documents all counts are 0 and both scores are those of one unknown
word. An empty table gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.llm._common import store, table, utf8

HIDDEN, RARE = 16, 16
#: Count from which a word may be modelled by itself, and the most such words: about 130 MB a worker with the optimizer.
LEAST, MOST = 5, 1 << 18
WINDOW = 16
LANES, FEWEST = 512, 16
#: Tokens scored in one step: fewer lanes, as where only the longest documents are left, take longer windows.
STEP = 8192
#: Tokens of a document after which training goes on from a fresh state; scoring never does.
STRETCH = 4096
ROUNDS = 3
RATE, START = 0.05, 0.1
#: Bytes of text in a block, tokens trained on or scored side by side, and those that make a training task worth while.
BLOCK = 6 << 20
TOKENS = 4 << 20
TASK = 2 << 20
#: Bytes of words and counts in a bucket, of a part of a model, and copies that are averaged in one step.
BUCKET = 24 << 20
PART = 1 << 20
FAN = 16
END = b" end"  # no word holds a space
_LN10 = math.log(10)


# --- corpus: tokenised blocks, counts ---------------------------------------------------------------------


def word_key(word: bytes) -> int:
    """64-bit hash whose low four bits are the word's group."""
    import xxhash

    return xxhash.xxh3_64_intdigest(word) & ~15 | xxhash.xxh32_intdigest(word[-2:]) & 15


def tokenised(docs: DataFrame, held_out) -> DataFrame:
    """Blocks of documents: local token ids, and key and training count of every local word."""
    base = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held"), utf8(F.col("text")).alias("body"))
    schema = "block long, doc_ids array<long>, lens binary, held binary, tokens binary, keys binary, counts binary"

    def run(batches):
        from collections import defaultdict

        import pyarrow as pa
        from pyspark import TaskContext

        part, seq, size = TaskContext.get().partitionId(), 0, 0
        ids, held, toks = [], [], []
        local = defaultdict()
        local.default_factory = local.__len__

        def close():
            nonlocal seq, size
            lens = np.array([len(t) for t in toks], "<u4")
            flat = np.concatenate(toks)
            out = np.array(held, bool)
            counts = np.bincount(flat[np.repeat(~out, lens)], minlength=len(local)).astype("<u4")
            keys = np.array([word_key(w) for w in local], "<u8")
            row = [[part << 32 | seq], [list(ids)], [lens.tobytes()], [out.astype(np.uint8).tobytes()], [flat.tobytes()], [keys.tobytes()], [counts.tobytes()]]
            kinds = [pa.int64(), pa.list_(pa.int64())] + [pa.binary()] * 5
            seq, size = seq + 1, 0
            for x in (ids, held, toks, local):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=["block", "doc_ids", "lens", "held", "tokens", "keys", "counts"])

        for batch in batches:
            for doc_id, out, body in zip(*batch.columns, strict=True):
                body = body.as_py()
                words = body.lower().split()
                words.append(END)
                ids.append(doc_id.as_py())
                held.append(out.as_py())
                toks.append(np.array(list(map(local.__getitem__, words)), "<u4"))
                size += len(body) + 8
                if size >= BLOCK:
                    yield close()
        if ids:
            yield close()

    return base.mapInArrow(run, schema)


def bucket_count(blocks: DataFrame, size: int = BUCKET) -> int:
    """Buckets of about `size` bytes of words, whatever the number of partitions."""
    sent = blocks.agg(F.coalesce(F.sum(F.octet_length("keys") + F.octet_length("counts")), F.lit(0)).cast("long")).first()[0]
    return max(1, -(-sent // size))


def counted(blocks: DataFrame, buckets: int) -> DataFrame:
    """For each block and bucket the corpus counts of the block's words there, in the block's order.

    A bucket's first row also holds its distinct words and counts by group, how many of its words have each
    (rounded) count, and its words that occur LEAST times. Buckets are by hashed word; a word is sent once a block,
    however common, so rows are no more than the blocks' distinct words.
    """

    def send(batches):
        import pyarrow as pa

        for batch in batches:
            for block, keys, counts in zip(*batch.columns, strict=True):
                key, count = np.frombuffer(keys.as_py(), "<u8"), np.frombuffer(counts.as_py(), "<u4")
                bucket = bucket_of(key, buckets)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                have = np.flatnonzero(np.diff(edges))
                parts = [order[edges[b] : edges[b + 1]] for b in have]
                yield pa.RecordBatch.from_arrays([pa.array(have.astype(np.int32)), pa.array([block.as_py()] * len(have), pa.int64()), pa.array([key[p].tobytes() for p in parts], pa.binary()), pa.array([count[p].tobytes() for p in parts], pa.binary())], names=["bucket", "block", "keys", "counts"])

    def add(group):
        import pyarrow as pa

        keys = [np.frombuffer(x, "<u8") for x in group.column("keys").to_pylist()]
        flat, where = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.frombuffer(b"".join(group.column("counts").to_pylist()), "<u4")
        total = np.bincount(where, counts, minlength=len(flat)).astype("<i8")
        ends = np.cumsum([len(k) for k in keys])[:-1]
        known = total > 0
        shape = (flat & np.uint64(15)).astype(np.int64)
        stats = np.concatenate((np.bincount(shape[known], minlength=RARE), np.bincount(shape, total, minlength=RARE).astype(np.int64))).astype("<i8")
        top = total >= LEAST
        sizes, many = np.unique(rounded(total[top]), return_counts=True)
        n = len(keys)
        first = lambda x: pa.array([x.astype("<i8").tobytes()] + [None] * (n - 1), pa.binary())
        return pa.table({"bucket": group.column("bucket"), "block": group.column("block"), "totals": pa.array([x.tobytes() for x in np.split(total[where], ends)], pa.binary()), "stats": first(stats), "sizes": first(np.concatenate((sizes, many))), "top_keys": first(flat[top].view("<i8")), "top_counts": first(total[top])})

    sent = blocks.select("block", "keys", "counts").mapInArrow(send, "bucket int, block long, keys binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(add, "bucket int, block long, totals binary, stats binary, sizes binary, top_keys binary, top_counts binary")


def rounded(counts: np.ndarray) -> np.ndarray:
    """Counts down to eight significant bits: under 8000 values, whatever the counts."""
    counts = counts.astype(np.int64)
    drop = np.maximum(np.frexp(counts.astype(np.float64))[1] - 8, 0)
    return counts >> drop << drop


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


class Vocabulary:
    """Corpus figures and the frequent words with their counts."""

    def __init__(self, totals: DataFrame, most: int = MOST):
        def pairs(first, second):
            def run(batches):
                import pyarrow as pa

                for batch in batches:
                    for x, y in zip(batch.column(0), batch.column(1), strict=True):
                        x, y = np.frombuffer(x.as_py(), "<i8"), np.frombuffer(y.as_py(), "<i8")
                        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=[first, second])

            return run

        def figures(batches):
            import pyarrow as pa

            for batch in batches:
                for kind, column in enumerate(batch.columns):
                    for x in column:
                        a = np.frombuffer(x.as_py(), "<i8")
                        k = np.arange(len(a)) if kind == 0 else a[: len(a) // 2]
                        yield pa.RecordBatch.from_arrays([pa.array([kind] * len(k), pa.int32()), pa.array(k, pa.int64()), pa.array(a if kind == 0 else a[len(a) // 2 :])], names=["kind", "k", "x"])

        rows = totals.filter("stats IS NOT NULL")
        sums, sizes = np.zeros(2 * RARE, np.int64), {}
        # 32 rows, and one for each rounded count
        for r in rows.select("stats", "sizes").mapInArrow(figures, "kind int, k long, x long").groupBy("kind", "k").agg(F.sum("x").alias("x")).collect():
            if r["kind"] == 0:
                sums[r["k"]] = r["x"]
            else:
                sizes[r["k"]] = r["x"]
        self.distinct, self.tokens = int(sums[:RARE].sum()), int(sums[RARE:].sum())
        room, least = min(most, math.isqrt(self.tokens)), 1 << 62
        for count, words in sorted(sizes.items(), reverse=True):
            room -= words
            if room < 0:
                break
            least = count
        best = rows.select("top_keys", "top_counts").mapInArrow(pairs("key", "n"), "key long, n long").filter(F.col("n") >= least).toArrow()  # `most` rows at most
        best = best.sort_by([("n", "descending"), ("key", "ascending")])
        end = word_key(END)
        keys = best.column("key").to_numpy().astype(np.int64).astype(np.uint64)
        counts = best.column("n").to_numpy().astype(np.int64)
        at_end = int(np.flatnonzero(keys == end)[0]) if (keys == end).any() else -1
        end_count = counts[at_end] if at_end >= 0 else 0
        others = np.arange(len(keys)) != at_end
        self.keys = np.concatenate(([np.uint64(end)], keys[others])).astype(np.uint64)  # the end token is word 0
        self.counts = np.concatenate(([end_count], counts[others])).astype(np.int64)
        self.order = np.argsort(self.keys)
        group = (self.keys & np.uint64(15)).astype(np.int64)
        seen = self.counts > 0
        mass = sums[RARE:] - np.bincount(group, self.counts, minlength=RARE).astype(np.int64) + 0.5 * (sums[:RARE] - np.bincount(group[seen], minlength=RARE))
        #: count mass of each group's rare words, with the half count of one unknown word
        self.rare_mass = np.maximum(mass, 0) + 0.5
        self.log_total = math.log10(self.tokens + 0.5 * (self.distinct + 1))

    def ids(self, keys: np.ndarray) -> np.ndarray:
        """Model id of each key: a frequent word's place, or their number + its group."""
        at = np.minimum(np.searchsorted(self.keys[self.order], keys), len(self.keys) - 1)
        found = self.order[at]
        return np.where(self.keys[found] == keys, found, len(self.keys) + (keys & np.uint64(15)).astype(np.int64)).astype(np.int32)

    def rest(self, ids: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its group's counts; 0 for frequent words."""
        n = len(self.keys)
        group = np.maximum(ids - n, 0)
        return np.where(ids >= n, np.log10((totals + 0.5) / self.rare_mass[group]), 0.0)


# --- model ------------------------------------------------------------------------------------------------


def class_edges(n: int) -> np.ndarray:
    """Where the classes of n words, commonest first, begin and end: about half of sqrt(n) classes, of growing size."""
    classes = max(1, round(math.sqrt(n) / 2))
    return np.unique(np.ceil(n * (np.arange(classes + 1) / classes) ** 2 - 1e-9).astype(np.int64))


class Gru:
    """Parameters as float32 arrays by name; class c has words edges[c] to edges[c + 1]."""

    def __init__(self, params: dict[str, np.ndarray]):
        self.p = params
        self.words = len(params["bo"])
        self.edges = class_edges(self.words)
        self.classes = len(self.edges) - 1
        # of words, then of the groups of rare words, which are classes of their own
        self.class_of = np.concatenate((np.repeat(np.arange(self.classes), np.diff(self.edges)), self.classes + np.arange(RARE))).astype(np.int16)

    @classmethod
    def start(cls, vocab: Vocabulary) -> Gru:
        rng = np.random.default_rng(11)
        words = len(vocab.counts)
        mass = vocab.counts + 0.5
        edges = class_edges(words)
        sizes = np.diff(edges)
        p = {
            "u": rng.normal(0, 0.3, (words + RARE, 3 * HIDDEN)),
            "w": rng.normal(0, 1 / math.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN)),
            "wc": rng.normal(0, 0.05, (HIDDEN, len(sizes) + RARE)),
            "bc": np.log(np.concatenate((np.add.reduceat(mass, edges[:-1]), vocab.rare_mass))),
            "wo": rng.normal(0, 0.05, (words, HIDDEN)),
            "bo": np.log(mass) - np.repeat(np.log(np.maximum.reduceat(mass, edges[:-1])), sizes),
        }
        p["u"][:, :HIDDEN] += 1.0  # keep the state at first
        p["bc"] -= p["bc"].max()
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    NAMES = ("u", "w", "wc", "bc", "wo", "bo")

    @staticmethod
    def shapes(words: int) -> dict[str, tuple[int, ...]]:
        classes = len(class_edges(words)) - 1 + RARE
        return {"u": (words + RARE, 3 * HIDDEN), "w": (HIDDEN, 3 * HIDDEN), "wc": (HIDDEN, classes), "bc": (classes,), "wo": (words, HIDDEN), "bo": (words,)}

    def tobytes(self) -> bytes:
        return b"".join(self.p[k].astype("<f4").tobytes() for k in self.NAMES)

    @classmethod
    def frombytes(cls, data: bytes, words: int) -> Gru:
        flat, at, p = np.frombuffer(data, "<f4"), 0, {}
        for k, shape in cls.shapes(words).items():
            n = math.prod(shape)
            p[k] = flat[at : at + n].reshape(shape).copy()
            at += n
        return cls(p)

    def forward(self, x: np.ndarray, h: np.ndarray, keep: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States after each input of x (steps, lanes) from state h; inputs of word 0 start a document."""
        w, d = self.p["w"], HIDDEN
        gates = self.p["u"].take(x, axis=0)
        fresh = (x != 0).astype(np.float32)[:, :, None]
        out = np.empty((*x.shape, d), np.float32)
        if keep is not None:
            keep.update(zr=np.empty((*x.shape, 2 * d), np.float32), an=np.empty_like(out), n=np.empty_like(out), hp=np.empty_like(out), fresh=fresh)
        for t in range(len(x)):
            hp = h * fresh[t]
            a = hp @ w
            zr = gates[t, :, : 2 * d] + a[:, : 2 * d]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r, an = zr[:, :d], zr[:, d:], a[:, 2 * d :]
            n = np.tanh(gates[t, :, 2 * d :] + r * an)
            h = out[t]
            np.subtract(hp, n, out=h)
            h *= z
            h += n
            if keep is not None:
                keep["zr"][t], keep["an"][t], keep["n"][t], keep["hp"][t] = zr, an, n, hp
        return out, h

    @staticmethod
    def _softmax(logits: np.ndarray, y: np.ndarray, wanted: bool) -> np.ndarray:
        """Log probability of y; logits, which are far from overflowing, are overwritten: wanted, by probabilities less one for y."""
        np.minimum(logits, 80, out=logits)
        at = np.arange(len(y))
        own = logits[at, y].astype(np.float64)
        np.exp(logits, out=logits)
        total = logits @ np.ones(logits.shape[1], np.float32)
        if wanted:
            logits *= (1 / total)[:, None]
            logits[at, y] -= 1
        return own - np.log(total)

    def output(self, h: np.ndarray, y: np.ndarray, grads: dict | None = None) -> np.ndarray:
        """Log probabilities of words y after states h; grads: gets the gradients of their mean's negative."""
        cls = self.class_of[y]
        order = np.argsort(cls, kind="stable")
        h, y, cls = h[order], y[order], cls[order]
        p = h @ self.p["wc"]
        p += self.p["bc"]
        logp = self._softmax(p, cls, grads is not None)
        if grads is not None:
            grads["wc"], grads["bc"], dh = h.T @ p, p.sum(axis=0), p @ self.p["wc"].T
            grads["wo"], grads["bo"] = np.zeros_like(self.p["wo"]), np.zeros_like(self.p["bo"])
        edges = np.searchsorted(cls, np.arange(self.classes + 1))
        for c in np.flatnonzero(np.diff(edges)).tolist():
            rows, own = slice(edges[c], edges[c + 1]), slice(self.edges[c], self.edges[c + 1])
            wo = self.p["wo"][own]
            q = h[rows] @ wo.T
            q += self.p["bo"][own]
            logp[rows] += self._softmax(q, y[rows] - self.edges[c], grads is not None)
            if grads is not None:
                np.matmul(q.T, h[rows], out=grads["wo"][own])
                np.sum(q, axis=0, out=grads["bo"][own])
                dh[rows] += q @ wo
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        if grads is not None:
            grads["h"] = dh[back]
        return logp[back]

    def backward(self, x: np.ndarray, kept: dict, dh_out: np.ndarray, grads: dict) -> None:
        d, w = HIDDEN, self.p["w"]
        da = np.empty((*x.shape, 3 * d), np.float32)
        dn_in = np.empty((*x.shape, d), np.float32)
        dh = np.zeros_like(dh_out[0])
        for t in range(len(x) - 1, -1, -1):
            dh = dh + dh_out[t]
            z, r = kept["zr"][t, :, :d], kept["zr"][t, :, d:]
            n, hp, an = kept["n"][t], kept["hp"][t], kept["an"][t]
            dn = dh * (1 - z) * (1 - n * n)
            da[t, :, :d] = dh * (hp - n) * z * (1 - z)
            da[t, :, d : 2 * d] = dn * an * r * (1 - r)
            da[t, :, 2 * d :] = dn * r
            dn_in[t] = dn
            dh = (dh * z + da[t] @ w.T) * kept["fresh"][t]
        grads["w"] = kept["hp"].reshape(-1, d).T @ da.reshape(-1, 3 * d)
        da[:, :, 2 * d :] = dn_in
        flat = x.ravel()
        order = np.argsort(flat.astype(np.uint16) if len(self.p["u"]) <= 1 << 16 else flat, kind="stable")
        rows = flat[order]
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        grads["u_rows"], grads["u"] = rows[first], np.add.reduceat(da.reshape(-1, 3 * d)[order], first, axis=0)


def lanes(lens: np.ndarray, most: int) -> list[list[int]]:
    """Documents dealt over lanes, longest first to the shortest lane; lanes in descending length."""
    import heapq

    heap = [(0, k) for k in range(min(most, len(lens)))]
    out: list[list[int]] = [[] for _ in heap]
    for k in np.argsort(-lens, kind="stable").tolist():
        n, lane = heapq.heappop(heap)
        out[lane].append(k)
        heapq.heappush(heap, (n + int(lens[k]), lane))
    return sorted(out, key=lambda lane: -int(lens[lane].sum()))


def side_by_side(docs: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, document of each place) as (steps, lanes) with -1 beyond a lane's end, and lanes' lengths."""
    lens = np.array([len(d) for d in docs], np.int64)
    dealt = lanes(lens, most)
    ends = np.array([lens[lane].sum() for lane in dealt])
    y = np.full((int(ends[0]), len(dealt)), -1, np.int32)
    own = np.full(y.shape, -1, np.int32)
    for k, lane in enumerate(dealt):
        y[: ends[k], k] = np.concatenate([docs[j] for j in lane])
        own[: ends[k], k] = np.repeat(np.array(lane, np.int32), lens[lane])
    x = np.zeros_like(y)
    x[1:] = np.maximum(y[:-1], 0)  # after an end token, and first of all, comes a document's start
    return x, y, own, ends


def score(model: Gru, docs: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each document's classes and frequent words."""
    out = np.zeros(len(docs))
    if not docs:
        return out
    x, y, own, ends = side_by_side(docs, LANES)
    h, lo = np.zeros((len(ends), HIDDEN), np.float32), 0
    while lo < len(x):
        n = int((ends > lo).sum())
        hi = lo + max(WINDOW, STEP // n)
        states, h = model.forward(x[lo:hi, :n], h[:n])
        target, who, lo = y[lo:hi, :n].ravel(), own[lo:hi, :n].ravel(), hi
        ok = target >= 0
        logp = model.output(states.reshape(-1, HIDDEN)[ok], target[ok])
        out += np.bincount(who[ok], logp, minlength=len(docs))
    return out / _LN10


class Adagrad:
    def __init__(self, model: Gru, rate: float = RATE):
        self.model, self.rate, self.sums = model, rate, {k: np.full_like(v, START) for k, v in model.p.items()}

    def step(self, grads: dict, n: int) -> None:
        """Moves by summed gradients; n: tokens of a full step, so that steps of few lanes weigh less."""
        scale = max(1.0, math.sqrt(n))
        self._move("u", grads["u_rows"], grads["u"], scale)
        for k in ("w", "wc", "bc", "wo", "bo"):
            self._move(k, slice(None), grads[k], scale)

    def _move(self, name: str, where, g: np.ndarray, scale: float) -> None:
        g *= np.float32(1 / scale)
        np.minimum(g, 5, out=g)
        np.maximum(g, -5, out=g)
        total = self.sums[name][where]
        total += g * g
        g *= np.float32(self.rate)
        g /= np.sqrt(total)
        if isinstance(where, slice):
            self.model.p[name] -= g
        else:
            self.sums[name][where] = total
            self.model.p[name][where] -= g


def learn(optimizer: Adagrad, docs: list[np.ndarray]) -> None:
    """One pass of truncated backpropagation over documents."""
    if not docs:
        return
    model = optimizer.model
    # stretches of a long document are trained on side by side, from a fresh state each
    docs = [d[lo : lo + STRETCH] for d in docs for lo in range(0, len(d), STRETCH)]
    x, y, _, ends = side_by_side(docs, max(FEWEST, min(LANES, sum(map(len, docs)) // STRETCH)))
    h = np.zeros((len(ends), HIDDEN), np.float32)
    for lo in range(0, len(x), WINDOW):
        n = int((ends > lo).sum())
        kept: dict = {}
        part = x[lo : lo + WINDOW, :n]
        states, h = model.forward(part, h[:n], kept)
        target = y[lo : lo + WINDOW, :n].ravel()
        ok = np.flatnonzero(target >= 0)
        grads: dict = {}
        model.output(states.reshape(-1, HIDDEN)[ok], target[ok], grads)
        dh = np.zeros((target.size, HIDDEN), np.float32)
        dh[ok] = grads.pop("h")
        model.backward(part, kept, dh.reshape(*part.shape, HIDDEN), grads)
        optimizer.step(grads, len(ends) * WINDOW)


# --- the operator -----------------------------------------------------------------------------------------


def block_documents(lens: bytes, tokens: bytes, ids: np.ndarray) -> list[np.ndarray]:
    """Model ids of each document of a block; ids: by local word."""
    ends = np.cumsum(np.frombuffer(lens, "<u4").astype(np.int64))
    return np.split(ids[np.frombuffer(tokens, "<u4")], ends[:-1])


def trained(blocks: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> Gru:
    sc = blocks.sparkSession.sparkContext
    model = Gru.start(vocab)
    vocab_sent, words = sc.broadcast(vocab), model.words
    # a copy is as large as the model: as many as there are cores, and of TASK tokens each where there are fewer
    tasks = max(1, min(sc.defaultParallelism, vocab.tokens // (rounds * TASK)))
    for r in range(rounds):
        sent = sc.broadcast(model.tobytes())

        def run(batches, sent=sent):
            import pyarrow as pa
            from pyspark import TaskContext

            task = TaskContext.get().partitionId()
            optimizer, docs, size, seen = Adagrad(Gru.frombytes(sent.value, words)), [], 0, 0
            for batch in batches:
                for lens, held, tokens, keys in zip(*batch.columns, strict=True):
                    found = block_documents(lens.as_py(), tokens.as_py(), vocab_sent.value.ids(np.frombuffer(keys.as_py(), "<u8")))
                    new = [d for d, out in zip(found, np.frombuffer(held.as_py(), np.uint8), strict=True) if not out]
                    docs += new
                    size += sum(map(len, new))
                    if size >= TOKENS:
                        learn(optimizer, docs)
                        seen, docs, size = seen + size, [], 0
            learn(optimizer, docs)
            seen += size
            if seen:
                data = optimizer.model.tobytes()
                for part, at in enumerate(range(0, len(data), PART)):
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([task], pa.int32()), pa.array([seen], pa.int64()), pa.array([data[at : at + PART]], pa.binary())], names=["part", "task", "n", "model"])

        def mean(group):
            import pyarrow as pa

            n = group.column("n").to_pylist()
            flat = np.zeros(len(group.column("model")[0].as_py()) // 4)
            for k, x in zip(n, group.column("model"), strict=True):
                flat += np.frombuffer(x.as_py(), "<f4") * (k / sum(n))
            task = group.column("task")[0].as_py() // FAN
            return pa.table({"part": group.column("part").slice(0, 1), "task": pa.array([task], pa.int32()), "n": pa.array([sum(n)], pa.int64()), "model": pa.array([flat.astype("<f4").tobytes()], pa.binary())})

        schema = "part int, task int, n long, model binary"
        mine = blocks.filter(F.pmod(F.xxhash64("block"), F.lit(rounds)) == r).select("lens", "held", "tokens", "keys").coalesce(tasks)
        copies, left = mine.mapInArrow(run, schema), tasks
        while left > 1:
            copies, left = copies.groupBy("part", F.floor(F.col("task") / FAN).alias("step")).applyInArrow(mean, schema), -(-left // FAN)
        got = copies.collect()  # one model
        if got:
            model = Gru.frombytes(b"".join(x["model"] for x in sorted(got, key=lambda x: x["part"])), words)
    return model


def scored(blocks: DataFrame, totals: DataFrame, vocab: Vocabulary, model: Gru, buckets: int) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score, score; a block's counts come to it by block number."""
    sc = blocks.sparkSession.sparkContext
    vocab_sent, sent = sc.broadcast(vocab), sc.broadcast(model.tobytes())
    lists = totals.groupBy("block").agg(F.collect_list(F.struct("bucket", "totals")).alias("totals"))
    both = blocks.select("block", "doc_ids", "lens", "held", "tokens", "keys").join(lists, "block")

    def run(batches):
        import pyarrow as pa

        vocab = vocab_sent.value
        model = Gru.frombytes(sent.value, len(vocab.keys))
        rows, docs, size = [], [], 0

        def flush():
            nonlocal rows, docs, size
            ids, held, n, known, base, rest = (sum(x, []) for x in zip(*rows, strict=True))
            total = np.array(rest) + score(model, docs)
            out = [pa.array(ids, pa.int64()), pa.array([bool(x) for x in held]), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(total)]
            rows, docs, size = [], [], 0
            return pa.RecordBatch.from_arrays(out, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

        for batch in batches:
            for k in range(batch.num_rows):
                lens, held, tokens, keys = (batch.column(c)[k].as_py() for c in range(2, 6))
                key = np.frombuffer(keys, "<u8")
                total = np.zeros(len(key), np.int64)
                bucket = bucket_of(key, buckets)
                order = np.argsort(bucket, kind="stable")
                sorted_buckets = bucket[order]
                for x in batch.column(6)[k].as_py():
                    at = np.searchsorted(sorted_buckets, [x["bucket"], x["bucket"] + 1])
                    total[order[at[0] : at[1]]] = np.frombuffer(x["totals"], "<i8")
                ids = vocab.ids(key)
                tok = np.frombuffer(tokens, "<u4")
                n = np.frombuffer(lens, "<u4").astype(np.int64)
                first = np.cumsum(n) - n
                base = np.add.reduceat((np.log10(total + 0.5) - vocab.log_total)[tok], first)
                known = np.add.reduceat((total > 0).astype(np.int64)[tok], first)
                rest = np.add.reduceat(vocab.rest(ids, total)[tok], first)
                rows.append((batch.column(1)[k].as_py(), list(np.frombuffer(held, np.uint8)), n.tolist(), known.tolist(), base.tolist(), rest.tolist()))
                docs += block_documents(lens, tokens, ids)
                size += len(tok)
                if size >= TOKENS:
                    yield flush()
        if rows:
            yield flush()

    return both.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def log_likelihoods(docs: DataFrame, held_out) -> DataFrame:
    """Scores of all documents by a model of those that aren't held out."""
    blocks = store(tokenised(docs, held_out), "blocks").df
    buckets = bucket_count(blocks)
    totals = store(counted(blocks, buckets), "counts").df
    vocab = Vocabulary(totals)
    model = trained(blocks, vocab)
    return scored(blocks, totals, vocab, model, buckets).withColumn("train_tokens", F.lit(vocab.tokens).cast("long"))


def op4_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    got = log_likelihoods(table(spark, sf_dir, "documents"), held)
    return got.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
