"""Operator 8: MinHash near-duplicates with sequential Bayesian verification.

A document's set are its distinct word n-grams. Equal word sequences form one class and go on as one document.
Signatures of BANDS * ROWS + EXTRA hashes are banded; a bucket's members are first held against the member that
most of their buckets share (one candidate pair a document, so a group of n near copies costs n pairs, not n
squared). A pair is compared batch by batch of its signatures and dropped as soon as the posterior probability
(uniform prior) that its similarity reaches the threshold is under MISS; survivors are verified on full sets.
Verified pairs are joined into components. Buckets whose members are then still in different components are
compared across components where they meet: pairs that pass the signatures are held against their sets (32-bit
hashes), and of each member and component the likeliest pair goes on to full verification. If one of those
fails there, all pairs go on, so no surviving pair of different components is left unverified.

A pair at the threshold shares no band with probability (1 - t**ROWS)**BANDS: 7e-6 at 0.85, 1e-4 at 0.8.

Nulls: texts without words (null, empty, only spaces) have empty sets and are linked with nothing. Rows with a
null doc_id form no links; their component is null and they are kept. Rows that share a doc_id count as one
document: they are linked. Repeated rows are returned as often as they occur. Empty tables give empty results.
Sets are compared by 64-bit hashes of their n-grams.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.llm._common import Temporary, bitmap_filter, fresh, lean, left_join, release, store, table, utf8

BANDS, ROWS, EXTRA, BATCH = 16, 4, 64, 32
SIZE = BANDS * ROWS + EXTRA
MISS = 1e-5
#: Members of a bucket compared in one task.
CHUNK = 1024
#: Pairs a member and component that a round verifies; None: all.
ROUNDS = (1, None)

_rng = np.random.default_rng(8675309)
_MUL = (_rng.integers(0, 1 << 31, SIZE, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_ADD = _rng.integers(0, 1 << 32, SIZE, np.uint64).astype(np.uint32)[:, None]
_W = _rng.integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_CACHE = 300_000
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Shingler:
    """Distinct n-gram hashes of a text's words (bytes between ASCII white space, A-Z in lower case)."""

    def __init__(self, n: int):
        self.n, self.words = n, {}

    def ids(self, body: bytes) -> tuple[np.ndarray, list[bytes]]:
        import xxhash

        words = body.lower().split()
        known = self.words
        try:
            return np.array([known[w] for w in words], np.uint64), words
        except KeyError:
            if len(known) > _CACHE:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            return np.array([known[w] for w in words], np.uint64), words

    def set(self, body: bytes) -> np.ndarray:
        return self.of(self.ids(body)[0])

    def of(self, h: np.ndarray) -> np.ndarray:
        n = min(self.n, len(h))
        if not n:
            return h
        out = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            x = h[k : len(h) - n + 1 + k] * _W[k % 64]
            out = (out ^ (out >> np.uint64(29))) * _W[63] + (x ^ (x >> np.uint64(32)))
        out ^= out >> np.uint64(31)
        out *= _W[62]
        out.sort()
        keep = np.ones(len(out), bool)
        keep[1:] = out[1:] != out[:-1]
        return out[keep]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of SIZE hash functions over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    sig = np.full(SIZE, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), 2048):
        np.minimum(sig, (x[lo : lo + 2048] * _MUL + _ADD).min(axis=1), out=sig)
    return sig


def least_matches(threshold: float, miss: float = MISS) -> dict[int, int]:
    """For n compared hashes (multiples of BATCH): the fewest matches with P(similarity >= threshold | matches) >= miss."""
    s = (np.arange(200_000) + 0.5) / 200_000
    high, out = s >= threshold, {}
    for n in range(BATCH, SIZE + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(s) + (n - m) * np.log1p(-s)
            p = np.exp(log - log.max())
            if p[high].sum() / p.sum() >= miss:
                out[n] = m
                break
    return out


def shingled(docs: DataFrame, n: int, keep: list[str]) -> DataFrame:
    """keep, n_shingles, seq (hash of the word sequence), sig and set (32-bit hashes in order); these are null for empty sets."""
    from pyspark.sql import types as T

    base = docs.select(utf8(F.col("text")).alias("body"), *keep)
    schema = T.StructType([*base.schema.fields[1:], T.StructField("n_shingles", T.LongType()), T.StructField("seq", T.BinaryType()), T.StructField("sig", T.BinaryType()), T.StructField("set", T.BinaryType())])

    def run(batches):
        import pyarrow as pa

        make = Shingler(n)
        for batch in batches:
            counts, seqs, sigs, sets = [], [], [], []
            for body in batch.column(0):
                h, words = make.ids(body.as_py())
                s = make.of(h)
                counts.append(len(s))
                seqs.append(hashlib.md5(b" ".join(words), usedforsecurity=False).digest() if len(s) else None)
                sigs.append(signature(s).tobytes() if len(s) else None)
                sets.append((s >> np.uint64(32)).astype("<u4").tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(counts, pa.int64()), pa.array(seqs, pa.binary()), pa.array(sigs, pa.binary()), pa.array(sets, pa.binary())], names=schema.names)

    return base.mapInArrow(lean(run), schema)


def _spanning(edges: DataFrame) -> DataFrame:
    """Each task's own edges as stars around its components' smallest ids."""

    def run(batches):
        import pandas as pd

        parent: dict[int, int] = {}

        def root(x):
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[p]
            return x

        for pdf in batches:
            for a, b in zip(pdf["u"].tolist(), pdf["v"].tolist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = [x for x in parent if root(x) != x]
        for lo in range(0, len(nodes), 50_000):
            part = nodes[lo : lo + 50_000]
            yield pd.DataFrame({"u": part, "v": [root(x) for x in part]})

    return edges.mapInPandas(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node reachable) of every node with an edge; edges: u, v.

    Large-star and small-star rounds, written out between them; edges never meet on the driver. Each task
    first contracts its own edges, which settles most of them.
    """
    now = store(_spanning(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))).distinct(), "stars")
    seen = None
    while True:
        both = now.df.select("u", "v").union(now.df.select(F.col("v"), F.col("u"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u != v").distinct()
        following = store(small, "stars")
        mark = following.df.agg(F.count("*"), F.coalesce(F.expr("bit_xor(xxhash64(u, v))"), F.lit(0))).first()
        now.drop()
        now = following
        # stars that a round leaves as they are: every node hangs on its component's smallest
        if mark == seen:
            return now.df.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = mark


class Verifier:
    """Pairs (u, v) that pass the signatures' bounds and then reach the threshold on full sets."""

    def __init__(self, docs: DataFrame, reps: DataFrame, n: int, percent: int):
        self.docs = docs.select(F.col("doc_id").cast("long").alias("id"), utf8(F.col("text")).alias("body")).filter("id IS NOT NULL")
        self.reps, self.n, self.percent = reps, n, percent

    def likely(self, pairs: DataFrame) -> DataFrame:
        least = least_matches(self.percent / 100)
        sig = self.reps.select("rep", "sig")
        both = pairs.join(sig.toDF("u", "su"), "u").join(sig.toDF("v", "sv"), "v")

        def run(batches):
            import pyarrow as pa

            for batch in batches:
                a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, SIZE) for k in (2, 3))
                left = np.arange(batch.num_rows)
                for n, m in least.items():
                    left = left[(a[left, :n] == b[left, :n]).sum(axis=1) >= m]
                yield pa.RecordBatch.from_arrays([c.take(pa.array(left)) for c in batch.columns[:2]], names=["u", "v"])

        return both.select("u", "v", "su", "sv").mapInArrow(run, "u long, v long").distinct()

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Texts are only shuffled for documents that a surviving pair names."""
        ids = pairs.select(F.explode(F.array("u", "v")).alias("id"))
        texts = bitmap_filter(self.docs, ids, ["id"])
        half = pairs.join(texts.toDF("v", "bv"), "v")
        both = half.join(texts.toDF("u", "bu"), "u").select("u", "v", "bu", "bv")
        n, percent = self.n, self.percent

        def run(batches):
            import pyarrow as pa

            make, last = Shingler(n), (None, None)
            for batch in batches:
                hit = []
                for k, (bu, bv) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                    bu = bu.as_py()
                    a = last[1] if last[0] == bu else make.set(bu)
                    last, b = (bu, a), make.set(bv.as_py())
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if both and 100 * both >= percent * (len(a) + len(b) - both):
                        hit.append(k)
                yield pa.RecordBatch.from_arrays([c.take(pa.array(hit, pa.int64())) for c in batch.columns[:2]], names=["u", "v"])

        return both.mapInArrow(run, "u long, v long")


def across(mixed: DataFrame, percent: int, most: int | None) -> DataFrame:
    """Pairs (u, v) of members of a bucket in different components that pass the bounds and their 32-bit sets; of each member and component of others the `most` likeliest.

    mixed: bucket, rep, comp, sig, set. The largest component of a bucket is cut into chunks and the rest repeated
    for each; the rest among themselves go by pairs of chunks. No task gets more than about two chunks.
    """
    sizes = mixed.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    per = sizes.groupBy("bucket").agg(F.max_by("comp", F.struct("n", "comp")).alias("top"), F.max("n").alias("n_top"), F.sum("n").alias("n_all"))
    placed = mixed.join(per, "bucket")
    chunks = F.ceil(F.col("n_top") / CHUNK)
    parts = F.ceil((F.col("n_all") - F.col("n_top")) / CHUNK)
    own = F.pmod(F.xxhash64("rep"), chunks)
    part = F.pmod(F.xxhash64("rep", F.lit(1)), F.greatest(parts, F.lit(1)))
    against = F.transform(F.sequence(F.lit(0).cast("long"), chunks - 1), lambda c: F.struct(F.lit("t").alias("kind"), c.alias("i"), F.lit(0).cast("long").alias("j")))
    among = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(parts, F.lit(1)) - 1), lambda c: F.struct(F.lit("o").alias("kind"), F.least(c, part).alias("i"), F.greatest(c, part).alias("j")))
    where = F.when(F.col("comp") == F.col("top"), F.array(F.struct(F.lit("t").alias("kind"), own.alias("i"), F.lit(0).cast("long").alias("j")))).otherwise(F.concat(against, among))
    dealt = placed.select("bucket", F.explode(where).alias("g"), "rep", "comp", "sig", "set", (F.col("comp") == F.col("top")).alias("is_top"), part.alias("part"))
    least = least_matches(percent / 100)

    def run(group):
        import pyarrow as pa

        rep, comp, part = (np.asarray(group.column(c).combine_chunks()) for c in ("rep", "comp", "part"))
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint32).reshape(-1, SIZE)
        sets = [np.frombuffer(x, "<u4") for x in group.column("set").to_pylist()]
        size = np.array([len(x) for x in sets], np.int64)
        # texts of which two n-grams share a hash may have one more in common than it seems
        slack = np.array([n - len(np.unique(x)) for n, x in zip(size, sets, strict=True)], np.int64)
        top = np.array(group.column("is_top").to_pylist(), bool)
        kind, i, j = (group.column(c)[0].as_py() for c in ("kind", "i", "j"))
        left, right = (np.flatnonzero(~top), np.flatnonzero(top)) if kind == "t" else (np.flatnonzero(part == i), np.flatnonzero(part == j))
        out_u, out_v = [], []
        for x in left:
            y = right[comp[right] != comp[x]]
            for n, m in least.items():
                if not len(y):
                    break
                y = y[(sig[y, :n] == sig[x, :n]).sum(axis=1) >= m]
            if not len(y):
                continue
            flat = np.concatenate([sets[k] for k in y])
            own_set = sets[x]
            at = np.minimum(np.searchsorted(own_set, flat), len(own_set) - 1)
            both = np.add.reduceat((own_set[at] == flat).astype(np.int64), np.cumsum(size[y]) - size[y]) + slack[y] + slack[x]
            union = size[y] + size[x] - both
            ok = 100 * both >= percent * union
            y, score = y[ok], both[ok] / union[ok]
            if len(y):
                order = np.lexsort((rep[y], -score, comp[y]))
                y = y[order]
                if most is not None:
                    c = comp[y]
                    head = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
                    rank = np.arange(len(y)) - np.repeat(head, np.diff(np.append(head, len(y))))
                    y = y[rank < most]
                out_u.append(np.minimum(rep[x], rep[y]))
                out_v.append(np.maximum(rep[x], rep[y]))
        u, v = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (out_u, out_v))
        return pa.table({"u": u, "v": v})

    flat = dealt.select("bucket", "g.kind", "g.i", "g.j", "rep", "comp", "sig", "set", "is_top", "part")
    return flat.groupBy("bucket", "kind", "i", "j").applyInArrow(run, "u long, v long").filter("u != v").distinct()


def linked(docs: DataFrame, n: int = 3, percent: int = 85, keep: list[str] | None = None) -> DataFrame:
    """doc_id (and keep), n_shingles, component_id, kept of every row."""
    keep = keep or ["doc_id"]
    rows = store(shingled(docs, n, keep), "signatures").df
    named = rows.filter("sig IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), "seq", "sig")
    reps = store(named.groupBy("seq").agg(F.min("id").alias("rep"), F.min_by("sig", "id").alias("sig")), "classes").df
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring(F.col("sig"), b * (4 * ROWS) + 1, F.lit(4 * ROWS))))
    bands = reps.select("rep", F.explode(keys).alias("bucket")).distinct()
    shared = bands.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.count("*").alias("n")).filter("n > 1").select("bucket", "pivot")
    members = store(left_join(bands, shared, "bucket").filter("pivot IS NOT NULL"), "members").df
    votes = members.filter("pivot != rep").groupBy("rep", "pivot").agg(F.count("*").alias("n"))
    pairs = votes.groupBy("rep").agg(F.max_by("pivot", F.struct("n", -F.col("pivot"))).alias("u")).select("u", F.col("rep").alias("v"))
    check = Verifier(docs, reps, n, percent)
    # rows that share a doc_id: every class of theirs counts as theirs
    twice = named.select("id", "seq").distinct().groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id")
    same = named.select("id", "seq").distinct().join(twice, "id").join(reps.select("seq", "rep"), "seq").select(F.col("rep").alias("u"), F.col("id").alias("v")).filter("u != v")
    tested = store(check.likely(pairs), "tested").df
    edges = store(check.verified(tested).unionByName(same), "links").df
    labels = components(edges)
    sets = rows.filter("sig IS NOT NULL AND doc_id IS NOT NULL").select("seq", F.col("doc_id").cast("long").alias("id"), "set")
    for most in ROUNDS:
        placed = members.select("bucket", "rep").join(labels.toDF("rep", "label"), "rep", "left").select("bucket", "rep", F.coalesce("label", "rep").alias("comp"))
        placed = store(placed, "placed").df
        open_ = placed.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("bucket", F.lit(True).alias("open"))
        mixed = store(left_join(placed, open_, "bucket").filter("open").select("bucket", "rep", "comp"), "mixed").df
        if mixed.isEmpty():
            break
        # signatures and sets of the members alone, once a member
        wanted = reps.join(mixed.select("rep").distinct(), "rep", "left_semi")
        whole = bitmap_filter(sets, wanted, ["seq"]).groupBy("seq").agg(F.min_by("set", "id").alias("set"))
        full = store(wanted.join(whole, "seq").select("rep", "sig", "set"), "members").df
        found = across(mixed.join(full, "rep"), percent, most)
        new = store(found.join(tested, ["u", "v"], "left_anti"), "candidates").df
        more = store(check.verified(new), "links").df
        edges = edges.unionByName(more)
        labels = components(edges)
        if more.count() == new.count():
            break
        tested = tested.unionByName(new)
    named_reps = reps.select("seq", "rep").join(labels.toDF("rep", "label"), "rep", "left").select("seq", F.coalesce("label", "rep").alias("component_id"))
    joined = left_join(rows.drop("sig", "set"), named_reps, "seq")
    component = F.coalesce("component_id", F.col("doc_id").cast("long"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return joined.select(*keep, "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def near_dedup(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Pipeline form: of each component's documents the one with the smallest doc_id stays, in one row.

    Of rows that share a doc_id the one with the smallest text stays. Documents without a doc_id form no links; of
    those with equal word sequences one stays, and all without words. The ids that go, and those that repeat, are few
    beside the texts: bitmaps of them keep other documents out of joins and groups.
    """
    columns = docs.columns
    ident, words, flag = (fresh(c, columns) for c in ("own_id", "own_words", "maybe_met"))
    with Temporary() as temp:
        found = linked(docs.select("doc_id", "text"), n, percent)
        gone = temp.keep(store(found.filter("NOT kept").select(F.col("doc_id").cast("long").alias(ident)).distinct(), "dropped")).df
        twice = docs.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias(ident)).agg(F.count("*").alias("n")).filter("n > 1").select(ident)
        twice = temp.keep(store(twice, "repeated")).df
    release(docs.sparkSession)
    keyed = docs.filter("doc_id IS NOT NULL").withColumn(ident, F.col("doc_id").cast("long"))
    flagged = bitmap_filter(keyed, gone.union(twice), [ident], flag)
    once = flagged.filter(~F.col(flag)).select(*columns)
    rest = flagged.filter(flag).join(gone, ident, "left_anti")
    first = lambda df, key: df.groupBy(key).agg(F.min_by(F.struct(*columns), F.coalesce("text", F.lit(""))).alias(flag)).select(*[F.col(flag)[c].alias(c) for c in columns])
    bare = docs.filter("doc_id IS NULL").withColumn(words, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0)))
    keyed_bare = bare.withColumn(words, F.when(F.size(words) > 0, F.md5(F.translate(F.array_join(words, " "), UPPER, LOWER))))
    unnamed = first(keyed_bare.filter(F.col(words).isNotNull()), words).unionByName(keyed_bare.filter(F.col(words).isNull()).select(*columns))
    return once.unionByName(first(rest, ident)).unionByName(unnamed)


def op8_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"), 3, 85)
