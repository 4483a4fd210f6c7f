"""Operator 3: benchmark decontamination by greedy string tiling (running Karp-Rabin).

Words are runs of letters, digits and underscores in lower case. Word n-grams (n = min_match) that a document shares
with a benchmark item are the seeds: of each item so many of its rarest ones are indexed that a document with none of
them can't cover `coverage` of its words, and items whose seeds could not cover that are passed over. For the others the longest common runs of unmarked words are marked again and again, longest first,
found by hashes of runs whose length is halved from round to round, until none of min_match words is left. A
document is contaminated by an item of which tiles cover `coverage` or more, in any order.

The benchmark is sent to the executors in blocks of about BLOCK_BYTES of text; all documents are held against each
block, without a shuffle of the documents. The blocks of one call are all alive until its result is written, so an
executor needs memory for the whole benchmark's index: some ten times its text.

Nulls: a null text has no words. An item with fewer than min_match words has to be matched whole (its run
length is its word count); one without words matches nothing. Null ids are returned as they are. Repeated
documents and items give a match each. Of equally long tiles the first in the item, then in the document, is
marked first. Empty tables give empty results. Other columns are passed on or left
unread.
"""

from __future__ import annotations

import heapq
import math
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curlew.llm._common import fresh, lean, table

MIN_MATCH = 3
COVERAGE = 0.8
BLOCK_BYTES = 32 << 20
_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
MATCHES = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("item_tokens", T.IntegerType()), T.StructField("covered", T.IntegerType()), T.StructField("tiles", T.ArrayType(T.StructType([T.StructField(k, T.IntegerType()) for k in ("item_start", "doc_start", "length")])))]))


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes (mod 2**64) of all runs of n ids."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(ids) - n + 1, np.uint64)
    x = ids.astype(np.uint64) + np.uint64(1)
    for k in range(n):
        out = out * _BASE + x[k : len(x) - n + 1 + k]
    return out


def tiles(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item_start, doc_start, length) of the tiles, longest first."""
    free_a, free_b = np.ones(len(item), bool), np.ones(len(doc), bool)
    out: list[tuple[int, int, int]] = []
    size = max(min_match, min(len(item), len(doc)))
    while True:
        found = []
        whole_a = np.convolve(free_a, np.ones(size, int), "valid") == size if len(item) >= size else np.zeros(0, bool)
        whole_b = np.convolve(free_b, np.ones(size, int), "valid") == size if len(doc) >= size else np.zeros(0, bool)
        at_a, at_b = np.flatnonzero(whole_a), np.flatnonzero(whole_b)
        if len(at_a) and len(at_b):
            ha, hb = rolling(item, size)[at_a], rolling(doc, size)[at_b]
            order = np.argsort(hb, kind="stable")
            lo, hi = np.searchsorted(hb[order], ha, "left"), np.searchsorted(hb[order], ha, "right")
            for i, first, last in zip(at_a[hi > lo].tolist(), lo[hi > lo], hi[hi > lo], strict=True):
                for j in at_b[order[first:last]].tolist():
                    if i and j and item[i - 1] == doc[j - 1] and free_a[i - 1] and free_b[j - 1]:
                        continue  # part of a run that starts before
                    n = min(len(item) - i, len(doc) - j)
                    stop = np.flatnonzero((item[i : i + n] != doc[j : j + n]) | ~free_a[i : i + n] | ~free_b[j : j + n])
                    n = int(stop[0]) if len(stop) else n
                    if n >= size:
                        found.append((-n, i, j))
        # longest first; what earlier tiles left of a run queues again under its new length
        heapq.heapify(found)
        while found:
            n, i, j = heapq.heappop(found)
            free = free_a[i : i - n] & free_b[j : j - n]
            if free.all():
                free_a[i : i - n] = False
                free_b[j : j - n] = False
                out.append((i, j, -n))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate(([False], free, [False])).astype(np.int8)))
            for x, y in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if y - x >= size:
                    heapq.heappush(found, (x - y, i + x, j + x))
        if size == min_match:
            return out
        size = max(min_match, size // 2)


class Index:
    """Seeds of a block of items."""

    def __init__(self, items: list[tuple[int | None, str]], min_match: int, coverage: float):
        self.min_match, self.coverage = min_match, coverage
        self.vocab: dict[str, int] = {}
        self.items: list[tuple[int | None, np.ndarray]] = []
        for item_id, text in items:
            if found := words(text):
                self.items.append((item_id, np.array([self.vocab.setdefault(w, len(self.vocab)) for w in found], np.int64)))
        #: by run length: sorted hashes of the items' rarest seeds, the items that hold them; and all seeds by item and place
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.runs: list[np.ndarray] = [rolling(x, min(min_match, len(x))) for _, x in self.items]
        for n in sorted({min(min_match, len(x)) for _, x in self.items}):
            at = [k for k, (_, x) in enumerate(self.items) if min(min_match, len(x)) == n]
            _, often, counts = np.unique(np.concatenate([np.unique(self.runs[k]) for k in at]), return_inverse=True, return_counts=True)
            ends = np.cumsum([len(np.unique(self.runs[k])) for k in at])
            flat, item = [], []
            for k, some in zip(at, np.split(counts[often], ends[:-1]), strict=True):
                flat.append(self.rarest(k, n, some))
                item.append(np.full(len(flat[-1]), k))
            flat, item = np.concatenate(flat), np.concatenate(item)
            order = np.argsort(flat, kind="stable")
            self.seeds[n] = flat[order], item[order]

    def need(self, k: int) -> int:
        """Words of item k that have to be covered."""
        return math.ceil(self.coverage * len(self.items[k][1]) - 1e-9)

    def rarest(self, k: int, n: int, often: np.ndarray) -> np.ndarray:
        """Seeds of item k of which a document that covers it has one at least; often: items that hold each distinct seed.

        A tile of m >= n words holds m - n + 1 seeds' places, so need(k) covered words hold need(k) / n at least. A
        document without a single one of the seeds returned has the others' places at most: fewer than that.
        """
        seeds, places = np.unique(self.runs[k], return_counts=True)
        order = np.lexsort((seeds, -often))
        spared = np.cumsum(places[order]) < math.ceil(self.need(k) / n)
        return seeds[order[~spared]]

    def match(self, texts: list[str | None]) -> list[list[dict]]:
        out: list[list[dict]] = [[] for _ in texts]
        get = self.vocab.get
        docs = [np.array([get(w, -1) for w in words(t)], np.int64) for t in texts]
        lens = np.array([len(d) for d in docs], np.int64)
        if not self.items or not lens.sum():
            return out
        flat, owner = np.concatenate(docs), np.repeat(np.arange(len(docs)), lens)
        for n, (hashes, item) in self.seeds.items():
            if len(flat) < n:
                continue
            ok = owner[: len(flat) - n + 1] == owner[n - 1 :]
            for k in range(n):
                ok &= flat[k : len(flat) - n + 1 + k] >= 0
            at = np.flatnonzero(ok)
            h = np.zeros(len(at), np.uint64)
            for k in range(n):
                h = h * _BASE + (flat[at + k].astype(np.uint64) + np.uint64(1))
            begin = np.searchsorted(owner[at], np.arange(len(docs) + 1))
            lo = np.searchsorted(hashes, h, "left")
            hit = lo < len(hashes)
            hit[hit] = hashes[lo[hit]] == h[hit]
            hit_at = np.flatnonzero(hit)
            if not len(hit_at):
                continue
            # each rare seed once a document, then the items that hold it
            once = np.unique(np.stack((owner[at[hit_at]], lo[hit_at]), 1), axis=0)
            times = np.searchsorted(hashes, hashes[once[:, 1]], "right") - once[:, 1]
            first = np.repeat(once[:, 1], times) + (np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
            pairs = np.unique(np.stack((np.repeat(once[:, 0], times), item[first]), 1), axis=0)
            own, seen = -1, h[:0]
            for d, k in pairs.tolist():
                if d != own:
                    own, seen = d, np.unique(h[begin[d] : begin[d + 1]])
                # what the document's seeds could cover of the item
                there = np.flatnonzero(np.isin(self.runs[k], seen))
                tokens, need = self.items[k][1], self.need(k)
                could = np.zeros(len(tokens), bool)
                for j in range(n):
                    could[there + j] = True
                if could.sum() < need:
                    continue
                found = tiles(tokens, docs[d], n)
                if (covered := sum(t[2] for t in found)) >= need:
                    out[d].append({"item_id": self.items[k][0], "item_tokens": len(tokens), "covered": covered, "tiles": [dict(zip(("item_start", "doc_start", "length"), t, strict=True)) for t in found]})
        return [sorted(x, key=lambda m: (m["item_id"] is not None, m["item_id"])) for x in out]


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """The benchmark's rows in blocks of about block_bytes of text, each collected by itself."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = max(1, math.ceil((rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0) / block_bytes))
    for k in range(n):
        yield [(r[0], r[1]) for r in rows.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(n)) == k).orderBy("item_id", "text").collect()]


def matches(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, min_match: int = MIN_MATCH, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """Every document, with the columns of `keep` (default: all) and an array of its contaminating items, whose column's name is returned too."""
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    name, text = fresh("matches", docs.columns), fresh("body", docs.columns)
    out = docs.select(*keep, F.col("text").alias(text), F.array().cast(MATCHES).alias(name))
    for block in blocks(benchmark, block_bytes):
        index = spark.sparkContext.broadcast(Index(block, min_match, coverage))

        def run(batches, index=index, at=len(keep)):
            import pyarrow as pa

            for batch in batches:
                for lo in range(0, batch.num_rows, 512):
                    part = batch.slice(lo, 512)
                    got = [a + b for a, b in zip(part.column(at + 1).to_pylist(), index.value.match(part.column(at).to_pylist()), strict=True)]
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(got, part.schema.field(at + 1).type)], schema=part.schema)

        out = out.mapInArrow(lean(run), out.schema)
    return out.drop(text), name


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without those that a benchmark item contaminates."""
    found, name = matches(docs, benchmark, **options)
    return found.filter(F.size(name) == 0).select(*docs.columns)


def op3_greedy_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each contaminated document and item of it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, name = matches(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    row = found.select("doc_id", F.explode(name).alias("m"))
    return row.select("doc_id", "m.item_id", F.col("m.item_tokens").cast("long").alias("item_tokens"), F.col("m.covered").cast("long").alias("covered_tokens"), F.size("m.tiles").cast("long").alias("n_tiles"))
