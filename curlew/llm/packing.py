"""Operator 2: best-fit packing by exact complements over the histogram of piece lengths.

Only counts of lengths (at most `capacity` rows) are planned with: a length's gap is filled exactly by one,
two or three lengths, looked up by the gap in an index of the sums of one, two and three lengths, as many times at
once as their counts allow; what no combination fills goes to the fullest sequence that still takes it. Each step uses up a
length or a gap, so the plan has a few thousand patterns whatever the number of documents. Pieces then find
their place by their rank among those of their length.

Nulls: a null text counts as empty (only the end id). Empty tables give empty results; repeated rows are
separate documents. Ties between pieces of a length are broken by task and position, so sequence numbers are
arbitrary but every placement is valid. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curlew.llm._common import lean, store, table
from curlew.llm.tokens import encoder, vocabulary

CAPACITY = 2048


class Sums:
    """Index of the sums of one, two and three lengths that were available at first, by sum.

    Pairs are held by their larger length, triples by their largest, both in descending order; a triple's other two
    are a pair of the index. Counts only fall, so what is used up is passed over for good.
    """

    def __init__(self, left: np.ndarray, capacity: int):
        self.left = left
        have = np.flatnonzero(left[1:capacity]) + 1
        self.pairs: dict[int, list[int]] = {}
        for big in have[::-1].tolist():
            for total in (big + have[(have <= big) & (have + big < capacity)]).tolist():
                self.pairs.setdefault(total, []).append(big)
        sums = np.array(sorted(self.pairs), np.int64)
        self.triples: dict[int, list[int]] = {}
        for big in have[::-1].tolist():
            for total in (big + sums[(sums <= 2 * big) & (sums + big < capacity)]).tolist():
                self.triples.setdefault(total, []).append(big)
        self.pairs_at, self.triples_at = dict.fromkeys(self.pairs, 0), dict.fromkeys(self.triples, 0)

    def single(self, gap: int, taken: tuple[int, ...]) -> tuple[int, ...] | None:
        return (gap,) if self.left[gap] > taken.count(gap) else None

    def pair(self, gap: int, taken: tuple[int, ...], most: int) -> tuple[int, ...] | None:
        """Two lengths that sum to gap, the larger as large as possible and at most `most`, besides those taken."""
        bigs = self.pairs.get(gap, ())
        while (at := self.pairs_at.get(gap, 0)) < len(bigs) and not (self.left[bigs[at]] and self.left[gap - bigs[at]]):
            self.pairs_at[gap] = at + 1
        for big in bigs[self.pairs_at.get(gap, 0) :]:
            small = gap - big
            if big <= most and self.left[big] > taken.count(big) + (big == small) and self.left[small] > taken.count(small):
                return big, small
        return None

    def triple(self, gap: int, taken: tuple[int, ...]) -> tuple[int, ...] | None:
        bigs = self.triples.get(gap, ())
        while (at := self.triples_at.get(gap, 0)) < len(bigs) and not self.left[bigs[at]]:
            self.triples_at[gap] = at + 1
        for big in bigs[self.triples_at.get(gap, 0) :]:
            if self.left[big] > taken.count(big) and (rest := self.pair(gap - big, (*taken, big), big)):
                return (big, *rest)
        return None


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in a sequence, times used) that use up counts[length] pieces of each length."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        out.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    sums = Sums(left, capacity)

    bins: dict[int, list[list]] = {}  # gap: [pattern, times]
    for length in range(capacity - 1, 0, -1):
        while left[length]:
            gap, taken = capacity - length, (length,)
            fill = sums.single(gap, taken) or sums.pair(gap, taken, capacity) or sums.triple(gap, taken)
            if not fill:
                break
            pattern = (length, *fill)
            times = min(left[x] // pattern.count(x) for x in set(pattern))
            out.append((pattern, int(times)))
            for x in pattern:
                left[x] -= times
    for length in range(capacity - 1, 0, -1):
        while left[length]:
            gap = min((g for g in bins if g >= length and bins[g]), default=None)
            if gap is None:
                each = capacity // length
                full, rest = divmod(int(left[length]), each)
                for n, times in ((each, full), (rest, 1)):
                    if n and times:
                        bins.setdefault(capacity - n * length, []).append([(length,) * n, times])
                left[length] = 0
                break
            pattern, times = bins[gap][-1]
            take = min(times, int(left[length]))
            bins[gap][-1][1] -= take
            if bins[gap][-1][1] == 0:
                bins[gap].pop()
            bins.setdefault(gap - length, []).append([(*pattern, length), take])
            left[length] -= take
    return out + [(tuple(p), t) for group in bins.values() for p, t in group if t]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks of its runs of slots, each run's first sequence and offset."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    first = 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rank = used.get(length, 0)
            runs.setdefault(length, []).append((rank, first, offset))
            used[length] = rank + times
            offset += length
        first += times
    return {k: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for k, v in runs.items()}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids; only the first of several may be shorter."""
    first = n % capacity or capacity if n > capacity else n
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, part, local_rank[, ids]); local_rank counts a length's pieces in the task."""

    def run(batches):
        import pandas as pd
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        enc, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for pdf in batches:
            for lo in range(0, len(pdf), 500):
                chunk = pdf.iloc[lo : lo + 500]
                rows = []
                for doc, raw in zip(chunk["doc_id"], enc.encode(chunk["text"].tolist()), strict=True):
                    raw += end
                    for k, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                        ids = raw[4 * start : 4 * (start + length)]
                        rows.append((None if pd.isna(doc) else int(doc), k, start, length, zlib.crc32(ids), part, int(seen[length]), *([ids] if with_ids else [])))
                        seen[length] += 1
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "local_rank"] + ["ids"] * with_ids)
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local_rank long" + ", ids binary" * with_ids
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(lean(run, encodes=True), schema)


def best_fit_pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Placement of every piece: adds sequence_id and offset to `pieces`' columns.

    A length that a third of all pieces have is spread over tasks: a piece's rank is its rank in its task
    plus the counts of the tasks before, so nothing is sorted or gathered by length.
    """
    spark = docs.sparkSession
    made = store(pieces(docs, tokenizer, end_id, capacity, with_ids), "pieces").df
    counted = made.groupBy("part", "length").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = store(counted.select("part", "length", F.col("count").alias("n"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")), "ranks").df
    counts = np.zeros(capacity + 1, np.int64)
    for row in base.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[row["length"]] = row["n"]
    places = spark.sparkContext.broadcast(slots(plan(counts, capacity)))

    def place(batches):
        for pdf in batches:
            rank = (pdf["base"] + pdf["local_rank"]).to_numpy(np.int64)
            length = pdf["length"].to_numpy(np.int64)
            seq, off = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            for n in np.unique(length):
                ranks, firsts, offsets = places.value[int(n)]
                here = length == n
                run = np.searchsorted(ranks, rank[here], "right") - 1
                seq[here] = firsts[run] + rank[here] - ranks[run]
                off[here] = offsets[run]
            out = pdf.drop(columns=["base", "part", "local_rank"])
            out["sequence_id"], out["offset"] = seq, off
            yield out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids + ", sequence_id long, offset long"
    # as many rows as tasks and lengths: too many to broadcast where there are many tasks
    joined = made.join(base.select("part", "length", "base").hint("shuffle_hash"), ["part", "length"]).select(*made.columns, "base")
    return joined.mapInPandas(lean(place), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed id sequences of a placement made with_ids: sequence_id and ids (uint32 bytes, at most `capacity` ids)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select("sequence_id", F.expr("aggregate(transform(p, x -> x.ids), X'', (a, b) -> a || b)").alias("ids"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0)
