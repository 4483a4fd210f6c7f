"""Operator 7: minimax contiguous partition of ordered atomic groups into shards.

Rows of equal texts form an atomic group; groups are ordered by their smallest doc_id. The smallest capacity
for which a greedy fill needs no more shards than given is found by binary search over prefix sums of the
group sizes, and the order is cut there. The driver never sees all groups: it works on the first and last
prefix sum of a bounded number of stretches, which bound the greedy cuts from both sides, and asks for finer
stretches only where a cut may fall, until the capacity is exact.

Nulls: a null text is a text of its own kind (no bytes, crc of nothing), all such rows form one group; a null
doc_id sorts first. Repeated rows stay in their group. Empty tables give empty results. Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curlew.llm._common import left_join, shuffle_partitions, store, table

STRETCHES = 4096
OVERHEAD = 16


class Prefixes:
    """What is known of the increasing sequence of group ends: single values, and gaps that may hide more."""

    def __init__(self, total: int):
        self.points = [0, total] if total else [0]
        self.gaps: list[tuple[int, int]] = [(0, total)] if total else []

    def refine(self, gaps: list[tuple[int, int]], stretches: list[tuple[int, int, int]]) -> None:
        """gaps give way to (first, last, values) of the stretches found inside."""
        gone = set(gaps)
        points, kept = set(self.points), [g for g in self.gaps if g not in gone]
        for first, last, n in stretches:
            points |= {first, last}
            if n > 2:
                kept.append((first, last))
        self.points, self.gaps = sorted(points), sorted(kept)

    def gap_at(self, x: int) -> tuple[int, int] | None:
        k = bisect_right(self.gaps, (x, float("inf"))) - 1
        return self.gaps[k] if k >= 0 and self.gaps[k][0] < x < self.gaps[k][1] else None

    def last_upto(self, x: int) -> tuple[int, int]:
        """Bounds of the last group end that is at most x."""
        low = self.points[bisect_right(self.points, x) - 1]
        return low, x if self.gap_at(x) else low


def greedy(known: Prefixes, capacity: int, shards: int, sure: bool) -> tuple[list[int], bool]:
    """Cuts of a greedy fill; sure: every cut is placed as early as it may fall, else as late."""
    total, at, cuts = known.points[-1], 0, []
    for _ in range(shards):
        if at >= total:
            break
        at = known.last_upto(min(total, at + capacity))[0 if sure else 1]
        cuts.append(at)
    return cuts, at >= total


def minimax(ends: DataFrame, total: int, largest: int, shards: int, stretches: int = STRETCHES) -> list[int]:
    """The cuts (ends of shards) for the smallest capacity; ends: a DataFrame with one column `end`, a row a group."""
    known = Prefixes(total)
    low, high = max(largest, -(-total // shards)) - 1, total  # infeasible, feasible
    ask = list(known.gaps)
    while ask:
        width = max(1, sum(b - a for a, b in ask) // stretches)
        # gaps are few and bounded by `stretches`; each is cut into stretches of the width
        cases = ends.sparkSession.createDataFrame(ask, "a long, b long")
        inside = ends.join(F.broadcast(cases), (F.col("end") > F.col("a")) & (F.col("end") < F.col("b"))) if len(ask) > 1 or ask[0] != (0, total) else ends.filter(F.col("end") < total).select("end", F.lit(0).alias("a"), F.lit(total).alias("b"))
        got = inside.groupBy("a", F.floor((F.col("end") - F.col("a")) / F.lit(width)).alias("k")).agg(F.min("end").alias("first"), F.max("end").alias("last"), F.count("*").alias("n")).collect()
        known.refine(ask, [(r["first"], r["last"], r["n"]) for r in got])
        # feasible if it is with early cuts, infeasible if it isn't with late ones
        lo, hi = low, high
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if greedy(known, mid, shards, True)[1] else (mid, hi)
        high = hi
        lo, hi = low, high
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if not greedy(known, mid, shards, False)[1] else (lo, mid)
        low = lo
        ask = []
        if high - low > 1 or greedy(known, high, shards, True)[0] != greedy(known, high, shards, False)[0]:
            early, late = greedy(known, low + 1, shards, True)[0], greedy(known, high, shards, False)[0]
            span = [(early[k] if k < len(early) else early[-1], late[k] if k < len(late) else total) for k in range(max(len(early), len(late)))]
            for a, b in span:
                i = bisect_left(known.gaps, (a, a)) - 1
                for gap in known.gaps[max(i, 0) :]:
                    if gap[0] >= b:
                        break
                    if gap[1] > a:
                        ask.append(gap)
            ask = sorted(set(ask))
    return greedy(known, high, shards, True)[0]


def minimax_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: every row, cut where the minimax capacity says."""
    spark = docs.sparkSession
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.when(F.col("text").isNotNull(), F.unhex(F.md5(raw))).alias("gid"))
    rows = store(rows, "sizes").df
    # A group has one row here however often its text is repeated: only that row's key is joined back.
    groups = rows.groupBy("gid").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("group_size"))
    ordered = left_join(rows, groups, "gid").repartitionByRange(shuffle_partitions(spark), "first_id", "gid", "doc_id", "text_crc32").sortWithinPartitions("first_id", "gid", "doc_id", "text_crc32")

    def number(batches):
        from pyspark import TaskContext

        part, count, upto = TaskContext.get().partitionId(), 0, 0
        for pdf in batches:
            pdf["part"], pdf["row"] = part, range(count, count + len(pdf))
            pdf["row_end"] = upto + pdf["size"].cumsum()
            if len(pdf):
                count, upto = count + len(pdf), int(pdf["row_end"].iloc[-1])
            yield pdf[["doc_id", "size", "text_crc32", "gid", "group_size", "part", "row", "row_end"]].astype({"doc_id": "Int64"})

    numbered = store(ordered.mapInPandas(number, "doc_id long, size long, text_crc32 long, gid binary, group_size long, part int, row long, row_end long"), "ordered").df
    parts = numbered.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s0"))  # a row a task
    placed = numbered.join(F.broadcast(base), "part").select("doc_id", "size", "text_crc32", "gid", "group_size", (F.col("row") + F.col("n0")).alias("row"), (F.col("row_end") + F.col("s0")).alias("end"))
    ends = store(placed.groupBy("gid").agg(F.max("end").alias("end"), F.max("group_size").alias("group_size")), "ends").df
    total, largest = ends.agg(F.max("end"), F.max("group_size")).first()
    if total is None:
        return placed.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.col("row").alias("slot"))
    cuts = minimax(ends.select("end"), total, largest, shards)
    inner = F.array(*[F.lit(c).cast("long") for c in cuts[:-1]]) if len(cuts) > 1 else F.array().cast("array<long>")
    sharded = placed.withColumn("shard", F.size(F.filter(inner, lambda c: c < F.col("end"))))
    first = sharded.groupBy("shard").agg(F.min("row").alias("first_row"))  # a row a shard
    return sharded.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot"))


def op7_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = minimax_shards(table(spark, sf_dir, "documents"), 40)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
