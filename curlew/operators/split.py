"""Cluster keys and group-disjoint train/test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.functions.paths import at, truthy
from curlew.functions.text import word_key
from curlew.sources.scratch import Scratch

KEYS = ("scenario", "topic", "intent", "subtopic", "fingerprint")
#: Clusters listed on the driver at once, and hex digits of the hash that name a bucket of clusters.
FOLD = 200_000
DIGITS = 4


def cluster_key(df: DataFrame) -> Column:
    """The first metadata key present, else the instruction's first six words."""
    return F.coalesce(*[F.when(truthy(at(df, f"metadata.{k}")), at(df, f"metadata.{k}")) for k in KEYS], word_key(F.col("instruction")))


def fold(sizes: list[tuple[str, int]], target: int, taken: int) -> tuple[list[str], int]:
    """(clusters, sum) that join the test side after `taken` records, in order, while it is short of the target.

    One that brings it over 1.5 times the target is passed over, but not while the test side is empty.
    """
    out = []
    for key, n in sizes:
        if taken >= target:
            break
        if not taken or taken + n <= target * 1.5:
            out.append(key)
            taken += n
    return out, taken


def choose(sizes: list[tuple[str, int]], total: int, ratio: float) -> list[str]:
    """The test clusters of all, in the given order."""
    return fold(sizes, max(1, int(total * ratio)), 0)[0]


def chosen_clusters(sizes: DataFrame, total: int, ratio: float) -> DataFrame:
    """The _key of what choose() takes of any number of clusters (_key, n, h) in the order of h.

    A cluster of up to half the target always fits while the test side is short of it. So buckets of the hash that
    hold no larger one are taken whole by their sums; only buckets with one, and that where the target is met, are
    listed, up to FOLD clusters at a time.
    """
    spark = sizes.sparkSession
    scratch = Scratch(spark)
    target = max(1, int(total * ratio))
    bucket = F.coalesce(F.conv(F.substring("h", 1, DIGITS), 16, 10).cast("int"), F.lit(0))
    sizes = scratch.put(sizes.withColumn("bucket", bucket))
    rows = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.count("*").alias("clusters")).orderBy("bucket").collect()  # at most 16 ** DIGITS rows
    schema = "_key string"
    out, taken, k = spark.createDataFrame([], schema), 0, 0
    while k < len(rows) and taken < target:
        first = k
        while k < len(rows) and rows[k]["most"] * 2 <= target and taken + rows[k]["n"] < target:
            taken += rows[k]["n"]
            k += 1
        if k > first:
            out = out.union(sizes.filter(F.col("bucket").between(rows[first]["bucket"], rows[k - 1]["bucket"])).select("_key"))
        if k == len(rows):
            break
        first, listed = k, 0
        while k < len(rows) and (k == first or listed + rows[k]["clusters"] <= FOLD):
            listed += rows[k]["clusters"]
            k += 1
        part = sizes.filter(F.col("bucket").between(rows[first]["bucket"], rows[k - 1]["bucket"])).orderBy("h", "_key")
        keys, taken = fold([(r["_key"], r["n"]) for r in part.select("_key", "n").collect()], target, taken)
        if keys:
            out = out.union(scratch.put(spark.createDataFrame([(x,) for x in keys], schema)))
    return out


def split(df: DataFrame, ratio: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test), no cluster in both. Clusters are ordered by a seeded hash.

    The test side is what choose() takes of all clusters in that order, however many there are.
    """
    keyed = df.withColumn("_key", cluster_key(df))
    total = df.count()
    empty = df.limit(0)
    if ratio <= 0 or total < 2:
        return df, empty
    sizes = keyed.groupBy("_key").agg(F.count("*").alias("n")).withColumn("h", F.sha2(F.concat("_key", F.lit(str(seed))), 256))
    test_keys = chosen_clusters(sizes, total, ratio).toDF("_test")
    same = F.col("_key").eqNullSafe(F.col("_test"))
    test = keyed.join(test_keys, same, "left_semi").drop("_key")
    train = keyed.join(test_keys, same, "left_anti").drop("_key")
    order = lambda d: d.orderBy(F.sha2(F.concat("id", F.lit(str(seed))), 256), "id")
    return order(train), order(test)


def shared_keys(train: DataFrame, test: DataFrame) -> DataFrame:
    """Q3: cluster keys on both sides; has to be empty."""
    return train.select(cluster_key(train).alias("key")).intersect(test.select(cluster_key(test).alias("key")))
