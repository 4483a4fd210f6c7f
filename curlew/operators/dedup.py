"""Exact and near duplicates by word-trigram Jaccard, first come first kept.

Scale: exact copies fold by hash before anything is joined. Sets of hashed shingles are made in numpy where they are
needed and never shuffled or stored whole: texts are sent signatures of ranges of their hashes, such that a pair has one
in common, and only texts in a candidate pair get their sets compared. The greedy rule is settled in rounds over the
pair table, which is written out between rounds.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curlew.functions.shingles import bands as minhash_bands
from curlew.functions.shingles import signatures, with_sets
from curlew.functions.text import text_hash
from curlew.sources.scratch import Scratch


#: Under this threshold ranges of hashes get too short to tell texts apart, and the rarest shingles make the candidates.
RANGES = 0.7


def hashed(records: DataFrame, text: Column) -> DataFrame:
    """id, seq, hash and text of each record."""
    return records.select("id", "seq", text_hash(text).alias("hash"), text.alias("text"))


def folded(rows: DataFrame) -> DataFrame:
    """hash, seq, id and text of the first row of each text."""
    first = rows.groupBy("hash").agg(F.min(F.struct("seq", "id", "text")).alias("x"))
    return first.select("hash", "x.*")


def similar_pairs(texts: DataFrame, threshold: float, after: int | None = None) -> DataFrame:
    """(a, b, inter, uni) with seq a < seq b and Jaccard >= threshold, of texts with any shingle; ids are seqs.

    texts: seq and text, without exact copies. after: only pairs with seq b over it.
    """
    if not threshold > 0:
        raise ValueError("the threshold has to be positive")
    if threshold < RANGES:
        met = _rarest(texts, threshold, after)
    else:
        met = _meeting(signatures(texts, F.col("text"), min(threshold, 1.0)), threshold, after)
    return _verified(texts, met, threshold)


def _meeting(signed: DataFrame, threshold: float, after: int | None = None) -> DataFrame:
    """(a, b) of texts with enough signatures in common and sizes that allow the threshold. signed: sig, seq, about."""
    shared = signed.withColumn("k", F.count("*").over(Window.partitionBy("sig"))).filter("k > 1").drop("k")
    shared = Scratch(signed.sparkSession).put(shared).selectExpr("sig", "seq", "shiftright(about, 24) AS n", "shiftright(about, 1) & 8388607 AS need", "about & 1 AS back")
    a, b = shared.toDF("sig", "a", "na", "need_a", "back_a"), shared.toDF("sig", "b", "nb", "need_b", "back_b")
    if after is not None:
        b = b.filter(F.col("b") > after)
    met = a.join(b, "sig").filter((F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.greatest("na", "nb") * threshold - 1e-9) & (F.col("back_a") + F.col("back_b") < 2))
    return met.groupBy("a", "b").agg(F.count("*").alias("k"), F.min(F.least("need_a", "need_b")).alias("need")).filter("k >= need").select("a", "b")


def _rarest(texts: DataFrame, threshold: float, after: int | None) -> DataFrame:
    """(a, b) of texts that share one of their rarest shingles.

    The prefix of a set of n is its n - ceil(t*n) + 1 rarest shingles; the small epsilon keeps products such as
    0.55 * 100 from rounding a place too high.
    """
    keyed = with_sets(texts, F.col("text")).filter(F.size("sh") > 0).select("seq", "sh", F.size("sh").alias("n"))
    each = keyed.select("seq", "n", F.explode("sh").alias("h"))
    often = each.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    keep = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    # shingles of one text only can't make a pair but do take places of the prefix: they come first
    ranked = each.join(often, "h", "left").withColumn("df", F.coalesce("df", F.lit(1)))
    w = Window.partitionBy("seq").orderBy("df", "h")
    prefix = ranked.withColumn("k", F.row_number().over(w)).filter((F.col("k") <= keep) & (F.col("df") > 1))
    return _meeting(prefix.selectExpr("h AS sig", "seq", "shiftleft(cast(n AS long), 24) | 2 AS about"), threshold, after)


def _verified(texts: DataFrame, met: DataFrame, threshold: float) -> DataFrame:
    """(a, b, inter, uni) of the candidates whose sets have Jaccard >= threshold; only their texts are made into sets."""
    scratch = Scratch(texts.sparkSession)
    met = scratch.put(met)
    ids = met.select(F.col("a").alias("seq")).union(met.select("b")).distinct()
    sets = scratch.put(with_sets(texts.select("seq", "text").join(ids, "seq", "left_semi"), F.col("text")))
    both = met.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    inter = F.size(F.array_intersect("sa", "sb")).alias("inter")
    sized = both.select("a", "b", inter, (F.size("sa") + F.size("sb")).alias("total"))
    return sized.select("a", "b", "inter", (F.col("total") - F.col("inter")).alias("uni")).filter(F.col("inter") >= F.col("uni") * threshold - 1e-12)


#: Pairs (two numbers each) that one task settles by itself.
SMALL = 1_000_000


def _settle(batches):
    got = [pdf for pdf in batches if len(pdf)]
    if not got:
        return
    edges = pd.concat(got).sort_values(["b", "a"])
    dropped: set[int] = set()
    for a, b in zip(edges["a"].tolist(), edges["b"].tolist(), strict=True):
        if a not in dropped:
            dropped.add(b)
    nodes = sorted({*edges["a"].tolist(), *edges["b"].tolist()})
    yield pd.DataFrame({"node": nodes, "kept": [x not in dropped for x in nodes]})


def greedy(pairs: DataFrame) -> DataFrame:
    """(node, kept) of every node of a pair: kept unless an earlier kept one is a neighbour.

    Up to SMALL pairs one task settles in order. More go in rounds: a round keeps the nodes without an undecided
    or kept earlier neighbour and drops the neighbours of kept ones.
    """
    scratch = Scratch(pairs.sparkSession)
    edges = scratch.put(pairs.select("a", "b"))
    if edges.count() <= SMALL:
        return edges.coalesce(1).mapInPandas(_settle, "node long, kept boolean")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    done = None
    open_edges, open_nodes = edges, scratch.put(nodes)
    while not open_nodes.isEmpty():
        free = open_nodes.join(open_edges.select(F.col("b").alias("node")).distinct(), "node", "left_anti").withColumn("kept", F.lit(True))
        free = scratch.put(free)
        hit = open_edges.join(free.select(F.col("node").alias("a")), "a", "left_semi").select(F.col("b").alias("node")).distinct().withColumn("kept", F.lit(False))
        new = scratch.put(free.union(hit))
        done = new if done is None else done.union(new)
        gone = new.select("node")
        nodes_before, edges_before = open_nodes, open_edges
        open_nodes = scratch.put(open_nodes.join(gone, "node", "left_anti"))
        # an edge from a dropped node binds no more; one into a decided node is settled
        open_edges = scratch.put(open_edges.join(gone.toDF("a"), "a", "left_anti").join(gone.toDF("b"), "b", "left_anti"))
        scratch.drop(nodes_before, edges_before, free)
    return done if done is not None else nodes.withColumn("kept", F.lit(True))


def _most_similar(pairs: DataFrame, verdict: DataFrame) -> DataFrame:
    """seq, kept_seq, score: of each dropped node the kept neighbour of the highest score, the earliest of equals."""
    scored = pairs.join(verdict.filter("kept").select(F.col("node").alias("a")), "a").join(verdict.filter("NOT kept").select(F.col("node").alias("b")), "b")
    best = scored.groupBy("b").agg(F.max(F.struct((F.col("inter") / F.col("uni")).alias("score"), (-F.col("a")).alias("m"))).alias("x"))
    return best.select(F.col("b").alias("seq"), (-F.col("x.m")).alias("kept_seq"), F.col("x.score").alias("score"))


def _bare(text: Column) -> Column:
    """Whether a text has no token; null for null."""
    return ~F.lower(text).rlike("[a-z0-9]")


def find_duplicates(records: DataFrame, text: Column, threshold: float = 0.85) -> DataFrame:
    """D3: duplicate_id, kept_id, reason, score (unrounded) of every record that isn't kept.

    Records with a blank id are left out. Exact copies name their first kept copy; near ones the kept record of
    the highest score, the earliest of equals. Texts without tokens are all alike: the first stays.
    """
    scratch = Scratch(records.sparkSession)
    rows = hashed(records.filter("trim(id) <> ''"), text)
    first = scratch.put(folded(rows).withColumn("bare", _bare(F.col("text"))))
    rows = scratch.put(rows.drop("text"))
    pairs = scratch.put(similar_pairs(first, threshold))
    verdict = scratch.put(greedy(pairs))
    best = _most_similar(pairs, verdict)
    bare = first.filter("bare")
    least = bare.agg(F.min("seq").alias("kept_seq"))
    best = best.union(bare.join(F.broadcast(least)).filter("seq > kept_seq").select("seq", "kept_seq", F.lit(1.0)))
    names = first.select(F.col("seq").alias("kept_seq"), F.col("id").alias("kept_id"))
    near = best.join(names, "kept_seq").select("seq", "kept_id", "score")
    # copies: of a kept text, exact; of a dropped one, near like it
    all_rows = rows.join(first.select("hash", F.col("seq").alias("first_seq"), F.col("id").alias("first_id")), "hash")
    judged = all_rows.join(near.withColumnRenamed("seq", "first_seq"), "first_seq", "left")
    dup = judged.filter(F.col("kept_id").isNotNull() | (F.col("seq") > F.col("first_seq")))
    return dup.select(F.col("id").alias("duplicate_id"), F.coalesce("kept_id", "first_id").alias("kept_id"), F.when(F.col("kept_id").isNull(), "exact").otherwise("near").alias("reason"), F.coalesce("score", F.lit(1.0)).alias("score"))


def deduplicate(records: DataFrame, text: Column, threshold: float = 0.85, limit: int | None = None) -> DataFrame:
    """Records with duplicates marked; a limit is optional and off by default."""
    if limit is not None:
        records = records.orderBy("seq").limit(limit)
    dups = find_duplicates(records, text, threshold).select(F.col("duplicate_id").alias("id"), F.concat(F.lit("Duplicate of "), "kept_id", F.lit(" ("), "reason", F.lit(")")).alias("_why"))
    out = records.join(dups, "id", "left")
    hit = F.col("_why").isNotNull()
    return out.withColumns({"status": F.when(hit, "deduped").otherwise(F.col("status")), "pipeline_status": F.when(hit, "fail").otherwise(F.col("pipeline_status")), "error_message": F.coalesce("_why", "error_message")}).drop("_why")


def import_duplicates(existing: DataFrame, batch: DataFrame, text: Column, threshold: float = 0.85) -> DataFrame:
    """duplicate_id, kept_id, reason, score of a batch's records against all stored ones and its earlier kept ones.

    Every stored record counts, whether or not it is itself like another; seeded rows of the batch don't take part. An
    exact copy names the last stored record with its text, else the batch's first; a near one the most similar, the
    earliest of equals. A stored record whose id is in the batch is about to be replaced and doesn't count.
    """
    scratch = Scratch(existing.sparkSession)
    new = batch.filter("status <> 'seeded' AND trim(id) <> ''")
    old = existing.filter("trim(id) <> ''").join(batch.select("id"), "id", "left_anti").select("id", "seq", text.alias("_text"))
    top = old.agg(F.coalesce(F.max("seq"), F.lit(-1))).first()[0]
    low = new.agg(F.coalesce(F.min("seq"), F.lit(0))).first()[0]
    every = old.unionByName(new.select("id", (F.col("seq") - low + top + 1).alias("seq"), text.alias("_text")))
    rows = scratch.put(hashed(every, F.col("_text")))
    stored = F.col("seq") <= top
    last = rows.filter(stored).groupBy("hash").agg(F.max_by("id", "seq").alias("last_stored"))
    first = scratch.put(folded(rows).join(last, "hash", "left").withColumn("bare", _bare(F.col("text"))))
    pairs = scratch.put(similar_pairs(first, threshold, after=top))
    # pairs end in a new text, so stored ones are never dropped
    near = _most_similar(pairs, scratch.put(greedy(pairs)))
    bare = first.filter("bare")
    least = bare.agg(F.min("seq").alias("kept_seq"))
    near = near.union(bare.filter(~stored).join(F.broadcast(least)).filter("seq > kept_seq").select("seq", "kept_seq", F.lit(1.0)))
    named = near.join(first.select(F.col("seq").alias("kept_seq"), F.col("id").alias("near_id")), "kept_seq").select(F.col("seq").alias("first_seq"), "near_id", "score")
    own = rows.filter(~stored).join(first.select("hash", F.col("seq").alias("first_seq"), F.col("id").alias("first_id"), "last_stored"), "hash").join(named, "first_seq", "left")
    exact = F.coalesce("last_stored", F.when((F.col("seq") > F.col("first_seq")) & F.col("near_id").isNull(), F.col("first_id")))
    found = own.select(F.col("id").alias("duplicate_id"), F.coalesce(exact, "near_id").alias("kept_id"), F.when(exact.isNotNull(), "exact").otherwise("near").alias("reason"), F.when(exact.isNotNull(), 1.0).otherwise(F.col("score")).alias("score"))
    return found.filter("kept_id IS NOT NULL AND kept_id <> duplicate_id")


def effective(records: DataFrame, text: Column, threshold: float = 0.85) -> DataFrame:
    """Records that aren't duplicates (for A1 and the rest of coverage)."""
    return records.join(find_duplicates(records, text, threshold).select(F.col("duplicate_id").alias("id")), "id", "left_anti")


def representatives(clusters: DataFrame) -> DataFrame:
    """Of each cluster the record of the highest score, then richest context, then earliest.

    clusters: cluster, id, judge_score, context, seq.
    """
    best = F.max_by("id", F.struct(F.coalesce("judge_score", F.lit(-1)), F.length(F.coalesce("context", F.lit(""))), -F.col("seq")))
    return clusters.groupBy("cluster").agg(best.alias("id"))


def minhash_pairs(records: DataFrame, text: Column, threshold: float = 0.85, bands: int = 16, rows: int = 4) -> DataFrame:
    """Near pairs (a, b) by seq of MinHash band candidates, verified exactly; exact copies fold to their first.

    A pair at the threshold shares no band with probability (1 - threshold**rows)**bands: 7e-6 at the defaults.
    """
    first = Scratch(records.sparkSession).put(folded(hashed(records, text)))
    return _verified(first, _meeting(minhash_bands(first, F.col("text"), bands, rows), threshold), threshold).select("a", "b")
