"""Operator 10: document quality rules with host-level verdicts, in DataFrame functions only.

Rule failures are counted for each host (here: a document's source); host rates are shrunk by a beta prior
whose mean and strength come from the hosts themselves (method of moments), and a host is rejected where the
lower bound of its posterior failure rate is above `reject_above`. Host verdicts are joined back;
hosts are few beside documents, so the verdicts are broadcast by their size, or else the join splits a hot host.

Nulls: a null text has no words and fails; a null source is a host of its own. A host of few documents stays
near the prior and is kept. Repeated rows count as often as they occur. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.llm._common import SPACE, Temporary, bitmap_filter, fresh, left_join, store, table, text_key

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: A host goes if its failure rate is above this with Z standard deviations of certainty.
REJECT_ABOVE = 0.5
Z = 2.0
SYMBOLS = r"[#*$%&|<>]"


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def repeated_words(window_keys: Column) -> Column:
    """Positions covered by windows whose key occurs twice or more, given all windows' keys in order."""
    n = F.size(window_keys)
    placed = F.sort_array(F.transform(window_keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

    def spread(sorted_keys: Column) -> Column:
        key = lambda j: F.get(sorted_keys, j)["k"]
        again = F.filter(F.transform(sorted_keys, lambda s, j: F.when((s["k"] == key(j - 1)) | (s["k"] == key(j + 1)), s["i"])), lambda i: i.isNotNull())
        starts = F.sort_array(again)
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("covered"), F.lit(-WINDOW).alias("last")),
            lambda acc, i: F.struct((acc["covered"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("covered"), i.alias("last")),
            lambda acc: acc["covered"],
        )

    # most texts repeat no window: they skip the sort
    bound = F.transform(F.array(placed), spread)
    return F.when((n < 2) | (F.size(F.array_distinct(window_keys)) == n), F.lit(0)).otherwise(F.get(bound, F.lit(0))).cast("long")


def measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of `keep` and the base figures of each document, under names that `keep` doesn't have."""
    named = {c: fresh(c, keep) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")}
    text, w, h = fresh("body", keep), fresh("w", keep), fresh("h", keep)
    # the words, then the windows' hashes, are columns of their own so that no expression is evaluated twice
    step = docs.select(*keep, F.coalesce("text", F.lit("")).alias(text))
    step = step.withColumn(w, words(F.col(text)))
    n = F.size(w)
    step = step.withColumn(h, F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(F.col(w), i, WINDOW)))).otherwise(F.array().cast("array<long>")))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.ltrim(F.translate(x, "\t\x0b\x0c\r", "    "))) > 0)
    got = step.select(
        *keep,
        F.size(w).cast("long").alias(named["n_words"]),
        F.length(F.array_join(w, "")).cast("long").alias(named["word_chars"]),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias(named["n_symbols"]),
        F.transform(F.array(lines), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))[0].alias(named["n_dup_lines"]),
        repeated_words(F.col(h)).alias(named["n_repeat_words"]),
    )
    failed = (F.col(named["n_words"]) < MIN_WORDS) | (F.col(named["n_repeat_words"]) * 100 > F.col(named["n_words"]) * MAX_REPEAT_PERCENT)
    return got.withColumn(named["base_failed"], failed)


def host_verdicts(judged: DataFrame, host: str, failed: str, reject_above: float = REJECT_ABOVE, z: float = Z) -> DataFrame:
    """One row a host: n, k, rate (posterior mean), lower (bound) and rejected.

    The prior is Beta(m * s, (1 - m) * s): m is the mean of the hosts' rates, and s follows from how far they
    lie apart beyond what their sizes explain. One host, or hosts that don't differ, give a strong prior.
    """
    hosts = judged.groupBy(host).agg(F.count("*").alias("n"), F.sum(F.col(failed).cast("long")).alias("k"))
    rate = F.col("k") / F.col("n")
    fit = hosts.agg(F.count("*").alias("g"), F.avg(rate).alias("m"), F.var_pop(rate).alias("v"), F.avg(1 / F.col("n")).alias("inv"))
    spread = F.col("m") * (1 - F.col("m"))
    beyond = F.greatest(F.col("v") - spread * F.col("inv"), F.lit(1e-6))
    strength = F.least(F.greatest((spread - F.col("v")) / beyond, F.lit(2.0)), F.lit(1000.0))
    prior = fit.select("m", F.coalesce(strength, F.lit(2.0)).alias("s"))
    # the prior is one row
    both = hosts.join(F.broadcast(prior))
    a, total = F.col("k") + F.col("m") * F.col("s"), F.col("n") + F.col("s")
    mean = a / total
    lower = mean - z * F.sqrt(mean * (1 - mean) / (total + 1))
    return both.select(host, "n", "k", mean.alias("rate"), lower.alias("lower"), (lower > reject_above).alias("rejected"))


def quality_filter(docs: DataFrame, host: str = "source", id_column: str = "doc_id") -> DataFrame:
    """Pipeline form: the documents that neither their own rules nor their host's verdict reject.

    Every document is measured once, for the hosts' counts; of it only keys and the verdict are written, never the
    text. The keys of failed documents then pass as a bitmap of fixed size over the documents, and those it hits are
    measured again, which needs no join. Rejected hosts are joined, sent to all executors where they are few.
    """
    columns = docs.columns
    failed, names, maybe = fresh("base_failed", columns), fresh("rejected_host", columns), fresh("maybe_failed", columns)
    ident, key, own = (fresh(c, [*columns, failed]) for c in ("judged_id", "judged_key", "judged_host"))
    named = docs.select(F.col(id_column).alias(ident), text_key(F.col("text")).alias(key), F.col(host).alias(own), "text")
    with Temporary() as temp:
        judged = measures(named, [ident, key, own])
        made = temp.keep(store(judged.select(ident, key, own, F.col(fresh("base_failed", [ident, key, own])).alias(failed)), "judged"))
        bad = temp.keep(store(host_verdicts(made.df, own, failed).filter("rejected").select(F.col(own).alias(host), F.lit(True).alias(names)), "hosts"))
    keyed = docs.withColumns({ident: F.col(id_column), key: text_key(F.col("text"))})
    flagged = bitmap_filter(keyed, made.df.filter(failed), [ident, key], maybe)
    sure = flagged.filter(~F.col(maybe)).select(*columns)
    # exploding holds the filter above the measures: pushed below, it would evaluate them for every window
    again = measures(flagged.filter(maybe).select(*columns), columns).select(*columns, F.explode(F.array(failed)).alias(maybe))
    stay = sure.unionByName(again.filter(~F.col(maybe)).select(*columns))
    return left_join(stay, bad.df, host).filter(F.col(names).isNull()).select(*columns)


def op10_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = store(measures(docs, ["doc_id", "source"]), "measures").df
    verdicts = host_verdicts(made, "source", "base_failed").select("source", "rejected")
    joined = left_join(made, verdicts, "source")
    kept = ~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


_W = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

OP10_SQL = f"""
WITH d AS (SELECT row_number() OVER () rid, doc_id, source, coalesce(text, '') AS body, {_W} AS w FROM documents),
win AS (
  SELECT rid, i, len(w) AS n, array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ') AS g
  FROM d, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 1))) t(i)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) c FROM win) x WHERE c > 1),
gaps AS (SELECT rid, least({WINDOW}, i - coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), i - {WINDOW})) AS c FROM again),
rep AS (SELECT rid, sum(c) AS r FROM gaps GROUP BY rid),
lin AS (
  SELECT rid, count(*) - count(DISTINCT x) AS dup
  FROM (SELECT rid, unnest(string_split(body, chr(10))) AS x FROM d) y WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
base AS (
  SELECT d.rid, doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (rid) LEFT JOIN lin USING (rid)),
f AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM base),
h AS (SELECT source, count(*) AS n, sum(base_failed::BIGINT) AS k FROM f GROUP BY source),
fit AS (SELECT avg(k / n) AS m, var_pop(k / n) AS v, avg(1 / n) AS inv FROM h),
pri AS (SELECT m, coalesce(least(greatest((m * (1 - m) - v) / greatest(v - m * (1 - m) * inv, 1e-6), 2.0), 1000.0), 2.0) AS s FROM fit),
post AS (SELECT source, (k + m * s) / (n + s) AS rate, n + s AS t FROM h, pri),
bad AS (SELECT source, rate - {Z} * sqrt(rate * (1 - rate) / (t + 1)) > {REJECT_ABOVE} AS rejected FROM post)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND NOT rejected) AS kept
FROM f JOIN bad ON f.source IS NOT DISTINCT FROM bad.source
"""
