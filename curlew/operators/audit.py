"""Corpus audit checks with numeric rules (Q1 to Q25). Shares are compared as integer ratios of counts.

Each check returns the rows that break its rule (or the figures it is about), so an empty result is a pass.
"""

from __future__ import annotations

import ast

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curlew.functions.text import shingles_of, strip, tokens
from curlew.operators.validate import PLACEHOLDER, refusal
from curlew.sources.scratch import Scratch

SHAPES = {"json": r"^\s*[\[{]", "list": r"(?m)^\s*(?:[-*]|\d+[.)])\s", "code": r"```|(?m)^\s*(?:def|class|SELECT|import)\b", "multi_paragraph": r"\n"}
OPENINGS = r"^(?i)(?:sure|certainly|of course|great question|as an|in this|here is|here are)\b"
CLOSINGS = r"(?i)(?:hope this helps|let me know if|in conclusion|feel free to ask)[^\n]{0,40}$"
MARKERS = (r"(?i)\bin conclusion\b", r"(?i)\bit is important to note\b", r"(?i)\bdelve\b", r"(?i)\bfurthermore\b", r"(?i)\boverall\b")


def duplicate_rate(n_records: Column, n_effective: Column, percent: int = 10) -> Column:
    """Q1: more than `percent` % duplicates."""
    return (n_records - n_effective) * 100 > n_records * percent


def over_share(df: DataFrame, field: Column, percent: int, name: str) -> DataFrame:
    """Q2, Q10, Q14, Q18: buckets that hold more than `percent` % of the records."""
    counts = df.groupBy(field.alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # one row
    return counts.join(F.broadcast(total)).filter(F.col("n") * 100 > F.col("total") * percent).select(F.lit(name).alias("field"), "value", "n", "total")


def under_share(df: DataFrame, field: Column, percent: int, name: str) -> DataFrame:
    """Q14, Q18: buckets under `percent` %."""
    counts = df.groupBy(field.alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).filter(F.col("n") * 100 < F.col("total") * percent).select(F.lit(name).alias("field"), "value", "n", "total")


def sparse_buckets(df: DataFrame, field: Column, expected: DataFrame, least: int = 3) -> DataFrame:
    """Q4: expected buckets (column value) with none or fewer than `least` records."""
    counts = df.groupBy(field.alias("value")).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return expected.join(counts, "value", "left").filter(n < least).select("value", n.alias("n"), F.when(n == 0, "zero").otherwise("sparse").alias("finding"))


def top_buckets(df: DataFrame, field: Column, most: int = 3) -> DataFrame:
    """Q4: the `most` largest buckets, ties by value: (value, n)."""
    return df.groupBy(field.alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(most)


def common_words(df: DataFrame, text: Column, at_most: int) -> DataFrame:
    """Words in at most `at_most` records: what Q5 calls decisive ones is our reading of the rule."""
    each = df.select(F.explode(F.array_distinct(tokens(text))).alias("word"))
    return each.groupBy("word").agg(F.count("*").alias("df")).filter(F.col("df") <= at_most)


def context_leakage(df: DataFrame, context: Column, answer: Column, at_most: int = 2, hits: int = 2) -> DataFrame:
    """Q5: (id, n) of records whose context holds more than `hits` rare words of the answer."""
    pairs = df.select("id", F.explode(F.array_intersect(tokens(context), tokens(answer))).alias("word"))
    rare = common_words(df, answer, at_most)
    return pairs.join(rare, "word").groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") > hits)


def leakage_rate(df: DataFrame, leaking: DataFrame, percent: int = 15) -> DataFrame:
    """Q5: (total, n, severity): high where over `percent` % of all records leak."""
    both = df.agg(F.count("*").alias("total")).join(F.broadcast(leaking.agg(F.count("*").alias("n"))))
    return both.select("total", "n", F.when(F.col("n") * 100 > F.col("total") * percent, "high").when(F.col("n") > 0, "low").otherwise("pass").alias("severity"))


def shape(text: Column) -> Column:
    """Q6, Q15, Q25: a response's outer shape, the first that fits."""
    out = F.lit("prose")
    for name in reversed(list(SHAPES)):
        out = F.when(text.rlike(SHAPES[name]), name).otherwise(out)
    return out


def opening(text: Column, words: int = 3) -> Column:
    return F.array_join(F.slice(tokens(text), 1, words), " ")


def in_stretches(df: DataFrame, group: str) -> DataFrame:
    """Rows with _part: stretches, in order of (group, seq), that each fit a task however large a group is."""
    return df.repartitionByRange(group, "seq").withColumn("_part", F.spark_partition_id())


def repeated_openings(df: DataFrame, key: Column, most: int = 3, group: str = "source") -> DataFrame:
    """Q6: runs of more than `most` records in a row (by seq, within a group) that open alike: gaps and islands.

    Islands are found in stretches of a group; those at a stretch's edges, two at most, are then joined in order.
    """
    rows = in_stretches(df.select(group, "seq", key.alias("opening")), group)
    order = Window.partitionBy("_part", group).orderBy("seq")
    whole = Window.partitionBy("_part", group)
    island = F.row_number().over(order) - F.row_number().over(Window.partitionBy("_part", group, "opening").orderBy("seq"))
    marked = rows.withColumn("island", island).withColumns({"low": F.min("seq").over(whole), "high": F.max("seq").over(whole)})
    runs = marked.groupBy("_part", group, "opening", "island").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"), (F.min("seq") == F.first("low")).alias("opens"), (F.max("seq") == F.first("high")).alias("ends"))
    runs = Scratch(df.sparkSession).put(runs.drop("island"))
    inner = runs.filter("NOT opens AND NOT ends").select(group, "opening", "n", "first_seq")
    edge = Window.partitionBy(group).orderBy("_part", "first_seq")
    goes_on = F.lag("opening").over(edge).eqNullSafe(F.col("opening")) & F.lag("ends").over(edge) & F.col("opens")
    joined = runs.filter("opens OR ends").withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("new").over(edge))
    joined = joined.groupBy(group, "run").agg(F.first("opening").alias("opening"), F.sum("n").alias("n"), F.min("first_seq").alias("first_seq"))
    return inner.unionByName(joined.drop("run")).filter(F.col("n") > most)


def quantity(df: DataFrame, minima: DataFrame) -> DataFrame:
    """Q7: (task, n, minimum) of tasks under their minimum; minima: task, minimum."""
    counts = df.groupBy(F.col("task_type").alias("task")).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return minima.join(counts, "task", "left").filter(n < F.col("minimum")).select("task", n.alias("n"), "minimum")


def pair_cells(df: DataFrame, axes: list[str], percent: int = 30) -> DataFrame:
    """Q8: cells of any two axes that hold over `percent` %: one pass of grouping sets."""
    pairs = [(a, b) for k, a in enumerate(axes) for b in axes[k + 1 :]]
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(f"{a} x {b}").alias("axes"), F.concat_ws("::", a, b).alias("cell")) for a, b in pairs])).alias("c"))
    counts = cells.groupBy("c.axes", "c.cell").agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    return counts.join(F.broadcast(total)).filter(F.col("n") * 100 > F.col("total") * percent).select("axes", "cell", "n", "total")


def variation(df: DataFrame, group: Column, number: Column) -> DataFrame:
    """Q8, Q9, Q15: (value, n, s1, s2) per group: variation below v means n*s2 - s1² < (v*s1)², all in integers."""
    x = number.cast("decimal(38,0)")
    return df.groupBy(group.alias("value")).agg(F.count("*").alias("n"), F.sum(x).alias("s1"), F.sum((number.cast("long") * number).cast("decimal(38,0)")).alias("s2"))


def low_variation(df: DataFrame, group: Column, number: Column, percent: int = 20) -> DataFrame:
    v = variation(df, group, number)
    return v.filter((F.col("n") * F.col("s2") - F.col("s1") * F.col("s1")) * 10_000 < F.col("s1") * F.col("s1") * percent * percent).select("value", "n", F.col("s1").cast("long").alias("total"))


def unsorted_steps(df: DataFrame, number: Column, group: str = "source") -> DataFrame:
    """Q8: per group, how many neighbours (by seq) ascend: a sorted corpus ascends nearly always.

    Steps are counted in stretches of a group, then those from a stretch to the next.
    """
    rows = in_stretches(df.select(group, "seq", number.alias("x")), group)
    rows = rows.withColumn("before", F.lag("x").over(Window.partitionBy("_part", group).orderBy("seq")))
    up = F.count_if(F.col("before").isNotNull() & (F.col("x") >= F.col("before")))
    part = rows.groupBy("_part", group).agg(F.count("before").alias("steps"), up.alias("ascending"), F.min_by("x", "seq").alias("first"), F.max_by("x", "seq").alias("last"))
    over = F.lag("last").over(Window.partitionBy(group).orderBy("_part"))  # a row a stretch
    part = part.withColumn("from", over).withColumns({"steps": F.col("steps") + F.when(F.col("from").isNotNull(), 1).otherwise(0), "ascending": F.col("ascending") + F.when(F.col("first") >= F.col("from"), 1).otherwise(0)})
    return part.groupBy(group).agg(F.sum("steps").alias("steps"), F.sum("ascending").alias("ascending")).filter("steps > 0")


def lengths(df: DataFrame, group: Column, text: Column) -> DataFrame:
    """Q9: (value, n, median_chars) by nearest lower rank, to hold against the limits of direct and reasoned answers."""
    rows = df.select(group.alias("value"), F.length(text).alias("len"))
    return rows.groupBy("value").agg(F.count("*").alias("n"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY len)").cast("long").alias("median_chars"))


def balance(df: DataFrame, label: Column) -> DataFrame:
    """Q10: (value, n, total, severity): over 75 % high, from 60 % medium."""
    found = over_share(df, label, 0, "label")
    share = F.col("n") * 100
    return found.select("value", "n", "total", F.when(share > F.col("total") * 75, "high").when(share >= F.col("total") * 60, "medium").otherwise("ok").alias("severity"))


def fingerprint(text: Column) -> Column:
    """Q11: how many markers of synthetic text it has; sentences of equal length count as one more."""
    sizes = F.transform(F.filter(F.split(text, r"[.!?]+"), lambda s: F.trim(s) != ""), lambda s: F.size(tokens(s)))
    even = F.when((F.size(sizes) >= 3) & (F.array_max(sizes) - F.array_min(sizes) <= 2), 1).otherwise(0)
    hits = even
    for m in MARKERS:
        hits = hits + F.when(text.rlike(m), 1).otherwise(0)
    return hits


def grounding(df: DataFrame, grounded: Column, group: Column) -> DataFrame:
    """Q12: (value, n, n_grounded, severity): under 40 % medium, to 60 % low."""
    g = df.groupBy(group.alias("value")).agg(F.count("*").alias("n"), F.count_if(grounded).alias("n_grounded"))
    share = F.col("n_grounded") * 100
    return g.withColumn("severity", F.when(share < F.col("n") * 40, "medium").when(share <= F.col("n") * 60, "low").otherwise("ok"))


def findings(*parts: tuple[str, str, DataFrame]) -> DataFrame:
    """Q13: (check, severity, n) over checks' results: one row each, empty checks included."""
    out = None
    for name, severity, df in parts:
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), F.when(F.col("n") > 0, severity).otherwise("pass").alias("severity"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def too_short(df: DataFrame, text: Column, intent: Column, minima: dict[str, int], default: int = 10) -> DataFrame:
    """Q16: (id, intent, n_words) under the intent's least number of words."""
    least = F.lit(default)
    for name, n in minima.items():
        least = F.when(intent == name, n).otherwise(least)
    words = F.size(tokens(text))
    return df.select("id", intent.alias("intent"), words.cast("long").alias("n_words"), least.alias("least")).filter("n_words < least").select("id", "intent", "n_words")


def closed(text: Column) -> Column:
    """Whether SQL text closes its string literals and matches its parentheses outside of them."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"'(?:[^']|'')*+'", "")
    steps = F.transform(F.regexp_extract_all(bare, F.lit("[()]"), F.lit(0)), lambda p: F.when(p == "(", 1).otherwise(-1))
    # depth, and the lowest it has been
    walk = F.aggregate(steps, F.struct(F.lit(0).alias("d"), F.lit(0).alias("low")), lambda a, x: F.struct((a["d"] + x).alias("d"), F.least(a["low"], a["d"] + x).alias("low")))
    return ~F.contains(bare, F.lit("'")) & (walk["d"] == 0) & (walk["low"] == 0)


def quoted(text: Column) -> Column:
    """Whether shell text closes its quotes and has no empty expansion."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?s)'[^']*+'|\"(?:[^\"\\]|\\.)*+\"|\\.", "")
    return ~bare.rlike("['\"]") & ~F.coalesce(text, F.lit("")).rlike(r"\$\{\s*\}|\$\(\s*\)")


def parses(text: Column, kind: Column) -> Column:
    """Q17: whether code of the kind (python, json, sql, shell) parses; other kinds count as parsing. Only Python code needs Python."""

    @F.pandas_udf("boolean")
    def python_ok(s: pd.Series) -> pd.Series:
        def one(t):
            try:
                ast.parse(t or "")
            except (SyntaxError, ValueError):
                return False
            return True

        return s.map(one).astype(bool)

    return F.when(kind == "json", F.try_parse_json(text).isNotNull()).when(kind == "python", python_ok(text)).when(kind == "sql", closed(text)).when(kind == "shell", quoted(text)).otherwise(F.lit(True))


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 8) -> DataFrame:
    """Q19: (id, item_id, n_shared) of records that share word n-grams with a benchmark item; our reading of the rule.

    Both sides are dealt by n-gram: neither has to fit a task.
    """
    grams = lambda c: F.explode(shingles_of(tokens(c), n)).alias("g")
    a, b = docs.select("id", grams(F.col("text"))), benchmark.select("item_id", grams(F.col("text")))
    return a.join(b, "g").groupBy("id", "item_id").agg(F.count("*").alias("n_shared"))


def tropes(text: Column) -> Column:
    """Q20: opening, closing, both or null."""
    a, b = text.rlike(OPENINGS), text.rlike(CLOSINGS)
    return F.when(a & b, "both").when(a, "opening").when(b, "closing")


def slots(df: DataFrame, axes: dict[str, list[str]], enough: int = 5) -> DataFrame:
    """Q21: every cell of a small literal matrix with its count and priority: empty, open or low."""
    rows = [()]
    for values in axes.values():
        rows = [(*r, v) for r in rows for v in values]
    grid = df.sparkSession.createDataFrame(rows, ", ".join(f"{a} string" for a in axes))
    counts = df.groupBy(*axes).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return grid.join(counts, list(axes), "left").select(*axes, n.alias("n"), F.when(n == 0, "empty").when(n >= enough, "low").otherwise("open").alias("priority"))


def verdict(score: Column, underrepresented: Column) -> Column:
    """Q22: pass from 4 (3 if its bucket is short of records), fail to 2, else rewrite."""
    return F.when(score >= 4, "pass").when((score == 3) & underrepresented, "pass").when(score <= 2, "fail").when(score.isNotNull(), "rewrite")


#: Words of texts in a block of a topic; blocks of a topic meet two by two.
BLOCK_WORDS = 1_000_000
#: Cells of the counts of one strip of a block against the other, and meetings counted at once.
CELLS, MEETINGS = 1 << 20, 1 << 23


def _alike(left: list[np.ndarray], right: list[np.ndarray] | None, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of pairs of sets with low <= Jaccard < high, across two lists or, without a second, within one.

    The prefix of a set of n is its n - ceil(low * n) + 1 rarest members. Counts of common prefix members leave few
    pairs: members that two sets share outside of both prefixes all lie past the prefix of one of them.
    """
    sets = left + (right or [])
    size = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    _, code, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.lexsort((code, often[code], owner))
    code, owner = code[order], owner[order]
    past = np.ceil(size * low - 1e-9).astype(np.int64) - 1
    start = np.cumsum(size) - size
    use = (np.arange(len(code)) - start[owner] < (size - past)[owner]) & (often[code] > 1)
    first, n_left = (0 if right is None else len(left)), len(left)
    mine, theirs = use & (owner < n_left), use & (owner >= first)
    by_code = np.argsort(code[theirs], kind="stable")
    there, met = owner[theirs][by_code] - first, code[theirs][by_code]
    here, wanted = owner[mine], code[mine]
    lo = np.searchsorted(met, wanted, "left")
    reps = np.searchsorted(met, wanted, "right") - lo
    n_right = len(sets) - first
    strip_rows = max(1, CELLS // n_right)
    out_a, out_b = [], []
    for top in range(0, n_left, strip_rows):
        rows = min(strip_rows, n_left - top)
        k, end = np.searchsorted(here, [top, top + rows])
        ends = np.cumsum(reps[k:end])
        counts = np.zeros(rows * n_right, np.int64)
        at = 0
        while at < end - k:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + MEETINGS, "right")))
            r = reps[k + at : k + stop]
            place = np.repeat(lo[k + at : k + stop] - np.cumsum(r) + r, r) + np.arange(r.sum())
            counts += np.bincount(np.repeat(here[k + at : k + stop] - top, r) * n_right + there[place], minlength=len(counts))
            at = stop
        cell = np.flatnonzero(counts)
        a, b = cell // n_right + top, cell % n_right + first
        total = size[a] + size[b]
        ok = counts[cell] + np.maximum(past[a], past[b]) >= total * (low / (1 + low)) - 1e-9
        ok &= np.minimum(size[a], size[b]) >= np.maximum(size[a], size[b]) * low - 1e-9
        if right is None:
            ok &= a < b
        out_a.append(a[ok])
        out_b.append(b[ok])
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    inter = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a.tolist(), b.tolist(), strict=True)], np.int64)
    score = inter / np.maximum(size[a] + size[b] - inter, 1)
    keep = (score >= low) & (score < high)
    return a[keep], b[keep]


def contradiction_candidates(df: DataFrame, topic: Column, text: Column, low: float = 0.3, high: float = 0.85) -> DataFrame:
    """Q23: (a, b) by seq: records of one topic that are alike but no duplicates, for a reader to judge.

    Of all pairs within a topic, those with low <= Jaccard < high of their word sets (words by 64-bit hash); low has
    to be positive. Texts of the same words fold to one before anything is compared. Texts without words and null
    topics make no pairs.
    """
    if not low > 0:
        raise ValueError("the lower bound has to be positive")
    scratch = Scratch(df.sparkSession)
    words = df.select("seq", topic.alias("topic"), F.transform(shingles_of(tokens(text), 1), lambda w: F.xxhash64(w)).alias("words")).filter(F.col("topic").isNotNull() & (F.size("words") > 0))
    rows = scratch.put(words.select("seq", "topic", F.array_sort("words").alias("words")).withColumn("key", F.sha2(F.array_join("words", " "), 256)))
    sets = scratch.put(rows.groupBy("topic", "key").agg(F.min("seq").alias("id"), F.min_by("words", "seq").alias("words")))
    blocks = sets.groupBy("topic").agg(F.ceil(F.sum(F.size("words")) / BLOCK_WORDS).alias("blocks"), F.count("*").alias("n")).filter("n > 1").drop("n")
    placed = sets.join(blocks, "topic").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    met = placed.select("topic", "id", "words", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.select("topic", "id", "words", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def pairs_of(group: pd.DataFrame) -> pd.DataFrame:
        one = group["block"] == group["i"]
        a, b = group[one], group[~one]
        if group["i"].iat[0] == group["j"].iat[0]:
            x, y = _alike(list(a["words"]), None, low, high)
            b = a
        elif len(a) and len(b):
            x, y = _alike(list(a["words"]), list(b["words"]), low, high)
            y = y - len(a)
        else:
            return pd.DataFrame({"x": [], "y": []}, dtype="int64")
        return pd.DataFrame({"x": a["id"].to_numpy()[x], "y": b["id"].to_numpy()[y]})

    found = scratch.put(met.groupBy("topic", "i", "j").applyInPandas(pairs_of, "x long, y long"))
    members = rows.join(sets.select("topic", "key", "id"), ["topic", "key"]).select("id", "seq")
    both = found.join(members.toDF("x", "seq_x"), "x").join(members.toDF("y", "seq_y"), "y")
    return both.select(F.least("seq_x", "seq_y").alias("a"), F.greatest("seq_x", "seq_y").alias("b"))


def pair_problems(chosen: Column, rejected: Column) -> Column:
    """Q24: what is wrong with a preference pair: rejected empty, a refusal, a placeholder, equal, or only shorter."""
    c, r = strip(F.coalesce(chosen, F.lit(""))), strip(F.coalesce(rejected, F.lit("")))
    return F.array_compact(F.array(F.when(r == "", "rejected is empty"), F.when(refusal(r).isNotNull(), "rejected is a refusal"), F.when(r.rlike(PLACEHOLDER), "rejected is a placeholder"), F.when(c == r, "both are equal"), F.when((r != "") & (F.length(r) * 4 < F.length(c)) & F.startswith(c, r), "rejected is only shorter")))


def bands(df: DataFrame, value: Column, wanted: DataFrame) -> DataFrame:
    """Q25: (value, n, total, finding) against bands in percent; wanted: value, low, high."""
    counts = df.groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    n = F.coalesce("n", F.lit(0))
    return wanted.join(counts, "value", "left").join(F.broadcast(total)).select("value", n.alias("n"), "total", F.when(n * 100 < F.col("total") * F.col("low"), "under").when(n * 100 > F.col("total") * F.col("high"), "over").otherwise("ok").alias("finding"))
