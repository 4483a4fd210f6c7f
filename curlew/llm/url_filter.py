"""Operator 6: explicit url rules, then empirical-Bayes host reputation, in DataFrame functions only.

Pages that a rule decides are labelled outcomes (1: blocked). Their rates are shrunk from level to level: a
suffix towards all pages, a registered domain towards its suffix, a host towards its domain, each by a
beta-binomial prior whose strength is fitted to that level by moments. A page that no rule decides is blocked
if the lower bound of the posterior rate of its host (or of the nearest level that has outcomes) is above
BLOCK_ABOVE.

Registered domain: the last two labels of the host (three where the suffix has two, as a parameter); suffix:
the rest. Nulls: a null url, or one without "://", has empty host and path, fits no rule and has no outcomes at
any level, so it is judged by the rate of all pages. A table without outcomes allows all. Repeated rows count
as often as they occur. Columns other than page_id and url are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.llm._common import left_join, store, table

#: (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
TWO_LABEL_SUFFIXES = ("co.uk", "com.au", "co.jp", "com.br")
BLOCK_ABOVE = 0.5
Z = 1.0
LEVELS = ["suffix", "domain", "host"]


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(pages: DataFrame) -> DataFrame:
    """page_id, host, path; the host keeps a port or user as they are."""
    rest = F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END")
    both = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
    host = F.regexp_extract("rest", r"^[^/?#]*", 0)
    path = F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1)
    return both.select("page_id", lower_ascii(host).alias("host"), path.alias("path"))


def levels(pages: DataFrame) -> DataFrame:
    labels = F.split("host", r"\.")
    last2 = F.array_join(F.slice(labels, -2, 2), ".")
    wide = last2.isin(*TWO_LABEL_SUFFIXES)
    has = F.size(labels) >= 2
    suffix = F.when(~has, F.col("host")).when(wide, last2).otherwise(F.element_at(labels, -1))
    domain = F.when(~has, F.col("host")).when(wide & (F.size(labels) >= 3), F.array_join(F.slice(labels, -3, 3), ".")).otherwise(last2)
    return pages.select("*", suffix.alias("suffix"), domain.alias("domain"))


def apply_rules(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Adds rule and its verdict (null where none fits); the longest rule wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return pages.select("*", rule.alias("rule"), verdict.alias("ruled"))


def reputation(hosts: DataFrame) -> DataFrame:
    """hosts: suffix, domain, host, n, k (labelled outcomes, may be 0) → adds mean and lower, the posterior's bound.

    Each level sums its groups by partial aggregation and is joined to the level above, which is smaller.
    """
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k"))
    up = total.select(((F.col("k") + 0.5) / (F.col("n") + 1.0)).alias("parent_mean"))
    keys: list[str] = []
    for level in LEVELS:
        keys = [*keys, level]
        groups = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        # up: one row for the first level; below, one row a group of the level above
        groups = groups.join(F.broadcast(up)) if level == "suffix" else groups.join(up, keys[:-1])
        mean, n = F.col("parent_mean"), F.col("n")
        rate = F.col("k") / n
        # of groups with outcomes: what lies between them beyond what their sizes explain
        fit = groups.filter("n > 0").agg(F.sum(n * (rate - mean) * (rate - mean)).alias("ss"), F.sum(mean * (1 - mean)).alias("noise"), F.sum(n * mean * (1 - mean)).alias("room"))
        strength = F.coalesce(F.least(F.greatest((F.col("room") - F.col("ss")) / F.greatest(F.col("ss") - F.col("noise"), F.lit(1e-6)), F.lit(1.0)), F.lit(1000.0)), F.lit(1.0))
        a, t = F.col("k") + F.col("s") * mean, n + F.col("s")
        done = groups.join(F.broadcast(fit.select(strength.alias("s")))).select(*keys, (a / t).alias("mean"), t.alias("t"))  # fit: one row
        up = done.select(*keys, F.col("mean").alias("parent_mean"))
    return done.select("host", "mean", (F.col("mean") - Z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("t") + 1))).alias("lower"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict."""
    ruled = store(apply_rules(levels(split_url(pages)), rules), "ruled").df
    hosts = ruled.groupBy("suffix", "domain", "host").agg(F.count("ruled").alias("n"), F.coalesce(F.sum(F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0)), F.lit(0)).alias("k"))
    bad = reputation(store(hosts, "hosts").df).filter(F.col("lower") > BLOCK_ABOVE).select("host", F.lit(True).alias("bad"))
    joined = left_join(ruled, bad, "host")
    verdict = F.coalesce("ruled", F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow")))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def op6_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def _level_sql(keys: str, prev: str, up: str | None, name: str) -> str:
    join = f"JOIN {up} u USING ({prev})" if prev else f"CROSS JOIN {up} u"
    return f"""
{name}_g AS (SELECT x.*, u.mean AS pm FROM (SELECT {keys}, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY {keys}) x {join}),
{name}_f AS (SELECT coalesce(least(greatest((sum(n*pm*(1-pm)) - sum(n*(k/n-pm)*(k/n-pm))) / greatest(sum(n*(k/n-pm)*(k/n-pm)) - sum(pm*(1-pm)), 1e-6), 1.0), 1000.0), 1.0) AS s FROM {name}_g WHERE n > 0),
{name} AS (SELECT {keys}, (k + s*pm)/(n + s) AS mean, n + s AS t FROM {name}_g, {name}_f)"""


def _rules_sql(rules: list[tuple[str, str, str]]) -> tuple[str, str]:
    when = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))]
    return "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in when) + " END", "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in when) + " END"


_RULE, _RULED = _rules_sql(RULES)
_WIDE = ", ".join(f"'{x}'" for x in TWO_LABEL_SUFFIXES)
OP6_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
sp AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
lab AS (SELECT *, string_split(host, '.') AS l FROM sp),
lv AS (SELECT *, CASE WHEN len(l) >= 2 THEN array_to_string(l[-2:], '.') ELSE host END AS last2 FROM lab),
r AS (SELECT page_id, host, path, {_RULE} AS rule, {_RULED} AS ruled,
  CASE WHEN len(l) < 2 THEN host WHEN last2 IN ({_WIDE}) THEN last2 ELSE l[-1] END AS suffix,
  CASE WHEN len(l) < 2 THEN host WHEN last2 IN ({_WIDE}) AND len(l) >= 3 THEN array_to_string(l[-3:], '.') ELSE last2 END AS domain FROM lv),
hosts AS (SELECT suffix, domain, host, count(ruled) AS n, coalesce(sum(CASE WHEN ruled = 'block' THEN 1 WHEN ruled = 'allow' THEN 0 END), 0) AS k FROM r GROUP BY ALL),
top AS (SELECT (coalesce(sum(k), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) AS mean FROM hosts),
{_level_sql("suffix", "", "top", "a")},{_level_sql("suffix, domain", "suffix", "a", "b")},{_level_sql("suffix, domain, host", "suffix, domain", "b", "c")},
bad AS (SELECT host FROM c WHERE mean - {Z} * sqrt(mean * (1 - mean) / (t + 1)) > {BLOCK_ABOVE})
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM r
"""
