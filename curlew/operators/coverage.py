"""Coverage of a corpus against a plan (A1 to A19): every measure is one aggregation over the records.

Shares are returned unrounded next to their counts; rounding belongs to the report. Findings are small
DataFrames (a row a bucket), records are aggregated before anything is sorted or collected.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curlew.functions.paths import missing, product, values
from curlew.functions.text import blank, strip, structure
from curlew.plans.plan import MISSING, Plan, strings


def histograms(df: DataFrame, fields: list[str]) -> DataFrame:
    """A3: (field, value, n) of every field in one pass; each item of a list counts."""
    if not fields:
        return df.sparkSession.createDataFrame([], "field string, value string, n long")
    axes = F.array(*[F.struct(F.lit(f).alias("field"), values(df, f).alias("vs")) for f in fields])
    rows = df.select(F.explode(axes).alias("a")).select("a.field", F.explode("a.vs").alias("value"))
    return rows.groupBy("field", "value").agg(F.count("*").alias("n"))


def _rules(spark: SparkSession, spec: dict[str, Any], kind: str) -> DataFrame:
    """A plan's {field: {value: number}} or {field: number} as rows; plans are small."""
    rows = [(f, str(v), float(x)) for f, by in spec.items() if isinstance(by, dict) for v, x in by.items()] if kind == "value" else [(f, None, float(x)) for f, x in spec.items() if not isinstance(x, dict)]
    return spark.createDataFrame(rows, "field string, value string, bound double")


def underrepresented(counts: DataFrame, plan: Plan) -> DataFrame:
    """A4: (field, value, n, minimum, gap) of buckets under their minimum; absent ones count 0."""
    rules = _rules(counts.sparkSession, dict(plan.section("group_minimums")), "value")
    got = rules.join(counts, ["field", "value"], "left")
    n, minimum = F.coalesce("n", F.lit(0)), F.col("bound").cast("long")
    return got.select("field", "value", n.alias("n"), minimum.alias("minimum"), (minimum - n).alias("gap")).filter("gap > 0")


def mode_collapse(counts: DataFrame, total: int, plan: Plan) -> DataFrame:
    """A5: (field, value, n, share, max_share) of buckets over their share; MISSING is exempt."""
    spec = dict(plan.section("max_share_per_group"))
    per_field = _rules(counts.sparkSession, spec, "field").select("field", F.col("bound").alias("max_share"))
    share = F.col("n") / F.lit(max(total, 1))
    out = counts.filter(F.col("value") != MISSING).join(F.broadcast(per_field), "field").select("field", "value", "n", share.alias("share"), "max_share")
    return out.filter("share > max_share")


def missing_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, n_missing, total) of fields that some record lacks."""
    if not fields:
        return df.sparkSession.createDataFrame([], "field string, n_missing long, total long")
    one = df.agg(F.count("*").alias("total"), *[F.count_if(missing(df, f)).alias(f"m{k}") for k, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"m{k}").alias("n_missing")) for k, f in enumerate(fields)])
    return one.select(F.explode(rows).alias("r"), "total").select("r.field", "r.n_missing", "total").filter("n_missing > 0")


def joint_counts(df: DataFrame, fields: list[str]) -> DataFrame:
    """(bucket, n): every combination of the fields' values in a record."""
    return df.select(F.explode(product(df, fields)).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def joint_findings(df: DataFrame, plan: Plan, total: int) -> DataFrame:
    spark = df.sparkSession
    out = []
    for rule in plan.spec.get("joint_group_rules") or []:
        fields = strings(rule.get("fields"))
        if len(fields) < 2:
            continue
        counts = joint_counts(df, fields)
        name = F.lit(str(rule.get("name") or " x ".join(fields)))
        least = spark.createDataFrame([(str(k), int(v)) for k, v in (rule.get("minimums") or {}).items()], "bucket string, minimum long")
        n = F.coalesce("n", F.lit(0))
        none = F.lit(None)
        out.append(least.join(counts, "bucket", "left").filter(n < F.col("minimum")).select(name.alias("rule"), "bucket", n.alias("n"), (F.col("minimum") - n).alias("gap"), none.cast("double").alias("share")))
        if rule.get("max_share") is not None:
            share = F.col("n") / F.lit(max(total, 1))
            out.append(counts.filter(~F.array_contains(F.split("bucket", "::"), MISSING) & (share > float(rule["max_share"]))).select(name.alias("rule"), "bucket", "n", none.cast("long").alias("gap"), share.alias("share")))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], "rule string, bucket string, n long, gap long, share double")


def primary_text() -> Column:
    """A16."""
    pair = F.col("response.format") == "preference_pair"
    return F.coalesce(F.when(pair, F.coalesce(F.nullif(F.col("response.chosen"), F.lit("")), F.col("response.rejected"))).otherwise(F.col("response.text")), F.lit(""))


def nearest_rank(df: DataFrame, number: str, fraction: float) -> DataFrame:
    """The value at rank round-half-even((n - 1) * fraction), as one row `value`; null for no rows.

    Ranks come from a histogram of the numbers, so what is ordered are distinct values, not records.
    """
    counts = df.groupBy(F.col(number).alias("value")).agg(F.count("*").alias("c"))
    total = counts.agg(F.sum("c").alias("n"))
    upto = counts.withColumn("upto", F.sum("c").over(Window.orderBy("value")))
    at = F.bround((F.col("n") - 1) * F.lit(fraction))
    return upto.join(F.broadcast(total)).filter(F.col("upto") > at).agg(F.min("value").alias("value"))


def length_stats(df: DataFrame, over: int = 0) -> DataFrame:
    """N, median (truncated), p90, longest and n_over of primary texts' lengths."""
    lengths = df.select(F.length(primary_text()).alias("len"))
    p90 = nearest_rank(lengths, "len", 0.9).select(F.col("value").alias("p90"))
    one = lengths.agg(F.count("*").alias("n"), F.coalesce(F.expr("percentile(len, 0.5)"), F.lit(0)).cast("long").alias("median_chars"), F.coalesce(F.max("len"), F.lit(0)).alias("max_chars"), F.count_if(F.col("len") > over).alias("n_over"))
    return one.join(F.broadcast(p90)).select("n", "median_chars", F.coalesce("p90", F.lit(0)).alias("p90_chars"), "max_chars", (F.col("n_over") if over else F.lit(0).cast("long")).alias("n_over"))


def structures(df: DataFrame) -> DataFrame:
    """(signature, display, n, first_seq) of responses' recursive JSON shapes."""
    s = df.select("seq", structure(primary_text()).alias("s"))
    return s.groupBy("s.signature").agg(F.min_by("s.display", "seq").alias("display"), F.count("*").alias("n"), F.min("seq").alias("first_seq"))


def prefixes(df: DataFrame, length: int = 48) -> DataFrame:
    """(prefix, display, n, first_seq) of responses' first characters, white space collapsed, lower-cased; blank ones are left out."""
    flat = strip(F.regexp_replace(primary_text(), r"(?U)\s+", " "))
    rows = df.select("seq", F.substring(flat, 1, length).alias("display")).filter("display <> ''").withColumn("prefix", F.lower("display"))
    return rows.groupBy("prefix").agg(F.min_by("display", "seq").alias("display"), F.count("*").alias("n"), F.min("seq").alias("first_seq"))


def top(counts: DataFrame, k: int = 10) -> DataFrame:
    """The k commonest, ties by first appearance."""
    return counts.orderBy(F.desc("n"), "first_seq").limit(k)


def dominant(counts: DataFrame, total: int, max_share: float) -> DataFrame:
    return counts.withColumn("share", F.col("n") / F.lit(max(total, 1))).filter((F.col("share") > max_share) & (F.col("n") > 1))


def provenance(df: DataFrame, plan: Plan) -> DataFrame:
    """N, n_real and n_traceable (real-world records with any reference field)."""
    spec = plan.section("provenance")
    real = strings(spec.get("real_world_values")) or ["real_world"]
    is_real = F.arrays_overlap(values(df, str(spec.get("field", "metadata.source_origin"))), F.array(*[F.lit(x) for x in real]))
    refs = strings(spec.get("reference_fields"))
    traced = reduce(lambda a, b: a | b, [~missing(df, f) for f in refs]) if refs else F.lit(False)
    return df.agg(F.count("*").alias("n"), F.count_if(is_real).alias("n_real"), F.count_if(is_real & traced).alias("n_traceable"))


def distributions(df: DataFrame) -> DataFrame:
    """(field, value, n) of the export card; records without a judge score are left out of that axis."""
    axes = histograms(df, ["task_type", "source_type", "metadata.difficulty", "metadata.persona"])
    scores = df.filter("judge_score IS NOT NULL").groupBy(F.lit("judge_score").alias("field"), F.col("judge_score").cast("string").alias("value")).agg(F.count("*").alias("n"))
    return axes.unionByName(scores)


#: Rows of a kind (for histograms: of a field) in a summary.
CAP = 1000


@dataclass
class Report:
    """The summary lists CAP rows of a kind at most; `left_out` in it says how many more there are, `tables` has all."""

    summary: dict[str, Any]
    recommendations: list[str]
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def complete(self, plan: Plan) -> bool:
        """Nothing is left to fix that blocks; without a plan nothing is ever complete."""
        s = self.summary
        if not plan.spec or s["target_gap"] or any(s[k] for k in ("underrepresented", "mode_collapse", "joint_findings", "missing_required")):
            return False
        return not any(plan.blocking(k) and s["findings"].get(k) for k in ("provenance", "response_length", "response_structure", "response_prefix"))


def report(records: DataFrame, effective: DataFrame, plan: Plan, group_by: list[str] | None = None) -> Report:
    """A1 to A15 as a driver-side summary; only counts per bucket leave the executors, the largest CAP of each field."""
    tables: dict[str, DataFrame] = {}
    left_out: dict[str, int] = {}

    def rows(d: DataFrame, *order, name: str = "", cap: int = CAP) -> list[dict]:
        got = [r.asDict() for r in d.orderBy(*order).limit(cap).collect()]
        if name:
            tables[name] = d
            if len(got) == cap and (more := d.count() - cap):
                left_out[name] = more
        return got

    effective = effective.persist()
    try:
        total, n = records.count(), effective.count()
        fields = plan.group_fields(group_by)
        counts = histograms(effective, fields).persist()
        spec = plan.spec
        under = rows(underrepresented(counts, plan), F.desc("gap"), "field", "value", name="underrepresented")
        collapse = rows(mode_collapse(counts, n, plan), F.desc("share"), "field", "value", name="mode_collapse")
        lacking = rows(missing_fields(effective, plan.required()), F.desc("n_missing"), "field", name="missing_required")
        joint = rows(joint_findings(effective, plan, n), "rule", "bucket", name="joint_findings")
        found: dict[str, list[str]] = {}
        rule = plan.section("response_length")
        stats = length_stats(effective, int(rule.get("over_chars_limit") or 0)).first().asDict()
        if rule.get("max_median_chars") and stats["median_chars"] > rule["max_median_chars"]:
            found.setdefault("response_length", []).append("median")
        if rule.get("over_chars_limit") and n and stats["n_over"] / n > float(rule.get("max_share_over_limit", 1)):
            found.setdefault("response_length", []).append("share over limit")
        for name, counter in (("response_structure", structures), ("response_prefix", lambda d: prefixes(d, int(plan.section("response_prefix").get("prefix_length", 48))))):
            if (limit := plan.section(name).get("max_share")) is not None and rows(dominant(counter(effective), n, float(limit)), F.desc("n"), "first_seq", cap=1):
                found[name] = ["one shape dominates"]
        origin = provenance(effective, plan).first().asDict()
        rule = plan.section("provenance")
        if rule.get("minimum_real_world_share") is not None and (origin["n_real"] / n if n else 0) < float(rule["minimum_real_world_share"]):
            found.setdefault("provenance", []).append("too few real-world records")
        if strings(rule.get("reference_fields")) and origin["n_traceable"] < origin["n_real"]:
            found.setdefault("provenance", []).append("untraceable real-world records")
        gap = None if plan.target is None else max(plan.target - n, 0)
        tables["groups"] = counts
        # a field of very many values leaves the others their place
        largest = counts.withColumn("k", F.row_number().over(Window.partitionBy("field").orderBy(F.desc("n"), "value"))).filter(F.col("k") <= CAP).drop("k")
        groups = [r.asDict() for r in largest.orderBy("field", F.desc("n"), "value").collect()]
        if more := counts.count() - len(groups):
            left_out["groups"] = more
        summary = {"records": total, "effective_count": n, "duplicate_count": total - n, "duplicate_rate": round((total - n) / total, 4) if total else 0.0, "target_gap": gap, "groups": groups, "left_out": left_out, "underrepresented": under, "mode_collapse": collapse, "missing_required": lacking, "joint_findings": joint, "response_length": stats, "provenance": origin, "findings": found}
    finally:
        effective.unpersist()
    return Report(summary, recommendations(summary), tables)


def recommendations(s: dict[str, Any]) -> list[str]:
    """Fixed order, capped for reading."""
    out = [f"Add {s['target_gap']} more effective records."] if s["target_gap"] else []
    out += [f"Collect {r['gap']} more for {r['field']} = {r['value']}." for r in s["underrepresented"][:10]]
    out += [f"Rebalance {r['field']}: {r['value']} holds {r['share']:.1%}." for r in s["mode_collapse"][:5]]
    out += [f"Fill {r['field']}: missing in {r['n_missing']} records." for r in s["missing_required"][:10]]
    out += [f"Joint bucket {r['bucket']} breaks {r['rule']}." for r in s["joint_findings"][:5]]
    return out + [f"{name}: {what}." for name, whats in s["findings"].items() for what in whats[:5]]


def blank_share(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.count_if(blank(F.col(column))).alias("n_blank"))
