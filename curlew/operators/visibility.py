"""Removal and redaction of answer-bearing prompt content (E7 to E16), as array expressions over lines."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.functions.paths import at
from curlew.functions.text import strip
from curlew.plans.plan import Plan, strings

REPLACEMENT = "[redacted]"
#: Response fields that automatic rules leave alone.
EXCLUDED = ("confidence", "reason", "rationale", "reasoning", "explanation", "evidence", "next_step", "next_steps", "summary", "details", "note", "notes", "fix", "fixes", "mitigation", "mitigations", "recommendation", "recommendations", "action", "actions")
_AUTO = {"min_hits": 2, "exclude_fields": sorted(EXCLUDED)}
#: The rules that hold where a plan gives none.
DEFAULT = {
    "instruction": {"remove_line_prefixes": ["Trace fingerprint:", "Case fingerprint:", "Focus parameter:", "Candidate ", "Analysis note:"], "auto_remove_lines_with_response_fields": _AUTO},
    "context": {"remove_line_prefixes": ["Trace fingerprint:", "Case fingerprint:", "Focus parameter:", "Candidate ", "Validation lens:", "Triage lens:", "Analysis note:"], "auto_remove_lines_with_response_fields": _AUTO},
}
_BREAK = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85  ]"


def mode(plan: Plan) -> tuple[Mapping[str, Any], str]:
    """The rules in force and their mode."""
    given = plan.spec.get("model_visibility")
    if given is None:
        return DEFAULT, "default_loose"
    if not isinstance(given, Mapping) or given.get("enabled") is False:
        return {}, "disabled"
    return given, "configured"


def scalars(value: Any) -> list[str]:
    """All scalars of a JSON value as stripped strings, in order."""
    if value is None:
        return []
    if isinstance(value, Mapping):
        return [s for v in value.values() for s in scalars(v)]
    if isinstance(value, list):
        return [s for v in value for s in scalars(v)]
    text = str(value).strip()
    return [text] if text else []


def unique(items: list[str]) -> list[str]:
    seen: dict[str, str] = {}
    for s in items:
        seen.setdefault(s.lower(), s)
    return list(seen.values())


def response_values(text: str | None, exclude: set[str]) -> list[str]:
    """Distinct scalars of a JSON object response, except under excluded keys."""
    try:
        value = json.loads(text or "")
    except ValueError:
        return []
    if not isinstance(value, dict):
        return []
    return unique([s for k, v in value.items() if str(k).strip().lower() not in exclude for s in scalars(v)])


def auto_values(text: Column, exclude: list[str]) -> Column:
    dropped = {x.lower() for x in exclude} or set(EXCLUDED)

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: response_values(t, dropped))

    return run(text)


def flat_values(paths: list[Column]) -> Column:
    """E13 over the values at several paths (JSON text or plain scalars)."""

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        def one(texts):
            out: list[str] = []
            for t in texts:
                if t is None:
                    continue
                try:
                    out += scalars(json.loads(t)) if t[:1] in '[{"' else scalars(t)
                except ValueError:
                    out += scalars(t)
            return unique(out)

        return s.map(one)

    return run(F.array(*paths))


def lookup(df: DataFrame, path: str) -> Column:
    """The path; below response also inside the response's JSON text."""
    here = at(df, path)
    if path.startswith("response."):
        return F.coalesce(here, F.get_json_object(F.col("response.text"), "$." + path.split(".", 1)[1]))
    return here


def pattern(value: Column, case_sensitive: bool = False) -> Column:
    """The value as a literal, word-like values only as whole words."""
    quoted = F.concat(F.lit("\\Q"), F.replace(value, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    bounded = F.when(value.rlike("^[A-Za-z0-9_]+$"), F.concat(F.lit(r"(?<!\w)"), quoted, F.lit(r"(?!\w)"))).otherwise(quoted)
    return F.concat(F.lit("(?U)" if case_sensitive else "(?iuU)"), bounded)


def lines_of(text: Column) -> Column:
    parts = F.split(text, _BREAK)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def hits(line: Column, patterns: Column) -> Column:
    return F.size(F.filter(patterns, lambda p: F.call_function("rlike", line, p)))


def without(lines: Column, hidden) -> Column:
    """The lines that are blank or not hidden."""
    return F.filter(lines, lambda line: (strip(line) == "") | ~hidden(line))


def shown(df: DataFrame, field: str, config: Mapping[str, Any]) -> DataFrame:
    """Adds `_field`, the field's text without revealing lines, values redacted, blank runs collapsed.

    Values that Python finds become pattern columns first: they can't be computed inside a line's lambda.
    """
    text = F.coalesce(F.col(field), F.lit(""))
    if not config:
        return df.withColumn(f"_{field}", text)
    sensitive = bool(config.get("case_sensitive", False))
    made: dict[str, Column] = {}

    def patterns(name: str, found: Column) -> Column:
        made[f"_{field}_{name}"] = found
        return F.transform(F.col(f"_{field}_{name}"), lambda v: pattern(v, sensitive))

    lines = lines_of(text)
    prefixes = [p.lower() for p in strings(config.get("remove_line_prefixes") or config.get("drop_line_prefixes"))]
    if prefixes:
        listed = F.array(*[F.lit(p) for p in prefixes])
        lines = without(lines, lambda line: F.exists(listed, lambda p: F.startswith(F.lower(strip(line)), p)))
    rule = config.get("remove_lines_with_fields") or {}
    if paths := strings(rule.get("paths") or rule.get("fields")):
        named, least = patterns("fields", flat_values([lookup(df, p) for p in paths])), max(1, int(rule.get("min_hits", 1)))
        lines = without(lines, lambda line: hits(line, named) >= least)
    auto = config.get("auto_remove_lines_with_response_fields") or {}
    if auto and auto.get("enabled", True):
        seen, few = patterns("auto", auto_values(F.col("response.text"), strings(auto.get("exclude_fields")))), max(1, int(auto.get("min_hits", 2)))
        lines = without(lines, lambda line: hits(line, seen) >= few)
    if paths := strings(config.get("redact_field_values") or config.get("redact_fields")):
        word = F.regexp_replace(F.lit(str(config.get("replacement", REPLACEMENT))), r"([\\$])", r"\\$1")
        secret = patterns("redact", flat_values([lookup(df, p) for p in paths]))
        lines = F.transform(lines, lambda line: F.aggregate(secret, line, lambda now, p: F.regexp_replace(now, p, word)))
    out = df.withColumns(made) if made else df
    return out.withColumn(f"_{field}", strip(F.array_join(collapse(lines), "\n"))).drop(*made)


def collapse(lines: Column) -> Column:
    """Of consecutive blank lines one stays."""
    empty = lambda x: strip(x) == ""
    return F.filter(lines, lambda x, k: ~(empty(x) & (k > 0) & empty(F.coalesce(F.get(lines, k - 1), F.lit("x")))))


def apply(df: DataFrame, plan: Plan) -> DataFrame:
    """Adds instruction_modified and context_modified (E15) and replaces both texts."""
    rules, _ = mode(plan)
    for field in ("instruction", "context"):
        config = rules.get(field) if isinstance(rules.get(field), Mapping) else {}
        df = shown(df, field, config)
    for field in ("instruction", "context"):
        df = df.withColumn(f"{field}_modified", F.col(f"_{field}") != (strip(F.coalesce(F.col(field), F.lit(""))) if rules.get(field) else F.coalesce(F.col(field), F.lit(""))))
    return df.withColumns({f: F.col(f"_{f}") for f in ("instruction", "context")}).drop("_instruction", "_context")


def changes(shown_df: DataFrame) -> DataFrame:
    """Counters over records that `apply` went over."""
    a, b = F.col("instruction_modified"), F.col("context_modified")
    return shown_df.agg(F.count_if(a).alias("instruction_modified"), F.count_if(b).alias("context_modified"), F.count_if(a | b).alias("records_modified"))
