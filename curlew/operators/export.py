"""Export projections, files and the data card."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.functions.paths import lookup
from curlew.functions.text import ascii_json, blank
from curlew.operators.coverage import distributions
from curlew.operators.split import split
from curlew.operators.validate import flat_schema_errors
from curlew.operators.visibility import apply, changes
from curlew.plans.plan import Plan

STATUSES = ("verified_pass",)


def exportable(df: DataFrame, statuses=STATUSES, run_id: str | None = None) -> DataFrame:
    """Pushed down to the scan: status, pipeline verdict and, if given, run."""
    out = df.filter(F.col("status").isin(*statuses) & (F.col("pipeline_status") == "pass"))
    return out if run_id is None else out.filter(F.col("run_id") == run_id)


def _turn(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.alias("content"))


def chat_messages() -> Column:
    """E3, E4 for single responses: system (if there is context), user, assistant."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    turns = F.array(F.when(~blank(F.col("context")), _turn("system", F.col("context"))), _turn("user", text("instruction")), _turn("assistant", text("response.text")))
    return F.filter(turns, lambda t: t.isNotNull())


def _line(single: Column, pair: Column) -> Column:
    body = F.when(F.col("task_type") == "dpo", F.to_json(pair, {"ignoreNullFields": "false"})).otherwise(F.to_json(single, {"ignoreNullFields": "false"}))
    # metadata is JSON text already: it goes in as an object
    return F.concat(F.regexp_replace(body, r"\}$", ""), F.lit(',"metadata":'), F.coalesce("metadata", F.lit("{}")), F.lit("}"))


def openai_lines(df: DataFrame) -> DataFrame:
    """A JSON line a record."""
    single = F.struct(chat_messages().alias("messages"))
    pair = F.struct(F.struct("instruction", "context").alias("input"), F.col("response.chosen").alias("chosen"), F.col("response.rejected").alias("rejected"))
    return df.select(_line(single, pair).alias("value"))


def huggingface_lines(df: DataFrame) -> DataFrame:
    """E4."""
    single = F.struct(chat_messages().alias("messages"))
    pair = F.struct(F.col("instruction").alias("prompt"), "context", F.col("response.chosen").alias("chosen"), F.col("response.rejected").alias("rejected"))
    return df.select(_line(single, pair).alias("value"))


def flat(df: DataFrame, schema: dict) -> DataFrame:
    """E5: a column a schema entry; paths that lead nowhere give an empty string, nulls stay null."""
    if errors := flat_schema_errors(schema):
        raise ValueError("; ".join(errors))
    return df.select(*[lookup(df, c["source"].strip()).alias(c["name"].strip()) for c in schema["columns"]])


def canonical_lines(df: DataFrame) -> DataFrame:
    """Records as they are in the store."""
    return df.select(F.to_json(F.struct(*[c for c in df.columns if c not in ("metadata", "seq", "instruction_modified", "context_modified")], F.try_parse_json("metadata").alias("metadata")), {"ignoreNullFields": "false"}).alias("value"))


def write_jsonl(lines: DataFrame, path: str, files: int | None = None) -> None:
    """K1: one object a line, in ASCII: other characters are escaped."""
    lines = lines.select(ascii_json(F.col("value")).alias("value"))
    (lines if files is None else lines.coalesce(files)).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """K2: header, minimal quoting, doubled quotes, null as empty; line ends stay LF so that quoted ones are kept."""
    (df if files is None else df.coalesce(files)).write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="", nullValue="")


def write_json(report: dict, path: str) -> None:
    """K3: small driver-side reports."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="ascii") as f:
        json.dump(report, f, indent=2, default=str)


def card(train: DataFrame, test: DataFrame, title: str = "Dataset") -> str:
    """K9: a Markdown data card from one histogram query."""
    rows = distributions(train.unionByName(test)).orderBy("field", "value").collect()
    heads = {"task_type": "Task types", "source_type": "Source types", "metadata.difficulty": "Difficulty", "metadata.persona": "Personas", "judge_score": "Judge scores"}
    out = [f"# {title}", "", f"- train records: {train.count()}", f"- test records: {test.count()}", ""]
    for field, head in heads.items():
        own = [f"- {r['value']}: {r['n']}" for r in rows if r["field"] == field]
        out += [f"## {head}", "", *(own or ["- none"]), ""]
    return "\n".join(out)


def export(df: DataFrame, folder: str, fmt: str = "all", schema: dict | None = None, ratio: float = 0.0, seed: int = 42, plan: Plan | None = None, run_id: str | None = None) -> dict:
    """Filter, split, hide, project, write: a folder a file; test files only where there is a test set (K8)."""
    chosen = exportable(df, run_id=run_id)
    sides = {name: apply(side, plan or Plan()).persist() for name, side in zip(("train", "test"), split(chosen, ratio, seed), strict=True)}
    done: dict = {}
    try:
        for name, side in sides.items():
            n = side.count()
            done[name] = n
            if name == "test" and not n:
                continue
            write_jsonl(canonical_lines(side), f"{folder}/canonical_{name}.jsonl")
            if fmt in ("openai", "all"):
                write_jsonl(openai_lines(side), f"{folder}/openai_{name}.jsonl")
            if fmt in ("huggingface", "all"):
                write_jsonl(huggingface_lines(side), f"{folder}/huggingface_{name}.jsonl")
            if schema and fmt in ("csv", "all"):
                write_csv(flat(side, schema), f"{folder}/{name}.csv")
            if schema and fmt in ("jsonl", "all"):
                write_jsonl(flat(side, schema).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")), f"{folder}/{name}.jsonl")
        done["visibility"] = changes(sides["train"].unionByName(sides["test"])).first().asDict()
        done["card"] = card(sides["train"], sides["test"])
    finally:
        for side in sides.values():
            side.unpersist()
    return done
