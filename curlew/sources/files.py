"""File sources: JSON, JSON lines, CSV, and trees of local text files."""

from __future__ import annotations

import glob
import json
import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curlew.operators.validate import flat_schema_errors

FORMATS = {".jsonl": "jsonl", ".ndjson": "jsonl", ".json": "json", ".csv": "csv"}
#: Which files are read and which folders are passed over.
TEXT_SUFFIXES = (".md", ".txt", ".rst", ".py", ".js", ".ts", ".java", ".go", ".rb", ".rs", ".c", ".cpp", ".h", ".cs", ".sh", ".bash", ".yaml", ".yml", ".toml", ".ini", ".cfg", ".json", ".html", ".xml", ".sql")
SKIPPED_DIRS = (".git", ".venv", "venv", "node_modules", "__pycache__", ".mypy_cache", ".pytest_cache", "dist", "build", ".eggs")


def detect_format(path: str) -> str:
    """S1."""
    suffix = os.path.splitext(path)[1].lower()
    if suffix not in FORMATS:
        raise ValueError(f"unsupported file format: {suffix or path}")
    return FORMATS[suffix]


def _numbered(df: DataFrame) -> DataFrame:
    """seq in file order: a file's rows stay in order within and between its splits."""
    return df.withColumn("seq", F.monotonically_increasing_id())


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """(raw, seq); blank lines are skipped, a line that is no object stops the job."""
    lines = _numbered(spark.read.text(path)).filter(F.trim("value") != "")
    ok = F.coalesce(F.substring(F.to_json(F.try_parse_json("value")), 1, 1) == "{", F.lit(False))
    checked = F.when(ok, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring("value", 1, 80))))
    return lines.select(checked.cast("string").alias("raw"), "seq")


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """S3: an array of objects or one object; a file is read whole, so JSON lines suit large inputs better."""
    whole = spark.read.text(path, wholetext=True)
    v = F.parse_json("value")
    one = F.substring(F.to_json(v), 1, 1) == "["
    items = F.from_json(F.to_json(v), "array<variant>")
    rows = whole.select(F.posexplode(F.when(one, items).otherwise(F.array(v))).alias("seq", "v"))
    return rows.select(F.to_json("v").alias("raw"), F.col("seq").cast("long").alias("seq"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header, strings only, quoted line ends; an empty cell is an empty string."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', nullValue="\0", emptyValue="")
    return _numbered(df).select(F.to_json(F.struct(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns if c != "seq"])).alias("raw"), "seq")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return {"jsonl": read_jsonl, "json": read_json, "csv": read_csv}[detect_format(path)](spark, path)


def walk(spark: SparkSession, root: str, suffixes=TEXT_SUFFIXES, skip=SKIPPED_DIRS, max_files: int | None = 200) -> DataFrame:
    """(path, length, content) of text files below root, by path; skipped folders are relative to root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    top = F.regexp_replace(F.lit(os.path.abspath(root)), r"/+$", "")
    inner = F.regexp_replace("path", r"^[a-z0-9]+:/*", "/")
    relative = F.substring(inner, F.length(top) + 2, F.length(inner))
    suffix = F.lower(F.regexp_extract(relative, r"(\.[^./]+)$", 1))
    parts = F.split(relative, "/")
    folders = F.slice(parts, 1, F.size(parts) - 1)
    kept = files.filter(suffix.isin(*[s.lower() for s in suffixes]) & ~F.arrays_overlap(folders, F.array(*[F.lit(s) for s in skip])))
    ordered = kept.select("path", "length", "content").orderBy("path")
    return ordered if max_files is None else ordered.limit(max_files)


def decode(content):
    """UTF-8 or else Latin-1, which never fails."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        def one(b):
            try:
                return b.decode("utf-8")
            except UnicodeDecodeError:
                return b.decode("latin-1")

        return s.map(lambda b: None if b is None else one(b))

    return run(content)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """S14 source: (id, score, reason, status, seq), all strings."""
    raw = read_records(spark, path)
    get = lambda k: F.get_json_object("raw", f"$.{k}").alias(k)
    return raw.select(get("id"), get("score"), get("reason"), get("status"), "seq")


def resolve_batches(paths: list[str], pattern: str | None = None) -> list[str]:
    """Batch files in order, each once; a missing one stops."""
    out: dict[str, str] = {}
    for p in [*paths, *(sorted(glob.glob(pattern)) if pattern else [])]:
        if not os.path.exists(p):
            raise FileNotFoundError(p)
        out.setdefault(os.path.realpath(p), p)
    return list(out.values())


def load_flat_schema(path: str) -> dict:
    """S16."""
    with open(path, encoding="utf-8") as f:
        schema = json.load(f)
    if errors := flat_schema_errors(schema):
        raise ValueError("; ".join(errors))
    return schema


REVIEW = T.StructType([T.StructField(k, T.StringType()) for k in ("id", "score", "reason", "status")] + [T.StructField("seq", T.LongType())])
