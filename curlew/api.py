"""The user's commands over a record store: collect, generate, augment, verify, dedup, coverage, audit, export, build."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.operators import audit as checks
from curlew.operators import export as sinks
from curlew.operators.augment import DIFFICULTIES, PERSONAS, import_augmented, metadata_variants
from curlew.operators.coverage import Report, report
from curlew.operators.dedup import deduplicate, effective, import_duplicates
from curlew.operators.normalize import record_text, seeds
from curlew.operators.validate import summary as verified_summary
from curlew.operators.validate import verify as verify_records
from curlew.plans.pipeline import Pipeline, ingest, mark_duplicates
from curlew.plans.plan import Plan
from curlew.sources.files import read_records, read_reviews, resolve_batches
from curlew.sources.scratch import Scratch
from curlew.sources.store import Store
from curlew.sources.web import collect_files, collect_pages, fetch, merge_collected

OPEN = ("raw_generated", "augmented", "judge_pending", "verified_pass")


def _of(store: Store, statuses: Sequence[str], limit: int | None = None) -> DataFrame:
    rows = store.by_status(*statuses)
    return rows if limit is None else rows.limit(limit)


def _store(store: Store, rows: DataFrame) -> DataFrame:
    """Writes rows and gives them back as written."""
    rows = Scratch(store.spark).put(rows, keep=True)
    store.upsert(rows)
    return rows


def generate(store: Store, path: str | None = None, topic: str | None = None, count: int = 500, task_type: str = "sft", source_type: str = "generated", allow_injections: bool | None = None, dedup_threshold: float | None = None, compare_status: Sequence[str] = OPEN, run_id: str | None = None) -> dict:
    """Imports a file, or seeds a topic. Invalid records are counted, not stored; with a threshold duplicates are stored as such."""
    if path is None and (topic is None or count < 1):
        raise ValueError("give a file, or a topic and a positive count")
    if path is None:
        good, bad = seeds(store.spark, topic, count, task_type, source_type).withColumn("run_id", F.lit(run_id).cast("string")), None
    else:
        good, bad = ingest(read_records(store.spark, path), source_type, allow_injections, (topic, path), run_id)
    found, old = None, store.read()
    if dedup_threshold is not None:
        known = good.limit(0) if old is None else old.filter(F.col("status").isin(*compare_status))
        found = Scratch(store.spark).put(import_duplicates(known, good, record_text(), dedup_threshold), keep=True)
        good = mark_duplicates(good, found, "Rejected on import as duplicate of ")
    _store(store, good)
    deduped = 0 if found is None else found.count()
    return {"imported": good.count() - deduped, "deduped_on_import": deduped, "failed": 0 if bad is None else bad.count(), "duplicates": found, "errors": None if bad is None else bad.select("id", "seq", "errors")}


def collect(store: Store, urls: Sequence[str] = (), folders: Sequence[str] = (), query: str | None = None, max_files: int | None = 200, max_chars: int = 3000, overlap: int = 200, task_type: str = "sft", **fetching) -> int:
    """Pages and text files, cut to chunks, as collected records; the number of records."""
    options = {"query": query, "max_chars": max_chars, "overlap": overlap, "task_type": task_type}
    parts = []
    if urls:
        pages = fetch(store.spark.createDataFrame([(u,) for u in urls], "url string"), **fetching)
        parts.append(collect_pages(Scratch(store.spark).put(pages), **options))
    parts += [collect_files(store.spark, f, max_files=max_files, **options) for f in folders]
    if not parts:
        return 0
    return _store(store, merge_collected(*parts)).count()


def augment(store: Store, path: str | None = None, from_status: Sequence[str] = ("raw_generated",), personas: Sequence[str] = PERSONAS, difficulties: Sequence[str] = DIFFICULTIES, limit: int | None = 25) -> int:
    """Outside rewrites from a file, or variants of stored records that still have to be rewritten; the number stored."""
    rows = import_augmented(read_records(store.spark, path)) if path else metadata_variants(_of(store, from_status), tuple(personas), tuple(difficulties), limit)
    return _store(store, rows.drop("created_at", "updated_at")).count()


def verify(store: Store, from_status: Sequence[str] = ("raw_generated", "augmented", "seeded"), review_file: str | None = None, plan: Plan | None = None, min_instruction: int = 12, min_response: int = 12, limit: int | None = None) -> dict:
    """Verdicts of checks and reviews on stored records: processed and their number by verdict."""
    reviews = read_reviews(store.spark, review_file) if review_file else None
    rows = _store(store, verify_records(_of(store, from_status), plan, reviews, min_instruction, min_response, limit).drop("errors"))
    return verified_summary(rows).first().asDict()


def dedup(store: Store, from_status: Sequence[str] = ("verified_pass",), threshold: float = 0.85, limit: int | None = None, run_id: str | None = None) -> dict:
    """Duplicates among stored records are marked; how many were looked at and marked."""
    rows = _of(store, from_status)
    rows = _store(store, deduplicate(rows if run_id is None else rows.filter(F.col("run_id") == run_id), record_text(), threshold, limit))
    return {"processed": rows.count(), "deduped": rows.filter("status = 'deduped'").count()}


def coverage(store: Store, from_status: Sequence[str] = ("raw_generated", "augmented", "verified_pass"), plan: Plan | None = None, group_by: list[str] | None = None, threshold: float = 0.85) -> Report:
    rows = Scratch(store.spark).put(_of(store, from_status))
    return report(rows, Scratch(store.spark).put(effective(rows, record_text(), threshold)), plan or Plan(), group_by)


def audit(store: Store, from_status: Sequence[str] = ("verified_pass",), benchmark: DataFrame | None = None) -> DataFrame:
    """(check, severity, n) of the checks that need nothing but the records (and, if given, a benchmark of item_id and text)."""
    rows = Scratch(store.spark).put(_of(store, from_status))
    meta = lambda k: F.get_json_object("metadata", f"$.{k}")
    answer = F.coalesce("response.text", "response.chosen", F.lit(""))
    parts = [
        ("difficulty share", "high", checks.over_share(rows, meta("difficulty"), 40, "difficulty")),
        ("persona share", "medium", checks.over_share(rows, meta("persona"), 40, "persona")),
        ("context leakage", "medium", checks.context_leakage(rows, F.col("context"), answer)),
        ("repeated openings", "medium", checks.repeated_openings(rows.withColumn("_all", F.lit(0)), checks.opening(answer), 3, "_all")),
        ("tropes", "low", rows.filter(checks.tropes(answer).isNotNull())),
        ("length", "medium", checks.too_short(rows, answer, meta("intent"), {})),
    ]
    if benchmark is not None:
        parts.append(("contamination", "high", checks.contaminated(rows.select("id", record_text().alias("text")), benchmark)))
    return checks.findings(*parts)


def export(store: Store, folder: str, fmt: str = "all", schema: dict | None = None, split: float = 0.0, seed: int = 42, plan: Plan | None = None, run_id: str | None = None) -> dict:
    return sinks.export(store.read(), folder, fmt, schema, split, seed, plan, run_id)


def build(store: Store, batches: Sequence[str] = (), pattern: str | None = None, plan: Plan | None = None, review_file: str | None = None, export_to: str | None = None, fmt: str = "openai", threshold: float = 0.85, skip_verify: bool = False, skip_dedup: bool = False, keep_going: bool = False) -> dict:
    """The build loop over batch files, in order, until the plan is met."""
    loop = Pipeline(store.spark, store.root, plan or Plan(), threshold, skip_verify, skip_dedup, keep_going)
    reviews = read_reviews(store.spark, review_file) if review_file else None
    return loop.run(resolve_batches(list(batches), pattern), reviews, export_to, fmt)

