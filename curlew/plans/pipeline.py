"""The build loop over batches (L1 to L7), a driver loop over DataFrame steps."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.operators.coverage import Report, report
from curlew.operators.dedup import deduplicate, effective, import_duplicates
from curlew.operators.export import export
from curlew.operators.normalize import infer_status, normalize, record_text, with_ids
from curlew.operators.sanitize import resolve_allowed, sanitize
from curlew.operators.validate import split_valid, verify
from curlew.plans.plan import Plan
from curlew.sources.files import read_records
from curlew.sources.scratch import Scratch
from curlew.sources.store import Store


def ingest(raw: DataFrame, source_type: str = "manual", allow_injections: bool | None = None, signals: tuple = (), run_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw JSON rows to (records, rejects); malformed rows and invalid records are rejected with their errors.

    Records are written between their projections and the checks: a filter on the checks would else be pushed below
    the projections, with all their expressions copied into it.
    """
    scratch = Scratch(raw.sparkSession)
    records = with_ids(scratch.put(sanitize(scratch.put(normalize(raw, source_type=source_type), keep=True), resolve_allowed(allow_injections, *signals)), keep=True))
    status = F.when(F.col("status").isin("", "pending"), infer_status(F.col("response"))).otherwise(F.col("status"))
    records = records.withColumn("status", status).withColumn("run_id", F.coalesce("run_id", F.lit(run_id).cast("string")))
    return split_valid(scratch.put(records, keep=True))


def active_statuses(skip_verify: bool, reviewed: bool) -> tuple[str, ...]:
    """L2."""
    return ("raw_generated", "augmented") if skip_verify else ("verified_pass",) if reviewed else ("judge_pending",)


def coverage_statuses(skip_verify: bool, reviewed: bool) -> tuple[str, ...]:
    """L3."""
    return active_statuses(skip_verify, reviewed) if skip_verify or reviewed else ("raw_generated", "augmented", "judge_pending", "verified_pass")


@dataclass
class Pipeline:
    spark: SparkSession
    root: str
    plan: Plan = field(default_factory=Plan)
    threshold: float = 0.85
    skip_verify: bool = False
    skip_dedup: bool = False
    keep_going: bool = False

    def __post_init__(self):
        self.store = Store(self.spark, self.root)

    def step(self, raw: DataFrame, reviews: DataFrame | None = None) -> Report:
        """L1: one batch through ingest, import dedup, verification, dedup and coverage."""
        scratch = Scratch(self.spark)
        good, _ = ingest(raw)
        good = scratch.put(good)
        old = self.store.read()
        text = record_text()
        if old is not None:
            dups = import_duplicates(old.filter(F.col("status").isin("raw_generated", "augmented", "judge_pending", "verified_pass")), good, text, self.threshold)
            good = mark_duplicates(good, dups)
        self.store.upsert(good)
        if not self.skip_verify:
            waiting = self.store.by_status("raw_generated", "augmented", "seeded")
            self.store.upsert(scratch.put(verify(waiting, self.plan, reviews).drop("errors")))
        pool = active_statuses(self.skip_verify, reviews is not None)
        if not self.skip_dedup:
            current = self.store.by_status(*pool)
            if not current.isEmpty():
                self.store.upsert(scratch.put(deduplicate(current, text, self.threshold)))
        seen = scratch.put(self.store.by_status(*coverage_statuses(self.skip_verify, reviews is not None)))
        return report(seen, scratch.put(effective(seen, text, self.threshold)), self.plan)

    def run(self, batches: list[str], reviews: DataFrame | None = None, export_to: str | None = None, fmt: str = "openai") -> dict:
        """Batches in order until the plan is met (or all, with keep_going); then, if asked, an export."""
        if self.plan.spec.get("require_review_file") and reviews is None:
            raise ValueError("the plan asks for a review file")  # L6
        done, complete, last = [], False, None
        for path in batches:
            last = self.step(read_records(self.spark, path), reviews)
            done.append(path)
            complete = last.complete(self.plan)
            if complete and not self.keep_going:
                break
        out = {"batches": done, "complete": complete, "stop_reason": "plan complete" if complete else "batches used up", "summary": last.summary if last else None}
        if export_to:
            out["export"] = export(self.store.read(), export_to, fmt, plan=self.plan)
        return out


def mark_duplicates(batch: DataFrame, dups: DataFrame, text: str = "Duplicate of ") -> DataFrame:
    why = dups.select(F.col("duplicate_id").alias("id"), F.concat(F.lit(text), "kept_id", F.lit(" ("), "reason", F.lit(")")).alias("_why"))
    hit = F.col("_why").isNotNull()
    return batch.join(why, "id", "left").withColumns({"status": F.when(hit, "deduped").otherwise(F.col("status")), "pipeline_status": F.when(hit, "fail").otherwise(F.col("pipeline_status")), "error_message": F.coalesce("_why", "error_message")}).drop("_why")
