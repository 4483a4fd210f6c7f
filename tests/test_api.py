"""The commands one after another over one store, and audit windows in stretches."""

import json
import random

from pyspark.sql import functions as F

from curlew import api
from curlew.operators import audit, coverage
from curlew.plans.plan import Plan
from curlew.sources.store import Store


def rows_of(k):
    rng = random.Random(k)
    text = "Answer: " + " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 99)}" for _ in range(20))
    return {"id": f"r{k}", "instruction": f"Explain the topic number {k} in detail", "response": {"format": "single", "text": text}, "metadata": {"difficulty": "easy", "persona": "general"}}


def test_commands(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    copy = rows_of(1) | {"id": "r1b"}
    (tmp_path / "a.jsonl").write_text("".join(json.dumps(r) + "\n" for r in [rows_of(1), rows_of(2), copy, rows_of(3) | {"response": {"format": "single", "text": ""}}]))
    (tmp_path / "b.jsonl").write_text("".join(json.dumps(r) + "\n" for r in [rows_of(4), rows_of(2) | {"id": "r2b"}]))
    first = api.generate(store, str(tmp_path / "a.jsonl"), run_id="run1")
    assert (first["imported"], first["failed"], first["deduped_on_import"]) == (3, 1, 0)
    # without the number in the instruction the copies would be exact
    second = api.generate(store, str(tmp_path / "b.jsonl"), dedup_threshold=0.85)
    assert (second["imported"], second["deduped_on_import"]) == (1, 1)
    assert [(r.duplicate_id, r.kept_id, r.reason) for r in second["duplicates"].collect()] == [("r2b", "r2", "exact")]
    assert api.generate(store, topic="rivers", count=4)["imported"] == 4
    (tmp_path / "rev.jsonl").write_text("".join(json.dumps({"id": i, "score": 5, "reason": "ok", "status": "pass"}) + "\n" for i in ("r1", "r1b", "r2", "r4")))
    assert api.verify(store, ("raw_generated",), str(tmp_path / "rev.jsonl")) == {"processed": 4, "n_pass": 4, "n_fail": 0, "n_pending": 0}
    assert api.verify(store, ("seeded",))["n_fail"] == 4
    assert api.dedup(store) == {"processed": 4, "deduped": 1}
    plan = Plan({"target_effective_count": 3})
    got = api.coverage(store, ("verified_pass",), plan)
    assert got.complete(plan) and got.summary["effective_count"] == 3 and got.summary["left_out"] == {}
    found = {r.check: (r.severity, r.n) for r in api.audit(store).collect()}
    assert found["difficulty share"] == ("high", 1) and found["tropes"] == ("pass", 0) and found["length"][1] == 0
    done = api.export(store, str(tmp_path / "out"), "openai")
    assert done["train"] == 3 and (tmp_path / "out" / "openai_train.jsonl").exists()
    assert api.augment(store, from_status=("verified_pass",), personas=("expert",), difficulties=("easy", "hard"), limit=1) == 2
    (tmp_path / "tree").mkdir()
    (tmp_path / "tree" / "n.md").write_text("Some notes on rivers.")
    assert api.collect(store, folders=[str(tmp_path / "tree")], urls=["u1"], fetcher=lambda u: (u, "<title>T</title><p>page</p>", 200, None), delay=0) == 2
    assert {r.status for r in store.read().collect()} == {"verified_pass", "verified_fail", "deduped", "augmented", "collected"}


def test_build_command(spark, tmp_path):
    (tmp_path / "b1.jsonl").write_text(json.dumps(rows_of(7)) + "\n")
    store = Store(spark, str(tmp_path / "s"))
    done = api.build(store, pattern=str(tmp_path / "b*.jsonl"), plan=Plan({"target_effective_count": 1}), skip_verify=True)
    assert done["complete"] and store.read().count() == 1


def test_runs_and_steps_over_stretches(spark):
    """A group of a third of all rows lies in many stretches; runs go on from one to the next."""
    rng = random.Random(3)
    made, groups = [], {"hot": [], "b": [], "c": []}
    for seq in range(3000):
        group = rng.choice(["hot", "hot", "b", "c"])
        opening = rng.choice(["x", "y"]) if seq % 500 > 130 else "same"
        made.append((group, seq, opening, rng.choice([None, rng.randint(0, 50)])))
        groups[group].append(made[-1])
    want, steps = [], {}
    for group, rows in groups.items():
        at = 0
        while at < len(rows):
            end = at
            while end < len(rows) and rows[end][2] == rows[at][2]:
                end += 1
            if end - at > 3:
                want.append((group, rows[at][2], end - at, rows[at][1]))
            at = end
        pairs = [(a[3], b[3]) for a, b in zip(rows, rows[1:]) if a[3] is not None]
        steps[group] = (len(pairs), sum(b is not None and b >= a for a, b in pairs))
    df = spark.createDataFrame(made, "source string, seq long, opening string, x int").repartition(6)
    assert sorted(tuple(r) for r in audit.repeated_openings(df, F.col("opening"), 3).collect()) == sorted(want)
    assert {r.source: (r.steps, r.ascending) for r in audit.unsorted_steps(df, F.col("x")).collect()} == steps


def test_report_says_what_it_leaves_out(spark, monkeypatch):
    monkeypatch.setattr(coverage, "CAP", 3)
    df = spark.createDataFrame([(f"r{k}", "sft", ("single", f"text {k}", None, None), json.dumps({"difficulty": f"d{k}", "persona": "p"}), k) for k in range(10)], "id string, task_type string, response struct<format:string,text:string,chosen:string,rejected:string>, metadata string, seq long")
    got = coverage.report(df, df, Plan({}), ["metadata.difficulty", "metadata.persona"])
    groups = got.summary["groups"]
    assert [g["field"] for g in groups] == ["metadata.difficulty"] * 3 + ["metadata.persona"] and got.summary["left_out"] == {"groups": 7} and got.tables["groups"].count() == 11
