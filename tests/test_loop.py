"""The store, the build loop and its streaming form, imports and exports, end to end."""

import json

import pytest
from pyspark.sql import functions as F

from curlew.operators import dedup, export
from curlew.operators.augment import variant_axes
from curlew.plans.pipeline import Pipeline, active_statuses, coverage_statuses, ingest
from curlew.plans.plan import Plan
from curlew.sources import scratch
from curlew.sources.store import KEEP, Store
from curlew.streaming.incremental import ingest_stream

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def record(k, text=None, **more):
    return {"instruction": f"Explain the topic number {k} in some detail", "context": "", "response": {"format": "single", "text": text or f"Answer {k}: " + " ".join(WORDS[(k * 7 + j * (k + 1)) % len(WORDS)] + str(k) for j in range(15))}, "metadata": {"difficulty": "easy", "persona": "general"}} | more


def lines(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


def raw(spark, rows):
    return spark.createDataFrame([(json.dumps(r), k) for k, r in enumerate(rows)], "raw string, seq long")


def test_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.read() is None
    rows = spark.createDataFrame([("a", 1, "new", "p"), ("b", 2, "new", None)], "id string, seq long, status string, raw_payload string")
    store.upsert(rows, "2024-01-01 00:00:00")
    old = store.read()
    again = spark.createDataFrame([("b", 5, "done", None, "x"), ("b", 4, "lost", None, "y"), ("c", 6, "new", None, "z")], "id string, seq long, status string, raw_payload string, note string")
    store.upsert(again, "2024-02-02 00:00:00")
    got = {r.id: r for r in store.read().collect()}
    assert {k: (r.status, r.note, str(r.created_at)[:10], str(r.updated_at)[:10]) for k, r in got.items()} == {"a": ("new", None, "2024-01-01", "2024-01-01"), "b": ("done", "x", "2024-01-01", "2024-02-02"), "c": ("new", "z", "2024-02-02", "2024-02-02")}
    assert old.count() == 2  # a reader of the snapshot before still has it
    store.update_status("a", status="fail", note="why")
    assert [(r.id, r.note) for r in store.by_status("fail").collect()] == [("a", "why")]
    assert [r.id for r in store.by_status("new", "done").collect()] == ["b", "c"] and [r.id for r in store.latest(1).collect()] == ["a"]
    for _ in range(KEEP + 1):
        store.update_status("a", status="fail")
    assert len(list((tmp_path / "s").glob("snapshot-*"))) == KEEP


def test_store_refuses_a_second_writer(spark, tmp_path, monkeypatch):
    one, two = Store(spark, str(tmp_path / "s")), Store(spark, str(tmp_path / "s"))
    rows = spark.createDataFrame([("a", 1)], "id string, seq long")
    one.upsert(rows)
    stale = two._pointers()
    one.upsert(rows)
    monkeypatch.setattr(two, "_pointers", lambda: stale)
    with pytest.raises(RuntimeError, match="meanwhile"):
        two.upsert(rows)


def test_ingest_rejects_and_names_errors(spark):
    rows = [record(1), record(2, text=" "), {"prompt": "What is the answer to it all?", "completion": "It is forty-two.\r\nReally.", "id": "own"}, record(3, source_type="raw_dataset")]
    good, bad = ingest(raw(spark, rows).union(spark.createDataFrame([("{broken", 9)], "raw string, seq long")))
    by = {r.seq: r for r in good.collect()}
    assert set(by) == {0, 2, 3} and by[2].id == "own" and by[2].response.text == "It is forty-two.\nReally." and by[0].id.startswith("rec_") and {r.status for r in by.values()} == {"raw_generated"}
    errors = {r.seq: r.errors for r in bad.collect()}
    assert errors[1] == ["response.text must be a non-empty string"] and "task_type must be one of: sft, dpo" in errors[9]


def test_import_compares_with_every_stored_record(spark):
    """A and B are alike and stored; C is like B, less like A; D is a copy of A, E like D alone, F a copy of the new G."""
    words = [f"w{k}" for k in range(60)]
    a, b, c = list(words), list(words), list(words)
    b[-2:] = ["b1", "b2"]
    c[-2:], c[:2] = ["b1", "b2"], ["c1", "c2"]
    stored = [("A", 1, a), ("B", 2, b)]
    g = [f"g{k}" for k in range(30)]
    batch = [("C", 1, c, "raw_generated"), ("D", 2, a, "raw_generated"), ("G", 3, g, "raw_generated"), ("F", 4, g, "raw_generated"), ("S", 5, a, "seeded"), ("H", 6, [f"h{k}" for k in range(30)], "raw_generated")]
    old = spark.createDataFrame([(i, s, " ".join(t)) for i, s, t in stored], "id string, seq long, text string")
    new = spark.createDataFrame([(i, s, " ".join(t), st) for i, s, t, st in batch], "id string, seq long, text string, status string")
    got = {r.duplicate_id: (r.kept_id, r.reason, round(r.score, 4)) for r in dedup.import_duplicates(old, new, F.col("text"), 0.85).collect()}
    near = round((58 - 2) / (58 + 2), 4)
    assert got == {"C": ("B", "near", near), "D": ("A", "exact", 1.0), "F": ("G", "exact", 1.0)}
    again = dedup.import_duplicates(old, new.withColumn("id", F.when(F.col("id") == "D", "A").otherwise(F.col("id"))), F.col("text"), 0.85)
    assert {r.duplicate_id: r.kept_id for r in again.collect()}["A"] == "B"  # it replaces the stored A, which is no copy to hold it against


def test_greedy_in_rounds_equals_one_task(spark, monkeypatch):
    import random

    rng = random.Random(5)
    pairs = {tuple(sorted(rng.sample(range(60), 2))) for _ in range(90)}
    df = spark.createDataFrame(sorted(pairs), "a long, b long")
    dropped = set()
    for x, y in sorted(pairs, key=lambda p: (p[1], p[0])):
        if x not in dropped:
            dropped.add(y)
    for small in (dedup.SMALL, 0):
        monkeypatch.setattr(dedup, "SMALL", small)
        assert {r.node for r in dedup.greedy(df).collect() if not r.kept} == dropped


def test_loop_over_batches(spark, tmp_path):
    one = lines(tmp_path / "b1.jsonl", [record(1, id="r1"), record(2, id="r2"), record(1, id="r3")])
    two = lines(tmp_path / "b2.jsonl", [record(4, id="r4")])
    reviews = spark.createDataFrame([(f"r{k}", "5", "good", "PASS", k) for k in (1, 2, 3, 4)], "id string, score string, reason string, status string, seq long")
    build = Pipeline(spark, str(tmp_path / "store"), Plan({"target_effective_count": 3}))
    done = build.run([one, two], reviews, export_to=str(tmp_path / "out"))
    assert done["complete"] and done["batches"] == [one, two] and done["stop_reason"] == "plan complete"
    status = {r.id: r.status for r in build.store.read().collect()}
    assert sorted(status.values()) == ["deduped", "verified_pass", "verified_pass", "verified_pass"] and status["r4"] == "verified_pass"
    out = "".join(p.read_text() for p in (tmp_path / "out" / "openai_train.jsonl").glob("part-*"))
    assert len(out.splitlines()) == 3 and all([m["role"] for m in json.loads(x)["messages"]] == ["user", "assistant"] for x in out.splitlines())
    assert done["export"]["test"] == 0 and "# Dataset" in done["export"]["card"] and not (tmp_path / "out" / "openai_test.jsonl").exists()


def test_loop_stops_early_and_asks_for_reviews(spark, tmp_path):
    one, two = lines(tmp_path / "b1.jsonl", [record(1, id="r1")]), lines(tmp_path / "b2.jsonl", [record(2, id="r2")])
    done = Pipeline(spark, str(tmp_path / "s"), Plan({"target_effective_count": 1}), skip_verify=True).run([one, two])
    assert done["batches"] == [one] and done["complete"]
    with pytest.raises(ValueError, match="review"):
        Pipeline(spark, str(tmp_path / "t"), Plan({"require_review_file": True})).run([one])
    assert active_statuses(True, False) == ("raw_generated", "augmented") and active_statuses(False, True) == ("verified_pass",) and "judge_pending" in coverage_statuses(False, False)


def test_stream_replays_to_the_same_store(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines(folder / "a.jsonl", [record(1, id="r1"), record(2, id="r2")])
    build = Pipeline(spark, str(tmp_path / "store"), Plan({"target_effective_count": 3}), skip_verify=True)
    ingest_stream(build, str(folder), str(tmp_path / "cp")).awaitTermination()
    lines(folder / "b.jsonl", [record(3, id="r3")])
    ingest_stream(build, str(folder), str(tmp_path / "cp")).awaitTermination()
    assert len(build.reports) == 1 and build.reports[0].complete(build.plan)
    first = sorted((r.id, r.status) for r in build.store.read().collect())
    ingest_stream(build, str(folder), str(tmp_path / "fresh")).awaitTermination()  # all files once more
    assert sorted((r.id, r.status) for r in build.store.read().collect()) == first and len(first) == 3


def test_export_all_formats(spark, tmp_path):
    good, _ = ingest(raw(spark, [record(k, id=f"r{k}", metadata={"difficulty": "easy", "persona": "general", "topic": f"t{k}"}) for k in range(6)] + [{"id": "p", "question": "Which one is better here?", "chosen": "The first, as it is right.", "rejected": "The other one, I guess."}]))
    ready = good.withColumns({"status": F.lit("verified_pass"), "pipeline_status": F.lit("pass")})
    schema = {"name": "x", "mode": "flat", "columns": [{"name": "prompt", "source": "instruction"}, {"name": "persona", "source": "metadata.persona"}, {"name": "score", "source": "judge_score"}]}
    done = export.export(ready, str(tmp_path), schema=schema, ratio=0.3)
    assert done["train"] + done["test"] == 7 and done["test"] >= 2
    read = lambda name: [json.loads(x) for p in sorted((tmp_path / name).glob("part-*")) for x in p.read_text().splitlines()]
    for side in ("train", "test"):
        assert len(read(f"canonical_{side}.jsonl")) == len(read(f"openai_{side}.jsonl")) == len(read(f"huggingface_{side}.jsonl")) == len(read(f"{side}.jsonl")) == done[side]
        assert all(set(r) == {"prompt", "persona", "score"} and r["score"] is None for r in read(f"{side}.jsonl"))
        assert spark.read.csv(str(tmp_path / f"{side}.csv"), header=True).columns == ["prompt", "persona", "score"]
    pair = [r for side in ("train", "test") for r in read(f"openai_{side}.jsonl") if "chosen" in r]
    assert [(r["input"]["instruction"], r["chosen"], r["rejected"]) for r in pair] == [("Which one is better here?", "The first, as it is right.", "The other one, I guess.")]
    hugging = [r for side in ("train", "test") for r in read(f"huggingface_{side}.jsonl") if "chosen" in r]
    assert hugging[0]["prompt"] == "Which one is better here?" and hugging[0]["metadata"]["persona"] == "general"


def test_variants_ask_for_a_rewrite(spark):
    good, _ = ingest(raw(spark, [record(1, id="r1")]))
    assert variant_axes(good, ("general", "expert"), ("easy", "hard")).count() == 3


def test_scratch_needs_a_shared_folder_on_clusters(spark, monkeypatch, tmp_path):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext, conf = Context(), type("C", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_root(Session())
    with scratch.Scratch(spark) as s:
        kept, gone = s.put(spark.range(3).toDF("x"), keep=True), s.put(spark.range(2).toDF("x"))
        assert gone.count() == 2
        (path,) = s.made
    assert kept.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
