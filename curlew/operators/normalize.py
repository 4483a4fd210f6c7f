"""Raw records to canonical ones (N1 to N10), as projections over JSON text."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.functions.paths import first_present, truthy
from curlew.functions.text import strip

INSTRUCTION = ("instruction", "prompt", "query", "question", "task")
CONTEXT = ("context", "input", "background", "system", "notes")
RESPONSE = ("response", "output", "answer", "completion", "assistant")
DIFFICULTY, PERSONA = ("difficulty", "level"), ("persona", "role", "speaker")
REAL_WORLD = ("url_reference", "internet_research")
RECORD = ["id", "task_type", "instruction", "context", "response", "metadata", "pipeline_status", "status", "run_id", "source_type", "source_uri", "raw_payload", "judge_score", "judge_reason", "error_message", "seq"]
RESPONSE_TYPE = "struct<format:string,text:string,chosen:string,rejected:string>"


def _get(name: str, kind: str = "string") -> Column:
    return F.try_variant_get("_v", f"$.{name}", kind)


def _pick(names: tuple[str, ...], default: str = "") -> Column:
    return F.coalesce(first_present([_get(n) for n in names]), F.lit(default))


def messages(turns: Column) -> Column:
    """array<struct<role,content>> in order → struct(instruction, context, text).

    The context holds system turns, then other roles as `role: text`, then earlier user and assistant turns.
    """
    content = lambda t: F.coalesce(t["content"], F.lit(""))
    by_role = lambda role: F.filter(turns, lambda t: t["role"] == role)
    last = lambda a: F.coalesce(strip(content(F.get(a, F.size(a) - 1))), F.lit(""))
    earlier = lambda a, role: F.transform(F.filter(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), lambda t: strip(content(t)) != ""), lambda t: F.concat(F.lit(f"{role}: "), content(t)))
    user, assistant = by_role("user"), by_role("assistant")
    role = lambda t: F.coalesce(t["role"], F.lit(""))
    system = F.filter(F.transform(by_role("system"), lambda t: strip(content(t))), lambda s: s != "")
    others = F.transform(F.filter(turns, lambda t: ~role(t).isin("system", "user", "assistant") & (strip(content(t)) != "")), lambda t: F.concat(role(t), F.lit(": "), strip(content(t))))
    context = strip(F.array_join(F.concat(system, others, earlier(user, "user"), earlier(assistant, "assistant")), "\n"))
    return F.struct(last(user).alias("instruction"), context.alias("context"), last(assistant).alias("text"))


def origin(source_type: Column) -> Column:
    """N6."""
    return F.when(source_type.isin(*REAL_WORLD), "real_world").when(source_type == "generated", "synthetic").otherwise("unknown")


def tag_list(tags: Column) -> Column:
    """Comma-separated text to an array of trimmed items."""
    return F.filter(F.transform(F.split(tags, ","), strip), lambda t: t != "")


def content_id(payload: dict) -> str:
    """A stable id of a record's content: 16 hex digits of the hash of its key-sorted ASCII JSON."""
    return "rec_" + hashlib.sha256(json.dumps(payload, sort_keys=True).encode()).hexdigest()[:16]


def record_ids(task: Column, instruction: Column, context: Column, response: Column) -> Column:
    """N7 over columns; byte parity with the JSON text needs Python, so it is an Arrow function."""

    @F.pandas_udf("string")
    def run(t: pd.Series, i: pd.Series, c: pd.Series, r: pd.DataFrame) -> pd.Series:
        out = []
        for k in range(len(t)):
            fields = {f: r[f].iloc[k] for f in ("format", "text", "chosen", "rejected")}
            out.append(content_id({"task_type": t.iloc[k], "instruction": i.iloc[k], "context": c.iloc[k], "response": {f: x for f, x in fields.items() if x is not None}}))
        return pd.Series(out)

    return run(task, instruction, context, response)


def record_text(df: DataFrame | None = None) -> Column:
    """Instruction, context and response on lines of their own; empty parts keep their line."""
    blank = F.lit("")
    answer = F.when(F.col("response.format") == "preference_pair", F.concat_ws("\n", F.coalesce("response.chosen", blank), F.coalesce("response.rejected", blank))).otherwise(F.coalesce("response.text", blank))
    return strip(F.concat_ws("\n", F.coalesce("instruction", blank), F.coalesce("context", blank), answer))


def infer_status(response: Column) -> Column:
    """Drafts are seeded, all else is raw_generated."""
    return F.when(F.coalesce(response["text"], response["chosen"], F.lit("")).startswith("[PENDING_"), "seeded").otherwise("raw_generated")


def coerce_metadata(source_type: str) -> Column:
    """Metadata with its defaults, as JSON text; all other keys stay as they are."""
    given = F.coalesce(F.from_json(F.to_json(_get("metadata", "variant")), "map<string,variant>"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>")))
    var = lambda c: F.parse_json(F.to_json(F.struct(c.alias("x"))))
    value = lambda c: F.variant_get(var(c), "$.x", "variant")
    known = F.coalesce(_get("source_type"), F.lit(source_type))
    old_origin = _get("metadata.source_origin")
    tags = _get("metadata.tags")
    listed = F.to_json(_get("metadata.tags", "variant")).startswith("[")
    # each default is an optional one-entry map that keys already given are laid over
    put = lambda key, c: F.map_from_arrays(F.array(F.lit(key)), F.array(value(c)))
    lay = lambda low, high: F.map_concat(F.map_filter(low, lambda k, v: ~F.map_contains_key(high, k)), high)
    m = given
    for key, c in (("difficulty", _pick(DIFFICULTY, "unspecified")), ("persona", _pick(PERSONA, "general")), ("source_type", known)):
        m = lay(put(key, c), m)
    no_origin = old_origin.isNull() | (old_origin == "")
    m = F.when(no_origin, lay(put("source_origin_inferred", F.lit(True)), lay(F.map_filter(m, lambda k, v: k != "source_origin"), put("source_origin", origin(F.lit(source_type)))))).otherwise(m)
    new_tags = F.when(listed, None).when(tags.isNotNull(), tag_list(tags)).otherwise(F.array().cast("array<string>"))
    return F.to_json(F.when(new_tags.isNull(), m).otherwise(lay(F.map_filter(m, lambda k, v: k != "tags"), put("tags", new_tags))))


def normalize(raw: DataFrame, task_type: str = "sft", source_type: str = "manual") -> DataFrame:
    """(raw: JSON text of an object, seq) → canonical records, dispatched on the shape of each record.

    Rows whose JSON can't be read, or repeats a key, have null task_type; `rejected` splits them off.
    """
    df = raw.select("raw", "seq", F.try_parse_json("raw").alias("_v"))
    shape = lambda name: F.substring(F.to_json(_get(name, "variant")), 1, 1)
    nested = F.coalesce(shape("response") == "{", F.lit(False))
    has = lambda name: F.array_contains(F.json_object_keys("raw"), name)
    pair = ~nested & F.coalesce(has("chosen") & has("rejected"), F.lit(False))
    chat = ~nested & ~pair & F.coalesce(shape("messages") == "[", F.lit(False))
    turns = messages(F.from_json(F.to_json(_get("messages", "variant")), "array<struct<role:string,content:string>>"))
    text = lambda c: F.coalesce(c, F.lit(""))
    none = F.lit(None).cast("string")
    answer = lambda form, t=none, c=none, r=none: F.struct(F.lit(form).alias("format") if isinstance(form, str) else form.alias("format"), t.alias("text"), c.alias("chosen"), r.alias("rejected"))
    out = df.withColumn("_turns", F.when(chat, turns))
    response = (
        F.when(nested, answer(_get("response.format"), _get("response.text"), _get("response.chosen"), _get("response.rejected")))
        .when(pair, answer("preference_pair", none, strip(text(_get("chosen"))), strip(text(_get("rejected")))))
        .when(chat, answer("single", F.col("_turns.text")))
        .otherwise(answer("single", strip(_pick(RESPONSE))))
    )
    instruction = F.when(nested, strip(text(_get("instruction")))).when(chat, F.col("_turns.instruction")).otherwise(strip(_pick(INSTRUCTION)))
    context = F.when(nested, text(_get("context"))).when(chat, F.col("_turns.context")).otherwise(_pick(CONTEXT))
    kind = F.when(pair, F.lit("dpo")).otherwise(F.coalesce(_get("task_type"), F.lit(task_type)))
    out = out.select(
        text(_get("id")).alias("id"),
        F.when(F.col("_v").isNotNull(), kind).alias("task_type"),
        instruction.alias("instruction"),
        context.alias("context"),
        response.alias("response"),
        coerce_metadata(source_type).alias("metadata"),
        F.coalesce(_get("pipeline_status"), F.lit("pending")).alias("pipeline_status"),
        F.coalesce(_get("status"), F.lit("pending")).alias("status"),
        _get("run_id").alias("run_id"),
        F.coalesce(_get("source_type"), F.lit(source_type)).alias("source_type"),
        first_present([_get("source_uri"), _get("url")]).alias("source_uri"),
        F.col("raw").alias("raw_payload"),
        F.expr("try_cast(try_variant_get(_v, '$.judge_score', 'string') AS int)").alias("judge_score"),
        _get("judge_reason").alias("judge_reason"),
        _get("error_message").alias("error_message"),
        "seq",
    )
    return out


def allows(metadata: Column, raw: Column) -> Column:
    """The record or its metadata says that injection text is wanted."""
    return truthy(F.get_json_object(raw, "$.allow_injections")) | truthy(F.get_json_object(metadata, "$.allow_injections"))


def with_ids(records: DataFrame) -> DataFrame:
    """Fills empty ids from the record's (sanitised) content."""
    made = record_ids(F.col("task_type"), F.col("instruction"), F.col("context"), F.col("response"))
    return records.withColumn("id", F.when(F.col("id") == "", made).otherwise(F.col("id")))


def seeds(spark, topic: str, count: int = 500, task_type: str = "sft", source_type: str = "generated") -> DataFrame:
    """Placeholder records 1 to count for a topic."""
    pair = task_type == "dpo"
    answer = {"format": "preference_pair", "chosen": "[PENDING_CHOSEN_RESPONSE]", "rejected": "[PENDING_REJECTED_RESPONSE]"} if pair else {"format": "single", "text": "[PENDING_RESPONSE]"}
    lit = lambda x: F.lit(x).cast("string")
    response = F.struct(*[lit(answer.get(f)).alias(f) for f in ("format", "text", "chosen", "rejected")])
    instruction = F.concat(F.lit("Create dataset example "), F.col("seq").cast("string"), F.lit(f" for topic: {topic}"))

    @F.pandas_udf("string")
    def ids(i: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([content_id({"task_type": task_type, "instruction": a, "context": "", "response": answer, "seed_index": int(b)}) for a, b in zip(i, k, strict=True)])

    meta = F.to_json(F.struct(F.lit("unspecified").alias("difficulty"), F.lit("general").alias("persona"), F.lit(topic).alias("topic"), F.col("seq").alias("seed_index"), F.lit("seed").alias("draft_state"), F.lit(source_type).alias("source_type"), F.array().cast("array<string>").alias("tags")))
    base = spark.range(1, count + 1).select(F.col("id").alias("seq")).withColumn("instruction", instruction)
    return base.select(ids("instruction", "seq").alias("id"), F.lit(task_type).alias("task_type"), "instruction", F.lit("").alias("context"), response.alias("response"), meta.alias("metadata"), F.lit("pending").alias("pipeline_status"), F.lit("seeded").alias("status"), lit(None).alias("run_id"), F.lit(source_type).alias("source_type"), lit(None).alias("source_uri"), lit(None).alias("raw_payload"), F.lit(None).cast("int").alias("judge_score"), lit(None).alias("judge_reason"), lit(None).alias("error_message"), "seq")
