"""Metadata variants of records for rewriting."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.operators.normalize import content_id, normalize, with_ids
from curlew.operators.sanitize import sanitize

PERSONAS = ("beginner", "practitioner", "expert")
DIFFICULTIES = ("easy", "medium", "hard")


def variant_axes(base: DataFrame, personas=PERSONAS, difficulties=DIFFICULTIES, limit: int | None = None) -> DataFrame:
    """G1: each record with every (persona, difficulty) but its own; the axes are short literal lists."""
    if limit is not None:
        base = base.orderBy("seq").limit(limit)
    axes = F.array(*[F.struct(F.lit(p).alias("persona"), F.lit(d).alias("difficulty")) for p in personas for d in difficulties])
    out = base.withColumn("_axis", F.explode(axes))
    same = F.col("_axis.persona").eqNullSafe(F.get_json_object("metadata", "$.persona")) & F.col("_axis.difficulty").eqNullSafe(F.get_json_object("metadata", "$.difficulty"))
    return out.filter(~same)


def metadata_variants(base: DataFrame, personas=PERSONAS, difficulties=DIFFICULTIES, limit: int | None = None) -> DataFrame:
    out = variant_axes(base, personas, difficulties, limit)

    @F.pandas_udf("struct<id:string,metadata:string>")
    def made(parent: pd.Series, axis: pd.DataFrame, i: pd.Series, r: pd.DataFrame, m: pd.Series) -> pd.DataFrame:
        import json

        rows = []
        for k in range(len(parent)):
            p, d = axis["persona"].iloc[k], axis["difficulty"].iloc[k]
            answer = {f: r[f].iloc[k] for f in ("format", "text", "chosen", "rejected") if r[f].iloc[k] is not None}
            meta = json.loads(m.iloc[k] or "{}") | {"persona": p, "difficulty": d, "augmentation_mode": "metadata_variant", "parent_id": parent.iloc[k], "rewrite_required": True}
            rows.append((content_id({"parent_id": parent.iloc[k], "persona": p, "difficulty": d, "instruction": i.iloc[k], "response": answer}), json.dumps(meta)))
        return pd.DataFrame(rows, columns=["id", "metadata"])

    out = out.withColumn("_made", made("id", "_axis", "instruction", "response", "metadata"))
    return out.withColumns({"id": F.col("_made.id"), "metadata": F.col("_made.metadata"), "status": F.lit("augmented"), "pipeline_status": F.lit("rewrite")}).drop("_made", "_axis")


def import_augmented(raw: DataFrame, **options) -> DataFrame:
    """Outside rewrites, normalised, with status augmented whatever they say."""
    return with_ids(sanitize(normalize(raw, **options))).withColumn("status", F.lit("augmented"))
