"""Dotted paths into canonical records: top-level columns, response.*, and metadata kept as JSON text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.functions.text import blank, strip
from curlew.plans.plan import MISSING


def at(df: DataFrame, path: str) -> Column:
    """The value as a string (JSON text for arrays and objects), null where the path leads nowhere."""
    head, _, rest = path.partition(".")
    if head not in df.columns:
        return F.lit(None).cast("string")
    if not rest:
        kind = df.schema[head].dataType.typeName()
        return F.to_json(head) if kind in ("struct", "array", "map") else F.col(head).cast("string")
    kind = df.schema[head].dataType
    if kind.typeName() == "struct":
        return F.col(f"{head}.{rest}").cast("string") if rest in kind.names else F.lit(None).cast("string")
    if kind.typeName() == "string":
        return F.get_json_object(head, "$." + rest)
    return F.lit(None).cast("string")


def lookup(df: DataFrame, path: str) -> Column:
    """The value as a string: an empty one where the path leads nowhere, null for a null that is there."""
    head, _, rest = path.partition(".")
    if head not in df.columns:
        return F.lit("")
    if not rest:
        return at(df, path)
    if df.schema[head].dataType.typeName() != "string":
        return F.coalesce(at(df, path), F.lit(""))
    there = F.try_variant_get(F.try_parse_json(head), "$." + rest, "variant").isNotNull()
    return F.when(there, at(df, path)).otherwise(F.lit(""))


def values(df: DataFrame, path: str) -> Column:
    """A2: the path's values: a list's stripped non-missing items, a scalar as it is, MISSING for none."""
    raw = at(df, path)
    items = F.filter(F.transform(F.from_json(raw, "array<string>"), strip), lambda x: x.isNotNull() & (x != ""))
    listed = F.when(raw.startswith("["), items)
    none = F.array(F.lit(MISSING))
    return F.when(missing(df, path), none).when(listed.isNotNull(), F.when(F.size(listed) > 0, listed).otherwise(none)).otherwise(F.array(raw))


def missing(df: DataFrame, path: str) -> Column:
    """Null, blank, an empty object, or a list of missing items only; 0 and false are present."""
    raw = at(df, path)
    items = F.from_json(raw, "array<string>")
    empty_list = raw.startswith("[") & items.isNotNull() & ~F.exists(items, lambda x: ~blank(x))
    return blank(raw) | (raw == "{}") | F.coalesce(empty_list, F.lit(False))


def truthy(c: Column) -> Column:
    return c.isNotNull() & ~F.lower(c).isin("", "false", "0", "0.0", "[]", "{}", "null")


def first_present(columns: list[Column]) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def product(df: DataFrame, fields: list[str]) -> Column:
    """Joint buckets: the fields' values combined, joined by '::'."""
    lists = [values(df, f) for f in fields]
    step = lambda left, right: F.flatten(F.transform(left, lambda x: F.transform(right, lambda y: F.concat(x, F.lit("::"), y))))
    return reduce(step, lists)
