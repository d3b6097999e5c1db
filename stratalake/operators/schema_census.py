"""Schemas that JSON documents really have: one merged schema per group, its paths, and what changed between two of them."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"`(?:[^`]|``)*`|[^<>:,() ]+")


def schema_census(documents: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """``(keys, documents, unreadable, schema)``: the schema that all documents of a group share, partially merged in the map tasks.

    Types that do not fit together become VARIANT, a value that is always null is VOID. Null texts are not counted; texts that are no
    JSON are unreadable.
    """
    parsed = documents.filter(F.col(text).isNotNull()).select(*keys, F.try_parse_json(F.col(text)).alias("_v"))
    return parsed.groupBy(*keys).agg(
        F.count("*").alias("documents"), F.count_if(F.col("_v").isNull()).alias("unreadable"), F.schema_of_variant_agg("_v").alias("schema")
    )


def paths_of(schema: str | None) -> list[tuple[str, str]]:
    """``(path, type)`` of a merged schema: ``$`` is the document, ``.key`` a member, ``[]`` the elements; decimals of any size are alike."""
    out: list[tuple[str, str]] = []
    at = 0

    def word() -> str:
        nonlocal at
        found = _WORD.match(schema, at)
        at = found.end()
        return found[0]

    def skip(sign: str) -> bool:
        nonlocal at
        if schema.startswith(sign, at):
            at += len(sign)
            return True
        return False

    # Open containers from the outside in; their members are read in place, so depth costs no stack.
    open_: list[tuple[str, str]] = []
    path = "$"
    while schema:
        kind = word()
        out.append((path, kind))
        if kind == "DECIMAL" and skip("("):
            at = schema.index(")", at) + 1
        if kind in ("OBJECT", "ARRAY") and skip("<"):
            if kind == "ARRAY":
                open_.append((kind, path))
                path += "[]"
                continue
            if not skip(">"):
                open_.append((kind, path))
                path = f"{path}.{word().strip('`').replace('``', '`')}"
                skip(": ")
                continue
        while open_ and skip(">"):
            open_.pop()
        if not open_ or not skip(", "):
            break
        path = f"{open_[-1][1]}.{word().strip('`').replace('``', '`')}"
        skip(": ")
    return out


def schema_paths(census: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, path, type)``: one row per path of each group's schema."""
    fields = [census.schema[k] for k in keys]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "paths array<struct<path:string,type:string>>"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[list(keys)].assign(paths=[[{"path": p, "type": t} for p, t in paths_of(s)] for s in batch["schema"]])

    return census.select(*keys, "schema").mapInPandas(read, schema).select(*keys, F.inline("paths"))


def schema_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, path, change, old_type, new_type)``: added, removed and retyped paths between two tables ``(keys, path, type)``.

    Below an added or removed path every path is listed.
    """
    by = [*keys, "path"]
    old = before.select(*by, F.col("type").alias("old_type"))
    new = after.select(*by, F.col("type").alias("new_type"))
    kind: Column = F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed").when(F.col("old_type") != F.col("new_type"), "retyped")
    both = old.join(new, by, "full_outer").withColumn("change", kind)
    return both.filter("change is not null").select(*by, "change", "old_type", "new_type")
