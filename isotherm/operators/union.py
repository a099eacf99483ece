"""Unions of reading parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.schemas import READINGS_SCHEMA


def align_columns(df: DataFrame, schema=READINGS_SCHEMA) -> DataFrame:
    """Select the target columns in order; absent ones become typed nulls, others drop."""
    present = set(df.columns)
    cols = [
        (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*cols)


def union_aligned(parts: list[DataFrame], schema=READINGS_SCHEMA) -> DataFrame:
    """Bag union of parts whose columns differ, aligned by name to ``schema``."""
    if not parts:
        raise ValueError("no parts to union")
    return reduce(DataFrame.unionByName, [align_columns(p, schema) for p in parts])


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Bag union of parts with identical column lists (name and order).

    Fails early, before any job runs, when a part's columns differ.
    """
    if not parts:
        raise ValueError("no parts to union")
    first = list(parts[0].columns)
    for i, p in enumerate(parts[1:], start=2):
        if list(p.columns) != first:
            raise ValueError(f"part {i} has columns {p.columns}, expected {first}")
    return reduce(DataFrame.union, parts)
