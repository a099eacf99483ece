"""Small parameter tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def literal_table(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A small parameter table built from literals inside the JVM (no Python
    worker at run time). ``schema`` is a DDL string such as ``"a int, b double"``."""
    from pyspark.sql.types import StructType

    struct = StructType.fromDDL(schema)
    fields = struct.fields
    if not rows:
        return spark.createDataFrame([], struct)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
