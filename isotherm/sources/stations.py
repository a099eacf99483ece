"""Station list: one station per text line, parsed with native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.functions.text import whitespace_tokens
from isotherm.schemas import GSN_TOKEN, STATION_COLUMNS


def read_station_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line (column ``value``); any Hadoop path or glob."""
    return spark.read.text(path)


def parse_station_tokens(tokens: Column) -> list[Column]:
    """Columns of the station schema from the whitespace tokens of one line.

    Tokens 1-4 are id, latitude, longitude, elevation. Then, looking at the
    whole token list: a last token of digits only is the HCN/CRN flag and is
    removed; a last token equal to GSN is then the GSN flag and is removed;
    the tokens after the fourth that remain, joined by single spaces, are
    the name. Numbers that do not parse become null.
    """
    n = F.size(tokens)
    last = F.element_at(tokens, F.greatest(n, F.lit(1)))
    has_hcn = (n >= 1) & last.rlike("^[0-9]+$")
    m = n - has_hcn.cast("int")
    before = F.when(m >= 1, F.element_at(tokens, F.greatest(m, F.lit(1))))
    has_gsn = F.coalesce(before == F.lit(GSN_TOKEN), F.lit(False))
    k = m - has_gsn.cast("int")
    name = F.when(k > 4, F.array_join(F.slice(tokens, 5, F.greatest(k - 4, F.lit(0))), " ")).otherwise(F.lit(""))
    return [
        F.get(tokens, 0).alias("station_id"),
        F.get(tokens, 1).try_cast("double").alias("latitude"),
        F.get(tokens, 2).try_cast("double").alias("longitude"),
        F.get(tokens, 3).try_cast("double").alias("elevation"),
        name.alias("station_name"),
        F.when(has_gsn, F.lit(GSN_TOKEN)).alias("GSN_flag"),
        F.when(has_hcn, last).alias("HCN_CRN_flag"),
    ]


def parse_station_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse a frame of text lines into the station schema; blank lines are dropped."""
    toks = lines.select(whitespace_tokens(column).alias("_tokens")).filter(F.size("_tokens") > 0)
    return toks.select(*parse_station_tokens(F.col("_tokens"))).select(*STATION_COLUMNS)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return parse_station_lines(read_station_lines(spark, path))
