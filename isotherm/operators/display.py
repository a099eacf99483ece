"""Previews for interactive inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame

PREVIEW_ROWS = 100


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first ``n`` rows for a look.

    A limit is the feature here: it is only for looking at results.
    """
    return df.limit(n)
