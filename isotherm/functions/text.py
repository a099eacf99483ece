"""Line splitting with native expressions (no Python worker)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One CSV field after its comma: a quoted field ("" escapes a quote) or a
# run of non-commas. The line gets a leading comma, so every match consumes
# one comma and is never empty (an empty match would make the scanner skip a
# character). Possessive quantifiers keep the match linear in the line length.
_CSV_FIELD = r',("(?:[^"]|"")*+"|[^,]*+)'


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def csv_fields(line: str | Column) -> Column:
    """Array of the unquoted fields of one CSV line; trailing empty fields kept.

    Commas inside quotes do not split. Line breaks inside quotes are not
    supported (each physical line is one record).
    """
    raw = F.regexp_extract_all(F.concat(F.lit(","), _col(line)), F.lit(_CSV_FIELD), F.lit(1))
    return F.transform(
        raw,
        lambda x: F.when(
            (F.length(x) >= 2) & x.startswith('"') & x.endswith('"'),
            F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(x),
    )


def whitespace_tokens(line: str | Column) -> Column:
    """Split on runs of whitespace after stripping both ends (like ``str.split()``)."""
    stripped = F.regexp_replace(_col(line), r"^\s+|\s+$", "")
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, r"\s+"))
