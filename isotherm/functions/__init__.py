"""Column expressions built only from Spark's native functions (no Python UDFs)."""

from isotherm.functions.calendar import month_of, season_of, year_of
from isotherm.functions.geo import grid_cell, in_rectangle
from isotherm.functions.means import exact_mean, hundredths, mean_of_hundredths
from isotherm.functions.temperature import celsius_if_fahrenheit, in_valid_range, outlier_reason
from isotherm.functions.text import csv_fields, whitespace_tokens

__all__ = [
    "celsius_if_fahrenheit",
    "csv_fields",
    "exact_mean",
    "grid_cell",
    "hundredths",
    "in_rectangle",
    "in_valid_range",
    "mean_of_hundredths",
    "month_of",
    "outlier_reason",
    "season_of",
    "whitespace_tokens",
    "year_of",
]
