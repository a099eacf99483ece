"""Operators: DataFrame -> DataFrame transformations (cleaning, aggregates, windows, joins)."""
