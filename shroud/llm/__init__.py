"""Operators of a training-data pipeline (filtering, dedup, mixing, search, output).

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
when it is present.
"""
