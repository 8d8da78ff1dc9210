"""Training-data operators: tokenising, deduplication, scoring, filtering and mixing.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
when the package is present.
"""
