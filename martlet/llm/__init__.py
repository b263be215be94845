"""Training-data operators: scoring, cleaning, deduplication, formatting, mixing.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when it is present.
"""
