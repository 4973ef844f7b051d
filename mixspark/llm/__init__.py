"""Training-data operators: tokenising, deduplication, sharding, scoring, packing.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries only where it can be imported.
"""
