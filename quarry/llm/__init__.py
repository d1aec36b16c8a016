"""Training-data operators: search, extraction, filtering, deduplication, output.

Each module holds one operator with its own general interface; ``queries``
binds them to the benchmark tables.  Nothing outside this package imports it.
"""
