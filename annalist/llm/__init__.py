"""Training-data operators: filtering, deduplication, mixing and token output.

Nothing outside this subpackage imports it; the query registry adds its
queries only where it can be imported.
"""
