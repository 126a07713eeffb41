"""Training-data operations (packing, dedup, filtering, sharding) on DataFrames.

Nothing outside this subpackage imports it; queries are registered by
``llm.queries``.
"""
