"""Training-data operators: sharding, mixing, packing, scoring, near-duplicates, archives.

Nothing outside this subpackage imports it. ``queries()`` and ``oracle_sql()``
live in :mod:`docmeter.llm.registry`.
"""
