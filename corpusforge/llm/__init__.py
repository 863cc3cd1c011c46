"""Operators of a large-scale training-data pipeline, with their queries.

Nothing else in the library imports this subpackage; it imports only general helpers
(session, portable hash, schema compiler).  One module per operator; ``catalog`` holds the
registered queries and ``oracles`` their DuckDB twins.
"""
