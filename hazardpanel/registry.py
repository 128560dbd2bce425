"""All registered queries: importing this module registers every key."""

from hazardpanel import queries_io, queries_model, queries_more, queries_stream  # noqa: F401
from hazardpanel.queries import ORACLE, QUERIES, entry_query

__all__ = ["ORACLE", "QUERIES", "entry_query"]
