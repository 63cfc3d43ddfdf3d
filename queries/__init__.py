"""Registered queries: each reads the given tables and has, where SQL can say it, a SQL twin."""

from . import (clusters, corpus_stats, files, learning, loading, scalars, streams, text_functions)  # noqa: F401
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
