"""Every operator run over the benchmark tables, with the SQL that says the same."""

from roadlog.showcase import analysis, documents, ingest, nested, reports, state, streams, tables, versions  # noqa: F401
from roadlog.showcase.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
