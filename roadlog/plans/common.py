"""Writing the outputs of an analysis."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from roadlog.sinks.tables import append_partitioned, append_table, write_bulk_file


@dataclass(frozen=True)
class Output:
    """One result: its rows, its document key, and how the table is partitioned.

    ``documents`` replaces the rows where the documents differ from the table;
    ``table`` is false for results that only exist as documents.
    """

    rows: DataFrame
    keys: Sequence[str]
    by: Sequence[str] = ()
    documents: DataFrame | None = None
    table: bool = True


def write_outputs(
    outputs: dict[str, Output],
    tables: str | None = None,
    bulk: str | None = None,
    replace_touched: bool = False,
    sep: str = "|",
) -> None:
    """Write each output as ``<tables>/<name>`` and as bulk lines ``<bulk>/<name>``."""
    for name, out in outputs.items():
        if tables and out.table:
            if out.by:
                append_partitioned(out.rows, f"{tables}/{name}", out.by, replace_touched)
            else:
                append_table(out.rows, f"{tables}/{name}")
        if bulk:
            docs = out.rows if out.documents is None else out.documents
            write_bulk_file(docs, f"{bulk}/{name}", out.keys, sep=sep)
