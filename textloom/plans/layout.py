"""Tokenized Parquet whose files hold whole row groups: raw texts are moved once, then encoded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from textloom.functions.tokens import MAX_LENGTH, Codec
from textloom.operators.encoding import encode_records
from textloom.operators.slots import lay_out
from textloom.sources.catalog import ROW_GROUP_ROWS
from textloom.sources.sinks import write_records

# Rows of a file: whole row groups.
ROWS_PER_FILE = 100 * ROW_GROUP_ROWS


def write_tokenized(
    documents: DataFrame,
    codec: Codec,
    path: str,
    key: str,
    rows_per_file: int = ROWS_PER_FILE,
    marker: Column | None = None,
    keep: tuple[str, ...] = ("doc_id",),
    max_length: int = MAX_LENGTH,
) -> None:
    """Encode (text, language, dataset, phase, ...) into files of ``rows_per_file`` rows a dataset.

    ``key`` is a column that tells rows apart, such as ``place_of_row()`` of a scan. Filters belong before
    this call: each row of ``documents`` becomes a record.
    """
    laid = lay_out(documents, ["phase", "dataset"], key, rows_per_file)
    records = encode_records(laid, codec, marker=marker, keep=[*keep, "phase"], max_length=max_length)
    write_records(records, path, row_group_rows=min(ROW_GROUP_ROWS, rows_per_file), compact=False)
