"""Readers and writers."""

from insight.sources.tables import read_table, TABLES  # noqa: F401
from insight.sources.delimited import (  # noqa: F401
    NA_TOKENS, read_delimited, read_headerless, normalise_na, infer_types,
)
from insight.sources.textfile import read_lines, write_lines  # noqa: F401
