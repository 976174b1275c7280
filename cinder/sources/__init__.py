"""Scans: text lines, quoted CSV, tab-delimited typed tables, regex logs, external tables."""

from cinder.sources.tables import TABLE_NAMES, read_table  # noqa: F401
from cinder.sources.text import first_line, read_lines  # noqa: F401
