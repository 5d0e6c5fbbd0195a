"""Batch analytics for incident-style event tables, written as plain Spark DataFrames."""

from casebook.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
