"""Fixtures that every operator is tried on, and readers of results."""

from __future__ import annotations

EDGE_TEXTS = [
    None,
    "",
    " \t\n",
    "One short line.",
    "ONE short line.",
    "One short line.",
    "12345 67890",
    "the of and " * 4000,
    "é" * 9000 + " fin",
    "<|endoftext|> inside  <|endoftext|>",
]


def edge_documents(spark):
    """Null key and columns, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, "s", 0, "x", 1, "t") for i, t in enumerate(EDGE_TEXTS)]
    rows += [(3, EDGE_TEXTS[3], None, None, None, None, None, None), (None, "Without a key at all.", "en", "s", 1, "y", 2, "u")]
    rows += [rows[4], (40, "A text that nothing else has, with words of its own.", "en", "s", 1, "y", 2, "u")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, TEXT string, row_id long, _key string")


def documents(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def empty(df):
    return df.limit(0)


def by_key(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}
