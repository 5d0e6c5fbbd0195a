"""Importing this module registers the queries of all operators of the subpackage."""

from casebook.llm import chat_format, decontaminate, exact_dedup, hard_negatives, html_extract, language, license_scan, ngram_join, packing, ranked_search, sharding, token_files, url_filter  # noqa: F401
from casebook.llm.common import ENTRIES  # noqa: F401
