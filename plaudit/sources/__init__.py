"""Readers, column standardisation, sinks and review-shaped test views."""

from plaudit.sources.reviews import REVIEW_COLUMNS, read_reviews, standardize_columns
from plaudit.sources.sinks import materialize, write_corpus, write_key_values, write_table

__all__ = [
    "REVIEW_COLUMNS", "materialize", "read_reviews", "standardize_columns",
    "write_corpus", "write_key_values", "write_table",
]
