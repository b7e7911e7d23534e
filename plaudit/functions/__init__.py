"""Column expressions (no DataFrames): sentiment, tokens, sampling."""

from plaudit.functions.sampling import hash_sample_predicate
from plaudit.functions.sentiment import NEGATIVE, POSITIVE, is_positive, sentiment
from plaudit.functions.text import (STOP_WORDS, clean_text, clean_tokens, is_kept_token,
                                     raw_tokens, token_candidates)

__all__ = [
    "NEGATIVE", "POSITIVE", "STOP_WORDS", "clean_text", "clean_tokens",
    "hash_sample_predicate", "is_kept_token", "is_positive", "raw_tokens", "sentiment",
    "token_candidates",
]
