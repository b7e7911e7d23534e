"""Word counts, cleaned corpora and word-cloud weights.

Vocabulary is unbounded, so nothing here sorts or collects all words: counts
are a partial-aggregated ``groupBy(word)`` (a very frequent word costs one row
per map task in the shuffle) and only top-k lists sort, via ``limit``. Lists
straight from the reviews don't shuffle the vocabulary either (``topk``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plaudit.functions.sentiment import sentiment as sentiment_expr
from plaudit.functions.text import (MIN_TOKEN_LENGTH, clean_text, is_kept_token, raw_tokens,
                                   token_candidates)
from plaudit.operators.clean import sample_reviews
from plaudit.operators.topk import exact_top

# FIXED VALUES — word-cloud settings of the original job.
TOP_WORDS_N = 15
MIN_FREQ_BY_SENTIMENT = 3
MIN_FREQ_ALL = 5
CLOUD_WORDS_BY_SENTIMENT = 100
CLOUD_WORDS_ALL = 150
TEXT_SAMPLE_FRACTION = 0.1


def word_counts(df: DataFrame) -> DataFrame:
    """Raw (word, count): split on whitespace runs, case and punctuation kept,
    no stop words; empty tokens from edge whitespace are counted (F1)."""
    words = df.select(F.explode(raw_tokens("review_text")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def top_words(wc: DataFrame, n: int = TOP_WORDS_N) -> DataFrame:
    return wc.orderBy(F.col("count").desc(), F.col("word").asc()).limit(n)


def most_frequent_words(df: DataFrame, n: int = TOP_WORDS_N) -> DataFrame:
    """``top_words(word_counts(df), n)`` without shuffling the vocabulary."""
    words = df.select(F.explode(raw_tokens("review_text")).alias("word"))
    return exact_top(words, "word", n).withColumnRenamed("freq", "count")


def cleaned_corpus(df: DataFrame, fraction: float | None = None, seed: int = 42,
                   sample_keys=None, rule: str = "equals_one", threshold=None) -> DataFrame:
    """(sentiment, clean_text) per review (F5); optionally a hash sample of
    the reviews first (the original uses 10 %)."""
    src = sample_reviews(df, fraction, sample_keys, seed) if fraction else df
    return src.select(sentiment_expr("review_score", rule, threshold).alias("sentiment"),
                      clean_text("review_text").alias("clean_text"))


def sentiment_words(df: DataFrame, fraction: float | None = None, seed: int = 42,
                    sample_keys=None, rule: str = "equals_one", threshold=None) -> DataFrame:
    """(sentiment, word): every cleaned token."""
    src = sample_reviews(df, fraction, sample_keys, seed) if fraction else df
    words = src.select(sentiment_expr("review_score", rule, threshold).alias("sentiment"),
                       F.explode(token_candidates("review_text")).alias("word"))
    return words.filter(is_kept_token("word"))


def sentiment_word_counts(df: DataFrame, fraction: float | None = None, seed: int = 42,
                          sample_keys=None, rule: str = "equals_one",
                          threshold=None) -> DataFrame:
    """(sentiment, word, freq) of cleaned tokens: one tokenising pass that
    serves the per-sentiment and the overall word frequencies."""
    words = sentiment_words(df, fraction, seed, sample_keys, rule, threshold)
    return words.groupBy("sentiment", "word").agg(F.count(F.lit(1)).alias("freq"))


def word_freq_from_counts(swc: DataFrame, sentiment: str | None = None,
                          min_freq: int | None = None) -> DataFrame:
    """(word, freq) for one sentiment or all, from ``sentiment_word_counts``;
    keeps words seen at least ``min_freq`` times (default 3 for one
    sentiment, 5 for all) and longer than two characters."""
    if min_freq is None:
        min_freq = MIN_FREQ_ALL if sentiment is None else MIN_FREQ_BY_SENTIMENT
    if sentiment is not None:
        freq = swc.filter(F.col("sentiment") == F.lit(sentiment)).select("word", "freq")
    else:
        freq = swc.groupBy("word").agg(F.sum("freq").alias("freq"))
    return freq.filter((F.col("freq") >= min_freq) & (F.length("word") >= MIN_TOKEN_LENGTH))


def cleaned_word_freq(df: DataFrame, sentiment: str | None = None, min_freq: int | None = None,
                      fraction: float | None = None, seed: int = 42, sample_keys=None,
                      rule: str = "equals_one", threshold=None) -> DataFrame:
    """(word, freq) of cleaned tokens, for one sentiment or all.

    Keeps words seen at least ``min_freq`` times (default 3 for one
    sentiment, 5 for all) and longer than two characters. The sentiment
    filter is pushed below the aggregate by Catalyst.
    """
    swc = sentiment_word_counts(df, fraction, seed, sample_keys, rule, threshold)
    return word_freq_from_counts(swc, sentiment, min_freq)


def cloud_weights(freq: DataFrame, max_words: int = CLOUD_WORDS_ALL) -> DataFrame:
    """(word, freq, weight): the ``max_words`` most frequent words (ties by
    word), weight = freq / largest freq (F7). The window runs over at most
    ``max_words`` rows left by the limit."""
    top = freq.orderBy(F.col("freq").desc(), F.col("word").asc()).limit(max_words)
    return top.select("word", "freq",
                      (F.col("freq") / F.max("freq").over(Window.partitionBy())).alias("weight"))


def cloud_words(df: DataFrame, sentiment: str | None = None, max_words: int | None = None,
                min_freq: int | None = None, fraction: float | None = None, seed: int = 42,
                sample_keys=None, rule: str = "equals_one", threshold=None) -> DataFrame:
    """``cloud_weights`` of ``cleaned_word_freq`` without shuffling the
    vocabulary (F7); the limits default as theirs do for one sentiment or all."""
    if min_freq is None:
        min_freq = MIN_FREQ_ALL if sentiment is None else MIN_FREQ_BY_SENTIMENT
    if max_words is None:
        max_words = CLOUD_WORDS_ALL if sentiment is None else CLOUD_WORDS_BY_SENTIMENT
    words = sentiment_words(df, fraction, seed, sample_keys, rule, threshold)
    if sentiment is not None:
        words = words.filter(F.col("sentiment") == F.lit(sentiment))
    words = words.filter(F.length("word") >= MIN_TOKEN_LENGTH)
    return cloud_weights(exact_top(words, "word", max_words, min_freq), max_words)
