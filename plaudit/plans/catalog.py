"""Registered queries: one per operator instance, each with a DuckDB oracle.

Each entry maps a name to ``(spark_query, oracle_sql)``. ``spark_query`` takes
``(spark, sf_dir)`` and returns a DataFrame built from the review-shaped views
of the provided tables (``plaudit.sources.fixtures``); ``oracle_sql`` is the
same computation written independently in SQL for DuckDB over the raw tables,
with the limits and names of the original written out there. Floating results
whose last bits depend on summation order are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.functions.text import STOP_WORDS
from plaudit.operators import clean as C
from plaudit.operators import games as G
from plaudit.operators import scale as SC
from plaudit.operators import stats as ST
from plaudit.operators import text as TX
from plaudit.sources import fixtures as FX
from plaudit.sources.reviews import read_reviews, standardize_columns
from plaudit.sources.sinks import run_folder, write_corpus, write_key_values, write_table

Query = Callable[[SparkSession, str], DataFrame]

DP = 6        # decimals kept for order-dependent float results
DP_DENSITY = 12

# --------------------------------------------------------------------------
# Oracle fixtures (FIXTURES.md), as SQL subqueries over the raw tables.
# --------------------------------------------------------------------------

SQL_R = """SELECT d.doc_id AS row_id, CAST(substr(d.source, 4) AS BIGINT) AS game_id, d.source AS game,
       d.lang AS app_name, d.text AS review_text,
       CAST(l.quality AS DOUBLE) AS review_score, CAST(l.toxic AS DOUBLE) AS review_votes
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

SQL_D = """SELECT doc_id AS row_id, CAST(0 AS BIGINT) AS game_id, lang AS game, lang AS app_name,
       text AS review_text, CAST(doc_id % 2 AS DOUBLE) AS review_score, CAST(0 AS DOUBLE) AS review_votes
FROM documents"""

SQL_S = """SELECT l.l_orderkey * 10 + l.l_linenumber AS row_id, l.l_partkey AS game_id,
       concat('part', CAST(l.l_partkey AS VARCHAR)) AS game, p.p_brand AS app_name,
       CAST('' AS VARCHAR) AS review_text,
       CASE WHEN l.l_discount = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS review_score,
       l.l_quantity AS review_votes
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""

SQL_E = """SELECT event_id AS row_id, user_id AS game_id, concat('user', CAST(user_id AS VARCHAR)) AS game,
       event_type AS app_name, props AS review_text,
       CASE WHEN event_type = 'purchase' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS review_score,
       value AS review_votes
FROM events"""

SQL_O5 = "SELECT CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS review_score FROM orders"
SQL_O10 = "SELECT l_quantity AS review_score FROM lineitem WHERE l_quantity <= 10"
SQL_OW = "SELECT l_quantity AS review_score FROM lineitem"
SQL_O0 = SQL_O5 + " WHERE o_totalprice < 0"  # empty, but data-dependent


def sql_cleaned(src: str) -> str:
    """clean_reviews(order_by='row_id') in SQL."""
    return f"""SELECT * FROM (
  SELECT row_id, game_id, game, app_name, trim(review_text) AS review_text, review_score, review_votes
  FROM ({src}) s0) s1
WHERE review_text IS NOT NULL AND length(review_text) > 0
  AND review_score IS NOT NULL AND NOT isnan(review_score)
QUALIFY row_number() OVER (PARTITION BY game_id, review_text ORDER BY row_id) = 1"""


def with_ctes(body: str, **ctes: str) -> str:
    parts = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes.items())
    return f"WITH {parts}\n{body}"


SENT_SQL = "CASE WHEN review_score = 1 THEN 'positive' ELSE 'negative' END"
POS_SQL = "coalesce(review_score = 1, false)"
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
JAVA_WS = r"[ \t\n\x0B\f\r]+"   # java.util.regex \s (ASCII, with vertical tab)
TOKENS_SQL = (
    r"list_filter(string_split_regex(regexp_replace(lower(coalesce(review_text, '')), "
    r"'[^a-zA-Z\s]', ' ', 'g'), '\s+'), lambda t: length(t) >= 3 AND NOT list_contains("
    + STOP_SQL + ", t))"
)


def _r(spark, sf):
    return FX.reviews_r(spark, sf)


def _rc(spark, sf):
    return C.clean_reviews(FX.reviews_r(spark, sf), order_by="row_id")


def _s(spark, sf):
    return FX.reviews_s(spark, sf)


def _e(spark, sf):
    return FX.reviews_e(spark, sf)


def _round(df: DataFrame, digits: int = DP, *cols: str) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# --------------------------------------------------------------------------
# A: readers and sinks, as round trips through the shared checkpoint folder
# --------------------------------------------------------------------------

@register("csv_round_trip", f"""SELECT CAST(game_id AS VARCHAR) AS game_id, game, app_name, review_text,
  review_score, review_votes FROM ({SQL_R}) r""")
def q_csv_round_trip(spark, sf):
    """A1, A2: reviews written as CSV under the original header (quoted
    newlines included), read and standardised."""
    path = f"{run_folder(spark)}/reviews"
    src = FX.reviews_r(spark, sf).select(
        F.col("game_id").alias("Game ID"), "app_name", F.col("game").alias("Game Name"),
        "review_text", "review_score", "review_votes")
    (src.write.option("header", True).option("escape", '"').option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return standardize_columns(read_reviews(spark, path)).select(
        "game_id", "game", "app_name", "review_text", "review_score", "review_votes")


@register("quoted_split_csv_round_trip", f"""SELECT CAST(game_id AS VARCHAR) AS game_id, game, app_name, review_text,
  review_score, review_votes FROM ({SQL_R}) r""")
def q_quoted_split_csv_round_trip(spark, sf):
    """A1: quoted newlines, read by byte ranges of a file."""
    path = f"{run_folder(spark)}/reviews"
    src = FX.reviews_r(spark, sf).select("game_id", "game", "app_name", "review_text", "review_score", "review_votes")
    (src.write.option("header", True).option("escape", '"').option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return standardize_columns(read_reviews(spark, path, split=True))


@register("split_csv_round_trip", f"""SELECT CAST(game_id AS VARCHAR) AS game_id, game, review_score
FROM ({SQL_S}) s""")
def q_split_csv_round_trip(spark, sf):
    """A1: text without newlines, read by the splittable reader."""
    path = f"{run_folder(spark)}/reviews"
    src = _s(spark, sf).select(F.col("game_id").alias("app_id"), F.col("game").alias("Game Name"), "review_score")
    write_table(src, path, "csv")
    return standardize_columns(read_reviews(spark, path, multiline=False)).select("game_id", "game", "review_score")


@register("table_sinks", with_ctes(
    """SELECT 'csv' AS format, game, count(*) AS review_count FROM s GROUP BY game
UNION ALL SELECT 'parquet', game, count(*) FROM s GROUP BY game""", s=SQL_S))
def q_table_sinks(spark, sf):
    """A3: a result table through the CSV and the parquet sink."""
    folder = run_folder(spark)
    counts = G.review_counts(_s(spark, sf)).select("game", "review_count")
    parts = []
    for fmt in ("csv", "parquet"):
        write_table(counts, f"{folder}/{fmt}", fmt)
        back = spark.read.schema(counts.schema).option("header", True).format(fmt).load(f"{folder}/{fmt}")
        parts.append(back.select(F.lit(fmt).alias("format"), "game", "review_count"))
    return parts[0].unionByName(parts[1])


@register("corpus_sink", with_ctes(
    f"SELECT {SENT_SQL} AS sentiment, array_to_string({TOKENS_SQL}, ' ') AS value FROM c", c=sql_cleaned(SQL_R)))
def q_corpus_sink(spark, sf):
    """A4: the cleaned corpus, one line per review, one folder per sentiment."""
    path = f"{run_folder(spark)}/corpus"
    write_corpus(_rc(spark, sf), path)
    return spark.read.text(path).select("sentiment", "value")


@register("key_value_sink", with_ctes(
    """SELECT unnest([concat('min=', min(review_score)), concat('max=', max(review_score)),
  concat('distinct=', count(DISTINCT review_score)),
  concat('binary=', CASE WHEN count(DISTINCT review_score) <= 3 AND min(review_score) >= -1
                          AND max(review_score) <= 1 THEN 'True' ELSE 'False' END),
  concat('threshold=', CASE WHEN max(review_score) <= 5 THEN '4.0' ELSE '?' END)]) AS value FROM o""", o=SQL_O5))
def q_key_value_sink(spark, sf):
    """A5: the score profile as key=value lines."""
    path = f"{run_folder(spark)}/summary"
    write_key_values(SC.score_profile(FX.view(spark, sf, "O5")), path)
    return spark.read.text(path)


# --------------------------------------------------------------------------
# B: cleaning, dedup, sampling, projections
# --------------------------------------------------------------------------

@register("clean_reviews", with_ctes(
    "SELECT game, count(*) AS review_count FROM c GROUP BY game", c=sql_cleaned(SQL_R)))
def q_clean_reviews(spark, sf):
    return G.review_counts(_rc(spark, sf))


@register("clean_reviews_d", with_ctes(
    "SELECT game, count(*) AS review_count FROM c GROUP BY game", c=sql_cleaned(SQL_D)))
def q_clean_reviews_d(spark, sf):
    return G.review_counts(C.clean_reviews(FX.reviews_d(spark, sf), order_by="row_id"))


@register("clean_reviews_no_dedup", with_ctes(
    """SELECT game, count(*) AS review_count FROM (
  SELECT game, trim(review_text) AS review_text, review_score FROM d) c
WHERE review_text IS NOT NULL AND length(review_text) > 0
  AND review_score IS NOT NULL AND NOT isnan(review_score)
GROUP BY game""", d=SQL_D))
def q_clean_reviews_no_dedup(spark, sf):
    """The original's --no-dedup run: cleaning filters only."""
    return G.review_counts(C.clean_reviews(FX.reviews_d(spark, sf), dedup=False))


@register("dedup_reviews", with_ctes(
    """SELECT row_id, game_id, game, app_name, review_text, review_score, review_votes FROM d
QUALIFY row_number() OVER (PARTITION BY game_id, review_text ORDER BY row_id) = 1""", d=SQL_D))
def q_dedup_reviews(spark, sf):
    return C.dedup_reviews(FX.reviews_d(spark, sf), order_by="row_id")


@register("dedup_reviews_counts", with_ctes(
    "SELECT count(*) AS n_rows FROM (SELECT DISTINCT game_id, review_text FROM d) x", d=SQL_D))
def q_dedup_reviews_counts(spark, sf):
    return C.dedup_reviews(FX.reviews_d(spark, sf)).agg(F.count(F.lit(1)).alias("n_rows"))


@register("cleaning_audit", with_ctes(
    "SELECT (SELECT count(*) FROM d) AS rows_before, (SELECT count(*) FROM c) AS rows_after",
    d=SQL_D, c=sql_cleaned(SQL_D)))
def q_cleaning_audit(spark, sf):
    return C.audit_cleaning(FX.reviews_d(spark, sf))


@register("cleaning_audit_r", with_ctes(
    "SELECT (SELECT count(*) FROM r) AS rows_before, (SELECT count(*) FROM c) AS rows_after",
    r=SQL_R, c=sql_cleaned(SQL_R)))
def q_cleaning_audit_r(spark, sf):
    """Rows without a score leave."""
    return C.audit_cleaning(FX.reviews_r(spark, sf))


# 10 % of the rows by the first 20 bits of md5: 104858 = 0x1999a.
SAMPLED_SQL = "substr(md5(concat('42|', CAST(row_id AS VARCHAR))), 1, 5) < '1999a'"


@register("sample_reviews", f"SELECT row_id, game, review_score FROM ({SQL_S}) s WHERE {SAMPLED_SQL}")
def q_sample_reviews(spark, sf):
    return C.sample_reviews(_s(spark, sf), 0.1, keys=["row_id"]).select("row_id", "game", "review_score")


@register("review_lengths", with_ctes(
    "SELECT CAST(length(review_text) AS INTEGER) AS review_length FROM c", c=sql_cleaned(SQL_R)))
def q_review_lengths(spark, sf):
    return C.review_lengths(_rc(spark, sf))


@register("sentiment_lengths", with_ctes(
    f"SELECT {SENT_SQL} AS sentiment, CAST(length(review_text) AS INTEGER) AS review_length FROM c",
    c=sql_cleaned(SQL_R)))
def q_sentiment_lengths(spark, sf):
    return C.sentiment_lengths(_rc(spark, sf))


@register("correlation_data", with_ctes(
    "SELECT CAST(length(review_text) AS INTEGER) AS review_length, review_score, review_votes FROM c",
    c=sql_cleaned(SQL_R)))
def q_correlation_data(spark, sf):
    return C.correlation_data(_rc(spark, sf))


# --------------------------------------------------------------------------
# C: score-scale profile
# --------------------------------------------------------------------------

def _profile_sql(src: str) -> str:
    return with_ctes("""SELECT "min", "max", "distinct", "binary",
  CASE WHEN "binary" THEN 1.0 WHEN "max" <= 5 THEN 4.0 WHEN "max" <= 10 THEN 7.0
       ELSE coalesce(med, 4.0) END::DOUBLE AS threshold
FROM (
  SELECT CAST(min(review_score) AS DOUBLE) AS "min", CAST(max(review_score) AS DOUBLE) AS "max",
         count(DISTINCT review_score) AS "distinct",
         coalesce(count(DISTINCT review_score) <= 3 AND min(review_score) >= -1
                  AND max(review_score) <= 1, false) AS "binary",
         CAST(quantile_disc(review_score, 0.5) AS DOUBLE) AS med
  FROM o) p""", o=src)


for _name, _view, _src in [("binary", "S", SQL_S), ("five", "O5", SQL_O5), ("ten", "O10", SQL_O10),
                           ("wide", "OW", SQL_OW), ("empty", "O0", SQL_O0)]:
    def _mk(view):
        return lambda spark, sf: SC.score_profile(FX.view(spark, sf, view))
    register(f"score_profile_{_name}", _profile_sql(_src))(_mk(_view))


@register("global_sentiment_summary", with_ctes(
    f"""SELECT CAST(sum(CASE WHEN {POS_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS positive_count,
       CAST(count(*) - sum(CASE WHEN {POS_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS negative_count,
       round(CAST(sum(CASE WHEN {POS_SQL} THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS positive_ratio
FROM c""", c=sql_cleaned(SQL_R)))
def q_global_sentiment_summary(spark, sf):
    return SC.global_sentiment_summary(_rc(spark, sf))


@register("global_sentiment_summary_wide", with_ctes(
    f"""SELECT CAST(sum(CASE WHEN {POS_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS positive_count,
       CAST(count(*) - sum(CASE WHEN {POS_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS negative_count,
       round(CAST(sum(CASE WHEN {POS_SQL} THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS positive_ratio
FROM o HAVING count(DISTINCT review_score) <= 3 AND min(review_score) >= -1 AND max(review_score) <= 1""", o=SQL_OW))
def q_global_sentiment_summary_wide(spark, sf):
    return SC.global_sentiment_summary(FX.scores_ow(spark, sf))


# --------------------------------------------------------------------------
# D: per-game aggregates
# --------------------------------------------------------------------------

def _counts_sql(src, scored):
    where = "WHERE review_score IS NOT NULL" if scored else ""
    return with_ctes(f"SELECT game, count(*) AS review_count FROM r {where} GROUP BY game", r=src)


def _avg_sql(src, scored):
    where = "WHERE review_score IS NOT NULL" if scored else ""
    return with_ctes(
        f"SELECT game, round(avg(review_score), {DP}) AS avg_review_score FROM r {where} GROUP BY game",
        r=src)


def _sentiment_counts_sql(src, scored):
    where = "WHERE review_score IS NOT NULL" if scored else ""
    return with_ctes(f"""SELECT game,
  CAST(sum(CASE WHEN {POS_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS positive_reviews,
  CAST(sum(CASE WHEN {POS_SQL} THEN 0 ELSE 1 END) AS BIGINT) AS negative_reviews,
  count(*) AS total_reviews,
  round(CAST(sum(CASE WHEN {POS_SQL} THEN 1 ELSE 0 END) AS DOUBLE) / count(*), {DP}) AS positive_ratio
FROM r {where} GROUP BY game""", r=src)


for _scored in (False, True):
    _p = "scored_" if _scored else ""

    def _mk_counts(scored):
        return lambda spark, sf: G.review_counts(_r(spark, sf), scored_only=scored)

    def _mk_avg(scored):
        return lambda spark, sf: _round(G.avg_scores(_r(spark, sf), scored_only=scored), DP,
                                        "avg_review_score")

    def _mk_sent(scored):
        return lambda spark, sf: _round(G.sentiment_counts(_r(spark, sf), scored_only=scored), DP,
                                        "positive_ratio")

    register(f"{_p}review_counts", _counts_sql(SQL_R, _scored))(_mk_counts(_scored))
    register(f"{_p}avg_scores", _avg_sql(SQL_R, _scored))(_mk_avg(_scored))
    register(f"{_p}sentiment_counts", _sentiment_counts_sql(SQL_R, _scored))(_mk_sent(_scored))


@register("review_counts_s", _counts_sql(SQL_S, False))
def q_review_counts_s(spark, sf):
    return G.review_counts(_s(spark, sf))


@register("avg_scores_s", _avg_sql(SQL_S, False))
def q_avg_scores_s(spark, sf):
    return _round(G.avg_scores(_s(spark, sf)), DP, "avg_review_score")


@register("sentiment_counts_s", _sentiment_counts_sql(SQL_S, False))
def q_sentiment_counts_s(spark, sf):
    return _round(G.sentiment_counts(_s(spark, sf)), DP, "positive_ratio")


@register("game_metrics", with_ctes(
    f"""SELECT game, count(*) AS review_count, count(review_score) AS scored_count,
  round(sum(review_score), {DP}) AS score_sum,
  CAST(sum(CASE WHEN {POS_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS positive
FROM r GROUP BY game""", r=SQL_R))
def q_game_metrics(spark, sf):
    return _round(G.game_metrics(_r(spark, sf)), DP, "score_sum")


def _games_sentiment_sql(src, min_reviews=10, digits=DP):
    ratio = "CAST(positive AS DOUBLE) / total_reviews"
    if digits is not None:
        ratio = f"round({ratio}, {digits})"
    return f"""SELECT game, positive, negative, total_reviews, {ratio} AS positive_ratio FROM (
  SELECT game, CAST(sum(CASE WHEN {POS_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS positive,
         CAST(sum(CASE WHEN {POS_SQL} THEN 0 ELSE 1 END) AS BIGINT) AS negative,
         count(*) AS total_reviews
  FROM ({src}) r GROUP BY game) g
WHERE total_reviews >= {min_reviews}"""


@register("games_sentiment", _games_sentiment_sql(sql_cleaned(SQL_R)))
def q_games_sentiment(spark, sf):
    return _round(G.games_sentiment(_rc(spark, sf)), DP, "positive_ratio")


@register("games_sentiment_s", _games_sentiment_sql(SQL_S))
def q_games_sentiment_s(spark, sf):
    return _round(G.games_sentiment(_s(spark, sf)), DP, "positive_ratio")


SQL_O5G = """SELECT o_orderkey AS row_id, o_custkey AS game_id, concat('cust', CAST(o_custkey AS VARCHAR)) AS game,
       o_orderstatus AS app_name, CAST('' AS VARCHAR) AS review_text,
       CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS review_score, o_totalprice AS review_votes
FROM orders"""


@register("games_sentiment_threshold", with_ctes(
    f"""SELECT game, positive, negative, total_reviews, round(CAST(positive AS DOUBLE) / total_reviews, {DP}) AS positive_ratio
FROM (SELECT game,
        CAST(sum(CASE WHEN coalesce(review_score >= t.threshold, false) THEN 1 ELSE 0 END) AS BIGINT) AS positive,
        CAST(sum(CASE WHEN coalesce(review_score >= t.threshold, false) THEN 0 ELSE 1 END) AS BIGINT) AS negative,
        count(*) AS total_reviews
      FROM r, ({_profile_sql("SELECT review_score FROM r")}) t GROUP BY game) g
WHERE total_reviews >= 10""", r=SQL_O5G))
def q_games_sentiment_threshold(spark, sf):
    """Documented-intent rule: positive when score >= the profiled threshold
    (4 on this five-point scale)."""
    df = FX.reviews_o5(spark, sf)
    return _round(G.games_sentiment(df, rule="threshold", threshold=SC.score_threshold(df)),
                  DP, "positive_ratio")


def _pct_sql(src, min_reviews=5):
    return f"""SELECT game, sentiment, count, total_by_game,
       round(CAST(count AS DOUBLE) / total_by_game * 100, 2) AS percentage FROM (
  SELECT game, sentiment, count, CAST(sum(count) OVER (PARTITION BY game) AS BIGINT) AS total_by_game FROM (
    SELECT game, {SENT_SQL} AS sentiment, count(*) AS count FROM ({src}) r GROUP BY 1, 2) a) b
WHERE total_by_game >= {min_reviews}"""


@register("review_percentages", _pct_sql(SQL_E))
def q_review_percentages(spark, sf):
    return G.review_percentages(_e(spark, sf))


@register("review_percentages_with_zero_s", with_ctes(
    f"""SELECT g.game, s.sentiment, coalesce(c.count, 0) AS count, g.total_by_game,
  round(CAST(coalesce(c.count, 0) AS DOUBLE) / g.total_by_game * 100, 2) AS percentage
FROM (SELECT game, count(*) AS total_by_game FROM r GROUP BY game HAVING count(*) >= 5) g
CROSS JOIN (VALUES ('positive'), ('negative')) s(sentiment)
LEFT JOIN (SELECT game, {SENT_SQL} AS sentiment, count(*) AS count FROM r GROUP BY 1, 2) c
  ON c.game = g.game AND c.sentiment = s.sentiment""", r=SQL_S))
def q_review_percentages_with_zero_s(spark, sf):
    """Both sentiments for every game, 0 % rows included."""
    return G.review_percentages(_s(spark, sf), include_zero=True)


@register("review_percentages_s", _pct_sql(SQL_S))
def q_review_percentages_s(spark, sf):
    return G.review_percentages(_s(spark, sf))


def _pct_summary_sql(src):
    return f"""SELECT sentiment, count(*) AS n_games, round(avg(percentage), {DP}) AS mean_percentage,
       round(quantile_cont(percentage, 0.5), {DP}) AS median_percentage
FROM ({_pct_sql(src)}) p GROUP BY sentiment"""


@register("percentage_summary", _pct_summary_sql(SQL_E))
def q_percentage_summary(spark, sf):
    return _round(G.percentage_summary(G.review_percentages(_e(spark, sf))), DP,
                  "mean_percentage", "median_percentage")


@register("percentage_summary_s", _pct_summary_sql(SQL_S))
def q_percentage_summary_s(spark, sf):
    return _round(G.percentage_summary(G.review_percentages(_s(spark, sf))), DP,
                  "mean_percentage", "median_percentage")


@register("app_avg_scores", with_ctes(
    f"SELECT app_name, round(avg(review_score), {DP}) AS avg_review_score FROM c GROUP BY app_name",
    c=sql_cleaned(SQL_R)))
def q_app_avg_scores(spark, sf):
    return _round(G.app_avg_scores(_rc(spark, sf)), DP, "avg_review_score")


@register("app_avg_scores_s", with_ctes(
    f"SELECT app_name, round(avg(review_score), {DP}) AS avg_review_score FROM s GROUP BY app_name",
    s=SQL_S))
def q_app_avg_scores_s(spark, sf):
    return _round(G.app_avg_scores(_s(spark, sf)), DP, "avg_review_score")


@register("app_avg_scores_by_game", with_ctes(
    f"SELECT game, round(avg(review_score), {DP}) AS avg_review_score FROM c GROUP BY game",
    c=sql_cleaned(SQL_R)))
def q_app_avg_scores_by_game(spark, sf):
    """Without an app_name column the average falls back to ``game``."""
    return _round(G.app_avg_scores(_rc(spark, sf).drop("app_name")), DP, "avg_review_score")


@register("top_apps_by_avg", with_ctes(
    f"""SELECT app_name, round(avg(review_score), {DP}) AS avg_review_score FROM s GROUP BY app_name
ORDER BY avg(review_score) DESC NULLS LAST, app_name ASC NULLS LAST LIMIT 10""", s=SQL_S))
def q_top_apps_by_avg(spark, sf):
    return _round(G.top_apps_by_avg(_s(spark, sf)), DP, "avg_review_score")


# --------------------------------------------------------------------------
# E: top-k lists and gated lists
# --------------------------------------------------------------------------

@register("top_games", with_ctes(
    f"""SELECT game, count(*) AS review_count FROM s GROUP BY game
ORDER BY review_count DESC, game ASC NULLS LAST LIMIT 10""", s=SQL_S))
def q_top_games(spark, sf):
    return G.top_games(_s(spark, sf))


def _gs_exact_sql(src):
    return _games_sentiment_sql(src, digits=None)


@register("top_positive_games", f"""SELECT game, positive, negative, total_reviews,
  round(positive_ratio, {DP}) AS positive_ratio FROM ({_gs_exact_sql(SQL_S)}) g
ORDER BY positive_ratio DESC NULLS LAST, game ASC NULLS LAST LIMIT 10""")
def q_top_positive_games(spark, sf):
    return _round(G.top_positive_games(G.games_sentiment(_s(spark, sf))), DP, "positive_ratio")


@register("bottom_positive_games", f"""SELECT game, positive, negative, total_reviews,
  round(positive_ratio, {DP}) AS positive_ratio FROM ({_gs_exact_sql(SQL_S)}) g
ORDER BY positive_ratio ASC NULLS LAST, game ASC NULLS LAST LIMIT 10""")
def q_bottom_positive_games(spark, sf):
    return _round(G.bottom_positive_games(G.games_sentiment(_s(spark, sf))), DP, "positive_ratio")


@register("top_reviewed_games", f"""SELECT game, positive, negative, total_reviews,
  round(positive_ratio, {DP}) AS positive_ratio FROM ({_gs_exact_sql(SQL_S)}) g
WHERE (SELECT count(*) FROM ({_gs_exact_sql(SQL_S)}) x) >= 10
ORDER BY total_reviews DESC, game ASC NULLS LAST LIMIT 20""")
def q_top_reviewed_games(spark, sf):
    return _round(G.top_reviewed_games(G.games_sentiment(_s(spark, sf)), min_games=10), DP, "positive_ratio")


@register("top_reviewed_games_r", f"""SELECT game, positive, negative, total_reviews,
  round(positive_ratio, {DP}) AS positive_ratio FROM ({_gs_exact_sql(sql_cleaned(SQL_R))}) g
WHERE (SELECT count(*) FROM ({_gs_exact_sql(sql_cleaned(SQL_R))}) x) >= 10
ORDER BY total_reviews DESC, game ASC NULLS LAST LIMIT 20""")
def q_top_reviewed_games_r(spark, sf):
    return _round(G.top_reviewed_games(G.games_sentiment(_rc(spark, sf)), min_games=10), DP, "positive_ratio")


@register("top_reviewed_games_ungated", f"""SELECT game, positive, negative, total_reviews,
  round(positive_ratio, {DP}) AS positive_ratio FROM ({_gs_exact_sql(sql_cleaned(SQL_R))}) g
ORDER BY total_reviews DESC, game ASC NULLS LAST LIMIT 20""")
def q_top_reviewed_games_ungated(spark, sf):
    return _round(G.top_reviewed_games(G.games_sentiment(_rc(spark, sf))), DP, "positive_ratio")


def _low_gate_sql(pct, gated=True):
    return "true" if not gated else (f"(SELECT count(*) FROM ({pct}) z WHERE sentiment = 'positive' "
            f"AND percentage <= 10.0) >= 5")


def _low_games_sql(src, gated=True):
    pct = _pct_sql(src)
    return f"""SELECT game, percentage FROM ({pct}) p
WHERE sentiment = 'positive' AND percentage <= 10.0 AND {_low_gate_sql(pct, gated)}
ORDER BY percentage ASC, game ASC NULLS LAST LIMIT 15"""


def _low_extended_sql(src, gated=True):
    pct = _pct_sql(src)
    return f"""SELECT game,
  CASE WHEN length(game) > 30 THEN concat(substr(game, 1, 30), '...')
       ELSE game END AS label, percentage
FROM ({pct}) p
WHERE sentiment = 'positive' AND percentage <= 20.0 AND {_low_gate_sql(pct, gated)}
ORDER BY percentage ASC, game ASC NULLS LAST LIMIT 20"""


def _low_summary_sql(src, gated=True):
    pct = _pct_sql(src)
    return f"""SELECT count(*) FILTER (WHERE percentage <= 10.0) AS n_le_10,
       count(*) FILTER (WHERE percentage <= 5.0) AS n_le_5,
       first(game ORDER BY percentage, game) FILTER (WHERE percentage <= 10.0) AS worst_game,
       min(percentage) FILTER (WHERE percentage <= 10.0) AS worst_percentage
FROM ({pct}) p WHERE sentiment = 'positive'
HAVING {_low_gate_sql(pct, gated)}"""


def _categories_sql(src, gated=True):
    pct = _pct_sql(src)
    rows = ", ".join(
        f"({i}, '{lab}', {lo}, {hi})" for i, (lab, lo, hi) in enumerate((
            ("0-5%", 0, 5), ("5-10%", 5, 10), ("10-15%", 10, 15), ("15-20%", 15, 20), ("20-25%", 20, 25),
            ("25-30%", 25, 30), ("30-40%", 30, 40), ("40-50%", 40, 50), ("50%+", 50, 100))))
    return f"""SELECT CAST(c.ord AS INTEGER) AS ord, c.category,
  count(p.game) AS n_games
FROM (VALUES {rows}) c(ord, category, lo, hi)
LEFT JOIN (SELECT * FROM ({pct}) q WHERE sentiment = 'positive') p
  ON p.percentage <= c.hi AND (p.percentage > c.lo OR (c.ord = 0 AND p.percentage >= c.lo))
WHERE {_low_gate_sql(pct, gated)}
GROUP BY c.ord, c.category"""


# The original's gates (five low games) where ``min_games`` is given; the
# ``_ungated`` queries are the defaults.
for _suffix, _src, _get, _gate in [("", SQL_S, _s, 5), ("_e", SQL_E, _e, 5),
                                   ("_ungated", SQL_S, _s, None), ("_e_ungated", SQL_E, _e, None)]:
    for _name, _fn, _sql in [("low_positive_games", G.low_positive_games, _low_games_sql),
                             ("low_positive_extended", G.low_positive_extended, _low_extended_sql),
                             ("low_positive_summary", G.low_positive_summary, _low_summary_sql),
                             ("percentage_categories", G.percentage_categories, _categories_sql)]:
        def _mk_low(fn, get, gate):
            return lambda spark, sf: fn(G.review_percentages(get(spark, sf)), min_games=gate)

        register(f"{_name}{_suffix}", _sql(_src, _gate is not None))(_mk_low(_fn, _get, _gate))


@register("score_distribution", with_ctes(
    "SELECT review_score, count(*) AS count FROM o GROUP BY review_score", o=SQL_OW))
def q_score_distribution(spark, sf):
    return G.score_distribution(FX.scores_ow(spark, sf))


@register("score_distribution_r", with_ctes(
    "SELECT review_score, count(*) AS count FROM c GROUP BY review_score", c=sql_cleaned(SQL_R)))
def q_score_distribution_r(spark, sf):
    return G.score_distribution(_rc(spark, sf))


@register("popularity_points", f"""SELECT game, total_reviews, round(positive_ratio, {DP}) AS positive_ratio,
  round(log10(total_reviews), {DP}) AS log10_total, round(CAST(total_reviews AS DOUBLE) / 50.0, {DP}) AS bubble_size
FROM ({_gs_exact_sql(SQL_S)}) g""")
def q_popularity_points(spark, sf):
    return _round(G.popularity_points(G.games_sentiment(_s(spark, sf))), DP,
                  "positive_ratio", "log10_total", "bubble_size")


# --------------------------------------------------------------------------
# F: text
# --------------------------------------------------------------------------

_RAW_WORDS_SQL = with_ctes(
    f"SELECT word, count(*) AS count FROM (SELECT unnest(string_split_regex(review_text, '{JAVA_WS}')) "
    "AS word FROM c) w GROUP BY word", c=sql_cleaned(SQL_R))


@register("word_counts", _RAW_WORDS_SQL)
def q_word_counts(spark, sf):
    return TX.word_counts(_rc(spark, sf))


@register("top_words", f"SELECT * FROM ({_RAW_WORDS_SQL}) x ORDER BY count DESC, word ASC LIMIT 15")
def q_top_words(spark, sf):
    return TX.most_frequent_words(_rc(spark, sf))


@register("cleaned_corpus", with_ctes(
    f"SELECT {SENT_SQL} AS sentiment, array_to_string({TOKENS_SQL}, ' ') AS clean_text FROM c",
    c=sql_cleaned(SQL_R)))
def q_cleaned_corpus(spark, sf):
    return TX.cleaned_corpus(_rc(spark, sf))


@register("sentiment_word_counts", with_ctes(
    f"""SELECT sentiment, word, count(*) AS freq
FROM (SELECT {SENT_SQL} AS sentiment, unnest({TOKENS_SQL}) AS word FROM c) w GROUP BY sentiment, word""",
    c=sql_cleaned(SQL_R)))
def q_sentiment_word_counts(spark, sf):
    return TX.sentiment_word_counts(_rc(spark, sf))


def _clean_freq_sql(sentiment, min_freq):
    where = f"WHERE {SENT_SQL} = '{sentiment}'" if sentiment else ""
    return with_ctes(
        f"""SELECT word, count(*) AS freq FROM (SELECT unnest({TOKENS_SQL}) AS word FROM c {where}) w
GROUP BY word HAVING count(*) >= {min_freq} AND length(word) >= 3""", c=sql_cleaned(SQL_R))


def _cloud_sql(sentiment, min_freq, max_words):
    return f"""SELECT word, freq, CAST(freq AS DOUBLE) / max(freq) OVER () AS weight FROM (
  SELECT * FROM ({_clean_freq_sql(sentiment, min_freq)}) f ORDER BY freq DESC, word ASC LIMIT {max_words}) t"""


for _sent, _minf, _maxw, _suffix in [(None, 5, 150, "all"), ("positive", 3, 100, "positive"),
                                     ("negative", 3, 100, "negative")]:
    def _mk_freq(sent):
        return lambda spark, sf: TX.cleaned_word_freq(_rc(spark, sf), sentiment=sent)

    def _mk_cloud(sent, maxw):
        return lambda spark, sf: _round(
            TX.cloud_words(_rc(spark, sf), sentiment=sent, max_words=maxw), DP, "weight")

    register(f"cleaned_word_freq_{_suffix}", _clean_freq_sql(_sent, _minf))(_mk_freq(_sent))
    register(f"cloud_weights_{_suffix}",
             f"SELECT word, freq, round(weight, {DP}) AS weight FROM ({_cloud_sql(_sent, _minf, _maxw)}) x"
             )(_mk_cloud(_sent, _maxw))


@register("cloud_weights_sampled", with_ctes(f"""SELECT word, freq, round(freq / max(freq) OVER (), {DP}) AS weight
FROM (SELECT word, count(*) AS freq FROM (SELECT unnest({TOKENS_SQL}) AS word FROM c WHERE {SAMPLED_SQL}) w
      GROUP BY word HAVING count(*) >= 5 AND length(word) >= 3 ORDER BY freq DESC, word LIMIT 150) t""",
    c=sql_cleaned(SQL_R)))
def q_cloud_weights_sampled(spark, sf):
    """Word-cloud weights over a 10 % hash sample of the reviews, the original
    job's setting (F4 -> F6 -> F7)."""
    return _round(TX.cloud_words(_rc(spark, sf), fraction=TX.TEXT_SAMPLE_FRACTION,
                                 sample_keys=["row_id"]), DP, "weight")


# --------------------------------------------------------------------------
# G: statistics
# --------------------------------------------------------------------------

def _corr_cell(a: str, b: str) -> str:
    """Pairwise-complete Pearson r of columns ``a`` and ``b`` in SQL."""
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL AND NOT isnan({a}) AND NOT isnan({b})"
    xa, xb = f"CASE WHEN {both} THEN {a} END", f"CASE WHEN {both} THEN {b} END"
    r = (f"CASE WHEN stddev_pop({xa}) * stddev_pop({xb}) = 0 THEN NULL "
         f"ELSE covar_pop({xa}, {xb}) / (stddev_pop({xa}) * stddev_pop({xb})) END")
    return f"CASE WHEN ({r}) IS NULL THEN NULL ELSE least(greatest({r}, -1.0), 1.0) END"


@register("correlation_matrix", with_ctes(
    f"""SELECT a.x, b.y, round(CASE
    WHEN a.x = 'review_length' AND b.y = 'review_length' THEN r_ll
    WHEN a.x = 'review_score' AND b.y = 'review_score' THEN r_ss
    WHEN a.x = 'review_votes' AND b.y = 'review_votes' THEN r_vv
    WHEN (a.x, b.y) IN (('review_length', 'review_score'), ('review_score', 'review_length')) THEN r_ls
    WHEN (a.x, b.y) IN (('review_length', 'review_votes'), ('review_votes', 'review_length')) THEN r_lv
    ELSE r_sv END, {DP}) AS r
FROM (SELECT unnest(['review_length', 'review_score', 'review_votes']) AS x) a
CROSS JOIN (SELECT unnest(['review_length', 'review_score', 'review_votes']) AS y) b
CROSS JOIN (SELECT
    {_corr_cell('l', 'l')} AS r_ll, {_corr_cell('s', 's')} AS r_ss, {_corr_cell('v', 'v')} AS r_vv,
    {_corr_cell('l', 's')} AS r_ls, {_corr_cell('l', 'v')} AS r_lv, {_corr_cell('s', 'v')} AS r_sv
  FROM m) k""",
    c=sql_cleaned(SQL_R),
    m="SELECT CAST(length(review_text) AS DOUBLE) AS l, review_score AS s, review_votes AS v FROM c"))
def q_correlation_matrix(spark, sf):
    return _round(ST.correlation_matrix(C.correlation_data(_rc(spark, sf))), DP, "r")

_LEN_SRC = "SELECT CAST(length(review_text) AS DOUBLE) AS v FROM c"


@register("describe_lengths", with_ctes(
    f"""SELECT count(*) AS count, round(avg(v), {DP}) AS mean, round(stddev_samp(v), {DP}) AS std,
  min(v) AS "min", round(quantile_cont(v, 0.25), {DP}) AS q25, round(quantile_cont(v, 0.5), {DP}) AS q50,
  round(quantile_cont(v, 0.75), {DP}) AS q75, max(v) AS "max" FROM x""",
    c=sql_cleaned(SQL_R), x=_LEN_SRC))
def q_describe_lengths(spark, sf):
    return _round(ST.describe_lengths(_rc(spark, sf)), DP, "mean", "std", "q25", "q50", "q75")


@register("describe_lengths_from_counts", with_ctes(
    f"""SELECT count(*) AS count, round(avg(v), {DP}) AS mean, round(stddev_samp(v), {DP}) AS std,
  min(v) AS "min", round(quantile_cont(v, 0.25), {DP}) AS q25, round(quantile_cont(v, 0.5), {DP}) AS q50,
  round(quantile_cont(v, 0.75), {DP}) AS q75, max(v) AS "max" FROM x""",
    c=sql_cleaned(SQL_R), x=_LEN_SRC))
def q_describe_lengths_from_counts(spark, sf):
    lc = C.sentiment_lengths(_rc(spark, sf)).groupBy("review_length").agg(F.count(F.lit(1)).alias("freq"))
    return _round(ST.describe(lc, "review_length", weight="freq").drop("group"), DP,
                  "mean", "std", "q25", "q50", "q75")


@register("trim_upper_quantile", with_ctes(
    "SELECT CAST(v AS INTEGER) AS review_length FROM x WHERE v <= (SELECT quantile_cont(v, 0.95) FROM x)",
    c=sql_cleaned(SQL_R), x=_LEN_SRC))
def q_trim_upper_quantile(spark, sf):
    lengths = C.review_lengths(_rc(spark, sf))
    return ST.trim_upper_quantile(lengths, "review_length", 0.95)


def _bin_sql(v: str, lo: str, hi: str, bins: int) -> str:
    step = f"(({hi} - {lo}) / {bins})"
    i0 = f"CAST(trunc(({v} - {lo}) / ({hi} - {lo}) * {bins}) AS INTEGER)"
    i1 = f"least({i0}, {bins - 1})"

    def edge(i):
        return f"(CASE WHEN {i} = {bins} THEN {hi} ELSE {lo} + ({i}) * {step} END)"

    return (f"CASE WHEN {v} < {edge(i1)} THEN {i1} - 1 "
            f"WHEN {v} >= {edge(f'{i1} + 1')} AND {i1} <> {bins - 1} THEN {i1} + 1 ELSE {i1} END")


def histogram_sql(src: str, bins: int) -> str:
    """``src`` yields columns grp (VARCHAR) and v (DOUBLE)."""
    return with_ctes(
        f"""SELECT g.grp AS "group", CAST(g.bin AS INTEGER) AS bin,
  round(g.lo + g.bin * ((g.hi - g.lo) / {bins}), {DP}) AS lo,
  round(CASE WHEN g.bin = {bins - 1} THEN g.hi ELSE g.lo + (g.bin + 1) * ((g.hi - g.lo) / {bins}) END, {DP}) AS hi,
  coalesce(c.n, 0) AS n
FROM (SELECT st.*, t.bin FROM st CROSS JOIN range(0, {bins}) t(bin)) g
LEFT JOIN c ON c.grp = g.grp AND c.bin = g.bin""",
        hv=f"SELECT grp, v FROM ({src}) s WHERE v IS NOT NULL AND NOT isnan(v)",
        st="""SELECT grp, CASE WHEN max(v) = min(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
       CASE WHEN max(v) = min(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM hv GROUP BY grp""",
        c=f"""SELECT hv.grp, {_bin_sql('hv.v', 'st.lo', 'st.hi', bins)} AS bin, count(*) AS n
FROM hv JOIN st ON hv.grp = st.grp GROUP BY 1, 2""")


def _len_src(by_sentiment: bool) -> str:
    grp = SENT_SQL if by_sentiment else "'all'"
    return f"SELECT {grp} AS grp, CAST(length(review_text) AS DOUBLE) AS v FROM ({sql_cleaned(SQL_R)}) c"


def _round_hist(df):
    return _round(df, DP, "lo", "hi")


def _length_counts(spark, sf):
    """(sentiment, review_length, freq): the job's shared length table."""
    lengths = C.sentiment_lengths(_rc(spark, sf))
    return lengths.groupBy("sentiment", "review_length").agg(F.count(F.lit(1)).alias("freq"))


def _len_hist_query(bins, by_sentiment=False, trimmed=False):
    def q(spark, sf):
        df = C.sentiment_lengths(_rc(spark, sf))
        return _round_hist(ST.histogram(df, "review_length", bins, by="sentiment" if by_sentiment else None,
                                        upper=0.95 if trimmed else None))
    return q


for _bins in (50, 15, 30):
    register(f"histogram_length_{_bins}", histogram_sql(_len_src(False), _bins))(_len_hist_query(_bins))
register("histogram_length_by_sentiment_50",
         histogram_sql(_len_src(True), 50))(_len_hist_query(50, by_sentiment=True))
register("histogram_length_trimmed_20", histogram_sql(
    f"SELECT * FROM ({_len_src(False)}) a WHERE v <= (SELECT quantile_cont(v, 0.95) FROM ({_len_src(False)}) b)",
    20))(_len_hist_query(20, trimmed=True))


@register("histogram_length_50_from_counts", histogram_sql(_len_src(False), 50))
def q_histogram_length_50_from_counts(spark, sf):
    """Same histogram from the folded (length, count) table with weights."""
    return _round_hist(ST.histogram(_length_counts(spark, sf), "review_length", 50, weight="freq"))


@register("histogram_length_trimmed_20_from_counts", histogram_sql(
    f"SELECT * FROM ({_len_src(False)}) a WHERE v <= (SELECT quantile_cont(v, 0.95) FROM ({_len_src(False)}) b)",
    20))
def q_histogram_length_trimmed_20_from_counts(spark, sf):
    lc = _length_counts(spark, sf)
    return _round_hist(ST.histogram(lc, "review_length", 20, weight="freq", upper=0.95))


@register("histogram_score", histogram_sql(f"SELECT 'all' AS grp, review_score AS v FROM ({SQL_OW}) o", 20))
def q_histogram_score(spark, sf):
    return _round_hist(ST.histogram(FX.scores_ow(spark, sf), "review_score", 20))


@register("histogram_score_r", histogram_sql(
    f"SELECT 'all' AS grp, review_score AS v FROM ({sql_cleaned(SQL_R)}) c", 20))
def q_histogram_score_r(spark, sf):
    return _round_hist(ST.histogram(_rc(spark, sf), "review_score", 20))


@register("histogram_score_constant", histogram_sql(
    f"SELECT 'all' AS grp, review_votes AS v FROM ({SQL_D}) d", 20))
def q_histogram_score_constant(spark, sf):
    """All values equal: one range min-0.5 .. max+0.5, 20 bins."""
    return _round_hist(ST.histogram(FX.reviews_d(spark, sf), "review_votes", 20))


def _pct_src(src):
    return f"SELECT sentiment AS grp, percentage AS v FROM ({_pct_sql(src)}) p"


for _bins in (20, 15):
    def _mk_pct_hist(get, bins):
        return lambda spark, sf: _round_hist(
            ST.histogram(G.review_percentages(get(spark, sf)), "percentage", bins, by="sentiment"))

    register(f"histogram_percentage_{_bins}", histogram_sql(_pct_src(SQL_E), _bins))(_mk_pct_hist(_e, _bins))
    register(f"histogram_percentage_{_bins}_s", histogram_sql(_pct_src(SQL_S), _bins))(_mk_pct_hist(_s, _bins))


def _shares_sql(src):
    return f"""SELECT sentiment, count, round(CAST(count AS DOUBLE) * 100.0 / sum(count) OVER (), 1) AS percent
FROM (SELECT {SENT_SQL} AS sentiment, count(*) AS count FROM ({src}) r GROUP BY 1) a"""


@register("sentiment_shares", _shares_sql(sql_cleaned(SQL_R)))
def q_sentiment_shares(spark, sf):
    return ST.sentiment_shares(_rc(spark, sf))


@register("sentiment_shares_s", _shares_sql(SQL_S))
def q_sentiment_shares_s(spark, sf):
    return ST.sentiment_shares(_s(spark, sf))


def box_sql(src: str) -> str:
    """``src`` yields grp and v."""
    return with_ctes(
        f"""SELECT q.grp AS "group", count(*) AS n, round(q1, {DP}) AS q1, round(med, {DP}) AS median,
  round(q3, {DP}) AS q3, round(q3 - q1, {DP}) AS iqr,
  round(least(coalesce(min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)), q1), q1), {DP}) AS whisker_lo,
  round(greatest(coalesce(max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)), q3), q3), {DP}) AS whisker_hi,
  count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_outliers,
  min(v) AS "min", max(v) AS "max"
FROM bv JOIN q ON bv.grp = q.grp GROUP BY q.grp, q1, med, q3""",
        bv=f"SELECT grp, v FROM ({src}) s WHERE v IS NOT NULL AND NOT isnan(v)",
        q="""SELECT grp, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med,
       quantile_cont(v, 0.75) AS q3 FROM bv GROUP BY grp""")


def _round_box(df):
    return _round(df, DP, "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi")


@register("box_stats_length", box_sql(_len_src(True)))
def q_box_stats_length(spark, sf):
    return _round_box(ST.box_stats(C.sentiment_lengths(_rc(spark, sf)), "review_length", by="sentiment"))


@register("box_stats_length_from_counts", box_sql(_len_src(True)))
def q_box_stats_length_from_counts(spark, sf):
    lc = _length_counts(spark, sf)
    return _round_box(ST.box_stats(lc, "review_length", by="sentiment", weight="freq"))


@register("box_stats_percentage", box_sql(_pct_src(SQL_S)))
def q_box_stats_percentage(spark, sf):
    return _round_box(ST.box_stats(G.review_percentages(_s(spark, sf)), "percentage", by="sentiment"))


@register("box_stats_percentage_e", box_sql(_pct_src(SQL_E)))
def q_box_stats_percentage_e(spark, sf):
    return _round_box(ST.box_stats(G.review_percentages(_e(spark, sf)), "percentage", by="sentiment"))


def density_sql(src: str, grid: int = ST.KDE_GRID, cut: float = 0.0) -> str:
    """``src`` yields grp and v."""
    x = f"CASE WHEN i = {grid - 1} THEN gmax ELSE gmin + i * ((gmax - gmin) / {grid - 1}) END"
    return with_ctes(
        f"""SELECT grp AS "group", CAST(i AS INTEGER) AS i, round(max(x), {DP}) AS x,
  round(sum(freq * exp(-0.5 * ((x - v) / bw) * ((x - v) / bw))) / (max(n) * max(bw) * sqrt(2 * pi())), {DP_DENSITY}) AS density
FROM (SELECT fv.grp, fv.v, fv.freq, p.n, p.bw, p.i, {x} AS x
      FROM fv JOIN (SELECT st.*, t.i FROM st CROSS JOIN range(0, {grid}) t(i)) p ON fv.grp = p.grp) z
GROUP BY grp, i""",
        dv=f"SELECT grp, v FROM ({src}) s WHERE v IS NOT NULL AND NOT isnan(v)",
        fv="SELECT grp, v, count(*) AS freq FROM dv GROUP BY grp, v",
        st0="""SELECT grp, count(*) AS n, stddev_samp(v) * pow(CAST(count(*) AS DOUBLE), -0.2) AS bw,
       min(v) AS vmin, max(v) AS vmax FROM dv GROUP BY grp""",
        st=f"SELECT grp, n, bw, vmin - {cut} * bw AS gmin, vmax + {cut} * bw AS gmax FROM st0 WHERE bw > 0")


def _round_density(df):
    return _round(_round(df, DP, "x"), DP_DENSITY, "density")


@register("density_length", density_sql(_len_src(False)))
def q_density_length(spark, sf):
    return _round_density(ST.density(C.review_lengths(_rc(spark, sf)), "review_length"))


@register("density_length_by_sentiment",
          density_sql(_len_src(True), grid=ST.VIOLIN_GRID, cut=ST.VIOLIN_CUT))
def q_density_length_by_sentiment(spark, sf):
    """Violin of length by sentiment."""
    return _round_density(ST.density(C.sentiment_lengths(_rc(spark, sf)), "review_length",
                                     by="sentiment", grid=ST.VIOLIN_GRID, cut=ST.VIOLIN_CUT))


@register("density_percentage", density_sql(_pct_src(SQL_E), grid=ST.VIOLIN_GRID, cut=ST.VIOLIN_CUT))
def q_density_percentage(spark, sf):
    """Violin of the per-game percentage by sentiment."""
    return _round_density(ST.density(G.review_percentages(_e(spark, sf)), "percentage",
                                     by="sentiment", grid=ST.VIOLIN_GRID, cut=ST.VIOLIN_CUT))


@register("density_score", density_sql(f"SELECT 'all' AS grp, review_score AS v FROM ({SQL_OW}) o"))
def q_density_score(spark, sf):
    return _round_density(ST.density(FX.scores_ow(spark, sf), "review_score"))


@register("density_length_by_sentiment_from_counts",
          density_sql(_len_src(True), grid=ST.VIOLIN_GRID, cut=ST.VIOLIN_CUT))
def q_density_length_by_sentiment_from_counts(spark, sf):
    lc = _length_counts(spark, sf)
    return _round_density(ST.density(lc, "review_length", by="sentiment", grid=ST.VIOLIN_GRID,
                                     cut=ST.VIOLIN_CUT, weight="freq"))


# --------------------------------------------------------------------------
# C and G on continuous columns: item prices by line status, and their fourth
# power, which spreads over twelve orders of magnitude.
# --------------------------------------------------------------------------

SQL_PRICE = "SELECT l_linestatus AS grp, l_extendedprice AS v FROM lineitem"
SQL_SKEWED = ("SELECT l_linestatus AS grp, l_extendedprice * l_extendedprice * l_extendedprice * l_extendedprice AS v "
              "FROM lineitem")


def _prices(spark, sf, skewed=False):
    p = F.col("l_extendedprice")
    return spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_linestatus").alias("grp"), (p * p * p * p if skewed else p).alias("v"))


def _describe_sql(src, rel=DP):
    return with_ctes(f"""SELECT grp AS "group", count(*) AS count, round(avg(v), {rel}) AS mean,
  round(stddev_samp(v), {rel}) AS std, min(v) AS "min", round(quantile_cont(v, 0.25), {rel}) AS q25,
  round(quantile_cont(v, 0.5), {rel}) AS q50, round(quantile_cont(v, 0.75), {rel}) AS q75, max(v) AS "max"
FROM x GROUP BY grp""", x=src)


for _name, _src, _skewed in (("price", SQL_PRICE, False), ("skewed", SQL_SKEWED, True)):
    def _mk_profile(skewed):
        return lambda spark, sf: SC.score_profile(_prices(spark, sf, skewed), "v")

    def _mk_quartiles(skewed):
        return lambda spark, sf: ST.quartiles(_prices(spark, sf, skewed), "v", by="grp")

    register(f"score_profile_{_name}", _profile_sql(f"SELECT v AS review_score FROM ({_src}) s"))(_mk_profile(_skewed))
    register(f"quartile_ranks_{_name}", with_ctes("""SELECT grp AS "group", quantile_disc(v, 0.25) AS q1,
  quantile_disc(v, 0.5) AS median, quantile_disc(v, 0.75) AS q3 FROM x GROUP BY grp""", x=_src))(_mk_quartiles(_skewed))


@register("describe_price", _describe_sql(SQL_PRICE))
def q_describe_price(spark, sf):
    return _round(ST.describe(_prices(spark, sf), "v", by="grp"), DP, "mean", "std", "q25", "q50", "q75")


@register("trim_upper_quantile_price", f"""SELECT grp, v FROM ({SQL_PRICE}) a
WHERE v <= (SELECT quantile_cont(v, 0.95) FROM ({SQL_PRICE}) b)""")
def q_trim_upper_quantile_price(spark, sf):
    return ST.trim_upper_quantile(_prices(spark, sf), "v", 0.95)


@register("histogram_price_by_status", histogram_sql(SQL_PRICE, 50))
def q_histogram_price_by_status(spark, sf):
    return _round_hist(ST.histogram(_prices(spark, sf), "v", 50, by="grp"))


@register("box_stats_price", box_sql(SQL_PRICE))
def q_box_stats_price(spark, sf):
    return _round_box(ST.box_stats(_prices(spark, sf), "v", by="grp"))


@register("density_price", density_sql(SQL_PRICE))
def q_density_price(spark, sf):
    return _round_density(ST.density(_prices(spark, sf), "v", by="grp"))


def queries() -> dict[str, Query]:
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
