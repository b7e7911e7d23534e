"""The whole analysis as one Spark application (the original ``main``).

Plan:

1. parse CSV input once into parquet (a multi-line file is one task for as
   long as it is CSV), clean (+ optional sample) it, add ``review_length``, and
   write the result once as parquet under ``spark.checkpoint.dir``
   (``materialize``): the only dedup shuffle; an executor loss later re-reads
   files instead of recomputing them. Sentiment is a column over that table;
   under the threshold rule its score profile is computed from it first.
   Input that lies in files is de-duplicated late: a pass over the key columns
   finds the keys that may occur twice, only their rows are shuffled.
2. compute the small shared aggregates once, each from the columns it needs
   (parquet column pruning), and materialise them too:

   * ``game_metrics``   one row per game       -> every per-game table
   * ``length_counts``  (sentiment, length, n) -> every length statistic
   * ``score_distribution`` (score, n)         -> score histogram and density
   * ``word_counts``    raw tokens             -> top words
   * ``word_freq_by_sentiment`` cleaned tokens -> the three clouds
   * ``app_avg_scores``                         -> top apps
   * ``score_profile``, ``global_sentiment_summary`` (one row each) -> the
     tables and their ``key=value`` text forms

   so the large table is scanned about a dozen times in total (most scans
   read one or two narrow columns), instead of once per output table.
3. derive every output from those tables and write it to ``out_dir/<name>``.

Nothing is collected to the driver: gates and thresholds are scalar
subqueries inside the plans. The intermediates are deleted at the end, also
after a failure.

Command line::

    python -m plaudit.plans.job --path reviews.csv --out out/ [--no-dedup]
        [--sample-fraction 0.5] [--text-fraction 0.1] [--format parquet|csv]
        [--split-csv]
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.functions.sentiment import sentiment as sentiment_expr
from plaudit.operators import clean as C
from plaudit.operators import games as G
from plaudit.operators import scale as SC
from plaudit.operators import stats as ST
from plaudit.operators import text as TX
from plaudit.sources.reviews import read_reviews, standardize_columns
from plaudit.sources.sinks import (drop_folder, materialize, run_folder, write_corpus,
                                   write_key_values, write_table)

NUMERIC_FEATURES = ("review_length", "review_score", "review_votes")


def prepare(raw: DataFrame, dedup: bool = True, order_by: str | None = None,
            sample_fraction: float = 1.0, late: bool = False, folder: str | None = None) -> DataFrame:
    """Standardised, cleaned reviews with ``review_length`` (lazy but for the
    first pass of ``late``; ``run_all`` materialises it)."""
    cleaned = C.clean_reviews(standardize_columns(raw), dedup=dedup, order_by=order_by, late=late, folder=folder)
    cleaned = C.sample_reviews(cleaned, sample_fraction)
    return cleaned.select("*", F.length("review_text").alias("review_length"))


def with_sentiment(base: DataFrame, rule: str = "equals_one", threshold=None) -> DataFrame:
    return base.select("*", sentiment_expr("review_score", rule, threshold).alias("sentiment"))


def shared_tables(base: DataFrame, rule: str = "equals_one", threshold=None,
                  text_fraction: float = 1.0) -> dict[str, Callable[[], DataFrame]]:
    """The small aggregates the outputs are derived from (lazy)."""
    st = {"rule": rule, "threshold": threshold}
    return {
        "game_metrics": lambda: G.game_metrics(base, **st),
        "length_counts": lambda: base.groupBy("sentiment", "review_length").agg(
            F.count(F.lit(1)).alias("freq")),
        "score_distribution": lambda: G.score_distribution(base),
        "word_counts": lambda: TX.word_counts(base),
        "word_freq_by_sentiment": lambda: TX.sentiment_word_counts(
            base, fraction=text_fraction, **st),
        "app_avg_scores": lambda: G.app_avg_scores(base),
        "score_profile": lambda: SC.score_profile(base),
        "global_sentiment_summary": lambda: SC.global_sentiment_summary(base),
    }


def outputs(base: DataFrame, sh: dict[str, DataFrame], rule: str = "equals_one",
            threshold=None) -> dict[str, Callable[[], DataFrame]]:
    """Every output table, lazily, from the cleaned reviews ``base`` and the
    materialised shared tables ``sh`` (see ``shared_tables``; those that the
    chosen outputs don't need may be missing)."""
    st = {"rule": rule, "threshold": threshold}
    gm, lc, sc = sh.get("game_metrics"), sh.get("length_counts"), sh.get("score_distribution")
    wc, swc, app = sh.get("word_counts"), sh.get("word_freq_by_sentiment"), sh.get("app_avg_scores")

    def gs() -> DataFrame:
        return G.games_sentiment_from_metrics(gm)

    def pct() -> DataFrame:
        return G.review_percentages_from_metrics(gm)

    def features() -> DataFrame:
        return base.select(*[c for c in NUMERIC_FEATURES if c in base.columns])

    def length_hist(bins: int, by: str | None = None) -> Callable[[], DataFrame]:
        return lambda: ST.histogram(lc, "review_length", bins, by=by, weight="freq")

    return {
        # tables the original job writes
        "review_counts": lambda: G.review_counts_from_metrics(gm),
        "avg_scores": lambda: G.avg_scores_from_metrics(gm),
        "sentiment_counts": lambda: G.sentiment_counts_from_metrics(gm),
        "games_sentiment": gs,
        "reviews_percentage": pct,
        "top_games": lambda: G.top_games_from_metrics(gm),
        "score_distribution": lambda: sc,
        "app_avg_scores": lambda: app,
        "review_lengths": lambda: base.select("review_length"),
        "sentiment_length": lambda: base.select("sentiment", "review_length"),
        "correlation_data": features,
        "word_counts": lambda: wc,
        "score_profile": lambda: sh["score_profile"],
        "global_sentiment_summary": lambda: sh["global_sentiment_summary"],
        # data behind each chart
        "length_counts": lambda: lc,
        "top_apps_by_avg": lambda: G.top_apps_from_avg(app),
        "histogram_score": lambda: ST.histogram(sc, "review_score", 20, weight="count"),
        "density_score": lambda: ST.density(sc, "review_score", weight="count"),
        "histogram_length_50": length_hist(50),
        "histogram_length_15": length_hist(15),
        "histogram_length_30": length_hist(30),
        "histogram_length_by_sentiment_50": length_hist(50, by="sentiment"),
        "histogram_length_trimmed_20": lambda: ST.histogram(
            lc, "review_length", 20, weight="freq", upper=0.95),
        "density_length": lambda: ST.density(lc, "review_length", weight="freq"),
        "density_length_by_sentiment": lambda: ST.density(
            lc, "review_length", by="sentiment", grid=ST.VIOLIN_GRID, cut=ST.VIOLIN_CUT,
            weight="freq"),
        "describe_lengths": lambda: ST.describe(lc, "review_length", weight="freq").drop("group"),
        "box_stats_length": lambda: ST.box_stats(lc, "review_length", by="sentiment", weight="freq"),
        "sentiment_shares": lambda: ST.sentiment_shares(base, **st),
        "correlation_matrix": lambda: ST.correlation_matrix(features()),
        "top_words": lambda: TX.top_words(wc),
        "cloud_weights_all": lambda: TX.cloud_weights(
            TX.word_freq_from_counts(swc), TX.CLOUD_WORDS_ALL),
        "cloud_weights_positive": lambda: TX.cloud_weights(
            TX.word_freq_from_counts(swc, "positive"), TX.CLOUD_WORDS_BY_SENTIMENT),
        "cloud_weights_negative": lambda: TX.cloud_weights(
            TX.word_freq_from_counts(swc, "negative"), TX.CLOUD_WORDS_BY_SENTIMENT),
        "top_positive_games": lambda: G.top_positive_games(gs()),
        "bottom_positive_games": lambda: G.bottom_positive_games(gs()),
        "top_reviewed_games": lambda: G.top_reviewed_games(gs()),
        "popularity_points": lambda: G.popularity_points(gs()),
        "histogram_percentage_20": lambda: ST.histogram(pct(), "percentage", 20, by="sentiment"),
        "histogram_percentage_15": lambda: ST.histogram(pct(), "percentage", 15, by="sentiment"),
        "percentage_summary": lambda: G.percentage_summary(pct()),
        "box_stats_percentage": lambda: ST.box_stats(pct(), "percentage", by="sentiment"),
        "density_percentage": lambda: ST.density(pct(), "percentage", by="sentiment",
                                                 grid=ST.VIOLIN_GRID, cut=ST.VIOLIN_CUT),
        "low_positive_games": lambda: G.low_positive_games(pct()),
        "low_positive_extended": lambda: G.low_positive_extended(pct()),
        "low_positive_summary": lambda: G.low_positive_summary(pct()),
        "percentage_categories": lambda: G.percentage_categories(pct()),
    }


# FIXED VALUES — file and column names of the original job's tabular outputs,
# for ``run_all(original_layout=True)``: file -> (our table, column renames;
# None = the column is not in the original file).
ORIGINAL_LAYOUT = {
    "rdd_review_counts": ("review_counts", {"review_count": "review_count_rdd"}),
    "rdd_avg_scores": ("avg_scores", {"avg_review_score": "avg_review_score_rdd"}),
    "rdd_sentiment_counts": ("sentiment_counts", {
        "positive_reviews": "positive_reviews_rdd", "negative_reviews": "negative_reviews_rdd",
        "total_reviews": "total_reviews_rdd", "positive_ratio": "positive_ratio_rdd"}),
    "df_review_counts": ("review_counts", {"review_count": "review_count_df"}),
    "df_avg_scores": ("avg_scores", {"avg_review_score": "avg_review_score_df"}),
    "df_sentiment_counts": ("sentiment_counts", {
        "positive_reviews": "positive_reviews_df", "negative_reviews": "negative_reviews_df",
        "total_reviews": None, "positive_ratio": "positive_ratio_df"}),
    "top_games": ("top_games", {}),
    "score_distribution": ("score_distribution", {}),
    "app_avg_scores": ("app_avg_scores", {}),
    "review_lengths": ("review_lengths", {}),
    "sentiment_length": ("sentiment_length", {}),
    "games_sentiment": ("games_sentiment", {}),
    "reviews_percentage": ("reviews_percentage", {}),
    "correlation_data": ("correlation_data", {}),
    "word_counts": ("word_counts", {}),
}


def original_tables(outs: dict[str, Callable[[], DataFrame]]) -> dict[str, Callable[[], DataFrame]]:
    """The original job's tabular outputs under its file and column names.

    ``df_sentiment_counts`` has no total column there; ``score_distribution``
    is (score, count) over all rows here instead of the first 500 000 raw
    scores.
    """
    def build(table: str, renames: dict[str, str | None]) -> Callable[[], DataFrame]:
        def make() -> DataFrame:
            df = outs[table]()
            return df.select(*[F.col(c).alias(renames.get(c, c)) for c in df.columns
                               if renames.get(c, c) is not None])
        return make
    return {name: build(t, r) for name, (t, r) in ORIGINAL_LAYOUT.items()}


def _run_concurrently(tasks: dict[str, Callable[[], None]], parallelism: int) -> list[str]:
    """Submit independent Spark jobs from ``parallelism`` driver threads.

    The jobs share the cluster; small ones no longer wait for each other.
    Any failure is raised after the running jobs finish.
    """
    if parallelism <= 1:
        for task in tasks.values():
            task()
        return list(tasks)
    with ThreadPoolExecutor(max_workers=parallelism, thread_name_prefix="plaudit") as pool:
        futures = {name: pool.submit(task) for name, task in tasks.items()}
        for f in futures.values():
            f.result()
    return list(tasks)


# Shared tables that an output is derived from; others read the cleaned table
# alone. ``only`` builds no more than its outputs need.
NEEDS = {
    **dict.fromkeys(("review_counts", "avg_scores", "sentiment_counts", "games_sentiment", "reviews_percentage",
                     "top_games", "top_positive_games", "bottom_positive_games", "top_reviewed_games",
                     "popularity_points", "histogram_percentage_20", "histogram_percentage_15",
                     "percentage_summary", "box_stats_percentage", "density_percentage", "low_positive_games",
                     "low_positive_extended", "low_positive_summary", "percentage_categories"), "game_metrics"),
    **dict.fromkeys(("length_counts", "histogram_length_50", "histogram_length_15", "histogram_length_30",
                     "histogram_length_by_sentiment_50", "histogram_length_trimmed_20", "density_length",
                     "density_length_by_sentiment", "describe_lengths", "box_stats_length"), "length_counts"),
    **dict.fromkeys(("score_distribution", "histogram_score", "density_score"), "score_distribution"),
    **dict.fromkeys(("word_counts", "top_words"), "word_counts"),
    **dict.fromkeys(("cloud_weights_all", "cloud_weights_positive", "cloud_weights_negative"),
                    "word_freq_by_sentiment"),
    **dict.fromkeys(("app_avg_scores", "top_apps_by_avg"), "app_avg_scores"),
    "score_profile": "score_profile", "score_scale_summary": "score_profile",
    "global_sentiment_summary": "global_sentiment_summary", "global_binary_summary": "global_sentiment_summary",
}


def run_all(spark: SparkSession, reviews: DataFrame | str, out_dir: str, *,
            input_format: str = "csv", dedup: bool = True, order_by: str | None = None,
            sample_fraction: float = 1.0, text_fraction: float = 1.0, rule: str = "equals_one",
            out_format: str = "parquet", write_text_corpus: bool = True,
            only: list[str] | None = None, keep_intermediate: bool = False,
            parallelism: int = 8, original_layout: bool = False, split_csv: bool = False) -> list[str]:
    """Run the whole analysis; returns the names of the written tables.

    CSV input is parsed once into parquet, which every later read can split;
    ``split_csv`` parses it by byte ranges too (``read_split_csv``: uncompressed
    RFC 4180 files, anything else raises). A path is read up to three times
    before the cleaned table is written, a DataFrame once.
    After the cleaned table and the shared aggregates are materialised, the
    output writes are independent jobs submitted ``parallelism`` at a time.
    ``text_fraction`` is the share of the reviews that the word clouds and the
    corpus use: all of them by default, 0.1 as in the original job. ``only``
    names the outputs to write (of ``outputs``, the two summaries and, with
    ``original_layout``, the original's files); tables that none of them needs
    are not built. The intermediates lie in one run folder and are deleted at
    the end, also after a failure, unless ``keep_intermediate``.
    ``original_layout`` also writes the original job's 15 tabular files (header
    CSV, its file and column names) under ``out_dir/original/``.
    """
    folder = run_folder(spark)
    try:
        return _run(spark, reviews, out_dir.rstrip("/"), folder, input_format, dedup, order_by, sample_fraction,
                    text_fraction, rule, out_format, write_text_corpus, only, parallelism, original_layout, split_csv)
    finally:
        if not keep_intermediate:
            drop_folder(folder)


def _run(spark: SparkSession, reviews: DataFrame | str, out: str, folder: str, input_format: str, dedup: bool,
         order_by: str | None, sample_fraction: float, text_fraction: float, rule: str, out_format: str,
         write_text_corpus: bool, only: list[str] | None, parallelism: int, original_layout: bool,
         split_csv: bool) -> list[str]:
    in_files = not isinstance(reviews, DataFrame)
    if not in_files:
        raw = reviews
    else:
        raw = read_reviews(spark, reviews, input_format, split=split_csv)
        if input_format == "csv":
            raw = materialize(standardize_columns(raw), "raw", folder)
    base = materialize(prepare(raw, dedup, order_by, sample_fraction, in_files, folder), "cleaned", folder)
    threshold, sh = None, {}
    if rule == "threshold":
        # one profile of the materialised table labels it and everything after
        sh["score_profile"] = materialize(SC.score_profile(base), "score_profile", folder)
        threshold = sh["score_profile"].select("threshold").scalar()
    base = with_sentiment(base, rule, threshold)

    def wanted(name: str) -> bool:
        return only is None or name in only

    layout = {n: t for n, (t, _) in ORIGINAL_LAYOUT.items() if original_layout and wanted(n)}
    names = {n for n in NEEDS if wanted(n)} | set(layout.values())
    needed = {NEEDS[n] for n in names if n in NEEDS}
    shares = {n: b for n, b in shared_tables(base, rule, threshold, text_fraction).items()
              if n in needed and n not in sh}

    def share(name: str, build: Callable[[], DataFrame]) -> Callable[[], None]:
        def task() -> None:
            sh[name] = materialize(build(), name, folder)
        return task

    _run_concurrently({n: share(n, b) for n, b in shares.items()}, parallelism)

    def write(build: Callable[[], DataFrame], name: str) -> Callable[[], None]:
        return lambda: write_table(build(), f"{out}/{name}", out_format)

    tasks: dict[str, Callable[[], None]] = {
        "cleaning_audit": write(lambda: C.cleaning_audit(raw, base), "cleaning_audit")}
    outs = outputs(base, sh, rule, threshold)
    for name, build in outs.items():
        if wanted(name):
            tasks[name] = write(build, name)
    for name, build in original_tables(outs).items():
        if name in layout:
            tasks[f"original/{name}"] = (lambda b=build, n=name: write_table(
                b(), f"{out}/original/{n}", "csv"))
    if wanted("score_scale_summary"):
        tasks["score_scale_summary"] = lambda: write_key_values(
            sh["score_profile"], f"{out}/score_scale_summary")
    if wanted("global_binary_summary"):
        tasks["global_binary_summary"] = lambda: write_key_values(
            sh["global_sentiment_summary"], f"{out}/global_binary_summary",
            {"positive_ratio": "%.6f"})
    if write_text_corpus:
        tasks["corpus"] = lambda: write_corpus(
            C.sample_reviews(base, text_fraction), f"{out}/corpus", rule=rule, threshold=threshold)
    return _run_concurrently(tasks, parallelism)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Review analytics on Spark")
    ap.add_argument("--path", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--input-format", default="csv")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--sample-fraction", type=float, default=1.0)
    ap.add_argument("--text-fraction", type=float, default=1.0,
                    help="share of the reviews in the word clouds and the corpus (the original job: 0.1)")
    ap.add_argument("--no-dedup", action="store_true")
    ap.add_argument("--order-by", default=None)
    ap.add_argument("--sentiment-rule", default="equals_one", choices=["equals_one", "threshold"])
    ap.add_argument("--parallelism", type=int, default=8, help="concurrent output jobs")
    ap.add_argument("--original-layout", action="store_true",
                    help="also write the original 15 tables under out/original/")
    ap.add_argument("--split-csv", action="store_true",
                    help="read uncompressed RFC 4180 files by byte ranges, many tasks to a file")
    a = ap.parse_args(argv)
    # Shuffle partitions, memory and master are the submitter's to set.
    spark = SparkSession.builder.appName("plaudit").getOrCreate()
    names = run_all(spark, a.path, a.out, input_format=a.input_format, dedup=not a.no_dedup,
                    order_by=a.order_by, sample_fraction=a.sample_fraction, text_fraction=a.text_fraction,
                    rule=a.sentiment_rule, out_format=a.format, parallelism=a.parallelism,
                    original_layout=a.original_layout, split_csv=a.split_csv)
    print(f"wrote {len(names)} tables to {a.out}")


if __name__ == "__main__":
    main()
