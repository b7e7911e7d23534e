"""The whole job on the smallest tables."""

import glob
import tempfile

from pyspark.sql import functions as F

from paths import SF_SMALL
from plaudit.operators import clean as C
from plaudit.operators import games as G
from plaudit.plans.job import ORIGINAL_LAYOUT, outputs, run_all, shared_tables
from plaudit.session import checkpoint_root
from plaudit.sources import fixtures as FX


def test_run_all_writes_every_table(spark):
    out = tempfile.mkdtemp(prefix="plaudit-job-", dir="/tmp")
    raw = FX.reviews_r(spark, SF_SMALL)
    root = checkpoint_root(spark).replace("file:", "")
    before = set(glob.glob(f"{root}/plaudit-run-*"))
    names = run_all(spark, raw, out)
    assert set(glob.glob(f"{root}/plaudit-run-*")) <= before  # intermediates removed
    expected = {"cleaning_audit", "corpus", "score_scale_summary", "global_binary_summary"}
    expected |= set(outputs(raw, dict.fromkeys(shared_tables(raw), raw)).keys())
    assert set(names) == expected
    audit = spark.read.parquet(f"{out}/cleaning_audit").first()
    cleaned = C.clean_reviews(raw)
    assert audit.rows_before == raw.count() and audit.rows_after == cleaned.count()
    got = {tuple(r) for r in spark.read.parquet(f"{out}/review_counts").collect()}
    assert got == {tuple(r) for r in G.review_counts(cleaned).collect()}
    corpus = spark.read.text(f"{out}/corpus")
    assert corpus.count() == cleaned.count()  # every review, no sample by default
    assert set(corpus.columns) == {"value", "sentiment"}
    assert spark.read.parquet(f"{out}/score_profile").first().binary
    lines = [r.value for r in spark.read.text(f"{out}/score_scale_summary").collect()]
    assert lines == ["min=0.0", "max=1.0", "distinct=2", "binary=True", "threshold=1.0"]
    summary = [r.value for r in spark.read.text(f"{out}/global_binary_summary").collect()]
    assert [g.split("=")[0] for g in summary] == ["positive_count", "negative_count", "positive_ratio"]
    assert len(summary[2].split(".")[1]) == 6


def test_run_all_reads_csv(spark, tmp_path):
    src = FX.reviews_e(spark, SF_SMALL).select(
        F.col("game_id").alias("Game ID"), "app_name", F.col("game").alias("Game Name"),
        "review_text", "review_score", "review_votes")
    csv = str(tmp_path / "in")
    src.write.option("header", True).option("escape", '"').csv(csv)
    out = str(tmp_path / "out")
    run_all(spark, csv, out, only=["review_counts"], write_text_corpus=False)
    n = spark.read.parquet(f"{out}/review_counts").agg(F.sum("review_count")).first()[0]
    assert n == C.clean_reviews(FX.reviews_e(spark, SF_SMALL)).count()


def test_run_all_from_files_equals_run_all_from_a_table(spark, tmp_path):
    """Late de-duplication (input in files) and split CSV reading leave the
    rows that the plain way leaves."""
    src = FX.reviews_r(spark, "/root/testdata/sf0.01").withColumn("review_votes", F.col("row_id") % 7).drop("row_id")
    again = src.filter(F.abs(F.hash("review_text")) % 20 == 0)
    src = src.unionByName(again).unionByName(again.limit(3).withColumn("review_text", F.lit(" \n\"x\", y")))
    src.write.parquet(str(tmp_path / "p"))
    src.coalesce(1).write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(str(tmp_path / "c"))
    names = ["review_counts", "correlation_data"]

    def rows(name, **kw):
        out = str(tmp_path / f"out-{name}")
        run_all(spark, kw.pop("reviews"), out, only=names, write_text_corpus=False, order_by="review_votes", **kw)
        tables = [spark.read.parquet(f"{out}/{n}") for n in names + ["cleaning_audit"]]
        return [sorted(tuple(map(str, r)) for r in t.select(sorted(t.columns)).collect()) for t in tables]

    want = rows("table", reviews=spark.read.parquet(str(tmp_path / "p")))
    assert want[2][0][0] != want[2][0][1]  # duplicates went
    assert rows("parquet", reviews=str(tmp_path / "p"), input_format="parquet") == want
    assert rows("csv", reviews=str(tmp_path / "c")) == rows("split", reviews=str(tmp_path / "c"), split_csv=True) == want


def test_derived_outputs_equal_direct_operators(spark):
    """The job derives outputs from small shared tables; each must equal the
    operator applied to the cleaned reviews directly."""
    from plaudit.operators import stats as ST
    from plaudit.operators import text as TX

    raw = FX.reviews_r(spark, "/root/testdata/sf0.01")
    out = tempfile.mkdtemp(prefix="plaudit-job-", dir="/tmp")
    names = ["histogram_length_50", "histogram_length_trimmed_20", "histogram_length_by_sentiment_50",
             "describe_lengths", "box_stats_length", "density_length", "histogram_score",
             "cloud_weights_positive", "cloud_weights_all", "top_apps_by_avg", "top_words",
             "sentiment_counts", "avg_scores", "reviews_percentage", "top_positive_games"]
    run_all(spark, raw, out, only=names, write_text_corpus=False)
    cleaned = C.clean_reviews(raw)
    lengths = C.sentiment_lengths(cleaned)
    gs = G.games_sentiment(cleaned)
    direct = {
        "histogram_length_50": ST.histogram(lengths, "review_length", 50),
        "histogram_length_trimmed_20": ST.histogram(
            ST.trim_upper_quantile(lengths, "review_length", 0.95), "review_length", 20),
        "histogram_length_by_sentiment_50": ST.histogram(lengths, "review_length", 50, by="sentiment"),
        "describe_lengths": ST.describe(lengths, "review_length").drop("group"),
        "box_stats_length": ST.box_stats(lengths, "review_length", by="sentiment"),
        "density_length": ST.density(lengths, "review_length"),
        "histogram_score": ST.histogram(cleaned, "review_score", 20),
        "cloud_weights_positive": TX.cloud_weights(
            TX.cleaned_word_freq(cleaned, "positive"), 100),
        "cloud_weights_all": TX.cloud_weights(TX.cleaned_word_freq(cleaned), 150),
        "top_apps_by_avg": G.top_apps_by_avg(cleaned),
        "top_words": TX.top_words(TX.word_counts(cleaned)),
        "sentiment_counts": G.sentiment_counts(cleaned),
        "avg_scores": G.avg_scores(cleaned),
        "reviews_percentage": G.review_percentages(cleaned),
        "top_positive_games": G.top_positive_games(gs),
    }

    def norm(rows):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)

    for name, df in direct.items():
        got = spark.read.parquet(f"{out}/{name}")
        assert got.columns == df.columns, name
        assert norm(got.collect()) == norm(df.collect()), name


def test_original_layout(spark, tmp_path):
    raw = FX.reviews_e(spark, SF_SMALL)
    out = str(tmp_path / "out")
    run_all(spark, raw, out, only=list(ORIGINAL_LAYOUT), write_text_corpus=False, original_layout=True)
    rdd = spark.read.option("header", True).csv(f"{out}/original/rdd_sentiment_counts")
    assert rdd.columns == ["game", "positive_reviews_rdd", "negative_reviews_rdd",
                           "total_reviews_rdd", "positive_ratio_rdd"]
    dfs = spark.read.option("header", True).csv(f"{out}/original/df_sentiment_counts")
    assert dfs.columns == ["game", "positive_reviews_df", "negative_reviews_df", "positive_ratio_df"]
    counts = spark.read.option("header", True).csv(f"{out}/original/df_review_counts")
    assert counts.columns == ["game", "review_count_df"]
    assert counts.count() == G.review_counts(C.clean_reviews(raw)).count() > 0


def test_outputs_never_rescan_the_raw_input(spark):
    """After materialisation every output reads only the job's own parquet
    intermediates, never the raw source tables."""
    import io
    import contextlib

    from plaudit.plans.job import prepare, with_sentiment
    from plaudit.sources.sinks import drop_folder, materialize, run_folder

    raw = FX.reviews_r(spark, SF_SMALL)
    folder = run_folder(spark)
    base = with_sentiment(materialize(prepare(raw), "cleaned", folder))
    sh = {name: materialize(build(), name, folder) for name, build in shared_tables(base).items()}
    try:
        for name, build in outputs(base, sh).items():
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                build().explain("formatted")
            text = buf.getvalue()
            assert "documents.parquet" not in text and "labels.parquet" not in text, name
            assert "plaudit-" in text, name
    finally:
        drop_folder(folder)


def test_only_builds_what_it_needs(spark, monkeypatch):
    from plaudit.plans import job

    built = []
    real = job.materialize
    monkeypatch.setattr(job, "materialize", lambda df, name, folder: built.append(name) or real(df, name, folder))
    out = tempfile.mkdtemp(prefix="plaudit-job-", dir="/tmp")
    names = run_all(spark, FX.reviews_e(spark, SF_SMALL), out, only=["review_counts"], write_text_corpus=False,
                    original_layout=True)
    assert set(built) == {"cleaned", "game_metrics"} and set(names) == {"cleaning_audit", "review_counts"}
    assert set(job.NEEDS.values()) == set(shared_tables(spark.range(1)))


def test_failed_run_leaves_no_intermediates(spark, monkeypatch):
    import pytest
    from plaudit.plans import job

    root = checkpoint_root(spark).replace("file:", "")
    before = set(glob.glob(f"{root}/plaudit-run-*"))
    monkeypatch.setattr(job, "write_table", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_all(spark, FX.reviews_e(spark, SF_SMALL), "/tmp/never", only=["review_counts"], write_text_corpus=False)
    assert set(glob.glob(f"{root}/plaudit-run-*")) <= before


def test_threshold_rule_labels_from_the_materialised_table(spark):
    out = tempfile.mkdtemp(prefix="plaudit-job-", dir="/tmp")
    raw = FX.reviews_d(spark, SF_SMALL).withColumn("review_score", (F.col("row_id") % 5 + 1).cast("double"))
    run_all(spark, raw, out, dedup=False, rule="threshold", only=["sentiment_counts", "score_profile"],
            write_text_corpus=False)
    got = spark.read.parquet(f"{out}/sentiment_counts").agg(F.sum("positive_reviews")).first()[0]
    assert got == C.clean_reviews(raw, dedup=False).where("review_score >= 4").count() > 0


def test_command_line_keeps_the_submitters_settings(tmp_path):
    """A session submitted with 37 shuffle partitions still has 37."""
    import subprocess
    import sys
    from pathlib import Path

    (tmp_path / "in.csv").write_text(
        'Game ID,app_name,Game Name,review_text,review_score,review_votes\n1,a,g,"good ""one"",\nyes",1,0\n')
    code = (
        "from pyspark.sql import SparkSession\n"
        "s = (SparkSession.builder.master('local[2]').config('spark.sql.shuffle.partitions', '37')"
        ".config('spark.ui.enabled', 'false').getOrCreate())\n"
        "from plaudit.plans.job import main\n"
        f"main(['--path', '{tmp_path}/in.csv', '--out', '{tmp_path}/out'])\n"
        "print('partitions', s.conf.get('spark.sql.shuffle.partitions'))\n")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300,
                          cwd=Path(__file__).parents[1])
    assert "partitions 37" in done.stdout, done.stderr[-2000:]
