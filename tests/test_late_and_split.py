"""Split reading of quoted CSV, exact top lists by cells, late de-duplication."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from paths import SF_ORACLE
from plaudit.operators import clean as C
from plaudit.operators import text as TX
from plaudit.operators.topk import exact_top
from plaudit.sources import fixtures as FX
from plaudit.sources.reviews import read_reviews
from plaudit.sources.split_csv import _records, read_split_csv

TEXTS = ['plain', 'two\nlines', 'a "quoted" word', '"', '""\n""', 'comma, here', '\n', '\n\n"\n', 'Ünï\r\ncode 漢字', 'x' * 300, None, ' edge ']


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_records_at_every_range_size(tmp_path):
    """Every cut of a small file gives each record once, in order."""
    data = b'h,i\n1,"a\nb"\n\n2,"say ""x""\n"\n3,\n"4","\n"\r\n5,"""q"""'
    (tmp_path / "f.csv").write_bytes(data)
    path = str(tmp_path / "f.csv")
    want = [b'h,i', b'1,"a\nb"', b'', b'2,"say ""x""\n"', b'3,', b'"4","\n"\r', b'5,"""q"""']
    for size in range(1, len(data) + 1):
        for block in (1, 2, 7, 1000):
            got = []
            for start in range(0, len(data), size):
                inside = data[:start].count(b'"') % 2 == 1
                for found in _records(path, start, min(start + size, len(data)), inside, ord(","), block):
                    got += found
            assert got == want, (size, block)


@pytest.mark.parametrize("range_bytes", [97, 1 << 12, 1 << 26])
def test_split_reader_equals_the_whole_file_reader(spark, tmp_path, range_bytes):
    rows = [(i, TEXTS[i % len(TEXTS)], float(i)) for i in range(60)]
    src = spark.createDataFrame(rows, "`Game ID` long, review_text string, review_score double").coalesce(1)
    path = str(tmp_path / "in dir")
    (src.write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    split = read_split_csv(spark, path, range_bytes=range_bytes)
    whole = read_reviews(spark, path)
    assert split.columns == whole.columns
    assert _rows(split) == _rows(whole) and split.count() == 60


def test_split_reader_uses_several_tasks(spark, tmp_path):
    FX.reviews_r(spark, SF_ORACLE).coalesce(1).write.option("header", True).option("escape", '"').csv(str(tmp_path / "in"))
    split = read_split_csv(spark, str(tmp_path / "in"), range_bytes=1 << 18)
    tasks = split.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 4 and _rows(split) == _rows(read_reviews(spark, str(tmp_path / "in")))


@pytest.mark.parametrize("data", [b'a,b\n5" disk,x\n', b'a,b\n"open,x\n', b'a,b\n"x\\"y",z\n'])
def test_split_reader_refuses_other_quoting(spark, tmp_path, data):
    (tmp_path / "f.csv").write_bytes(data)
    with pytest.raises(Exception, match="split=False"):
        read_split_csv(spark, str(tmp_path / "f.csv")).collect()


def test_split_reader_edges(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b'\xef\xbb\xbf"a","a",\r\n1,2,3\r\n\r\n4\r\n')
    df = read_split_csv(spark, str(tmp_path / "f.csv"))
    assert df.columns == ["a0", "a1", "_c2"] and _rows(df) == [("1", "2", "3"), ("4", None, None)]
    (tmp_path / "h.csv").write_bytes(b'"x, y",b,,B,"say ""c"""\n"1","2\n2",3,4,5\n')
    one, other = (read(spark, str(tmp_path / "h.csv")) for read in (read_split_csv, read_reviews))
    assert one.columns == other.columns and _rows(one) == _rows(other)
    (tmp_path / "g.csv.gz").write_bytes(b"x")
    with pytest.raises(ValueError, match="compressed"):
        read_split_csv(spark, str(tmp_path / "g.csv.gz"))


@pytest.mark.parametrize("n,min_freq,cells", [(15, 1, 1 << 16), (5, 3, 8), (0, 1, 64), (2000, 2, 64), (3, 1, 1)])
@pytest.mark.parametrize("shape", ["skewed", "flat", "empty", "nulls"])
def test_top_is_exact(spark, n, min_freq, cells, shape):
    rng = random.Random(7)
    words = {"skewed": [f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(4000)],
             "flat": [f"w{i % 700}" for i in range(1400)], "empty": [],
             "nulls": [None, "", "a", "a", None, "b"]}[shape]
    got = exact_top(spark.createDataFrame([(w,) for w in words], "word string"), "word", n, min_freq, cells)
    counts = [(w, c) for w, c in collections.Counter(words).items() if c >= min_freq]
    want = sorted(counts, key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:n]
    assert [tuple(r) for r in got.collect()] == want


def test_direct_lists_equal_those_from_the_counts(spark):
    df = FX.reviews_r(spark, SF_ORACLE)
    assert _rows(TX.most_frequent_words(df)) == _rows(TX.top_words(TX.word_counts(df)))
    for sentiment, n in ((None, 150), ("positive", 100)):
        want = TX.cloud_weights(TX.cleaned_word_freq(df, sentiment=sentiment), n)
        assert _rows(TX.cloud_words(df, sentiment=sentiment)) == _rows(want)


@pytest.mark.parametrize("max_hashes", [1 << 20, 0])
def test_late_dedup_equals_dedup(spark, max_hashes):
    df = FX.reviews_r(spark, SF_ORACLE)
    twice = df.unionByName(df.filter("row_id % 50 = 0").withColumn("row_id", F.col("row_id") + 1000000))
    twice = twice.unionByName(df.limit(2).withColumn("review_text", F.lit(None).cast("string")))
    for order_by in ("row_id", None):
        assert _rows(C.dedup_reviews_late(twice, order_by, max_hashes=max_hashes)) == _rows(C.dedup_reviews(twice, order_by))


def test_late_dedup_keeps_keys_that_share_a_hash(spark, monkeypatch):
    """With every key in one hash the whole keys decide."""
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", 3), (1, "a", 0), (None, None, 5), (None, None, 4)],
                               "game_id long, review_text string, row_id long")
    monkeypatch.setattr(C.F, "xxhash64", lambda *c: F.lit(1).cast("long") + F.lit(0))
    got = _rows(C.dedup_reviews_late(df, "row_id"))
    assert got == sorted([(1, "a", 0), (1, "b", 2), (2, "a", 3), (None, None, 4)], key=repr)
