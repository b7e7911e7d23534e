"""Registered queries of the training-data operators: thin wrappers that apply
each operator to its whole table and derive the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, katz, linedup, materialise, mixing, periodic, pii, quality, simhash, suffixdedup, warc, whitening, winnow


# Words after lower-casing A-Z only; windows of 10 words, shorter items whole.
OP5_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
win AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(words), 10) AS k,
    unnest([array_to_string(list_slice(words, i, i + least(len(words), 10) - 1), ' ')
            for i in range(1, greatest(len(words) - 9, 1) + 1)]) AS win
  FROM iw WHERE len(words) > 0),
ks AS (SELECT DISTINCT k FROM win),
grams AS (
  SELECT doc_id, k, unnest(range(1, len(words) - k + 2)) AS i, words FROM w, ks WHERE len(words) >= k),
hit AS (
  SELECT g.doc_id, g.i, g.k, win.item FROM
    (SELECT doc_id, i, k, array_to_string(list_slice(words, i, i + k - 1), ' ') AS win FROM grams) g
    JOIN win ON win.k = g.k AND win.win = g.win),
pos AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM
    (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hit)) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS h
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(coalesce(pos.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(its.n, 0) AS BIGINT) AS n_items, coalesce(its.h, sha256('')) AS items_sha256,
  coalesce(pos.n, 0) > 0 AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP1_SQL = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha1(coalesce(html, '')) AS d
  FROM pages),
g AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY d, n) ELSE page_id END AS keep FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM g
"""


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back, payloads checked."""
    path = warc.write_archives(_table(spark, sf_dir, "pages"), min_revisit=1000)
    return warc.read_archives(spark, path, payload="verify").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes inside a 100-byte string that also starts earlier are removed."""
    out = suffixdedup.remove_repeats(_table(spark, sf_dir, "documents"), length=100)
    return out.select(
        "doc_id", F.length("text_bytes").cast("long").alias("n_bytes"),
        (F.length("text_bytes") - F.length("kept_bytes")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"))


# The pseudonyms of a release share one key; a deployment passes its own.
OP3_KEY = "plaudit release key"


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by format-preserving pseudonyms."""
    out = pii.pseudonymise(_table(spark, sf_dir, "documents"), OP3_KEY)
    return out.select(
        "doc_id", "n_found", F.array_join(F.array_sort(F.array_distinct("found.kind")), ",").alias("kinds"), "text",
        F.col("found.pseudonym").alias("pseudonyms"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates over 3-word shingles, at most 3 differing bits."""
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside a 10-word window of a benchmark item."""
    found = decontam.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of each text and its edited text."""
    out = winnow.fingerprint_edits(_table(spark, sf_dir, "documents"), gram=5, window=8)
    return out.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        winnow.as_text("fp").alias("fingerprint"), winnow.as_text("edited_fp").alias("edited_fingerprint"),
        winnow.likeness("fp", "edited_fp").alias("near_edited"), winnow.likeness("fp", "next_fp").alias("near_next"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compression quality score of each document; predicted at 0.7."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model, threshold=0.7)


OP8_SQL = r"""
WITH u AS (
  SELECT doc_id, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS unit FROM (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^.!?。！？\n]+[.!?。！？\n]*|[.!?。！？\n]+') AS parts FROM documents)),
d AS (
  SELECT doc_id, i, unit, length(unit) AS size,
    trim(regexp_replace(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[ \t\r\n]+', ' ', 'g'), ' ') AS norm FROM u),
r AS (
  SELECT doc_id, i, greatest(length(norm) - length(replace(norm, ' ', '')) + 1, length(norm) // 12) AS words,
    row_number() OVER (PARTITION BY md5(norm) ORDER BY doc_id, i) > 1 AS repeated,
    row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM d WHERE norm <> ''),
runs AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id, repeated ORDER BY i) AS run FROM r),
gone AS (
  SELECT doc_id, i FROM runs WHERE repeated
  QUALIFY sum(words) OVER (PARTITION BY doc_id, run) >= 25)
SELECT x.doc_id, CAST(count(d.i) AS INTEGER) AS n_units, CAST(count(gone.i) AS INTEGER) AS n_removed,
  CAST(coalesce(sum(d.size) FILTER (gone.i IS NOT NULL), 0) AS BIGINT) AS removed_chars,
  sha256(coalesce(string_agg(d.unit, '' ORDER BY d.i) FILTER (gone.i IS NULL), '')) AS kept_sha256
FROM documents x LEFT JOIN d ON d.doc_id = x.doc_id LEFT JOIN gone ON gone.doc_id = d.doc_id AND gone.i = d.i
GROUP BY x.doc_id
"""


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least 25 words of sentences and lines that occur earlier are removed."""
    out = linedup.remove_repeated_lines(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_units", "n_removed",
        F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["length"]).alias("removed_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


# Shares of the corpus's tokens that op9_mixing aims at.
OP9_WEIGHTS = {"clean": 0.80, "low": 0.15, "toxic": 0.05}


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors, rate and copies of each document for OP9_WEIGHTS."""
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), OP9_WEIGHTS)


def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token shards of all documents in permuted order; the manifest of sequences."""
    return materialise.materialise(_table(spark, sf_dir, "documents")).drop("folder")


def op11_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz trigram score of each document, learned from six sevenths of them."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    out = katz.score_documents(_table(spark, sf_dir, "documents"), ~held_out, order=3)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings whitened along their 32 leading components."""
    points = whitening.fixed_point(_table(spark, sf_dir, "embeddings"), scale=64, offset=1_000_000)
    return whitening.whiten(points, components=32)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of the words of each document; a tenth of the documents
    (by the crc32 of the id) is first made periodic in its tail."""
    key = periodic.crc_key("doc_id")
    out = periodic.periodic_runs(_table(spark, sf_dir, "documents"), planted=F.when(key % 10 == 0, key))
    run = periodic.longest()
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), run["start"].alias("start"),
        run["length"].alias("length"), run["period"].alias("period"),
        F.floor(1000 * run["length"] / run["period"]).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": op1_warc,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_pii": op3_pii,
        "op4_simhash": op4_simhash,
        "op5_decontamination": op5_decontamination,
        "op6_winnowing": op6_winnowing,
        "op7_quality": op7_quality,
        "op8_line_dedup": op8_line_dedup,
        "op9_mixing": op9_mixing,
        "op10_training_order": op10_training_order,
        "op11_katz": op11_katz,
        "op12_whitening": op12_whitening,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1_SQL, "op5_decontamination": OP5_SQL, "op8_line_dedup": OP8_SQL}
