"""Quality score from compression with two dictionaries.

A text is compressed twice with zstandard: once against a dictionary of texts
labelled good, once against one of texts labelled bad. The difference of the
two sizes per byte of text says which kind it resembles; a logistic
calibration turns it into the probability of label 1. Labels, language,
source and ids never enter a score.

Fitting reads a bounded sample of labelled rows: at most
``SampleBounds.per_class`` documents a class, each of at most ``max_bytes``
bytes, chosen by a hash of their id. Scoring reads every text whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, no_text


@dataclass(frozen=True)
class SampleBounds:
    """per_class documents a label are collected for fitting, texts over
    max_bytes are left out of the sample; a dictionary holds dict_bytes."""
    per_class: int = 1600
    max_bytes: int = 16 << 10
    dict_bytes: int = 1 << 20


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, float, float]  # intercept, size difference, shortness
    level: int = 6
    segment: int = 4 << 10

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Rows of (1, (bad - good) / bytes, shortness). A text is compressed
        in segments, all of them, so that long texts do not become their own
        dictionary; empty texts have difference 0."""
        packers = [_packer(body, self.level) for body in (self.good, self.bad)]
        out = np.empty((len(texts), 3))
        for k, text in enumerate(texts):
            parts = [text[i:i + self.segment] for i in range(0, len(text), self.segment)]
            good, bad = (sum(len(p.compress(x)) for x in parts) for p in packers)
            out[k] = 1.0, (bad - good) / max(1, len(text)), 64 / (64 + len(text))
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ np.array(self.weights), -40, 40)))


def _packer(body: bytes, level: int) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if body else None
    if dictionary:
        dictionary.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=False,
                                    write_content_size=False, write_dict_id=False)


def held_out(id_col: str = "doc_id") -> Column:
    """True for rows kept away from fitting; rows without an id: false."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weighted ridge logistic regression by Newton's method; the intercept
    is not penalised."""
    scale = np.r_[1.0, np.maximum(x[:, 1:].std(axis=0), 1e-9)]
    z, beta = x / scale, np.zeros(x.shape[1])
    penalty = np.r_[0.0, np.full(x.shape[1] - 1, ridge)] * w.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -40, 40)))
        grad = z.T @ (w * (p - y)) + penalty * beta
        hess = (z * (w * p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9)
        move = np.linalg.solve(hess, grad)
        beta -= move
        if np.abs(move).max() < 1e-9:
            break
    return beta / scale


def _sample(docs: DataFrame, labels: DataFrame, label: str, text: str, id_col: str,
            bounds: SampleBounds, seed: int) -> tuple[dict[int, list[bytes]], dict[int, int]]:
    """Texts of the sampled rows by label, in hash order, and the number of
    usable labelled ids: those that ``docs`` holds with a text of 1 to
    ``max_bytes`` bytes. Ids labelled both ways teach nothing and are left out."""
    texts = (docs.select(F.col(id_col).cast("long").alias("id"), no_text(text).cast("binary").alias("t"))
             .where(F.length("t").between(1, bounds.max_bytes)))
    usable = cut(labels.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
                 .where("id is not null and y in (0, 1)").where(~held_out("id"))
                 .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2")
                 .join(texts.select("id"), "id", "left_semi")
                 .select("id", "y", F.xxhash64("id", F.lit(seed)).alias("h")), "quality-labels")
    counts = {r["y"]: r["count"] for r in usable.groupBy("y").count().collect()}  # two rows
    picks = [usable.where(F.col("y") == y).orderBy("h", "id").limit(bounds.per_class) for y in (0, 1)]
    rows = (texts.join(F.broadcast(picks[0].unionByName(picks[1])), "id")
            .groupBy("id", "y", "h").agg(F.min("t").alias("t")).collect())  # per_class rows a label at most
    found: dict[int, list[bytes]] = {0: [], 1: []}
    for r in sorted(rows, key=lambda r: (r["h"], r["id"])):
        found[r["y"]].append(bytes(r["t"]))
    return found, counts


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", id_col: str = "doc_id",
        bounds: SampleBounds = SampleBounds(), seed: int = 7) -> QualityModel:
    """Dictionaries from one half of the sample, calibration on the other.
    Without rows of both labels the score is the labels' share (0.5 for none)."""
    found, counts = _sample(docs, labels, label, text, id_col, bounds, seed)
    total = sum(counts.values())
    prior = (counts.get(1, 0) + 0.5) / (total + 1)
    if not (found[0] and found[1]):
        return QualityModel(b"", b"", (float(np.log(prior / (1 - prior))), 0.0, 0.0))
    body, rest = {}, {}
    for y, texts in found.items():
        half = max(1, len(texts) // 2)
        body[y] = b"\n".join(texts[:half])[-bounds.dict_bytes:]
        rest[y] = texts[half:] or texts
    model = QualityModel(body[1], body[0], (0.0, 0.0, 0.0))
    x = np.concatenate([model.features(rest[0]), model.features(rest[1])])
    y = np.r_[np.zeros(len(rest[0])), np.ones(len(rest[1]))]
    w = np.r_[np.full(len(rest[0]), (1 - prior) / len(rest[0])), np.full(len(rest[1]), prior / len(rest[1]))]
    return QualityModel(body[1], body[0], tuple(map(float, _logistic(x, y, w * len(y)))))


def score_column(model: QualityModel, text: str = "text") -> Column:
    """Score of every whole text, 0 to 1; null texts count as empty."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score([t.as_py() for t in texts]))

    return score(no_text(text).cast("binary"))


def score_documents(docs: DataFrame, model: QualityModel, text: str = "text", id_col: str = "doc_id",
                    threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row. Repeated rows stay."""
    return (docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                        score_column(model, text).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Rows of ``docs`` that score at least ``threshold``, all columns kept."""
    return docs.where(score_column(model, text) >= threshold)
