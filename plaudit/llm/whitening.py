"""Embedding whitening by Chebyshev-filtered subspace iteration.

The vectors are fixed-point integers, so sums and deviations are exact. They
are packed once into blocks in the shared folder; after that the covariance
``V = (1/n) sum (x - m)(x - m)'`` is never formed. A pass over the blocks
multiplies it with a few columns Q: every task adds up ``Xc' (Xc Q)`` of its
centred rows, and the sums meet in a handful of tasks before the driver.

Iteration: a Chebyshev polynomial of V, built by its three-term recurrence of
such passes, damps the unwanted part of the spectrum; QR, then Rayleigh-Ritz
with one more pass give Ritz values and residuals. The components are certified
when every residual is at rounding level, and the whitened vectors' covariance
is then measured against the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

_BLOCK_ENTRIES = 1 << 19   # entries of a block: 4 MB as doubles
_COMBINERS = 8             # tasks that add up the sums of a pass
_BLOCK = "ids array<long>, lo long, width int, data binary, sums array<long>"


def fixed_point(vectors: DataFrame, vec: str = "embedding", id_col: str = "vec_id", scale: int = 64,
                offset: int = 0) -> DataFrame:
    """(vec_id, x) with x = floor(scale * entry) + offset, of the rows whose
    vector is not null and holds neither nulls nor non-finite entries."""
    ok = F.col(vec).isNotNull() & F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                                           & (F.abs(c.cast("double")) < float("inf")))
    x: Column = F.transform(vec, lambda c: F.floor(c.cast("double") * scale).cast("long") + offset)
    return vectors.where(ok).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))


def _dimension(points: DataFrame) -> int:
    """The commonest length of the vectors, the greatest of equal ones; 0 without any."""
    row = (points.groupBy(F.size("x").alias("d")).count().where("d > 0")
           .agg(F.max(F.struct("count", "d")).alias("m")).first())
    return row["m"]["d"] if row["m"] is not None else 0


def pack(points: DataFrame, d: int) -> DataFrame:
    """Blocks of the vectors of length ``d``, written to the shared folder:
    ids, least entry, bytes an entry, entries above the least, their sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("ids", pa.list_(pa.int64())), ("lo", pa.int64()), ("width", pa.int32()),
                            ("data", pa.binary()), ("sums", pa.list_(pa.int64()))])
        step = max(1, _BLOCK_ENTRIES // d)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = part.column(1).flatten().to_numpy().reshape(-1, d)
                lo = int(x.min())
                above = (x - lo).astype(np.uint64)
                width = next(w for w in (1, 2, 4, 8) if int(above.max()) < 1 << 8 * w)
                yield pa.RecordBatch.from_pylist([{
                    "ids": part.column(0).to_pylist(), "lo": lo, "width": width,
                    "data": above.astype(f"<u{width}").tobytes(), "sums": above.sum(0).astype(np.int64)}], schema=schema)

    return cut(points.where(F.size("x") == d).select("vec_id", "x").mapInArrow(run, _BLOCK), "vector-blocks")


def _above(block: dict, d: int) -> np.ndarray:
    return np.frombuffer(block["data"], f"<u{block['width']}").reshape(-1, d)


def _centred(block: dict, mean: np.ndarray) -> np.ndarray:
    """The rows less the mean. ``mean`` is (whole part, rest): the whole parts
    are subtracted as integers, so no digit of a large offset is lost."""
    whole, rest = mean
    return (_above(block, len(whole)).astype(np.int64) + (block["lo"] - whole)).astype(np.float64) - rest


def _summed(blocks: DataFrame, columns: list[str], shape: tuple[int, ...], part) -> np.ndarray:
    """The sum of ``part(block)``, arrays of ``shape``, over all blocks."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for i in range(batch.num_rows):
                total += part({c: batch.column(c)[i].as_py() for c in columns})
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sum"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for raw in batch.column(0):
                total += np.frombuffer(raw.as_buffer()).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sum"])

    parts = blocks.select(*columns).mapInArrow(add, "sum binary").repartition(_COMBINERS)
    return sum((np.frombuffer(r["sum"]).reshape(shape) for r in parts.mapInArrow(merge, "sum binary").collect()),
               np.zeros(shape))


@dataclass
class Whitener:
    """``directions`` (d x k): unit eigenvectors of the covariance by falling
    ``values``; ``residuals`` |V q - value q| relative to the greatest value;
    ``sums`` and ``n`` of the fit list; ``identity_error`` of its whitening."""
    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    residuals: np.ndarray
    trace: float
    passes: int
    identity_error: float = 0.0

    @property
    def mean(self) -> tuple[np.ndarray, np.ndarray]:
        whole = [s // self.n for s in self.sums]
        return (np.array(whole, np.int64),
                np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole)]))


def _chebyshev(apply, q: np.ndarray, vq: np.ndarray, low: float, high: float, degree: int) -> np.ndarray:
    """T_degree of V, mapped so that [low, high] becomes [-1, 1], times q; ``vq`` is V q."""
    centre, half = (low + high) / 2, (high - low) / 2
    before, now = q, (vq - centre * q) / half
    for _ in range(degree - 1):
        before, now = now, 2 * (apply(now) - centre * now) / half - before
    return now


def _degree(top: float, low: float, high: float, most: int) -> int:
    """So many steps that the top value is not amplified over 1e10."""
    t = max(1.0 + 1e-12, (2 * top - low - high) / (high - low))
    return int(np.clip(np.log(2e10) / np.arccosh(t), 2, most))


def fit(blocks: DataFrame, d: int, components: int = 32, tolerance: float = 1e-13, max_degree: int = 10,
        max_rounds: int = 80, seed: int = 1) -> Whitener:
    """The leading ``components`` eigenvectors of the covariance of ``blocks``.

    Residuals at ``tolerance`` of the greatest value certify them; rounds that
    no longer improve below 1e-10 have reached rounding level and count too.
    Directions without variance (under 1e-10 of the greatest value) are left
    out, so there may be fewer."""
    sums = [int(r["s"]) for r in blocks.select(F.size("ids").alias("n"), "lo", F.posexplode("sums").alias("i", "a")).groupBy("i")
            .agg(F.sum(F.col("a").cast("decimal(38,0)") + F.col("n") * F.col("lo").cast("decimal(27,0)")).alias("s"))
            .orderBy("i").collect()]  # a row a dimension
    n = blocks.agg(F.sum(F.size("ids"))).first()[0]
    model = Whitener(n, sums, np.zeros(0), np.zeros((d, 0)), np.zeros(0), 0.0, 1)
    mean, columns = model.mean, ["lo", "width", "data"]
    width = min(d, max(components + 8, components * 3 // 2))

    def apply(q: np.ndarray) -> np.ndarray:
        def part(block: dict) -> np.ndarray:
            x = _centred(block, mean)
            return np.vstack([x.T @ (x @ q), np.full((1, q.shape[1]), (x * x).sum())])
        out = _summed(blocks, columns, (d + 1, q.shape[1]), part) / n
        model.passes += 1
        model.trace = float(out[-1, 0])
        return out[:-1]

    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
    vq, low, last = apply(q), None, np.inf
    for _ in range(max_rounds):
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        order = np.argsort(-values)
        values, q, vq = values[order], q @ turn[:, order], vq @ turn[:, order]
        top = max(values[0], 0.0)
        k = min(components, int((values > 1e-10 * top).sum()) if top > 0 else 0)
        off = np.linalg.norm(vq - q * values, axis=0) / (top or 1.0)
        worst = off[:k].max(initial=0.0)
        if worst <= tolerance or width == d or (worst < 1e-10 and worst > last / 2):
            break
        # unwanted values: below the least of the guard columns, down to a
        # guess that is given up (0 always holds) once a round gains little
        if low is None:
            low = max(0.0, 2 * values[-1] - top)
        elif worst > last / 2:
            low = 0.0
        high = values[-1]
        last = worst
        if high - low <= 1e-12 * top:
            low = 0.0
        if high <= 1e-12 * top:  # rank below the block's width: V q spans the range
            new = vq / top
        else:
            new = _chebyshev(apply, q, vq, low, high, _degree(top, low, high, max_degree))
            new /= np.linalg.norm(new, axis=0)
        q = np.linalg.qr(new)[0]
        vq = apply(q)
    if worst > 1e-9:
        raise RuntimeError(f"components not certified: residual {worst:.1e} after {model.passes} passes")
    model.values, model.directions, model.residuals = values[:k], q[:, :k], off[:k]
    if k:
        scaled = model.directions / np.sqrt(model.values)

        def part(block: dict) -> np.ndarray:
            w = _centred(block, mean) @ scaled
            return np.vstack([w.T @ w, w.sum(0)])

        out = _summed(blocks, columns, (k + 1, k), part) / n
        model.identity_error = float(np.abs(out[:-1] - np.outer(out[-1], out[-1]) - np.eye(k)).max())
    return model


def transform(blocks: DataFrame, model: Whitener) -> DataFrame:
    """(vec_id, component from 1, deviation, whitened) per vector and
    component. deviation is the exact sum over the dimensions of
    (n x - sum)^2, null where it doesn't fit a long."""
    mean, k, n, sums = model.mean, len(model.values), model.n, model.sums
    scaled = model.directions / np.sqrt(model.values) if k else model.directions

    def exact(block: dict) -> list[int | None]:
        above, lo = _above(block, len(sums)), block["lo"]
        rest = [s - n * lo for s in sums]
        reach = max(max(abs(r) for r in rest), abs(n * int(above.max()) - min(rest)))
        if reach * reach * len(sums) < 1 << 63:
            far = above.astype(np.int64) * n - np.array(rest, np.int64)
            return (far * far).sum(1).tolist()
        whole = [sum((n * int(a) - r) ** 2 for a, r in zip(row, rest)) for row in above]
        return [v if v < 1 << 63 else None for v in whole]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                w = _centred(block, mean) @ scaled
                pick = pa.array(np.repeat(np.arange(len(w)), k))
                yield pa.RecordBatch.from_arrays([
                    pa.array(block["ids"], pa.int64()).take(pick),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(w))),
                    pa.array(exact(block), pa.int64()).take(pick), pa.array(w.ravel())],
                    ["vec_id", "component", "deviation", "whitened"])

    return blocks.select("ids", "lo", "width", "data").mapInArrow(
        run, "vec_id long, component int, deviation long, whitened double")


def whiten(points: DataFrame, components: int = 32) -> DataFrame:
    """``transform`` of the integer vectors (vec_id, x), fitted on all of them,
    with n, explained (share of the covariance's trace) and identity_error
    beside each row. The commonest length is the dimension; vectors of another
    length are left out, like those without entries. Repeated rows and rows
    without an id count and stay. Without vectors, or without variance, there
    is no component and no row."""
    points = cut(points.select("vec_id", "x"), "points")
    d = _dimension(points)
    if not d:
        return points.sparkSession.createDataFrame([], (
            "vec_id long, component int, n long, deviation long, whitened double, explained double, "
            "identity_error double"))
    blocks = pack(points, d)
    model = fit(blocks, d, components)
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    return transform(blocks, model).select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("component") - 1).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
