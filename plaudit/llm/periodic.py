"""Periodic run detection over the words of a text.

A run is a maximal stretch of words with smallest period q (words q apart are
identical) that is long enough. It is found by a sparse diagonal DP: going
through the words, an earlier occurrence of the word at distance q extends the
match on diagonal (lag) q; where a diagonal ends, its stretch is emitted if it
is long enough.

Letting every earlier occurrence extend a diagonal costs the square of a
frequent word's count. Only these have to: for 2^k words, the nearest earlier
occurrence of the 2^k words that end here, on lags of 2^(k-1) < q <= 2^k. In a
stretch of smallest period q and at least ``2 q + 2^k`` words this occurrence
lies exactly q words back (a nearer one would give the stretch a smaller
period), so on a run of exponent 4 the diagonal of q is active from its first
2^k words on, and every other diagonal that is long enough would be the nearest
one too. What remains is n log n work for n words in the worst case, and next
to nothing beyond the levels where strings of words still repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import no_text

_GROUP_BYTES = 4 << 20  # texts worked on together in a task


def word_codes(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers, from 0."""
    return pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _pair_codes(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Numbers from 0 for the pairs; ``n`` is above all of b."""
    return np.unique(a * n + b, return_inverse=True)[1]


def find_runs(codes: np.ndarray, doc: np.ndarray, least: int, power: int) -> tuple[np.ndarray, ...]:
    """(doc, start, length, period) arrays of the runs with at least
    max(least, power * period) words, ``power`` >= 4. ``codes`` has the words
    of several documents one after the other, ``doc`` their document; starts
    count from the first of all words, and no run crosses a document."""
    n, found, size = len(codes), [], 1
    # at: positions where a string of `size` words ends that occurs twice in
    # its document; name: the string's number, apart for each document
    at = np.arange(n)
    name = _pair_codes(doc, codes, int(codes.max(initial=0)) + 1)
    while len(at):
        order = np.argsort(name, kind="stable")  # by string, then position
        same = name[order][1:] == name[order][:-1]
        lag = np.zeros(len(at), np.int64)
        lag[order[1:]] = np.where(same, at[order][1:] - at[order][:-1], 0)
        twice = np.zeros(len(at), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        # the diagonals of this level: stretches of equal lag, word after word
        on = np.flatnonzero((lag <= size) & (2 * lag > size))
        if len(on):
            p, q = at[on], lag[on]
            ends = np.flatnonzero((np.diff(p) != 1) | (np.diff(q) != 0))
            first, last = np.r_[0, ends + 1], np.r_[ends, len(on) - 1]
            start = p[first] - size + 1 - q[first]
            length = p[last] + 1 - start
            long = length >= np.maximum(least, power * q[first])
            found.append(np.stack([doc[p[first]], start, length, q[first]])[:, long])
        # strings of twice the words: two neighbours that both occur twice
        at, name = at[twice], name[twice]
        i = np.searchsorted(at, at - size)
        ok = at[np.minimum(i, len(at) - 1)] == at - size if len(at) else np.zeros(0, bool)
        ok &= doc[at - size] == doc[at] if len(at) else ok
        left, right = name[i[ok]], name[ok]
        at = at[ok]
        name = _pair_codes(left, right, int(right.max(initial=0)) + 1)
        size *= 2
    runs = np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
    runs = runs[:, np.lexsort((runs[3], runs[1]))]
    return tuple(runs)


def plant(n: int, key: int) -> np.ndarray:
    """Where the words of a text come from when a tail of it is made periodic
    by ``key`` (a document's hash): word i is the original word at place i."""
    g = key // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at >= a, a + (at - a) % p, at)


_RESULT = ("n_words long, runs array<struct<start:long,length:long,period:long>>, runs_sha256 string, "
           "collapsed string, collapsed_sha256 string")


def _scan(texts: list[bytes], keys: list[int] | None, least: int, power: int, collapsed: bool) -> list[dict]:
    words = [t.split() for t in texts]  # bytes split at blanks and \t .. \r only
    if keys is not None:
        words = [[w[i] for i in plant(len(w), k)] if w and k >= 0 else w for w, k in zip(words, keys)]
    sizes = np.array([len(w) for w in words])
    begin = np.r_[0, np.cumsum(sizes)]
    flat = [x for w in words for x in w]
    doc, start, length, period = find_runs(word_codes(flat), np.repeat(np.arange(len(words)), sizes), least, power)
    cut = np.searchsorted(doc, np.arange(len(words) + 1))  # runs are in text order
    out = []
    for i, w in enumerate(words):
        mine = slice(cut[i], cut[i + 1])
        runs = list(zip((start[mine] - begin[i]).tolist(), length[mine].tolist(), period[mine].tolist()))
        if runs:
            keep = np.ones(len(w), bool)
            for s, size, q in runs:
                keep[s + q:s + size] = False
            w = [x for x, k in zip(w, keep.tolist()) if k]
        body = b" ".join(w)
        out.append({
            "n_words": int(sizes[i]), "runs": [dict(zip(("start", "length", "period"), r)) for r in runs],
            "runs_sha256": hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            "collapsed": body.decode() if collapsed else None,
            "collapsed_sha256": hashlib.sha256(body).hexdigest()})
    return out


def periodic_runs(docs: DataFrame, text: str = "text", id_col: str = "doc_id", least: int = 6, power: int = 4,
                  planted: Column | None = None, collapsed: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs (array<struct<start, length,
    period>> by start, then period; word numbers from 0), runs_sha256 over
    their ``start,length,period`` lines, collapsed (with ``collapsed=True``:
    the words joined by a blank, without those that a run holds after its first
    period; else null) and collapsed_sha256 of it.

    Words are runs of other characters than blank and \\t to \\r. Null and empty
    texts have no word and no run. ``power`` must be 4 or more. ``planted``: a
    hash per row; where it is not null the text is first made periodic by it
    (``plant``), which tests a detector on any table. Repeated rows stay; every
    row is worked on by itself, so clashing names and ids don't matter."""
    if power < 4:
        raise ValueError("power must be at least 4")

    plain, id_type = planted is None, pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("doc_id", id_type), ("n_words", pa.int64()),
            ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
            ("runs_sha256", pa.string()), ("collapsed", pa.string()), ("collapsed_sha256", pa.string())])
        for batch in batches:
            lengths = batch.column(2).to_numpy()
            at = 0
            while at < batch.num_rows:  # groups of some megabytes, a longer text alone
                end = at + max(1, int(np.searchsorted(np.cumsum(lengths[at:]), _GROUP_BYTES, side="right")))
                texts = [t.as_py() for t in batch.column(1)[at:end]]
                keys = None if plain else [-1 if k is None else k for k in batch.column(3)[at:end].to_pylist()]
                rows = _scan(texts, keys, least, power, collapsed)
                ids = batch.column(0)[at:end].to_pylist()
                yield pa.RecordBatch.from_pylist([{"doc_id": d, **r} for d, r in zip(ids, rows)], schema=schema)
                at = end

    body = no_text(text).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), body.alias("t"), F.length(body).alias("size"),
                       *([] if planted is None else [planted.cast("long").alias("key")]))
    return rows.mapInArrow(run, f"doc_id long, {_RESULT}")


def longest(runs: str = "runs") -> Column:
    """The run of greatest length, the earliest, then the shortest period of equal ones; null without runs."""
    order = F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("size"), r["start"].alias("at"), r["period"].alias("period"), r.alias("run")))
    return F.array_min(order)["run"]


def crc_key(id_col: str = "doc_id") -> Column:
    """Unsigned crc32 of the decimal id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))
