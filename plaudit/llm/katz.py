"""Katz backoff language model with Good-Turing discounts, on whole corpora.

    P(w | h) = d_c c(h w) / c(h)      where the n-gram h w was seen c times,
             = A(h) P(w | h')         otherwise, h' without its first word,

down to the unigrams, whose discounted mass goes to one unknown word. d_c is the
Good-Turing discount of the n-gram's order for c <= 5 and 1 above. The backoff
weight A(h) = (1 - sum of the seen P(w | h)) / (1 - sum of P(w | h') over the same
words) makes every distribution sum to 1 exactly. A context whose words were
all seen more than 5 times has nothing left to give; one is added to its count.

Everything that ends in the same last context word v lies in one bucket: the
record of a token (its history, v last, and the token) finds all n-gram counts
and contexts of order 2 and more there, and c(v), which gives the probability
of the *previous* token should it be a plain unigram. So a record travels once,
and only two kinds of sums travel besides: for each v the unigram mass of the
words seen after it, and the counts of the bigrams of frequent v, whose records
are dealt over several buckets by the word before v.

1. ``_frequent``: words that would overfill a bucket (a bounded list).
2. ``_records``: texts to records, packed by bucket; ``_count``: n-grams with
   their training counts and the (n-gram, document) pairs of a bucket, written
   as the partitioned table of the model.
3. ``_seen_mass``: unigram mass by preceding word.
4. ``_evaluate``: discounts, weights and the recursion, summed per document.

Words are 56-bit hashes after the first step. A context pair (u, v) isn't split
further; all its records are in one bucket.
"""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, no_text, scratch_path, shuffle_files_dropped

MOST = 5                    # counts up to this are discounted
START, END = 0, 1           # hashes that no word has
_WORD = (1 << 56) - 2
_GROUP_BYTES = 32 << 20     # texts whose records are packed together in a task
_CODE_BYTES = 4 << 20       # of these, split into words at once
_BUCKET_TOKENS = 5 << 18    # records of a bucket, about
_LEAST_BUCKETS = 64
_SLICE = 1 << 18            # pairs of n-gram and document summed at once
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) % _WORD + 2


def _mix(h: np.ndarray) -> np.ndarray:
    x = h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def _home(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a word that is not frequent."""
    return (_mix(h) % np.uint64(buckets)).astype(np.int64)


def _trim() -> None:
    """Give freed memory back to the system; a worker that is kept for later
    tasks would hold on to the most that any of them took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def _groups(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list[list]]:
    """Rows in groups of some megabytes of the first column, a longer text alone."""
    held, size = [[] for _ in range(columns)], 0
    for batch in batches:
        for i in range(batch.num_rows):
            for c in range(columns):
                held[c].append(batch.column(c)[i].as_py())
            size += len(held[0][-1])
            if size >= _GROUP_BYTES:
                yield held
                held, size = [[] for _ in range(columns)], 0
    if held[0]:
        yield held


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, hash by code, words by text); the codes of all texts one after
    the other, without ends. Codes rise with the first occurrence."""
    known: dict[bytes, int] = {}
    codes, sizes, at = [], [], 0
    while at < len(texts):
        end = at + max(1, int(np.searchsorted(np.cumsum([len(t) for t in texts[at:at + 65536]]), _CODE_BYTES, "right")))
        words = [t.translate(_LOWER).split() for t in texts[at:end]]  # splits at blanks and \t .. \r only
        coded = pa.array([w for x in words for w in x], pa.binary()).dictionary_encode()
        place = np.array([known.setdefault(w, len(known)) for w in coded.dictionary.to_pylist()], np.int32)
        codes.append(place[coded.indices.to_numpy(zero_copy_only=False)])
        sizes += [len(x) for x in words]
        at = end
    return (np.concatenate(codes) if codes else np.zeros(0, np.int32),
            np.fromiter(map(word_hash, known), np.int64, len(known)), np.array(sizes, np.int64))


def _small(x: np.ndarray) -> np.ndarray:
    top = int(x.max(initial=0))
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _planes(x: np.ndarray) -> tuple[str, bytes]:
    """Unsigned numbers in their least width, byte by byte: the upper bytes of
    small numbers compress to nothing."""
    x = _small(x)
    return x.dtype.str, x.view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes()


def _packed(parts: dict[str, np.ndarray]) -> bytes:
    """Takes the columns out of ``parts``, so that each is freed once it is narrow."""
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps({k: _planes(parts.pop(k)) for k in list(parts)}, 5))


def _columns(blob: pa.Buffer) -> dict[str, tuple[str, bytes]]:
    """The columns of a packed blob, still byte by byte."""
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def _column(planes: tuple[str, bytes]) -> np.ndarray:
    """One of them: 32 bits wide where it fits."""
    kind, raw = planes
    width = np.dtype(kind).itemsize
    x = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()
    return x.astype(np.int32 if width < 4 or width == 4 and int(x.max(initial=0)) < 1 << 31 else np.int64)


def _ranges(x: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Rising numbers as differences inside the groups that begin at ``new``."""
    return np.where(new, x, np.diff(x, prepend=0))


def _from_ranges(d: np.ndarray, new: np.ndarray) -> np.ndarray:
    total = np.cumsum(d)
    begin = np.flatnonzero(new)
    total -= np.repeat(total[begin] - d[begin], np.diff(np.r_[begin, len(d)]))
    return total


def _changes(x: np.ndarray) -> np.ndarray:
    """Where a value begins in a sorted column."""
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return new


def _sorted(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts the pairs of a and b, where a new pair begins in it);
    all b are below ``size``."""
    both = a.astype(np.int64)
    both *= size
    both += b
    order = np.argsort(both)
    return order, _changes(both[order])


def _numbers(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Number from 0 of each row's pair, by its order."""
    out = np.empty(len(order), np.int32)
    out[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return out


# --------------------------------------------------------------------------
# Buckets
# --------------------------------------------------------------------------

def _frequent(docs: DataFrame, bucket_tokens: int) -> tuple[int, dict[int, int]]:
    """(number of buckets, {word hash: buckets it is dealt over}).

    A word is dealt over several buckets where it has more records than one
    should hold. The number of buckets isn't known yet, so each task names
    the words with 1/65 536 of its tokens, 65 536 at most; what is kept back of
    a word is less than that share. Only balance depends on this list."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, {START: 0}
        for batch in batches:
            lengths = np.cumsum(batch.column(1).to_numpy())
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(lengths, (lengths[at - 1] if at else 0) + _CODE_BYTES, "right")))
                words = [w for t in batch.column(0).slice(at, end - at) for w in t.as_py().translate(_LOWER).split()]
                total += len(words) + end - at
                seen[START] += end - at
                found = pa.array(words, pa.binary()).value_counts()
                often = found.filter(pc.greater(found.field("counts"), len(words) >> 17))
                for x in often.to_pylist():
                    h = word_hash(x["values"])
                    seen[h] = seen.get(h, 0) + x["counts"]
                at = end
        keep = [(h, c) for h, c in seen.items() if c << 16 >= total]
        yield pa.RecordBatch.from_arrays([
            pa.array([-1, *(h for h, _ in keep)], pa.int64()), pa.array([total, *(c for _, c in keep)], pa.int64())],
            ["h", "c"])

    named = docs.select("t", F.length("t")).mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    named = cut(named, "frequent-words")
    total = named.where("h = -1").agg(F.sum("c")).first()[0] or 0
    buckets = max(_LEAST_BUCKETS if total >= bucket_tokens else 8, -(-total // bucket_tokens))
    share = total / buckets
    rows = named.where("h >= 0").where(F.col("c") > share).collect()  # fewer rows than buckets
    return buckets, {r["h"]: int(-(-r["c"] // share)) for r in rows}


def _numbered(cols: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The values that occur, ascending, and the columns as places among them;
    ``place`` is scratch with an entry for every value."""
    if sum(map(len, cols)) * 32 < len(place):  # few records: sort them
        found, at = np.unique(np.concatenate(cols), return_inverse=True)
        return found, list(at.reshape(len(cols), -1))
    there = np.zeros(len(place), bool)
    for c in cols:
        there[c] = True
    found = np.flatnonzero(there)
    place[found] = np.arange(len(found))
    return found, [place[c] for c in cols]


def _records(docs: DataFrame, order: int, buckets: int, frequent: dict[int, int]) -> DataFrame:
    """(bucket, blob): the records of a group of texts for a bucket. Columns
    ``x0`` (the token), ``x1`` = v, ``x2`` .. the words before, as places in
    ``words``; ``doc`` as places in ``key``, with ``train`` beside."""
    hot = np.array(sorted(frequent), np.int64)
    spread = np.array([frequent[h] for h in hot.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, keys, train in _groups(batches, 3):
            code, hashes, sizes = _tokens(texts)
            texts.clear()
            _trim()
            hashes = np.r_[hashes, END, START]
            end, start = len(hashes) - 2, len(hashes) - 1
            n = len(code) + len(sizes)
            last = np.cumsum(sizes + 1) - 1
            token = np.full(n, end, np.int32)
            word = np.ones(n, bool)
            word[last] = False
            token[word] = code
            doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
            place = np.arange(n, dtype=np.int32)  # n is below 2^31: a value in Spark has at most that many bytes
            place -= np.repeat((last - sizes).astype(np.int32), sizes + 1)
            del code, word
            cols = [token]
            for k in range(1, order):
                back = np.r_[np.full(min(k, n), start, np.int32), token[:max(0, n - k)]]
                cols.append(np.where(place >= k, back, np.int32(start)))
            del place, back
            home = _home(hashes, buckets).astype(np.int32)[cols[1]]
            if len(hot):
                at = np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)
                ways = np.where(hot[at] == hashes, spread[at], 1)
                many = np.flatnonzero((ways > 1)[cols[1]])
                part = (_mix(hashes + 7)[cols[2][many]] % ways[cols[1][many]].astype(np.uint64)).astype(np.int64)
                home[many] = (home[many] + part) % buckets
                del many, part
            # rare words are numbered by their hash, so that it can be stored as a difference
            rare = np.bincount(token, minlength=len(hashes)) < 64
            rank = np.empty(len(hashes), np.int32)
            rank[np.lexsort((np.where(rare, hashes, np.arange(len(hashes))), rare))] = np.arange(len(hashes))
            back = np.argsort(rank)
            hashes, rare = hashes[back], rare[back]
            del token
            for k in range(order):
                cols[k] = rank[cols[k]]
            many = len(hashes)
            home = _small(home)
            order_by = np.argsort(home, kind="stable").astype(np.int32)
            home = home[order_by]
            cuts = np.r_[np.flatnonzero(_changes(home)), n]
            keys, train = np.array(keys, np.int64), np.array(train, np.int64)
            word_place, doc_place = np.empty(many, np.int32), np.empty(len(keys), np.int32)
            for a, b in zip(cuts[:-1], cuts[1:]):
                mine = order_by[a:b]
                mine = mine[np.argsort(cols[1][mine] * np.int64(many) + cols[0][mine], kind="stable")]  # v, then token
                words, x = _numbered([c[mine] for c in cols], word_place)
                docs_, (where,) = _numbered([doc[mine]], doc_place)
                new = np.r_[True, x[1][1:] != x[1][:-1]]
                few = rare[words]
                parts = {"x0": _ranges(x[0], new), "x1": np.diff(x[1], prepend=0), "doc": where,
                         "often": hashes[words[~few]], "rare": np.diff(hashes[words[few]], prepend=0),
                         "key": keys[docs_].view(np.uint64), "train": train[docs_]}
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(home[a])], pa.int32()),
                    pa.array([_packed(parts | {f"x{k}": x[k] for k in range(2, order)})], pa.binary())],
                    ["bucket", "blob"])
            del cols, doc, home, order_by, mine, x, parts
            _trim()

    return docs.select("t", "key", "train").mapInArrow(run, "bucket int, blob binary")


def _by_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """A task a bucket, or up to 16 of them beyond 4096 buckets."""
    tasks = max(min(buckets, 4096), buckets // 16)
    return rows.repartitionById(tasks, (F.col("bucket") % tasks).cast("int"))


def _joined(blobs: list[pa.Buffer], order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(words, columns, doc, key, train) of a bucket's records."""
    words, cols, doc, key, train = [], [[] for _ in range(order)], [], [], []
    for blob in blobs:
        p = {k: _column(x) for k, x in _columns(blob).items()}
        words.append(np.r_[p["often"], np.cumsum(p["rare"])])
        new = np.r_[True, p["x1"][1:] > 0]
        p["x0"], p["x1"] = _from_ranges(p["x0"], new), np.cumsum(p["x1"])
        for k in range(order):
            cols[k].append(p[f"x{k}"].astype(np.int32))
        doc.append(p["doc"].astype(np.int32))
        key.append(p["key"].astype(np.int64))
        train.append(p["train"])

    def merged(parts: list[np.ndarray], sizes: list[int], place: np.ndarray) -> np.ndarray:
        starts = np.cumsum(sizes) - sizes
        return np.concatenate([place[a:a + n][x] for x, a, n in zip(parts, starts, sizes)])

    sizes = [len(w) for w in words]
    words, place = np.unique(np.concatenate(words), return_inverse=True)
    place = place.astype(np.int32)
    for k in range(order):
        cols[k] = merged(cols[k], sizes, place)
    sizes = [len(x) for x in key]
    key, first, row = np.unique(np.concatenate(key), return_index=True, return_inverse=True)
    return words, cols, merged(doc, sizes, row.astype(np.int32)), key, np.concatenate(train)[first]


_COUNTS = "bucket int, blob binary, stats array<long>, hot array<struct<v:long,w:long,c:long>>"


def _count(records: DataFrame, order: int, buckets: int, frequent: dict[int, int]) -> DataFrame:
    """The n-gram table: a row a bucket. blob: distinct n-grams (``x0`` ..) with
    training counts ``c``, and for each its documents. stats: tokens, distinct
    words and ends in training, then the number of n-grams seen 1 .. MOST + 1
    times, by order. hot: this bucket's counts of the bigrams of frequent
    words, those too that only other buckets have in training."""
    hot_words = np.array(sorted(frequent), np.int64)

    def finish(bucket: int, blobs: list[pa.Buffer]) -> pa.RecordBatch:
        words, cols, doc, key, train = _joined(blobs, order)
        blobs.clear()
        size = len(words)
        code = cols[1]
        for k in [*range(2, order), 0]:  # v, the words before it, the token
            code = _numbers(*_sorted(code, cols[k], size))
        rows, new = _sorted(code, doc, len(key))
        begin = np.flatnonzero(new)
        many = np.diff(np.r_[begin, len(rows)]).astype(np.int32)
        rows = rows[begin]
        code, doc = code[rows], doc[rows]
        begins = _changes(code)  # n-grams among the pairs of n-gram and document
        first = rows[begins]
        del code, rows, new, begin
        for k in range(order):
            cols[k] = cols[k][first]
        del first
        grams = np.flatnonzero(begins)
        seen = np.add.reduceat(many * train[doc], grams, dtype=np.int64)
        stats = np.zeros((order + 1, MOST + 1), np.int64)
        is_hot = np.isin(words, hot_words)
        total = np.bincount(cols[1], weights=seen, minlength=size).astype(np.int64)
        plain = total[~is_hot & (words != START)]
        stats[0, :3] = total[words != START].sum(), (plain > 0).sum(), seen[(words == END)[cols[0]]].sum()
        stats[1] = np.bincount(plain, minlength=MOST + 2)[1:MOST + 2]
        pair, pair_sums, _ = _pairs(cols, size, seen)
        hot = is_hot[pair // size]
        hot_pairs, hot_sums = pair[hot], pair_sums[hot]
        for k in range(2, order + 1):
            sums = pair_sums[~hot] if k == 2 else seen if k == order else _longer(cols, k, size, seen)[1]
            stats[k] = np.bincount(np.minimum(sums, MOST + 2), minlength=MOST + 3)[1:MOST + 2]
        del pair, pair_sums, hot
        # n-grams are in the order of v, the words before it, the token; their documents in order
        new = _changes(cols[1])
        blob = _packed({f"x{k}": c for k, c in enumerate(cols) if k != 1} | {
            "x1": np.diff(cols[1], prepend=0), "x2": _ranges(cols[2], new), "words": np.diff(words, prepend=0),
            "c": seen, "n": np.diff(np.r_[grams, len(doc)]), "doc": _ranges(doc, begins), "many": many,
            "key": key.view(np.uint64)})
        hot = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in
                                          (words[hot_pairs // size], words[hot_pairs % size], hot_sums)], ["v", "w", "c"])
        return pa.RecordBatch.from_arrays([
            pa.array([bucket], pa.int32()), pa.array([blob], pa.binary()),
            pa.array([stats.ravel().tolist()], pa.list_(pa.int64())),
            pa.ListArray.from_arrays(pa.array([0, len(hot)], pa.int32()), hot)], ["bucket", "blob", "stats", "hot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != now and blobs:
                    yield finish(now, blobs)
                    blobs = []
                    _trim()
                now = bucket
                blobs.append(blob.as_buffer())
        if blobs:
            yield finish(now, blobs)
            _trim()

    dealt = _by_bucket(records, buckets).sortWithinPartitions("bucket")
    return cut(dealt.mapInArrow(run, _COUNTS), "katz-counts")


def _pairs(cols: list[np.ndarray], size: int, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bigrams (v, token) as one number, their counts, the place of each n-gram's."""
    order, new = _sorted(cols[1], cols[0], size)
    first = order[new]
    at = _numbers(order, new)
    pair = cols[1][first].astype(np.int64) * size + cols[0][first]
    return pair, np.bincount(at, weights=seen, minlength=len(pair)).astype(np.int64), at


def _contexts(cols: list[np.ndarray], k: int) -> np.ndarray:
    """Number from 0 of each n-gram's context of its last k words, by which
    the n-grams of the table are sorted."""
    new = _changes(cols[1])
    for j in range(2, k + 1):
        new |= _changes(cols[j])
    return np.cumsum(new, dtype=np.int32) - np.int32(1)


def _longer(cols: list[np.ndarray], k: int, size: int, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of each n-gram's k-gram, counts of the k-grams, an n-gram of each)."""
    order, new = _sorted(_contexts(cols, k - 1), cols[0], size)
    at = _numbers(order, new)
    return at, np.bincount(at, weights=seen).astype(np.int64), order[new]


# --------------------------------------------------------------------------
# Discounts
# --------------------------------------------------------------------------

def discounts(times: list[int]) -> np.ndarray:
    """d_0 .. d_MOST + 1 (the last for all higher counts) from the numbers of
    n-grams seen 1 .. MOST + 1 times. Katz's formula with the highest cut-off
    for which all discounts lie in (0, 1]; failing that, absolute discounting
    of the same counts; no discount without n-grams seen once."""
    n, out = [0, *times], np.ones(MOST + 2)
    if n[1] == 0:
        return out
    for top in range(MOST, 0, -1):
        rest = (top + 1) * n[top + 1] / n[1]
        if rest >= 1 or not all(n[r] and n[r + 1] for r in range(1, top + 1)):
            continue
        d = [((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest) for r in range(1, top + 1)]
        if all(0 < x <= 1 for x in d):
            out[1:top + 1] = d
            return out
    off = min(0.75, n[1] / (n[1] + 2 * n[2]))
    out[1:MOST + 1] = [(r - off) / r for r in range(1, MOST + 1)]
    return out


@dataclass
class Totals:
    """What the tasks share: tokens and distinct words in training, ends,
    discounts by order, counts and discounted bigram sums of frequent words,
    unigram mass of the words seen after them (a bounded number of entries)."""
    tokens: int
    words: int
    ends: int
    d: list[np.ndarray]
    unknown: float
    scale: float
    hot: dict[int, list[float]]

    def unigram(self, c: np.ndarray) -> np.ndarray:
        """P of words seen c times; the unknown word's for c = 0."""
        c = np.asarray(c)
        return np.where(c > 0, self.d[1][np.minimum(c, MOST + 1)] * c / self.scale, self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((np.asarray(c) + 1) / (self.tokens + self.words + 1))


def _totals(counts: DataFrame, order: int, bigrams: DataFrame, frequent: dict[int, int]) -> Totals:
    rows = (counts.select(F.posexplode("stats").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n"))
            .collect())  # (order + 1) * (MOST + 1) rows
    stats = np.zeros((order + 1) * (MOST + 1), np.int64)
    for r in rows:
        stats[r["i"]] = r["n"]
    stats = stats.reshape(order + 1, MOST + 1)
    n, distinct, ends = (int(x) for x in stats[0, :3])
    times = bigrams.where(F.col("c") <= MOST + 1).groupBy("c").count().collect()  # MOST + 1 rows
    for r in times:
        stats[2, r["c"] - 1] += r["count"]
    hot = {h: [0.0, 0.0, 0.0] for h in frequent}
    by_count = [F.sum(F.when(F.least("c", F.lit(MOST + 1)) == r, F.col("c")).otherwise(0)).alias(f"s{r}")
                for r in range(1, MOST + 2)]
    found = {r["v"]: [r[f"s{i}"] for i in range(1, MOST + 2)] for r in bigrams.groupBy("v").agg(*by_count).collect()}
    for c in [*(sum(found.get(h, [0])) for h in frequent if h != START), ends]:
        distinct += c > 0
        if 0 < c <= MOST + 1:
            stats[1, c - 1] += 1
    n += ends
    d = [np.ones(MOST + 2), *(discounts(stats[k].tolist()) for k in range(1, order + 1))]
    for h, sums in found.items():
        hot[h][:2] = float(sum(sums)), float(sum(x * d[2][i] for i, x in enumerate(sums, 1)))
    left = sum((1 - d[1][r]) * r * stats[1, r - 1] for r in range(1, MOST + 1))
    scale = n if left > 0 else n + 1
    return Totals(n, distinct, ends, d, (left or 1.0) / scale, float(scale), hot)


# --------------------------------------------------------------------------
# Evaluation
# --------------------------------------------------------------------------

class _Bucket:
    """A row of the n-gram table, with what its n-grams have in common. Its
    columns are taken out of the blob as they are needed."""

    def __init__(self, blob: pa.Buffer, order: int, totals: Totals):
        self.p, self.totals, self.order = _columns(blob), totals, order
        step = self._take("x1")
        self.v = np.cumsum(step, dtype=np.int32)
        self.u = _from_ranges(self._take("x2"), np.r_[True, step[1:] > 0]).astype(np.int32)
        del step
        self.words = np.cumsum(self._take("words"))
        self.size = len(self.words)
        self.seen = self._take("c")
        # c(v) by place in words; frequent words have theirs from all buckets
        self.count = np.bincount(self.v, weights=self.seen, minlength=self.size)
        for h, (c, _, _) in totals.hot.items():
            i = np.searchsorted(self.words, h)
            if i < self.size and self.words[i] == h:
                self.count[i] = c
        self.pair = _contexts([None, self.v, self.u], 2)
        self.first = np.flatnonzero(_changes(self.pair))  # n-gram of each pair
        self.pair_count = np.add.reduceat(self.seen, self.first, dtype=np.int64)

    def _take(self, name: str) -> np.ndarray:
        return _column(self.p.pop(name))

    def seen_after(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash of u, unigram mass of the words v of this bucket seen after u)."""
        first = self.first[(self.pair_count > 0) & (self.words != START)[self.v[self.first]]]
        u, v = self.u[first], self.v[first]
        place, at = np.unique(u, return_inverse=True)
        return self.words[place], np.bincount(at, weights=self.totals.unigram(self.count.astype(np.int64))[v])

    def scores(self, mass: dict[str, np.ndarray], hot: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
        """(key, tokens, known, base, score) per document; ``mass``: unigram
        mass ``x`` of the words seen after ``a``; ``hot``: counts ``c`` of the
        bigrams (``a``, ``b``) of frequent words."""
        t, size, seen = self.totals, self.size, self.seen
        cols = [self._take("x0"), self.v, self.u, *(self._take(f"x{k}") for k in range(3, self.order))]
        end, word = self.words == END, self.words != START
        # bigrams
        pair, c2, at2 = _pairs(cols, size, seen)
        if len(hot["c"]):
            a, b = np.searchsorted(self.words, hot["a"]), np.searchsorted(self.words, hot["b"])
            c2[np.searchsorted(pair, a * size + b)] = hot["c"]
        p = t.d[2][np.minimum(c2, MOST + 1)] * c2
        v_of, end_of = pair // size, end[pair % size]
        del pair
        gave = np.bincount(v_of, weights=p, minlength=size)
        after = np.zeros(size)  # unigram mass of the words seen after v
        after[np.searchsorted(self.words, mass["a"])] = mass["x"]
        ends = np.bincount(v_of, weights=end_of * (c2 > 0), minlength=size) > 0
        p_end = float(t.unigram(np.array([t.ends]))[0])
        after += ends * p_end
        for h, (_, total, m) in t.hot.items():
            i = np.searchsorted(self.words, h)
            if i < size and self.words[i] == h:
                gave[i], after[i] = total, m
        den = _room(self.count, gave)
        weight = _weight(self.count, gave, den, after)
        p /= np.maximum(den, 1)[v_of]
        with np.errstate(divide="ignore"):
            low = np.where(c2 > 0, np.log10(p), weight[v_of])
        low += np.where(end_of & (c2 == 0), np.log10(p_end), 0.0)
        score, p_low = low[at2], p[at2]
        del v_of, end_of, c2, at2, low, p
        # longer n-grams, up to the order
        for k in range(3, self.order + 1):
            own = context = self.pair if k == 3 else _contexts(cols, k - 1)
            if k < self.order:
                at, c, first = _longer(cols, k, size, seen)
                own = context[first]
            else:  # each n-gram of the table once
                at = first = slice(None)
                c = seen
            p = t.d[k][np.minimum(c, MOST + 1)]
            p *= c
            total, gave = np.bincount(own, weights=c), np.bincount(own, weights=p)
            den = _room(total, gave)
            below = p_low[first]
            weight = _weight(total, gave, den, np.bincount(own, weights=np.multiply(below, c > 0, out=below)))
            del below, p_low
            p /= np.maximum(den, 1)[own]
            score += weight[context]
            known = c > 0
            with np.errstate(divide="ignore"):
                np.copyto(score, np.log10(p)[at], where=known[at])
            p_low = p[at]
            del at, first, c, p, known, own, context
        del p_low
        # the token before, v: known, base, and its unigram if (u, v) was not seen
        v = self.v[self.first]
        once = np.where(word[v] & (self.pair_count == 0), np.log10(t.unigram(self.count.astype(np.int64)))[v], 0.0)
        score += once[self.pair]
        del v, once, self.pair, self.first
        count = self.count.astype(np.int64)
        known, base = word & (count > 0), word * t.base(count)
        known_end, base_end = end & (t.ends > 0), end * t.base(t.ends)
        return self._by_document(lambda a, b: (
            1.0, known[cols[1][a:b]] + known_end[cols[0][a:b]].astype(float), base[cols[1][a:b]] + base_end[cols[0][a:b]],
            score[a:b]))

    def _by_document(self, values: Callable[[int, int], tuple]) -> tuple[np.ndarray, ...]:
        """(key, tokens, known, base, score): the values of a range of n-grams,
        summed over the documents that hold them."""
        n, docs, many, key = (self._take(c) for c in ("n", "doc", "many", "key"))
        until, sums, a = np.cumsum(n), np.zeros((4, len(key))), 0
        while a < len(n):
            start = until[a] - n[a]
            b = max(a + 1, int(np.searchsorted(until, start + _SLICE, "right")))
            mine, (each, of) = slice(start, until[b - 1]), (n[a:b], np.repeat(np.arange(b - a), n[a:b]))
            new = np.zeros(len(of), bool)
            new[np.cumsum(each) - each] = True
            doc = _from_ranges(docs[mine], new)
            for i, x in enumerate(values(a, b)):
                sums[i] += np.bincount(doc, weights=many[mine] * (x[of] if np.ndim(x) else x), minlength=len(key))
            a = b
        return key.astype(np.int64), sums[0].astype(np.int64), sums[1].astype(np.int64), sums[2], sums[3]


def _room(count: np.ndarray, gave: np.ndarray) -> np.ndarray:
    """What counts are divided by: one more where nothing would be left."""
    return np.where(count - gave > 1e-9 * count, count, count + 1)


def _weight(count: np.ndarray, gave: np.ndarray, den: np.ndarray, below: np.ndarray) -> np.ndarray:
    """log10 of the backoff weights; 0 for contexts never seen."""
    out = np.zeros(len(count))
    on = count > 0
    out[on] = np.log10((1 - gave[on] / den[on]) / (1 - below[on]))
    return out


def _seen_mass(counts: DataFrame, order: int, totals: Totals) -> DataFrame:
    """(h, x): unigram mass of the words that were seen after the word h."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                h, x = _Bucket(blob.as_buffer(), order, totals).seen_after()
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(x, pa.float64())], ["h", "x"])
                _trim()

    return (counts.select("blob").mapInArrow(run, "h long, x double").groupBy("h").agg(F.sum("x").alias("x")))


def _evaluate(counts: DataFrame, mass: DataFrame, bigrams: DataFrame, order: int, buckets: int,
              totals: Totals) -> DataFrame:
    """(key, n, known, base, score): sums by document and bucket. The blob of a
    bucket comes after its rows of unigram mass and frequent bigrams."""
    @F.arrow_udf("int")
    def home(h: pa.Array) -> pa.Array:
        return pa.array(_home(h.to_numpy(), buckets), pa.int32())

    # what a bucket needs besides its table row is written to a folder of its
    # own and read by the bucket's task: a join would shuffle the whole table
    null = F.lit(None).cast("long")
    need = counts.select("bucket", F.explode("hot").alias("g")).select("bucket", "g.v", "g.w")
    side = (mass.select(home("h").alias("bucket"), F.col("h").alias("a"), null.alias("b"), null.alias("c"), "x")
            .unionByName(need.join(bigrams, ["v", "w"]).select(
                "bucket", F.col("v").alias("a"), F.col("w").alias("b"), "c", F.lit(None).cast("double").alias("x"))))
    folder = scratch_path(counts.sparkSession, "katz-sides")
    with shuffle_files_dropped(counts.sparkSession):
        _by_bucket(side, buckets).sortWithinPartitions("bucket").write.partitionBy("bucket").parquet(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = _side(fs, f"{root}/bucket={bucket}")
                got = _Bucket(blob.as_buffer(), order, totals)
                _trim()
                # a word may have its home here without being a context here
                after = rows.filter(rows["b"].is_null())
                after = after.filter(pa.array(np.isin(after["a"].to_numpy(), got.words)))
                pairs = rows.filter(rows["b"].is_valid())  # before to_numpy: nulls would make the hashes floats
                del rows
                out = got.scores({c: after[c].to_numpy() for c in "ax"}, {c: pairs[c].to_numpy() for c in "abc"})
                kinds = [pa.int64()] * 3 + [pa.float64()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)],
                                                 ["key", "n", "known", "base", "score"])
                _trim()

    return counts.select("bucket", "blob").mapInArrow(run, "key long, n long, known long, base double, score double")


def _side(fs: pafs.FileSystem, folder: str) -> pa.Table:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("x", pa.float64())])
    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    parts = [pq.read_table(f.path, filesystem=fs, schema=schema, partitioning=None) for f in found
             if f.path.endswith(".parquet")]
    return pa.concat_tables([schema.empty_table(), *parts]).combine_chunks()


def score_documents(docs: DataFrame, train: Column, text: str = "text", id_col: str = "doc_id", order: int = 3,
                    bucket_tokens: int = _BUCKET_TOKENS) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) per row of
    ``docs`` under the model of the rows where ``train`` holds.

    Tokens are the A-Z lower-cased words between blanks and \\t to \\r, then one
    end. ``score`` is the model's log10 probability of the whole text,
    ``base_score`` that of add-one unigrams. Null and empty texts have the end
    alone. Rows of one id or without one are told apart by a hash of their
    text; rows equal in both share their score, and each of them teaches.
    Without training rows every token is unknown, at probability 1."""
    if order < 3:
        raise ValueError("order must be at least 3")
    spark: SparkSession = docs.sparkSession
    ids = F.col(id_col).cast("long")
    twice = docs.groupBy(ids.alias("i")).count().where("count > 1 or i is null").limit(1).count() > 0
    key = F.xxhash64(ids, no_text(text)) if twice else ids
    rows = docs.select(no_text(text).cast("binary").alias("t"), key.alias("key"),
                       F.coalesce(train, F.lit(False)).alias("train"))
    buckets, frequent = _frequent(rows, bucket_tokens)
    counts = _count(_records(rows, order, buckets, frequent), order, buckets, frequent)
    bigrams = cut(counts.select(F.explode("hot").alias("g")).groupBy("g.v", "g.w").agg(F.sum("g.c").alias("c"))
                  .where("c > 0"), "katz-bigrams")
    totals = _totals(counts, order, bigrams, frequent)
    mass = cut(_seen_mass(counts, order, totals), "katz-mass")
    for r in mass.where(F.col("h").isin(list(frequent))).collect() if frequent else []:  # bounded as the list is
        totals.hot[r["h"]][2] = r["x"]
    p_end = float(totals.unigram(np.array([totals.ends]))[0])
    for r in bigrams.where(F.col("w") == END).collect() if frequent else []:
        totals.hot[r["v"]][2] += p_end
    plain = mass.where(~F.col("h").isin(list(frequent))) if frequent else mass
    # a bucket is a row of the table, so any split of its files is a split by buckets
    out = (_evaluate(counts, plain, bigrams, order, buckets, totals).groupBy("key")
           .agg(*[F.sum(c).alias(c) for c in ("n", "known", "base", "score")]))
    n = F.lit(totals.tokens).cast("long").alias("train_tokens")
    if not twice:
        return out.select(F.col("key").alias("doc_id"), F.col("n").alias("n_tokens"), F.col("known").alias("n_known"), n,
                          F.col("base").alias("base_score"), "score")
    # equal rows share a key: their sums are divided by their number
    out = cut(out, "katz-sums")
    same = docs.select(ids.alias("doc_id"), key.alias("key"))
    number = same.groupBy("key").agg(F.count("*").alias("m"))
    out = out.join(number, "key")
    return same.join(out, "key").select(
        "doc_id", (F.col("n") / F.col("m")).cast("long").alias("n_tokens"), (F.col("known") / F.col("m")).cast("long")
        .alias("n_known"), n, (F.col("base") / F.col("m")).alias("base_score"), (F.col("score") / F.col("m")).alias("score"))
