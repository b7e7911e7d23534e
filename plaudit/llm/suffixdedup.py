"""Exact substring de-duplication by a sparse, distributed suffix array.

Every byte covered by a ``length``-byte string that also starts earlier
(smaller doc_id, or same document and earlier start) goes. Texts are UTF-8
bytes, matches never cross documents, strings are judged on the input.

*Suffixes.* Not every position is sorted: in each ``length``-byte string one
anchor is chosen from its content alone (the rightmost smallest hash among its
``_GRAM``-byte grams), so equal strings have the anchor at the same place and
their suffixes from the anchor on start with the same gram. Neighbouring
strings share anchors; a record is one anchor with the text around it that
holds all its strings, about 3.3 bytes shipped per byte of text.

*Buckets.* Records are range-partitioned by the leading bytes of the suffix at
the anchor, with splitters from a sample of documents (they balance, they do
not decide), and inside a range by a hash of the gram where a range is larger
than a bucket. Equal leading grams share a bucket, so no comparison crosses
bucket boundaries, except for a bucket that outgrows its bound: its strings
are then grouped one by one in Spark.

*Inside a bucket* a multikey quicksort (eight bytes a symbol, only ties go on
to the next symbol) groups equal suffix heads, then equal records, then the
single strings of what is left; all but the earliest of a group are covered.

Copies are folded before the shuffle: of equal records in a map batch only the
earliest travels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, no_text

_GRAM = 16  # two 8-byte symbols
_PART = 2 << 20  # bytes of text hashed at once
_FLUSH = 8 << 20  # bytes of text whose records are folded together
_LAST = (1 << 63) - 1  # rank of rows without an id
_B = 0x9E3779B97F4A7C15


def _anchors(data: np.ndarray, length: int) -> np.ndarray:
    """Anchor of the string at every start 0 .. len(data) - length."""
    with np.errstate(over="ignore"):
        h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        step, power = 1, _B
        while step < _GRAM:
            h = h[:-step] * np.uint64(power) + h[step:]
            power = power * power % (1 << 64)
            step *= 2
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    low = np.uint64((1 << 24) - 1)
    best = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
    width, have = length - _GRAM + 1, 1
    while have * 2 <= width:
        best = np.minimum(best[:-have], best[have:])
        have *= 2
    if have < width:
        best = np.minimum(best[:-(width - have)], best[width - have:])
    return (low - (best & low)).astype(np.int64)


def _records(texts: list[bytes], length: int) -> Iterator[tuple[int, int, bytes, int]]:
    """(text number, first start, record bytes, anchor offset in the record)."""
    def cuts() -> Iterator[list[tuple[int, int, bytes]]]:
        held, size = [], 0
        for k, t in enumerate(texts):
            for at in range(0, len(t) - length + 1, _PART):
                piece = t[at:at + _PART + length - 1]
                held.append((k, at, piece))
                size += len(piece)
                if size >= _PART:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    for pieces in cuts():
        body = b"".join(p for _, _, p in pieces)
        sizes = np.array([len(p) for _, _, p in pieces])
        first = np.r_[0, np.cumsum(sizes)[:-1]]
        anchor = _anchors(np.frombuffer(body, dtype=np.uint8), length)
        starts = np.concatenate([np.arange(f, f + n - length + 1) for f, n in zip(first, sizes)])
        owner = np.repeat(np.arange(len(pieces)), sizes - length + 1)
        anchor = anchor[starts]
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
        end = np.r_[new[1:], len(starts)] - 1
        for lo, hi, a, o in zip(starts[new].tolist(), starts[end].tolist(), anchor[new].tolist(), owner[new].tolist()):
            k, at, _ = pieces[o]
            yield k, at + lo - int(first[o]), body[lo:hi + length], a - lo


class _Batch:
    """Records of one map batch, folded: of equal ones the earliest stays."""

    def __init__(self, length: int):
        self.length = length
        self.best: dict[bytes, list] = {}
        self.spans: list[tuple[int, int, int, int]] = []  # doc, rid, start, end
        self.size = 0

    def add(self, docs: list[int], rids: list[int], texts: list[bytes]) -> None:
        best = self.best
        for k, lo, body, a in _records(texts, self.length):
            rec = (docs[k], lo, rids[k], a)
            old = best.get(body)
            if old is None:
                best[body] = [rec]
            elif rec[:2] == old[0][:2]:
                old.append(rec)
            else:
                late = [rec]
                if rec[:2] < old[0][:2]:
                    best[body], late = late, old
                self.spans += [(d, r, s, s + len(body)) for d, s, r, _ in late]
        self.size += sum(map(len, texts))

    def merged_spans(self) -> Iterator[tuple[int, int, int, int]]:
        now = None
        for doc, rid, s, e in sorted(self.spans):
            if now and now[:2] == (doc, rid) and s <= now[3]:
                now = (doc, rid, now[2], max(e, now[3]))
            else:
                if now:
                    yield now
                now = (doc, rid, s, e)
        if now:
            yield now


_MAPPED = "part int, sub int, size long, blob binary, doc long, rid long, s long, e long"
_MAPPED_ARROW = pa.schema([("part", pa.int32()), ("sub", pa.int32()), ("size", pa.int64()), ("blob", pa.binary()),
                           ("doc", pa.int64()), ("rid", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])
_FIELDS = (("doc", np.int64), ("lo", np.int64), ("rid", np.int64), ("a", np.int32), ("n", np.int32))


def _mapper(length: int, splitters: list[bytes], subs: int):
    cuts = np.array(splitters, dtype=f"S{_GRAM}")

    def flush(batch: _Batch) -> pa.RecordBatch:
        rows: list[dict] = []
        if batch.best:
            bodies, recs = [], []
            for body, group in batch.best.items():
                for rec in group:
                    bodies.append(body)
                    recs.append((*rec, len(body)))
            cols = list(zip(*recs))
            heads = np.array([b[a:a + _GRAM] for b, a in zip(bodies, cols[3])], dtype=f"S{_GRAM}")
            part = np.searchsorted(cuts, heads, side="right")
            sub = np.zeros(len(part), np.int64)
            if subs > 1:
                words = np.ascontiguousarray(heads).view(np.uint64).reshape(-1, _GRAM // 8)
                with np.errstate(over="ignore"):
                    sub = (((words[:, 0] * np.uint64(_B)) ^ words[:, 1]) * np.uint64(_B) >> np.uint64(33)).astype(
                        np.int64) % subs
            order = np.lexsort((sub, part))
            arrays = [np.array(c, dtype=t)[order] for c, (_, t) in zip(cols, _FIELDS)]
            part, sub = part[order], sub[order]
            start = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (sub[1:] != sub[:-1])])
            pack = zstandard.ZstdCompressor(level=1)
            for i, j in zip(start, np.r_[start[1:], len(part)]):
                text = b"".join([bodies[k] for k in order[i:j]])
                head = np.int64(j - i).tobytes() + b"".join(x[i:j].tobytes() for x in arrays)
                rows.append({"part": int(part[i]), "sub": int(sub[i]), "size": len(text),
                             "blob": pack.compress(head + text)})
        # spans only pass through; dealt over the partitions by their document
        rows += [{"part": -1, "sub": doc % 4099, "size": 0, "doc": doc, "rid": rid, "s": s, "e": e}
                 for doc, rid, s, e in batch.merged_spans()]
        return pa.RecordBatch.from_pylist(rows, schema=_MAPPED_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Batch(length)
        for batch in batches:
            docs, rids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < batch.num_rows:
                texts, size, end = [], 0, at
                while end < batch.num_rows and size < _PART:
                    texts.append(batch.column(2)[end].as_py())
                    size += len(texts[-1])
                    end += 1
                held.add(docs[at:end], rids[at:end], texts)
                at = end
                if held.size >= _FLUSH:
                    yield flush(held)
                    held = _Batch(length)
        yield flush(held)
    return run


# --------------------------------------------------------------------------
# Inside a bucket
# --------------------------------------------------------------------------

def _multikey(idx: np.ndarray, gid: np.ndarray, symbols: list[Callable[[np.ndarray], np.ndarray]]
              ) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of ``idx`` inside the groups ``gid``: one symbol at a
    time, ties alone go on. Returns the members of the groups that are equal
    in all symbols, ordered by group."""
    for symbol in symbols:
        if not len(idx):
            break
        key = symbol(idx)
        order = np.lexsort((key, gid))
        idx, gid, key = idx[order], gid[order], key[order]
        g = np.cumsum(np.r_[True, (gid[1:] != gid[:-1]) | (key[1:] != key[:-1])]) - 1
        tied = np.bincount(g)[g] > 1
        idx, gid = idx[tied], g[tied]
    return idx, gid


def _later(gid: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Members that come strictly after the first (doc, start) of their group."""
    order = np.lexsort((start, doc, gid))
    g, d, s = gid[order], doc[order], start[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    rank = np.cumsum(np.r_[True, g[1:] != g[:-1]]) - 1
    late = (d > d[first][rank]) | (s > s[first][rank])
    out = np.zeros(len(gid), dtype=bool)
    out[order[late]] = True
    return out


def bucket_spans(blobs: list[bytes], length: int, most: int = 2_000_000) -> Iterator[tuple[np.ndarray, ...]]:
    """(doc, rid, start, end) arrays covered inside one bucket."""
    parts, texts = {f: [] for f, _ in _FIELDS}, []
    for raw in blobs:
        n, at = int(np.frombuffer(raw, np.int64, 1)[0]), 8
        for f, t in _FIELDS:
            parts[f].append(np.frombuffer(raw, t, n, at))
            at += n * np.dtype(t).itemsize
        texts.append(raw[at:])
    doc, lo, rid, a, n = (np.concatenate(parts[f]).astype(np.int64) for f, _ in _FIELDS)
    body = b"".join(texts) + bytes(8)
    base = np.r_[0, np.cumsum(n)[:-1]]
    words = np.ndarray(shape=(len(body) - 7,), dtype=">u8", buffer=body, strides=(1,))

    def at(offset: np.ndarray) -> np.ndarray:
        return words[offset].astype(np.uint64)

    idx = np.arange(len(doc))
    heads = [lambda i, d=d: at(base[i] + a[i] + d) for d in range(0, _GRAM, 8)]
    idx, gid = _multikey(idx, np.zeros(len(idx), np.int64), heads)
    if not len(idx):
        return
    whole = [lambda i: n[i] * 4096 + a[i]]
    for d in range(0, int(n[idx].max()), 8):
        whole.append(lambda i, d=d: np.where(d + 8 <= n[i], at(base[i] + np.minimum(d, n[i] - 8)),
                                             np.where(d < n[i], at(base[i] + n[i] - 8), np.uint64(0))))
    same, sgid = _multikey(idx, gid, whole)
    gone = np.zeros(len(doc), dtype=bool)
    if len(same):
        late = same[_later(sgid, doc[same], lo[same])]
        gone[late] = True
        yield doc[late], rid[late], lo[late], lo[late] + n[late]
    left = ~gone[idx]
    idx, gid = idx[left], gid[left]
    size = np.bincount(gid)[gid] > 1 if len(gid) else np.zeros(0, bool)
    idx, gid = idx[size], gid[size]
    if not len(idx):
        return
    # single strings of the records that are left, some whole groups at a time
    count = n[idx] - length + 1
    total = np.cumsum(count)
    i = 0
    while i < len(idx):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + most)))
        while j < len(idx) and gid[j] == gid[j - 1]:
            j += 1
        rec = np.repeat(np.arange(i, j), count[i:j])
        off = np.arange(len(rec)) - np.repeat(total[i:j] - count[i:j] - (total[i - 1] if i else 0), count[i:j])
        owner = idx[rec]
        where, start = base[owner] + off, lo[owner] + off
        steps = [*range(0, length - 8, 8), length - 8]
        symbols = [lambda e: (a[owner[e]] - off[e]).astype(np.uint64)]
        symbols += [lambda e, d=d: at(where[e] + d) for d in steps]
        el, eg = _multikey(np.arange(len(rec)), gid[rec], symbols)
        if len(el):
            late = np.sort(el[_later(eg, doc[owner[el]], start[el])])
            if len(late):
                o, s = owner[late], start[late]
                new = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (s[1:] > s[:-1] + 1)])
                last = np.r_[new[1:], len(o)] - 1
                yield doc[o[new]], rid[o[new]], s[new], s[last] + length
        i = j


_FOUND = "doc long, rid long, s long, e long, win binary"


def _found(doc, rid, s, e, win=None) -> pa.RecordBatch:
    arrays = [pa.array(x, pa.int64()) for x in (doc, rid, s, e)]
    return pa.RecordBatch.from_arrays(
        [*arrays, pa.array(win, pa.binary()) if win is not None else pa.nulls(len(arrays[0]), pa.binary())],
        ["doc", "rid", "s", "e", "win"])


def _strings(raw: bytes, length: int) -> pa.RecordBatch:
    """Every string of the records of a blob, for a bucket over its bound."""
    n, at, cols = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for _, t in _FIELDS:
        cols.append(np.frombuffer(raw, t, n, at).tolist())
        at += n * np.dtype(t).itemsize
    out: tuple[list, ...] = ([], [], [], [], [])
    for doc, lo, rid, _, size in zip(*cols):
        for k in range(size - length + 1):
            for x, v in zip(out, (doc, rid, lo + k, lo + k + length, raw[at + k:at + k + length])):
                x.append(v)
        at += size
    return _found(*out)


def _bucketer(length: int, bound: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in (part, sub) order."""
        unpack = zstandard.ZstdDecompressor()
        now, held, size, over = None, [], 0, False

        def close() -> Iterator[pa.RecordBatch]:
            if held and not over:
                for spans in bucket_spans(held, length):
                    yield _found(*spans)

        for batch in batches:
            for row in batch.to_pylist():
                if row["blob"] is None:
                    yield _found([row["doc"]], [row["rid"]], [row["s"]], [row["e"]])
                    continue
                if (row["part"], row["sub"]) != now:
                    yield from close()
                    now, held, size, over = (row["part"], row["sub"]), [], 0, False
                raw = unpack.decompress(row["blob"])
                size += row["size"]
                if size > bound:
                    for r in [*held, raw]:
                        yield _strings(r, length)
                    held, over = [], True
                else:
                    held.append(raw)
        yield from close()
    return run


def _splitters(rows: DataFrame, length: int, ranges: int, sample: int = 2000) -> list[bytes]:
    """Range splitters: leading bytes at the anchors of about ``sample`` documents."""
    if ranges < 2:
        return []

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [body[a:a + _GRAM] for t in batch.column(2)
                   for _, _, body, a in list(_records([t.as_py()[:1 << 16]], length))[::7]]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.binary())], ["head"])

    share = max(1, rows.count() // sample)
    picked = rows.where(F.pmod(F.xxhash64("doc", "rid"), F.lit(share)) == 0)
    found = sorted(bytes(r[0]) for r in picked.mapInArrow(heads, "head binary")
                   .orderBy(F.xxhash64("head")).limit(100 * ranges if ranges < 1000 else 100_000).collect())
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def covered_spans(docs: DataFrame, length: int = 100, text: str = "text", id_col: str = "doc_id",
                  bucket_bytes: int = 8 << 20, bound: int = 24 << 20) -> DataFrame:
    """Stored spans (doc, rid, s, e): bytes s .. e-1 of the text are covered.
    Spans of a text may overlap. ``doc`` is the id (the largest bigint without
    one), ``rid`` a hash of the text that tells rows of one id apart."""
    if length < 2 * _GRAM:
        raise ValueError(f"length must be at least {2 * _GRAM}")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"),
                       F.xxhash64(no_text(text)).alias("rid"), no_text(text).cast("binary").alias("t"))
    size = rows.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    buckets = max(1, int(size * 3.4) // bucket_bytes)
    ranges = min(buckets, 4096)
    mapped = rows.where(F.length("t") >= length).mapInArrow(
        _mapper(length, _splitters(rows, length, ranges), -(-buckets // ranges)), _MAPPED)
    found = cut(mapped.repartition("part", "sub").sortWithinPartitions("part", "sub")
                .mapInArrow(_bucketer(length, bound), _FOUND), "spans")
    spans = found.where("win is null").select("doc", "rid", "s", "e")
    strings = found.where("win is not null")
    if strings.isEmpty():
        return spans
    first = cut(strings.groupBy("win").agg(F.min(F.struct("doc", "s")).alias("first")), "first-strings")
    late = (strings.join(first, "win")
            .where((F.col("doc") > F.col("first.doc")) | (F.col("s") > F.col("first.s"))))
    return spans.unionByName(late.select("doc", "rid", "s", "e"))


def remove_repeats(docs: DataFrame, length: int = 100, text: str = "text", id_col: str = "doc_id",
                   **sizes: int) -> DataFrame:
    """(doc_id, text_bytes, kept_bytes, spans) per row of ``docs``: the UTF-8
    bytes, those that stay, and the maximal removed runs. Null texts count as
    empty; repeated rows are judged alike (neither starts earlier)."""
    spans = (covered_spans(docs, length, text, id_col, **sizes).groupBy("doc", "rid")
             .agg(F.collect_list(F.struct("s", "e")).alias("found")))

    @F.arrow_udf("struct<kept_bytes:binary,spans:array<struct<s:long,e:long>>>")
    def cut_out(texts: pa.Array, found: pa.Array) -> pa.Array:
        kept, runs = [], []
        for t, f in zip(texts, found):
            data, merged, at, parts = t.as_py(), [], 0, []
            for s, e in sorted((x["s"], x["e"]) for x in f.as_py() or ()):
                if merged and s <= merged[-1]["e"]:
                    merged[-1]["e"] = max(e, merged[-1]["e"])
                else:
                    merged.append({"s": s, "e": e})
            for x in merged:
                parts.append(data[at:x["s"]])
                at = x["e"]
            kept.append(b"".join([*parts, data[at:]]))
            runs.append(merged)
        return pa.StructArray.from_arrays(
            [pa.array(kept, pa.binary()),
             pa.array(runs, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))], names=["kept_bytes", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"),
                       F.xxhash64(no_text(text)).alias("rid"), no_text(text).cast("binary").alias("text_bytes"))
    return (rows.join(spans, ["doc", "rid"], "left")
            .select("doc_id", "text_bytes", cut_out("text_bytes", "found").alias("r"))
            .select("doc_id", "text_bytes", "r.kept_bytes", "r.spans"))


