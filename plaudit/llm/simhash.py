"""SimHash near-duplicates through a Gray-order hierarchical index.

``fingerprints`` gives each text a 64-bit SimHash of its word shingles.
``near_groups`` links fingerprints that differ in at most ``max_bits`` bits:

* distinct fingerprints only (a group of exact copies is one node);
* the upper nodes of the index are shared masked bit patterns: the 64 bits
  are cut into ``max_bits + 1`` blocks, and two fingerprints within
  ``max_bits`` bits agree on one block at least, so each fingerprint goes
  under one node per block. A node with more than ``leaf`` fingerprints is
  factored further: its free bits are cut into blocks again and its children
  carry longer patterns. Fingerprints are distinct, so this ends; no cap and
  no case is dropped;
* inside a node the fingerprints lie in Gray rank order; runs of them share
  masked patterns, and whole runs are pruned against each other by the
  differences accumulated on the bits that both share;
* a node emits a spanning forest of its links, never all its pairs, and
  connected components join the forests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, cut, no_text

SEED = 42
_CHUNK = 1 << 16


def simhash(data: bytes, shingle: int = 3) -> int:
    """Unsigned SimHash of one UTF-8 text: A-Z lower-cased, words split at
    ASCII white space, shingles with repeats, majority bit strictly over half.
    Fewer words than a shingle: the whole sequence; none: zero."""
    words = data.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        grams = [digest(b" ".join(words), SEED)]
    else:
        grams = [digest(b" ".join(g), SEED) for g in zip(*(words[i:] for i in range(shingle)))]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(grams), _CHUNK):
        part = grams[at:at + _CHUNK]
        bits = np.unpackbits(np.frombuffer(b"".join(part), dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > len(grams)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3) -> DataFrame:
    """(doc_id, fp) with fp the 64 bits as a signed bigint. Null text: empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(t.as_buffer().to_pybytes(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), no_text(text).cast("binary").alias("t"))
    return picked.mapInArrow(run, "doc_id long, fp long")


def gray_rank(fp: Column) -> Column:
    """Rank of the 64 bits in Gray order, as a bigint that sorts like it."""
    r = fp
    for s in (1, 2, 4, 8, 16, 32):
        r = r.bitwiseXOR(F.shiftrightunsigned(r, s))
    return r.bitwiseXOR(F.lit(-(1 << 63)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _block_masks(free: int, blocks: int) -> list[int]:
    """``free``'s bits cut into ``blocks`` masks, high bits first."""
    bits = [b for b in range(63, -1, -1) if free >> b & 1]
    cuts = [len(bits) * i // blocks for i in range(blocks + 1)]
    return [sum(1 << b for b in bits[i:j]) for i, j in zip(cuts, cuts[1:])]


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label = up
    return label


def _shared(low: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask and pattern shared by the runs that start at ``low``."""
    both, any_ = np.bitwise_and.reduceat(fp, low), np.bitwise_or.reduceat(fp, low)
    mask = ~(both ^ any_)
    return mask, both & mask


def _node_pairs(fp: np.ndarray, max_bits: int, fan: int = 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``max_bits`` bits among Gray-ordered ``fp``.

    Two levels of runs over the leaves: pairs of upper runs whose shared
    patterns differ in more than ``max_bits`` shared bits go at once; pairs
    of lower runs add only the differences on bits that are new to them."""
    n = len(fp)
    low = np.arange(0, n, fan)
    up = np.arange(0, len(low), fan)
    lmask, lpat = _shared(low, fp)
    umask, upat = _shared(low[up], fp)
    ui, uj = np.triu_indices(len(up))
    both = umask[ui] & umask[uj]
    acc = np.bitwise_count((upat[ui] ^ upat[uj]) & both)
    keep = acc <= max_bits
    steps = np.arange(fan)
    for i, j, seen, have in zip(ui[keep], uj[keep], both[keep], acc[keep]):
        li, lj = up[i] + steps, up[j] + steps
        li, lj = li[li < len(low)], lj[lj < len(low)]
        a, b = np.repeat(li, len(lj)), np.tile(lj, len(li))
        a, b = a[a <= b], b[a <= b]
        new = lmask[a] & lmask[b] & ~seen
        near = have + np.bitwise_count((lpat[a] ^ lpat[b]) & new) <= max_bits
        a, b = a[near], b[near]
        if not len(a):
            continue
        x = np.repeat(low[a][:, None] + steps, fan, axis=1).ravel()
        y = np.tile(low[b][:, None] + steps, (1, fan)).ravel()
        ok = (x < y) & (y < n)
        x, y = x[ok], y[ok]
        ok = np.bitwise_count(fp[x] ^ fp[y]) <= max_bits
        if ok.any():
            yield x[ok], y[ok]


def _link_nodes(fp: np.ndarray, node: np.ndarray, max_bits: int, small: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (fp, earlier fp) inside each run of equal ``node``."""
    start = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    size = np.diff(np.r_[start, len(node)])

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        little = np.repeat(size <= small, size)
        for d in range(1, small):
            i = np.flatnonzero(little[:-d] & (node[d:] == node[:-d])) if d < len(node) else np.empty(0, int)
            if not len(i):
                break
            i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= max_bits]
            if len(i):
                yield i, i + d
        for s, k in zip(start[size > small], size[size > small]):
            for i, j in _node_pairs(fp[s:s + k], max_bits):
                yield s + i, s + j

    label = _forest(len(fp), pairs())
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def _linker(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (mask, val, Gray rank); a node that a batch may have
        cut waits for the next batch (at most ``leaf`` rows)."""
        held = [np.empty(0, np.int64)] * 3

        def done(cols: list[np.ndarray]) -> pa.RecordBatch:
            node = np.cumsum(np.r_[0, (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])])
            u, v = _link_nodes(cols[2].view(np.uint64), node, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for batch in batches:
            cols = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns)]
            if not len(cols[0]):
                continue
            other = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            end = other[-1] + 1 if len(other) else 0
            held = [c[end:] for c in cols]
            if end:
                yield done([c[:end] for c in cols])
        if len(held[0]):
            yield done(held)
    return run


def near_links(fps: DataFrame, max_bits: int = 3, leaf: int = 4096) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of distinct
    fingerprints ``fp`` within ``max_bits`` bits."""
    nodes = cut(fps.select("fp").distinct(), "fps").withColumn("mask", F.lit(0).cast("long")).withColumn(
        "val", F.lit(0).cast("long"))
    masks, links = [0], None
    while masks:
        children = {m: [m | b for b in _block_masks(~m & (1 << 64) - 1, max_bits + 1)] for m in masks}
        pick = F.create_map(*[F.lit(x) for m, c in children.items()
                              for x in (_signed(m), F.array(*[F.lit(_signed(k)) for k in c]))])
        rows = cut(nodes.select("fp", F.explode(pick[F.col("mask")]).alias("mask"))
                   .withColumn("val", F.col("fp").bitwiseAND(F.col("mask"))).distinct(), "nodes")
        sizes = rows.groupBy("mask", "val").count()
        big = cut(sizes.where(F.col("count") > leaf).select("mask", "val"), "big-nodes")
        masks = [r[0] % (1 << 64) for r in big.select("mask").distinct().collect()]  # a few bit masks
        if masks:
            nodes = rows.join(big, ["mask", "val"], "left_semi")
            rows = rows.join(big, ["mask", "val"], "left_anti")
        found = (rows.repartition("mask", "val")
                 .sortWithinPartitions("mask", "val", gray_rank(F.col("fp")))
                 .select("mask", "val", "fp").mapInArrow(_linker(max_bits), "u long, v long"))
        links = found if links is None else links.unionByName(found)
    return links


def near_groups(fps: DataFrame, max_bits: int = 3, leaf: int = 4096) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``fps`` (doc_id, fp);
    component_id is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits, itself included. Rows without a doc_id get
    their group's id, null where the whole group has none; repeated rows stay."""
    reps = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "reps")
    root = components(near_links(reps, max_bits, leaf)).withColumnRenamed("node", "fp")
    known = reps.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = known.groupBy("root").agg(F.min("rep").alias("component_id"))
    group = cut(known.join(least, "root").select("fp", "component_id"), "groups")
    return fps.join(group, "fp").select("doc_id", "fp", "component_id")


def simhash_groups(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3,
                   max_bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint hex, component_id) per row of ``docs``. Other
    columns of ``docs``, whatever their names, are not read."""
    fps = cut(fingerprints(docs, text, id_col, shingle), "simhash")
    return near_groups(fps, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3,
             max_bits: int = 3) -> DataFrame:
    """Rows of ``docs`` whose document is the smallest id of its near-duplicate
    group, all columns kept. Repeated rows (same id and text) become one; rows
    without an id belong to no group and stay."""
    groups = simhash_groups(docs, text, id_col, shingle, max_bits)
    keep = cut(groups.where("doc_id = component_id").select("doc_id").distinct(), "kept-ids")
    known = (docs.join(keep, docs[id_col].cast("long") == keep["doc_id"], "left_semi")
             .dropDuplicates([id_col, text]))
    return known.unionByName(docs.where(F.col(id_col).isNull()))
