"""Benchmark decontamination by a prefix-filtered set join.

Every run of ``window`` consecutive words of a benchmark item is a window (an
item with fewer words is one window). A document word inside any occurrence
of a window is hit.

The words of a window are ordered by rarity in the whole corpus. A document
that holds the window must hold its rarest word, so that one word is the
necessary prefix to join on. A match of it fixes where the window would start:
it must lie inside the document with its whole length (positional and length
bound), and only then the words are compared one by one.

The windows are the stated query set. They are cut into blocks of at most
about ``block_bytes`` bytes by a hash, however large the benchmark is; each
block goes to the tasks, every document is read against every block.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, no_text

# A-Z become a-z; other ASCII than digits and letters separates words.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))
_EMPTY = "struct<n_words:long,hits:array<int>,items:array<string>>"


def split_words(data: bytes) -> list[bytes]:
    return data.translate(_TABLE).split()


def benchmark_windows(benchmark: DataFrame, window: int = 10, text: str = "text", id_col: str = "item_id") -> DataFrame:
    """Distinct (item, win): item ids as text, the words of a window joined by
    blanks as binary. Items without words have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, wins = [], []
            for item, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = split_words(data.as_py())
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    items.append(item)
                    wins.append(b" ".join(words[i:i + window]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(wins, pa.binary())],
                                             ["item", "win"])

    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), no_text(text).cast("binary").alias("t"))
    return rows.mapInArrow(run, "item string, win binary").distinct()


def _word_counts(docs: DataFrame, vocabulary: frozenset[bytes], text: str) -> dict[bytes, int]:
    """How often each word of ``vocabulary`` (a block's words) occurs in all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for t in batch.column(0):
                total.update(filter(vocabulary.__contains__, split_words(t.as_py())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    found = (docs.select(no_text(text).cast("binary").alias("t")).mapInArrow(run, "word binary, n long")
             .groupBy("word").agg(F.sum("n").alias("n")))
    return {bytes(r["word"]): r["n"] for r in found.collect()}  # at most a block's words


class _Index:
    """A block's windows under their rarest word."""

    def __init__(self, rows: list[tuple[str | None, bytes]], counts: dict[bytes, int]):
        owners: dict[bytes, set] = defaultdict(set)
        for item, win in rows:
            owners[win].add(item)
        self.by_word: dict[bytes, list[tuple[int, list[bytes], tuple]]] = defaultdict(list)
        for win, items in owners.items():
            words = win.split(b" ")
            at = min(range(len(words)), key=lambda i: (counts.get(words[i], 0), words[i], i))
            if counts.get(words[at], 0):  # a word that no document holds rules the window out
                self.by_word[words[at]].append((at, words, tuple(items)))
        self.prefix = frozenset(self.by_word)

    def find(self, data: bytes) -> tuple[int, list[int], list[str]]:
        """Words of the text, positions hit (ascending), items found."""
        words = split_words(data)
        hits: set[int] = set()
        items: set = set()
        if not self.prefix.isdisjoint(words):
            n = len(words)
            for p, w in enumerate(words):
                for at, win, owners in self.by_word[w] if w in self.prefix else ():
                    s = p - at
                    e = s + len(win)
                    if s >= 0 and e <= n and words[s:e] == win:
                        hits.update(range(s, e))
                        items.update(owners)
        return len(words), sorted(hits), sorted(items - {None})


def _matcher(index: _Index, text: str) -> Column:
    @F.arrow_udf(_EMPTY)
    def match(texts: pa.Array) -> pa.Array:
        found = [index.find(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int32())),
             pa.array([f[2] for f in found], pa.list_(pa.string()))], names=["n_words", "hits", "items"])

    return match(no_text(text).cast("binary"))


def overlap_column(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text",
                   item_text: str = "text", item_id: str = "item_id", block_bytes: int = 8 << 20) -> Column:
    """Column of (n_words, hits, items) for the rows of ``docs``: word count,
    positions of hit words, ids (as text) of the items found. Null and empty
    texts have no words; items without an id hit words but are not listed."""
    wins = cut(benchmark_windows(benchmark, window, item_text, item_id), "windows")
    size = wins.agg(F.coalesce(F.sum(F.length("win") + F.coalesce(F.length("item"), F.lit(0)) + 16), F.lit(0))).first()[0]
    blocks = int(size) // block_bytes + 1
    found = []
    for b in range(blocks):
        part = wins.where(F.pmod(F.xxhash64("win", "item"), F.lit(blocks)) == b)
        rows = [(r["item"], bytes(r["win"])) for r in part.collect()]  # one block, bounded
        vocabulary = frozenset(w for _, win in rows for w in win.split(b" "))
        counts = _word_counts(docs, vocabulary, text) if rows else {}
        found.append(_matcher(_Index(rows, counts), text))
    if len(found) == 1:
        return found[0]
    return F.struct(
        found[0]["n_words"].alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*[m["hits"] for m in found])))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*[m["items"] for m in found])))).alias("items"))


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", id_col: str = "doc_id",
             block_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, n_words, hits, items) per row of ``docs``; repeated rows stay."""
    m = overlap_column(docs, benchmark, window, text, block_bytes=block_bytes)
    return docs.select(F.col(id_col).alias("doc_id"), m.alias("m")).select("doc_id", "m.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text") -> DataFrame:
    """Rows of ``docs`` without any hit word, all columns kept."""
    return docs.where(F.size(overlap_column(docs, benchmark, window, text)["hits"]) == 0)
