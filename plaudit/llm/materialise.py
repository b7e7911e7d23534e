"""Training-order materialisation: token ids in fixed-stride binary shards.

1. Documents are tokenised and dealt into range buckets of their id. Inside a
   bucket, in id order, the tokens (an end-of-text id after each document)
   form a stream, stored in chunks; bucket totals give every chunk its place
   in the corpus-wide stream.
2. The stream is cut into sequences of ``length`` tokens, the last one padded
   with the end-of-text id. A keyed Feistel permutation with cycle-walking
   over exactly the number of sequences gives each one a global slot.
3. Shard k holds the slots ``k * per_shard ...`` in order, each at the fixed
   stride of ``2 * length`` bytes (uint16, little endian), so a reader seeks
   to any slot and reads on from there.

A shard is written under a temporary name and renamed; a repeated attempt
writes the same bytes again.
"""

from __future__ import annotations

import array
import base64
import hashlib
import heapq
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import tiktoken
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucket_count, cut, no_text, range_bucket, scratch_path

# Fixed values of the public byte-level vocabularies: pre-split pattern and
# the end-of-text id above their ranks.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = 50256
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


@dataclass(frozen=True)
class Layout:
    length: int = 2048
    per_shard: int = 1024
    key: bytes = b"training order 1"

    @property
    def stride(self) -> int:
        return 2 * self.length


def token_ranks(vocabulary: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}


def encoding(vocabulary: bytes) -> tiktoken.Encoding:
    return tiktoken.Encoding("file", pat_str=SPLIT_PATTERN, mergeable_ranks=token_ranks(vocabulary), special_tokens={})


# Runs of white space that the pre-split pattern can't match in its bounded stack.
_LONG_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{20000,}")


def merge_runs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-split piece by the merge rules: the pair of lowest
    rank, the leftmost of equal ones, is merged first. A heap over a linked
    list, so time is n log n in the piece's length."""
    left, right = list(range(-1, len(piece) - 1)), list(range(1, len(piece) + 1))
    part = [piece[i:i + 1] for i in range(len(piece))]
    heap = [(ranks[p], i, 2) for i in range(len(piece) - 1) if (p := piece[i:i + 2]) in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = right[i]
        if not part[i] or j == len(piece) or len(part[i]) + len(part[j]) != size:
            continue  # one of the two has been merged since
        part[i], part[j], right[i] = part[i] + part[j], b"", right[j]
        if right[i] < len(piece):
            left[right[i]] = i
        for a, b in ((left[i], i), (i, right[i])):
            if a >= 0 and b < len(piece) and (whole := part[a] + part[b]) in ranks:
                heapq.heappush(heap, (ranks[whole], a, len(whole)))
    return [ranks[p] for p in part if p]


def encode(enc: tiktoken.Encoding, ranks: dict[bytes, int], text: str) -> list[int]:
    """Token ids of a whole text. The pattern takes a run of white space as one
    piece, without its last sign where a word follows; long runs are cut out
    at just these places and merged apart, so the ids are those of the text."""
    ids, at = [], 0
    for run in _LONG_SPACE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += enc.encode_ordinary(text[at:run.start()])
        ids += merge_runs(text[run.start():end].encode(), ranks)
        at = end
    return ids + enc.encode_ordinary(text[at:])


# --------------------------------------------------------------------------
# Keyed permutation
# --------------------------------------------------------------------------

class Permutation:
    """Keyed permutation of 0 .. n-1: eight Feistel rounds over the next even
    number of bits, walked along the cycle until the value is below n."""

    def __init__(self, n: int, key: bytes, rounds: int = 8):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.keys = [int.from_bytes(hashlib.sha256(key + bytes([i])).digest()[:8], "little") for i in range(rounds)]

    def _round(self, r: np.ndarray, key: int) -> np.ndarray:
        x = r ^ np.uint64(key)
        for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
        return (x ^ (x >> np.uint64(31))) & np.uint64((1 << self.half) - 1)

    def _pass(self, x: np.ndarray, back: bool) -> np.ndarray:
        half = np.uint64(self.half)
        left, right = x >> half, x & np.uint64((1 << self.half) - 1)
        for key in reversed(self.keys) if back else self.keys:
            left, right = (right ^ self._round(left, key), left) if back else (right, left ^ self._round(right, key))
        return left << half | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        y = self._pass(np.asarray(x, dtype=np.uint64), back)
        while (out := y >= self.n).any():
            y[out] = self._pass(y[out], back)
        return y.astype(np.int64)

    def slots(self, sequences: np.ndarray) -> np.ndarray:
        return self._walk(sequences, False)

    def sequences(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, True)


# --------------------------------------------------------------------------
# Steps
# --------------------------------------------------------------------------

def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def tokenise(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n, blob): tokens of the whole text and the end-of-text id, as
    uint16 under zstandard. Null and empty texts have the end id alone. The
    vocabulary file is read on the driver and sent to the tasks."""
    with open(vocabulary, "rb") as f:
        body = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, ranks, pack = encoding(body), token_ranks(body), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            sizes, blobs = [], []
            for t in batch.column(1):
                ids = array.array("H", encode(enc, ranks, t.as_py()))
                ids.append(END_OF_TEXT)
                sizes.append(len(ids))
                blobs.append(pack.compress(ids.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), _binary(blobs)], ["doc_id", "n", "blob"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), no_text(text).alias("t")).mapInArrow(
        run, "doc_id long, n long, blob binary")


_CHUNK = "bucket int, start long, n long, blob binary, ids array<long>, sizes array<long>"


def _chunker(target: int = 1 << 17):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in (bucket, doc_id) order to chunks of about ``target`` tokens
        with their start in the bucket's stream. A document may span chunks."""
        pack, unpack = zstandard.ZstdCompressor(level=6), zstandard.ZstdDecompressor()
        now, start, held, parts, ids, sizes = None, 0, 0, [], [], []

        def flush() -> pa.RecordBatch:
            row = {"bucket": now, "start": start, "n": held, "blob": pack.compress(b"".join(parts)),
                   "ids": list(ids), "sizes": list(sizes)}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema(
                [("bucket", pa.int32()), ("start", pa.int64()), ("n", pa.int64()), ("blob", pa.binary()),
                 ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))]))

        for batch in batches:
            for bucket, doc, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "blob"))):
                if bucket != now:
                    if sizes:
                        yield flush()
                    now, start, held, parts, ids, sizes = bucket, 0, 0, [], [], []
                raw = unpack.decompress(blob)
                for at in range(0, len(raw), 2 * target):
                    piece = raw[at:at + 2 * target]
                    parts.append(piece)
                    ids.append(doc)
                    sizes.append(len(piece) // 2)
                    held += len(piece) // 2
                    if held >= target:
                        yield flush()
                        start, held, parts, ids, sizes = start + held, 0, [], [], []
        if sizes:
            yield flush()
    return run


def stream_chunks(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text", id_col: str = "doc_id",
                  buckets: int | None = None) -> DataFrame:
    """The token streams of the buckets as stored chunks (see ``_CHUNK``)."""
    tokens = tokenise(docs, vocabulary, text, id_col)
    # splitters from the id column alone, so that texts are tokenised once
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    dealt = range_bucket(ids, "doc_id", "bucket", buckets or bucket_count(docs.count()), on=tokens,
                         no_key=F.xxhash64("blob"))
    return cut(dealt.repartition("bucket").sortWithinPartitions("bucket", F.col("doc_id"), "blob")
               .select("bucket", "doc_id", "blob").mapInArrow(_chunker(), _CHUNK), "token-chunks")


def _pieces(layout: Layout, base: dict[int, int], perm: Permutation):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks to the parts that fall into each sequence."""
        pack, unpack = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                raw = unpack.decompress(row["blob"])
                first = base[row["bucket"]] + row["start"]
                seqs = np.arange(first // layout.length, (first + row["n"] - 1) // layout.length + 1)
                slots = perm.slots(seqs)
                ends = np.cumsum(row["sizes"])
                out = {"slot": [], "seq": [], "at": [], "blob": [], "ids": []}
                for seq, slot in zip(seqs.tolist(), slots.tolist()):
                    lo, hi = max(0, seq * layout.length - first), min(row["n"], (seq + 1) * layout.length - first)
                    i, j = np.searchsorted(ends, [lo, hi - 1], side="right")
                    out["slot"].append(slot)
                    out["seq"].append(seq)
                    out["at"].append(first + lo - seq * layout.length)
                    out["blob"].append(pack.compress(raw[2 * lo:2 * hi]))
                    out["ids"].append(list(dict.fromkeys(row["ids"][i:j + 1])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["slot"], pa.int64()), pa.array(out["seq"], pa.int64()),
                     pa.array(out["at"], pa.int32()), _binary(out["blob"]),
                     pa.array(out["ids"], pa.list_(pa.int64()))], list(out))
    return run


_MANIFEST = ("slot long, sequence long, shard long, byte_offset long, n_tokens int, doc_ids array<long>, "
             "sha256 string")


def _shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.bin"


def _writer(layout: Layout, folder: str):
    pad = END_OF_TEXT.to_bytes(2, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in (slot, at) order; each shard lies whole in one partition."""
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        unpack = zstandard.ZstdDecompressor()
        out, temp, shard = None, "", -1
        seq: dict | None = None

        def finish() -> dict:
            body = b"".join(seq.pop("parts"))
            seq["n_tokens"] = len(body) // 2
            body += pad * (layout.length - seq["n_tokens"])
            out.write(body)
            return seq | {"sha256": hashlib.sha256(body).hexdigest()}

        def close() -> None:
            out.close()
            fs.move(temp, _shard_path(root, shard))

        for batch in batches:
            done = []
            for slot, number, blob, ids in zip(*(batch.column(c).to_pylist() for c in ("slot", "seq", "blob", "ids"))):
                if seq is None or slot != seq["slot"]:
                    if seq is not None:
                        done.append(finish())
                    if slot // layout.per_shard != shard:
                        if out is not None:
                            close()
                        shard = slot // layout.per_shard
                        temp = f"{root}/.{uuid.uuid4().hex}.tmp"
                        out = fs.open_output_stream(temp)
                    seq = {"slot": slot, "sequence": number, "shard": shard,
                           "byte_offset": slot % layout.per_shard * layout.stride, "doc_ids": [], "parts": []}
                seq["parts"].append(unpack.decompress(blob))
                seq["doc_ids"] += [i for i in ids if i not in seq["doc_ids"]]
            yield _manifest(done)
        if seq is not None:
            yield _manifest([finish()])
            close()
    return run


def _manifest(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(
        [("slot", pa.int64()), ("sequence", pa.int64()), ("shard", pa.int64()), ("byte_offset", pa.int64()),
         ("n_tokens", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("sha256", pa.string())]))


def materialise(docs: DataFrame, folder: str | None = None, vocabulary: str = VOCABULARY, layout: Layout = Layout(),
                text: str = "text", id_col: str = "doc_id", buckets: int | None = None) -> DataFrame:
    """Write the shards under ``folder`` (default: a fresh one in the shared
    checkpoint folder) and return the manifest, one row per sequence: slot,
    sequence, shard, byte_offset, n_tokens without padding, doc_ids, sha256 of
    the stored bytes. An empty table writes no shard. Documents without an id
    come first in the stream, repeated rows stay."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "shards")
    chunks = stream_chunks(docs, vocabulary, text, id_col, buckets)
    totals = chunks.groupBy("bucket").agg(F.sum("n").alias("n")).orderBy("bucket").collect()  # a row a bucket
    base, total = {}, 0
    for r in totals:
        base[r["bucket"]] = total
        total += r["n"]
    count = -(-total // layout.length)
    perm = Permutation(count, layout.key)
    pieces = chunks.mapInArrow(_pieces(layout, base, perm), "slot long, seq long, at int, blob binary, ids array<long>")
    # shards go to the tasks in ranges, 16 a task or enough for every core
    shards = -(-count // layout.per_shard)
    tasks = max(1, min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards // 16)))
    task: Column = F.floor(F.floor(F.col("slot") / layout.per_shard) * tasks / max(1, shards)).cast("int")
    return cut(pieces.repartitionById(tasks, task).sortWithinPartitions("slot", "at")
               .mapInArrow(_writer(layout, folder), _MANIFEST), "manifest").withColumn("folder", F.lit(folder))


def read_slots(spark: SparkSession, folder: str, first: int, last: int, layout: Layout = Layout()) -> DataFrame:
    """(slot, tokens) of the slots first .. last-1: the resumable read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            slots = batch.column(0).to_numpy()
            tokens = []
            for shard in np.unique(slots // layout.per_shard):
                with fs.open_input_file(_shard_path(root, int(shard))) as f:
                    for slot in slots[slots // layout.per_shard == shard]:
                        f.seek(int(slot % layout.per_shard) * layout.stride)
                        tokens.append(np.frombuffer(f.read(layout.stride), dtype="<u2").astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.list_(pa.int32()))],
                                             ["slot", "tokens"])

    return spark.range(first, last).withColumnRenamed("id", "slot").mapInArrow(run, "slot long, tokens array<int>")
