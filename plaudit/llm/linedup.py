"""Substring de-duplication by sentence and line hashing.

A text is cut into units that end at line breaks and sentence ends. A unit is
normalised (A-Z lower-cased, white space collapsed), its digests are grouped
over all documents, and the occurrence of lowest rank (doc_id, then position)
is the first. Every other one is a repeat. Single repeated units are everyday
phrases; a maximal run of consecutive repeats is removed when it holds at
least ``min_words`` words, with its place in the original text kept.

The digests fold map-side, so a line that a third of all documents hold costs
one row a task in the grouping; the join back deals such a digest anew when it
is skewed (AQE). Only digests that occur twice go into that join.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, no_text

_LAST = (1 << 63) - 1  # rank of rows without an id
# A unit: anything up to and with its sentence ends and line breaks.
UNIT = r"[^.!?。！？\n]+[.!?。！？\n]*|[.!?。！？\n]+"
_BLANK = r"[ \t\r\n]+"
MIN_WORDS = 25
# Scripts without blanks: so many characters of a unit count as a word at least.
WORD_CHARS = 12


def units(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc, rid, pos, digest) per unit that is not blank; ``pos`` numbers all
    units. ``rid``, a hash of the text, tells rows of one id apart."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64(no_text(text)).alias("rid"),
        F.posexplode(F.regexp_extract_all(no_text(text), F.lit(UNIT), F.lit(0))).alias("pos", "unit"))
    norm = F.trim(F.regexp_replace(F.translate("unit", upper, lower), _BLANK, " "))
    return (rows.select("doc", "rid", "pos", norm.alias("unit")).where("unit <> ''")
            .select("doc", "rid", "pos", F.unhex(F.md5(F.col("unit").cast("binary"))).alias("digest")))


def repeated_units(found: DataFrame) -> DataFrame:
    """(doc, rid, pos) of the units of which an earlier occurrence exists."""
    rank = F.struct("doc", "pos", "rid")
    # written, so that the join shuffles both sides and can split a hot digest
    first = cut(found.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n"))
                .where("n > 1").select("digest", "first"), "first-units")
    return (found.join(first, "digest").where(rank != F.col("first")).select("doc", "rid", "pos"))


def _split(text: str, repeats: set[int], min_words: int) -> tuple[str, int, list[dict]]:
    """The text that stays, the number of units, the removed ones."""
    parts, blank = re.findall(UNIT, text), re.compile(_BLANK)
    size = [max(n.count(" ") + 1, len(n) // WORD_CHARS) if n else 0
            for n in (blank.sub(" ", p).strip(" ") for p in parts)]
    gone, run, words = set(), [], 0
    for i in [*(i for i, n in enumerate(size) if n), -1]:  # blank units don't end a run
        if i in repeats:
            run.append(i)
            words += size[i]
            continue
        if words >= min_words:
            gone.update(run)
        run, words = [], 0
    kept, removed, at = [], [], 0
    for i, p in enumerate(parts):
        if i in gone:
            removed.append({"pos": i, "start": at, "length": len(p)})
        else:
            kept.append(p)
        at += len(p)
    return "".join(kept), len(parts), removed


def remove_repeated_lines(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
                          min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text, n_units, n_removed, removed) per row of ``docs``: the
    units that stay, joined as they stood, the number of units (blank ones
    too) and of removed ones, and the removed units as
    array<struct<pos, start, length>> in code points of the original text.
    ``min_words=1`` removes every repeated unit.

    Null texts count as empty and have no unit; blank units stay and don't
    interrupt a run. Repeated rows (same id and text) share their rank:
    neither removes the other's units."""
    found = cut(units(docs, text, id_col), "units")
    gone = repeated_units(found).groupBy("doc", "rid").agg(F.collect_set("pos").alias("gone"))

    @F.arrow_udf("struct<text:string,n_units:int,removed:array<struct<pos:int,start:long,length:long>>>")
    def drop(texts: pa.Array, gone: pa.Array) -> pa.Array:
        out = []
        for t, g in zip(texts, gone):
            kept, n, removed = _split(t.as_py(), set(g.as_py() or ()), min_words)
            out.append({"text": kept, "n_units": n, "removed": removed})
        return pa.array(out, pa.struct([
            ("text", pa.string()), ("n_units", pa.int32()),
            ("removed", pa.list_(pa.struct([("pos", pa.int32()), ("start", pa.int64()), ("length", pa.int64())])))]))

    rid: Column = F.xxhash64(no_text(text))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"),
                       rid.alias("rid"), no_text(text).alias("t"))
    return (rows.join(gone, ["doc", "rid"], "left").select("doc_id", drop("t", "gone").alias("r"))
            .select("doc_id", "r.text", "r.n_units", F.size("r.removed").alias("n_removed"), "r.removed"))
