"""SimHash, substring and line de-duplication against brute force."""

import hashlib
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from plaudit.llm import linedup, queries, simhash, suffixdedup

SF = "/root/testdata/sf0.001"


def brute_simhash(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(fps, bits):
    label = list(range(len(fps)))
    near = [[j for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= bits] for i in range(len(fps))]
    while True:
        new = [min(label[j] for j in near[i]) for i in range(len(fps))]
        if new == label:
            return label
        label = new


def test_simhash_query_matches_brute_force(spark, docs):
    got = {r.doc_id: r for r in queries.op4_simhash(spark, SF).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    fps = [brute_simhash(t) for _, t in rows]
    label = brute_groups(fps, 3)
    assert len(got) == len(rows)
    for (i, _), fp, k in zip(rows, fps, label):
        assert (got[i].fingerprint, got[i].component_id) == (f"{fp:016x}", rows[k][0])


def test_near_groups_split_full_nodes(spark):
    """Nodes over ``leaf`` fingerprints are factored further without losing links."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    flips = [np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64) for _ in range(3)]
    fps = np.concatenate([base, base[rng.integers(0, 12, 200)] ^ flips[0] ^ flips[1],
                          base[rng.integers(0, 12, 200)] ^ flips[2]])
    df = spark.createDataFrame([(i, int(x)) for i, x in enumerate(fps.view(np.int64))], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.near_groups(df, 3, leaf=16).collect()}
    assert [got[i] for i in range(len(fps))] == brute_groups([int(x) for x in fps], 3)


def test_simhash_edges(spark, edge, empty):
    rows = simhash.simhash_groups(edge).collect()
    assert len(rows) == edge.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[2][0].fingerprint == by[3][0].fingerprint == by[4][0].fingerprint == "0" * 16
    assert by[7][0].component_id == 1
    assert sorted(r.component_id for r in by[None]) == [2, 11]  # rows without an id join their group
    assert simhash.simhash_groups(empty).count() == 0
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 7 not in ids and ids.count(None) == 2 and ids.count(8) == 2
    assert simhash.keep_one(empty).count() == 0


def brute_cover(rows, length):
    """{row number: covered byte mask}; (doc, start) ranks, equal ranks don't cover."""
    first = {}
    for doc, data in rows:
        for i in range(len(data) - length + 1):
            s = data[i:i + length]
            first[s] = min(first.get(s, (doc, i)), (doc, i))
    out = []
    for doc, data in rows:
        mask = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if first[data[i:i + length]] < (doc, i):
                mask[i:i + length] = True
        out.append(mask)
    return out


def check_spans(df, rows, length=100, **sizes):
    got = suffixdedup.remove_repeats(df, length, **sizes).collect()
    want = sorted((doc, data, np.frombuffer(data, np.uint8)[~m].tobytes()) for (doc, data), m
                  in zip(rows, brute_cover(rows, length)))
    last = 1 << 62
    have = sorted((r.doc_id if r.doc_id is not None else last, bytes(r.text_bytes), bytes(r.kept_bytes)) for r in got)
    assert have == want
    for r in got:
        flat = [x for s in r.spans for x in (s.s, s.e)]
        assert flat == sorted(set(flat))  # maximal runs, apart from each other


def test_suffix_query_matches_brute_force(spark, docs):
    rows = sorted((r.doc_id, (r.text or "").encode()) for r in docs.collect())
    masks = brute_cover(rows, 100)
    got = {r.doc_id: r for r in queries.op2_suffix_dedup(spark, SF).collect()}
    assert any(m.any() for m in masks)
    for (doc, data), m in zip(rows, masks):
        kept = np.frombuffer(data, np.uint8)[~m].tobytes()
        runs = int((np.diff(np.r_[0, m.astype(int)]) == 1).sum())
        r = got[doc]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(data), int(m.sum()), runs, hashlib.sha256(kept).hexdigest())


def test_suffix_edges_and_small_buckets(spark, edge, empty):
    rows = [(r.doc_id if r.doc_id is not None else 1 << 62, (r.text or "").encode()) for r in edge.collect()]
    check_spans(edge, rows)
    assert suffixdedup.remove_repeats(empty).count() == 0


def test_suffix_shifted_copies_and_overfull_buckets(spark):
    """Copies at every offset, periods, and buckets over their bound."""
    rng = np.random.default_rng(5)
    word = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8)).decode()
    shared = word(260)
    rows = [(i, word(i % 37) + shared[i % 50:200 + i % 61] + word(90)) for i in range(60)]
    rows += [(100, "ab" * 300), (101, "x" + "ab" * 300), (102, shared[:99]), (103, shared[:100])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    data = [(d, t.encode()) for d, t in rows]
    check_spans(df, data)
    check_spans(df, data, bucket_bytes=4000, bound=1500)


def brute_lines(rows, min_words):
    """Kept text per row; a unit ends after sentence ends and line breaks."""
    norm = lambda u: re.sub("[ \t\r\n]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), u)).strip(" ")
    cut = lambda t: re.split(r"(?<=[.!?。！？\n])(?![.!?。！？\n])", t)
    seen = {}
    for doc, text in rows:
        for i, u in enumerate(cut(text)):
            if norm(u):
                seen[norm(u)] = min(seen.get(norm(u), (doc, i)), (doc, i))
    out = []
    for doc, text in rows:
        parts = [p for p in cut(text) if p]
        kinds = "".join("_" if not norm(u) else "x" if seen[norm(u)] != (doc, i) else "." for i, u in enumerate(parts))
        gone = set()
        for m in re.finditer("x[x_]*", kinds):
            run = [i for i in range(*m.span()) if kinds[i] == "x"]
            if sum(max(norm(parts[i]).count(" ") + 1, len(norm(parts[i])) // 12) for i in run) >= min_words:
                gone.update(run)
        out.append((doc, "".join(u for i, u in enumerate(parts) if i not in gone)))
    return sorted(out)


def test_line_query_matches_brute_force_and_edges(spark, docs, edge, empty):
    last = 1 << 62
    for df, words in ((edge, 1), (edge, 25), (docs, 25), (docs, 1)):
        rows = [(r.doc_id if r.doc_id is not None else last, r.text or "") for r in df.collect()]
        out = linedup.remove_repeated_lines(df, min_words=words).collect()
        assert all(len(r.removed) == r.n_removed for r in out)
        assert sorted((r.doc_id if r.doc_id is not None else last, r.text) for r in out) == brute_lines(rows, words)
    assert linedup.remove_repeated_lines(empty).count() == 0


def test_line_offsets_point_at_the_removed_units(spark):
    df = spark.createDataFrame([(1, "Same line\nown\n\nSAME  line"), (2, "é\nsame line\nown two")], "doc_id long, text string")
    text = {r.doc_id: r.text for r in df.collect()}
    out = {r.doc_id: r for r in linedup.remove_repeated_lines(df, min_words=1).collect()}
    assert [text[1][x.start:x.start + x.length] for x in out[1].removed] == ["SAME  line"]
    assert [text[2][x.start:x.start + x.length] for x in out[2].removed] == ["same line\n"]
    assert out[2].text == "é\nown two"


def test_repeats_inside_lines_and_everyday_phrases(spark):
    """A passage that starts inside a line goes, short repeats and texts without blanks follow the run rule."""
    passage = " ".join(f"word{i}" for i in range(20)) + ". " + " ".join(f"more{i}" for i in range(20)) + "!"
    han = "天地玄黄宇宙洪荒日月盈昃辰宿列张" * 20 + "。"
    rows = [(1, "Start here. " + passage + " Own end."), (2, "Another start? Yes. " + passage + "\nThat was it."),
            (3, "Yes. Short one. Yes. "), (4, han + "甲。"), (5, "乙。" + han)]
    got = {r.doc_id: r.text for r in linedup.remove_repeated_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1] and got[3] == rows[2][1] and got[4] == rows[3][1]
    assert got[2] == "Another start? Yes.That was it." and got[5] == "乙。"


def test_hot_line_and_hot_fingerprint(spark):
    """A third of all rows under one key."""
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the same text in a third of all rows " * 5))
        .otherwise(F.concat(F.lit("row "), F.md5(F.col("id").cast("string")))).alias("text"))
    assert linedup.remove_repeated_lines(rows).agg(F.sum("n_removed")).first()[0] == 999
    groups = simhash.simhash_groups(rows)
    assert groups.where("component_id = 0").count() == 1000
    removed = suffixdedup.remove_repeats(rows).where("size(spans) > 0")
    assert removed.count() == 1000  # the first copy repeats itself as well
