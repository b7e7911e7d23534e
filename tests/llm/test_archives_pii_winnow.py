"""WARC round trip, PII pseudonyms, winnowing."""

import base64
import gzip
import hashlib
import re
from pathlib import Path

import pytest
import xxhash
from pyspark.sql import functions as F

from plaudit.llm import pii, queries, warc, winnow

SF = "/root/testdata/sf0.001"


def test_warc_round_trip(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    more = spark.createDataFrame([
        (None, "u", None), (9001, None, ""), (None, "x\r\ny: z", "é" * 600), (9002, "q", "é" * 600),
        (9002, "q", "é" * 600), (9003, "s", "short"), (9004, "s", "short")], pages.schema)
    copies = pages.where("page_id < 9").withColumn("page_id", F.col("page_id") + 5000)
    every = pages.unionByName(copies).unionByName(more).withColumn("payload", F.lit(1)).withColumn("keep", F.lit(1))
    path = warc.write_archives(every)
    back = warc.read_archives(spark, path)
    rows = back.collect()
    assert len(rows) == every.count()
    html = {r.page_id: (r.html or "").encode() for r in every.collect()}
    for r in rows:
        if r.page_id is None:
            continue
        data = html[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert r.payload == (data if r.record_type == "response" else None)
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in rows}
    assert all(kinds[i] == ("revisit", i + 5000) for i in range(9) if len(html[i]) >= 1000)
    assert kinds[9003] == kinds[9004] == ("response", None) and kinds[9002] == ("response", None)
    assert sorted((r.record_type, r.refers_to) for r in rows if r.page_id is None) == [
        ("response", None), ("revisit", 9002)]
    # predicates are taken by the source, ranges split the files, standard tools can read them
    revisits = back.where("record_type = 'revisit' and page_id in (1, 2)")
    assert revisits.count() == len([i for i in (1, 2) if len(html[i]) >= 1000])
    assert " Filter (" not in revisits._jdf.queryExecution().executedPlan().toString()
    split = spark.read.format("warc").option("splitBytes", 5000).option("payload", "verify").load(path)
    assert split.count() == len(rows) and split.where("payload is not null").count() == 0
    folder = Path(path.removeprefix("file:"))
    text = b"".join(gzip.open(f).read() for f in sorted(folder.glob("part-*.warc.gz")))
    assert text.count(b"WARC/1.1\r\n") == len(rows)
    assert not list(folder.glob(".*.warc.gz"))


def test_warc_plain_and_foreign_files(spark, tmp_path):
    """Uncompressed archives and gzip members without lengths."""
    rows = [{"record_type": "response", "target_uri": f"http://x/{i}", "page_id": i, "refers_to": None,
             "payload_bytes": 3, "payload_digest": hashlib.sha1(b"abc").hexdigest(), "payload": b"abc"} for i in range(5)]
    raw = [warc.record_bytes(r) for r in rows]
    (tmp_path / "a.warc").write_bytes(b"".join(raw))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in raw))
    (tmp_path / "_ignored.warc").write_bytes(b"junk")
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(r.page_id for r in got) == sorted([*range(5)] * 2) and {bytes(r.payload) for r in got} == {b"abc"}


def _foreign(kind, block, digest=None, **more):
    """A record as other writers make it: no payload length, seldom a payload digest."""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{kind}>", "WARC-Date": "2024-01-01T00:00:00Z",
            "WARC-Block-Digest": "sha1:" + "A" * 32, **more, "Content-Length": str(len(block))}
    if digest:
        head["WARC-Payload-Digest"] = "sha1:" + base64.b32encode(hashlib.sha1(digest).digest()).decode()
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def test_warc_headers_of_other_writers(spark, tmp_path):
    """Predicates keep what the unfiltered read returns; every record type has its block."""
    get = b"GET / HTTP/1.1\r\nHost: x\r\n\r\n"
    blocks = {"warcinfo": b"software: x\r\n", "request": get, "metadata": b"fetchTimeMs: 7\r\n",
              "conversion": b"HTTP/1.1 is\r\n\r\na protocol", "resource": b"plain"}
    raw = [_foreign(k, b, b"" if k == "request" else None) for k, b in blocks.items()]
    raw.append(_foreign("response", b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody"))
    raw.append(_foreign("revisit", b"HTTP/1.1 200 OK\r\n\r\n", b"body"))
    (tmp_path / "a.warc").write_bytes(b"".join(raw))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, raw)) + gzip.compress(b""))
    back = warc.read_archives(spark, str(tmp_path))
    rows = back.collect()
    want = blocks | {"response": b"body", "revisit": None}
    assert len(rows) == 14 and all(r.payload == want[r.record_type] for r in rows)
    assert all(r.payload_bytes == len(r.payload) for r in rows if r.payload is not None)
    sha = hashlib.sha1(b"body").hexdigest()
    for where, keep in (("payload_bytes > 0", lambda r: r.payload_bytes), ("payload_bytes = 4", lambda r: r.payload_bytes == 4),
                        ("payload_bytes in (4, 5)", lambda r: r.payload_bytes in (4, 5)),
                        (f"payload_digest = '{sha}'", lambda r: r.payload_digest == sha)):
        n = back.where(where).count()
        assert n == sum(1 for r in rows if keep(r)) and n > 0


def test_warc_broken_records_are_errors(spark, tmp_path):
    whole = _foreign("resource", bytes(range(256)) * 40)
    rows = [{"record_type": "response", "target_uri": "u", "page_id": 1, "refers_to": None, "payload_bytes": 3,
             "payload_digest": hashlib.sha1(b"abc").hexdigest(), "payload": b"abc"}]
    member = warc._member(warc.record_bytes(rows[0]))
    for i, (name, data) in enumerate([
            ("a.warc", whole + whole[:60]), ("a.warc", whole + whole[:900]), ("a.warc.gz", gzip.compress(whole)[:-300]),
            ("a.warc.gz", gzip.compress(whole) + gzip.compress(whole[:60])),
            ("a.warc.gz", gzip.compress(whole) + gzip.compress(whole[:900])), ("a.warc.gz", member + member[:-4])]):
        folder = tmp_path / str(i)
        folder.mkdir()
        (folder / name).write_bytes(data)
        reader = warc.WarcReader({"path": str(folder)})
        with pytest.raises(ValueError):
            for part in reader.partitions():
                list(reader.read(part))


def test_warc_empty_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").where("page_id < 0")
    assert warc.read_archives(spark, warc.write_archives(pages)).count() == 0


# --------------------------------------------------------------------------

def _pii(spark, values, **kw):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string")
    return [r for r in pii.pseudonymise(df, "key", **kw).orderBy("doc_id").collect()]


def test_pii_validates_and_keeps_formats(spark):
    good = {"card": ["4952935900253052", "4111 1111 1111 1111", "378282246310005"], "ssn": ["078-05-1120", "899-99-9999"],
            "phone": ["+1 (017) 555-7713", "212-555-0100"], "ip": ["10.0.0.255", "0.0.0.0"],
            "date": ["2001-12-31", "29/02/2000", "01.01.1900"], "email": ["a.b@mail.example.com"]}
    flat = [(k, v) for k, vs in good.items() for v in vs]
    out = _pii(spark, [f"see {v}, twice: {v}!" for _, v in flat])
    again = _pii(spark, [r.text for r in out], back=True)
    for (kind, value), r, b in zip(flat, out, again):
        assert [f.kind for f in r.found] == [kind, kind]
        new = r.found[0].pseudonym
        assert r.text == f"see {new}, twice: {new}!" and new != value
        if kind != "email":
            assert re.sub("[0-9]+" if kind == "ip" else "[0-9]", "9", new) == re.sub(
                "[0-9]+" if kind == "ip" else "[0-9]", "9", value)
            assert b.text == f"see {value}, twice: {value}!"
    bad = ["4952935900253053", "666-12-1234", "000-12-1234", "123-00-1234", "2001-02-29", "31.11.2020", "256.1.1.1",
           "1.2.3.4.5", "a@b", "id123-45-6789", "12345678901234567890", "2400-01-01", None, "", "@", "🙂 12"]
    for v, r in zip(bad, _pii(spark, bad)):
        assert (r.text, r.n_found) == (v or "", 0)


def test_pii_feistel_is_a_permutation(spark):
    """Every value of a small domain is reached once."""
    a, b = 29, 11
    df = spark.range(a * b).select(
        pii.feistel(F.floor(F.col("id") / b), F.col("id") % b, F.lit(a), F.lit(b), "k", "t").alias("x"))
    got = {(r.x.l, r.x.r) for r in df.collect()}
    assert got == {(i, j) for i in range(a) for j in range(b)}


def test_pii_edges(edge, empty):
    rows = pii.pseudonymise(edge, "key").collect()
    assert len(rows) == edge.count() and all(r.n_found == 0 for r in rows)
    assert sorted(r.text for r in rows) == sorted(r.text or "" for r in edge.collect())
    assert pii.pseudonymise(empty, "key").count() == 0


def test_pii_query_finds_what_a_scan_finds(spark, docs):
    want = {r.doc_id for r in docs.collect() if re.search(r"[\w.]+@mail\d", r.text or "")}
    got = {r.doc_id for r in queries.op3_pii(spark, SF).collect() if "email" in r.kinds.split(",")}
    assert got == want


# --------------------------------------------------------------------------

def brute_runs(text, gram=5, window=8):
    words = [w for w in re.split("[ \t\n\x0b\f\r]+", text) if w]
    if not words:
        return []
    mask = (1 << 64) - 1
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    if len(words) < gram:
        runs = [xxhash.xxh64_intdigest(" ".join(words).encode(), 42)]
    else:
        runs = []
        for i in range(len(words) - gram + 1):
            v = 0
            for x in h[i:i + gram]:
                v = ((v << 1 | v >> 63) & mask) ^ x
            runs.append(v)
    packed = [(x >> 25 << 24) | ((1 << 24) - 1 - i) for i, x in enumerate(runs)]
    if len(packed) < window:
        return packed
    return list(dict.fromkeys(min(packed[i:i + window]) for i in range(len(packed) - window + 1)))


def check_edits(got, rows):
    """``rows`` (id, text) in the order of the operator."""
    def like(a, b):
        a, b = {x >> 24 for x in a}, {x >> 24 for x in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        fp, efp, nfp = brute_runs(text), brute_runs(edited), brute_runs(after)
        r = got[i, text]
        show = lambda v: " ".join(f"{x:X}" for x in v)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (show(fp), show(efp))
        assert abs(r.near_edited - like(fp, efp)) < 1e-12 and abs(r.near_next - like(fp, nfp)) < 1e-12


def test_winnowing_query_matches_brute_force(spark, docs):
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {(r.doc_id, text[r.doc_id]): r for r in queries.op6_winnowing(spark, SF).collect()}
    check_edits(got, sorted(text.items(), reverse=True))


def test_winnowing_few_buckets_and_edges(spark, edge, empty):
    rows = [(i, "a b c d e f g h i j k l m n %d" % (i % 4)) for i in range(30)] + [(40, ""), (41, "one"), (42, "q " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for buckets in (1, 4):
        out = winnow.fingerprint_edits(df, buckets=buckets)
        got = {(r.doc_id, r.text): r for r in out.select(
            "doc_id", "text", F.length("text").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias(
                "edited_sha256"), winnow.as_text("fp").alias("fingerprint"), winnow.as_text("edited_fp").alias(
                "edited_fingerprint"), winnow.likeness("fp", "edited_fp").alias("near_edited"),
            winnow.likeness("fp", "next_fp").alias("near_next")).collect()}
        check_edits(got, sorted(rows, reverse=True))
    out = winnow.fingerprint_edits(edge).collect()
    assert len(out) == edge.count()
    assert all(r.fp == brute_runs(r.text) for r in out if r.text.isascii())
    assert winnow.fingerprint_edits(empty).count() == 0


def test_winnowing_positions_and_guarantee(spark):
    shared = " ".join(f"w{i}" for i in range(12))  # gram + window - 1 words
    df = spark.createDataFrame([(1, "a b c " + shared + " d e"), (2, shared + " x y z")], "doc_id long, text string")
    a, b = [r.s for r in winnow.with_fingerprint(df, "text", "fp").orderBy("doc_id").select(
        winnow.selected("fp").alias("s")).collect()]
    common = {x.hash: x.pos for x in a if x.hash in {y.hash for y in b}}
    assert common and all(common[y.hash] == y.pos + 3 for y in b if y.hash in common)


def test_warc_member_with_several_records(spark, tmp_path):
    """One gzip member over a whole archive, wanted and unwanted records mixed; a payload that holds the bytes
    of a member's head doesn't start a range."""
    def record(i, kind, body):
        return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {len(body)}\r\n\r\n"
                .encode() + body + b"\r\n\r\n")
    bodies = [(i, ["response", "metadata", "resource"][i % 3], bytes([65 + i]) * (i * 40000)) for i in range(7)]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"".join(record(*b) for b in bodies)))
    got = {r.page_id: bytes(r.payload) for r in warc.read_archives(spark, tmp_path.as_uri()).collect()}
    assert got == {i: b for i, _, b in bodies}
    some = warc.read_archives(spark, tmp_path.as_uri()).where("record_type = 'resource'")
    assert {r.page_id: bytes(r.payload) for r in some.collect()} == {i: b for i, k, b in bodies if k == "resource"}


def test_warc_hot_payload(spark):
    """A third of the pages under one payload: one response, the others revisit it."""
    pages = spark.range(1200).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.when(F.col("id") % 3 == 0, F.lit("same " * 400)).otherwise(F.repeat(F.md5(F.col("id").cast("string")), 40)).alias("html"))
    rows = warc.read_archives(spark, warc.write_archives(pages), payload="verify")
    assert rows.count() == 1200 and rows.where("record_type = 'revisit' and refers_to = 1197").count() == 399
