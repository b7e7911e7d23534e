"""Quality, decontamination, mixing, materialisation and the pipeline."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plaudit.llm import decontam, materialise, mixing, quality, queries

SF, SF_MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


def test_quality_on_held_out_labels(spark):
    got = queries.op7_quality(spark, SF_MORE).toPandas()
    labels = spark.read.parquet(f"{SF_MORE}/labels.parquet").toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    both = got.merge(labels, on="doc_id")
    both = both[both.held_out]
    assert (both.predicted == both.quality).mean() > 0.97
    assert both[both.quality == 1].predicted.mean() > 0.98


def test_quality_edges(spark, docs, labels, edge, empty):
    model = quality.fit(docs, labels)
    rows = quality.score_documents(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    assert quality.score_documents(empty, model).count() == 0
    kept = quality.keep_good(edge, model)
    assert kept.columns == edge.columns
    none = quality.fit(docs, labels.where("quality < 0"))
    assert quality.score_documents(edge, none).select("score").distinct().collect()[0].score == 0.5
    one = quality.fit(docs, labels.where("quality = 1"))
    assert quality.score_documents(edge, one).first().score > 0.9
    assert quality.fit(empty, labels).good == b""
    # held-out rows never teach, rows labelled both ways neither
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit(docs, flipped) == model
    assert quality.fit(docs, labels.unionByName(labels)) == model


def test_quality_learns_from_the_documents_that_are_there(spark, docs, labels):
    """Labels without a document neither fill the bound nor move the prior."""
    ghosts = spark.range(10**6, 10**6 + 3000).select(F.col("id").alias("doc_id"), F.lit(0).alias("quality"), F.lit(0).alias("toxic"))
    bounds = quality.SampleBounds(per_class=40)
    assert quality.fit(docs, labels.unionByName(ghosts), bounds=bounds) == quality.fit(docs, labels, bounds=bounds)


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_overlap(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = _words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[i:i + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hits, found = _words(text), set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in wins:
                    hits |= set(range(i, i + k))
                    found |= wins[tuple(w[i:i + k])]
        out.append((doc, len(w), sorted(hits), sorted(str(x) for x in found if x is not None)))
    return out


@pytest.mark.parametrize("block_bytes", [8 << 20, 600])
def test_decontamination_edges(spark, edge, empty, block_bytes):
    """Short, empty, null, repeated and unnamed items; one block or many."""
    items = [(1, "one two three four five six seven eight nine ten"), (2, "No ID-here"), (3, ""), (4, None), (10, "WORD"),
             (10, "twelve one two"), (None, "another text under"), (6, " ".join(["lorem ipsum dolor sit amet"] * 3))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("win", F.lit(1))
    got = sorted(((r.doc_id or -1, r.n_words, r.hits, r["items"]) for r in decontam.overlaps(
        edge, bench, block_bytes=block_bytes).collect()))
    want = sorted((d or -1, n, h, i) for d, n, h, i in brute_overlap(
        [(r.doc_id, r.text) for r in edge.collect()], items))
    assert got == want
    clean = decontam.decontaminate(edge, bench)
    assert clean.columns == edge.columns
    assert clean.count() == sum(1 for x in want if not x[2])
    assert decontam.overlaps(empty, bench).count() == 0
    nothing = decontam.overlaps(edge, bench.where("item_id < 0")).collect()
    assert len(nothing) == edge.count() and not any(r.hits for r in nothing)


def test_decontamination_query(spark, docs, benchmark):
    want = brute_overlap([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in benchmark.collect()])
    got = {r.doc_id: r for r in queries.op5_decontamination(spark, SF).collect()}
    assert any(h for _, _, h, _ in want)
    for doc, n, hits, items in want:
        r = got[doc]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, len(hits), len(items), bool(hits))


def nnls(a, b):
    """Lawson and Hanson's active set method."""
    x, on = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    while (w := np.where(on, -np.inf, a.T @ (b - a @ x))).max() > 1e-9 * np.abs(a.T @ b).max():
        on[w.argmax()] = True
        while True:
            z = np.zeros_like(x)
            z[on] = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if z[on].min() > 0:
                break
            down = on & (z <= 0)
            x += (x[down] / (x[down] - z[down])).min() * (z - x)
            on &= x > 1e-12
        x = z
    return x


def test_rates_against_nnls(spark):
    """Within reach, with clipping, out of reach, a domain without mass: the
    objective is that of the nonnegative optimum."""
    rng = np.random.default_rng(2)
    p = rng.dirichlet([3, 1, 1], 400)
    p[:, 2] = np.where(np.arange(400) < 300, p[:, 2], 0)
    p /= p.sum(1, keepdims=True)
    tokens = rng.integers(1, 500, 400)
    tight = np.clip(p, 0.1, None) / np.clip(p, 0.1, None).sum(1, keepdims=True)
    none = p * [1, 1, 0] / (p * [1, 1, 0]).sum(1, keepdims=True)
    for q, weights, met in ((p, {"clean": .6, "low": .2, "toxic": .2}, True),
                            (p, {"clean": .9, "low": .08, "toxic": .02}, True),
                            (tight, {"clean": .97, "low": .01, "toxic": .02}, False),
                            (none, {"clean": .8, "low": .1, "toxic": .1}, False)):
        df = spark.createDataFrame([(int(t), [float(x) for x in y]) for t, y in zip(tokens, q)],
                                   "tokens long, p array<double>").coalesce(1)
        got = mixing.fit_rates(df, weights)
        rate = np.array([r.r for r in df.select(mixing.rate_column(got.steps).alias("r")).collect()])
        a = (q * tokens[:, None]).T
        assert rate.min() >= 0 and np.allclose(got.now, a @ rate)
        assert got.settled and (not got.unmet) == met
        on = a.sum(1) > 0
        half = np.linalg.cholesky(np.linalg.inv(a[on] @ q[:, on])).T
        best = nnls(half @ a[on], half @ got.target[on])
        assert np.abs(a @ best - a @ rate)[on].max() <= 2e-4 * tokens.sum()


def test_mixing_query_and_edges(spark, docs, labels, edge, empty):
    out = queries.op9_mixing(spark, SF).toPandas()
    assert len(out) == docs.count() and (out.rate >= 0).all()
    p = out[["p_clean", "p_low", "p_toxic"]].to_numpy()
    assert np.allclose(p.sum(1), 1)
    mass = (p * (out.tokens * out.rate).to_numpy()[:, None]).sum(0)
    assert np.allclose(mass / mass.sum(), [0.80, 0.15, 0.05], atol=2e-3)
    assert ((out.copies == np.floor(out.rate)) | (out.copies == np.floor(out.rate) + 1)).all()
    weights = {"clean": 1.0, "low": 0.0, "toxic": 0.0}
    mixed = mixing.mixed_documents(edge, labels, weights, keep="clean")
    assert mixed.columns == edge.columns
    assert mixing.mix(edge, labels, weights).count() == edge.count()
    assert mixing.mixed_documents(empty, labels, weights).count() == 0
    assert mixing.mix(empty, labels.limit(0), weights).count() == 0


def test_mixing_accuracy_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_MORE}/{t}.parquet") for t in ("documents", "labels"))
    model = mixing.fit_domains(docs, labels)
    got = (model.apply(docs).select("_row.doc_id", "p").join(labels, "doc_id").where(quality.held_out())
           .withColumn("y", mixing.domain_of())).toPandas()
    best = np.stack(got.p).argmax(1)
    assert (best == got.y).mean() > 0.9


def test_domains_learn_from_the_documents_that_are_there(spark):
    """Most labels of one domain have no document left: the bound is filled from
    those that have one, and the priors are the shares of the documents."""
    labels = spark.range(1000).select(F.col("id").alias("doc_id"), F.expr("if(id < 500, 1, 0)").alias("quality"),
                                      F.lit(0).alias("toxic"))
    here = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 != 2]
    clean, low = [i for i in here if i < 500], [i for i in here if i >= 500][:20]
    alone = spark.createDataFrame([(i, str(i)) for i in clean + low], "doc_id long, text string")
    n = len(clean) + len(low)  # no frequent word: the posteriors are the priors
    assert np.allclose(mixing.fit_domains(alone, labels).constant, [len(clean) / n, len(low) / n, 0])
    told = spark.createDataFrame([(i, f"{'fine' if i < 500 else 'poor'} words {i}") for i in clean + low]
                                 + [(low[-1] + 1, "poor " * 9000)], "doc_id long, text string")
    model = mixing.fit_domains(told, labels, per_domain=10)
    p = {r.doc_id: r.p for r in model.apply(told).select("_row.doc_id", "p").collect()}
    assert all(p[i][0] > 0.9 for i in clean) and all(p[i][1] > 0.9 for i in low)


def test_permutation():
    for n in (1, 2, 3, 17, 256, 4097):
        perm = materialise.Permutation(n, b"key")
        x = np.arange(n)
        y = perm.slots(x)
        assert sorted(y) == list(range(n)) and (perm.sequences(y) == x).all()
    assert (materialise.Permutation(4097, b"a").slots(x) != materialise.Permutation(4097, b"b").slots(x)).any()


def slow_slot(seq, n, key, rounds=8):
    """The keyed permutation in plain integers: Feistel rounds, walked into 0 .. n-1."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    keys = [int.from_bytes(hashlib.sha256(key + bytes([i])).digest()[:8], "little") for i in range(rounds)]
    low, full = (1 << half) - 1, (1 << 64) - 1
    while True:
        a, b = seq >> half, seq & low
        for k in keys:
            x = b ^ k
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & full
            x = (x ^ x >> 27) * 0x94D049BB133111EB & full
            a, b = b, a ^ ((x ^ x >> 31) & low)
        seq = a << half | b
        if seq < n:
            return seq


def test_long_white_space_encodes_like_the_whole_text():
    body = open(materialise.VOCABULARY, "rb").read()
    enc, ranks = materialise.encoding(body), materialise.token_ranks(body)
    for text in (" " * 60000 + "x", "a" + " \n" * 30000, "\n" * 40000 + "a b", "k" + "\t" * 25000 + " ", "a" + " " * 30001 + "b"):
        assert materialise.encode(enc, ranks, text) == enc.encode_ordinary(text)


def test_many_empty_documents_and_many_without_an_id(spark):
    import time
    t0 = time.time()
    m = materialise.materialise(spark.range(200000).select(F.col("id").alias("doc_id"), F.lit("").alias("text")), buckets=2)
    assert m.agg(F.sum("n_tokens")).first()[0] == 200000 and time.time() - t0 < 60
    rows = spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"), F.md5(F.col("id").cast("string")).alias("text"))
    chunks = materialise.stream_chunks(rows, buckets=16)
    assert chunks.select("bucket").distinct().count() == 16 and chunks.agg(F.sum(F.size("sizes"))).first()[0] == 5000


def test_materialise_round_trip(spark, edge):
    """The shards hold the documents' tokens in id order, whatever the layout."""
    layout = materialise.Layout(length=64, per_shard=10)
    edge = edge.unionByName(edge.where("doc_id = 5").withColumns(
        {"doc_id": F.lit(90).cast("long"), "text": F.expr("concat(repeat(' ', 2000000), 'end', repeat('\\n', 2000000))")}))
    enc = materialise.encoding(open(materialise.VOCABULARY, "rb").read())
    digests = []
    for buckets, parts in ((1, 1), (5, 3)):
        m = materialise.materialise(edge.repartition(parts), layout=layout, buckets=buckets).toPandas().sort_values("sequence")
        assert sorted(m.slot) == list(range(len(m)))
        assert [slow_slot(s, len(m), layout.key) for s in m.sequence] == list(m.slot)
        assert (m.byte_offset == m.slot % 10 * 128).all() and (m.shard == m.slot // 10).all()
        tokens = {r.slot: r.tokens for r in materialise.read_slots(spark, m.folder.iloc[0], 0, len(m), layout).collect()}
        stream = [t for s in m.slot for t in tokens[s]]
        n = int(m.n_tokens.sum())
        assert set(stream[n:]) <= {materialise.END_OF_TEXT} and len(stream) - n < 64
        got, now = [], []
        for t in stream[:n]:
            if t == materialise.END_OF_TEXT:
                got.append(enc.decode(now))
                now = []
            else:
                now.append(t)
        rows = [(r.doc_id if r.doc_id is not None else -1, r.text or "") for r in edge.collect()]
        assert sorted(got) == sorted(t for _, t in rows)
        at = [got.index(t) for _, t in sorted(rows) if rows.count((_, t)) == 1 and got.count(t) == 1]
        assert at == sorted(at)
        digests.append(list(m.sha256))
        tail = materialise.read_slots(spark, m.folder.iloc[0], 5, 9, layout).collect()  # a resumed read
        assert {r.slot: r.tokens for r in tail} == {s: tokens[s] for s in range(5, 9)}
    assert digests[0] == digests[1]


def test_materialise_empty(empty):
    assert materialise.materialise(empty).count() == 0
