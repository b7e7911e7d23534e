"""Periodic runs against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plaudit.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def brute_runs(words, least=6, power=4):
    """Every maximal stretch of each period, those kept whose smallest period it is."""
    n, out = len(words), {}
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, power * q):
                out.setdefault((i, j + q - i), q)  # smallest period first
            i = j
    return sorted((s, n, q) for (s, n), q in out.items())


def scan(texts):
    return [[(r["start"], r["length"], r["period"]) for r in x["runs"]] for x in
            periodic._scan([t.encode() for t in texts], None, 6, 4, False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=7), st.integers(1, 9)), max_size=6))
def test_runs_of_nested_periods(parts):
    words = [w for p, n in parts for w in p * n]
    assert scan([" ".join(words), "x", " ".join(words[::-1])])[::2] == [brute_runs(words), brute_runs(words[::-1])]


def test_runs_of_random_words():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(list("ab"), 400)) for _ in range(20)]
    texts += [" ".join(str(x) for x in np.tile(rng.integers(0, 5, q), 9)[3:-2]) for q in (1, 2, 3, 16, 17, 31, 32, 33, 64, 100)]
    assert scan(texts) == [brute_runs(t.split()) for t in texts]


def test_hot_word_in_a_long_text():
    """A million equal words, and a word in every second place: no square of the count."""
    assert scan(["a " * 1_000_000]) == [[(0, 1_000_000, 1)]]
    rng = np.random.default_rng(2)
    other = rng.integers(0, 50_000, 300_000)
    assert scan([" ".join(f"the {x}" for x in other)]) == [[]]


def expect(doc, text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    h = zlib.crc32(str(doc).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_matches_brute_force(spark, docs):
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op13_periodic_runs(spark, SF).collect()}
    want = {r.doc_id: expect(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 40_000}
    assert sum(x[0] > 0 for x in want.values()) > 10
    assert {d: got[d] for d in want} == want and len(got) == docs.count()


def test_edges(spark, edge, empty):
    rows = periodic.periodic_runs(edge, collapsed=True).collect()
    assert len(rows) == edge.count()
    by = {r.doc_id: r for r in rows}
    assert by[2].n_words == by[3].n_words == by[4].n_words == 0 and by[2].runs == [] and by[3].collapsed == ""
    assert [tuple(x) for x in by[6].runs] == [(0, 20000, 5)] and by[6].collapsed == "lorem ipsum dolor sit amet"
    assert [tuple(x) for x in by[11].runs] == [(0, 60, 3)]
    assert periodic.periodic_runs(empty).count() == 0
    assert periodic.periodic_runs(empty).select(periodic.longest()).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(edge, power=3)
    planted = periodic.periodic_runs(edge, planted=F.lit(10)).where("doc_id = 10").first()
    assert planted.n_words == 60  # the no-break space is a word
