"""Each stage of the pipeline against a brute-force version on its own input."""

import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from plaudit.llm import common, materialise, mixing, quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """{name: (input, output)}, both written."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in C.STAGES:
        after = common.cut(stage(spark, docs, SF), name)
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_columns_and_order(stages):
    assert list(stages) == ["quality_filter", "near_dedup", "decontaminate", "mix", "training_order"]
    for name, (before, after) in stages.items():
        assert name == "training_order" or after.columns == before.columns


def test_quality_filter(spark, stages):
    before, after = stages["quality_filter"]
    model = quality.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    docs = rows(before)
    score = model.score([(t or "").encode() for _, t in docs])
    assert rows(after) == [d for d, s in zip(docs, score) if s >= 0.7]


def test_near_dedup(stages):
    from test_dedup import brute_groups, brute_simhash
    docs = rows(stages["near_dedup"][0])
    label = brute_groups([brute_simhash(t) for _, t in docs], 3)
    assert rows(stages["near_dedup"][1]) == [d for i, d in enumerate(docs) if label[i] == i]


def test_decontaminate(spark, stages):
    from test_models_and_order import brute_overlap
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = rows(stages["decontaminate"][0])
    dirty = {d for d, _, hits, _ in brute_overlap(docs, bench) if hits}
    assert rows(stages["decontaminate"][1]) == [d for d in docs if d[0] not in dirty]


def test_mix(spark, stages):
    """Copies are the whole part of the rate or one more; the rates are those of the steps in numpy; expected
    tokens meet the targets."""
    before, after = stages["mix"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = mixing.fit_domains(before, labels)
    members = common.cut(model.apply(before).select("_row.doc_id", "tokens", "p"), "members")
    fit = mixing.fit_rates(members, C.MIX_WEIGHTS, keep="clean", surplus=C.MIX_SURPLUS)
    copies = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    got = members.toPandas()
    p, rate = np.stack(got.p), np.ones(len(got))
    for s in fit.steps:
        rate = np.maximum(0, rate + p @ s)
    n = got.doc_id.map(copies).fillna(0).to_numpy()
    assert (np.abs(n - rate) < 1 + 1e-6).all() and (n >= np.floor(rate - 1e-9)).all()
    assert np.allclose((p * (got.tokens * rate).to_numpy()[:, None]).sum(0), fit.now)
    share = np.array([C.MIX_WEIGHTS[d] for d in mixing.DOMAINS])
    assert np.allclose(fit.target / fit.target.sum(), share)


def test_training_order(stages):
    before, after = stages["training_order"]
    layout = materialise.Layout()
    enc = materialise.encoding(open(materialise.VOCABULARY, "rb").read())
    want = sum(len(enc.encode_ordinary(t or "")) + 1 for _, t in rows(before))
    out = after.toPandas()
    assert out.n_tokens.sum() == want and sorted(out.sequence) == list(range(-(-want // layout.length)))
    assert {i for ids in out.doc_ids for i in ids} == {d for d, _ in rows(before)}


def test_run_leaves_only_its_results(spark, stages):
    from plaudit.session import checkpoint_root
    folder = Path(re.sub("^file:(//)?", "", checkpoint_root(spark)))
    before = {p.name for p in folder.glob("llm-*")}
    manifest = C.run(spark, SF)
    assert rows_of(manifest) == rows_of(stages["training_order"][1])
    new = {p.name.split("-")[1] for p in folder.glob("llm-*") if p.name not in before}
    assert new == {"shards", "manifest"}


def rows_of(manifest):
    return sorted((r.slot, r.n_tokens, r.sha256) for r in manifest.collect())


def test_stages_on_edge_tables(spark, edge, empty):
    for name, stage in C.STAGES[:-1]:
        assert stage(spark, edge, SF).columns == edge.columns
        assert stage(spark, empty, SF).count() == 0
    long = edge.where("doc_id = 5").withColumn("text", F.expr("concat(repeat(' ', 2000000), 'end', repeat('\\n', 2000000))"))
    assert C.STAGES[-1][1](spark, edge.unionByName(long), SF).count() > 0
