"""The corpus pipeline: each stage next to a plain implementation on its own input."""

import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_text_operators import plain_components, plain_hits, plain_print
from tradelake.llm import mixing, pii, toxicity
from tradelake.llm.common import read, stored
from tradelake.llm.queries import PII_KEY, domain_weights, labelled_domains


@pytest.fixture(scope="module")
def stages(spark):
    docs = read(spark, SF_SMALL, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF_SMALL), name))
    return out


def test_columns(stages):
    assert all(x.columns == stages[0].columns for x in stages[1:-1])
    assert stages[-1].columns == [*stages[0].columns, "tokens", "domain", "rate", "copies"]


def test_toxic_rejected(spark, stages):
    model = toxicity.fit(stages[0], read(spark, SF_SMALL, "labels"))
    want = {r.doc_id for r in toxicity.score(stages[0], model).where("score < 0.5").collect()}
    assert {r.doc_id for r in stages[1].collect()} == want and 0 < len(want) < stages[0].count()


def test_one_of_each_group(stages):
    rows = stages[1].collect()
    roots = plain_components([plain_print(r.text) for r in rows])
    want = sorted(min(r.doc_id for r, x in zip(rows, roots, strict=True) if x == root) for root in set(roots))
    assert sorted(r.doc_id for r in stages[2].collect()) == want and len(want) < len(rows)


def test_contaminated_rejected(spark, stages):
    items = [tuple(r) for r in read(spark, SF_SMALL, "benchmark").collect()]
    want = []
    for r in stages[2].collect():
        words, hit, _ = plain_hits(r.text, items)
        if not (hit and 20 * hit >= words):
            want.append(r.doc_id)
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(want)


def test_personal_hidden(spark, stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    after = {r.doc_id: r for r in stages[4].collect()}
    want = {r.doc_id: r.text for r in pii.pseudonymise(stages[3], PII_KEY).collect()}
    assert {i: r.text for i, r in after.items()} == want and before.keys() == after.keys()
    assert any(before[i].text != after[i].text for i in before)
    assert all(r.n_chars == len(r.text) for i, r in after.items() if before[i].n_chars == len(before[i].text))


def test_mixed(spark, stages):
    model = mixing.fit_classifier(labelled_domains(spark, stages[4], SF_SMALL), domain_col="domain")
    all_rows = mixing.mix(stages[4], model, domain_weights(model))
    assert all_rows.count() == stages[4].count()
    got = {r.doc_id: r for r in stages[5].collect()}
    want = {r.doc_id: r for r in all_rows.where("copies > 0").collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[i].rate, want[i].rate) and got[i].copies == want[i].copies for i in got)


def test_run_is_the_stages(spark, stages):
    rows = lambda df: sorted((r.doc_id, r.text, r.copies) for r in df.collect())
    assert rows(corpus_pipeline.run(spark, SF_SMALL)) == rows(stages[-1])


def test_odd_documents(spark, tmp_path):
    docs = read(spark, SF_SMALL, "documents")
    odd = [(None, None, None, None, None), (None, "x", None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a " * 50_000, "en", None, 7)]
    rows = spark.createDataFrame(odd, docs.schema)
    extra = rows.select("*", F.lit(1).alias("score"), F.lit("x").alias("domain"), F.lit(2).alias("row"), F.lit(3).alias("_row"))
    for table in (rows, extra, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, SF_SMALL)
            assert out.columns == table.columns, name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, table, SF_SMALL).collect()
    folder = str(tmp_path)
    for name in ("documents", "labels", "benchmark"):
        read(spark, SF_SMALL, name).limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
