"""The pipeline's stages, each on what the one before kept, and its whole run."""

import pytest

import corpus_pipeline
from stratamart.llm import packing, personal_data, quality_rules, simhash
from stratamart.llm.common import written
from stratamart.llm.queries import QUERIES


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [("documents", documents)]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, written(stage(spark, out[-1][1], sf_dir), name)))
    return out


def test_stages_keep_the_columns(stages):
    documents = stages[0][1]
    assert [name for name, _ in stages[1:]] == ["quality_rules", "line_dedup", "near_duplicates", "personal_data", "packing"]
    assert all(df.columns == documents.columns for _, df in stages[:-1])


def test_each_stage_does_its_work(spark, stages, sf_dir):
    rows = {name: {r.doc_id: r for r in df.collect()} for name, df in stages[:-1]}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    gone = set(rows["documents"]) - set(rows["quality_rules"])
    assert gone and sum(labels.get(i) == 1 for i in gone) <= 0.2 * len(gone)
    assert rows["quality_rules"].keys() == rows["line_dedup"].keys()
    one_each = {simhash.fingerprint(r.text.encode()) for r in rows["near_duplicates"].values()}
    assert len(one_each) == len(rows["near_duplicates"])
    assert all(not personal_data.base_spans(r.text) for r in rows["personal_data"].values())
    assert all(r.n_chars == len(r.text) for r in rows["personal_data"].values())
    assert {r.doc_id for r in stages[-1][1].collect()} == set(rows["personal_data"])


def test_run_equals_its_stages(spark, stages, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, found.select(key).collect())) == sorted(map(tuple, stages[-1][1].select(key).collect()))
    assert found.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").count() == 0


def test_every_query_is_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert set(QUERIES) | {"pipeline"} <= names and sum(n.startswith("op") and n[2].isdigit() for n in names) >= 10
    assert packing.SIZE == 2048 and quality_rules.MIN_WORDS >= 10
