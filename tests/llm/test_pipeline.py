"""The stages one after the other on the smallest data, and on a hard small table."""

import duckdb
import pytest

import corpus_pipeline
from tests.llm.cases import as_set, documents, texts
from tests.llm.test_near_dedup import brute as groups_of
from tests.llm.test_winnowing import brute as hits_of

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    original = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == original.columns
        docs = spark.createDataFrame(docs.toArrow())
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = [(r["doc_id"], r["text"]) for r in original.collect()]
    with_letter = {i for i, t in rows if t and any(c.isalpha() for c in t)}
    assert set(kept["language"]) <= with_letter and len(kept["language"]) >= 0.99 * len(with_letter)
    rows = sorted(kept["language"].items())
    assert set(kept["near_dedup"]) == {i for i, _, _, keep in groups_of(rows) if keep}
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    rows = sorted(kept["near_dedup"].items())
    assert set(kept["decontamination"]) == {r[0] for r in hits_of(rows, items) if not r[-1]}
    assert set(kept["pseudonyms"]) == set(kept["decontamination"])
    assert {i: len(t) for i, t in kept["pseudonyms"].items()} == {i: len(t) for i, t in kept["decontamination"].items()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    sizes = {r["doc_id"]: r["n"] for r in packed.groupBy("doc_id").sum("n_tokens").withColumnRenamed("sum(n_tokens)", "n").collect()}
    assert sizes == {i: len(t.encode()) for i, t in kept["pseudonyms"].items()}


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and got.groupBy("bucket", "batch", "place").count().filter("count > 1").isEmpty()


@pytest.mark.parametrize("rows", [texts(9), []])
def test_hard_rows(spark, rows):
    docs = documents(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        docs = after
    assert len(as_set(corpus_pipeline.STAGES[-1][1](spark, docs, SF), "doc_id", "piece")) >= (10 if rows else 0)
