from __future__ import annotations

from conftest import SF_DIR, rows
from test_line_dedup import brute_force as lines_left
from test_ngram_join import groups_of, links_of

import __spark_entry__ as contract
import corpus_pipeline
from tripmart.llm import decontamination, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(name: str):
    return dict(corpus_pipeline.STAGES)[name]


def table(spark, texts: list[tuple]):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_every_query_is_registered():
    names = contract.queries()
    assert "pipeline" in names
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{i}" for i in range(1, 14)]
    assert set(contract.oracle_sql()) <= set(names)


def test_toxicity_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = stage("toxicity")(spark, docs, SF_DIR)
    model = toxicity.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    expected = {r["doc_id"] for r in docs.collect() if model.score(r["text"]) < toxicity.THRESHOLD}
    assert kept.columns == COLUMNS and {r["doc_id"] for r in kept.collect()} == expected


def test_line_stage(spark):
    texts = [(1, "a line that stands twice in the table\nown words of one"), (2, "a line that stands twice in the table"), (3, ""), (4, None)]
    kept = stage("line dedup")(spark, table(spark, texts), SF_DIR)
    expected = lines_left([(i, t or "") for i, t in texts])
    assert kept.columns == COLUMNS
    # the second document lost all it had; those without words at first stay
    assert rows(kept.select("doc_id", "text", "n_chars")) == [(i, t, len(t)) for i, t in expected.items() if i != 2]


def test_join_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id")
    texts = [r["text"] for r in docs.collect()]
    kept = stage("n-gram Jaccard join")(spark, docs, SF_DIR)
    assert kept.columns == COLUMNS
    assert {r["doc_id"] for r in kept.collect()} == set(groups_of(len(texts), links_of(texts)))


def test_decontamination_stage(spark):
    docs, benchmark = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {r["doc_id"] for r in decontamination.contaminations(docs, benchmark).collect()}
    kept = stage("benchmark decontamination")(spark, docs, SF_DIR)
    assert kept.columns == COLUMNS and found
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - found


def test_run(spark):
    found = contract.queries()["pipeline"](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert 0 < found.count() < docs.count()
    assert found.join(docs, "doc_id").count() == found.count()
    for r in found.limit(5).collect():
        assert len(r["ids"]) == 4 * r["n_tokens"]


def test_stages_of_an_empty_table(spark):
    docs = table(spark, [(1, "x")]).limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, SF_DIR).count() == 0
