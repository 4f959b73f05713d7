"""Queries that apply each operator to its whole table, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import (
    byte_bpe,
    centroids,
    decontamination,
    fill_in_middle,
    html_text,
    licenses,
    line_dedup,
    ngram_join,
    packed_ids,
    token_counts,
    topk_search,
    toxicity,
    vector_graph,
)
from tripmart.session import scratch_dir

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
BYTE_JSON = "byte_bpe_50k.json"
WORD_JSON = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicated(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "text",
        F.length("text").cast("bigint").alias("n_chars"),
        F.col("__lines").cast("bigint").alias("n_lines"),
        F.col("__dropped").cast("bigint").alias("n_dropped"),
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(_table(spark, sf_dir, "pages"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return byte_bpe.with_tokens(docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)


def op4_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    path = scratch_dir(spark, "shards")
    return packed_ids.round_trip(docs, path, public_tokenizers.path(WORD_JSON)).drop("ids")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path(BYTE_JSON), public_tokenizers.PATTERN)


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.similar_documents(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "group_id", "n_copies", "n_linked_texts", "n_links")


def op11_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents")))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(_table(spark, sf_dir, "embeddings")).drop("centroid")


QUERIES = [
    op1_line_dedup,
    op2_html_text,
    op3_byte_bpe,
    op4_packed_ids,
    op5_decontamination,
    op6_token_counts,
    op7_topk_search,
    op8_license_scan,
    op9_toxicity,
    op10_ngram_join,
    op11_vector_graph,
    op12_fill_in_middle,
    op13_centroids,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}


ORACLES = {
    "op7_topk_search": """
        with v as (
            select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where vec_id is not null and embedding is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0
        ), scored as (
            select q.vec_id as query_id, c.vec_id, max(list_inner_product(q.v, c.v))::bigint as score
            from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
            where q.vec_id % 50 = 0
            group by 1, 2
        ), ranked as (
            select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
            from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
    "op10_ngram_join": """
        with recursive classes as (
            select coalesce(text, '') as text, min(doc_id) as class_id, count(*) as n_copies, row_number() over () as n
            from documents group by 1
        ), split as (
            select n, list_filter(string_split_regex(lower(text), '[ \\t\\n\\r\\f\\v\\x1c-\\x1f]+'), lambda w: w <> '') as words from classes
        ), shingles as (
            select distinct n, unnest(list_transform(
                range(1, greatest(len(words) - 3, least(len(words), 1) + 1)), lambda i: array_to_string(words[i:i + 4], ' ')
            )) as shingle
            from split
        ), sizes as (select n, count(*) as size from shingles group by 1
        ), common as (
            select a.n as a, b.n as b, count(*) as common from shingles a join shingles b using (shingle) where a.n <> b.n group by 1, 2
        ), links as (
            select a, b from common join sizes x on x.n = a join sizes y on y.n = b
            where common >= 0.8 * (x.size + y.size - common) - 1e-9
        ), reach as (
            select n as a, n as b from classes union select reach.a, links.b from reach join links on links.a = reach.b
        ), groups as (select a as n, min(class_id) as group_id from reach join classes on classes.n = b group by 1
        ), degrees as (select a as n, count(*) as texts, sum(n_copies) as copies from links join classes on classes.n = b group by 1)
        select doc_id, class_id, group_id, n_copies, coalesce(texts, 0)::bigint as n_linked_texts,
               (n_copies - 1 + coalesce(copies, 0))::bigint as n_links
        from documents join classes on coalesce(documents.text, '') = classes.text
        join groups using (n) left join degrees using (n)
    """,
}
