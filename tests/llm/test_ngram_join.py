from __future__ import annotations

import random

from cases import awkward, documents
from conftest import SF_DIR, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmart.llm import ngram_join
from tripmart.llm.components import connected_components


def links_of(texts: list[str]) -> set[tuple[int, int]]:
    """All linked pairs by comparing each text with each other."""
    sets = []
    for text in texts:
        words = text.lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))})
    found = set()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            common = len(a & b)
            if a and common >= ngram_join.THRESHOLD * (len(a) + len(b) - common):
                found.add((j, i))
    return found


def groups_of(n: int, links: set[tuple[int, int]]) -> list[int]:
    root = list(range(n))
    for _ in range(n):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def near_copies(seed: int, groups: int, copies: int) -> list[str]:
    rng = random.Random(seed)
    texts = []
    for group in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(120)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(own))
    return texts


def check(spark, texts: list[str], **options) -> None:
    found = ngram_join.similar_documents(documents(spark, list(enumerate(texts))), **options)
    links = links_of(texts)
    degree = [sum(i in pair for pair in links) for i in range(len(texts))]
    expected = groups_of(len(texts), links)
    got = {r["doc_id"]: (r["n_links"], r["group_id"]) for r in found.collect()}
    assert got == {i: (degree[i], expected[i]) for i in range(len(texts))}


def test_equals_brute_force(spark):
    check(spark, near_copies(1, 8, 7) + ["a b c", "A  b c", "a b c d", "", "unlike all the others here"])


def test_blocks_of_a_large_node(spark):
    check(spark, near_copies(2, 2, 30), block=8)


def test_table_equals_brute_force(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()]
    check(spark, texts)


def test_copies_are_counted_and_not_expanded(spark):
    text = "one text that stands in the table a great many times over"
    found = ngram_join.similar_documents(documents(spark, [(i, text) for i in range(300)] + [(300, f"{text} ")]))
    got = {tuple(r) for r in found.select("class_id", "group_id", "n_links").collect()}
    assert got == {(0, 0, 300), (300, 0, 300)}


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = ngram_join.similar_documents(docs)
    assert found.count() == docs.count()
    kept = ngram_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    # the repeated row goes; those without words all stay
    assert kept.count() == docs.count() - 1
    assert rows(ngram_join.similar_documents(docs.limit(0))) == []
    assert rows(ngram_join.one_of_each_group(docs.limit(0))) == []


def test_one_of_each_group_stays(spark):
    texts = near_copies(3, 6, 5)
    kept = {r["doc_id"] for r in ngram_join.one_of_each_group(documents(spark, list(enumerate(texts)))).collect()}
    assert kept == set(groups_of(len(texts), links_of(texts)))


def test_depth_follows_the_target():
    depths = [ngram_join.prefix_depth(target=t) for t in (0.5, 0.9, 0.995, 0.9999)]
    assert depths == sorted(depths, reverse=True)
    assert ngram_join.expected_recall(ngram_join.prefix_depth()) >= ngram_join.TARGET_RECALL


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=25))
def test_components(spark, edges):
    df = spark.createDataFrame([*edges, (None, 1)], "a bigint, b bigint")
    root = groups_of(26, {e for e in edges if e[0] != e[1]})
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert {tuple(r) for r in connected_components(df, "a", "b").collect()} == {(x, root[x]) for x in touched}


def test_components_of_a_path(spark):
    path = spark.range(1, 300).selectExpr("id as a", "id - 1 as b")
    found = connected_components(path, "a", "b").collect()
    assert len(found) == 300 and {r["root"] for r in found} == {0}
