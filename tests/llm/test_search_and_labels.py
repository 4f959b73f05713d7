from __future__ import annotations

import math
import random

import numpy as np
from cases import awkward, documents
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from tripmart.llm import licenses, topk_search, toxicity

NAN, INF = float("nan"), float("inf")


def brute_force(vectors: list[tuple], k: int, is_query) -> list[tuple]:
    known = {}
    for i, v in vectors:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            known.setdefault(i, set()).add(tuple(math.floor(256 * x) for x in v))
    out = []
    for q in known:
        if is_query(q):
            scores = {}
            for c in known:
                pairs = [sum(map(int.__mul__, a, b)) for a in known[q] for b in known[c] if c != q and len(a) == len(b)]
                if pairs:
                    scores[c] = max(pairs)
            best = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:k]
            out += [(q, rank, c, s) for rank, (c, s) in enumerate(best, 1)]
    return out


def search(spark, vectors: list[tuple], k: int = 5, **options) -> list[tuple]:
    df = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id bigint, embedding array<float>, rank int")
    return rows(topk_search.top_k(df, F.col("vec_id") % 10 == 0, k, **options))


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(0, 0.3, 6).astype("float32").tolist()) for i in range(300)]
    vectors += [(300 + i, vectors[7][1]) for i in range(40)]
    expected = sorted(brute_force(vectors, 5, lambda i: i % 10 == 0), key=repr)
    assert search(spark, vectors) == expected
    assert search(spark, vectors, block=37) == expected


def test_top_k_of_awkward_vectors(spark):
    vectors = [
        (0, [1.0, 0.5]), (1, None), (2, []), (3, [NAN, 1.0]), (4, [INF, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]),
        (10, [1.0, 2.0, 3.0]), (11, [0.25, 0.25]), (11, [0.25, 0.25]), (12, [0.25, 0.25]), (13, [-1.0, -1.0]), (0, [1.0, 0.5]),
        (20, [0.5, 0.5]), (20, [0.75, 0.5]),
    ]
    assert search(spark, vectors) == sorted(brute_force(vectors, 5, lambda i: i % 10 == 0), key=repr)
    assert search(spark, [(1, [1.0])]) == []
    assert search(spark, [(10, [1.0])]) == []


def plain_scan(text: str) -> tuple:
    """Base columns word by word."""
    found = licenses.words(text)
    places = [
        (at, label)
        for label, phrase in (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))
        for at in range(len(found))
        if [w.decode() for w in found[at : at + len(phrase.split())]] == phrase.split()
    ]
    starts = [at for at, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(found), len(places), min(starts, default=None), max(starts, default=None), labels


def test_license_scan_equals_plain_scan(spark):
    rng = random.Random(1)
    vocabulary = "all rights reserved cc by general public license BY-CC the Ünder x1 _ K".split()
    texts = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(200)] + ["", "CC-BY 4.0; All Rights\nReserved.", "all rights all rights reserved"]
    texts += [r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    found = licenses.scanned(documents(spark, list(enumerate(texts)))).collect()
    base = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert {r["doc_id"]: tuple(r[c] for c in base) for r in found} == {i: plain_scan(t) for i, t in enumerate(texts)}
    assert all(0 <= r["score"] <= 1 and (r["score"] == 1 or not r["n_base"]) for r in found)


def test_license_templates(spark):
    texts = {
        1: "Copyright 2020. Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        2: "Licensed under the Apache License, Version 2.0 (the thing)",
        3: "permission is granted, and a copy is free",
        4: "Redistribution and use in source and binary forms, with or WITHOUT changes, are permitted. All rights reserved",
    }
    found = {r["doc_id"]: (r["labels"], r["base_labels"]) for r in licenses.scanned(documents(spark, list(texts.items()))).collect()}
    assert found == {1: ("mit", ""), 2: ("apache", ""), 3: ("", ""), 4: ("bsd,reserved", "reserved")}


def test_license_awkward_rows(spark):
    docs = awkward(spark)
    found = licenses.scanned(docs)
    assert found.count() == docs.count()
    assert {tuple(r)[1:] for r in found.filter("doc_id in (1, 2, 3)").collect()} == {(0, 0, None, None, "", "", 0.0)}
    assert rows(licenses.scanned(docs.limit(0))) == []


def labelled(spark, n: int = 600):
    rng = random.Random(6)
    filler = [f"plain{i}" for i in range(400)]
    texts, labels = [], []
    for i in range(n):
        own = rng.choices(filler, k=30)
        toxic = i % 6 == 0
        if toxic:
            own[rng.randrange(30)] = rng.choice(["vilehund", "vilekatz", "nastyword"])
        texts.append((i, " ".join(own)))
        labels.append((i, int(toxic), 0))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id bigint, toxic int, text int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels)
    found = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    held = [r for r in found.values() if r["held_out"]]
    assert len(held) > 100 and all(r["predicted"] == (r["doc_id"] % 6 == 0) for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found.values())
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if not r["predicted"]}


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = labelled(spark)
    swapped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [rows(toxicity.scored(docs, toxicity.train(docs, own)).select("doc_id", "score")) for own in (labels, swapped)]
    assert scores[0] == scores[1]


def test_interactions_are_learnt():
    """Neither of two terms alone tells the label, only both together do."""
    rng = np.random.default_rng(2)
    pair = rng.integers(0, 2, (2000, 2))
    labels = (pair.sum(axis=1) == 2).astype(float)
    a, b = (toxicity.word_buckets(w)[0] for w in ("insult", "group"))
    rows_in = [np.array(sorted({b for b, on in ((a, x), (b, y)) if on}), np.int32) for x, y in pair]
    model = toxicity.fit(rows_in, labels, np.ones(len(labels)))
    assert np.abs(model.factors).sum() > 0

    def value(on: list[int]) -> float:
        at = [model.place[i] for i in on]
        own = model.factors[at]
        pairs = 0.5 * (own.sum(axis=0) ** 2 - (own**2).sum(axis=0)).sum() / max(1, len(at))
        return model.bias + model.weights[at].sum() + pairs

    assert value([a, b]) > 0 > max(value([a]), value([b]), value([]))


def test_toxicity_of_awkward_rows(spark):
    docs, labels = labelled(spark)
    model, odd = toxicity.train(docs, labels), awkward(spark)
    found = toxicity.scored(odd, model)
    assert found.count() == odd.count() and found.filter("score is null or held_out is null").count() == 0
    assert rows(toxicity.scored(odd.limit(0), model)) == []
    nobody = toxicity.train(docs, labels.limit(0))
    assert toxicity.scored(odd, nobody).filter("predicted = 1").count() == 0
    strange = spark.createDataFrame([(None, 1), (1, None), (2, 7), (3, 1), (3, 1), (10**9, 1)], "doc_id bigint, toxic int")
    assert toxicity.scored(docs, toxicity.train(docs, strange)).count() == docs.count()


def test_pairs_are_learnt_whose_terms_tell_nothing_by_themselves():
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(4, 10))) for _ in range(400)]
    texts, labels = [], []
    for n in range(4000):
        # each of the two words stands in half of the texts of either label
        both = rng.integers(2)
        pair = [w for w, there in (("wretched", both), ("strangers", both if n % 2 else 1 - both)) if there]
        texts.append(" ".join([*rng.choice(words, 20), *pair]))
        labels.append(float(n % 2))
    of_word = toxicity.Memo(toxicity.word_buckets)
    learnt = toxicity.fit([toxicity.buckets(t, of_word) for t in texts[:3000]], np.array(labels[:3000]), np.ones(3000))
    right = [(learnt.score(t) >= 0.5) == bool(y) for t, y in zip(texts[3000:], labels[3000:], strict=True)]
    assert np.mean(right) >= 0.97
    alone = toxicity.Model(learnt.bias, learnt.weights, 0 * learnt.factors)
    assert np.mean([(alone.score(t) >= 0.5) == bool(y) for t, y in zip(texts[3000:], labels[3000:], strict=True)]) < 0.7


def test_top_k_counts_an_id_of_many_vectors_once(spark):
    rng = np.random.default_rng(8)
    vectors = [(i, [float(x) for x in rng.normal(0, 1, 6)]) for i in range(40)]
    # ids of up to ten vectors, near the queries, so that the best rows are of few ids
    vectors += [(i, [float(x) for x in np.array(vectors[(i % 3) * 10][1]) * (1 + n / 50)]) for i in (7, 8, 9, 21, 30) for n in range(10)]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in vectors]
    expected = []
    for query in range(0, 40, 10):
        best = {}
        for i, v in whole:
            for j, own in whole:
                if j == query and i != query:
                    score = sum(a * b for a, b in zip(v, own, strict=True))
                    best[i] = max(best.get(i, score), score)
        ranked = sorted(best.items(), key=lambda item: (-item[1], item[0]))[:5]
        expected += [(query, at + 1, i, score) for at, (i, score) in enumerate(ranked)]
    assert rows(topk_search.top_k(df, F.col("vec_id") % 10 == 0, 5)) == sorted(expected, key=repr)


def test_lists_are_not_read_to_their_end():
    rng = np.random.default_rng(2)
    middles = rng.normal(0, 1, (20, 32))
    vectors = np.floor(256 * (middles[np.arange(4000) % 20] + rng.normal(0, 0.2, (4000, 32))))
    read: list[int] = []
    found = topk_search.best_of_block(np.arange(4000), vectors, np.arange(-20, 0), np.floor(256 * middles), 5, read)
    scores = np.floor(256 * middles) @ vectors.T
    for at in range(20):
        own = found[found["query_id"] == at - 20]
        assert own["vec_id"].tolist() == np.lexsort((np.arange(4000), -scores[at]))[:5].tolist()
    assert len(read) == 20 and sum(read) < 0.75 * 20 * vectors.size
