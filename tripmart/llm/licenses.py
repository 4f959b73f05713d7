"""Licence phrases in documents, by a positional index of rare words."""

from __future__ import annotations

import math
import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import whole_text

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Phrases and labels of the base scan.
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
#: label: (template, mandatory key phrase).
TEMPLATES = {
    "apache": ("licensed under the apache license version 2 0", "apache license"),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted",
        "source and binary forms",
    ),
    "cc0": ("to the extent possible under law the author has waived all copyright and related rights", "waived all copyright"),
    "mit": ("permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted"),
    "mpl": ("subject to the terms of the mozilla public license", "mozilla public license"),
}
ANCHORS = 3
MIN_SHARE = 0.7


def words(text: str) -> list[bytes]:
    """Words of a text with A to Z, and no other letters, in lower case."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower())


class Index:
    """Postings of template words, by the rarity that the corpus gives them."""

    def __init__(self, documents: int, frequency: dict[bytes, int]):
        texts = {label: phrase for label, phrase in BASE.items()} | {label: t for label, (t, _) in TEMPLATES.items()}
        self.templates = {label: words(text) for label, text in texts.items()}
        self.key = {label: words(phrase) for label, (_, phrase) in TEMPLATES.items()} | {
            label: words(phrase) for label, phrase in BASE.items()
        }
        vocabulary = {w for template in self.templates.values() for w in template}
        self.idf = {w: math.log((documents + 1) / (frequency.get(w, 0) + 1)) + 1e-6 for w in vocabulary}
        self.weight = {label: sum(self.idf[w] for w in t) for label, t in self.templates.items()}
        self.postings: dict[bytes, list[tuple[str, int]]] = defaultdict(list)
        for label, template in self.templates.items():
            # a base phrase has to match word for word, so its one rarest word finds all places
            rare = sorted(range(len(template)), key=lambda at: (-self.idf[template[at]], at))
            for at in rare[: 1 if label in BASE else ANCHORS]:
                self.postings[template[at]].append((label, at))

    def scan(self, found: list[bytes]) -> tuple[list[int], set[str], set[str], float]:
        """Starts of base phrases, base labels, all labels, and the best share of a template's weight."""
        starts: list[int] = []
        base, labels, score, seen = set(), set(), 0.0, set()
        present = self.postings.keys() & set(found)
        if not present:
            return starts, base, labels, score
        for at, word in enumerate(found):
            if word not in present:
                continue
            for label, offset in self.postings[word]:
                start, template = at - offset, self.templates[label]
                if (label, start) in seen:
                    continue
                seen.add((label, start))
                if label in BASE:
                    if start >= 0 and found[start : start + len(template)] == template:
                        starts.append(start)
                        base.add(label)
                        score = 1.0
                    continue
                agreeing = sum(
                    self.idf[w] for i, w in enumerate(template) if 0 <= start + i < len(found) and found[start + i] == w
                )
                share = agreeing / self.weight[label]
                if share >= MIN_SHARE and self._has_key(found, max(0, start), start + len(template), self.key[label]):
                    labels.add(label)
                    score = max(score, min(share, 1.0))
        return starts, base, base | labels, score

    @staticmethod
    def _has_key(found: list[bytes], start: int, stop: int, key: list[bytes]) -> bool:
        return any(found[at : at + len(key)] == key for at in range(start, stop - len(key) + 1))


def word_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """Number of documents, and in how many of them each licence word stands; as many rows as licence words."""
    vocabulary = frozenset(
        w for text in [*BASE.values(), *(t for t, _ in TEMPLATES.values())] for w in words(text)
    )

    @F.pandas_udf("array<string>")
    def present(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: [w.decode() for w in vocabulary.intersection(words(text))])

    # the empty word counts the documents
    found = docs.select(F.explode(F.concat(F.array(F.lit("")), present(whole_text(text_col)))).alias("word"))
    counts = {row["word"].encode(): row["n"] for row in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return counts.pop(b"", 0), counts


SCANNED = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
)


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and what its whole text says of licences, a row for each document.

    Words are runs of digits, letters and all characters beyond ASCII, A to Z in lower case.
    ``n_base`` counts the places of the base phrases, ``first_word`` and ``last_word`` are their
    smallest and largest start (null without any), ``base_labels`` and ``labels`` are distinct, sorted
    and joined by commas. For other labels the template's rarest words, by the inverse document
    frequency over all of ``docs``, propose where it begins; the words that stand at the same relative
    place must have ``MIN_SHARE`` of its weight and its key phrase must stand there word for word.
    ``score`` is 1 with a base phrase, else the best such share, else 0.

    A null or empty text has no words and no labels (empty strings). Null ids and repeated rows are
    kept; other columns are ignored; an empty table gives no rows.
    """
    index = Index(*word_frequencies(docs, text_col))

    @F.pandas_udf(SCANNED)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            found = words(text)
            starts, base, labels, score = index.scan(found)
            first, last = (min(starts), max(starts)) if starts else (None, None)
            rows.append((len(found), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score))
        names = [part.split()[0] for part in SCANNED.split(", ")]
        return pd.DataFrame(rows, columns=names).astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.select(F.col(id_col).alias("doc_id"), scan(whole_text(text_col)).alias("found")).select("doc_id", "found.*")
