"""Benchmark passages in documents: CGK embeddings, repeated bit sampling, exact edit distance.

Texts are sequences of words (runs of letters, digits and characters beyond ASCII, in lower case), and an edit puts in, takes
out or replaces one word.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import ALPHANUMERIC, free_names, mixed, whole_text, word_hashes
from tripmart.session import materialize

MAX_EDITS = 0.2
SEED = 3
SAMPLED = 2
TARGET_RECALL = 0.99
MARKS = 1 << 20
MAX_REPETITIONS = 64
#: By item, edited copies on which repetitions are measured, and walks for each.
COPIES, WALKS = 4, 4
#: Cells of embeddings that are measured at once.
CELLS = 1 << 22
#: Bytes of benchmark text that one pass holds in each task; a larger benchmark takes several passes.
PASS_BYTES = 32 << 20


def allowed_edits(n_words: int, share: float = MAX_EDITS) -> int:
    """Edits of words that an item of ``n_words`` may have; none up to five words.

    So at least ``SEED`` neighbouring words of an item of that length or more stay as they are.
    """
    return int(share * n_words) if n_words > 5 else 0


def embed(words: np.ndarray, starts: np.ndarray, length: int | np.ndarray, walk: int) -> np.ndarray:
    """CGK embeddings of the windows of ``length`` words from each start: three times as many steps.

    Each step copies the word under the pointer, which moves on if a random bit of that word and step
    is 1. Past the window's end, the copy is 0.
    """
    steps = 3 * int(np.max(length))
    copies = np.zeros((len(starts), steps), np.uint64)
    at, ends = starts.copy(), np.minimum(starts + length, len(words))
    for step in range(steps):
        inside = at < ends
        word = np.where(inside, words[np.minimum(at, len(words) - 1)], np.uint64(0))
        copies[:, step] = word
        salt = np.uint64((walk * 0x9E3779B97F4A7C15 + step * 0xD1B54A32D192ED03) & (2**64 - 1))
        bits = (word ^ salt) * np.uint64(0xBF58476D1CE4E5B9)
        at = at + (inside & ((bits >> np.uint64(40)) & np.uint64(1) == 1))
    return copies


def sampled_places(length: int, repetition: int) -> np.ndarray:
    """Coordinates of an embedding that one repetition compares."""
    drawn = np.random.default_rng([length, repetition]).choice(3 * length, size=min(SAMPLED, 3 * length), replace=False)
    return np.sort(drawn)


def edit_distance_within(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Fewest edits between the item and any stretch of the text, and the place where that stretch ends."""
    before = np.zeros(len(text) + 1, np.int64)
    places = np.arange(len(text) + 1)
    for at, word in enumerate(item):
        row = np.empty_like(before)
        row[0] = at + 1
        row[1:] = np.minimum(before[1:] + 1, before[:-1] + (text != word))
        before = np.minimum.accumulate(row - places) + places
    end = int(before.argmin())
    return int(before[end]), end


def _edited(rng: np.random.Generator, item: np.ndarray, edits: int) -> np.ndarray:
    out = item.tolist()
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(len(out)))
        if kind == 0:
            out[at] = int(rng.integers(2**62))
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, int(rng.integers(2**62)))
    return np.array(out, np.uint64)


def _runs(words: np.ndarray) -> np.ndarray:
    """A key for every run of ``SEED`` words."""
    n = max(0, len(words) - SEED + 1)
    keys = np.zeros(n, np.uint64)
    for at in range(SEED):
        keys = (keys + words[at : at + n]) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(keys)


def _laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths and starts of texts, and the texts one behind the other."""
    lengths = np.array([len(t) for t in texts], np.int64)
    return lengths, np.cumsum(lengths) - lengths, np.concatenate(texts) if texts else np.zeros(0, np.uint64)


class Items:
    """Benchmark items, where their runs of words stand, and the sketches of their embeddings."""

    def __init__(self, items: list[tuple[object, str]], share: float = MAX_EDITS, target: float = TARGET_RECALL):
        self.share = share
        split = [(item_id, word_hashes(text, ALPHANUMERIC)) for item_id, text in items]
        self.ids = [item_id for item_id, words in split if len(words)]
        self.words = [words for _, words in split if len(words)]
        self.edits = np.array([allowed_edits(len(words), share) for words in self.words], np.int64)
        self.needed = np.array([max(1, len(w) - SEED + 1 - SEED * int(k)) for w, k in zip(self.words, self.edits, strict=True)])
        self.short = [item for item, words in enumerate(self.words) if len(words) < SEED]
        keys, items_of, offsets = [np.zeros(0, np.uint64)], [], []
        for item, words in enumerate(self.words):
            keys.append(_runs(words))
            items_of += [item] * len(keys[-1])
            offsets += range(len(keys[-1]))
        joined = np.concatenate(keys)
        order = np.argsort(joined, kind="stable")
        self.run_item, self.run_offset = np.array(items_of, np.int64)[order], np.array(offsets, np.int64)[order]
        self.keys, self.list_starts, counts = np.unique(joined[order], return_index=True, return_counts=True)
        self.list_ends = self.list_starts + counts
        self.marked = np.zeros(MARKS, bool)
        self.marked[self.keys & np.uint64(MARKS - 1)] = True
        self.repetitions = self._repetitions(target)
        self.sketches = [self._sketches_of(r) for r in range(int(self.repetitions.max(initial=0)))]

    def _alike(self, items: np.ndarray) -> list[np.ndarray]:
        """The items in groups of like lengths, whose embeddings have at most ``CELLS`` cells or are one."""
        lengths = np.array([len(self.words[item]) for item in items.tolist()], np.int64)
        groups, begin = [], 0
        order = np.argsort(lengths, kind="stable")
        for at in range(1, len(order) + 1):
            if at == len(order) or (at - begin + 1) * 3 * lengths[order[at]] > CELLS:
                groups.append(items[order[begin:at]])
                begin = at
        return groups

    def _sketches_of(self, repetition: int) -> dict[int, np.ndarray]:
        """Sketches of the items that are compared in this repetition."""
        found = {}
        for group in self._alike(np.flatnonzero(self.repetitions > repetition)):
            lengths, starts, joined = _laid_out([self.words[item] for item in group.tolist()])
            embedded = embed(joined, starts, lengths, repetition)
            for item, row, n in zip(group.tolist(), embedded, lengths.tolist(), strict=True):
                found[item] = row[sampled_places(n, repetition)]
        return found

    def _repetitions(self, target: float) -> np.ndarray:
        """By item, as many as find it at the target rate with all the edits it may bear; 0 where ``MAX_REPETITIONS`` do not.

        Measured on edited copies of each item, against the one that agrees least. Items with 0 are
        not sampled: their windows are all verified.
        """
        rng, least = np.random.default_rng(5), np.ones(len(self.words))
        for group in self._alike(np.flatnonzero(self.edits > 0)):
            own = [self.words[item] for item in group.tolist()]
            lengths, starts, joined = _laid_out(own)
            chances = np.zeros((COPIES, len(group)))
            copies = [_laid_out([_edited(rng, w, int(self.edits[i])) for w, i in zip(own, group.tolist(), strict=True)])[1:] for _ in range(COPIES)]
            for walk in range(WALKS):
                one = embed(joined, starts, lengths, walk)
                for copy, (other_starts, other_joined) in enumerate(copies):
                    same = one == embed(other_joined, other_starts, lengths, walk)
                    chances[copy] += [row[: 3 * n].mean() ** SAMPLED for row, n in zip(same, lengths.tolist(), strict=True)]
            least[group] = chances.min(axis=0) / WALKS
        lost = 1 - np.clip(least, 1e-9, 1 - 1e-9)
        needed = np.ceil(np.log(max(1 - target, 1e-9)) / np.log(lost))
        return np.where(needed > MAX_REPETITIONS, 0, np.maximum(needed, 1)).astype(np.int64)

    @staticmethod
    def _sketch(words: np.ndarray, starts: np.ndarray, length: int, repetition: int) -> np.ndarray:
        return embed(words, starts, length, repetition)[:, sampled_places(length, repetition)]

    def _windows(self, words: np.ndarray) -> dict[int, np.ndarray]:
        """By item, where its windows start: enough runs of its words stand there, each at its place in the item.

        One edit changes ``SEED`` runs of an item at most and moves the others by one place at most, so a
        stretch within an item's edits keeps the rest of them at places as many apart as it has edits.
        """
        found: dict[int, np.ndarray] = {}
        keys = _runs(words)
        runs = np.flatnonzero(self.marked[keys & np.uint64(MARKS - 1)])
        if len(runs):
            keys = keys[runs]
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hits = np.flatnonzero(self.keys[place] == keys)
            lists = place[hits]
            sizes = self.list_ends[lists] - self.list_starts[lists]
            within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            entries = np.repeat(self.list_starts[lists], sizes) + within
            items, starts = self.run_item[entries], np.repeat(runs[hits], sizes) - self.run_offset[entries]
            order = np.lexsort((starts, items))
            items, starts = items[order], starts[order]
            first = np.arange(len(items))
            last = first + self.needed[items] - 1
            inside = last < len(items)
            first, last = first[inside], last[inside]
            near = (items[first] == items[last]) & (starts[last] - starts[first] <= self.edits[items[first]])
            opened = np.zeros(len(items) + 1, np.int64)
            np.add.at(opened, first[near], 1)
            np.add.at(opened, last[near] + 1, -1)
            opened = np.flatnonzero(np.cumsum(opened[:-1]) > 0)
            for item in np.unique(items[opened]).tolist():
                found[item] = np.unique(starts[opened][items[opened] == item])
        for item in self.short:
            begins = np.flatnonzero(words == self.words[item][0])
            if len(begins):
                found[item] = begins
        return found

    def matches(self, text: str) -> list[tuple[object, int, int, int]]:
        """Item, edits, length of the item, and place of the last word of the nearest stretch."""
        hashed, out = word_hashes(text, ALPHANUMERIC), []
        windows = self._windows(hashed)
        for item, starts in windows.items():
            words = self.words[item]
            n, edits = len(words), int(self.edits[item])
            begin = np.unique(np.clip(starts, 0, len(hashed) - 1))
            collided = np.full(len(begin), self.repetitions[item] == 0)
            for repetition in range(self.repetitions[item]):
                rest = np.flatnonzero(~collided)
                if not len(rest):
                    break
                sketch = self._sketch(hashed, begin[rest], n, repetition)
                collided[rest] = (sketch == self.sketches[repetition][item]).all(axis=1)
            best = None
            for start in begin[collided].tolist():
                low = max(0, start - edits)
                distance, end = edit_distance_within(words, hashed[low : start + n + edits])
                if distance <= edits and (best is None or (distance, low + end) < best):
                    best = (distance, low + end)
            if best:
                out.append((self.ids[item], best[0], n, best[1] - 1))
        return sorted(out, key=lambda match: (str(match[0]), match[1:]))


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    share: float = MAX_EDITS,
    target: float = TARGET_RECALL,
) -> DataFrame:
    """``doc_id, item_id, edits, item_words, last_word``, a row for each document and item found in it.

    An item is found if some stretch of the document is at most ``share`` of the item's words away
    from it in edit distance (exactly equal for items of up to five words); ``edits`` is the smallest
    distance met. Windows of the item's length are opened where as many runs of three of its words
    stand at their places as such a stretch must have, so that none is lost; window and item are embedded by random walks, and where
    sampled coordinates agree in one of the repetitions, the distance is computed. Each item has as
    many repetitions as the target recall takes on edited copies of it; the windows of an item that
    takes more than ``MAX_REPETITIONS`` are all verified.

    The benchmark is held by every task, ``PASS_BYTES`` of it at a time: its size is looked at first, and
    a larger one takes several passes over the documents. Texts or items without words (null, empty)
    match nothing; null ids are kept; repeated rows are rows of their own, as are items with equal
    text; other columns are ignored; empty tables give no rows.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), whole_text(item_text_col).alias("text"))
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, math.ceil(size / PASS_BYTES))
    found = []
    for at in range(passes):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == at)
        held = Items([tuple(row) for row in own.orderBy("item_id", "text").collect()], share, target)
        found.append(rows.select("doc_id", F.explode(_matcher(held, kind)(F.col("text"))).alias("match")))
    return reduce(DataFrame.unionAll, found).select("doc_id", "match.*")


def _matcher(held: Items, kind: str) -> Callable[[Column], Column]:
    @F.pandas_udf(f"array<struct<item_id: {kind}, edits: int, item_words: int, last_word: int>>")
    def match(texts: pd.Series) -> pd.Series:
        names = ("item_id", "edits", "item_words", "last_word")
        return texts.map(lambda text: [dict(zip(names, found, strict=True)) for found in held.matches(text)])

    return match


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents in which an item of the benchmark is found, all columns kept.

    Rows that are equal in id and text share their fate; see ``contaminations`` for other cases.
    """
    marked = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    marked = marked.withColumn("digest", F.md5("text")).withColumn("key", F.struct("doc_id", "digest"))
    found = contaminations(marked, benchmark, "key", "text").select("doc_id.*").distinct()
    other_id, other_digest = free_names(docs, "other_id", "other_digest")
    found = materialize(found, "contaminated").toDF(other_id, other_digest)
    same = [F.md5(whole_text(text_col)) == F.col(other_digest), F.col(id_col).eqNullSafe(F.col(other_id))]
    return docs.join(found, same, "left_anti")
