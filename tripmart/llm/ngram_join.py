"""Similarity join of documents on word n-grams, by plain MinHash banding."""

from __future__ import annotations

from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import NOT_SPACE, checkpointed, free_names, mixed, whole_text, word_hashes
from tripmart.llm.components import connected_components
from tripmart.session import materialize

NGRAM = 5
THRESHOLD = 0.8
TREES = 12
FULL_DEPTH = 6
TARGET_RECALL = 0.995
BLOCK = 512
COLUMNS_AT_ONCE = 4096
_MIX = np.uint64(0x9E3779B97F4A7C15)


def expected_recall(depth: int, threshold: float = THRESHOLD, trees: int = TREES) -> float:
    """Chance that two texts just at the threshold share a prefix of ``depth`` in at least one tree."""
    return 1.0 - (1.0 - threshold**depth) ** trees


def prefix_depth(threshold: float = THRESHOLD, trees: int = TREES, target: float = TARGET_RECALL) -> int:
    """Most values, up to the full depth, that a band can have at the target recall: four by the defaults, for all texts."""
    depth = FULL_DEPTH
    while depth > 1 and expected_recall(depth, threshold, trees) < target:
        depth -= 1
    return depth


def shingles(text: str, ngram: int = NGRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of the lower-cased words; a shorter text is one n-gram."""
    hashes = word_hashes(text, NOT_SPACE)
    size = max(len(hashes) - ngram + 1, min(len(hashes), 1))
    found = np.full(size, min(len(hashes), ngram), np.uint64)
    for at in range(min(ngram, len(hashes))):
        found = found * _MIX + hashes[at : at + size]
    return np.unique(mixed(found))


@cache
def _multipliers(trees: int, depth: int) -> np.ndarray:
    drawn = np.random.default_rng(20).integers(1, 2**63, size=trees * FULL_DEPTH, dtype=np.uint64)
    return (drawn * np.uint64(2) + np.uint64(1)).reshape(trees, FULL_DEPTH)[:, :depth].ravel()


def prefixes(found: np.ndarray, trees: int = TREES, depth: int = FULL_DEPTH) -> np.ndarray:
    """For each tree, a hash of the first ``depth`` MinHash values; none for an empty set."""
    if not len(found):
        return np.zeros(0, np.int64)
    lows = np.empty(trees * depth, np.uint64)
    for at, multiplier in enumerate(_multipliers(trees, depth)):
        lows[at] = (found * multiplier).min()
    keys = np.zeros(trees, np.uint64)
    for column in lows.reshape(trees, depth).T:
        keys = mixed(keys * _MIX + column)
    return keys.view(np.int64)


def _forest(links: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the lowest row of its component."""
    low = np.arange(len(links))
    while True:
        reached = np.where(links, low[None, :], len(low)).min(axis=1)
        new = np.minimum(low, reached)
        new = np.minimum(new, new[new])
        if (new == low).all():
            return low
        low = new


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices over the hashes that occur twice."""
    n = len(sets)
    sizes = [len(s) for s in sets]
    values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1
    keep = counts[place] > 1
    rows, columns = np.repeat(np.arange(n), sizes)[keep], column[place[keep]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    total = np.zeros((n, n), np.float64)
    width = int(columns[-1]) + 1 if len(columns) else 0
    for start in range(0, width, COLUMNS_AT_ONCE):
        low, high = np.searchsorted(columns, [start, start + COLUMNS_AT_ONCE])
        held = np.zeros((n, min(COLUMNS_AT_ONCE, width - start)), np.float32)
        held[rows[low:high], columns[low:high] - start] = 1
        total += held @ held.T
    return total


def _verify_unit(unit: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Exact links of one prefix node, or of two blocks of one: per text their number, and a spanning forest.

    A pair that shares prefixes in several trees is looked at in the first of them only.
    """
    tree, one, other = (int(unit[c].iloc[0]) for c in ("tree", "block_a", "block_b"))
    keys = np.stack(unit["prefixes"].to_numpy())
    wanted = np.ones((len(unit), len(unit)), bool)
    for earlier in range(tree):
        wanted &= keys[:, earlier][:, None] != keys[:, earlier][None, :]
    if one != other:
        block = unit["block"].to_numpy()
        wanted &= block[:, None] != block[None, :]
    np.fill_diagonal(wanted, False)
    nothing = unit.iloc[:0][["digest"]].assign(texts=0, copies=0, low=b"")
    if not wanted.any():
        return nothing
    sets = [np.frombuffer(s, np.uint64) for s in unit["shingles"]]
    common, sizes = _common(sets), np.array([len(s) for s in sets], np.float64)
    links = wanted & (common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9)
    linked = links.any(axis=1)
    if not linked.any():
        return nothing
    digests = unit["digest"].to_numpy()
    return pd.DataFrame(
        {
            "digest": digests[linked],
            "texts": links.sum(axis=1)[linked],
            "copies": (links @ unit["n_copies"].to_numpy())[linked],
            "low": digests[_forest(links)][linked],
        }
    )


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    target: float = TARGET_RECALL,
    trees: int = TREES,
    block: int = BLOCK,
) -> DataFrame:
    """Every document with its class, its group and its number of links.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles (lower
    case, words between white space; a text of one to four words is one shingle) is at least
    ``threshold``. Returns one row per row of ``docs``: ``doc_id``, ``digest`` (of the text),
    ``class_id`` (smallest doc_id with the same text), ``group_id`` (smallest doc_id of the
    connected component), ``n_copies`` (documents of the class), ``n_linked_texts`` (other texts
    linked to this one) and ``n_links`` (other documents linked to this one, copies included).

    Equal texts are one class and take part once. Each text gets ``trees`` MinHash labels; texts
    with a common label prefix are candidates, at the depth where two texts at the threshold meet
    with probability ``target`` (see ``prefix_depth``). All pairs of a prefix node are verified
    exactly; a node larger than ``block`` is dealt as pairs of blocks. No pairs are put out, only
    each text's counts and a spanning forest, whose components are found by distributed union-find.

    Null text counts as empty. Texts without words have no shingles and are linked to none but
    their equals. Repeated rows and repeated or null ids are rows of their own; an id of a class or
    group is null only if all ids in it are. Other columns are ignored. An empty table gives no rows.
    """
    depth = prefix_depth(threshold, trees, target)

    @F.pandas_udf("array<bigint>")
    def label(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: prefixes(shingles(t), trees, depth))

    @F.pandas_udf("binary")
    def shingle_bytes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shingles(t).tobytes())

    def verify(unit: pd.DataFrame) -> pd.DataFrame:
        return _verify_unit(unit, threshold)

    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5("text")))
    classes = materialize(
        rows.groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_copies")), "classes"
    )
    labelled = rows.select("digest", label("text").alias("prefixes")).groupBy("digest")
    labelled = materialize(labelled.agg(F.any_value("prefixes").alias("prefixes")), "prefixes")

    members = labelled.select("digest", F.posexplode("prefixes").alias("tree", "key"))
    nodes = members.groupBy("tree", "key").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("digest")).alias("fingerprint")
    )
    nodes = nodes.filter("size > 1").groupBy("size", "fingerprint").agg(F.min(F.struct("tree", "key")).alias("node"))
    nodes = nodes.select("node.*", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    units = materialize(
        members.join(nodes, ["tree", "key"])
        .withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "tree", "key", "block", F.least("block", "other").alias("block_a"),
            F.greatest("block", "other").alias("block_b"), "digest",
        ),
        "units",
    )
    candidates = units.select("digest").distinct().join(labelled, "digest").join(classes, "digest")
    same_row = [F.col("r.digest") == F.col("c.digest"), F.col("r.doc_id").eqNullSafe(F.col("c.class_id"))]
    texts = rows.alias("r").join(candidates.alias("c"), same_row, "left_semi")
    texts = texts.groupBy("digest").agg(F.any_value("text").alias("text"))
    sets = texts.select("digest", shingle_bytes("text").alias("shingles")).join(candidates, "digest")
    verified = checkpointed(
        units.join(sets, "digest")
        .groupBy("tree", "key", "block_a", "block_b")
        .applyInPandas(verify, "digest binary, texts bigint, copies bigint, low binary")
    )
    links = verified.groupBy("digest").agg(F.sum("texts").alias("texts"), F.sum("copies").alias("copies"))
    roots = connected_components(verified, "digest", "low")
    known = classes.join(links, "digest", "left").join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    known = known.withColumn("root", F.coalesce("root", "digest"))
    groups = known.groupBy("root").agg(F.min("class_id").alias("group_id"))
    known = known.join(groups, "root").select(
        "digest", "class_id", "group_id", "n_copies",
        F.coalesce("texts", F.lit(0)).alias("n_linked_texts"),
        (F.col("n_copies") - 1 + F.coalesce("copies", F.lit(0))).alias("n_links"),
    )
    return rows.select("doc_id", "digest").join(known, "digest").select(
        "doc_id", "digest", "class_id", "group_id", "n_copies", "n_linked_texts", "n_links"
    )


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of similar ones, all columns kept.

    Of a group stays the document with the smallest id (of those with the same id, the smallest
    digest); of its repeated rows, one. Documents without words all stay.
    """
    digest, own, has_words = F.unhex(F.md5(whole_text(text_col))), F.col(id_col), whole_text(text_col).rlike(r"(?U)\S")
    found = similar_documents(docs.filter(has_words), id_col, text_col)
    linked = found.filter("n_links > 0").groupBy("group_id", "doc_id", "digest").agg(F.count("*").alias("rows"))
    linked = materialize(linked, "linked")
    first = linked.groupBy("group_id").agg(F.min(F.struct("doc_id", "digest", "rows")).alias("first")).select("first.*")
    stay = first.filter("rows = 1")
    same = [F.col("l.digest") == F.col("s.digest"), F.col("l.doc_id").eqNullSafe(F.col("s.doc_id"))]
    leave = materialize(linked.alias("l").join(stay.alias("s"), same, "left_anti").select("doc_id", "digest"), "leave")
    repeated = materialize(first.filter("rows > 1").select("doc_id", "digest"), "repeated")

    def rows_of(found: DataFrame, how: str) -> DataFrame:
        other_id, other_digest = free_names(docs, "other_id", "other_digest")
        keys = found.toDF(other_id, other_digest)
        return docs.join(keys, [digest == F.col(other_digest), own.eqNullSafe(F.col(other_id))], how)

    return rows_of(leave, "left_anti").unionByName(
        rows_of(repeated, "left_semi").dropDuplicates([id_col, text_col])
    )
