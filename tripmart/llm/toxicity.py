"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import Memo, whole_text
from tripmart.session import materialize

WORD = re.compile(r"\w+")
BUCKETS = 1 << 18
PREFIXES = (4, 5)
#: At most so many rows of each label are learnt from: those with the smallest hash of their id.
ROWS_PER_LABEL = 5000
FACTORS = 4
BATCH = 16
#: Passes over the sample, and batches that they have together at least.
EPOCHS, STEPS = 8, 300
#: Steps of the weights and of the factors, and the spread that factors start with.
RATE, FACTOR_RATE, SPREAD = 0.2, 0.2, 0.03
#: A weight stays zero while its summed slopes do not exceed this many times the square root of the documents, as
#: the sums of chance slopes grow; and what holds weights and factors near zero.
SPARSITY, DECAY = 0.22, 1.0
THRESHOLD = 0.3


def word_buckets(word: str) -> tuple[int, ...]:
    """Buckets of a word's terms: itself and its first letters."""
    terms = {f"={word}", *(f"{n}{word[:n]}" for n in PREFIXES if len(word) >= n)}
    return tuple(sorted({zlib.crc32(t.encode("utf-8", "surrogatepass")) & (BUCKETS - 1) for t in terms}))


def buckets(text: str, of_word: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Sorted distinct buckets of a text's terms."""
    found = set().union(*map(of_word.__getitem__, set(WORD.findall(text.lower()))))
    return np.array(sorted(found), np.int32)


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(values, -30, 30)))


class Model:
    """A linear weight and factors of every bucket of hashed terms."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors
        self.known = Memo(word_buckets)
        #: Every bucket has its own place among the weights.
        self.place = range(len(weights))

    def __getstate__(self) -> tuple:
        return self.bias, self.weights, self.factors

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def score(self, text: str) -> float:
        """Chance of label 1 by the terms of the whole text, one by one and in pairs."""
        terms = buckets(text, self.known)
        own = self.factors[terms].astype(np.float64)
        pairs = 0.5 * (own.sum(axis=0) ** 2 - (own**2).sum(axis=0)).sum() / max(len(terms), 1)
        return float(_sigmoid(np.array(self.bias + self.weights[terms].sum(dtype=np.float64) + pairs)))


def _solved(slopes: np.ndarray, squares: np.ndarray, rate: float, sparsity: float) -> np.ndarray:
    """Numbers by the sums of their slopes so far: the minimum of their linear bound with both penalties."""
    pulled = np.sign(slopes) * np.maximum(np.abs(slopes) - sparsity, 0)
    return -pulled / ((1 + np.sqrt(squares)) / rate + DECAY)


def _sums(place: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` by place."""
    return np.stack([np.bincount(place, values[:, f], minlength=n) for f in range(values.shape[1])], axis=1)


def fit(rows: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> Model:
    """Model of the buckets of documents and their labels; ``weights`` restore the labels' shares.

    A factorization machine of degree two over all buckets, none left out: a document's value is the sum of its
    buckets' weights and of the products of the factors of each two of them, by their number. Learnt in small batches
    that touch their own buckets only, by following the regularised leader: weights that chance
    explains stay zero by their penalty, not by a choice of buckets beforehand, and factors learn pairs whatever the
    weights are.
    """
    prior = float((weights * labels).sum() / weights.sum()) if len(labels) else 0.0
    rng = np.random.default_rng(3)
    bias, bias_squares = float(np.log((prior + 1e-4) / (1 - prior + 1e-4))), 0.0
    slopes, squares = np.zeros(BUCKETS), np.zeros(BUCKETS)
    # slopes that give the factors their start
    factor_slopes = -rng.normal(0, SPREAD, (BUCKETS, FACTORS)) * (1 / FACTOR_RATE + DECAY)
    factor_squares, used = np.zeros((BUCKETS, FACTORS)), np.zeros(BUCKETS, bool)
    sparsity = SPARSITY * np.sqrt(len(rows))
    share = weights * (len(weights) / weights.sum()) if len(labels) else weights
    passes = max(EPOCHS, -(-STEPS // max(1, -(-len(rows) // BATCH)))) if len(set(labels.tolist())) == 2 else 0
    for _ in range(passes):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            sizes = np.array([len(rows[i]) for i in batch])
            owner, number = np.repeat(np.arange(len(batch)), sizes), np.maximum(sizes, 1)
            touched, term = np.unique(np.concatenate([rows[i] for i in batch]), return_inverse=True)
            used[touched] = True
            w = _solved(slopes[touched], squares[touched], RATE, sparsity)
            v = _solved(factor_slopes[touched], factor_squares[touched], FACTOR_RATE, 0.0)
            each = v[term]
            sums = _sums(owner, each, len(batch))
            own_squares = np.bincount(owner, (each**2).sum(axis=1), minlength=len(batch))
            value = bias + np.bincount(owner, w[term], minlength=len(batch)) + 0.5 * ((sums**2).sum(axis=1) - own_squares) / number
            error = share[batch] * (_sigmoid(value) - labels[batch])
            slope = np.bincount(term, error[owner], minlength=len(touched))
            pull = _sums(term, (error / number)[owner][:, None] * (sums[owner] - each), len(touched))
            for found, step, total, total_squares, rate in (
                (w, slope, slopes, squares, RATE), (v, pull, factor_slopes, factor_squares, FACTOR_RATE),
            ):
                before = total_squares[touched]
                total_squares[touched] = before + step**2
                total[touched] += step - (np.sqrt(before + step**2) - np.sqrt(before)) / rate * found
            bias_squares += error.sum() ** 2
            bias -= RATE * error.sum() / (1 + np.sqrt(bias_squares))
    # a bucket that was never met has nothing to say
    w = np.where(used, _solved(slopes, squares, RATE, sparsity), 0).astype(np.float32)
    v = np.where(used[:, None], _solved(factor_slopes, factor_squares, FACTOR_RATE, 0.0), 0).astype(np.float32)
    return Model(bias, w, v)


def held_out(id_column: Column) -> Column:
    """Rows that are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string")), F.lit(4)) == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows_per_label: int = ROWS_PER_LABEL,
) -> Model:
    """Model learnt from a bounded sample of the labelled rows that are not held out.

    The sample has at most ``rows_per_label`` documents of each label, chosen by a hash of their id; rows
    are weighted so that the labels have their shares of all learnable rows. What reaches the driver
    is the sample's hashed terms. Labels other than 0 and 1, null ids, labels without a document and
    documents with both labels' rows (the larger one counts) are no obstacle; without rows of both
    labels the score is the labels' share.
    """

    @F.pandas_udf("binary")
    def terms(texts: pd.Series) -> pd.Series:
        of_word = Memo(word_buckets, 50_000)
        return texts.map(lambda text: buckets(text, of_word).tobytes())

    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    usable = usable.filter(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    usable = usable.groupBy("id").agg(F.max("label").alias("label"))
    shares = dict(usable.groupBy("label").count().collect())
    parts = [
        usable.filter(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(rows_per_label) for label in (0, 1)
    ]
    # at most two times rows_per_label pairs of an id and a label
    sample = F.broadcast(materialize(parts[0].unionByName(parts[1]), "sample"))
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")).join(sample, "id")
    found = texts.select("id", "label", F.xxhash64("text").alias("tie"), terms("text").alias("terms"))
    found = found.groupBy("id", "tie").agg(F.any_value("label").alias("label"), F.any_value("terms").alias("terms"))
    rows = found.orderBy("id", "tie").collect()
    known = np.array([r["label"] for r in rows], float)
    counts = {label: max(1, int((known == label).sum())) for label in (0, 1)}
    weights = np.array([shares[r["label"]] / counts[r["label"]] for r in rows], float)
    return fit([np.frombuffer(r["terms"], np.int32) for r in rows], known, weights)


def scorer(model: Model) -> Callable[[Column], Column]:
    """The model as a column expression on whole texts."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(model.score).astype("float64")

    return score


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; only its text has a say in the score.

    A null or empty text has the score of a text without known terms. Null ids (not held out) and
    repeated rows are kept; other columns are ignored; an empty table gives no rows.
    """
    found = docs.select(
        F.col(id_col).alias("doc_id"),
        held_out(F.col(id_col)).alias("held_out"),
        scorer(model)(whole_text(text_col)).alias("score"),
    )
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that the model rejects, all columns kept."""
    return docs.filter(scorer(model)(whole_text(text_col)) < threshold)
