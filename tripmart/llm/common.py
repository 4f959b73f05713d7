"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.session import CHECKPOINT_DIR, scratch_dir


def whole_text(column: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, with its lineage cut."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        root = df.sparkSession.conf.get(CHECKPOINT_DIR, None)
        context.setCheckpointDir(root or scratch_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)


#: A table of up to so many bytes may be sent to all tasks; a larger one is joined by a shuffle.
SENT_BYTES = 32 << 20


def sent_if_small(df: DataFrame, row_bytes: Column, limit: int = SENT_BYTES) -> DataFrame:
    """``df``, a table that has been written, to be broadcast if its rows are measured to be below the limit."""
    size = df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores more as keep it apart from the columns of ``df``."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def give_back_memory() -> None:
    """Return what Arrow has freed to the system, as a Python worker lives on for later stages."""
    pa.default_memory_pool().release_unused()


class Memo(dict):
    """Results of a function by its argument, of the latest ``limit`` to twice as many different ones.

    When it is full, its entries become the older ones, in place of those before; an older entry that is
    asked for again is taken over.
    """

    def __init__(self, compute: Callable[[Any], Any], limit: int = 50_000):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, key: Any) -> Any:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value


#: By byte of UTF-8: what is not white space of ASCII, and letters, digits and all beyond ASCII.
NOT_SPACE = np.array([not chr(b).isspace() or b > 127 for b in range(256)])
ALPHANUMERIC = np.array([chr(b).isalnum() or b > 127 for b in range(256)])
_BASE = 0x9E3779B97F4A7C15


def mixed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values, one to one, with their bits spread."""
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to 2 ** bits of the base and of its inverse, modulo 2 ** 64."""
    found = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full((1 << bits) + 1, base, np.uint64)
        factors[0] = 1
        found.append(np.multiply.accumulate(factors))
    return found[0], found[1]


def word_hashes(text: str, letters: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of the lower-cased text; words are runs of bytes in ``letters``.

    A word's hash is a polynomial of its bytes, got from running sums over the whole text.
    """
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = letters[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    powers, inverse = _powers(max(16, len(data).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts])
