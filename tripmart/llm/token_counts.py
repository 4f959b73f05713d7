"""Token counts by byte-pair merging over a linked list, without making ids."""

from __future__ import annotations

import json
from functools import cache
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import Memo, whole_text

LIMIT = 1024
KEPT_PIECES = 150_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


class Counter:
    """Counts of the tokens of texts under one tokenizer file."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols = byte_symbols()
        self.symbol_of = {b: s for b, s in enumerate(symbols)}
        self.rank = {tuple(pair): at for at, pair in enumerate(spec["model"]["merges"])}
        special = [regex.escape(t["content"]) for t in spec["added_tokens"]]
        self.split_special = regex.compile("|".join(special)).split if special else lambda text: [text]
        self.pieces = regex.compile(pattern).findall
        self.counts = Memo(self.merge, KEPT_PIECES)

    def merge(self, piece: str) -> int:
        """Symbols that are left of a piece: those at first less the merges.

        A heap holds the adjacent pairs by rank and place; a pair is out of date if one of its sides
        has been merged since.
        """
        symbols = [self.symbol_of[b] for b in piece.encode("utf-8", "surrogatepass")]
        n = left = len(symbols)
        if n < 2:
            return n
        rank = self.rank
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, at, symbols[at], symbols[at + 1]) for at in range(n - 1) if (r := rank.get((symbols[at], symbols[at + 1]))) is not None]
        heapify(heap)
        while heap:
            _, at, one, other = heappop(heap)
            following = after[at]
            if symbols[at] != one or following >= n or symbols[following] != other:
                continue
            symbols[at], symbols[following] = one + other, ""
            left -= 1
            after[at] = behind = after[following]
            if behind < n:
                before[behind] = at
                if (r := rank.get((symbols[at], symbols[behind]))) is not None:
                    heappush(heap, (r, at, symbols[at], symbols[behind]))
            if (ahead := before[at]) >= 0 and (r := rank.get((symbols[ahead], symbols[at]))) is not None:
                heappush(heap, (r, ahead, symbols[ahead], symbols[at]))
        return left

    def count(self, text: str) -> int:
        """Tokens of a whole text; each special string in it is one token."""
        parts = self.split_special(text)
        return len(parts) - 1 + sum(sum(map(self.counts.__getitem__, self.pieces(part))) for part in parts)


@cache
def counter(path: str, pattern: str) -> Counter:
    """One counter for each Python worker."""
    return Counter(path, pattern)


def token_count(text: Column, path: str, pattern: str) -> Column:
    """Number of tokens of each whole text."""

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(counter(path, pattern).count).astype("int64")

    return count(text)


def token_counts(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document.

    A null or empty text has no bytes and no tokens. Null ids and repeated rows are kept, a row for
    each; other columns are ignored; an empty table gives no rows.
    """
    text = whole_text(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        token_count(text, path, pattern).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
