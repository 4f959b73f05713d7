"""Byte-level BPE: long texts are pre-tokenised in overlapping chunks, then encoded piece by piece."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import Memo, give_back_memory, whole_text

CHUNK = 32_768
OVERLAP = 512
ROWS_AT_ONCE = 64
KEPT_PIECES = 40_000


class Codec:
    """Encoder of pieces and decoder of ids for one rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = regex.compile(pattern).findall
        self.matches = regex.compile(pattern).finditer
        self.packed = Memo(self._pack, KEPT_PIECES)
        self.bytes_of = [token for token, _ in sorted(ranks.items(), key=lambda item: item[1])]

    def _pack(self, piece: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(piece), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.packed.__getitem__, self.pieces(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def ends(self, text: str) -> list[int]:
        """Where the pieces of a text end."""
        return [match.end() for match in self.matches(text)]


@cache
def codec(path: str, pattern: str) -> Codec:
    """One codec for each Python worker."""
    return Codec(path, pattern)


def _found(ids: bytes, both: Codec) -> dict:
    """What is known of one text by its ids."""
    return {
        "n_tokens": len(ids) // 4,
        "ids": ids,
        "ids_sha256": hashlib.sha256(ids).hexdigest(),
        "decoded_sha256": hashlib.sha256(both.decode(ids)).hexdigest(),
    }


RESULT = "n_tokens bigint, ids binary, ids_sha256 string, decoded_sha256 string"
RESULT_ARROW = pa.schema([("n_tokens", pa.int64()), ("ids", pa.binary()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _chunk_ends(path: str, pattern: str) -> Callable[[pd.Series, pd.Series], pd.Series]:
    @F.pandas_udf("head array<int>, tail array<int>")
    def ends(chunks: pd.Series, starts: pd.Series) -> pd.DataFrame:
        """Ends of pieces in the overlaps with the chunk before and the next one, as positions in the text.

        The last ends of a chunk's tail are left out: the cut text may have moved them.
        """
        heads, tails = [], []
        for chunk, start in zip(chunks, starts, strict=True):
            found = np.array(codec(path, pattern).ends(chunk), np.int64)
            heads.append((found[found <= OVERLAP] + start).tolist())
            # a piece is settled once two more characters and another piece follow it
            settled = found[:-2][found[:-2] < len(chunk) - 2]
            tails.append((settled[settled > CHUNK] + start).tolist())
        return pd.DataFrame({"head": heads, "tail": tails})

    return ends


def _encode_pieces(path: str, pattern: str) -> Callable[[pd.Series], pd.Series]:
    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        return texts.map(codec(path, pattern).encode)

    return encode


def _long_texts(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encoded texts of more than one chunk; ``rows`` has ``doc_id, text``."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    distinct = rows.withColumn("text_hash", F.xxhash64("text"))
    chunks = distinct.select(
        "doc_id",
        "text_hash",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.ceil(F.length("text") / CHUNK).cast("int") - 1),
                lambda at: F.substring("text", at * CHUNK + 1, CHUNK + OVERLAP),
            )
        ).alias("chunk", "part"),
    )
    key = ["doc_id", "text_hash", "chunk"]
    chunks = chunks.groupBy(*key).agg(F.any_value("part").alias("part"), F.count("*").alias("rows"))
    chunks = chunks.withColumn("start", F.col("chunk") * CHUNK)
    chunks = chunks.withColumn("ends", _chunk_ends(path, pattern)("part", "start")).select("*", "ends.*")

    order = Window.partitionBy("doc_id", "text_hash").orderBy("chunk")
    last = F.lead("chunk").over(order).isNull()
    # the first boundary that both chunks have: from there on both read the same pieces
    chunks = chunks.withColumn("cut", F.array_min(F.array_intersect("tail", F.lead("head").over(order))))
    chunks = chunks.withColumn("from", F.coalesce(F.lag("cut").over(order), F.lit(0))).withColumn("last", last)
    piece = F.when(F.col("last"), F.expr("substring(part, `from` - start + 1)")).otherwise(
        F.expr("substring(part, `from` - start + 1, cut - `from`)")
    )
    # only a text whose chunks do not all fit together is needed as a whole
    joined = F.min(F.col("last") | F.col("cut").isNotNull()).over(Window.partitionBy("doc_id", "text_hash"))
    chunks = chunks.withColumn("piece", F.coalesce(piece, F.lit(""))).withColumn("joined", joined)
    joined = F.col("joined")
    chunks = chunks.select(
        *key, "rows", F.when(~joined, F.substring("part", 1, CHUNK)).alias("own"), joined.alias("joined"),
        _encode_pieces(path, pattern)("piece").alias("ids"),
    )

    def join_chunks(text: pd.DataFrame) -> pd.DataFrame:
        text = text.sort_values("chunk")
        both = codec(path, pattern)
        if text["joined"].all():
            ids = b"".join(text["ids"])
        else:  # a piece longer than the overlap: the whole text is read at once
            ids = both.encode("".join(text["own"]))
        found = pd.DataFrame([_found(ids, both)])
        found.insert(0, "doc_id", text["doc_id"].iloc[:1].to_numpy())
        return found.loc[found.index.repeat(int(text["rows"].iloc[0]))]

    return chunks.groupBy("doc_id", "text_hash").applyInPandas(join_chunks, f"doc_id {kind}, {RESULT}")


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256`` of every document.

    ``ids`` are the ids of the whole text as little-endian unsigned 32-bit integers; the decoded
    bytes are those of its tokens, joined. A text of more than ``CHUNK`` characters becomes several
    rows that overlap, in as many tasks; boundaries of pieces that two neighbours agree on are where
    they are put together, since matching has no memory of what lies before a boundary. If they
    agree on none, one piece being longer than the overlap, that text is read at once.

    Null text counts as empty and has no tokens. Null ids and repeated rows are kept, a row for each;
    other columns are ignored; an empty table gives no rows.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                found = [_found(own.encode(text), own) for text in part.column(1).to_pylist()]
                columns = pa.RecordBatch.from_pylist(found, RESULT_ARROW).columns
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", *RESULT_ARROW.names])
            give_back_memory()

    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    short = rows.filter(F.length("text") <= CHUNK).mapInArrow(encode, f"doc_id {kind}, {RESULT}")
    return short.unionByName(_long_texts(rows.filter(F.length("text") > CHUNK), path, pattern))


def with_tokens(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The digests of ``encoded`` without the ids."""
    return encoded(docs, path, pattern, id_col, text_col).drop("ids")
