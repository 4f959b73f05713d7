"""Token ids in 64-bit words of varying counts, written as shards in document order and read back.

A word's top four bits are its selector; the other sixty hold as many ids as the selector's width
allows. Selector 15 is an escape: the next word holds one value of up to 64 bits as it is. A shard row
has the words of whole documents and, for every ``BLOCK_WORDS`` words, the index of the block's first
id, so blocks can be decoded on their own.
"""

from __future__ import annotations

import re
import string
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripmart.llm.common import Memo, whole_text
from tripmart.llm.token_counts import byte_symbols

END_ID = 1
#: Fixed values of the word format: ids per word for selectors 0 to 13, each of 60 // count bits.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
ESCAPE = 15
BLOCK_WORDS = 4096
ROW_IDS = 500_000
ROWS_AT_ONCE = 256
KEPT_CHUNKS = 300_000
SIGNS = string.punctuation
#: What ``str.split`` takes for white space and the tokenizer does not, and what both do.
NO_SPACE = "\x1c\x1d\x1e\x1f"
SPACE = re.compile(rf"[^\S{NO_SPACE}]+")
#: By code point: letters, digits and other signs; what is never parted from its neighbours, an apostrophe and all beyond Latin-1, has none.
KINDS = np.array([0 if c.isspace() or c == "'" else 1 if c.isalpha() else 2 if c.isnumeric() else 3 for c in map(chr, range(256))] + [0], np.uint8)
_PAYLOAD = np.uint64(60)


def pack(ids: np.ndarray) -> np.ndarray:
    """Words of unsigned ids: at each place the selector that takes the most of the ids to come."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64)
    selector, step = np.full(n, ESCAPE, np.int8), np.ones(n, np.int8)
    narrow = ids.astype(np.uint32) if ids.max() < 1 << 32 else ids
    widest = int(ids.max())
    for at in range(len(COUNTS) - 1, -1, -1):
        count, bits = COUNTS[at], 60 // COUNTS[at]
        if widest < 1 << bits:
            begins = slice(0, max(0, n - count + 1))
        else:
            fits = np.flatnonzero(narrow < (1 << bits))
            # places from which so many ids in a row are narrow enough
            begins = fits[: max(0, len(fits) - count + 1)]
            begins = begins[fits[count - 1 :] - begins == count - 1]
        selector[begins], step[begins] = at, count
    steps, starts, at = step.tolist(), [], 0
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts)
    chosen = selector[starts]
    place = np.arange(len(starts)) + np.concatenate(([0], np.cumsum(chosen == ESCAPE)[:-1]))
    words = np.zeros(len(starts) + int((chosen == ESCAPE).sum()), np.uint64)
    words[place] = chosen.astype(np.uint64) << _PAYLOAD
    words[place[chosen == ESCAPE] + 1] = ids[starts[chosen == ESCAPE]]
    for at, count in enumerate(COUNTS):
        own = starts[chosen == at]
        if len(own):
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(60 // count)
            words[place[chosen == at]] |= (ids[own[:, None] + np.arange(count)] << shifts).sum(axis=1, dtype=np.uint64)
    return words


def _layout(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Selector of each word, and how many ids it holds; a word that follows an escape has selector -1."""
    selector = (words >> _PAYLOAD).astype(np.int64)
    if (selector == ESCAPE).any():
        at = 0
        for mark in np.flatnonzero(selector == ESCAPE).tolist():
            if mark >= at and selector[mark] == ESCAPE:
                selector[mark + 1 : mark + 2] = -1
                at = mark + 2
    counts = np.zeros(len(words), np.int64)
    known = selector >= 0
    counts[known] = np.array([*COUNTS, 0, 1])[selector[known]]
    return selector, counts


def unpack(words: np.ndarray) -> np.ndarray:
    """All ids of the words, one vectorised step for each selector."""
    words = np.asarray(words, np.uint64)
    selector, counts = _layout(words)
    start = np.cumsum(counts) - counts
    ids = np.empty(int(counts.sum()), np.uint64)
    for at, count in enumerate(COUNTS):
        own = np.flatnonzero(selector == at)
        if len(own):
            bits = 60 // count
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            ids[start[own][:, None] + np.arange(count)] = (words[own][:, None] >> shifts) & np.uint64((1 << bits) - 1)
    escaped = np.flatnonzero(selector == ESCAPE)
    ids[start[escaped]] = words[escaped + 1]
    return ids


def block_offsets(words: np.ndarray) -> np.ndarray:
    """Index of the first id of every block of ``BLOCK_WORDS`` words.

    A block that begins with an escape's value has the index of the id after it.
    """
    _, counts = _layout(words)
    return (np.cumsum(counts) - counts)[::BLOCK_WORDS]


def parted(text: str) -> str:
    """``text`` with a space where letters, digits and other signs of Latin-1 meet; a text of Latin-1 alone in lower case.

    A tokenizer that encodes runs of each kind separately has the same ids for both. Only runs that
    begin with an apostrophe hold two kinds, so nothing is put beside one.
    """
    try:
        text.encode("latin-1")
        code, codes = "latin-1", np.frombuffer(text.lower().encode("latin-1"), np.uint8)
        kinds = KINDS[codes]
    except UnicodeEncodeError:
        code, codes = "utf-32-le", np.frombuffer(text.encode("utf-32-le"), "<u4")
        kinds = KINDS[np.minimum(codes, 256)]
    before, after = kinds[:-1], kinds[1:]
    places = np.flatnonzero((before != after) & (before > 0) & (after > 0)) + 1
    return np.insert(codes, places, ord(" ")).tobytes().decode(code)


class Ids:
    """Ids of texts under a tokenizer that drops white space and case, with the ids of earlier chunks kept.

    Pieces of letters, of digits and of other signs are encoded separately, so a word has one entry among the
    kept ones, whatever its case and the signs beside it. Special strings are looked for in the text as it is; none
    holds white space, so each lies within a chunk.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.symbols = self.tokenizer.model, byte_symbols()
        self.packed = Memo(self._packed, KEPT_CHUNKS)

    def _packed(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            if (low := chunk.lower()) != chunk:
                return self.packed[low]
            # such letters are their own symbols
            ids = [token.id for token in self.model.tokenize(chunk)]
        elif "<|" in chunk or (not chunk.isascii() and max(chunk) >= "\u0100"):
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        elif (low := chunk.lower()) != chunk:
            return self.packed[low]
        elif (stem := chunk.rstrip(SIGNS)) != chunk and stem.isalpha():
            return self.packed[stem] + self.packed[chunk[len(stem) :]]
        elif chunk.isalpha():
            # one piece: the tokenizer's own model without the steps that find the pieces
            ids = [token.id for token in self.model.tokenize("".join(map(self.symbols.__getitem__, chunk.encode())))]
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if any(sign in text for sign in NO_SPACE):
            chunks = filter(None, SPACE.split(text))
        else:
            chunks = (text if "<|" in text else parted(text)).split()
        return b"".join(map(self.packed.__getitem__, chunks))


@cache
def ids_of(path: str) -> Ids:
    """One tokenizer for each Python worker."""
    return Ids(path)


SHARD = "part int, row int, n_ids bigint, doc_ids array<{id}>, doc_lengths array<bigint>, words binary, offsets array<bigint>"


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> None:
    """Encode every whole text, append ``end_id``, and write shard rows in ascending order of the ids."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = [part.split()[0] for part in SHARD.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, row, ids, lengths, buffers, held = np.array([end_id], "<u4").tobytes(), 0, [], [], [], 0

        def shard() -> pa.RecordBatch:
            words = pack(np.frombuffer(b"".join(buffers), "<u4"))
            values = [part, row, held, ids, lengths, words.astype("<u8").tobytes(), block_offsets(words).tolist()]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(id_type), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            id_type = batch.column(1).type
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                piece = batch.slice(at, ROWS_AT_ONCE)
                part = piece.column(0)[0].as_py()
                for doc_id, text in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist(), strict=True):
                    buffers.append(ids_of(tokenizer).encode(text) + end)
                    ids.append(doc_id)
                    lengths.append(len(buffers[-1]) // 4)
                    held += lengths[-1]
                    if held >= ROW_IDS:
                        yield shard()
                        row, ids, lengths, buffers, held = row + 1, [], [], [], 0
        if ids:
            yield shard()

    text = whole_text(text_col)
    ordered = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    ordered.mapInArrow(rows, SHARD.format(id=kind)).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the shards; ``ids`` are unsigned 32-bit integers."""
    shards = spark.read.parquet(path)
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    sizes = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row for each task that wrote: as many as the shuffle has partitions, whatever the corpus
    before = sizes.alias("own").join(sizes.alias("other"), F.col("other.part") < F.col("own.part"), "left")
    before = before.groupBy(F.col("own.part").alias("part")).agg(F.coalesce(F.sum("other.n"), F.lit(0)).alias("before"))
    in_part = shards.select("part", "row", "n_ids").alias("own").join(
        shards.select("part", "row", "n_ids").alias("other"),
        (F.col("own.part") == F.col("other.part")) & (F.col("other.row") < F.col("own.row")),
        "left",
    )
    in_part = in_part.groupBy(F.col("own.part").alias("part"), F.col("own.row").alias("row")).agg(
        F.coalesce(F.sum("other.n_ids"), F.lit(0)).alias("ahead")
    )
    starts = in_part.join(before, "part").select("part", "row", (F.col("before") + F.col("ahead")).alias("first"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, doc_ids, lengths, words in zip(
                batch["first"], batch["doc_ids"], batch["doc_lengths"], batch["words"], strict=True
            ):
                ids = unpack(np.frombuffer(words, "<u8")).astype("<u4")
                ends = np.cumsum(lengths)
                yield pd.DataFrame(
                    {
                        "doc_id": pd.Series(list(doc_ids), dtype=object),
                        "start": first + ends - lengths,
                        "n_tokens": lengths,
                        "ids": [own.tobytes() for own in np.split(ids, ends[:-1])],
                    }
                )

    return shards.join(starts, ["part", "row"]).select("first", "doc_ids", "doc_lengths", "words").mapInPandas(
        decode, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary"
    )


def round_trip(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` of every document, from the shards written to ``path``.

    Documents stand in ascending order of their ids, null ids first, rows of one id in the order of a
    hash of their texts; repeated rows stand side by side. A null or empty text has the end id alone.
    Other columns are ignored; an empty table gives no rows.
    """

    @F.pandas_udf("bigint")
    def crc32(ids: pd.Series) -> pd.Series:
        return ids.map(zlib.crc32)

    write_shards(docs, path, tokenizer, id_col, text_col)
    found = read_shards(docs.sparkSession, path)
    return found.select("doc_id", "start", "n_tokens", crc32("ids").alias("ids_crc32"), "ids")
