"""Fill-in-middle transformation over texts that are kept as seekable compressed frames."""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import give_back_memory, whole_text
from tripmart.session import materialize

FRAME_BYTES = 1 << 16
LEVEL = 3
SEED = 42
#: Of 100: texts that are transformed, and those of them in the order suffix, prefix, middle.
RATE, SPM_RATE = 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Parts of the text in the order of the output, each behind its mark.
ORDER = {"psm": (("prefix", PREFIX), ("suffix", SUFFIX), ("middle", MIDDLE)), "spm": (("suffix", SUFFIX), ("prefix", PREFIX), ("middle", MIDDLE))}
#: White space that parts units: a space and U+0009 to U+000D.
SPACE = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])

STORED = pa.list_(pa.struct([("units_before", pa.int64()), ("chars_before", pa.int64()), ("data", pa.binary())]))
WRITTEN = pa.list_(pa.struct([("chars_before", pa.int64()), ("data", pa.binary())]))
STORED_TYPE = "array<struct<units_before:bigint,chars_before:bigint,data:binary>>"
WRITTEN_TYPE = "array<struct<chars_before:bigint,data:binary>>"


@cache
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)


@cache
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def pressed(piece: bytes) -> bytes:
    return _compressor().compress(piece)


def plain(frame: bytes) -> bytes:
    return _decompressor().decompress(frame)


def count_chars(piece: bytes) -> int:
    """Code points of UTF-8: the bytes that continue none."""
    return int(((np.frombuffer(piece, np.uint8) & 0xC0) != 0x80).sum())


def unit_ends(text: bytes) -> np.ndarray:
    """Where each unit ends: after each run of other signs, and at the end after white space that follows the last one."""
    if not text:
        return np.zeros(0, np.int64)
    space = SPACE[np.frombuffer(text, np.uint8)]
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(text))


def frames_of(text: bytes, frame_bytes: int = FRAME_BYTES) -> tuple[list[dict], int, int]:
    """Independent frames of a text with the units and code points before each, and the text's own numbers of both.

    A frame ends after ``frame_bytes`` bytes, or up to three later, where a code point does; a unit
    belongs to the frame that it ends in, so one longer than a frame is no special case.
    """
    ends, frames, start, chars = unit_ends(text), [], 0, 0
    while start < len(text):
        stop = min(start + frame_bytes, len(text))
        while stop < len(text) and text[stop] & 0xC0 == 0x80:
            stop += 1
        piece = text[start:stop]
        before = int(np.searchsorted(ends, start, side="right"))
        frames.append({"units_before": before, "chars_before": chars, "data": pressed(piece)})
        chars += count_chars(piece)
        start = stop
    return frames, len(ends), chars


class Place(NamedTuple):
    """A cut: the frame, the bytes and code points of it that stand before, and those of the whole text."""

    frame: int
    offset: int
    chars: int


def place_of(frames: list[dict], units: int, opened: dict[int, bytes]) -> Place:
    """Where the first ``units`` units end; only the frame that is cut is decompressed, into ``opened``."""
    if not units:
        return Place(0, 0, 0)
    at = bisect_left([f["units_before"] for f in frames], units) - 1
    if at not in opened:
        opened[at] = plain(frames[at]["data"])
    piece = opened[at]
    space = SPACE[np.frombuffer(piece, np.uint8)]
    inside = np.flatnonzero(~space[:-1] & space[1:]) + 1
    left = units - frames[at]["units_before"]
    # the frame's last unit may end with it, which only the count of units tells
    offset = int(inside[left - 1]) if left <= len(inside) else len(piece)
    return Place(at, offset, frames[at]["chars_before"] + count_chars(piece[:offset]))


class Output:
    """Frames in output order: pieces are put together to a frame, whole frames are taken over as they are."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        self.frames, self.chars, self.waiting, self.size, self.frame_bytes = [], 0, [], 0, frame_bytes

    def piece(self, data: bytes) -> None:
        self.waiting.append(data)
        self.size += len(data)
        if self.size >= self.frame_bytes:
            self.close()

    def close(self) -> None:
        data = b"".join(self.waiting)
        if data:
            self.frame(pressed(data), count_chars(data))
        self.waiting, self.size = [], 0

    def frame(self, data: bytes, chars: int) -> None:
        self.frames.append({"chars_before": self.chars, "data": data})
        self.chars += chars


def reordered(frames: list[dict], chars: int, form: str, first: int, second: int) -> tuple[list[dict], int | None, int | None]:
    """Frames of the output, and the code points of prefix and middle.

    Only the frames that are cut are decompressed; the others move as they are.
    """
    if form == "plain":
        return [{"chars_before": f["chars_before"], "data": f["data"]} for f in frames], None, None
    opened: dict[int, bytes] = {}
    begin, one, two = Place(0, 0, 0), place_of(frames, first, opened), place_of(frames, second, opened)
    spans = {"prefix": (begin, one), "middle": (one, two), "suffix": (two, Place(len(frames), 0, chars))}
    stops = [f["chars_before"] for f in frames[1:]] + [chars]
    found = Output()
    for part, mark in ORDER[form]:
        found.piece(mark)
        start, stop = spans[part]
        for at in range(start.frame, min(stop.frame + 1, len(frames))):
            if at in opened:
                found.piece(opened[at][start.offset if at == start.frame else 0 : stop.offset if at == stop.frame else None])
            elif at < stop.frame:
                found.close()
                found.frame(frames[at]["data"], stops[at] - frames[at]["chars_before"])
    found.close()
    return found.frames, one.chars, two.chars - one.chars


class Reader:
    """Bytes of compressed frames, one frame at a time."""

    def __init__(self, frames: list[dict]):
        self.frames, self.last = frames, (-1, b"")

    def __getitem__(self, at: int) -> bytes:
        if self.last[0] != at:
            self.last = (at, plain(self.frames[at]["data"]))
        return self.last[1]

    def __iter__(self) -> Iterator[bytes]:
        for at in range(len(self.frames)):
            yield self[at]

    def span(self, starts: list[int], start: int, stop: int) -> Iterator[bytes]:
        """The bytes from ``start`` to ``stop``; ``starts`` are those of the frames."""
        for at in range(max(0, bisect_right(starts, start) - 1), len(self.frames)):
            if starts[at] >= stop:
                return
            yield self[at][max(0, start - starts[at]) : stop - starts[at]]


def restored(frames: list[dict], form: str) -> Iterator[bytes]:
    """Pieces of the original text, told from the output's frames and the form alone.

    A first pass looks for the marks, which the text of a transformed output does not hold; the parts
    between them are streamed in the text's order then.
    """
    reader = Reader(frames)
    if form == "plain":
        yield from reader
        return
    marks, starts, total, tail = [], [], 0, b""
    for piece in reader:
        starts.append(total)
        window, offset = tail + piece, total - len(tail)
        at = window.find(b"<")
        while at >= 0 and at + 3 <= len(window):
            if window[at : at + 3] in (PREFIX, SUFFIX, MIDDLE):
                marks.append((offset + at, window[at : at + 3]))
            at = window.find(b"<", at + 1)
        total += len(piece)
        tail = window[-2:]
    if [mark for _, mark in marks] != [mark for _, mark in ORDER[form]]:
        raise ValueError(f"the output is not of the form {form}")
    stops = [at for at, _ in marks[1:]] + [total]
    spans = {part: (at + 3, stop) for (part, _), (at, _), stop in zip(ORDER[form], marks, stops, strict=True)}
    for part in ("prefix", "middle", "suffix"):
        yield from reader.span(starts, *spans[part])


def digest(pieces: Iterator[bytes]) -> str:
    found = hashlib.sha256()
    for piece in pieces:
        found.update(piece)
    return found.hexdigest()


def stored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """``doc_id, n, n_chars, marked, frames``: every whole text as independent zstandard frames.

    Each frame knows the units and code points before it, so that a unit is found by opening one frame.
    ``marked`` tells whether the text holds one of the marks. A null or empty text has no frame; null
    ids and repeated rows are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frames, units, chars, marked = [], [], [], []
            for value in batch.column(1):
                text = value.as_py()
                own, n, length = frames_of(text, frame_bytes)
                frames.append(own)
                units.append(n)
                chars.append(length)
                marked.append(any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(units, pa.int64()), pa.array(chars, pa.int64()), pa.array(marked, pa.bool_()), pa.array(frames, STORED)],
                ["doc_id", "n", "n_chars", "marked", "frames"],
            )
            give_back_memory()

    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, n_chars bigint, marked boolean, frames {STORED_TYPE}")


def _drawn(id_column: Column, seed: int) -> list[Column]:
    """Four unsigned numbers of 32 bits by the seed and the id; a null id counts as no digits."""
    text = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(text, 1 + 8 * at, 8), 16, 10).cast("bigint") for at in range(4)]


def transformed(frames: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of the rows that ``stored`` gives.

    Form and cuts follow from the id alone, the cuts lying between units. ``output`` are zstandard
    frames whose contents, one after the other, are the transformed text; ``texts`` puts them together.
    A text that is empty, holds a mark or is not drawn stays as it is (form ``plain``).
    """
    h1, h2, h3, h4 = _drawn(F.col("doc_id"), seed)
    as_is = (F.col("n") == 0) | F.col("marked") | (h3 % 100 >= rate)
    cuts = [h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)]
    rows = frames.select(
        "doc_id", "n", F.when(as_is, "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm").alias("form"),
        F.least(*cuts).alias("first"), F.greatest(*cuts).alias("second"), "n_chars", "frames",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                reordered(own.as_py(), chars, form, first, second)
                for form, first, second, chars, own in zip(*(batch.column(at).to_pylist() for at in range(2, 6)), batch.column(6), strict=True)
            ]
            outputs, prefixes, middles = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(at) for at in range(3)), pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, WRITTEN)],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )
            give_back_memory()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output {WRITTEN_TYPE}"
    )


def _mapped(rows: DataFrame, new: list[tuple[str, object]], of) -> DataFrame:
    """``rows`` with ``output`` replaced by what ``of`` makes of each output and form; the new columns are strings."""
    kept = [c for c in rows.columns if c != "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [of(own.as_py(), form.as_py()) for own, form in zip(batch.column("output"), batch.column("form"), strict=True)]
            columns = [batch.column(c) for c in kept]
            columns += [pa.array([one[at] for one in found], pa.string()) for at in range(len(new))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *new])
            give_back_memory()

    types = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "output"), *(f"{n} string" for n in new)])
    return rows.mapInArrow(run, types)


def texts(rows: DataFrame) -> DataFrame:
    """``rows`` of ``transformed`` with the output's text as ``text`` in place of its frames."""
    return _mapped(rows, ["text"], lambda frames, form: (b"".join(Reader(frames)).decode("utf-8", "replace"),))


def digests(rows: DataFrame) -> DataFrame:
    """``rows`` of ``transformed`` with digests of the output and of the text restored from it in place of its frames.

    Frames are streamed in order, one at a time, so no whole text is put together.
    """
    return _mapped(
        rows, ["output_sha256", "restored_sha256"], lambda frames, form: (digest(iter(Reader(frames))), digest(restored(frames, form)))
    )


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``transformed`` over the whole texts of ``docs``, whose frames are written to the shared folder first.

    Units are runs of white space with the signs that follow, and white space at the end. Columns
    other than id and text are ignored; an empty table gives no rows.
    """
    return transformed(materialize(stored(docs, id_col, text_col), "frames"), **options)
