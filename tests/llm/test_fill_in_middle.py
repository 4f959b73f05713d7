from __future__ import annotations

import hashlib
import re

import pytest
from cases import awkward, documents
from conftest import SF_DIR
from pyspark.sql import functions as F

from tripmart.llm import fill_in_middle, queries

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id: int | None, text: str | None) -> tuple:
    """The contract, word by word, and the output's text."""
    text = text or ""
    units = UNIT.findall(text)
    n, drawn = len(units), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[at : at + 8], 16) for at in range(0, 32, 8))
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:first]), "".join(units[first:second]), "".join(units[second:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text), text
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(prefix), len(middle), sha(out := f"<S>{suffix}<P>{prefix}<M>{middle}"), sha(text), out
    return doc_id, n, "psm", len(prefix), len(middle), sha(out := f"<P>{prefix}<S>{suffix}<M>{middle}"), sha(text), out


def test_whole_table_equals_the_contract(spark):
    texts = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op12_fill_in_middle(spark, SF_DIR)
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert [t for _, t in found.dtypes] == ["bigint", "bigint", "string", "bigint", "bigint", "string", "string"]
    assert sorted(map(tuple, found.collect())) == sorted(expected(i, t)[:-1] for i, t in texts)
    assert {r["form"] for r in found.select("form").distinct().collect()} == {"plain", "spm", "psm"}


@pytest.mark.parametrize("frame_bytes", [1, 7, 64, 1 << 16])
def test_frames_of_any_size(spark, frame_bytes):
    pieces = ["a", "é", "漢字", "\U0001f600", " ", "\t\n", "\x0b", "\x1c", " ", "<", "P>", "<P", "words and more words"]
    texts = [(i, "".join(pieces[(i * k * k + k) % len(pieces)] for k in range(i % 37))) for i in range(300)]
    texts += [(1000 + i, mark) for i, mark in enumerate(["<P> at the start", "in <S> it", "at the end <M>", " ", "\n\n", "one"])]
    docs = documents(spark, texts)
    found = fill_in_middle.texts(fill_in_middle.transformed(fill_in_middle.stored(docs, frame_bytes=frame_bytes)))
    again = fill_in_middle.digests(fill_in_middle.transformed(fill_in_middle.stored(docs, frame_bytes=frame_bytes)))
    both = found.join(again, "doc_id").select("doc_id", found.n, found.form, found.prefix_chars, found.middle_chars, "output_sha256", "restored_sha256", "text")
    assert sorted(map(tuple, both.collect())) == sorted(expected(i, t) for i, t in texts)


def test_only_cut_frames_are_opened(monkeypatch):
    text = " ".join(f"word{i}" for i in range(40_000)).encode()
    frames, units, chars = fill_in_middle.frames_of(text, 1 << 12)
    opened = []
    monkeypatch.setattr(fill_in_middle, "plain", lambda data, plain=fill_in_middle.plain: opened.append(data) or plain(data))
    output, prefix, middle = fill_in_middle.reordered(frames, chars, "psm", 9_000, 31_000)
    assert len(frames) > 50 and len(opened) == 2 and units == 40_000
    # all frames that no cut goes through are taken over as they are
    assert len({f["data"] for f in frames} - {f["data"] for f in output}) == 2
    assert prefix == len(" ".join(f"word{i}" for i in range(9_000)))


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = fill_in_middle.digests(fill_in_middle.fill_in_middle(docs)).collect()
    key = lambda row: tuple(str(v) for v in row)
    assert sorted(map(tuple, found), key=key) == sorted((expected(r["doc_id"], r["text"])[:-1] for r in docs.collect()), key=key)
    assert fill_in_middle.digests(fill_in_middle.fill_in_middle(docs.limit(0))).collect() == []


def test_ids_of_other_types(spark):
    docs = spark.range(5).select(F.concat(F.lit("d"), "id").alias("doc_id"), F.lit("one two three").alias("text"))
    found = fill_in_middle.digests(fill_in_middle.fill_in_middle(docs)).collect()
    assert {r["restored_sha256"] for r in found} == {sha("one two three")} and len(found) == 5
