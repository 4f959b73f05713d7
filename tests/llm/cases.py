"""Documents that operators must bear, and plain versions of small pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, label int, dropped string, lost_at string, text_hash string, other_id int, __lines int, digest string, score double"


def documents(spark: SparkSession, texts: list[tuple[int | None, str | None]]) -> DataFrame:
    """Documents with further columns whose names the operators use inside, nulls among them."""
    return spark.createDataFrame([(i, t, None, "d", None, "h", 1, None, "x", 0.5) for i, t in texts], SCHEMA)


def awkward(spark: SparkSession) -> DataFrame:
    """Null and empty texts, null ids, repeated rows, one very long text and one without a space."""
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
    return documents(
        spark,
        [
            (1, None),
            (2, ""),
            (3, " \n\t "),
            (4, "one"),
            (5, "two words"),
            (5, "two words"),
            (None, "an id is missing here, with enough words to compare"),
            (None, None),
            (7, long),
            (8, "x" * 70_000),
            (9, "naïve Ünïcode – 漢字 \U0001f600 and   no-break, 'tis it's"),
        ],
    )
