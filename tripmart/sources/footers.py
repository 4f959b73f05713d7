"""What the footers of parquet files tell, as a table made by one job over the list of files."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

#: Schemes that a task can open by itself; files elsewhere are left to Spark's own merge of schemas.
SCHEMES = {"": None, "file": None, "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}
#: Where Spark's writer keeps the schema of the rows it wrote.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
FILES_PER_TASK = 64
COLUMNS = "array<struct<name:string,type:string,n_nulls:bigint,lowest:string,highest:string>>"


def scheme_of(path: str) -> str:
    found = re.match(r"^(\w[\w+.-]*):", path)
    return found.group(1).lower() if found else ""


def plain_path(path: str) -> str:
    """A path without its scheme, by which the same file is known under ``/x``, ``file:/x`` and ``file:///x``."""
    return re.sub(r"^\w[\w+.-]*:/*(?=/)", "", path).rstrip("/")


def can_open(paths: list[str]) -> bool:
    return all(scheme_of(path) in SCHEMES for path in paths)


def _metadata(path: str) -> pa.parquet.FileMetaData:
    scheme = SCHEMES[scheme_of(path)]
    if scheme is None:
        return pa.parquet.read_metadata(plain_path(path))
    system, place = pa.fs.FileSystem.from_uri(re.sub(r"^\w+(?=:)", scheme, path))
    return pa.parquet.read_metadata(place, filesystem=system)


def schema_of(found: pa.parquet.FileMetaData) -> T.StructType:
    """The schema as Spark infers it: its own record of it, or the columns' types."""
    known = (found.metadata or {}).get(SPARK_SCHEMA)
    if known is not None:
        return T.StructType.fromJson(json.loads(known))
    old_times = {c.path for c in map(found.schema.column, range(found.num_columns)) if c.physical_type == "INT96"}
    return T.StructType(
        [
            T.StructField(f.name, T.TimestampType() if f.name in old_times else from_arrow_type(f.type, prefer_timestamp_ntz=True))
            for f in found.schema.to_arrow_schema()
        ]
    )


def _columns(found: pa.parquet.FileMetaData, schema: T.StructType) -> list[dict]:
    """Type, nulls and range of each top-level column; what a row group does not tell is null."""
    told: dict[str, list] = {}
    for group in range(found.num_row_groups):
        for at in range(found.num_columns):
            column = found.row_group(group).column(at)
            told.setdefault(column.path_in_schema, []).append(column.statistics)
    rows = []
    for field in schema:
        own = told.get(field.name, [])
        nulls = [s.null_count if s is not None and s.has_null_count else None for s in own]
        # the twelve bytes of old timestamps have no order
        ranges = [s for s in own if s is not None and s.physical_type != "INT96" and s.has_min_max]
        complete = len(ranges) == len(own) and ranges
        rows.append(
            {
                "name": field.name,
                "type": field.dataType.simpleString(),
                "n_nulls": None if None in nulls or not nulls else sum(nulls),
                "lowest": str(min(s.min for s in ranges)) if complete else None,
                "highest": str(max(s.max for s in ranges)) if complete else None,
            }
        )
    return rows


def files_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path`` of the parquet files at and below the paths: a listing, no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return reader.load(paths).select("path")


def footers(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``path, schema, n_rows, columns`` of each file: schema as JSON, row count, and every column's type, nulls and range.

    One job, whose tasks read the footers of ``FILES_PER_TASK`` files each and no data.
    """
    tasks = max(1, -(-files.count() // FILES_PER_TASK))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                found = _metadata(path)
                schema = schema_of(found)
                rows.append((path, schema.json(), found.num_rows, _columns(found, schema)))
            yield pd.DataFrame(rows, columns=["path", "schema", "n_rows", "columns"])

    return files.repartition(tasks).mapInPandas(read, f"path string, schema string, n_rows bigint, columns {COLUMNS}")


def by_schema(spark: SparkSession, paths: list[str]) -> dict[str, dict[str, list[str]]]:
    """For each of the paths, the schemas of the files at and below it, as JSON, and those files.

    The names of the files and each different schema are what the driver gets.
    """
    found: dict[str, dict[str, list[str]]] = {path: {} for path in paths}
    known = {plain_path(path): path for path in paths}
    grouped = footers(spark, files_of(spark, paths)).groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("files"))
    for row in sorted(grouped.toLocalIterator(), key=lambda r: r.schema):
        for file in row.files:
            place = plain_path(file)
            while place not in known:
                place = place.rsplit("/", 1)[0]
            found[known[place]].setdefault(row.schema, []).append(file)
    return found
