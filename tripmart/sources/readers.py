"""Parquet scans, and one scan over monthly files whose schemas drifted apart."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions import names
from tripmart.functions.numeric import try_cast
from tripmart.functions.time import utc_instant
from tripmart.session import read_text
from tripmart.sources import footers
from tripmart.sources.landing import manifest

MERGE_CONFLICT = "CANNOT_MERGE_SCHEMAS"


class EmptySourceError(ValueError):
    """A source that must hold rows holds none."""


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise EmptySourceError(f"no rows in {what}")
    return df


def scan(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def scan_recursive(spark: SparkSession, *folders: str) -> DataFrame:
    """All files below the folders, with the columns in the files only.

    The scan goes to any depth and folder names give no columns, so ``source_date`` must be a
    column of the files. Columns that only some files have are kept.
    """
    return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*folders)


def object_paths(landed: DataFrame) -> list[str]:
    """Paths of the landed objects in order of their dataset and period; a list of names, not of data."""
    order = ["dataset", "source_date", "path"]
    return [row.path for row in landed.select(*order).orderBy(*order).toLocalIterator()]


def _agree(a: T.StructType, b: T.StructType) -> bool:
    types = {f.name.lower(): f.dataType.simpleString() for f in a}
    return all(types.get(f.name.lower(), f.dataType.simpleString()) == f.dataType.simpleString() for f in b)


def _union_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    known = {f.name.lower() for f in a}
    return T.StructType(list(a) + [f for f in b if f.name.lower() not in known])


def _is_merge_conflict(error: Exception) -> bool:
    """Whether the error, or one that caused it in a task, has the condition of a schema conflict."""
    if isinstance(error, PySparkException) and error.getCondition() == MERGE_CONFLICT:
        return True
    cause = getattr(error, "_origin", None) or getattr(error, "java_exception", None)
    while cause is not None:
        if cause.getClass().getSimpleName().startswith("Spark") and cause.getCondition() == MERGE_CONFLICT:
            return True
        cause = cause.getCause()
    # a failed task's cause reaches the driver as text only
    return f"[{MERGE_CONFLICT}]" in str(error)


def _merged_schema(spark: SparkSession, paths: list[str], recursive: bool = True) -> T.StructType | None:
    """Schema of all files together, merged by one distributed job; None if a column has two types."""
    reader = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", str(recursive).lower())
    try:
        return reader.parquet(*paths).schema
    except Exception as error:
        if _is_merge_conflict(error):
            return None
        raise


def _files(spark: SparkSession, path: str) -> list[str]:
    """The parquet files below one folder."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return [row.path for row in reader.load(path).select("path").orderBy("path").toLocalIterator()]


def schema_groups(spark: SparkSession, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Objects grouped so that within a group no column has two types, from all their footers.

    One job reads the footers of all files, however many objects there are and however their schemas alternate. An object
    whose own files differ is taken apart into these. Files in a store that only Spark can open are merged by Spark,
    see ``merged_groups``.
    """
    found = footers.by_schema(spark, paths) if footers.can_open(paths) else {}
    if not any(found.values()):
        return merged_groups(spark, paths)
    groups: list[tuple[T.StructType, list[str]]] = []
    group_of: dict[str, int] = {}
    schemas = {text: T.StructType.fromJson(json.loads(text)) for own in found.values() for text in own}

    def put(text: str, member: str) -> None:
        # a schema stays in its group, whose columns include its own from then on
        if text not in group_of:
            for at, (known, _) in enumerate(groups):
                if _agree(known, schemas[text]):
                    group_of[text] = at
                    break
            else:
                group_of[text] = len(groups)
                groups.append((schemas[text], []))
        at = group_of[text]
        if not groups[at][1] or groups[at][1][-1] != member:
            groups[at] = (_union_schema(groups[at][0], schemas[text]), [*groups[at][1], member])
        else:
            groups[at] = (_union_schema(groups[at][0], schemas[text]), groups[at][1])

    for path in paths:
        own = found[path]
        together = T.StructType([])
        for text in own:
            together = _union_schema(together, schemas[text]) if together is not None and _agree(together, schemas[text]) else None
            if together is None:
                break
        if len(own) > 1 and together is not None:
            schemas[together.json()] = together
            put(together.json(), path)
        elif own:
            for text, files in own.items():
                for member in [path] if len(own) == 1 else files:
                    put(text, member)
    return groups


def merged_groups(spark: SparkSession, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """``schema_groups`` by Spark's own merge of schemas.

    Usually that is one group, which Spark's schema merge tells in one job. Where it meets a conflict,
    the list, which is in order of the period, is halved, so the jobs grow with the number of schema
    changes and the logarithm of the number of objects. An object whose own files differ is taken
    apart into these.
    """
    merged = _merged_schema(spark, paths)
    if merged is not None:
        return [(merged, paths)]
    if len(paths) == 1:
        files = _files(spark, paths[0])
        if len(files) < 2:
            raise ValueError(f"the schema of {paths[0]} cannot be read")
        paths = files
    half = len(paths) // 2
    groups = merged_groups(spark, paths[:half])
    for schema, members in merged_groups(spark, paths[half:]):
        for i, (known, others) in enumerate(groups):
            if _agree(known, schema):
                groups[i] = (_union_schema(known, schema), others + members)
                break
        else:
            groups.append((schema, members))
    return groups


def _casts(schemas: list[T.StructType], targets: dict[str, str]) -> dict[str, str]:
    """Cast target of every column that needs one, by lower-case name.

    Columns that are numeric everywhere are left to the union, which widens them, and timestamps of
    two kinds are made instants. Any other clash ends in text.
    """
    seen: dict[str, list[T.DataType]] = {}
    for schema in schemas:
        for field in schema:
            seen.setdefault(field.name.lower(), []).append(field.dataType)
    casts = {name.lower(): target for name, target in targets.items()}
    for name, types in seen.items():
        clash = len({t.simpleString() for t in types}) > 1
        times = all(isinstance(t, (T.TimestampType, T.TimestampNTZType)) for t in types)
        numbers = all(isinstance(t, T.NumericType) for t in types)
        if name not in casts and clash and not times and not numbers:
            casts[name] = "string"
    return casts


def read_objects(
    spark: SparkSession, paths: list[str], targets: dict[str, str] | None = None, with_source: bool = True
) -> DataFrame:
    """One DataFrame over objects of differing schemas, with the path of each row's file as ``data_source``.

    Each schema group is one scan with its own schema; the union matches columns by name without
    regard to case, fills missing ones with NULL and widens numbers. ``targets`` names columns to
    cast, NULL where the value does not fit.
    """
    groups = schema_groups(spark, paths)
    casts = _casts([schema for schema, _ in groups], targets or {})
    instants = {f.name.lower() for schema, _ in groups for f in schema if isinstance(f.dataType, T.TimestampType)}
    parts = []
    for schema, members in groups:
        raw = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*members)

        def column(field: T.StructField, raw: DataFrame = raw) -> Column:
            name = field.name.lower()
            if name in casts:
                return try_cast(F.col(field.name), casts[name]).alias(field.name)
            if name in instants and isinstance(field.dataType, T.TimestampNTZType):
                return utc_instant(raw, field.name).alias(field.name)
            return F.col(field.name)

        source = [F.col("_metadata.file_path").alias("data_source")] if with_source else []
        parts.append(raw.select(*[column(f) for f in raw.schema], *source))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_landed(
    spark: SparkSession, root: str, dataset: str | None = None, targets: dict[str, str] | None = None
) -> DataFrame:
    """The landed objects under a folder, all or those of one dataset."""
    landed = manifest(spark, root)
    if dataset is not None:
        landed = landed.filter(F.col("dataset") == dataset)
    paths = object_paths(landed)
    if not paths:
        raise EmptySourceError(f"no landed objects of {dataset or 'any dataset'} under {root}")
    return read_objects(spark, paths, targets)


#: A zone's record of its columns, which Spark's readers pass over.
RECORD = "_schema.json"


def recorded_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The one schema that all months of a zone have, as its last writer recorded it; None without a record."""
    text = read_text(spark, f"{path.rstrip('/')}/{RECORD}")
    return None if text is None else T.StructType.fromJson(json.loads(text))


def zone_groups(spark: SparkSession, path: str, by: str = "source_date") -> list[tuple[T.StructType, list[str]]]:
    """The folders of a zone grouped by schema, as ``schema_groups`` does with objects.

    A zone that keeps a record of its schema is one group, and no footer of its history is read.
    """
    known = recorded_schema(spark, path)
    if known is not None:
        return [(known, [path])]
    if footers.can_open([path]):
        own = footers.by_schema(spark, [path])[path]
        folders = [name for files in own.values() for name in re.findall(r"/(\w+)=", files[0][len(footers.plain_path(path)) :])]
        together = T.StructType([])
        for text in own:
            schema = T.StructType.fromJson(json.loads(text))
            if not _agree(together, schema):
                return schema_groups(spark, partition_folders(spark, path, by))
            together = _union_schema(together, schema)
        if own:
            named = T.StructType([T.StructField(name, T.StringType()) for name in dict.fromkeys(folders)])
            return [(_union_schema(together, named), [path])]
    merged = _merged_schema(spark, [path], recursive=False)
    return [(merged, [path])] if merged is not None else schema_groups(spark, partition_folders(spark, path, by))


def read_zone(spark: SparkSession, path: str, by: tuple[str, ...] = ("source_date",)) -> DataFrame:
    """A zone folder, usually partitioned by ``source_date``, with that column as the string it was written as.

    Months written by different runs may differ in schema; they are grouped as landed objects are.
    ``by`` names the folder levels, the last one telling the runs apart. A schema names them strings: a
    type guessed from the folder names would take ``2023-01`` for a date.
    """
    groups = zone_groups(spark, path, by[-1])
    texts = _casts([schema for schema, _ in groups], {})
    instants = {f.name for schema, _ in groups for f in schema if isinstance(f.dataType, T.TimestampType)}
    parts = []
    for schema, members in groups:
        columns = T.StructType([f for f in schema if f.name not in by])
        for name in by:
            if name in schema.names or any(f"/{name}=" in m for m in members):
                columns = columns.add(name, "string")
        raw = spark.read.schema(columns).option("basePath", path).parquet(*members)
        casts = {c: F.col(c).cast(texts[c.lower()]) for c in raw.columns if c.lower() in texts}
        casts |= {f.name: utc_instant(raw, f.name) for f in raw.schema if f.name in instants and isinstance(f.dataType, T.TimestampNTZType)}
        parts.append(raw.withColumns(casts))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def partition_folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """The ``column=value`` folders below a folder, and the files that lie in none."""
    folder = F.regexp_extract("path", f"^(.*/{column}=[^/]*)/", 1)
    found = manifest(spark, path).select(F.when(folder != "", folder).otherwise(F.col("path")).alias("folder"))
    return [row.folder for row in found.distinct().orderBy("folder").toLocalIterator()]


def schema_report(spark: SparkSession, root: str) -> DataFrame:
    """Types of every column over time: dataset, column, type, first and last month, objects.

    A column with two rows changed its type; one with fewer objects than its dataset is missing
    from some. One job reads the footers, and no data.
    """
    told = footers.footers(spark, footers.files_of(spark, [root]))
    columns = told.select(names.object_path(F.col("path")).alias("path"), F.explode("columns").alias("c"))
    columns = columns.select("path", F.lower("c.name").alias("column_name"), F.col("c.type").alias("type")).distinct()
    name = names.object_name(F.col("path"))
    return (
        columns.select("column_name", "type", names.dataset(name).alias("dataset"), names.source_date(F.col("path")).alias("source_date"))
        .groupBy("dataset", "column_name", "type")
        .agg(
            F.min("source_date").alias("first_month"),
            F.max("source_date").alias("last_month"),
            F.count("*").alias("n_objects"),
        )
    )


def column_profile(spark: SparkSession, root: str) -> DataFrame:
    """Per dataset, month and column: type, rows, nulls and files, from the footers alone.

    ``n_nulls`` is null where a file does not tell. A column that an object lacks has no row there.
    """
    told = footers.footers(spark, footers.files_of(spark, [root]))
    path = names.object_path(F.col("path"))
    columns = told.select(path.alias("path"), "n_rows", F.explode("columns").alias("c"))
    by = [names.dataset(names.object_name(F.col("path"))).alias("dataset"), names.source_date(F.col("path")).alias("source_date")]
    found = columns.groupBy(*by, F.lower("c.name").alias("column_name"), F.col("c.type").alias("type")).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("c.n_nulls").alias("told"), F.count_if(F.col("c.n_nulls").isNull()).alias("silent"), F.count("*").alias("n_files"),
    )
    return found.withColumn("n_nulls", F.when(F.col("silent") == 0, F.col("told"))).drop("told", "silent")
