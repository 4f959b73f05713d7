"""What has landed, what is wanted, and what is still to fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions import names
from tripmart.functions.time import month_bounds, month_label
from tripmart.session import temporary


def _listing_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings whose scans pack files by their number, not by their bytes."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if other.conf.isModifiable(key):
            other.conf.set(key, value)
    other.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 60))
    return other


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The landed objects under a folder: path, dataset, file_name, source_date, n_files, n_bytes.

    A listing only. The content column of the file source is not selected, so no file is opened, and
    files are put together in tasks by their number, whatever their size.
    """
    files = (
        _listing_session(spark).read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select(names.object_path(F.col("path")).alias("path"), "length")
    )
    name = names.object_name(F.col("path"))
    return (
        files.groupBy("path")
        .agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))
        .select(
            "path",
            names.dataset(name).alias("dataset"),
            name.alias("file_name"),
            names.source_date(F.col("path")).alias("source_date"),
            "n_files",
            "n_bytes",
        )
    )


def listing(spark: SparkSession, root: str) -> DataFrame:
    """``manifest`` with the latest time of change of each object's files, to be kept and compared with a later one."""
    files = (
        _listing_session(spark).read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select(names.object_path(F.col("path")).alias("path"), "length", "modificationTime", F.xxhash64("path", "length", "modificationTime").alias("state"))
    )
    name = names.object_name(F.col("path"))
    found = files.groupBy("path").agg(
        F.count("*").alias("n_files"),
        F.sum("length").alias("n_bytes"),
        F.max("modificationTime").alias("changed_at"),
        F.bit_xor("state").alias("state"),
    )
    return found.select(
        "path", names.dataset(name).alias("dataset"), name.alias("file_name"), names.source_date(F.col("path")).alias("source_date"),
        "n_files", "n_bytes", "changed_at", "state",
    )


def keep_listing(found: DataFrame, path: str) -> None:
    """Keep a listing as a table in place of the one before, which may be what it was compared with."""
    with temporary(found, "listing") as copy:
        copy.write.mode("overwrite").parquet(path)


def changes(now: DataFrame, kept: DataFrame) -> DataFrame:
    """Objects that differ from a kept listing: ``new``, ``republished`` under the same name, or ``gone``.

    An object is republished if any of its files has another name, length or time of change.
    """
    columns = ["path", "dataset", "file_name", "source_date"]
    before = kept.select(*[F.col(c).alias(f"kept_{c}") for c in (*columns, "state")])
    both = now.join(before, F.col("path") == F.col("kept_path"), "full")
    change = F.when(F.col("kept_path").isNull(), "new").when(F.col("path").isNull(), "gone").when(F.col("state") != F.col("kept_state"), "republished")
    return both.select(*[F.coalesce(c, f"kept_{c}").alias(c) for c in columns], change.alias("change")).filter("change is not null")


def run_grid(categories: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every category in every ``yyyy-MM`` from the first month to the last, given as DATE.

    The months are generated within each category's row, so the product needs neither a join nor a
    shuffle.
    """
    months = F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 MONTH"))).alias("first_day")
    grid = categories.withColumns({"first": first, "last": last}).select(*categories.columns, months)
    return grid.select(*categories.columns, month_label(F.col("first_day")).alias("month"))


def configured_grid(spark: SparkSession, categories: list[str], first_month: str, last_month: str) -> DataFrame:
    """The grid of the configured run."""
    rows = spark.createDataFrame([(c,) for c in categories], "category string")
    return run_grid(rows, F.lit(month_bounds(first_month)[0]), F.lit(month_bounds(last_month)[0]))


def wanted_files(links: DataFrame) -> DataFrame:
    """File name, dataset and source_date of linked files."""
    name = names.file_of_url(F.col("href"))
    return links.select(
        names.dataset(name).alias("dataset"), name.alias("file_name"), F.trim(F.col("href")).alias("href")
    )


def files_to_fetch(wanted: DataFrame, landed: DataFrame) -> DataFrame:
    """Wanted files which the manifest does not hold under their dataset and name."""
    return wanted.join(landed.select("dataset", "file_name"), ["dataset", "file_name"], "left_anti")


def resolve(wanted: DataFrame, landed: DataFrame) -> DataFrame:
    """First landed path whose name starts with each wanted ``file_name``; NULL if there is none.

    Every prefix of a landed name is a join key, which turns the prefix test into an equi-join: the
    rows grow with the listing, never with listing times wanted. Prefixes of lengths nobody asks
    for are dropped before the shuffle.
    """
    lengths = wanted.agg(F.array_sort(F.collect_set(F.length("file_name"))).alias("lengths"))
    prefixes = (
        landed.select("path", F.col("file_name").alias("name"), lengths.scalar().alias("lengths"))
        .select("path", "name", F.explode(F.filter("lengths", lambda n: n <= F.length("name"))).alias("n"))
        .select(names.plain_scheme(F.col("path")).alias("path"), F.substr("name", F.lit(1), F.col("n")).alias("file_name"))
        .groupBy("file_name")
        .agg(F.min("path").alias("path"))
    )
    return wanted.join(prefixes, "file_name", "left")
