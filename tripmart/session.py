"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
OVERWRITE_OPTION = "partitionOverwriteMode"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
#: Months that a task writes side by side; if it meets more, it sorts the rows that are left.
OPEN_MONTHS = 200
MB = 1024 * 1024


def build_session(app: str = "tripmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs assume.

    AQE joins small shuffle partitions and splits skewed ones, so their initial number only has to
    be large enough for the biggest shuffle; see ``sized_conf``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(OVERWRITE_MODE, "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_conf(input_bytes: int) -> dict[str, str]:
    """Partition settings for ``build_session`` by the bytes of the largest input.

    Scan tasks read 128 MB, or more where that would make over 200 000 tasks. The widest shuffle is
    that of the repeated-row rule, which moves its key columns, about an eighth of the input, in
    partitions of 128 MB. Beyond 50 000 of them, which 50 TB take, the blocks of a shuffle (tasks times
    partitions) cost more than larger partitions, which are sorted on disk. AQE joins the partitions
    of smaller shuffles.
    """
    scan = max(128 * MB, -(-input_bytes // 200_000))
    shuffle = min(max(200, input_bytes // 8 // (128 * MB)), 50_000)
    return {"spark.sql.files.maxPartitionBytes": str(scan), "spark.sql.shuffle.partitions": str(shuffle)}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's checkpoint folder, which every executor can reach.

    Only a local session, where driver and executors are one process, may fall back to a
    temporary folder of the machine.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tripmart-")
    return f"{root.rstrip('/')}/tripmart/{name}-{uuid.uuid4().hex}"


_writing: dict[str, tuple[int, str | None]] = {}
_writing_lock = threading.Lock()


@contextmanager
def months_side_by_side(spark: SparkSession) -> Iterator[None]:
    """Within the block, tasks write the months they meet into files that are open at a time, without sorting their rows.

    A sort would hold all rows of a task, wide as they are with the path of their file, before the first is
    written. There is no option of a writer for it, so the session's setting is changed while any
    block is open, and comes back with the last one; a value that the session has is left as it is.
    """
    session = spark._jsparkSession.sessionUUID()
    with _writing_lock:
        blocks, before = _writing.get(session, (0, None))
        if not blocks:
            before = spark.conf.get(OPEN_FILES, None)
            if before in (None, "0"):
                spark.conf.set(OPEN_FILES, str(OPEN_MONTHS))
        _writing[session] = (blocks + 1, before)
    try:
        yield
    finally:
        with _writing_lock:
            blocks, before = _writing.pop(session)
            if blocks > 1:
                _writing[session] = (blocks - 1, before)
            elif before is None:
                spark.conf.unset(OPEN_FILES)
            elif before == "0":
                spark.conf.set(OPEN_FILES, before)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder that a job of this package wrote, through the file system that it lies in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _hadoop(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    system, place = _hadoop(spark, path)
    return system.exists(place)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    system, place = _hadoop(spark, path)
    system.create(place, True).close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as text; None where there is none."""
    system, place = _hadoop(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place of one of its name."""
    system, place = _hadoop(spark, path)
    stream = system.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below one; none where it does not exist."""
    system, place = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory()) if system.exists(place) else []


_kept: dict[str, list[str]] = {}


def clear_scratch(spark: SparkSession) -> int:
    """Delete what ``materialize`` has written in this application, once its results have been used; returns the folders."""
    paths = _kept.pop(spark.sparkContext.applicationId, [])
    return sum(delete_folder(spark, path) for path in paths)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the optimizer the true size
    of the result: a join with it is broadcast only if that size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and is a shuffle join otherwise. The caller may read the
    result at any time, so it stays until ``clear_scratch``.
    """
    path = scratch_dir(df.sparkSession, name)
    _kept.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back, until the block that uses it is left."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(df.sparkSession, path)
