"""What the path of a landed object says about it.

A landed object is a file ``<zone>/<a>_<b>/<a>_<b>_<period>.parquet``, or a folder of that name
which a Spark job wrote (also as a partition folder, ``object=<name>``). ``source_date`` is
evaluated for every row read, so it cuts strings and uses no regular expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _folder_name(file_path: Column) -> Column:
    """Name of the folder that holds the file; empty for a bare file name."""
    last_two = F.substring_index(file_path, "/", -2)
    return F.when(F.contains(last_two, F.lit("/")), F.substring_index(last_two, "/", 1)).otherwise("")


def object_path(file_path: Column) -> Column:
    """Path of the object which a data file belongs to: the folder it lies in, if that is named as one."""
    folder = F.left(file_path, F.length(file_path) - F.length(F.substring_index(file_path, "/", -1)) - 1)
    return F.when(F.endswith(_folder_name(file_path), F.lit(".parquet")), folder).otherwise(file_path)


def object_name(path: Column) -> Column:
    return F.substring_index(F.substring_index(path, "/", -1), "=", -1)


def source_date(path: Column) -> Column:
    """Period of the object, from its path or that of a file in it: last ``_`` token before the suffix."""
    folder = _folder_name(path)
    name = F.when(F.endswith(folder, F.lit(".parquet")), folder).otherwise(F.substring_index(path, "/", -1))
    stem = F.substring_index(name, ".parquet", 1)
    return F.substring_index(F.substring_index(stem, "_", -1), ".", -1)


def dataset(name: Column) -> Column:
    """Data set of the object: first two ``_`` tokens of its name."""
    return F.substring_index(F.substring_index(name, ".", 1), "_", 2)


def file_of_url(url: Column) -> Column:
    return F.trim(F.substring_index(url, "/", -1))


def target_path(root: str, name: Column) -> Column:
    """Folder of an object in the production zone: ``<root>/<dataset>_parquet/<yyyy_MM>``."""
    period = F.substring_index(F.substring_index(name, ".", 1), "_", -1)
    return F.concat(F.lit(root.rstrip("/") + "/"), dataset(name), F.lit("_parquet/"), F.replace(period, F.lit("-"), F.lit("_")))


def plain_scheme(path: Column) -> Column:
    """``s3a://`` as ``s3://``."""
    return F.regexp_replace(path, "^s3a://", "s3://")
