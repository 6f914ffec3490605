"""Files that tasks write into a shared folder: temporary names, atomic renames,
and a manifest that lists what was committed."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyarrow import fs as pafs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with scheme and host.  Spark takes a path without scheme from the
    default filesystem; tasks are to write where it reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """Arrow filesystem and plain path of a folder given as a URI; a path without
    scheme is local (jobs qualify theirs before)."""
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), os.path.abspath(folder)
    return pafs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder)


@contextmanager
def committed(folder: str, name: str):
    """Open ``folder/name`` for writing under a temporary name; rename when done.  An
    attempt that dies leaves only its temporary file, a repeated one replaces the
    same bytes."""
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    temp = f"{root}/_{name}.{uuid.uuid4().hex}.tmp"
    try:
        with fs.open_output_stream(temp) as out:
            yield out
        fs.move(temp, f"{root}/{name}")
    except BaseException:
        if fs.get_file_info(temp).type != pafs.FileType.NotFound:
            fs.delete_file(temp)
        raise


def open_input(folder: str, name: str):
    """Random-access input; a local file is memory-mapped."""
    fs, root = filesystem(folder)
    if isinstance(fs, pafs.LocalFileSystem):
        import pyarrow as pa

        return pa.memory_map(f"{root}/{name}")
    return fs.open_input_file(f"{root}/{name}")
