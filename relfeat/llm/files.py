"""Files that tasks write and read themselves, in the shared folder, through the file system its address names."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The address with its scheme, so that an executor resolves it as the driver does."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def located(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def create(path: str) -> pa.NativeFile:
    """Open for writing; attempts use names of their own, so a file of a lost attempt is never read."""
    system, name = located(path)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    return system.open_output_stream(name)


def mapped(path: str) -> pa.Buffer:
    """The file's bytes: memory-mapped where it lies in a mounted folder, otherwise read."""
    system, name = located(path)
    if isinstance(system, fs.LocalFileSystem):
        if system.get_file_info(name).size == 0:
            return pa.py_buffer(b"")
        return pa.memory_map(name).read_buffer()
    with system.open_input_file(name) as f:
        return f.read_buffer()


def stream(path: str) -> pa.NativeFile:
    system, name = located(path)
    return system.open_input_stream(name)
