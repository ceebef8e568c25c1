"""Wide results per key, computed one slice of the keys after the other.

The partial states of a block of a hundred aggregates are many times as large as the rows they come from, and the shuffle
files of all blocks of a plan lie on disk together until it ends. Here only those of one slice of one block do.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relfeat.session import fresh_dir, owned, released, shuffles_freed

# Rows are dealt into this many slices; a step takes as many of them as stay within the bytes, one at least.
SLICES = 16
SLICE_BYTES = 64 << 20

Block = Callable[[DataFrame], DataFrame]


def input_bytes(df: DataFrame) -> int:
    """The size of what a plan reads, a table as often as it is read; very large where it is not known."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def _write(df: DataFrame, path: str, *by: str) -> None:
    df.write.option("compression", "zstd").mode("append").partitionBy(*by).parquet(path)


def dealt(df: DataFrame, key: str, slice_bytes: int | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """Store the rows once, dealt by a hash of the key: all of them, and the same in frames of about ``slice_bytes``, of
    which each has whole keys. Rows without a key are one key's."""
    spark, limit = df.sparkSession, SLICE_BYTES if slice_bytes is None else slice_bytes
    path = fresh_dir(spark, "slices")
    owned(path)
    # not the hash that deals rows to partitions, or a slice would fill only some of them
    _write(df.withColumn("__slice", F.expr(f"pmod(xxhash64({key}), {SLICES})")), path, "__slice")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    steps: list[list[str]] = []
    room = 0
    for i in range(SLICES):
        at = f"{path}/__slice={i}"
        if files.exists(spark._jvm.org.apache.hadoop.fs.Path(at)):
            size = files.getContentSummary(spark._jvm.org.apache.hadoop.fs.Path(at)).getLength()
            if not steps or size > room:
                steps.append([])
                room = limit
            steps[-1].append(at)
            room -= size
    read = spark.read.schema(df.schema)
    frames = [read.parquet(*paths) for paths in steps or [[path]]]
    return read.parquet(*([at for paths in steps for at in paths] or [path])), frames


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``make``, stored; shuffle files and other tables stored on the way are deleted."""
    path = fresh_dir(spark, "block")
    owned(path)
    with shuffles_freed(spark), released(spark):
        result = make()
        _write(result, path)
    return spark.read.schema(result.schema).parquet(path)


def by_slices(
    df: DataFrame, key: str, inner: str, fit: Callable[[DataFrame], Sequence[Block]], slice_bytes: int | None = None
) -> list[DataFrame]:
    """The stored results of the blocks that ``fit`` makes after a look at all rows, each with one row per key.

    The rows of a slice are cut by range of (key, inner), by Spark's own sample of that order, before a block gets them: the
    states of a key meet in one task instead of many, and a key with very many rows is cut at its ``inner``. The cuts balance the
    work; no result depends on them. Shuffle files and stored tables of a step go with the step, the dealt rows at the end.
    """
    spark, schemas = df.sparkSession, []
    path = fresh_dir(spark, "blocks")
    owned(path)
    with shuffles_freed(spark), released(spark):
        rows, frames = dealt(df, key, slice_bytes)
        for i, block in enumerate(fit(rows)):
            for frame in frames:
                with released(spark):
                    result = block(frame.repartitionByRange(key, inner))
                    _write(result, f"{path}/{i}")
            schemas.append(result.schema)
    return [spark.read.schema(schema).parquet(f"{path}/{i}") for i, schema in enumerate(schemas)]
