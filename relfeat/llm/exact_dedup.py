"""Exact dedup by merging sorted digest runs up a tree.

Each partition of the input becomes a run: one line per distinct text, with its best id and number of rows, so a text
that fills a third of the table is one line per run. The stored runs are exchanged once, cut by ranges of the digest and
sorted in each cut. In each round the runs of ``fan_in`` neighbours merge: equal digests are adjacent in the merged
order, at most one line per run, the first (best) of them stays and takes over the number of rows. Two lines merge only if
SHA-256, length and a second hash of their texts agree. No task holds a whole run or more than ``fan_in`` lines of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relfeat.llm.common import ascii_lower, stored, whole

FINGERPRINT = ["digest", "n_bytes", "second"]


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", fan_in: int = 8
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty. ``keep`` chooses the ``smallest`` or
    ``largest`` id of a group. A NULL id stays only in a group without any other id. Rows that repeat both id and text
    are kept or dropped together. Nothing is broadcast unless Spark finds the stored groups small enough.
    """
    text = whole(F.col(f"`{text_col}`"))
    best = {"smallest": F.min, "largest": F.max}[keep]
    order = {"smallest": F.asc_nulls_last, "largest": F.desc_nulls_last}[keep]("keep_id")
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("raw"), ascii_lower(text).alias("normal")
    ).select(
        "doc_id",
        F.xxhash64("raw").alias("text_key"),
        F.unhex(F.sha2("normal", 256)).alias("digest"),
        F.octet_length("normal").cast("long").alias("n_bytes"),
        F.xxhash64("normal").alias("second"),
        F.spark_partition_id().alias("run"),
    )
    rows = stored(rows, "digests")
    runs = rows.groupBy("run", *FINGERPRINT).agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    runs = stored(runs.sortWithinPartitions("run", "digest"), "digest-runs").repartitionByRange("digest")
    n_runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    while n_runs > 1:
        runs = merged(runs.withColumn("run", F.expr(f"CAST(run DIV {fan_in} AS INT)")), order)
        n_runs = -(-n_runs // fan_in)
    groups = stored(runs.drop("run"), "digest-groups")
    return rows.join(groups, FINGERPRINT).select(
        "doc_id", "text_key", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def merged(runs: DataFrame, order: Column) -> DataFrame:
    """One line per run and text from lines cut by digest: the first in ``order``, with the rows of all."""
    same = Window.partitionBy(*FINGERPRINT, "run").orderBy(order)
    every = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lines = runs.sortWithinPartitions(*FINGERPRINT, "run", order)
    lines = lines.withColumns({"place": F.row_number().over(same), "group_size": F.sum("group_size").over(every)})
    return lines.where("place = 1").drop("place")
