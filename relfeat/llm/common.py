"""What the operators share: durable intermediate tables, row keys, dropping rows, scanning words in Arrow batches.

Meaning of edge cases, for every operator of this package unless its docstring says otherwise: a NULL text counts as
the empty text, a NULL id is an id of its own that never wins a comparison, rows that repeat an id and its text are
one document and share their fate, an empty table gives an empty result, and columns of the input that an operator
does not need may have any names, those of its own columns included.
"""

from __future__ import annotations

import ctypes
import gc
import io
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relfeat.llm.files import create, qualified
from relfeat.session import fresh_dir

# A table is broadcast only after its rows were counted and found to be at most this many (narrow rows of ids).
BROADCAST_ROWS = 1_000_000
# bits of a bitmap of hashed ids for each of them, and at most in all (8 MB)
BITS_EACH, MOST_BITS = 32, 1 << 26
# Bytes of text that a Python worker scans at once; one longer text is a slice of its own.
SLICE_BYTES = 2 << 20
ROWS_PER_BATCH = 1_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Compute once into the shared folder and read back: lineage ends there, and the planner learns the true size."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, through the shared folder."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    where = qualified(spark, f"{fresh_dir(spark, 'package')}/relfeat-package.zip")
    with create(where) as f:
        f.write(packed.getvalue())
    sc.addPyFile(where)
    _shipped.add(sc.applicationId)


def small_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Before Python tasks: send the package, and bound the Arrow batches by rows, since a row may be long; a smaller
    setting of the session stays."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    set_to = int(spark.conf.get(key))
    if set_to <= 0 or set_to > rows:
        spark.conf.set(key, rows)


def whole(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does that on pure ASCII, and much faster than ``translate``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, text``: what identifies a row, whatever else the table holds."""
    text = whole(F.col(f"`{text_col}`"))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def bounded(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored table for broadcast when its counted rows are within the limit, else leave the choice to Spark."""
    return F.broadcast(df) if df.count() <= limit else df


def without(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose (id, text) is not in ``dropped`` (``doc_id, text_key``); all columns stay."""
    gone = bounded(stored(dropped.select("doc_id", "text_key").distinct(), "dropped"))
    key = F.xxhash64(whole(docs[f"`{text_col}`"]))
    same = docs[f"`{id_col}`"].cast("long").eqNullSafe(gone["doc_id"]) & (key == gone["text_key"])
    return docs.join(gone, same, "left_anti")


def likely(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``column`` is among ``ids`` (a stored table of one column), and about one in a thousand of the others:
    two bitmaps of hashed ids are broadcast, so ``rows`` does not move. Past ``MOST_BITS`` more of the others stay."""
    (name,) = ids.columns
    bits = min(max(ids.count() * BITS_EACH, 1), MOST_BITS)
    for seed in range(2):
        at = F.pmod(F.xxhash64(F.col(name), F.lit(seed)), F.lit(bits))
        places = ids.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("at")).repartition("bucket")
        maps = stored(places.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")), "bitmaps")
        own = F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(bits))
        place = F.bitmap_bit_position(own)
        byte = F.conv(F.hex(F.substring(maps["bits"], (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
        there = F.getbit(byte, (place % 8).cast("int")) == 1
        rows = rows.join(F.broadcast(maps), (F.bitmap_bucket_number(own) == maps["bucket"]) & there, "left_semi")
    return rows


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds at most ``limit`` bytes, or a single row."""
    for batch in batches:
        ends = np.cumsum(np.diff(text_buffer(batch.column(column))[1]))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, before + limit, side="right")), at + 1)
            yield batch.slice(at, to - at)
            at = to
    give_back()


def give_back() -> None:
    """At the end of a Python task: return freed memory to the system, and the tables of powers. A worker stays for later
    tasks, and what it keeps counts beside the memory of whatever runs next."""
    _powers.update(up=np.ones(1, np.uint64), down=np.ones(1, np.uint64))
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows in them; NULL is empty."""
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = column.cast(pa.large_string())
    _, offsets, data = wide.buffers()
    offsets = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    if data is None:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


# 64-bit polynomial hashing modulo 2**64: odd base and its inverse, so that a substring's hash is a difference of sums
BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**j`` and ``BASE**-j`` for j < n, kept for the next slice of this worker."""
    if len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Finish a hash so that all its bits depend on all bits (multiply and shift twice)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


LOWER_BYTES = np.arange(256, dtype=np.uint8)
LOWER_BYTES[65:91] += 32


class Words:
    """Words of the rows of a batch: byte spans in ``data``, row of each word, first word of each row, 64-bit hashes."""

    def __init__(self, column: pa.Array, in_word: np.ndarray):
        raw, rows = text_buffer(column)
        self.data = LOWER_BYTES[raw]
        self.starts, self.ends = spans(in_word[self.data], rows)
        self.first = np.searchsorted(self.starts, rows)  # rows + 1 entries
        self.row = np.repeat(np.arange(len(rows) - 1), np.diff(self.first))
        self.hashes = span_hashes(self.data, self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def spans(inside: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside``, cut at the row offsets."""
    n = len(inside)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[rows] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:n]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` consecutive words, by position of the first; the caller drops those that leave their row."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = (out + hashes[k : len(hashes) - n + 1 + k]) * np.uint64(BASE)
        out ^= out >> np.uint64(29)
    return mixed(out)
