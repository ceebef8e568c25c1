"""Token ids as flat binary files.

A part is three files: ``.ids`` (unsigned 16-bit when the vocabulary fits, else 32-bit, little-endian),
``.offsets`` (unsigned 64-bit, one more than documents, counted within the part) and ``.docs`` (signed 64-bit document
ids; the first ``n_null`` have none). Parts hold ascending ranges of document ids; ``manifest`` lists them with the
number of ids before each, a prefix sum over parts, so any document's place in the whole is base + offset.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relfeat.llm.common import LOWER_BYTES, byte_class, keyed, slices, small_batches, span_hashes, spans, stored, text_buffer
from relfeat.llm.files import create, mapped, qualified
from relfeat.session import fresh_dir

SPACE = byte_class((9, 13), (32, 32))
ASCII_LETTER = byte_class((65, 90), (97, 122))
ASCII_DIGIT = byte_class((48, 57))
ASCII_MARK = byte_class((33, 47), (58, 64), (91, 96), (123, 126))
# words of a-z and the letters U+00DF-U+00FF but the division sign: one piece, and its own normal form
PLAIN = re.compile("[a-zß-öø-ÿ]+")
PARTS = "part STRING, task INT, n_docs LONG, n_null LONG, n_tokens LONG, width INT"


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself when printable, else 256, 257, ..."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordEncoder:
    """Encode texts with a tokenizer that drops white space, each distinct piece of text only once per worker.

    Cutting at ASCII white space, between an ASCII letter and a following ASCII mark, and around ASCII digits changes
    nothing, because the tokenizer's own pattern always cuts there; ids of the pieces are looked up by 64-bit hash.
    Special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, end_id: int, limit: int = 3_000_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.end_id, self.limit = end_id, limit
        self.forget()

    def forget(self) -> None:
        self.known, self.at = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)
        self.pool = np.empty(1 << 20, np.uint32)
        self.used = 0

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, each row's closed by ``end_id``, and the number of ids of each row."""
        raw, rows = text_buffer(column)
        n_rows = len(rows) - 1
        data, starts, ends = pieces(raw, rows)
        hashes, index, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at, size = self.lookup(hashes, data, starts[index], ends[index])
        at, size = at[inverse], size[inverse]
        # every row ends with a piece of its own: the end id
        first = np.searchsorted(starts, rows[1:], side="left")
        size = np.insert(size, first, 1)
        at = np.insert(at, first, 0)
        out = self.pool[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        last = first + np.arange(n_rows)
        stops = np.cumsum(size)[last] if n_rows else np.empty(0, np.int64)
        out[stops - 1] = self.end_id
        return out, np.diff(stops, prepend=0)

    def lookup(self, hashes, data, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.limit:
            self.forget()
        spot = np.searchsorted(self.known, hashes)
        new = spot == len(self.known)
        new[~new] = self.known[spot[~new]] != hashes[~new]
        if new.any():
            self.learn(hashes[new], data.tobytes(), starts[new].tolist(), ends[new].tolist())
            spot = np.searchsorted(self.known, hashes)
        return self.at[spot], self.size[spot]

    def learn(self, hashes: np.ndarray, data: bytes, starts: list[int], ends: list[int]) -> None:
        found, rest = [None] * len(starts), []
        tokenize, letters = self.model.tokenize, self.letters
        for i, (s, e) in enumerate(zip(starts, ends)):
            word = data[s:e].decode()
            if PLAIN.fullmatch(word):
                found[i] = [t.id for t in tokenize(data[s:e].decode("latin-1").translate(letters))]
            else:
                rest.append((i, word))
        for (i, _), e in zip(rest, self.tokenizer.encode_batch_fast([w for _, w in rest], add_special_tokens=False)):
            found[i] = e.ids
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((x for ids in found for x in ids), np.uint32, int(size.sum()))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used : self.used + len(flat)] = flat
        at = self.used + np.cumsum(size) - size
        self.used += len(flat)
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.at, self.size = np.concatenate([self.at, at])[order], np.concatenate([self.size, size])[order]


def pieces(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes and the piece spans. A-Z before a non-ASCII byte stays: a combining mark may follow."""
    n = len(raw)
    if not n:
        return raw, np.empty(0, np.int64), np.empty(0, np.int64)
    plain_next = np.ones(n, bool)
    plain_next[:-1] = raw[1:] < 128
    plain_next[rows[1:][rows[1:] > 0] - 1] = True
    data = np.where(plain_next, LOWER_BYTES[raw], raw)
    digit, letter, mark = ASCII_DIGIT[raw], ASCII_LETTER[raw], ASCII_MARK[raw]
    plain = raw < 128
    cut = (letter[:-1] & mark[1:]) | (digit[:-1] & plain[1:]) | (plain[:-1] & digit[1:])
    return data, *spans(~SPACE[raw], np.concatenate([rows, np.flatnonzero(cut) + 1]))


_encoders: dict[tuple, WordEncoder] = {}


def encoder(path: str, end_id: int) -> WordEncoder:
    """One per worker process, so that what it has learned serves the next task."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = WordEncoder(path, end_id)
    return _encoders[path, end_id]


def write_token_ids(
    docs: DataFrame, out_dir: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every text, append ``end_id``, write parts in ascending doc_id order; return the manifest.

    NULL texts are empty (one id, the end); NULL ids come first; rows that repeat an id are ordered by a hash of their
    text and written one after the other. Without rows there are no parts. The manifest (part, task, n_docs, n_null,
    n_tokens, width, base) is stored in ``out_dir`` as well and names only files of attempts that succeeded.
    """
    small_batches(docs.sparkSession)
    out_dir = qualified(docs.sparkSession, out_dir)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task = encoder(tokenizer_path, end_id), TaskContext.get().partitionId()
        part, out, n_docs, n_null, n_tokens = f"{out_dir}/part-{task:06d}-{uuid.uuid4().hex}", None, 0, 0, 0
        for batch in slices(batches, "text"):
            if out is None:
                out = [create(part + x) for x in (".ids", ".offsets", ".docs")]
                out[1].write(np.zeros(1, "<u8").tobytes())
            ids, size = enc.encode(batch.column("text"))
            out[0].write(ids.astype(f"<u{enc.width}").tobytes())
            out[1].write((n_tokens + np.cumsum(size)).astype("<u8").tobytes())
            doc_ids = batch.column("doc_id")
            out[2].write(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            n_docs, n_null, n_tokens = n_docs + len(doc_ids), n_null + doc_ids.null_count, n_tokens + len(ids)
        if out is not None:
            for f in out:
                f.close()
            row = {"part": [part], "task": [task], "n_docs": [n_docs], "n_null": [n_null], "n_tokens": [n_tokens], "width": [enc.width]}
            types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types)], list(row))

    ordered = keyed(docs, id_col, text_col)
    ordered = ordered.repartitionByRange("doc_id", "text_key").sortWithinPartitions("doc_id", "text_key")
    parts = stored(ordered.mapInArrow(write, PARTS), "token-parts")
    # one line per part: the prefix sum over parts
    base = "coalesce(sum(n_tokens) OVER (ORDER BY task ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    manifest = parts.selectExpr("*", f"{base} AS base")
    manifest.write.parquet(f"{out_dir}/manifest")
    return docs.sparkSession.read.schema(manifest.schema).parquet(f"{out_dir}/manifest")


def read_token_ids(spark: SparkSession, out_dir: str, docs_at_once: int = 4096) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32 (of 32-bit ids). Files are mapped."""
    manifest = spark.read.parquet(f"{out_dir}/manifest")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            ids = np.frombuffer(mapped(row["part"] + ".ids"), f"<u{row['width']}")
            offsets = np.frombuffer(mapped(row["part"] + ".offsets"), "<u8").astype(np.int64)
            doc_ids = np.frombuffer(mapped(row["part"] + ".docs"), "<i8")
            for at in range(0, row["n_docs"], docs_at_once):
                ends = offsets[at : at + docs_at_once + 1]
                crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(ends, ends[1:])]
                null = np.arange(at, at + len(crc)) < row["n_null"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids[at : at + len(crc)], mask=null), pa.array(row["base"] + ends[:-1]), pa.array(np.diff(ends)), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    parts = max(manifest.count(), 1)
    return manifest.repartition(parts).mapInArrow(read, "doc_id LONG, start LONG, n_tokens LONG, ids_crc32 LONG")


def token_id_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write into a fresh shared folder and read back."""
    out_dir = fresh_dir(docs.sparkSession, "token-ids")
    write_token_ids(docs, out_dir, tokenizer_path, end_id)
    return read_token_ids(docs.sparkSession, out_dir).select(
        "doc_id", F.col("start").cast("long"), F.col("n_tokens").cast("long"), "ids_crc32"
    )
