"""Byte-level BPE by a tree reduction over spans of text.

An encoded span is its text and ids; spans join associatively. To join two neighbours, a window around the seam is
encoded again: it grows on each side, doubling, until it ends at a stable place or at the end of its span. A place is
stable when every match of the split pattern, in any surrounding text, ends there: before white space that follows
something else, between a letter and a digit, after a letter or digit before another sign, and before a digit after a
sign. No match reaches across such a place and the matches before it do not look past it, so ids outside the window
are those of the whole text. Texts are halved down to ``LEAF`` characters; decoding joins bytes up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from relfeat.llm.common import keyed, slices, small_batches

LEAF = 8192
# bytes of text whose ids, as Python numbers, are in memory at once
SLICE = 256 << 10
SIGN = r"[^\p{White_Space}\p{L}\p{N}]"
STABLE = regex.compile(
    r"(?<=\P{White_Space})(?=\p{White_Space})|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})"
    rf"|(?<=[\p{{L}}\p{{N}}])(?={SIGN})|(?<={SIGN})(?=\p{{N}})"
)
WINDOW = 32
SCHEMA = "doc_id LONG, text_key LONG, n_tokens LONG, ids_sha256 STRING, decoded_sha256 STRING"


class TreeEncoder:
    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def leaf(self, text: str) -> list[int]:
        return self.bpe.encode_ordinary(text)

    def encode(self, text: str, leaf: int = LEAF) -> list[int]:
        if len(text) <= leaf:
            return self.leaf(text)
        mid = len(text) // 2
        return self.join(text[:mid], self.encode(text[:mid], leaf), text[mid:], self.encode(text[mid:], leaf))

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        l, r = stable_before(left), stable_after(right)
        again = self.leaf(left[l:] + right[:r])
        keep = len(left_ids) - len(self.leaf(left[l:]))
        drop = len(self.leaf(right[:r]))
        left_ids[keep:] = again
        left_ids += right_ids[drop:]
        return left_ids

    def decode(self, ids: list[int], leaf: int = LEAF) -> bytes:
        if len(ids) <= leaf:
            return self.bpe.decode_bytes(ids)
        mid = len(ids) // 2
        return self.decode(ids[:mid], leaf) + self.decode(ids[mid:], leaf)


def stable_before(text: str) -> int:
    """The last stable place that lies at least a little before the end of ``text``, or 0."""
    size = WINDOW
    while size < len(text):
        found = STABLE.search(text, len(text) - size, len(text) - 1)
        if found:
            return found.start()
        size *= 2
    return 0


def stable_after(text: str) -> int:
    """The first stable place in ``text`` after its start, or its end."""
    found = STABLE.search(text, 1)
    return found.start() if found else len(text)


_encoders: dict[tuple, TreeEncoder] = {}


def encoder(ranks_path: str, pattern: str) -> TreeEncoder:
    if (ranks_path, pattern) not in _encoders:
        _encoders[ranks_path, pattern] = TreeEncoder(ranks_path, pattern)
    return _encoders[ranks_path, pattern]


def encode_and_decode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF,
    with_ids: bool = True,
) -> DataFrame:
    """One row per document: doc_id, text_key, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256,
    and unless ``with_ids`` is off the ids.

    NULL texts are empty (no ids). Special tokens do not exist: their strings are text. No shuffle: a text is reduced
    where it is read, its leaves bound what is encoded at once.
    """
    small_batches(docs.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_path, pattern)
        for batch in slices(batches, "text", SLICE):
            all_ids = [enc.encode(t, leaf) for t in batch.column("text").to_pylist()]
            ids_sha = [hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() for ids in all_ids]
            text_sha = [hashlib.sha256(enc.decode(ids, leaf)).hexdigest() for ids in all_ids]
            out = {
                "doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"),
                "n_tokens": pa.array([len(ids) for ids in all_ids], pa.int64()),
                "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string()),
            }
            if with_ids:
                out["ids"] = pa.array(all_ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    return keyed(docs, id_col, text_col).mapInArrow(run, SCHEMA + ", ids ARRAY<INT>" * with_ids)
