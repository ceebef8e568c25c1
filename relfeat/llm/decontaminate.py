"""Benchmark decontamination as a prefix-filtered containment join.

Every benchmark item gives windows of ``window`` consecutive words (an item with fewer words is one window). A window
is contained in a document only if all its word shingles are, so it suffices to look for one: the rarest in the whole
corpus, its necessary prefix. Documents are scanned once to count the benchmark's shingles and once to find prefixes;
each find gives the one place where the window can start (positional bound), which must lie with all its words in the
document (length bound), and is then compared word by word, byte by byte.

The benchmark is cut into blocks of bounded bytes, each sent to all tasks; documents pass through one block after the
other without a shuffle, carrying the hits found so far.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfeat.llm.common import Words, byte_class, keyed, shingle_hashes, slices, small_batches, stored

# after lower-casing: digits, letters and everything beyond ASCII
WORD = byte_class((48, 57), (97, 122), (128, 255))
BLOCK_BYTES = 8 << 20
# blocks that a worker holds at once; what documents hit in them is stored after that
BLOCKS_AT_ONCE = 4
AT_ONCE = 1 << 20
CARRIED = "doc_id LONG, text_key LONG, text STRING, hit_from ARRAY<INT>, hit_to ARRAY<INT>, items ARRAY<STRING>"
RESULT = "doc_id LONG, text_key LONG, n_words LONG, n_hit LONG, n_items LONG, items_sha256 STRING, contaminated BOOLEAN"


class Windows:
    """The windows of one block of items and, once rarity is known, the prefix shingle of each."""

    def __init__(self, names: list[str], texts: pa.Array, window: int, shingle: int):
        self.names, self.words = names, Words(texts, WORD)
        first, n = self.words.first, self.words.counts()
        per_item = np.where(n > window, n - window + 1, np.minimum(n, 1))
        self.item = np.repeat(np.arange(len(names)), per_item)
        nth = np.arange(len(self.item)) - np.repeat(np.cumsum(per_item) - per_item, per_item)
        self.start = first[self.item] + nth
        self.size = np.minimum(n, window)[self.item]
        self.step = np.minimum(self.size, shingle)  # a window shorter than a shingle is its own shingle
        self.shingles = {int(s): shingle_hashes(self.words.hashes, int(s)) for s in np.unique(self.step)}
        used = [np.unique(self.shingles[s][self.spots(s)[1]]) for s in self.shingles]
        self.wanted = {s: u for s, u in zip(self.shingles, used)}

    def spots(self, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows with shingles of ``step`` words, repeated for each of their shingles, and where these start."""
        chosen = np.flatnonzero(self.step == step)
        count = self.size[chosen] - step + 1
        window = np.repeat(chosen, count)
        offset = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
        return window, self.start[window] + offset

    def choose(self, counts: dict[tuple[int, int], int]) -> None:
        """Order shingles by rarity (ties by hash) and keep the rarest of each window with its place in it."""
        self.prefix = {}
        for step in self.shingles:
            window, at = self.spots(step)
            hashes = self.shingles[step][at]
            seen = np.array([counts.get((step, int(h)), 0) for h in self.wanted[step].view(np.int64)], np.int64)
            rarity = seen[np.searchsorted(self.wanted[step], hashes)]
            order = np.lexsort((at, hashes, rarity, window))
            best = order[np.unique(window[order], return_index=True)[1]]
            # windows of the same prefix stand together
            best = best[np.argsort(hashes[best], kind="stable")]
            keys, begin = np.unique(hashes[best], return_index=True)
            self.prefix[step] = (Lookup(keys), np.append(begin, len(best)), window[best], at[best] - self.start[window[best]])


class Lookup:
    """Positions of hashes in a sorted table; most are refused by one bit each."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - max(16, min(24, int(len(keys)).bit_length() + 5)))
        self.maybe = np.zeros(1 << int(64 - self.shift), bool)
        self.maybe[keys >> self.shift] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices into ``hashes`` that are in the table, and where there."""
        at = np.flatnonzero(self.maybe[hashes >> self.shift])
        spot = np.searchsorted(self.keys, hashes[at])
        ok = (spot < len(self.keys)) & (self.keys[np.minimum(spot, len(self.keys) - 1)] == hashes[at])
        return at[ok], spot[ok]


def row_shingles(words: Words, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles that lie in one row, and where each starts."""
    hashes = shingle_hashes(words.hashes, step)
    inside = np.flatnonzero(words.row[: len(hashes)] == words.row[step - 1 :])
    return hashes[inside], inside


def occurrences(words: Words, block: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Verified occurrences in the rows: word position and window."""
    places, windows = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for step, (lookup, begin, of_window, offset) in block.prefix.items():
        hashes, at = row_shingles(words, step)
        found, key = lookup.find(hashes)
        at, count = at[found], begin[key + 1] - begin[key]
        upto = np.cumsum(count)
        while len(at):  # in portions, since one frequent prefix may stand for many windows
            take = max(int(np.searchsorted(upto, AT_ONCE, side="right")), 1)
            n = count[:take]
            entry = np.repeat(begin[key[:take]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start, window = np.repeat(at[:take], n) - offset[entry], of_window[entry]
            row = words.row[np.repeat(at[:take], n)]
            ok = (start >= words.first[row]) & (start + block.size[window] <= words.first[row + 1])
            start, window = start[ok], window[ok]
            ok = same_words(words, start, block, window)
            places.append(start[ok])
            windows.append(window[ok])
            at, key, count = at[take:], key[take:], count[take:]
            upto = np.cumsum(count)
    return np.concatenate(places), np.concatenate(windows)


def same_words(words: Words, start: np.ndarray, block: Windows, window: np.ndarray) -> np.ndarray:
    """Whether all words of the window stand at ``start``: hashes first, then the bytes of those that agree."""
    ok = np.zeros(len(start), bool)
    for size in np.unique(block.size[window]):
        at = np.flatnonzero(block.size[window] == size)
        span = np.arange(size)
        here, there = start[at][:, None] + span, block.start[window[at]][:, None] + span
        equal = (words.hashes[here] == block.words.hashes[there]).all(axis=1)
        here, there, at = here[equal], there[equal], at[equal]
        if not len(at):
            continue
        pairs, back = np.unique(np.stack([here.ravel(), there.ravel()]), axis=1, return_inverse=True)
        a, b = words, block.words
        length = a.ends[pairs[0]] - a.starts[pairs[0]]
        alike = length == b.ends[pairs[1]] - b.starts[pairs[1]]
        length = np.where(alike, length, 1)
        step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        bytes_equal = a.data[np.repeat(a.starts[pairs[0]], length) + step] == b.data[np.repeat(b.starts[pairs[1]], length) + step]
        alike &= np.logical_and.reduceat(bytes_equal, np.cumsum(length) - length)
        ok[at] = alike[back.reshape(here.shape)].all(axis=1)
    return ok


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list[str], pa.Array]]:
    """Distinct items with an id and a text, in blocks of about ``block_bytes`` that are fetched one at a time."""
    text = F.col(f"`{text_col}`").cast("string")
    known = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), text.alias("text")).where(
        "item IS NOT NULL AND text IS NOT NULL"
    )
    known = stored(known.distinct(), "items")
    n = -(-(known.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes)
    for i in range(n):
        block = known.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i).toArrow().combine_chunks()
        yield block["item"].to_pylist(), block["text"].combine_chunks()


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = 13,
    shingle: int = 3,
    share: tuple[int, int] = (1, 20),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of digits, letters and non-ASCII characters after lower-casing A-Z. A word in any occurrence of a
    window is hit; a document is contaminated when at least ``share`` of its words are. NULL texts have no words, items
    without id or text no windows; an id that stands for several texts is one item. ``items_sha256`` is of the ids of
    the items that occur, sorted as strings, joined by commas.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = keyed(docs, id_col, text_col)
    empty = F.array().cast("array<int>")
    state = rows.withColumns({"hit_from": empty, "hit_to": empty, "items": F.array().cast("array<string>")})
    blocks = []
    for names, texts in item_blocks(items, item_col, item_text_col, block_bytes):
        if len(blocks) == BLOCKS_AT_ONCE:
            state = stored(state.mapInArrow(in_turn([marking(b) for b in blocks]), CARRIED), "hits")
            blocks = []
        block = Windows(names, texts, window, shingle)
        block.choose(shingle_counts(rows, block))
        blocks.append(spark.sparkContext.broadcast(block))
    return state.mapInArrow(in_turn([*[marking(b) for b in blocks], summing(share)]), RESULT)


def in_turn(steps: list):
    """One pass through all steps in the same Python worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps:
            batches = step(batches)
        return batches

    return run


def shingle_counts(rows: DataFrame, block: Windows) -> dict[tuple[int, int], int]:
    """How often each shingle of the block occurs in all documents; at most one line per shingle of the block."""
    wanted = rows.sparkSession.sparkContext.broadcast(block.wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups = {step: Lookup(keys) for step, keys in wanted.value.items()}
        totals = {step: np.zeros(len(x.keys), np.int64) for step, x in lookups.items()}
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"), WORD)
            for step, lookup in lookups.items():
                spots = lookup.find(row_shingles(words, step)[0])[1]
                totals[step] += np.bincount(spots, minlength=len(lookup.keys))
        for step, n in totals.items():
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), step, np.int32)), pa.array(lookups[step].keys[seen].view(np.int64)), pa.array(n[seen])], ["step", "shingle", "n"]
            )

    counted = rows.select("text").mapInArrow(count, "step INT, shingle LONG, n LONG").groupBy("step", "shingle").agg(F.sum("n").alias("n"))
    return {(r.step, r.shingle): r.n for r in counted.collect()}


def intervals(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values of a list column and the row of each."""
    column = column.cast(pa.large_list(column.type.value_type))
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), sizes)


def covered(words: Words, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each word lies in one of the spans."""
    n = len(words.starts)
    change = np.bincount(begin, minlength=n + 1) - np.bincount(end, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def ragged(values, rows: np.ndarray, n_rows: int, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n_rows))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def marking(block):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, windows = Words(batch.column("text"), WORD), block.value
            start, window = occurrences(words, windows)
            old_from, row = intervals(batch.column("hit_from"))
            old_to, _ = intervals(batch.column("hit_to"))
            begin = np.concatenate([words.first[row] + old_from, start]).astype(np.int64)
            end = np.concatenate([words.first[row] + old_to, start + windows.size[window]]).astype(np.int64)
            hit = np.append(covered(words, begin, end), False)
            edge = np.zeros(len(hit) + 1, bool)
            edge[words.first] = True
            # spans as they are kept: maximal runs of hit words within a row
            run_from = np.flatnonzero(hit & (edge[:-1] | ~np.insert(hit[:-1], 0, False)))
            run_to = np.flatnonzero(hit[:-1] & (edge[1:-1] | ~hit[1:])) + 1
            row = words.row[run_from]
            old_items, item_row = intervals(batch.column("items"))
            pairs = {*zip(item_row.tolist(), old_items.tolist())} | {
                (r, windows.names[i]) for r, i in np.unique(np.stack([words.row[start], windows.item[window]]), axis=1).T.tolist()
            }
            pairs = sorted(pairs)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), batch.column("text"),
                 ragged(run_from - words.first[row], row, n, pa.int32()), ragged(run_to - words.first[row], row, n, pa.int32()),
                 ragged([i for _, i in pairs], np.array([r for r, _ in pairs], np.int64), n, pa.string())],
                ["doc_id", "text_key", "text", "hit_from", "hit_to", "items"],
            )

    return mark


def summing(share: tuple[int, int]):
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"), WORD)
            begin, row = intervals(batch.column("hit_from"))
            end, _ = intervals(batch.column("hit_to"))
            n_words = words.counts()
            n_hit = np.bincount(row, weights=end - begin, minlength=batch.num_rows).astype(np.int64)
            items = batch.column("items").to_pylist()
            digests = [hashlib.sha256(",".join(sorted(set(x))).encode()).hexdigest() for x in items]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(n_words, pa.int64()), pa.array(n_hit),
                 pa.array([len(set(x)) for x in items], pa.int64()), pa.array(digests, pa.string()),
                 pa.array((n_hit > 0) & (share[1] * n_hit >= share[0] * n_words))],
                ["doc_id", "text_key", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return total
