"""Periodic runs of words: maximal stretches that repeat with a smallest period.

Each run has a Lyndon word as its root that is the longest Lyndon word starting at its place, in one of the two orders
of the alphabet. So each place and order gives one candidate root, and a candidate is extended to the right by the
longest common extension of the places one period apart and to the left by the same on the reversed words. Common
extensions are depths of lowest common ancestors of leaves in the suffix trees (Ukkonen) of the words and of their
reversal: an Euler tour, kept as one depth per step from leaf to leaf, with a sparse table of range minima answers each
in constant time. Longest Lyndon words follow from the order of the leaves: they end before the next smaller suffix.

Trees are built for stretches that can hold a run only: of a run of at least ``min_length`` words and ``min_repeats``
periods, every window of ``window_words`` words occurs twice in the document, and a neighbouring word that extends it
makes one more such window. So a document is cut where windows occur once, and no run crosses or touches a cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from relfeat.llm.common import byte_class, keyed, mixed, shingle_hashes, slices, small_batches, span_hashes, spans, text_buffer

WORD = ~byte_class((9, 13), (32, 32))  # anything but ASCII white space
SCHEMA = (
    "doc_id LONG, text_key LONG, n_runs LONG, start LONG, length LONG, period LONG, exponent_milli LONG, "
    "runs_sha256 STRING, collapsed_sha256 STRING"
)
RUNS = "runs ARRAY<STRUCT<start: LONG, length: LONG, period: LONG>>, collapsed STRING"


class SuffixTree:
    """Ukkonen's suffix tree of a list of non-negative numbers, closed by a smallest sign of its own."""

    def __init__(self, word_ids: list[int]):
        text = [*word_ids, -1]
        self.size = size = len(text)
        # node 0 is the root; leaves have no entry in ``below``
        start, stop, link = [0], [0], [0]
        below: list[dict[int, int] | None] = [{}]
        node, edge, length, due = 0, 0, 0, 0
        for i, sign in enumerate(text):
            waiting = 0  # the inner node made last, which has no suffix link yet
            due += 1
            while due:
                if not length:
                    edge = i
                child = below[node].get(text[edge])
                if child is None:
                    below[node][sign] = len(start)
                    start.append(i), stop.append(size), link.append(0), below.append(None)
                    if waiting:
                        link[waiting], waiting = node, 0
                else:
                    span = min(stop[child], i + 1) - start[child]
                    if length >= span:
                        edge, length, node = edge + span, length - span, child
                        continue
                    begin = start[child]
                    if text[begin + length] == sign:
                        if waiting:
                            link[waiting] = node
                        length += 1
                        break
                    inner = len(start)
                    below[node][text[edge]] = inner
                    start[child] = begin + length
                    start.append(begin), stop.append(begin + length), link.append(0)
                    below.append({sign: inner + 1, text[begin + length]: child})
                    start.append(i), stop.append(size), link.append(0), below.append(None)
                    if waiting:
                        link[waiting] = inner
                    waiting = inner
                due -= 1
                if node:
                    node = link[node]
                elif length:
                    length, edge = length - 1, i - due + 1
        self.start, self.stop, self.below = start, stop, below

    def tour(self, turned: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of the leaves, and for each leaf the depth at which the tour turned on its way there from
        the leaf before. ``turned``: larger signs first, the closing sign before all of them."""
        start, stop, below, size = self.start, self.stop, self.below, self.size
        leaves, turns, low = [], [], size
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            if depth < low:
                low = depth
            children = below[node]
            depth += stop[node] - start[node]
            if children is None:
                leaves.append(size - depth)
                turns.append(low)
                low = size
            else:
                # the stack gives the last one first
                order = sorted(children, reverse=not turned)
                if turned and order[0] == -1:
                    order = [*order[1:], -1]
                stack += [(children[sign], depth) for sign in order]
        return np.array(leaves, np.int64), np.array(turns, np.int64)


class CommonExtension:
    """Length of the longest common prefix of suffixes, for arrays of pairs at once."""

    def __init__(self, leaves: np.ndarray, turns: np.ndarray):
        self.place = np.empty(len(leaves), np.int64)
        self.place[leaves] = np.arange(len(leaves))
        self.minima = [turns.astype(np.int32)]
        width = 1
        while 2 * width <= len(turns):
            above = self.minima[-1]
            self.minima.append(np.minimum(above[:-width], above[width:]))
            width *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.place[i], self.place[j]
        first, last = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.minima[k][first[at]], self.minima[k][last[at] - (1 << int(k)) + 1])
        return out


def lyndon_ends(place: list[int]) -> list[int]:
    """Where the longest Lyndon word from each position ends: at the next smaller suffix (``place``: rank of suffixes)."""
    n = len(place)
    ends = [n] * n
    for i in range(n - 2, -1, -1):
        j, mine = i + 1, place[i]
        while j < n and place[j] > mine:
            j = ends[j]
        ends[i] = j
    return ends


def runs_of(word_ids: list[int], min_length: int, min_repeats: int) -> np.ndarray:
    """Rows (start, length, period) of the runs of a list of numbers, by start, then period."""
    n = len(word_ids)
    tree = SuffixTree(word_ids)
    leaves, turns = tree.tour()
    orders = [leaves, tree.tour(turned=True)[0]]
    del tree
    ahead = CommonExtension(leaves, turns)
    back = CommonExtension(*SuffixTree(word_ids[::-1]).tour())
    found = []
    for order in orders:
        place = np.empty(n + 1, np.int64)
        place[order] = np.arange(n + 1)
        begin = np.arange(n)
        end = np.array(lyndon_ends(place[:n].tolist()), np.int64)
        inside = end < n
        begin, end = begin[inside], end[inside]
        period = end - begin
        right = ahead(begin, end)
        left = np.zeros(len(begin), np.int64)
        some = begin > 0
        left[some] = back(n - begin[some], n - end[some])
        length = left + period + right
        long = length >= np.maximum(min_length, min_repeats * period)
        found.append(np.stack([begin - left, length, period], 1)[long])
    every = np.unique(np.concatenate(found), axis=0)
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def window_words(min_length: int, min_repeats: int) -> int:
    """The longest window that occurs at two places, a period apart, wherever it lies in a run."""
    return 1 + min(max(min_length, min_repeats * q) - 2 * q for q in range(1, min_length + 1))


def stretches(hashes: np.ndarray, first: np.ndarray, window: int, min_length: int) -> list[tuple[int, int]]:
    """Spans of words, within rows, all of whose windows occur twice in their row."""
    n = len(hashes)
    if n < window:
        return []
    begin = np.arange(n - window + 1)
    row = np.searchsorted(first, begin, side="right")
    whole = begin + window <= first[np.minimum(row, len(first) - 1)]
    begin, row = begin[whole], row[whole]
    in_row = mixed(shingle_hashes(hashes, window)[whole] + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, inverse, counts = np.unique(in_row, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    begin, row = begin[twice], row[twice]
    if not len(begin):
        return []
    breaks = np.flatnonzero((np.diff(begin) > 1) | (np.diff(row) > 0)) + 1
    starts, ends = begin[np.concatenate([[0], breaks])], begin[np.concatenate([breaks - 1, [-1]])] + window
    return [(a, b) for a, b in zip(starts.tolist(), ends.tolist()) if b - a >= min_length]


def exponent_order(run: tuple[int, int, int], best: tuple[int, int, int] | None) -> bool:
    """Whether the exact length / period of ``run`` is greater; ties go to the smaller start, then period."""
    if best is None:
        return True
    mine, other = run[1] * best[2], best[1] * run[2]
    return mine > other or (mine == other and (run[0], run[2]) < (best[0], best[2]))


def periodic_runs(
    docs: DataFrame, min_length: int = 24, min_repeats: int = 3, id_col: str = "doc_id", text_col: str = "text",
    with_runs: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_runs; start, length, period and exponent_milli of the run with
    the greatest length / period (ties: smallest start, then period; NULL without a run); runs_sha256 over the lines
    ``start,length,period``; collapsed_sha256 of the words that are left, joined by one space, when of each run only the
    first period stays; and unless ``with_runs`` is off the runs and the collapsed text.

    Words are separated by ASCII white space and compared byte by byte, numbered from 0. A run has at least
    ``min_length`` words and ``min_repeats`` (2 or more) periods. NULL and empty texts have no words, no runs and an
    empty collapsed text. No shuffle; memory is linear in the longest stretch of repeated windows of one document.
    """
    if min_repeats < 2 or min_length < 2:
        raise ValueError("a run has two words and two periods at least")
    small_batches(docs.sparkSession)
    window = window_words(min_length, min_repeats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, rows = text_buffer(batch.column("text"))
            starts, ends = spans(WORD[data], rows)
            first = np.searchsorted(starts, rows)
            raw = data.tobytes()
            found: list[list[tuple[int, int, int]]] = [[] for _ in range(batch.num_rows)]
            keep = np.ones(len(starts), bool)
            for a, b in stretches(span_hashes(data, starts, ends), first[1:], window, min_length):
                numbers: dict[bytes, int] = {}
                word_ids = [numbers.setdefault(raw[s:e], len(numbers)) for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())]
                row = int(np.searchsorted(first, a, side="right")) - 1
                for start, length, period in runs_of(word_ids, min_length, min_repeats).tolist():
                    keep[a + start + period : a + start + length] = False
                    found[row].append((a - int(first[row]) + start, length, period))
            out: dict[str, list] = {n: [] for n in ("start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "collapsed")}
            for row, (a, b) in enumerate(zip(first.tolist(), first[1:].tolist())):
                best = None
                for r in found[row]:
                    if exponent_order(r, best):
                        best = r
                start, length, period = best or (None, None, None)
                out["start"].append(start), out["length"].append(length), out["period"].append(period)
                out["exponent_milli"].append(1000 * length // period if best else None)
                lines = "".join(f"{s},{n},{p}\n" for s, n, p in found[row])
                out["runs_sha256"].append(hashlib.sha256(lines.encode()).hexdigest())
                left = np.flatnonzero(keep[a:b]) + a
                text = b" ".join([raw[s:e] for s, e in zip(starts[left].tolist(), ends[left].tolist())])
                out["collapsed_sha256"].append(hashlib.sha256(text).hexdigest())
                out["collapsed"].append(text)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            columns = {n: pa.array(out[n], t) for n, t in zip(out, kinds)}
            columns = {"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "n_runs": pa.array([len(f) for f in found], pa.int64()), **columns}
            if with_runs:
                named = [[{"start": s, "length": n, "period": p} for s, n, p in f] for f in found]
                columns["runs"] = pa.array(named, pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])))
                columns["collapsed"] = pa.array([t.decode() for t in out["collapsed"]], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return keyed(docs, id_col, text_col).mapInArrow(run, f"{SCHEMA}, {RUNS}" if with_runs else SCHEMA)
