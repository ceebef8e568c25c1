"""BPE with word ends, encoded by one depth-first walk over a trie of distinct words.

For a consistent list of merges (a pair is merged only after its two parts exist, each merge makes a token of its own),
a sequence of tokens is an encoding exactly when every token is the encoding of its own symbols and every two
neighbours are that of theirs. So the encoding of a prefix of a word is that of a shorter prefix and one last token, and
the last token is all a prefix has to remember. The walk visits each node of the trie, that is each distinct prefix,
once: sorted words are the trie's leaves in depth-first order, and a word goes on from the path that it shares with the
word before. At each node the longest match of the vocabulary that is still open leads by its links to all tokens that
end here; the walk takes the one that may stand after the last token of where it began, and leaves it on its path; a
word's ids are read back along these. The final letter of a word is a symbol of its own, so words share what lies
before it.

Texts are cut into pieces where the tokenizer always cuts. A piece of the letters a to z is one word; any other distinct
piece is split into words by the tokenizer's own normalizer and pre-tokenizer. Each distinct word is encoded once per
worker while it is remembered.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfeat.llm.common import LOWER_BYTES, byte_class, keyed, slices, small_batches, span_hashes, spans, text_buffer

SPACE = byte_class((9, 13), (32, 32))
LETTER = byte_class((65, 90), (97, 122))
LOWER = byte_class((97, 122))
DIGIT = byte_class((48, 57))
MARK = byte_class((33, 47), (58, 64), (91, 96), (123, 126))
# added to the code of a word's final letter
END = 1 << 12
# words of one walk; words are sorted before, so that a trie holds neighbours
TRIE_WORDS = 20_000
# distinct pieces, and bytes of them, that a worker remembers
KEPT_PIECES = 400_000
KEPT_BYTES = 32 << 20
# bytes of text whose pieces are in memory at once
SLICE = 1 << 20
SCHEMA = "doc_id LONG, text_key LONG, n_tokens LONG, ids_sha256 STRING, decoded_sha256 STRING"


class Node:
    """Of the vocabulary's trie: edges by letter, its own token, the node of its longest proper end, and the tokens that end
    here with their sizes, the longest first. One of them must fit, so the last needs no test and has size 0."""

    __slots__ = ("edges", "token", "back", "ends")

    def __init__(self):
        self.edges: dict[str, Node] = {}
        self.token: int | None = None
        self.back: Node | None = None
        self.ends: tuple[tuple[int, int], ...] = ()


class Merges:
    """A vocabulary with its merges, as a trie of tokens, and the test whether two tokens may be neighbours."""

    def __init__(self, model: dict):
        suffix, vocab = model.get("end_of_word_suffix") or "", model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = {a + b for a, b in merges}
        if model["type"] != "BPE" or len(made) < len(merges) or any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges", "continuing_subword_prefix")):
            raise ValueError("a BPE model without dropout, unknown token and prefixes, with one merge per token, is needed")
        self.rank = {t: -1 for t in vocab.values()}  # when a token comes to exist; single symbols are there from the start
        self.parts: dict[int, tuple[int, int]] = {}
        self.pair_rank: dict[tuple[int, int], int] = {}
        spelled: dict[int, str] = {}
        for text, t in vocab.items():
            if text not in made:
                spelled[t] = chr(ord(text[0]) + END) if suffix and text == text[0] + suffix else text
        for r, (a, b) in enumerate(merges):
            left, right, t = vocab[a], vocab[b], vocab[a + b]
            if left not in spelled or right not in spelled:
                raise ValueError(f"merge {r} joins a token that does not exist yet")
            spelled[t] = spelled[left] + spelled[right]
            self.rank[t], self.parts[t], self.pair_rank[left, right] = r, (left, right), r
        self.end = END if suffix else 0
        self.root = Node()
        self.symbols = {s for s in spelled.values() if len(s) == 1}
        sound: set[int] = set()
        for t in sorted(spelled, key=self.rank.__getitem__):
            pair = self.parts.get(t)
            if pair is None or (pair[0] in sound and pair[1] in sound and not self.crosses(*pair, self.rank[t])):
                sound.add(t)
                node = self.root
                for letter in spelled[t]:
                    node = node.edges.get(letter) or node.edges.setdefault(letter, Node())
                node.token = t
        self.size = {t: len(text) for t, text in spelled.items()}
        self.link()
        self.known: dict[tuple[int, int], bool] = {}

    def link(self) -> None:
        """Fill ``back`` and ``ends`` of each node, level by level."""
        tested, untested = {t: (t, n) for t, n in self.size.items()}, {t: (t, 0) for t in self.size}
        level = [(self.root, letter, node) for letter, node in self.root.edges.items()]
        while level:
            below = []
            for above, letter, node in level:
                back = above.back
                while back is not None and letter not in back.edges:
                    back = back.back
                node.back = self.root if back is None else back.edges[letter]
                ends = [t for t, _ in node.back.ends] if node.token is None else [node.token, *(t for t, _ in node.back.ends)]
                node.ends = (*[tested[t] for t in ends[:-1]], *[untested[t] for t in ends[-1:]])
                below += [(node, x, child) for x, child in node.edges.items()]
            level = below

    def spine(self, t: int, side: int, until: float) -> list[tuple[int, float]]:
        """The tokens that stand at one end of ``t`` while it is built, each with the rank of the merge that ends it."""
        out = [(t, until)]
        while t in self.parts:
            until, t = self.rank[t], self.parts[t][side]
            out.append((t, until))
        return out

    def crosses(self, left: int, right: int, until: float = float("inf")) -> bool:
        """Whether a merge before ``until`` joins the end of ``left`` with the start of ``right``. Of merges of one rank
        the leftmost goes first: at its own rank the left side has merged already, the right side has not."""
        rights = self.spine(right, 0, until)
        for a, a_until in self.spine(left, 1, until):
            for b, b_until in rights:
                r = self.pair_rank.get((a, b))
                if r is not None and r < a_until and (r <= b_until if b_until < until else r < until):
                    return True
        return False

    def neighbours(self, left: int, right: int) -> bool:
        found = self.known.get((left, right))
        if found is None:
            if len(self.known) > 2_000_000:
                self.known.clear()
            found = self.known[left, right] = not self.crosses(left, right)
        return found


def shared(a: str, b: str) -> int:
    """The length of the longest common prefix."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def encode_words(merges: Merges, words: Sequence[str]) -> list[tuple[int, ...]]:
    """The ids of each word (letters of the byte alphabet); ``words`` are sorted and distinct."""
    found, before = [], " "
    last, path = [-1], [merges.root]  # by depth
    size_of, known, neighbours = merges.size, merges.known, merges.neighbours
    for word in words:
        depth = shared(before[:-1], word)  # the final letter of the word before is a symbol of its own
        del last[depth + 1 :], path[depth + 1 :]
        place = path[depth]
        for letter in word[depth:-1] + chr(ord(word[-1]) + merges.end):
            below = place.edges.get(letter)
            while below is None:
                place = place.back
                if place is None:
                    raise ValueError(f"no token ends a prefix of {word!r}")
                below = place.edges.get(letter)
            place, token = below, None
            depth += 1
            for token, size in place.ends:
                if not size or size == depth:
                    break
                left = last[depth - size]
                fits = known.get((left, token))
                if neighbours(left, token) if fits is None else fits:
                    break
            if token is None:
                raise ValueError(f"no token ends a prefix of {word!r}")
            last.append(token)
            path.append(place)
        ids, at = [], depth
        while at:
            token = last[at]
            ids.append(token)
            at -= size_of[token]
        found.append(tuple(ids[::-1]))
        before = word
    return found


class TrieEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec.get("decoder") or spec.get("post_processor"):
            raise ValueError("a tokenizer without decoder and post-processor is needed")
        self.merges = Merges(spec["model"])
        rules = Tokenizer.from_file(path)
        self.normalize, self.split = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must be found in the raw text, as they are")
        self.text = [""] * (max([*spec["model"]["vocab"].values(), *self.special.values()]) + 1)
        for t, i in [*spec["model"]["vocab"].items(), *self.special.items()]:
            self.text[i] = t
        self.decimal = [str(i) for i in range(len(self.text))]
        # pieces by sorted hash: the hash and its place in what follows
        self.seen, self.at = np.empty(0, np.uint64), np.empty(0, np.int64)
        # by place: number of ids, bytes, whether met again in a later slice; ids, in decimal, decoded
        self.sizes, self.bytes, self.again = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        self.ids: list[tuple[int, ...]] = []
        self.written: list[str] = []
        self.decoded: list[str] = []

    def forget(self) -> None:
        """All pieces but those met again, if they are not too many; they must be met again to stay the next time."""
        kept = np.flatnonzero(self.again)
        if len(kept) > KEPT_PIECES // 2 or self.bytes[kept].sum() > KEPT_BYTES // 2:
            kept = kept[:0]
        moved = np.full(len(self.again), -1)
        moved[kept] = np.arange(len(kept))
        stays = moved[self.at] >= 0
        self.seen, self.at = self.seen[stays], moved[self.at[stays]]
        self.sizes, self.bytes, self.again = self.sizes[kept], self.bytes[kept], np.zeros(len(kept), bool)
        places = kept.tolist()
        self.ids, self.written, self.decoded = ([x[p] for p in places] for x in (self.ids, self.written, self.decoded))

    def encode(self, column: pa.Array) -> Iterator[list[int]]:
        """The ids of each row."""
        for _, places in self.rows(column):
            yield [t for p in places for t in self.ids[p]]

    def rows(self, column: pa.Array) -> Iterator[tuple[int, list[int]]]:
        """Of each row the number of ids, and the places of its pieces without those that have no ids."""
        raw, rows = text_buffer(column)
        data, starts, ends = self.pieces(raw, rows)
        hashes, index, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.ids) > KEPT_PIECES or self.bytes.sum() > KEPT_BYTES:
            self.forget()
        spot = np.searchsorted(self.seen, hashes)
        new = spot == len(self.seen)
        new[~new] = self.seen[spot[~new]] != hashes[~new]
        self.again[self.at[spot[~new]]] = True
        if new.any():
            self.learn(hashes[new], data, starts[index[new]], ends[index[new]])
            spot = np.searchsorted(self.seen, hashes)
        places = self.at[spot][inverse]
        full, first = self.sizes[places] > 0, np.searchsorted(starts, rows)
        counts = np.diff(np.concatenate([[0], np.cumsum(self.sizes[places])])[first]).tolist()
        first = np.concatenate([[0], np.cumsum(full)])[first].tolist()
        places = places[full].tolist()
        for n, a, b in zip(counts, first, first[1:]):
            yield n, places[a:b]

    def pieces(self, raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes and spans of pieces: cut at ASCII white space, between an ASCII letter and an ASCII mark after it, around
        ASCII digits, and around the strings of added tokens. A-Z are lowered where no combining mark can follow."""
        n = len(raw)
        if not n:
            return raw, np.empty(0, np.int64), np.empty(0, np.int64)
        plain = raw < 128
        plain_next = np.ones(n, bool)
        plain_next[:-1] = plain[1:]
        plain_next[rows[1:][rows[1:] > 0] - 1] = True
        data = np.where(plain_next, LOWER_BYTES[raw], raw)
        letter, digit, mark, inside = LETTER[raw], DIGIT[raw], MARK[raw], ~SPACE[raw]
        cut = np.zeros(n + 1, bool)
        cut[1:n] = (letter[:-1] & mark[1:]) | (digit[:-1] & plain[1:]) | (plain[:-1] & digit[1:])
        cut[rows] = True
        for a, b in self.added(raw.tobytes(), rows):
            inside[a:b], data[a:b] = True, raw[a:b]
            cut[a + 1 : b] = False
            cut[a] = cut[b] = True
        return data, *spans(inside, np.flatnonzero(cut))

    def added(self, raw: bytes, rows: np.ndarray) -> list[tuple[int, int]]:
        """Where the strings of added tokens stand in a row, the leftmost first, the longest of those at one place."""
        found = []
        for s in (t.encode() for t in self.special):
            at = raw.find(s)
            while at >= 0:
                found.append((at, -len(s)))
                at = raw.find(s, at + 1)
        out, free = [], 0
        for a, size in sorted(found):
            b = a - size
            row_end = rows[np.searchsorted(rows, a, side="right")]
            if a >= free and b <= row_end:
                out.append((a, b))
                free = b
        return out

    def learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        whole = data.tobytes()
        letters = whole.decode("latin-1")
        others = np.concatenate([[0], np.cumsum(~LOWER[data])])
        plain = (others[starts] == others[ends]).tolist()
        pieces, words = [], set()  # a piece is a word, a list of words, or an id
        for s, e, one_word in zip(starts.tolist(), ends.tolist(), plain):
            if one_word:
                piece = letters[s:e]
                words.add(piece)
            else:
                piece = whole[s:e].decode()
                if piece in self.special:
                    piece = self.special[piece]
                else:
                    piece = [w for w, _ in self.split(self.normalize(piece)) if w]
                    words.update(piece)
            pieces.append(piece)
        ids: dict[str, tuple[int, ...]] = {}
        ordered = sorted(words)
        for at in range(0, len(ordered), TRIE_WORDS):
            chunk = ordered[at : at + TRIE_WORDS]
            ids.update(zip(chunk, encode_words(self.merges, chunk)))
        first, decimal, text = len(self.ids), self.decimal, self.text
        for piece in pieces:
            if isinstance(piece, str):
                found = ids[piece]
            elif isinstance(piece, int):
                found = (piece,)
            else:
                found = tuple([t for w in piece for t in ids[w]])
            self.ids.append(found)
            self.written.append(" ".join([decimal[t] for t in found]))
            self.decoded.append(" ".join([text[t] for t in found]))
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, self.ids[first:]), np.int64)])
        self.bytes = np.concatenate([self.bytes, ends - starts])
        self.again = np.concatenate([self.again, np.zeros(len(starts), bool)])
        seen = np.concatenate([self.seen, hashes])
        order = np.argsort(seen, kind="stable")
        self.seen, self.at = seen[order], np.concatenate([self.at, np.arange(first, len(self.ids))])[order]

    def decode(self, ids: Sequence[int]) -> str:
        """Without a decoder the library joins the tokens by one space, added tokens included."""
        text = self.text
        return " ".join([text[i] for i in ids])


_encoders: dict[str, TrieEncoder] = {}


def encoder(path: str) -> TrieEncoder:
    """One per worker process, so that what it remembers serves the next task."""
    if path not in _encoders:
        _encoders[path] = TrieEncoder(path)
    return _encoders[path]


def trie_encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, text_key, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256, and
    unless ``with_ids`` is off the ids and the decoded text.

    NULL texts are empty: no ids, decoded to nothing. Strings of added tokens in a text are those tokens. No shuffle.
    A worker holds the words of one slice of text and a bounded number of pieces beside it; a longer text is a slice of
    its own.
    """
    small_batches(docs.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in slices(batches, "text", SLICE):
            sizes, ids_sha, text_sha, kept, decoded = [], [], [], [], []
            for n, places in enc.rows(batch.column("text")):
                text = " ".join([enc.decoded[p] for p in places])
                sizes.append(n)
                ids_sha.append(hashlib.sha256(" ".join([enc.written[p] for p in places]).encode()).hexdigest())
                text_sha.append(hashlib.sha256(text.encode()).hexdigest())
                if with_ids:
                    kept.append([t for p in places for t in enc.ids[p]])
                    decoded.append(text)
            out = {
                "doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "n_tokens": pa.array(sizes, pa.int64()),
                "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string()),
            }
            if with_ids:
                out |= {"ids": pa.array(kept, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())}
            yield pa.RecordBatch.from_pydict(out)

    return keyed(docs, id_col, text_col).mapInArrow(run, SCHEMA + ", ids ARRAY<INT>, decoded STRING" * with_ids)


def trie_decode(rows: DataFrame, tokenizer_path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with a column ``decoded``: the tokens of ``ids_col`` joined by one space; NULL stays NULL."""
    small_batches(rows.sparkSession, 256)

    @F.pandas_udf("string")
    def decoded(ids):
        enc = encoder(tokenizer_path)
        return ids.map(lambda x: None if x is None else enc.decode(x))

    return rows.withColumn("decoded", decoded(F.col(f"`{ids_col}`")))
