"""Periodic runs, trie BPE and the prefix trie against brute force, with NULLs, empty and very long texts, ties, repeated
rows, empty tables and clashing column names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from relfeat.llm import prefix_trie
from relfeat.llm.periodic_runs import CommonExtension, SuffixTree, periodic_runs, runs_of, stretches, window_words
from relfeat.llm.prefix_trie import conversation_trie, trie_of_keys, turn_keys
from relfeat.llm.queries import planted, rebuilt
from relfeat.llm.trie_bpe import TrieEncoder, trie_decode, trie_encode

BPE = public_tokenizers.path("word_bpe_49k.json")
DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("text_key", "n", "h", "g", "w", "a", "p", "start", "runs", "ids", "decoded", "a key")]
)
TURNS = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("path", "shard", "turn_key", "bytes", "depth", "low", "a key")]
)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


# --- runs ----------------------------------------------------------------------------------------------------------


def runs_by_force(w, min_length, min_repeats):
    n, out = len(w), []
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i + q - s
            if length >= max(min_length, min_repeats * q) and not any(all(w[k] == w[k + d] for k in range(s, s + length - d)) for d in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(rng, n):
    k, out = rng.choice([1, 2, 2, 3, 6]), []
    while len(out) < n:
        out += [rng.randrange(k) for _ in range(rng.randint(1, 9))] * rng.randint(1, 6)
    return out[:n]


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        w = repetitive(rng, rng.randint(1, 70))
        hashes = np.array([hash((x, 7)) & (2**64 - 1) for x in w], np.uint64)
        for shape in ((2, 2), (6, 3), (24, 3), (10, 2), (12, 4)):
            expected = runs_by_force(w, *shape)
            assert [tuple(r) for r in runs_of(w, *shape).tolist()] == expected
            cut = stretches(hashes, np.array([len(w)]), window_words(*shape), shape[0])
            found = [(a + s, n, p) for a, b in cut for s, n, p in runs_of(w[a:b], *shape).tolist()]
            assert sorted(found, key=lambda r: (r[0], r[2])) == expected


def test_common_extensions():
    rng = random.Random(6)
    w = repetitive(rng, 60)
    ahead = CommonExtension(*SuffixTree(w).tour())
    pairs = [(i, j) for i in range(60) for j in range(60) if i != j]
    got = ahead(*map(np.array, zip(*pairs)))
    for (i, j), n in zip(pairs, got.tolist()):
        a, b = w[i:], w[j:]
        assert n == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def run_texts():
    rng = random.Random(9)
    rows = [(None, "x y " * 20), (1, None), (2, ""), (3, " \t\n"), (4, "la " * 24), (5, "la " * 23), (6, "La la " * 12), (7, "a b c " * 8 + "a b z"), (8, "x " * 5000)]
    rows += [(9, "tu wo " * 15 + "gap " + "me no pa " * 9), (9, "tu wo " * 15 + "gap " + "me no pa " * 9), (10, "ü ñ 漢 字 " * 9), (11, "one two three")]
    for i in range(12, 140):
        w = [f"w{x}" for x in repetitive(rng, rng.randint(1, 150))]
        if i % 3 == 0:
            w = [f"v{rng.randrange(60)}" for _ in range(rng.randint(1, 200))]
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(w)))
    return rows


def expected_runs(doc_id, text, plant):
    w = words_of(text)
    if plant and doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = runs_by_force(w, 24, 3)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if runs else None
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


def test_periodic_runs(spark):
    rows = run_texts()
    docs = spark.createDataFrame([(i, t, *["x"] * 12) for i, t in rows], DOCS).repartition(3)
    for plant in (False, True):
        got = periodic_runs(planted(docs) if plant else docs)
        names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        found = got.collect()
        assert sorted((tuple(r[n] for n in names) for r in found), key=str) == sorted((expected_runs(i, t, plant) for i, t in rows), key=str)
        assert all(sha(r.collapsed) == r.collapsed_sha256 and len(r.runs) == r.n_runs for r in found)
    assert sum(r.n_runs > 1 for r in found) > 5
    assert periodic_runs(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(docs, min_repeats=1)


# --- trie BPE ------------------------------------------------------------------------------------------------------


def bpe_texts():
    rng = random.Random(3)
    odd = "abcdefghijklmnopqrstuvwxyzABCDEFGHINTRESaaaeeettt   ''.,!0123456789éÉñß漢字🙂́ 　\n\t=<≯İ'sΣς/wﬁ²½Åɐ"
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["".join(rng.choice("aabnthersi") for _ in range(rng.randint(0, 40))) for _ in range(400)]
    special = ["a<|endoftext|>b<|startoftext|>", "<|endoftext|><|endoftext|>x <|ENDOFTEXT|>", "<|endoftext|", "endoftext|>", "</w>", "n<|endoftext|>n"]
    return [None, "", " ", "x" * 30_000, "漢" * 9_000, "don't WE'LL 3rd", *special, *special, *texts]


def test_trie_bpe_equals_the_library(spark):
    library = Tokenizer.from_file(BPE)
    rows = [(None if i == 3 else i // 2, t) for i, t in enumerate(bpe_texts())]
    docs = spark.createDataFrame([(i, t, *["x"] * 12) for i, t in rows], DOCS).repartition(3)
    expected = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    coded = trie_encode(docs, BPE)
    found = coded.collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found), key=str) == sorted(expected, key=str)
    again = trie_decode(coded.select("ids", "decoded_sha256"), BPE).collect()
    assert all(sha(r.decoded) == r.decoded_sha256 for r in again)
    assert trie_encode(spark.createDataFrame([], DOCS), BPE).count() == 0


def test_a_worker_that_forgets_gives_the_same_ids(monkeypatch):
    import pyarrow as pa

    from relfeat.llm import trie_bpe

    monkeypatch.setattr(trie_bpe, "KEPT_PIECES", 50)
    monkeypatch.setattr(trie_bpe, "TRIE_WORDS", 7)
    library, enc = Tokenizer.from_file(BPE), TrieEncoder(BPE)
    texts = [t or "" for t in bpe_texts()]
    for at in range(0, len(texts), 100):
        got = list(enc.encode(pa.array(texts[at : at + 100], pa.string())))
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts[at : at + 100]]


def test_frequent_words_are_learned_once_and_without_the_splitter(monkeypatch):
    """A piece of the letters a to z is a word as it is; pieces that were met again outlast a worker's forgetting."""
    import pyarrow as pa

    from relfeat.llm import trie_bpe

    def never(text):
        raise AssertionError(text)

    monkeypatch.setattr(trie_bpe, "KEPT_PIECES", 100)
    library, enc, learned = Tokenizer.from_file(BPE), TrieEncoder(BPE), []
    monkeypatch.setattr(enc, "normalize", never)
    monkeypatch.setattr(enc, "split", never)
    learn = enc.learn
    monkeypatch.setattr(enc, "learn", lambda hashes, *rest: (learned.append(len(hashes)), learn(hashes, *rest)))
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("aeinorstth") for _ in range(rng.randint(1, 12))) for _ in range(700)})
    rng.shuffle(words)
    common, fresh = words[:20], words[20:420]
    for at in range(0, 400, 40):
        texts = [" ".join(common).title(), " ".join(fresh[at : at + 40])]
        assert list(enc.encode(pa.array(texts, pa.string()))) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(learned) == 420 and len(enc.ids) <= 100 + 60


def test_neighbouring_tokens():
    """Every two tokens of an encoding may be neighbours; a merge that joins them forbids it."""
    merges = TrieEncoder(BPE).merges
    rng = random.Random(2)
    for pair in rng.sample(sorted(merges.pair_rank), 300):
        assert not merges.neighbours(*pair)


# --- prefix trie ---------------------------------------------------------------------------------------------------


def trie_by_force(convs: dict[int, list[tuple[str, str]]]):
    members: dict[tuple, list[int]] = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def subtree(path):
        todo = [path]
        while todo:
            p = todo.pop()
            yield p
            todo += children[p]

    out = []
    for path, ids in members.items():
        below = list(subtree(path))
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in ids if len(convs[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(ids), len(path), parent, len(ids), len(children[path]), sum(not children[p] for p in below), saved, sha(ends)))
    return sorted(out, key=str)


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


def conversations():
    """Few distinct turns, so that many share; a third are equal; NULLs, ties, repeated rows, a long one, negative ids."""
    rng = random.Random(4)
    rows, last = [], {}
    for c in range(-20, 300):
        if c % 3 == 0:
            turns = [(0, "user", "common"), (1, "bot", "answer ü")]
        else:
            turns = [(t, rng.choice(["user", None, ""]), rng.choice(["a", "ab", "é", None, ""])) for t in range(rng.randint(1, 7))]
        if c == 7:
            turns = [(t, "user", "a") for t in range(400)]
        rows += [(c, *t) for t in turns]
    rows += [(301, None, "user", "first"), (301, 0, "user", "second"), (302, 1, "b", "tie"), (302, 1, "a", "tie"), (302, 1, "a", "tie"), (None, 0, "user", "nobody")]
    return rows


def in_order(rows):
    """Turns by number, NULL first, equal ones by the digest of role and text."""
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append(((t is not None, t or 0), hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest(), role, text))
    return {c: [(role, text) for *_, role, text in sorted(turns)] for c, turns in convs.items()}


@pytest.mark.parametrize("shard", [4096, 16, 1])
def test_conversation_trie(spark, monkeypatch, shard):
    real = prefix_trie.local_nodes

    def small(batches):
        prefix_trie.SHARD_CONVERSATIONS = shard
        return real(batches)

    monkeypatch.setattr(prefix_trie, "local_nodes", small)
    rows = conversations()
    turns = spark.createDataFrame([(*r, *["x"] * 7) for r in rows], TURNS).repartition(5)
    assert nodes(conversation_trie(turns)) == trie_by_force(in_order(rows))


def test_conversations_without_turns_are_members_of_the_root(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "bot", "yo")]
    ids = spark.createDataFrame([(0,), (1,), (2,), (9,), (None,)], "conv_id LONG")
    turns = spark.createDataFrame([(*r, *["x"] * 7) for r in rows], TURNS)
    expected = trie_by_force({0: [], 9: [], **in_order(rows)})
    assert nodes(conversation_trie(turns, ids)) == expected
    assert conversation_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_rebuilt_conversations(spark):
    rows = [r for r in conversations() if r[0] is None or (r[0] >= 0 and r[0] not in (15, 40))]
    turns = spark.createDataFrame([(*r, *["x"] * 7) for r in rows], TURNS)
    own = in_order(rows)
    convs = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = own.get(c - c % 5, [])[:h] + t[h:]
    assert any(not t for t in convs.values())
    assert nodes(trie_of_keys(*rebuilt(turn_keys(turns)))) == trie_by_force(convs)
