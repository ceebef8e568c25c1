"""Prefix trie of conversations by vertical bitmaps.

Conversations are cut, in the order of their ids, into shards of bounded size. A shard indexes its turns by position and
content: each (position, turn) has the bitset of the conversations that have it. The trie is walked depth first: the
members of a node that go on are intersected with the posting of the next turn of the first of them, which gives a
child; what is left gives the next child; members that stop here are the node's end list. So a node costs one
intersection, whatever the number of turns in the index, and its popcount is its number of conversations.

A prefix may be in many shards, so a common first turn is spread like any other. Nodes are joined over shards by a
digest of their path, with sums and a smallest member. Sums over subtrees must count a node of several shards once: it
is owned by the shard of its smallest member, which has all of its ancestors, so each shard adds what it owns up its own
tree and the sums of the shards are added.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfeat.llm.common import small_batches, stored, whole

# conversations, and turns, of a shard; a longer conversation is a shard of its own
SHARD_CONVERSATIONS = 4096
SHARD_TURNS = 100_000
ROOT = bytes(16)
LOCAL = (
    "path BINARY, shard LONG, number LONG, above LONG, size LONG, depth LONG, low LONG, members LONG, n_ends LONG, bytes LONG, ends STRING"
)
PART = "path BINARY, conv_id LONG, depth LONG, parent_conv_id LONG, n_convs LONG, children LONG, leaves LONG, saved LONG"


def turn_keys(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, turn_key, bytes``: a digest of role and text in place of both (NULL counts as empty). Rows
    without a conv_id belong to no conversation and are left out."""
    role, text = whole(F.col(f"`{role_col}`")), whole(F.col(f"`{text_col}`"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    return turns.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        digest.alias("turn_key"), F.octet_length(text).cast("long").alias("bytes"),
    )


class Shard:
    """Some conversations in the order of their ids: for each its id and turns."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.turns: list[list[bytes]] = []
        self.bytes: dict[bytes, int] = {}
        self.n_turns = 0

    def add(self, conv_id: int, key: bytes | None, size: int | None) -> None:
        if not self.ids or self.ids[-1] != conv_id:
            self.ids.append(conv_id)
            self.turns.append([])
        if key is not None:
            self.turns[-1].append(key)
            self.bytes[key] = size
            self.n_turns += 1

    def full(self) -> bool:
        return len(self.ids) >= SHARD_CONVERSATIONS or self.n_turns >= SHARD_TURNS

    def nodes(self) -> dict[str, list]:
        """The columns of ``LOCAL``, nodes in depth-first order, children by smallest member."""
        ids, turns = self.ids, self.turns
        postings: dict[tuple[int, bytes], int] = {}
        stops: dict[int, int] = {}
        for c, keys in enumerate(turns):
            bit = 1 << c
            for at, key in enumerate(keys):
                postings[at, key] = postings.get((at, key), 0) | bit
            stops[len(keys)] = stops.get(len(keys), 0) | bit
        out: dict[str, list] = {f.split()[0]: [] for f in LOCAL.split(", ")}
        stack = [((1 << len(ids)) - 1, 0, -1, ROOT, 0)]
        while stack:
            members, depth, above, path, size = stack.pop()
            number = len(out["path"])
            ends = members & stops.get(depth, 0)
            row = (path, ids[0], number, above, 1, depth, ids[lowest(members)], members.bit_count(), ends.bit_count(), size)
            for column, value in zip(out.values(), row):
                column.append(value)
            out["ends"].append(",".join([str(ids[c]) for c in bits(ends)]) if ends else None)
            going, children = members ^ ends, []
            while going:
                key = turns[lowest(going)][depth]
                child = going & postings[depth, key]
                going ^= child
                below = hashlib.blake2b(path + key, digest_size=16).digest()
                children.append((child, depth + 1, number, below, self.bytes[key]))
            stack += children[::-1]
        size, above = out["size"], out["above"]
        for number in range(len(size) - 1, 0, -1):
            size[above[number]] += size[number]
        return out


def lowest(members: int) -> int:
    return (members & -members).bit_length() - 1


def bits(members: int) -> list[int]:
    out = []
    while members:
        out.append(lowest(members))
        members &= members - 1
    return out


def local_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.binary(), *[pa.int64()] * 9, pa.string()]

    def table(shard: Shard) -> Iterator[pa.RecordBatch]:
        columns = shard.nodes()
        batch = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns.values(), kinds)], list(columns))
        for at in range(0, batch.num_rows, 10_000):
            yield batch.slice(at, 10_000)

    shard = Shard()
    for batch in batches:
        for conv_id, key, size in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn_key", "bytes"))):
            if shard.ids and conv_id != shard.ids[-1] and shard.full():
                yield from table(shard)
                shard = Shard()
            shard.add(conv_id, key, size)
    if shard.ids:
        yield from table(shard)


def subtree_parts(nodes: pd.DataFrame) -> pd.DataFrame:
    """What one shard adds to each of its nodes: owned children, and over its subtree owned leaves and saved bytes."""
    nodes = nodes.sort_values("number")
    owned = (nodes["low"] == nodes["conv_id"]).to_numpy()
    above, stop = nodes["above"].to_numpy(), nodes["number"].to_numpy() + nodes["size"].to_numpy()
    number = np.arange(len(nodes))
    out = nodes[["path", "conv_id", "depth", "n_convs"]].copy()
    inner = owned & (above >= 0)
    out["children"] = np.bincount(above[inner], minlength=len(nodes))
    saved = (nodes["n_convs"].to_numpy() - 1) * nodes["bytes"].to_numpy()
    for name, value in (("leaves", nodes["leaf"].to_numpy().astype(np.int64)), ("saved", saved)):
        before = np.concatenate([[0], np.cumsum(np.where(owned, value, 0))])
        out[name] = before[stop] - before[number]
    parent = nodes["conv_id"].to_numpy()[np.maximum(above, 0)]
    out["parent_conv_id"] = pd.array(parent, "Int64")
    out.loc[above < 0, "parent_conv_id"] = pd.NA
    return out[[f.split()[0] for f in PART.split(", ")]]


def end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each path's end lists, given piece by piece in the order of their shards."""

    def result(path: bytes, digest) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"path": pa.array([path], pa.binary()), "ends_sha256": [digest.hexdigest()]})

    path, digest = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for p, piece in zip(batch.column("path").to_pylist(), batch.column("ends").to_pylist()):
            if p != path:
                if digest is not None:
                    done.append((path, digest.hexdigest()))
                path, digest = p, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.binary()), pa.array([d for _, d in done])], ["path", "ends_sha256"])
    if digest is not None:
        yield result(path, digest)


def trie_of_keys(keys: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """The nodes of the trie over ``keys`` (``turn_keys``): path, conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    ``conversations`` (conv_id) may name conversations without turns, which are members of the root only. Turns go by
    ``turn`` (NULL first), equal ones by their digest. Without conversations there is no node.
    """
    spark = keys.sparkSession
    small_batches(spark, 4_000)
    named = keys.select("conv_id", "turn", "turn_key", "bytes")
    if conversations is not None:
        # a mark without a turn comes before the turns
        mark = [F.lit(None).cast(t).alias(n) for n, t in (("turn", "long"), ("turn_key", "binary"), ("bytes", "long"))]
        named = named.unionByName(conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), *mark))
    ordered = named.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "turn", "turn_key")
    local = stored(ordered.mapInArrow(local_nodes, LOCAL), "trie-shards")
    total = local.groupBy("path").agg(
        F.min("low").alias("conv_id"), F.sum("members").alias("n_convs"), (F.sum("members") == F.sum("n_ends")).alias("leaf")
    )
    known = local.drop("ends", "members", "n_ends").join(total, "path")
    parts = known.groupBy("shard").applyInPandas(subtree_parts, PART)
    sums = parts.groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        # of the shards only the owner's smallest member is that of the whole; all shards name the same parent
        F.min("parent_conv_id").alias("parent_conv_id"), F.min("n_convs").alias("n_convs"),
        F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
    )
    lists = local.where("ends IS NOT NULL").select("path", "shard", "ends")
    lists = lists.repartition("path").sortWithinPartitions("path", "shard")
    ends = lists.mapInArrow(end_digests, "path BINARY, ends_sha256 STRING")
    nothing = hashlib.sha256().hexdigest()
    return sums.join(ends, "path", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))


def conversation_trie(
    turns: DataFrame, conversations: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The trie of all conversations of ``turns``: one row per distinct sequence of first turns, see ``trie_of_keys``.

    n_convs conversations start with it, conv_id is the smallest of them; n_children of it go on differently; n_leaves
    childless nodes and saved_tokens (per node (n_convs - 1) times the UTF-8 bytes of its last text) are summed over its
    subtree; ends_sha256 is over the decimal ids of those that stop here. NULL roles and texts are empty.
    """
    return trie_of_keys(turn_keys(turns, conv_col, turn_col, role_col, text_col), conversations)
