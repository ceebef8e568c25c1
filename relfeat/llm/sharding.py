"""Sharding by a K-d tree over document metadata, with leaves of nearly equal bytes.

A node is split along the dimension in which its documents spread widest, at the median weighted by bytes; a node
that holds an odd number of leaves is split at the matching share instead. Medians are distributed: the interval that
holds the wanted byte is cut into ``FANOUT`` parts, one grouped sum finds the part that holds it, and so on until the
cut misses the wanted byte by no more than ``tolerance``. Documents with the same place in a dimension are ordered by
a hash of their text, then of their id, so a source or a group of copies with a third of all rows is split as well.
The driver sees only one line per node and part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfeat.llm.common import stored, whole

FANOUT = 1024
# a place in a dimension: 20 bits of its value, then 42 bits of the text's hash
VALUE_BITS, TIE_BITS = 20, 42
SPACE = 1 << (VALUE_BITS + TIE_BITS)


@dataclass
class Cut:
    """Search for the place in node ``node`` along ``dim`` below which ``wanted`` bytes lie."""

    node: int
    leaves: int
    dim: int
    low: int
    high: int
    wanted: int
    slack: int
    place: int | None = None  # everything below goes left
    tied: bool = False  # documents at ``place`` itself are cut by the hash of their id
    tie_place: int | None = None

    @property
    def found(self) -> bool:
        return self.place is not None and (not self.tied or self.tie_place is not None)


def points_of(docs: DataFrame, id_col: str, text_col: str, dims: list[str]) -> DataFrame:
    """doc_id, size, text_crc32, ties, and ``dims``: places of log size and of each metadata column in 0..2**20-1.

    Rows of equal text are one point, with the metadata of that with the smallest id, so that a group is only parted
    where a cut falls among its own rows.
    """
    text = whole(F.col(f"`{text_col}`"))
    has_text = F.octet_length(F.col(f"`{text_col}`").cast("string"))
    doc_id = F.col(f"`{id_col}`").cast("long")
    rows = stored(
        docs.select(
            doc_id.alias("doc_id"), (F.coalesce(has_text, F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"),
            F.shiftrightunsigned(F.xxhash64(doc_id), 2).alias("id_hash"), F.struct(F.lit(0), *[F.col(f"`{c}`").cast("string").alias(f"m{i}") for i, c in enumerate(dims)]).alias("meta"),
        ),
        "sizes",
    )
    same = ["text_hash", "text_crc32", "size"]
    # NULL counts 1 byte as the empty text does: both are one group
    groups = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("doc_id", "meta")).alias("first"))
    rows = rows.join(groups.where("c > 1").drop("c"), same, "left").withColumn("meta", F.coalesce("first.meta", "meta"))
    top = (1 << VALUE_BITS) - 1
    values = [F.least(F.floor(F.log2(F.col("size").cast("double")) * (top / 32)).cast("long"), F.lit(top))]
    for i in range(len(dims)):  # a category has no order: its place is a hash, and a missing one comes first
        place = F.pmod(F.xxhash64(F.col(f"meta.m{i}")), F.lit(top)) + 1
        values.append(F.when(F.col(f"meta.m{i}").isNull(), F.lit(0).cast("long")).otherwise(place))
    tie = F.shiftrightunsigned("text_hash", 64 - TIE_BITS)
    places = [(v * (1 << TIE_BITS) + tie).alias(f"d{i}") for i, v in enumerate(values)]
    return rows.select("doc_id", "size", "text_crc32", "id_hash", *places)


def kd_shards(
    docs: DataFrame,
    shards: int | None = 8,
    target_bytes: int | None = None,
    dims: tuple[str, ...] = ("lang", "source"),
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = 0.0005,
) -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law, shard, slot, grown_shard.

    ``target_bytes`` instead of ``shards`` sets the number of leaves to total / target. The law is ``bytes``: shard
    sizes differ by the tolerance per split (a share of all bytes) and one document. Equal texts lie in one shard but for
    the groups that a cut falls into, of which there are fewer than shards. Slots count from 0 in each shard
    without gaps, by doc_id. NULL texts weigh 1; repeated (id, text) rows cannot be split from each other but are rows
    with slots of their own.
    """
    dims = [c for c in dims if c in docs.columns]
    points = stored(points_of(docs, id_col, text_col, dims), "points")
    total = points.agg(F.sum("size")).first()[0] or 0
    if shards is None:
        shards = max(1, round(total / target_bytes))
    names = [f"d{i}" for i in range(len(dims) + 1)]
    leaves, placed = {1: shards}, points.withColumn("node", F.lit(1).cast("long"))
    done: dict[int, int] = {}
    while leaves:
        cuts = first_cuts(placed, leaves, names, total * tolerance)
        while not all(c.found for c in cuts):
            refine(placed, cuts)
        placed = descend(placed, cuts)
        below = {}
        for node, n in leaves.items():
            if n == 1:
                done[node] = 1
            else:
                below |= {2 * node: n // 2, 2 * node + 1: n - n // 2}
        leaves = {k: v for k, v in below.items() if v > 1}
        done |= {k: 1 for k, v in below.items() if v == 1}
    shard_of = {node: i for i, node in enumerate(sorted(done, key=lambda k: (f"{k:b}", k)))}
    mapping = F.create_map(*[F.lit(x).cast("long") if i % 2 == 0 else F.lit(x) for kv in shard_of.items() for i, x in enumerate(kv)])
    placed = placed.withColumn("shard", mapping[F.col("node")]).select("doc_id", "size", "text_crc32", "shard")
    return with_slots(placed)


def first_cuts(placed: DataFrame, leaves: dict[int, int], names: list[str], slack: float) -> list[Cut]:
    """The widest dimension of each node that is to be split, and the bytes wanted on its left."""
    nodes = [k for k, n in leaves.items() if n > 1]
    if not nodes:
        return []
    value = lambda d: F.shiftright(d, TIE_BITS)
    spread = [(F.max(value(d)) - F.min(value(d))).alias(f"w_{d}") for d in names]
    rows = placed.where(F.col("node").isin(nodes)).groupBy("node").agg(F.sum("size").alias("bytes"), *spread).collect()
    cuts = []
    for r in rows:
        widest = max(range(len(names)), key=lambda i: (r[f"w_{names[i]}"], -i))
        n = leaves[r.node]
        cuts.append(Cut(r.node, n, widest, 0, SPACE, r.bytes * (n // 2) // n, max(int(slack), 1)))
    return cuts


def refine(placed: DataFrame, cuts: list[Cut]) -> None:
    """One pass: sum bytes over the parts of every open interval, then narrow each interval to the part wanted."""
    open_cuts = [c for c in cuts if not c.found]
    part, known = F.lit(None).cast("long"), F.lit(False)
    for c in open_cuts:
        at = F.col("id_hash") if c.tied else F.col(f"d{c.dim}")
        step = -(-(c.high - c.low) // FANOUT)
        inside = (F.col("node") == c.node) & (at >= c.low) & (at < c.high)
        if c.tied:
            inside &= F.col(f"d{c.dim}") == c.place
        part = F.when(inside, F.expr(f"CAST({'id_hash' if c.tied else f'd{c.dim}'} - {c.low} AS BIGINT) DIV {step}")).otherwise(part)
        known |= inside
    sums: dict[int, dict[int, int]] = {c.node: {} for c in open_cuts}
    for r in placed.where(known).groupBy("node", part.alias("part")).agg(F.sum("size").alias("bytes")).collect():
        sums[r.node][r.part] = r.bytes
    for c in open_cuts:
        step, before = -(-(c.high - c.low) // FANOUT), 0
        for p, n in sorted(sums[c.node].items()):
            if before + n > c.wanted or abs(before + n - c.wanted) <= c.slack:
                break
            before += n
        else:
            p, n = FANOUT, 0
        low, high = c.low + p * step, min(c.low + (p + 1) * step, c.high)
        near, far = abs(c.wanted - before), abs(before + n - c.wanted)
        if min(near, far) <= c.slack or not n:
            end = low if near <= far else high
            if c.tied:
                c.tie_place = end
            else:
                c.place = end
        elif step > 1:
            c.low, c.high, c.wanted = low, high, c.wanted - before
        elif c.tied:  # a single id: it can go to one side only
            c.tie_place = low if near <= far else high
        else:
            c.place, c.tied, c.low, c.high, c.wanted = low, True, 0, 1 << 62, c.wanted - before


def descend(placed: DataFrame, cuts: list[Cut]) -> DataFrame:
    node = F.col("node")
    for c in cuts:
        at, right = F.col(f"d{c.dim}"), F.col("node") * 2 + 1
        if c.tied:
            left = (at < c.place) | ((at == c.place) & (F.col("id_hash") < c.tie_place))
        else:
            left = at < c.place
        node = F.when(F.col("node") == c.node, F.when(left, F.col("node") * 2).otherwise(right)).otherwise(node)
    return placed.withColumn("node", node)


def with_slots(placed: DataFrame) -> DataFrame:
    """Number the rows of each shard by doc_id without putting a shard into one task.

    Rows are ranged over (shard, doc_id) and sorted in each task; a row's number is its position in the task plus the
    rows that the tasks before hold of its shard, of which there are few numbers.
    """
    ranged = stored(
        placed.repartitionByRange(F.col("shard"), F.col("doc_id"), F.col("text_crc32"))
        .sortWithinPartitions("shard", "doc_id", "text_crc32")
        .withColumn("at", F.monotonically_increasing_id()),
        "slots",
    )
    task = F.shiftright("at", 33)
    held = ranged.groupBy("shard", task.alias("task")).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    begins = held.selectExpr(
        "shard", "task", "coalesce(sum(n) OVER (PARTITION BY shard ORDER BY task ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - first AS shift"
    )
    # one line per task and shard: as many as tasks, plus one per shard
    return (
        ranged.withColumn("task", task)
        .join(F.broadcast(begins), ["shard", "task"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
            (F.col("at") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
