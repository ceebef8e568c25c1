"""WARC archives through chunked record tables.

Both ways a long payload is rows (record, chunk number, bytes) of at most ``CHUNK`` bytes with the SHA-1 of the payload
up to and with that chunk; the last chunk's digest is the record's. When writing, payloads beyond ``LONG_BYTES`` are cut
where they are read, and only their last rows take part in the search for equal payloads; the chunks of records that keep
their payload are then sorted by record and number and stream into the archive. Shorter payloads are one chunk each and
do not move. A reader or writer holds a few chunks of a record. A payload that another record holds already is a
``revisit`` record: its HTTP header tells the length, its WARC header the digest and the record it refers to.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relfeat.llm.common import bounded, small_batches, stored
from relfeat.llm.files import create, qualified, stream
from relfeat.session import fresh_dir

CHUNK = 64 << 10
# payloads beyond this are written from chunk rows; with BATCH_ROWS it bounds what an Arrow batch holds
LONG_BYTES, BATCH_ROWS = 512 << 10, 128
ROLL_BYTES = 1 << 30
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
CHUNKS = "page_id LONG, record STRING, record_type STRING, refers_to LONG, url STRING, chunk INT, last BOOLEAN, payload_bytes LONG, payload_digest STRING, data BINARY"
LONG_CHUNKS = "record LONG, page_id LONG, url STRING, size LONG, chunk INT, last BOOLEAN, payload_bytes LONG, payload_digest STRING, data BINARY"
ARCHIVES = "path STRING, n_records LONG, n_bytes LONG"
RECORD_URN = re.compile(r"<urn:page:(-?\d+)>")


def running_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes and SHA-1 of each payload up to and with each chunk; the chunks of a record follow each other."""
    sha, done = hashlib.sha1(), 0
    for batch in batches:
        sizes, digests = [], []
        for number, chunks in zip(batch.column("chunk").to_pylist(), chunk_views(batch.column("data"))):
            if number == 0:
                sha, done = hashlib.sha1(), 0
            for data in chunks:
                sha.update(data)
                done += len(data)
            sizes.append(done)
            digests.append(sha.copy().hexdigest())
        out = {c: batch.column(c) for c in ("record", "page_id", "url", "size", "chunk", "last")}
        out |= {"payload_bytes": pa.array(sizes, pa.int64()), "payload_digest": pa.array(digests, pa.string()), "data": batch.column("data")}
        yield pa.RecordBatch.from_pydict(out)


def long_chunks(rows: DataFrame, chunk: int) -> DataFrame:
    """The stored chunk table of payloads, cut and digested in the tasks that read them; ``record`` numbers the rows."""
    rows = rows.withColumn("record", F.monotonically_increasing_id())
    last = F.expr(f"cast((size - 1) DIV {chunk} AS int)")
    cut = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), last)))
    cut = cut.select("record", "page_id", "url", "size", "chunk", (F.col("chunk") == last).alias("last"), F.expr(f"substring(payload, chunk * {chunk} + 1, {chunk})").alias("data"))
    return stored(cut.mapInArrow(running_digests, LONG_CHUNKS), "payload-chunks")


def record_rows(pages: DataFrame, min_bytes: int, id_col: str, url_col: str, html_col: str, chunk: int, long_bytes: int) -> DataFrame:
    """Chunk rows of all records, those of a record in order in one task: page_id, url, digest, size, the page a revisit
    refers to (NULL: the record is a response), chunk, last, data (NULL for a revisit, which has one row).

    Groups of equal payloads come from digests alone. Of long payloads only those that are kept move, as chunks.
    """
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        html.cast("binary").alias("payload"), F.octet_length(html).cast("long").alias("size"),
    )
    short = rows.where(F.col("size") <= long_bytes).withColumn("digest", F.sha1("payload"))
    chunks = long_chunks(rows.where(F.col("size") > long_bytes), chunk)
    ends = chunks.where("last").select("record", "page_id", "url", F.col("payload_digest").alias("digest"), "size")

    sized = short.select("page_id", "digest", "size").unionByName(ends.select("page_id", "digest", "size")).where(F.col("size") >= min_bytes)
    groups = sized.groupBy("digest", "size").agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n"))
    groups = bounded(stored(groups.where("n > 1").drop("n"), "payload-groups"))
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("holder")), F.col("holder")).alias("refers_to")

    head = ["page_id", "url", "digest", "size", "refers_to"]
    one_row = [F.lit(0).alias("chunk"), F.lit(True).alias("last")]
    short = short.join(groups, ["digest", "size"], "left").select("page_id", "url", "digest", "size", refers, "payload")
    short = short.select(*head, *one_row, F.when(F.col("refers_to").isNull(), F.col("payload")).alias("data"))
    ends = stored(ends.join(groups, ["digest", "size"], "left").select("record", "page_id", "url", "digest", "size", refers), "long-records")
    again = ends.where("refers_to IS NOT NULL").select(*head, *one_row, F.lit(None).cast("binary").alias("data"))
    kept = bounded(ends.where("refers_to IS NULL"))
    kept = chunks.select("record", "chunk", "last", "data").join(kept, "record").repartition("record").sortWithinPartitions("record", "chunk")
    return short.unionByName(again).unionByName(kept.select(*head, "chunk", "last", "data"))


def clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value).strip()


def record_head(page_id: int | None, url: str | None, digest: str, size: int, refers_to: int | None, date: str) -> bytes:
    """WARC header and HTTP header of a record; the payload of a response follows."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    name = f"none#{uuid.uuid4().hex}" if page_id is None else str(page_id)
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {clean(url or '')}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (size if refers_to is None else 0)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class ArchiveWriter:
    """Records as members of a gzip file, rolled over to a new file beyond ``ROLL_BYTES``."""

    def __init__(self, out_dir: str):
        self.out_dir, self.file, self.done = out_dir, None, []

    def begin(self, head: bytes) -> None:
        if self.file is None:
            self.path, self.records, self.bytes = f"{self.out_dir}/part-{uuid.uuid4().hex}.warc.gz", 0, 0
            self.file = create(self.path)
        self.packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.add(head)

    def add(self, data: bytes | memoryview) -> None:
        self.put(self.packer.compress(data))

    def end(self) -> None:
        self.put(self.packer.compress(b"\r\n\r\n") + self.packer.flush())
        self.records += 1
        if self.bytes > ROLL_BYTES:
            self.close()

    def put(self, data: bytes) -> None:
        self.bytes += len(data)
        self.file.write(data)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.done.append((self.path, self.records, self.bytes))
            self.file = None


def chunk_views(column: pa.Array, chunk: int = CHUNK) -> Iterator[Iterator[memoryview]]:
    """For each row of a binary column, views of its chunks: nothing is copied."""
    wide = column.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    offsets = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1].tolist()
    whole = memoryview(data if data is not None else b"")
    for a, b in zip(offsets, offsets[1:]):
        yield (whole[i : min(i + chunk, b)] for i in range(a, b, chunk))


def write_warc(
    pages: DataFrame,
    out_dir: str,
    min_bytes: int = 1000,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    chunk: int = CHUNK,
    long_bytes: int = LONG_BYTES,
) -> DataFrame:
    """Write one record per page, return the stored list of archives (path, n_records, n_bytes).

    Of pages with equal payloads of at least ``min_bytes`` the one with the largest id is a response and the others
    revisit it; rows that repeat that id are responses too. NULL html is an empty payload, a NULL id never holds a
    payload for others, a NULL url is an empty target. Payloads beyond ``long_bytes`` are written from rows of ``chunk``
    bytes. The list names only archives of attempts that succeeded.
    """
    spark = pages.sparkSession
    small_batches(spark, BATCH_ROWS)
    out_dir, date = qualified(spark, out_dir), datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(out_dir)
        for batch in batches:
            heads = zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "size", "refers_to")])
            places = zip(batch.column("chunk").to_pylist(), batch.column("last").to_pylist())
            for values, (number, last), pieces in zip(heads, places, chunk_views(batch.column("data"))):
                if number == 0:
                    writer.begin(record_head(*values, date))
                for data in pieces:
                    writer.add(data)
                if last:
                    writer.end()
        writer.close()
        for path, records, size in writer.done:
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records]), pa.array([size])], ["path", "n_records", "n_bytes"])

    rows = record_rows(pages, min_bytes, id_col, url_col, html_col, chunk, long_bytes)
    return stored(rows.mapInArrow(write, ARCHIVES), "archives")


class ArchiveReader:
    """Streams one archive of gzip members; ``pending`` never holds much more than a chunk."""

    def __init__(self, path: str, chunk: int):
        self.file, self.chunk = stream(path), chunk
        self.unpacker, self.rest, self.pending = None, b"", b""

    def fill(self) -> bool:
        """Unpack some more of the current member; false at its end."""
        if self.unpacker is None or self.unpacker.eof:
            return False
        data = self.unpacker.unconsumed_tail or self.file.read(self.chunk)
        if not data and not self.unpacker.eof:
            raise ValueError("archive ends within a record")
        self.pending += self.unpacker.decompress(data, self.chunk)
        if self.unpacker.eof:
            self.rest = self.unpacker.unused_data
        return True

    def next_member(self) -> bool:
        while self.fill():
            self.pending = b""
        if not self.rest:
            self.rest = self.file.read(self.chunk)
        if not self.rest:
            self.file.close()
            return False
        self.unpacker, self.pending = zlib.decompressobj(31), b""
        self.pending += self.unpacker.decompress(self.rest, self.chunk)
        self.rest = self.unpacker.unused_data if self.unpacker.eof else b""
        return True

    def head(self) -> dict[str, str]:
        """Header lines up to the empty line, by lower-case name; the first line under an empty name."""
        while b"\r\n\r\n" not in self.pending:
            if not self.fill():
                raise ValueError("record without a header")
        head, _, self.pending = self.pending.partition(b"\r\n\r\n")
        self.head_bytes = len(head) + 4
        first, *lines = head.decode().split("\r\n")
        return {"": first} | {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}

    def chunks(self, size: int) -> Iterator[bytes]:
        while size:
            want = min(size, self.chunk)
            while len(self.pending) < want:
                if not self.fill():
                    raise ValueError("record is shorter than its header says")
            data, self.pending = self.pending[:want], self.pending[want:]
            size -= want
            yield data


def read_records(path: str, chunk: int) -> Iterator[tuple]:
    """Chunk rows of an archive in order. The digest of a whole payload must be the one in the header."""
    reader = ArchiveReader(path, chunk)
    while reader.next_member():
        warc = reader.head()
        block = int(warc["content-length"])
        http = reader.head()
        payload, size = block - reader.head_bytes, int(http["content-length"])
        told = base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex()
        of, to = RECORD_URN.fullmatch(warc["warc-record-id"]), RECORD_URN.fullmatch(warc.get("warc-refers-to", ""))
        same = (int(of[1]) if of else None, warc["warc-record-id"], warc["warc-type"], int(to[1]) if to else None, warc["warc-target-uri"])
        if warc["warc-type"] == "revisit":
            yield *same, 0, True, size, told, None
            continue
        running, done, number = hashlib.sha1(), 0, 0
        for data in reader.chunks(payload):
            running.update(data)
            done += len(data)
            yield *same, number, done == payload, done, running.copy().hexdigest(), data
            number += 1
        if not payload:
            yield *same, 0, True, 0, running.hexdigest(), b""
        if running.hexdigest() != told or done != size:
            raise ValueError(f"{warc['warc-record-id']}: the payload is not the one that was written")


def read_warc(spark: SparkSession, archives: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunk rows of all archives: what and where the record is, chunk number, whether it is the last, and bytes
    and SHA-1 of the payload up to and with it (for a revisit those of the payload it stands for, and no data)."""
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in CHUNKS.split(", ")]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        keep = len(names) if with_data else len(names) - 1
        return pa.RecordBatch.from_arrays([pa.array(columns[i], kinds[i]) for i in range(keep)], names[:keep])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            rows, held = [], 0
            for row in read_records(path, chunk):
                rows.append(row if with_data else row[:-1])
                held += len(row[-1] or b"") if with_data else 100
                if held > 4 << 20:
                    yield packed(rows)
                    rows, held = [], 0
            if rows:
                yield packed(rows)

    schema = CHUNKS if with_data else CHUNKS.rpartition(", ")[0]
    return archives.select("path").repartition(max(archives.count(), 1)).mapInArrow(read, schema)


def warc_round_trip(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Write into a fresh shared folder and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    The digest and size of a record are those on its last chunk row.
    """
    archives = write_warc(pages, fresh_dir(pages.sparkSession, "warc"), min_bytes)
    chunks = read_warc(pages.sparkSession, archives, with_data=False)
    return chunks.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
