"""Deterministic sharded WARC writer and its reader (op 9).

Records are sorted by page id.  The running sum of their payload sizes in that
order assigns shards, so shards depend on the rows alone, not on how Spark
sampled or split them.  A task writes its shards one after another: every
record is a gzip member with regenerated WARC and HTTP headers, digests and a
record id made from page id and digest; a file is closed when its compressed
size reaches ``roll_bytes``.  Files get temporary names and are renamed; the
manifest (a Parquet table with name, records, bytes and SHA-1 of each file) is
the commit: a reader opens what it lists and nothing else.

Of records with equal payloads of at least ``min_bytes`` bytes the one with
the smallest page id is a response and the others are revisit records that
refer to it.  Equal payloads are found on (id, digest) rows; a payload that a
third of all pages share costs one row per task.

Defined results: null html is an empty payload; a null page id sorts first and
is written as an empty field; rows that repeat page id and html are written
each, the first as the response; a null url leaves the field out, control
characters in one are percent-encoded; an empty table writes no file; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vachan.llm.common import NO_ID, join_hot, modest_batches, store
from vachan.llm.files import committed, open_input, qualified

SHARD_BYTES = 16 << 20  # payload bytes of a shard
MAX_SHARDS = 1 << 18  # beyond 4 TB of payload shards grow instead, so their bounds stay below 2 MB
ROLL_BYTES = 4 << 20  # compressed bytes after which a file is closed
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE_ID = uuid.UUID("6f2d1c1e-3c7e-5b0a-9a55-0d6f5f0b7a11")

MANIFEST = "shard long, part long, name string, records long, bytes long, sha1 string"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page: int | None, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE_ID, f'{page}/{digest}/{nth}')}>"


def clean_uri(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)


def member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record as a gzip member (no time stamp: equal input, equal bytes)."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers: tuple[int | None] | None, nth: int) -> bytes:
    """The member of one page; ``refers`` holds the response's page id for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers is None else http
    fields = [("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", record_id(page, digest, nth)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", clean_uri(url)))
    fields += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
               ("X-Page-ID", "" if page is None else str(page))]
    if refers is not None:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(refers[0], digest, 0)), ("X-Refers-To-Page-ID", "" if refers[0] is None else str(refers[0]))]
    return member(fields, block)


class Roller:
    """Writes members to ``shard-part`` files below a folder and lists them."""

    def __init__(self, folder: str, roll_bytes: int):
        self.folder, self.roll_bytes, self.files = folder, roll_bytes, []
        self.shard, self.part, self.sink = None, 0, None

    def open(self) -> None:
        self.name = f"shard-{self.shard:06d}-{self.part:04d}.warc.gz"
        self.context = committed(self.folder, self.name)
        self.sink, self.sha, self.bytes, self.records = self.context.__enter__(), hashlib.sha1(), 0, 0
        info = b"software: sharded writer\r\nformat: WARC File Format 1.1\r\n"
        self.put(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, self.name, 0)), ("WARC-Date", DATE), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info))

    def put(self, data: bytes) -> None:
        self.sink.write(data)
        self.sha.update(data)
        self.bytes += len(data)

    def add(self, shard: int, data: bytes) -> None:
        if self.sink is not None and (shard != self.shard or self.bytes >= self.roll_bytes):
            self.close()
        if shard != self.shard:
            self.shard, self.part = shard, 0
        if self.sink is None:
            self.open()
        self.put(data)
        self.records += 1

    def close(self) -> None:
        if self.sink is not None:
            self.context.__exit__(None, None, None)
            self.files.append((self.shard, self.part, self.name, self.records, self.bytes, self.sha.hexdigest()))
            self.sink, self.part = None, self.part + 1


def describe(pages: DataFrame, shard_bytes: int, min_bytes: int) -> tuple[DataFrame, np.ndarray]:
    """One row per (key, sha) with the key of the response to its payload; and the
    least key of each shard after the first, from running sums of payload bytes in
    key order (one number per shard, MAX_SHARDS at most)."""
    narrow = pages.select("key", F.sha1(F.coalesce("html", F.lit(""))).alias("sha"), F.coalesce(F.octet_length("html"), F.lit(0)).alias("n"))
    rows = narrow.groupBy("key", "sha").agg(F.sum("n").alias("bytes"), F.max("n").alias("n"))
    rows, _ = store(rows.repartitionByRange("key", "sha").sortWithinPartitions("key", "sha").withColumn("at", F.monotonically_increasing_id()), "records")
    part = F.shiftright("at", 33)
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    parts = rows.groupBy(part.alias("part")).agg(F.sum("bytes").alias("b"))
    parts = parts.select("part", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("first"),
                         (F.coalesce(F.sum("b").over(before), F.lit(0)) + F.col("b")).alias("upto"))
    running = F.sum("bytes").over(Window.partitionBy("p").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("p", part).withColumn("running", F.coalesce(running, F.lit(0))).join(F.broadcast(parts), F.col("p") == F.col("part"))
    total = parts.agg(F.max("upto")).first()[0] or 0
    shard = F.floor((F.col("first") + F.col("running")) / max(shard_bytes, -(-total // MAX_SHARDS)))
    cuts = placed.groupBy(shard.alias("shard")).agg(F.min("key").alias("key")).select("key").toArrow().column("key").to_numpy()
    first = rows.filter(F.col("n") >= min_bytes).groupBy("sha").agg(F.min("key").alias("first_key"), F.count("*").alias("n_equal"))
    joined = join_hot(rows, first, "sha", "n_equal", rows.count(), "at")
    return joined.select("key", "sha", F.col("g.first_key").alias("first_key")), np.unique(cuts)[1:]


def shard_of(spark: SparkSession, cuts: np.ndarray):
    """Function of a key column: the number of ``cuts`` that are not above the key.  The
    bounds go to the executors once, not into the plan; only keys pass through Python."""
    if not len(cuts):
        return lambda key: F.lit(0).cast("long")
    table = spark.sparkContext.broadcast(cuts)

    @F.pandas_udf("long")
    def find(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(table.value, key.to_numpy(), "right"))

    return find


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, min_bytes: int = 0) -> DataFrame:
    """Write the archives and the manifest below ``folder``; return the manifest."""
    d = modest_batches(pages).select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    folder = qualified(pages.sparkSession, folder)
    info, cuts = describe(d, shard_bytes, min_bytes)
    shard = shard_of(pages.sparkSession, cuts)(F.col("key")).alias("shard")
    # what is known of a payload comes just before its pages; html is shuffled once
    heads = info.select(shard, "key", "sha", F.lit(0).alias("kind"), "first_key", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"))
    bodies = d.select(shard, "key", F.sha1(F.coalesce("html", F.lit(""))).alias("sha"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("first_key"), "url", "html")
    rows = heads.unionByName(bodies).repartitionById(len(cuts) + 1, F.col("shard").cast("int")).sortWithinPartitions("shard", "key", "sha", "kind", "url")

    def run(batches):
        out, first, nth = Roller(folder, roll_bytes), None, 0
        for b in batches:
            html = pc.fill_null(b.column("html"), "")
            cols = [b.column(c).to_pylist() for c in ("shard", "key", "sha", "kind", "first_key", "url")]
            for shard_, key, sha, kind, first_key, url, text in zip(*cols, html, strict=True):
                if not kind:
                    first, nth = first_key, 0
                    continue
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                refers = ((None if first == NO_ID else first),) if first is not None and (first != key or nth) else None
                out.add(shard_, record(None if key == NO_ID else key, url, text.as_buffer().to_pybytes(), digest, refers, nth))
                nth += 1
        out.close()
        if out.files:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out.files, strict=True)], names=["shard", "part", "name", "records", "bytes", "sha1"])

    rows.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def members(source, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The decompressed gzip members of an input, one record in memory."""
    z, parts = zlib.decompressobj(31), []
    while data := bytes(source.read(chunk)):
        while data:
            parts.append(z.decompress(data))
            if not z.eof:
                break
            yield b"".join(parts)
            data, z, parts = z.unused_data, zlib.decompressobj(31), []


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; raises where lengths or digests are wrong."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    n = int(fields["Content-Length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError("record length differs from Content-Length")
    block = rest[:n]
    if "WARC-Block-Digest" in fields and fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError("block digest differs")
    return fields, block


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the manifest's files; digests are computed again."""
    folder = qualified(spark, folder)
    manifest, _ = store(spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("name"), "names")

    def page(text: str) -> int | None:
        return int(text) if text else None

    def run(batches):
        for b in batches:
            for name in b.column("name").to_pylist():
                rows = []
                with open_input(folder, name) as source:
                    for data in members(source):
                        fields, block = parse(data)
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        size = int(http.decode().rsplit("Content-Length: ", 1)[1].split("\r\n")[0])
                        if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
                            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
                        rows.append((page(fields["X-Page-ID"]), size, digest, kind, page(fields["X-Refers-To-Page-ID"]) if kind == "revisit" else None, fields.get("WARC-Target-URI")))
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                     names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])

    return manifest.repartition(max(1, manifest.count()), "name").mapInArrow(run, RECORD)
