"""Helpers shared by the training-data operators.

Text helpers work on one Arrow batch at a time: the UTF-8 bytes of a slice of
documents lie in one flat buffer, and words, lines and hashes are found by
whole-array numpy steps (no loop over words or documents).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vachan.session import ensure_checkpoint_dir

# Bytes of text handled at once inside a task; bounds the numpy temporaries.
SLICE_BYTES = 1 << 20

# Odd multiplier of the polynomial byte hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)

# Stands for a null id where a plain long is needed: it orders below all others.
NO_ID = -(1 << 63)

# [\x20\x09-\x0D]
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


# ---------------------------------------------------------------- scratch tables

def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once as Parquet in the shared folder; return the table read
    back and its path.  Lost executors don't lose it, and no consumer runs the
    plan above it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


BATCH_ROWS = 2_000  # documents of one Arrow batch


def modest_batches(df: DataFrame) -> DataFrame:
    """Documents are long: unless the session sets its own size, Arrow batches hold
    BATCH_ROWS rows instead of Spark's default, five times as many."""
    key, spark = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(BATCH_ROWS))
    return df


def drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no later step reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


# ---------------------------------------------------------------- Arrow slices

def slices(batch: pa.RecordBatch, col: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows with at most ``limit`` bytes in ``col`` (one
    row at least).  Yields (rows, bytes, offsets); a null text is empty."""
    arr = batch.column(col)
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    width = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    n = len(arr)
    if not n:
        return
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], width)[arr.offset:arr.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at), data[off[at]:off[to]], off[at:to + 1] - off[at]
        at = to


# ---------------------------------------------------------------- hashing

def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64; the longest table is kept."""
    have = _POWERS.get(base)
    if have is None or len(have) < n + 1:
        size = max(n + 1, SLICE_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * SLICE_BYTES:
            _POWERS[base] = have
    return have[:n + 1]


class Spans:
    """Hashes of byte spans of one flat buffer, from prefix sums of
    byte * BASE**position."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n)[:n], out=self.sums[1:])
        self.inverse = powers(BASE_INV, n)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


# ---------------------------------------------------------------- words

def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words [^\\x20\\x09-\\x0D]+ of each document: starts, ends, and per
    document the index of its first word (one more entry than documents)."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    gap = SPACE[data]
    full = off[:-1][off[1:] > off[:-1]]  # first bytes of documents with text
    first = ~gap
    first[1:] &= gap[:-1]
    first[full] = ~gap[full]
    last = ~gap
    last[:-1] &= gap[1:]
    ends = off[1:][off[1:] > off[:-1]] - 1
    last[ends] = ~gap[ends]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, off)


def per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of set flags in each [off[i], off[i+1])."""
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return c[off[1:]] - c[off[:-1]]


def rank_within(df: DataFrame, group: str, order: list[str], name: str = "rank") -> DataFrame:
    """Add the 0-based position of each row in its group (order: ``order``), as ``name``.

    Rows are range-partitioned by (group, order) and written once, so a hot group
    spans many tasks; each (group, task) run gets the offset of the runs before it
    from a table of at most groups + tasks rows.  Rows should be narrow.
    """
    at = F.monotonically_increasing_id()
    rows, _ = store(df.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("__at", at), "ranked")
    part = F.shiftright("__at", 33)
    runs = rows.groupBy(group, part.alias("__part")).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col(group).alias("__group"), "__part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    joined = rows.withColumn("__p", part).join(runs, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__p") == F.col("__part")))
    return joined.withColumn(name, F.col("__before") + F.col("__at") - F.col("__first")).drop("__at", "__p", "__group", "__part", "__first", "__before")


def join_hot(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, row: str, part: int = 10_000) -> DataFrame:
    """Left join of ``rows`` with ``groups`` (one row per ``key``; ``size`` counts the rows
    of the key) as a struct column ``g``, safe for a key that holds a third of all rows.

    Keys with more than 1/part of the rows, of which there are fewer than ``part``,
    are settled by a broadcast join.  Their rows then carry a key of their own
    (``row``, a column that tells rows apart) into the join with all the other keys.
    """
    fields = [c for c in groups.columns if c != key]
    heavy = groups.filter(F.col(size) * part > total).select(F.col(key).alias("__hk"), F.struct(*fields).alias("__h"))
    light = groups.select(F.col(key).cast("string").alias("__lk"), F.struct(*fields).alias("__l"))
    joined = rows.join(F.broadcast(heavy), F.col(key) == F.col("__hk"), "left")
    joined = joined.withColumn("__k", F.when(F.col("__h").isNull(), F.col(key).cast("string")).otherwise(F.concat(F.lit("row "), F.col(row).cast("string"))))
    joined = joined.join(light, F.col("__k") == F.col("__lk"), "left").withColumn("g", F.coalesce("__h", "__l"))
    return joined.drop("__hk", "__h", "__lk", "__l", "__k")


def known_id(col: Column) -> Column:
    """An id as a long, NO_ID for a null one."""
    return F.coalesce(col.cast("long"), F.lit(NO_ID))


def with_keys(docs: DataFrame, keys: list[Column], names: list[str]) -> DataFrame:
    """(one struct of all columns, keys): whatever the columns are called, none clashes."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), *[k.alias(n) for k, n in zip(keys, names, strict=True)])


def rows_with_keys(docs: DataFrame, keys: list[Column], wanted: DataFrame) -> DataFrame:
    """One row of ``docs`` for each row of ``wanted`` (distinct keys), with its columns.

    Rows equal in all keys pass one after another and the first stays; they are
    already together where the join has put them, so nothing is shuffled for it.
    """
    names = wanted.columns
    found = with_keys(docs, keys, names).join(wanted, names, "left_semi").dropDuplicates(names)
    return found.select("whole.*")


# ---------------------------------------------------------------- packed pairs

def pack_pairs(key: np.ndarray, node: np.ndarray, buckets: int) -> pa.RecordBatch:
    """(key, node) pairs dealt to buckets by key, one row of packed arrays per bucket."""
    bucket = (mix(key) % np.uint64(buckets)).astype(np.int64)
    at = np.argsort(bucket, kind="stable")
    key, node, bucket = key[at], node[at], bucket[at]
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(key) else np.zeros(1, np.int64)
    keys, nodes = [], []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        u, inverse = np.unique(node[a:b], return_inverse=True)
        keys.append(key[a:b].tobytes())
        nodes.append(len(u).to_bytes(8, "little") + u.astype(np.int64).tobytes() + inverse.astype(np.int32).tobytes())
    return pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]]), pa.array(keys, pa.binary()), pa.array(nodes, pa.binary())], names=["bucket", "keys", "nodes"])


def unpack_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of all rows of a bucket."""
    keys, nodes = [], []
    for kb, nb in zip(table.column("keys"), table.column("nodes"), strict=True):
        k, raw = np.frombuffer(kb.as_buffer(), np.uint64), nb.as_buffer()
        m = int(np.frombuffer(raw, np.int64, 1)[0])
        keys.append(k)
        nodes.append(np.frombuffer(raw, np.int64, m, 8)[np.frombuffer(raw, np.int32, len(k), 8 + 8 * m)])
    return np.concatenate(keys), np.concatenate(nodes)


# ---------------------------------------------------------------- bounded membership filter

BLOOM_BITS = 1 << 26  # 8 MB, whatever the input; a full filter passes everything and stays right
_SEGMENT = 1 << 20  # bits built by one group


def _bloom_bits(key: np.ndarray) -> np.ndarray:
    h = mix(key.astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
    return np.concatenate([h >> np.uint64(38), (h << np.uint64(20)) >> np.uint64(38)])


class Bloom:
    """May-contain filter of a column of longs.  Its bits are set on the executors and
    only the fixed-size bit array reaches the driver, which broadcasts it.  It saves
    work before an exact join; it never decides alone."""

    def __init__(self, df: DataFrame, col: str):
        def bits(batches):
            for b in batches:
                at = np.unique(_bloom_bits(b.column(0).to_numpy()))
                yield pa.RecordBatch.from_arrays([pa.array((at // _SEGMENT).astype(np.int64)), pa.array((at % _SEGMENT).astype(np.int32))], names=["segment", "bit"])

        def build(table: pa.Table) -> pa.Table:
            flags = np.zeros(_SEGMENT, bool)
            flags[table.column("bit").to_numpy()] = True
            return pa.table({"segment": table.column("segment")[:1], "bits": pa.array([np.packbits(flags).tobytes()], pa.binary())})

        set_ = df.select(F.col(col).cast("long")).mapInArrow(bits, "segment long, bit int").distinct()
        rows = set_.groupBy("segment").applyInArrow(build, "segment long, bits binary").collect()
        whole = np.zeros(BLOOM_BITS // 8, np.uint8)
        for r in rows:
            at = r["segment"] * _SEGMENT // 8
            whole[at:at + _SEGMENT // 8] = np.frombuffer(r["bits"], np.uint8)
        self.bits = df.sparkSession.sparkContext.broadcast(whole)

    def __getstate__(self):
        return {"bits": self.bits}

    def may_contain(self, key: np.ndarray) -> np.ndarray:
        at = _bloom_bits(key)
        hit = (self.bits.value[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & np.uint8(1)
        return hit[:len(key)].astype(bool) & hit[len(key):].astype(bool)
