"""Token sequences in Arrow files of fixed-size-list batches (op 3).

The id stream of all documents, in ascending id order, is cut into sequences
of ``seq_len``; each shard holds a contiguous range of documents as one Arrow
IPC file (the stream format plus a footer) whose batches have BATCH rows of

    tokens  fixed_size_list<uint16 or uint32>[seq_len]
    mask    fixed_size_list<bool>[seq_len]     (false: padding; one bit each)

so sequence i of a shard is row i % BATCH of batch i // BATCH, at a fixed
place in a memory map; tokens and mask bits are views of it, without a copy.  Only the last sequence of a shard is
padded.  Beside it lies a small Arrow file with (id, start, n_tokens) of the
shard's documents, and the manifest, a Parquet table, lists the committed
shards; shard starts in the whole stream are running sums over it.

Shards are ranges of ids between quantiles, found on narrow rows beforehand so
that texts are encoded once.  Only documents' compressed ids are shuffled, and
a writer streams its sorted shards with one batch in memory.  A task writes
temporary names and renames them, so lost executors and repeated attempts
leave the same files.

Defined results: null text is its end id alone; a null id comes first; rows
that repeat an id lie side by side, ordered by their text's hash; an empty
table gives an empty manifest and result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vachan.llm.common import NO_ID, modest_batches, slices, store
from vachan.llm.files import committed, open_input, qualified
from vachan.llm.tokens import TOKEN_SLICE, encoder, largest_id

SEQ_LEN = 2048
BATCH = 64
SHARD_TEXT = 16 << 20  # bytes of text per shard, on average
MAX_SHARDS = 1 << 16  # beyond 1 TB of text shards grow instead, so their bounds stay below 1 MB

MANIFEST = "shard long, n_docs long, n_tokens long, n_sequences long"


def bounds(docs: DataFrame, id_col: str, text_col: str, shard_text: int) -> np.ndarray:
    """Least keys of the shards after the first: quantiles of the ids."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    shards = min(MAX_SHARDS, max(1, -(-size // shard_text)))
    if shards == 1:
        return np.zeros(0, np.int64)
    at = docs.agg(F.percentile_approx(key, [i / shards for i in range(1, shards)], 20 * shards)).first()[0]
    return np.unique(np.array(at, np.int64))


def encode(docs: DataFrame, tokenizer: str, end_id: int, width: str, id_col: str, text_col: str, cuts: np.ndarray) -> DataFrame:
    """(shard, id, key, tie, n_tokens, ids): ids as zstd-compressed little-endian integers."""

    def run(batches):
        enc, codec = encoder(tokenizer), pa.Codec("zstd", 1)
        for batch in batches:
            for rows, data, off in slices(batch, "text", TOKEN_SLICE):
                ids, at = enc.encode(data, off)
                out = np.insert(ids, at[1:], end_id).astype(width)
                total = np.diff(at) + 1
                ends = np.cumsum(total) * out.itemsize
                view = memoryview(out).cast("B")
                blobs = [codec.compress(view[a:b], asbytes=True) for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True)]
                shard = np.searchsorted(cuts, rows.column("key").to_numpy(), "right")
                yield pa.RecordBatch.from_arrays([pa.array(shard), rows.column("id"), rows.column("key"), rows.column("tie"), pa.array(total), pa.array(blobs, pa.binary())],
                                                 names=["shard", "id", "key", "tie", "n_tokens", "ids"])

    d = modest_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"),
                    F.xxhash64(text_col).alias("tie"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, "shard long, id long, key long, tie long, n_tokens long, ids binary")


class ShardWriter:
    """Cuts a stream of ids into batches of sequences."""

    def __init__(self, sink, seq_len: int, width: str):
        self.seq_len, self.width = seq_len, np.dtype(width)
        self.schema = pa.schema([("tokens", pa.list_(pa.from_numpy_dtype(self.width), seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.out = pa.ipc.new_file(sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.held = self.sequences = 0

    def write(self, ids: np.ndarray) -> None:
        size = BATCH * self.seq_len
        while len(ids):
            take = ids[:size - self.held]
            self.parts.append(take)
            self.held += len(take)
            ids = ids[len(take):]
            if self.held == size:
                self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        n = -(-self.held // self.seq_len)
        flat = np.zeros(n * self.seq_len, self.width)
        flat[:self.held] = np.concatenate(self.parts)
        tokens = pa.FixedSizeListArray.from_arrays(pa.array(flat), self.seq_len)
        mask = pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(flat)) < self.held), self.seq_len)
        self.out.write_batch(pa.RecordBatch.from_arrays([tokens, mask], schema=self.schema))
        self.sequences += n
        self.parts, self.held = [], 0

    def close(self) -> None:
        self.flush()
        self.out.close()


def id_width(largest: int, width: str | None = None) -> str:
    """The narrowest integer type that holds all ids; a given one is checked."""
    chosen = width or ("<u2" if largest <= np.iinfo("<u2").max else "<u4")
    if largest > np.iinfo(chosen).max:
        raise ValueError(f"id {largest} doesn't fit into {chosen}")
    return chosen


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, seq_len: int = SEQ_LEN, width: str | None = None,
          id_col: str = "doc_id", text_col: str = "text", shard_text: int = SHARD_TEXT) -> DataFrame:
    """Write the shards and the manifest below ``folder``; return the manifest.
    ``width`` comes from the vocabulary: <u2 up to 65,536 ids, else <u4; a given
    one that is too narrow raises."""
    width, folder = id_width(max(largest_id(tokenizer), end_id), width), qualified(docs.sparkSession, folder)

    def one(shard: int, batches) -> pa.RecordBatch:
        codec, index, at = pa.Codec("zstd", 1), {"id": [], "start": [], "n_tokens": []}, 0
        with committed(folder, f"shard-{shard:06d}.arrow") as sink:
            w = ShardWriter(sink, seq_len, width)
            for b in batches:
                n = b.column("n_tokens").to_numpy()
                for k, blob in zip(n.tolist(), b.column("ids"), strict=True):
                    w.write(np.frombuffer(codec.decompress(blob.as_buffer(), k * np.dtype(width).itemsize), width))
                index["id"].append(b.column("id"))
                index["start"].append(at + np.cumsum(n) - n)
                index["n_tokens"].append(n)
                at += int(n.sum())
            w.close()
        rows = pa.table({"id": pa.chunked_array(index["id"], pa.int64()), "start": np.concatenate(index["start"]), "n_tokens": np.concatenate(index["n_tokens"])})
        with committed(folder, f"shard-{shard:06d}.docs.arrow") as sink, pa.ipc.new_file(sink, rows.schema) as out:
            out.write_table(rows, max_chunksize=1 << 16)
        return pa.RecordBatch.from_pydict({"shard": [shard], "n_docs": [rows.num_rows], "n_tokens": [at], "n_sequences": [w.sequences]})

    def runs(batches):
        """(shard, batch) for each run of rows of one shard."""
        for b in batches:
            shard = b.column("shard").to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else []
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                yield int(shard[lo]), b.slice(lo, hi - lo)

    def run(batches):
        for shard, group in groupby(runs(batches), key=lambda x: x[0]):
            yield one(shard, (b for _, b in group))

    cuts = bounds(docs, id_col, text_col, shard_text)
    rows = encode(docs, tokenizer, end_id, width, id_col, text_col, cuts).repartitionById(len(cuts) + 1, F.col("shard").cast("int"))
    rows = rows.sortWithinPartitions("shard", "key", "tie").select("shard", "id", "n_tokens", "ids")
    rows.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


class Shard:
    """Random access to one shard's sequences."""

    def __init__(self, folder: str, shard: int):
        self.file = pa.ipc.open_file(open_input(folder, f"shard-{shard:06d}.arrow"))
        self.docs = pa.ipc.open_file(open_input(folder, f"shard-{shard:06d}.docs.arrow"))
        self.seq_len = self.file.schema.field("tokens").type.list_size

    def batch(self, i: int) -> np.ndarray:
        """The tokens of a whole batch as a (rows, seq_len) array, a view of the file."""
        return self.file.get_batch(i).column("tokens").flatten().to_numpy(zero_copy_only=True).reshape(-1, self.seq_len)

    def mask(self, i: int) -> pa.BooleanArray:
        """The mask of sequence i, an Arrow view of the file's bits."""
        at = i % BATCH * self.seq_len
        return self.file.get_batch(i // BATCH).column("mask").flatten()[at:at + self.seq_len]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens (a view) and mask, whose bits are unpacked for this sequence alone."""
        return self.batch(i // BATCH)[i % BATCH], self.mask(i).to_numpy(zero_copy_only=False)

    def span(self, start: int, n: int):
        """The ids [start, start + n) of the shard, a view per batch."""
        size = BATCH * self.seq_len
        while n > 0:
            i, lo = divmod(start, size)
            part = self.batch(i).reshape(-1)[lo:lo + n]
            yield part
            start, n = start + len(part), n - len(part)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files."""
    folder = qualified(spark, folder)
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts, _ = store(manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long"))).select("shard", "first"), "shards")

    def run(batches):
        for b in batches:
            for shard, first in zip(b.column("shard").to_pylist(), b.column("first").to_pylist(), strict=True):
                s = Shard(folder, shard)
                for i in range(s.docs.num_record_batches):
                    d = s.docs.get_batch(i)
                    start, n = d.column("start").to_numpy(), d.column("n_tokens").to_numpy()
                    crc = []
                    for a, k in zip(start.tolist(), n.tolist(), strict=True):
                        c = 0
                        for part in s.span(a, k):
                            c = zlib.crc32(part.astype("<u4"), c)
                        crc.append(c)
                    yield pa.RecordBatch.from_arrays([d.column("id"), pa.array(start + first), pa.array(n), pa.array(crc, pa.int64())],
                                                     names=["id", "start", "n_tokens", "ids_crc32"])

    tasks = max(1, starts.count())
    return starts.repartition(tasks, "shard").mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")
