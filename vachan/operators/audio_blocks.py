"""C2/C3 on fixed-size sample blocks.

A recording is a row per block of BLOCK samples, so no row and no task holds a
recording, however long it is.  Samples are float32 throughout, as decoders
give them.

1. ``mono``: channels of a block become one, with the block's own peak; this is
   the only scan of the source, and its result is written once.
2. ``headers``: rate, length and peak of each recording, aggregated from the
   narrow columns of that table (partial aggregation; no sample is read).
3. ``condition``: blocks divided by their recording's peak.  ``cut``: the samples of
   chunks of seconds.  A chunk is a range of samples; it is dealt to the blocks
   that the range touches, an equi-join on (recording, block), and its pieces
   are put together in their order.  Only a chunk's samples ever meet in a row.

Defined results: a recording without samples has one empty block; a NULL
sample is NaN; a peak that is 0 or NaN leaves samples as they are; channels of
different lengths make the recording's length NULL (a reject); a NULL channel
list has no blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vachan.session import cut_lineage

TARGET_SR = 16_000
BLOCK = 1 << 14  # samples

BLOCK_SCHEMA = "recording_id long, sampling_rate int, block long, channels array<array<float>>"
MONO_SCHEMA = "recording_id long, sampling_rate int, block long, n int, peak float, samples array<float>"

# blocks of a recording that share one copy of its header in a join
SPAN = 256


def to_blocks(waves: DataFrame, size: int = BLOCK) -> DataFrame:
    """Rows that hold a whole recording (``recording_id, sampling_rate, channels``) as
    BLOCK_SCHEMA; for recordings small enough to have come in one row."""
    n = F.coalesce(F.size(F.try_element_at("channels", F.lit(1))), F.lit(0))
    last = F.greatest(F.lit(0).cast("long"), F.floor((n - 1) / size))
    cut = F.transform("channels", lambda ch: F.slice(ch, (F.col("block") * size + 1).cast("int"), F.lit(size)))
    # the last block takes what a longer channel has over, so that its length shows
    rest = F.transform("channels", lambda ch: F.slice(ch, (F.col("block") * size + 1).cast("int"), F.greatest(F.lit(size), F.size(ch))))
    rows = waves.where(F.col("channels").isNotNull()).select("recording_id", "sampling_rate", "channels", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"), last.alias("last"))
    return rows.select("recording_id", "sampling_rate", "block", F.when(F.col("block") == F.col("last"), rest).otherwise(cut).alias("channels"))


def _mono_batches(batches):
    for b in batches:
        each = b.column("channels")
        samples, n, peak = [], [], []
        for i in range(b.num_rows):
            chans = [c.values.to_numpy(zero_copy_only=False).astype(np.float32, copy=False) if c.is_valid else np.zeros(0, np.float32) for c in each[i]] if each[i].is_valid else []
            if len({len(c) for c in chans}) > 1:
                samples.append(np.zeros(0, np.float32))
                n.append(None)
                peak.append(None)
                continue
            x = chans[0] if len(chans) == 1 else np.add.reduce(chans, axis=0, dtype=np.float32) / np.float32(len(chans)) if chans else np.zeros(0, np.float32)
            samples.append(x)
            n.append(len(x))
            peak.append(float(np.max(np.abs(x))) if len(x) else None)
        flat = np.concatenate(samples) if samples else np.zeros(0, np.float32)
        off = np.concatenate([[0], np.cumsum([len(x) for x in samples])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [b.column("recording_id"), b.column("sampling_rate"), b.column("block"), pa.array(n, pa.int32()), pa.array(peak, pa.float32()),
             pa.ListArray.from_arrays(pa.array(off), pa.array(flat, pa.float32()))], names=["recording_id", "sampling_rate", "block", "n", "peak", "samples"])


def mono(blocks: DataFrame) -> DataFrame:
    """MONO_SCHEMA of BLOCK_SCHEMA rows, written once: the mean over channels, sample by
    sample, and the greatest absolute sample of the block."""
    return cut_lineage(blocks.select("recording_id", "sampling_rate", "block", "channels").mapInArrow(_mono_batches, MONO_SCHEMA))


def headers(mono_blocks: DataFrame) -> DataFrame:
    """``recording_id, sampling_rate, blocks, n_samples, peak`` per recording."""
    g = mono_blocks.groupBy("recording_id").agg(
        F.max("sampling_rate").alias("sampling_rate"), F.count("*").alias("blocks"), F.bool_or(F.col("n").isNull()).alias("ragged"),
        F.sum("n").alias("n_samples"), F.max("peak").alias("peak"))
    return g.select("recording_id", "sampling_rate", "blocks", F.when(~F.col("ragged"), F.col("n_samples")).alias("n_samples"), "peak")


def _divide(batches, lists: str, others: list[str], out: str):
    """Lists of samples divided by their row's peak, in float32."""
    for b in batches:
        col = b.column(lists)
        start, flat = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)
        first = int(start[0]) if len(start) else 0
        flat = flat[first:int(start[-1]) if len(start) else 0]
        peak = b.column("peak").to_numpy(zero_copy_only=False).astype(np.float32)
        by = np.where(peak > 0, peak, np.float32(1))  # a NULL or NaN peak compares as false
        made = pa.array((flat / np.repeat(by, np.diff(start))).astype(np.float32), pa.float32())
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in others], pa.ListArray.from_arrays(pa.array((start - first).astype(np.int32)), made)], names=[*others, out])


def condition(mono_blocks: DataFrame, heads: DataFrame) -> DataFrame:
    """``recording_id, block, samples`` with the recording's peak at 1.  A long
    recording's header is dealt once per SPAN blocks, so its blocks don't meet in one task."""
    spans = heads.select(F.col("recording_id").alias("r"), "peak", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / SPAN))).alias("s")).withColumnRenamed("peak", "p")
    j = mono_blocks.join(spans, (F.col("recording_id") == F.col("r")) & (F.floor(F.col("block") / SPAN) == F.col("s")))
    rows = j.select("recording_id", "block", F.col("p").alias("peak"), "samples")
    return rows.mapInArrow(lambda it: _divide(it, "samples", ["recording_id", "block"], "samples"), "recording_id long, block long, samples array<float>")


def sample_range(start_sec: Column, end_sec: Column, n_samples: Column, rate: int = TARGET_SR) -> tuple[Column, Column]:
    """[first, end) of ``int(start * rate) : int(end * rate)``, clamped to the length."""
    s, e = (t * rate for t in (start_sec, end_sec))
    return s.cast("long"), F.least(e.cast("long"), n_samples.cast("long"))


def cut(mono_blocks: DataFrame, chunks: DataFrame, size: int = BLOCK) -> DataFrame:
    """The normalised samples of each chunk.

    ``chunks``: ``recording_id, chunk_id, first, end, peak`` (a range of samples inside the
    recording) and one struct ``rest`` that passes through.  Returns ``recording_id,
    chunk_id, rest, array``; chunks without samples are left out.
    """
    c = chunks.where(F.col("end") > F.col("first")).select("recording_id", "chunk_id", "first", "end", "peak", "rest", F.explode(
        F.sequence(F.floor(F.col("first") / size).cast("long"), F.floor((F.col("end") - 1) / size).cast("long"))).alias("block"))
    narrow = c.select("recording_id", "chunk_id", "first", "end", "block")
    base = F.col("block") * size
    start = F.greatest(F.col("first") - base, F.lit(0).cast("long"))
    stop = F.least(F.col("end") - base, F.lit(size).cast("long"))
    pieces = narrow.join(mono_blocks.select("recording_id", "block", "samples"), ["recording_id", "block"]).select(
        "recording_id", "chunk_id", "block", F.slice("samples", (start + 1).cast("int"), (stop - start).cast("int")).alias("piece"))
    whole = pieces.groupBy("recording_id", "chunk_id").agg(F.sort_array(F.collect_list(F.struct("block", "piece"))).alias("x"))
    whole = whole.select("recording_id", "chunk_id", F.flatten("x.piece").alias("samples"))
    j = whole.join(chunks.select("recording_id", "chunk_id", "peak", "rest"), ["recording_id", "chunk_id"]).select("recording_id", "chunk_id", "rest", "peak", "samples")
    types = {f.name: f.dataType.simpleString() for f in j.schema.fields}
    others = ["recording_id", "chunk_id", "rest"]
    schema = ", ".join(f"{n} {types[n]}" for n in others) + ", array array<float>"
    return j.mapInArrow(lambda it: _divide(it, "samples", others, "array"), schema)
