"""Packing by cutting-stock column generation (op 1).

A document's ids are cut into full sequences and one remainder.  Remainders
are the items of a cutting-stock problem: how few rolls of ``seq_len`` hold
them all.  Item lengths are rounded up to units, so the problem has at most
``seq_len / unit`` classes whatever the number of documents: only the length
histogram reaches the driver.  There the linear program over patterns is
solved by column generation (revised simplex; an unbounded knapsack dynamic
program prices new patterns), pattern counts are rounded down, and the few
items that are left are packed by best fit into patterns of their own.

Back on the executors each remainder gets its rank within its class (a range
sort of narrow rows; a hot length spans many tasks), and the r-th item of a
class takes the r-th slot that the patterns have for it.

Defined results: null text is empty and is its end id alone; rows that repeat
an id are packed each; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vachan.llm.common import NO_ID, modest_batches, rank_within, slices, store
from vachan.llm.tokens import TOKEN_SLICE, encoder

SEQ_LEN = 2048
UNIT = 8
MAX_COLUMNS = 4000  # patterns that pricing may add; rounding works from any of them


# ---------------------------------------------------------------- cutting stock

def knapsack(value: np.ndarray, capacity: int) -> tuple[float, dict[int, int]]:
    """Best multiset of classes 1..len(value) with total size at most ``capacity``."""
    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        top = min(c, len(value))
        # the last item is of size 1..top, what is before it fills c - size
        options = value[:top] + best[c - top:c][::-1]
        k = int(np.argmax(options))
        if options[k] > best[c - 1] + 1e-12:
            best[c], take[c] = options[k], k + 1
        else:
            best[c] = best[c - 1]
    out: Counter[int] = Counter()
    c = capacity
    while c > 0:
        if take[c]:
            out[int(take[c])] += 1
            c -= int(take[c])
        else:
            c -= 1
    return float(best[capacity]), dict(out)


def column_generation(demand: dict[int, int], capacity: int, limit: int = MAX_COLUMNS) -> list[tuple[dict[int, int], float]]:
    """Fractional optimum of the cutting-stock relaxation: (pattern, times used)."""
    classes = sorted(demand)
    m = len(classes)
    if not m:
        return []
    row = {c: i for i, c in enumerate(classes)}
    # demands are perturbed a little against cycling
    b = np.array([demand[c] for c in classes], float) * (1 + 1e-9 * np.arange(1, m + 1))
    patterns = [{c: capacity // c} for c in classes]
    cost = np.ones(m)
    inverse = np.diag([1.0 / (capacity // c) for c in classes])
    x = inverse @ b
    for _ in range(limit):
        dual = cost @ inverse
        low = int(np.argmin(dual))
        if dual[low] < -1e-9:  # more than is asked for of this class: its surplus enters
            column, price, enters = np.zeros(m), 0.0, {-classes[low]: 1}
            column[low] = -1.0
        else:
            value = np.zeros(capacity)
            value[np.array(classes) - 1] = np.maximum(dual, 0)
            worth, pattern = knapsack(value, capacity)
            if worth <= 1 + 1e-7:
                break
            pattern = {c: k for c, k in pattern.items() if c in row and dual[row[c]] > 0}
            column, price, enters = np.zeros(m), 1.0, pattern
            for c, k in pattern.items():
                column[row[c]] = k
        step = inverse @ column
        up = step > 1e-9
        if not up.any():
            break
        ratio = np.where(up, x / np.where(up, step, 1.0), np.inf)
        leave = int(np.argmin(ratio))
        patterns[leave], cost[leave] = enters, price
        pivot = inverse[leave] / step[leave]
        inverse -= np.outer(step, pivot)
        inverse[leave] = pivot
        x -= step * ratio[leave]
        x[leave] = ratio[leave]
    return [(p, max(0.0, float(t))) for p, t, c in zip(patterns, x, cost, strict=True) if c > 0]


def best_fit(items: dict[int, int], capacity: int) -> list[dict[int, int]]:
    """Pack left-over class counts: each roll takes the largest item that still fits."""
    left, rolls = {c: k for c, k in items.items() if k > 0}, []
    while left:
        room, roll = capacity, Counter()
        for c in sorted(left, reverse=True):
            k = min(left[c], room // c)
            if k:
                roll[c] += k
                room -= k * c
                left[c] -= k
        left = {c: k for c, k in left.items() if k}
        rolls.append(dict(roll))
    return rolls


def plan(histogram: dict[int, int], seq_len: int = SEQ_LEN, unit: int = UNIT) -> list[tuple[dict[int, int], int]]:
    """(pattern over classes, number of rolls) that hold every item of a length histogram."""
    capacity = seq_len // unit
    demand: Counter[int] = Counter()
    for length, k in histogram.items():
        demand[-(-length // unit)] += k
    used: Counter[tuple] = Counter()
    left = dict(demand)
    for pattern, times in sorted(column_generation(dict(demand), capacity), key=lambda p: -p[1]):
        times = int(times + 1e-6)
        times = min([times, *(left[c] // k for c, k in pattern.items())]) if pattern else 0
        if times > 0:
            used[tuple(sorted(pattern.items()))] += times
            for c, k in pattern.items():
                left[c] -= k * times
    for pattern, k in Counter(tuple(sorted(p.items())) for p in best_fit(left, capacity)).items():
        used[pattern] += k
    return [(dict(p), k) for p, k in sorted(used.items())]


def slot_table(rolls: list[tuple[dict[int, int], int]]) -> tuple[dict[int, tuple[np.ndarray, ...]], int]:
    """Per class: first rank, slots per roll and first roll of each pattern that has
    it; and the number of rolls."""
    at, slots, taken = 0, defaultdict(list), Counter()
    for pattern, k in rolls:
        for c, n in pattern.items():
            slots[c].append((taken[c], n, at))
            taken[c] += n * k
        at += k
    return {c: tuple(np.array(v, np.int64) for v in zip(*s, strict=True)) for c, s in slots.items()}, at


# ---------------------------------------------------------------- Spark side

def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, seq_len: int, id_col: str, text_col: str, with_ids: bool) -> DataFrame:
    """One row per piece: id, key, start, length, ids_crc32, doc_tokens (and ids)."""
    schema = "id long, key long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids

    def run(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            for rows, data, off in slices(batch, "text", TOKEN_SLICE):
                ids, at = enc.encode(data, off)
                n = np.diff(at)
                out = np.insert(ids, at[1:], end_id).astype("<u4")  # the end id closes each document
                total = n + 1
                first = np.concatenate([[0], np.cumsum(total)])
                count = -(-total // seq_len)
                doc = np.repeat(np.arange(len(n)), count)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * seq_len
                length = np.minimum(seq_len, total[doc] - start)
                lo = first[doc] + start
                view = memoryview(out).cast("B")
                crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(lo.tolist(), (lo + length).tolist(), strict=True)]
                take = pa.array(doc)
                cols = [rows.column("id").take(take), rows.column("key").take(take), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(total[doc])]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(lo, len(out)).astype(np.int32)), pa.array(out.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=["id", "key", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids)

    d = modest_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, seq_len: int = SEQ_LEN, end_id: int = 1, unit: int = UNIT, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Every id of every document in one piece of one sequence.  Returns (id, start,
    length, ids_crc32, doc_tokens, sequence_id, offset) and, if asked for, the ids."""
    pieces, _ = store(cut_pieces(docs, tokenizer, end_id, seq_len, id_col, text_col, with_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.filter(F.col("length") < seq_len).groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, rolls = slot_table(plan(histogram, seq_len, unit))

    narrow = pieces.select("id", "key", "start", "length", "ids_crc32", "doc_tokens", F.ceil(F.col("length") / unit).alias("class"), *["ids"] * with_ids)
    # full pieces are a class of their own, above the others
    narrow = narrow.withColumn("class", F.when(F.col("length") == seq_len, F.lit(seq_len // unit + 1).cast("long")).otherwise(F.col("class")))
    ranked = rank_within(narrow, "class", ["key", "start", "ids_crc32"], "rank")
    full = seq_len // unit + 1

    def seat(batches):
        for b in batches:
            cls, rank = b.column("class").to_numpy(), b.column("rank").to_numpy()
            seq = np.empty(len(cls), np.int64)
            for c in np.unique(cls):
                own = cls == c
                if c == full:
                    seq[own] = rolls + rank[own]
                else:
                    first, per, base = slots[int(c)]
                    j = np.searchsorted(first, rank[own], "right") - 1
                    seq[own] = base[j] + (rank[own] - first[j]) // per[j]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(seq)], names=[*b.schema.names, "sequence_id"])

    seated = ranked.mapInArrow(seat, T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType())]))
    before = (Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "key", "start", "ids_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    return seated.select("id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")).alias("offset"), *["ids"] * with_ids)
