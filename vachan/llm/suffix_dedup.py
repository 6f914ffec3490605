"""Removal of repeated byte strings by blockwise suffix sorting (op 10).

Every byte covered by a LENGTH-byte string that also starts earlier (smaller
id, or same document, earlier start) is removed.  Sorting all suffixes at once
would move a hundred bytes per byte of text, so suffixes are cut down first,
and then sorted one suffix bucket at a time in bounded memory:

1. Texts are written once as a table bucketed by row, which the later steps
   read and join without a shuffle.  Whole copies are set apart by digest.
2. Anchors: in every window of LENGTH bytes the gram of GRAM bytes with the
   least hash (leftmost of equals) is its anchor; equal windows have equal
   anchors at equal distance.  Anchors, one in some 36 bytes, are dealt out
   by hash as packed arrays, those that a task met twice as one entry with a
   count; windows whose anchor occurs once are unique.
3. Segments: for each anchor that occurs again, the text of its windows goes to
   the anchor's suffix bucket.  An anchor that is very frequent is cut into
   single windows, dealt by their own hash, so that no bucket depends on one
   line's count.  Equal segments fall together in the tasks and again in the
   bucket.
4. Each bucket's remaining windows are sorted by difference cover: positions
   whose residue modulo PERIOD lies in a difference cover are the sample;
   sample suffixes are ranked beforehand with their common prefixes; windows
   are sorted by their first PERIOD bytes, and a longer tie of i and j is
   resolved by the ranks of i + d and j + d, both in the sample for some
   d < PERIOD.  Windows that tie for LENGTH bytes are equal; all but the first
   of each class are repeated.
5. Repeated windows return to the texts as intervals, and bytes are removed.

Defined results: null and empty texts have no bytes; texts shorter than LENGTH
lose nothing; a null id orders below all others; rows that repeat an id are
ordered by their row numbers, so a repeated row loses its whole text if it
is long enough; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vachan.llm.common import NO_ID, SLICE_BYTES, Bloom, Spans, join_hot, mix, modest_batches, pack_pairs, slices, store, unpack_pairs

LENGTH = 100
GRAM = 30
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)  # differences of its members modulo 31 are all residues
TABLE_BYTES = 16 << 20  # text per bucket of the table
BUCKET_ANCHORS = 1_000_000  # anchors of a bucket, on average
BUCKET_SEGMENTS = 50_000
HOT_ANCHOR = 20_000  # occurrences above which an anchor is cut into single windows
FLUSH_ANCHORS = 400_000
FLUSH_SEGMENTS = 50_000
SORT_WINDOWS = 100_000  # windows that are sorted at once

POSITION = np.uint64((1 << 23) - 1)


# ---------------------------------------------------------------- anchors

def chunks(batch: pa.RecordBatch, limit: int = SLICE_BYTES, length: int = LENGTH) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    """Slices of documents; one longer than ``limit`` comes in parts that overlap by
    length - 1 bytes, so that each window is in one part.  The last item is where
    the part starts in its document."""
    for rows, data, off in slices(batch, "text", limit):
        if len(data) <= limit:
            yield rows, data, off, 0
        else:
            for a in range(0, max(1, len(data) - length + 1), limit):
                part = data[a:a + limit + length - 1]
                yield rows, part, np.array([0, len(part)]), a


def anchors(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(anchor hash, document, first window start, last window start, anchor position)
    of each anchor, in text order; and the byte hashes."""
    spans = Spans(data)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return np.zeros(0, np.uint64), none, none, none, none, spans
    at = np.arange(len(data) - gram + 1)
    h = spans.hash(at, at + gram)
    low = (h & ~POSITION) | at.astype(np.uint64)
    width, w = length - gram + 1, 1
    while 2 * w <= width:  # least over 2, 4, 8, .. positions
        low = np.minimum(low[:-w], low[w:])
        w *= 2
    if w < width:
        low = np.minimum(low[:len(low) - (width - w)], low[width - w:])
    size = np.diff(off)
    valid = np.zeros(len(data) + 1, np.int32)
    full = size >= length
    np.add.at(valid, off[:-1][full], 1)
    np.add.at(valid, off[1:][full] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    place = (low[starts] & POSITION).astype(np.int64)
    doc = np.searchsorted(off, starts, "right") - 1
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return h[place[first]], doc[first], starts[first], starts[last], place[first], spans


# ---------------------------------------------------------------- sorting by difference cover

def shifts() -> np.ndarray:
    """Least d for two residues with both residue + d in the cover."""
    inside = np.zeros(PERIOD, bool)
    inside[list(COVER)] = True
    out = np.full((PERIOD, PERIOD), -1)
    r = np.arange(PERIOD)
    for d in range(PERIOD - 1, -1, -1):
        a = inside[(r + d) % PERIOD]
        out[a[:, None] & a[None, :]] = d
    assert (out >= 0).all(), "not a difference cover"
    return out


SHIFT = shifts()


def ranked_sample(text: np.ndarray, near: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each sample position (-1 elsewhere) by its suffix's first ``length``
    bytes, and the common prefix of each ranked suffix with the one before.  Only
    sample positions within PERIOD after one of ``near`` are needed."""
    reach = np.zeros(len(text) + 1, np.int64)
    np.add.at(reach, near, 1)
    np.add.at(reach, near + PERIOD, -1)
    position = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
    inside = np.zeros(PERIOD, bool)
    inside[list(COVER)] = True
    sample = position[inside[position % PERIOD]]
    wide = -(-length // 8) * 8
    padded = np.zeros((len(sample), wide), np.uint8)
    padded[:, :length] = np.lib.stride_tricks.sliding_window_view(text, length)[sample]
    order = np.lexsort(padded.view(">u8").astype(np.uint64).T[::-1])
    rank = np.full(len(text), -1, np.int64)
    rank[sample[order]] = np.arange(len(sample))
    padded = padded[order]
    apart = padded[1:] != padded[:-1]
    common = np.where(apart.any(axis=1), apart.argmax(axis=1), length)
    return rank, np.concatenate([[0], common])


def equal_windows(text: np.ndarray, start: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Class number of each window text[start:start + length]; equal windows share one."""
    padded = np.concatenate([text, np.zeros(length + PERIOD, np.uint8)])
    head = -(-PERIOD // 8) * 8
    key = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, head)[start]).view(">u8").astype(np.uint64)
    order = np.lexsort(key.T[::-1])
    same = np.zeros(len(start) + 1, bool)
    same[1:-1] = (key[order[1:]] == key[order[:-1]]).all(axis=1)
    group = np.empty(len(start), np.int64)
    group[order] = np.cumsum(~same[:-1]) - 1
    out = group.copy()  # right for windows whose first bytes are theirs alone
    tied = same[:-1] | same[1:]
    open_ = order[tied]
    if not len(open_):
        return out
    rank, common = ranked_sample(padded, start[open_], length)
    levels: dict[int, np.ndarray] = {}
    done = len(start)
    draw = np.random.default_rng(7)
    while len(open_):
        # each group of ties: a pivot, and every member below, equal or above by cover ranks
        at = np.lexsort((draw.random(len(open_)), group[open_]))
        open_ = open_[at]
        new = np.ones(len(open_), bool)
        new[1:] = group[open_[1:]] != group[open_[:-1]]
        lead = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        pivot = start[open_[lead]][number]
        mine = start[open_]
        d = SHIFT[mine % PERIOD, pivot % PERIOD]
        sign = np.zeros(len(open_), np.int64)
        for shift in np.unique(d).tolist():
            own = np.flatnonzero(d == shift)
            if shift not in levels:  # ranks that agree for length - shift bytes share a level
                levels[shift] = np.cumsum(common < length - shift, dtype=np.int32)
            sign[own] = np.sign(levels[shift][rank[mine[own] + shift]] - levels[shift][rank[pivot[own] + shift]])
        equal = sign == 0
        out[open_[equal]] = done + number[equal]
        done += len(lead)
        group[open_] = number * 2 + (sign > 0)
        open_ = open_[~equal]
    return out


def repeated(text: np.ndarray, seg: dict[str, np.ndarray], length: int) -> np.ndarray:
    """Per window of the segments (in order): whether an equal one starts earlier.
    Segments lie one after another in ``text``; they are handled in runs of whole
    groups, or, within a group with many windows, offset by offset."""
    n = seg["n"]
    base = np.cumsum(n + length - 1) - (n + length - 1)
    window = np.cumsum(n) - n
    flags = np.zeros(int(n.sum()), bool)
    cut = np.flatnonzero(np.concatenate([[True], seg["k"][1:] != seg["k"][:-1], [True]])) if len(n) else np.zeros(1, np.int64)
    sums = np.concatenate([[0], np.cumsum(n)])
    g = 0
    while g < len(cut) - 1:
        e = max(g + 1, int(np.searchsorted(sums[cut], sums[cut[g]] + SORT_WINDOWS, "right")) - 1)
        _sort_run(text, seg, np.arange(cut[g], cut[e]), base, window, flags, length)
        g = e
    return flags


def _sort_run(text, seg, rows, base, window, flags, length) -> None:
    n = seg["n"][rows]
    owner = np.repeat(np.arange(len(rows)), n)
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    if len(owner) > 2 * SORT_WINDOWS:  # one group: windows at different distances from its anchor differ
        distance = seg["rel"][rows][owner] - step
        for d in np.unique(distance):
            own = distance == d
            _classes(text, seg, rows[owner[own]], step[own], base, window, flags, length)
    else:
        _classes(text, seg, rows[owner], step, base, window, flags, length)


def _classes(text, seg, row, step, base, window, flags, length) -> None:
    begin = base[row] + step
    lo, hi = int(begin.min()), int(begin.max()) + length
    if hi - lo > 4 * length * len(begin):  # few windows of a wide stretch: copy them together
        part = text[(begin[:, None] + np.arange(length)).ravel()]
        cls = equal_windows(part, np.arange(len(begin)) * length, length)
    else:
        cls = equal_windows(text[lo:hi], begin - lo, length)
    order = np.lexsort((seg["pos"][row] + step, seg["row"][row], seg["key"][row], cls))
    c = cls[order]
    later = np.zeros(len(c), bool)
    later[1:] = c[1:] == c[:-1]
    flags[(window[row] + step)[order[later]]] = True


# ---------------------------------------------------------------- Spark stages

SEGMENT = {"k": np.uint64, "h": np.uint64, "row": np.int64, "key": np.int64, "pos": np.int64, "n": np.int64, "rel": np.int64}
INTERVAL = "row long, first long, last long"  # window starts, both inclusive


def collapse(seg: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(segments to keep, in the order of their groups; repeats of those)."""
    order = np.lexsort((seg["pos"], seg["row"], seg["key"], seg["n"], seg["rel"], seg["h"], seg["k"]))
    same = np.ones(len(order), bool)
    same[:1] = False
    for c in ("k", "h", "n", "rel"):
        v = seg[c][order]
        same[1:] &= v[1:] == v[:-1]
    return order[~same], order[same]


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    end = np.cumsum(size)
    return data[np.repeat(start - (end - size), size) + np.arange(int(end[-1]) if len(end) else 0)]


def join_windows(row: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of window starts (both ends inclusive) with those of a row that overlap or
    touch joined to one."""
    if not len(row):
        return row, first, last
    order = np.lexsort((first, row))
    row, first, last = row[order], first[order], last[order]
    turn = np.concatenate([[False], row[1:] != row[:-1]])
    shift = np.cumsum(turn) * (int(last.max()) + 2)  # rows apart from each other on one axis
    reach = np.maximum.accumulate(last + shift)
    new = np.ones(len(row), bool)
    new[1:] = turn[1:] | (first[1:] + shift[1:] > reach[:-1] + 1)
    end = np.append(np.flatnonzero(new)[1:], len(row)) - 1
    return row[new], first[new], (reach - shift)[end]


def write_table(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """Texts as a table bucketed by row: (row, id, key, text)."""
    spark = docs.sparkSession
    d = modest_batches(docs).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                    F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"), F.col(text_col).cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    buckets, name = max(1, -(-size // TABLE_BYTES)), f"llm_texts_{uuid.uuid4().hex}"
    d.repartition(buckets, "row").write.format("parquet").bucketBy(buckets, "row").saveAsTable(name)
    return spark.table(name), name


def frequent_anchors(texts: DataFrame, size: int, length: int) -> tuple[DataFrame, Bloom]:
    """(row, anchors): hashes of the row's anchors that occur again; and a filter that
    holds those that are very frequent.

    A task settles what it meets twice: those (row, anchor) pairs don't travel, and of
    the anchor one entry with its count does, so a bucket gets an anchor at most
    once per FLUSH_ANCHORS, however many texts hold it.
    """
    buckets = max(1, -(-size // (36 * BUCKET_ANCHORS)))

    def settle(keys: list[np.ndarray], rows: list[np.ndarray]):
        k, row = np.concatenate(keys), np.concatenate(rows)
        order = np.lexsort((row, k))
        k, row = k[order], row[order]
        start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        count = np.diff(np.append(start, len(k)))
        several = np.repeat(count > 1, count)
        lead = start[count > 1]  # a negative node is a number of pairs settled here
        yield pack_pairs(np.concatenate([k[~several], k[lead]]), np.concatenate([row[~several], -count[count > 1]]), buckets)
        if len(lead):
            own = several.copy()
            own[1:] &= (k[1:] != k[:-1]) | (row[1:] != row[:-1])
            done = pack_pairs(k[own], row[own], 1)
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), done.column("keys"), done.column("nodes")], names=["bucket", "keys", "nodes"])

    def deal(batches):
        keys, rows, held = [], [], 0
        for batch in batches:
            for r, data, off, _ in chunks(batch, length=length):
                k, doc, *_ = anchors(data, off, length)
                keys.append(k)
                rows.append(r.column("row").to_numpy()[doc])
                held += len(k)
                if held >= FLUSH_ANCHORS:
                    yield from settle(keys, rows)
                    keys, rows, held = [], [], 0
        if held:
            yield from settle(keys, rows)

    def again(table: pa.Table) -> pa.Table:
        k, node = unpack_pairs(table)
        order = np.lexsort((node, k))
        k, node = k[order], node[order]
        start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        times = np.add.reduceat(np.where(node < 0, -node, 1), start)
        keep = np.repeat(times > 1, np.diff(np.append(start, len(k)))) & (node >= 0)
        keep[1:] &= (k[1:] != k[:-1]) | (node[1:] != node[:-1])
        hot = k[start[times > HOT_ANCHOR]]  # row -1: the anchor itself, as very frequent
        return pa.table({"row": np.concatenate([node[keep], np.full(len(hot), -1)]), "anchor": np.concatenate([k[keep], hot]).view(np.int64)})

    def settled(batches):
        for b in batches:
            for i in range(b.num_rows):
                k, row = unpack_pairs(pa.Table.from_batches([b.slice(i, 1)]))
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(k.view(np.int64))], names=["row", "anchor"])

    dealt, _ = store(texts.select("row", "text").mapInArrow(deal, "bucket long, keys binary, nodes binary"), "anchor-pairs")
    found, _ = store(dealt.filter("bucket >= 0").groupBy("bucket").applyInArrow(again, "row long, anchor long"), "anchors-again")
    hot = Bloom(found.filter("row < 0"), "anchor")
    pairs = found.filter("row >= 0").unionByName(dealt.filter("bucket < 0").mapInArrow(settled, "row long, anchor long"))
    return pairs.groupBy("row").agg(F.collect_list("anchor").alias("anchors")), hot


def segments(texts: DataFrame, wanted: DataFrame, hot: Bloom, buckets: int, length: int) -> DataFrame:
    """(bucket, head, body): packed segments; bucket -1 holds intervals that a task
    found repeated by itself, those of one row that touch joined to one: a passage that
    a task meets again is one row, whatever number of windows it has."""

    def emit(held: list[tuple[dict, np.ndarray]]):
        seg = {c: np.concatenate([s[c] for s, _ in held]) for c in SEGMENT}
        size = seg["n"] + length - 1
        text = np.concatenate([t for _, t in held])
        begin = np.cumsum(size) - size
        keep, again = collapse(seg)
        codec = pa.Codec("zstd", 1)
        names, heads, bodies = [], [], []
        bucket = (mix(seg["k"][keep]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        keep, bucket = keep[order], bucket[order]
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(keep) else np.zeros(1, np.int64)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            own = keep[a:b]
            names.append(int(bucket[a]))
            heads.append(codec.compress(b"".join(seg[c][own].astype(t).tobytes() for c, t in SEGMENT.items()), asbytes=True))
            bodies.append(codec.compress(gather(text, begin[own], size[own]).tobytes(), asbytes=True))
        out = [pa.array(names, pa.int64()), pa.array([int(x) for x in np.diff(cut)], pa.int64()), pa.array(heads, pa.binary()), pa.array(bodies, pa.binary())]
        yield pa.RecordBatch.from_arrays([*out, *[pa.nulls(len(names), pa.int64())] * 3], names=["bucket", "segments", "head", "body", "row", "first", "last"])
        row, first, last = join_windows(seg["row"][again], seg["pos"][again], seg["pos"][again] + seg["n"][again] - 1)
        m = len(row)
        if m:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, -1)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()), pa.array(row), pa.array(first), pa.array(last)],
                                             names=["bucket", "segments", "head", "body", "row", "first", "last"])

    def run(batches):
        held, count = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                known = np.sort(batch.column("anchors")[i].values.to_numpy().view(np.uint64))
                row, key = batch.column("row")[i].as_py(), batch.column("key")[i].as_py()
                for _, data, off, base in chunks(batch.slice(i, 1), length=length):
                    k, _, lo, hi, place, spans = anchors(data, off, length)
                    if not len(k):
                        continue
                    j = np.minimum(np.searchsorted(known, k), len(known) - 1)
                    use = known[j] == k
                    k, lo, hi, place = k[use], lo[use], hi[use], place[use]
                    often = hot.may_contain(k)  # one passed by mistake is so everywhere, and only costs more
                    if often.any():  # single windows, by their own hash
                        n = (hi - lo + 1)[often]
                        one = np.repeat(lo[often] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                        calm = ~often
                        k = np.concatenate([k[calm], spans.hash(one, one + length)])
                        place = np.concatenate([place[calm], one])  # the window is its own anchor
                        lo, hi = np.concatenate([lo[calm], one]), np.concatenate([hi[calm], one])
                    if len(k):
                        n = hi - lo + 1
                        seg = {"k": k, "h": spans.hash(lo, hi + length), "row": np.full(len(k), row), "key": np.full(len(k), key), "pos": lo + base, "n": n, "rel": place - lo}
                        held.append((seg, gather(data, lo, n + length - 1)))
                        count += len(k)
                if count >= FLUSH_SEGMENTS:
                    yield from emit(held)
                    held, count = [], 0
        if held:
            yield from emit(held)

    joined = texts.select("row", "key", "text").join(wanted.hint("merge"), "row")
    return joined.mapInArrow(run, "bucket long, segments long, head binary, body binary, row long, first long, last long")


def repeated_intervals(packed: DataFrame, length: int) -> DataFrame:
    """Sort each suffix bucket and return its repeated windows as intervals."""

    def run(table: pa.Table) -> pa.Table:
        codec = pa.Codec("zstd")
        width = sum(np.dtype(t).itemsize for t in SEGMENT.values())
        parts, texts = [], []
        for m, head, body in zip(table.column("segments").to_pylist(), table.column("head"), table.column("body"), strict=True):
            raw, at, seg = codec.decompress(head.as_buffer(), m * width), 0, {}
            for c, t in SEGMENT.items():
                seg[c] = np.frombuffer(raw, t, m, at)
                at += m * np.dtype(t).itemsize
            parts.append(seg)
            texts.append(np.frombuffer(codec.decompress(body.as_buffer(), int((seg["n"] + length - 1).sum())), np.uint8))
        seg = {c: np.concatenate([p[c] for p in parts]) for c in SEGMENT}
        text = np.concatenate(texts)
        size = seg["n"] + length - 1
        begin = np.cumsum(size) - size
        keep, again = collapse(seg)
        out = [(seg["row"][again], seg["pos"][again], seg["pos"][again] + seg["n"][again] - 1)]
        # an anchor with one segment left has nothing to tie with: its windows differ in their distance to it
        k = seg["k"][keep]
        same = k[1:] == k[:-1]
        several = np.zeros(len(k), bool)
        several[1:] |= same
        several[:-1] |= same
        keep = keep[several]
        if len(keep):
            own = {c: v[keep] for c, v in seg.items()}
            flags = repeated(gather(text, begin[keep], size[keep]), own, length)
            n = own["n"]
            owner = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(flags)) - np.repeat(np.cumsum(n) - n, n)
            at = np.flatnonzero(flags)
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
            first = at[new]
            last = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] if len(at) else at
            out.append((own["row"][owner[first]], own["pos"][owner[first]] + step[first], own["pos"][owner[last]] + step[last]))
        row, first, last = join_windows(*(np.concatenate(x) for x in zip(*out, strict=True)))
        return pa.table({"row": row, "first": first, "last": last})

    return packed.groupBy("bucket").applyInArrow(run, INTERVAL)


def merge(first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal byte runs [start, end) covered by windows with these starts."""
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.maximum.accumulate(last[order] + length)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    return start[new], end[np.append(np.flatnonzero(new)[1:], len(start)) - 1] if len(start) else end


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_kept: bool = False) -> DataFrame:
    """(row, id, n_bytes, n_removed, n_spans, kept_sha256, spans) for every row of ``docs``:
    ``spans`` are the removed byte ranges [start, end); with ``with_kept`` the
    remaining bytes come too."""
    spark = docs.sparkSession
    texts, name = write_table(docs, id_col, text_col)
    # whole copies: one row of each text stays in the search
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    digests, _ = store(texts.select("row", "key", sha.alias("sha"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")), "digests")
    first = digests.groupBy("sha").agg(F.min(F.struct("key", "row")).alias("first"), F.count("*").alias("n_equal"))
    marked = join_hot(digests, first, "sha", "n_equal", digests.count(), "row")
    marked, _ = store(marked.select("row", "n_bytes", (F.col("row") != F.col("g.first.row")).alias("copy"), (F.col("g.n_equal") > 1).alias("has_copy")), "marked")
    size = marked.agg(F.sum("n_bytes")).first()[0] or 0
    search = marked.filter((F.col("n_bytes") >= length) & ~F.col("copy")).select("row")
    single = texts.join(search.hint("merge"), "row", "left_semi")

    repeated_anchors, hot = frequent_anchors(single, size, length)
    wanted, _ = store(repeated_anchors, "anchors")
    entries = wanted.agg(F.sum(F.size("anchors"))).first()[0] or 0
    packed, _ = store(segments(single, wanted, hot, max(1, -(-entries // BUCKET_SEGMENTS)), length), "segments")
    found = packed.filter("bucket = -1").select("row", "first", "last").unionByName(repeated_intervals(packed.filter("bucket >= 0").select("bucket", "segments", "head", "body"), length))
    intervals, _ = store(found, "intervals")

    each = intervals.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    notes = marked.select("row", "copy").join(each, "row", "left")
    schema = "row long, id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>" + ", kept binary" * with_kept

    def cut(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for text, copy, runs in zip(b.column("text"), b.column("copy").to_pylist(), b.column("runs"), strict=True):
                buf = text.as_buffer() if text.is_valid else None
                data = memoryview(buf) if buf is not None else memoryview(b"")
                if copy and len(data) >= length:
                    start, end = np.array([0]), np.array([len(data)])
                elif runs.is_valid:
                    flat = runs.values.flatten()
                    start, end = merge(flat[0].to_numpy(), flat[1].to_numpy(), length)
                else:
                    start = end = np.zeros(0, np.int64)
                kept = [data[a:z] for a, z in zip([0, *end.tolist()], [*start.tolist(), len(data)], strict=True)]
                digest = hashlib.sha256()
                for k in kept:
                    digest.update(k)
                spans = [{"start": a, "end": z} for a, z in zip(start.tolist(), end.tolist(), strict=True)]
                for c, v in zip(cols, [len(data), int((end - start).sum()), len(start), digest.hexdigest(), spans, b"".join(kept) if with_kept else b""], strict=True):
                    c.append(v)
            types = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(cols, types, strict=True)][:5 + with_kept]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("id"), *arrays], names=["row", "id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"] + ["kept"] * with_kept)

    out, _ = store(texts.join(notes.hint("merge"), "row").select("row", "id", "text", "copy", "runs").mapInArrow(cut, schema), "result")
    spark.sql(f"DROP TABLE {name}")
    return out
