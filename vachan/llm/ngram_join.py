"""N-gram Jaccard self-join by prefix trees (op 7).

A document's set holds the distinct ``n``-word shingles of its text.  Sets are
globally ordered: by hash, with the most frequent shingles last.

1. Nodes.  Equal sets are one node, found on signatures of the sets; a text
   that a third of all rows repeat is one node.
2. Prefixes.  Two sets with Jaccard similarity t or more share a shingle among
   the first |A| - ceil(t |A|) + 1 of each, and for the smaller set it lies
   among a shorter prefix still.  Prefix shingles are dealt to buckets as
   packed arrays; a bucket sorts the nodes of a shingle by size, splits them
   where sizes are too far apart, and yields star rows (hub, node), so a
   shingle of g nodes costs g rows, not g * g.  Any two linked nodes meet in
   some hub's group.
3. Candidates.  Groups are split into blocks.  A node is paired with its hub and
   with the NEAR nearest fellows of its block.  What can't link is known from
   sizes and from parity bitmaps: |A xor B| is at least the Hamming distance
   of the bitmaps, so this prunes without loss.  A bitmap has about as many
   bits as its set has shingles; two of different lengths are compared after
   folding the longer one.
4. Verification by prefix tree.  The candidates of one probe are put into a tree
   of their ordered sets; paths are walked once, partial overlaps are shared
   by all sets below, and a subtree is left as soon as the overlap so far plus
   the remaining length of the shorter side can't reach what is required.
5. Components of the verified links.  Then, in groups that still hold several
   components, all pairs across components that sizes and bitmaps allow are
   verified: no link between different components can be missed.

Sets are hashes of 63 bits per shingle; nodes are 64-bit hashes of sets, and a
run raises if two different sets share one.

Defined results: a text without words, or null, has an empty set and links
with nothing; a text with fewer than n words has its whole word sequence as
its one shingle; a null id orders below all others; rows that repeat an id
are judged each; an empty table gives an empty result; other columns pass
through ``keep_one`` unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vachan.llm.common import Bloom, join_hot, known_id, mix, modest_batches, NO_ID, rows_with_keys, slices, Spans, store, words
from vachan.llm.components import components

N = 5
PERCENT = 80
LEAST_BITS = 128  # bits of the shortest parity bitmap
HOT = 1 << 16  # most frequent shingles that are ordered last
HOT_IN_TASK = 4  # documents of one task that a shingle needs to be counted
BUCKET_TOKENS = 1_000_000  # prefix shingles of a bucket, on average
BLOCK = 2_000  # nodes of a block of a hub's group
NEAR = 3  # nearest fellows that a node is tried with before all remaining pairs
FLUSH_TOKENS = 600_000  # prefix shingles that a task holds before it writes blobs

TOP = np.uint64(1 << 63)


# ---------------------------------------------------------------- sets

def shingle_sets(data: np.ndarray, off: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(63-bit shingle hashes, document numbers), sorted by document and hash, distinct."""
    low = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    start, end, first = words(low, off)
    docs = len(off) - 1
    count = np.diff(first)
    h = Spans(low).hash(start, end)
    owner = np.repeat(np.arange(docs), count)
    m = max(0, len(h) - n + 1)
    g = h[:m].copy()
    for i in range(1, n):
        g = mix(g * np.uint64(2 * i + 1) + h[i:m + i])
    inside = owner[n - 1:] == owner[:m] if m else np.zeros(0, bool)
    g, o = g[inside], owner[:m][inside]
    # texts of 1 to n - 1 words: the whole sequence
    few = np.flatnonzero((count > 0) & (count < n))
    if len(few):
        whole = np.zeros(len(few), np.uint64)
        for i in range(n - 1):
            more = count[few] > i
            whole[more] = mix(whole[more] * np.uint64(31) + h[first[:-1][few[more]] + i] + np.uint64(n))
        g, o = np.concatenate([g, whole]), np.concatenate([o, few])
    g &= ~TOP
    order = np.lexsort((g, o))
    g, o = g[order], o[order]
    keep = np.ones(len(g), bool)
    keep[1:] = (g[1:] != g[:-1]) | (o[1:] != o[:-1])
    return g[keep], o[keep]


def per_doc(op, values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Reduce the values of each document; documents without any get 0."""
    out = np.zeros(len(size), values.dtype)
    full = size > 0
    if full.any():
        out[full] = op.reduceat(values, (np.cumsum(size) - size)[full])
    return out


def signatures(g: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set, as signed integers."""
    a = mix(per_doc(np.add, mix(g), size) + size.astype(np.uint64))
    b = mix(per_doc(np.bitwise_xor, mix(g + np.uint64(0x632BE59BD9B4E019)), size) * np.uint64(3) + size.astype(np.uint64))
    return a.view(np.int64), b.view(np.int64)


def bitmaps(g: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Parity bitmap of each set: bit b is set if an odd number of shingles hash to
    b.  It has LEAST_BITS * 2**i bits, the least that are no fewer than the shingles."""
    bits = np.maximum(LEAST_BITS, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
    base = np.cumsum(bits) - bits
    h = (mix(g ^ np.uint64(0xA24BAED4963EE407)) >> np.uint64(20)).astype(np.int64)
    at = np.repeat(base, size) + (h & (np.repeat(bits, size) - 1))
    packed = np.packbits((np.bincount(at, minlength=int(bits.sum())) & 1).astype(bool), bitorder="little").tobytes()
    return [packed[x:y] for x, y in zip((base // 8).tolist(), ((base + bits) // 8).tolist(), strict=True)]


class Maps:
    """Bitmaps of several lengths; distances of one to many."""

    def __init__(self, blobs: list[bytes]):
        self.width = np.array([len(x) for x in blobs], np.int64)
        self.place = np.zeros(len(blobs), np.int64)
        self.rows = {}
        for w in np.unique(self.width).tolist():
            own = np.flatnonzero(self.width == w)
            self.place[own] = np.arange(len(own))
            self.rows[w] = np.frombuffer(b"".join(blobs[i] for i in own), np.uint64).reshape(len(own), w // 8)

    @staticmethod
    def fold(x: np.ndarray, words: int) -> np.ndarray:
        while x.shape[-1] > words:
            half = x.shape[-1] // 2
            x = x[..., :half] ^ x[..., half:]
        return x

    def distance(self, i: int, js: np.ndarray) -> np.ndarray:
        out = np.zeros(len(js), np.int64)
        mine = self.rows[int(self.width[i])][self.place[i]]
        for w in np.unique(self.width[js]).tolist():
            own = self.width[js] == w
            words = min(w // 8, len(mine))
            theirs = self.fold(self.rows[w][self.place[js[own]]], words)
            out[own] = np.bitwise_count(theirs ^ self.fold(mine, words)).sum(-1, dtype=np.int64)
        return out


def required(a, b, percent: int = PERCENT):
    """Least intersection with 100 * i >= percent * (a + b - i)."""
    return -(-(percent * (a + b)) // (100 + percent))


def may_link(size_a, size_b, distance, percent: int = PERCENT):
    """Whether sizes and a lower bound of |A xor B| leave a link possible."""
    need = required(size_a, size_b, percent)
    return (need <= np.minimum(size_a, size_b)) & (size_a + size_b - distance >= 2 * need)


# ---------------------------------------------------------------- prefix tree

def tree_overlaps(probe: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[int]:
    """Intersection of ``probe`` with each set, or -1 where it can't reach what a link
    requires.  All arrays are ascending in the global order.

    The tree is walked in lexicographic order of the sets: consecutive sets share the
    path of their common prefix, whose overlaps are on the stack already.  Past it a
    path is walked in steps, and left when overlap plus remaining length is too small.
    """
    out = [-1] * len(sets)
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    path = np.zeros(0, np.uint64)
    hits = np.zeros(1, np.int64)  # overlap after 0, 1, .. shingles of the path
    for i in order:
        s = sets[i]
        m = min(len(path), len(s))
        apart = np.flatnonzero(path[:m] != s[:m])
        depth = min(int(apart[0]) if len(apart) else m, len(hits) - 1)  # a part that was not walked is not shared
        hits = hits[:depth + 1]
        path = s
        need = int(required(len(probe), len(s), percent))
        if need > min(len(probe), len(s)):
            continue
        walked = [hits]
        overlap, at, step, alive = int(hits[-1]), depth, 64, True
        while at < len(s):
            left = len(s) - at
            beyond = len(probe) - int(np.searchsorted(probe, s[at]))
            if overlap + min(left, beyond) < need:
                alive = False
                break
            part = s[at:at + step]
            j = np.searchsorted(probe, part)
            found = np.cumsum(probe[np.minimum(j, len(probe) - 1)] == part)
            walked.append(overlap + found)
            overlap += int(found[-1])
            at += len(part)
            step *= 2
        hits = np.concatenate(walked)
        if alive and overlap >= need:
            out[i] = overlap
    return out


# ---------------------------------------------------------------- Spark stages

def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return modest_batches(docs).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def describe(docs: DataFrame, n: int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """(row, id, tie, size, node) per document, tie a hash of its text; (node, size, bitmap)
    per distinct set with its least row by (id, tie, row); the HOT most frequent shingles,
    ascending by frequency."""
    schema = "kind int, row long, id long, tie long, size long, node long, check long, bitmap binary, text_hash long"

    def run(batches):
        seen: set[int] = set()
        counts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for rows, data, off in slices(batch, "text"):
                g, o = shingle_sets(data, off, n)
                docs_ = len(off) - 1
                size = np.bincount(o, minlength=docs_)
                a, b = signatures(g, size)
                fresh = np.zeros(docs_, bool)
                for i, x in enumerate(a.tolist()):
                    if x not in seen:
                        seen.add(x)
                        fresh[i] = True
                blob = [m if f else None for m, f in zip(bitmaps(g, size), (fresh & (size > 0)).tolist(), strict=True)]
                whole = pa.array(text_hashes(data, off).view(np.int64), mask=~fresh)
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(docs_, np.int32)), rows.column("row"), rows.column("id"), rows.column("tie"), pa.array(size), pa.array(a), pa.array(b), pa.array(blob, pa.binary()), whole],
                                                 names=["kind", "row", "id", "tie", "size", "node", "check", "bitmap", "text_hash"])
                h = np.sort(g[fresh[o]])
                cut = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]])) if len(h) else np.zeros(1, int)
                k = np.diff(cut)
                if (k > 1).any():
                    counts.append((h[cut[:-1]][k > 1], k[k > 1]))
                if len(counts) > 32:
                    counts = [_sum_counts(counts)]
        if counts:
            h, k = _sum_counts(counts)
            h, k = h[k >= HOT_IN_TASK], k[k >= HOT_IN_TASK]
            none = pa.nulls(len(h), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(h), np.int32)), none, none, none, pa.array(k), pa.array(h.view(np.int64)), none, pa.nulls(len(h), pa.binary()), none],
                                             names=["kind", "row", "id", "tie", "size", "node", "check", "bitmap", "text_hash"])

    found, _ = store(docs.withColumn("tie", F.xxhash64("text")).mapInArrow(run, schema), "sets")
    rows = found.filter("kind = 0")
    sets = rows.filter("size > 0")
    nodes, _ = store(sets.groupBy("node").agg(F.min("check").alias("check"), F.max("check").alias("check2"), F.min("size").alias("size"), F.max("bitmap").alias("bitmap"), F.min("text_hash").alias("text_hash"),
                                              F.min(F.struct(F.coalesce("id", F.lit(NO_ID)).alias("id"), "tie", "row")).alias("least"), F.count("*").alias("copies")), "nodes")
    if nodes.filter("check <> check2").limit(1).count():
        raise RuntimeError("two different sets share a 64-bit signature; change the constants of mix()")
    hot = (found.filter("kind = 1").groupBy("node").agg(F.sum("size").alias("k")).orderBy(F.col("k").desc(), "node").limit(HOT).collect())
    hot = np.array([r["node"] for r in hot][::-1], np.int64).view(np.uint64)
    return rows.select("row", "id", "tie", "size", "node"), nodes.select("node", "size", "bitmap", "text_hash", "least", "copies"), hot


def text_hashes(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    return Spans(data).hash(off[:-1], off[1:])


def _sum_counts(counts):
    h, k = np.concatenate([c[0] for c in counts]), np.concatenate([c[1] for c in counts])
    u, inverse = np.unique(h, return_inverse=True)
    return u, np.bincount(inverse, weights=k).astype(np.int64)


class Order:
    """The global order of shingles: by hash, the frequent ones last."""

    def __init__(self, hot: np.ndarray):
        self.sorted = np.sort(hot)
        self.rank = np.argsort(hot).astype(np.uint64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(hot & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def key(self, g: np.ndarray) -> np.ndarray:
        out = g.copy()
        if len(self.sorted):
            at = np.flatnonzero(self.maybe[(g & np.uint64((1 << 20) - 1)).astype(np.int64)])
            j = np.minimum(np.searchsorted(self.sorted, g[at]), len(self.sorted) - 1)
            hit = self.sorted[j] == g[at]
            out[at[hit]] = TOP + self.rank[j[hit]]
        return out


def ordered_sets(data, off, n: int, order: Order) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys in the global order, document numbers, sizes, nodes)."""
    g, o = shingle_sets(data, off, n)
    size = np.bincount(o, minlength=len(off) - 1)
    node, _ = signatures(g, size)
    k = order.key(g)
    hot = k >= TOP
    if hot.any():
        at = np.lexsort((k, o))
        k = k[at]
    return k, o, size, node


def pack_postings(k: np.ndarray, node: np.ndarray, size: np.ndarray, inner: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Postings in text order, dealt to buckets: 40 bits of each shingle's hash beside
    its bucket (a chance equality only adds a candidate), the flag ``inner``, and
    runs of (node, size, count)."""
    h = mix(k)
    bucket, rest = (h % np.uint64(buckets)).astype(np.int64), h // np.uint64(buckets)
    at = np.argsort(bucket, kind="stable")
    bucket, rest, node, size, inner = bucket[at], rest[at], node[at], size[at], inner[at]
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    low = np.ascontiguousarray(rest.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5]
    blobs = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        run = np.flatnonzero(np.concatenate([[True], node[a + 1:b] != node[a:b - 1]]))
        count = np.diff(np.append(run, b - a))
        blobs.append(np.array([b - a, len(run)], np.int64).tobytes() + node[a:b][run].tobytes() + size[a:b][run].astype(np.int32).tobytes() + count.astype(np.int32).tobytes()
                     + np.packbits(inner[a:b]).tobytes() + low[a:b].tobytes())
    return pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]]), pa.array(blobs, pa.binary())], names=["bucket", "postings"])


def unpack_postings(blob) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, node, size, inner) of one blob."""
    m, r = np.frombuffer(blob, np.int64, 2).tolist()
    at = 16
    node = np.frombuffer(blob, np.int64, r, at)
    size = np.frombuffer(blob, np.int32, r, at + 8 * r)
    count = np.frombuffer(blob, np.int32, r, at + 12 * r)
    at += 16 * r
    inner = np.unpackbits(np.frombuffer(blob, np.uint8, -(-m // 8), at), count=m).astype(bool)
    key = np.zeros((m, 8), np.uint8)
    key[:, :5] = np.frombuffer(blob, np.uint8, 5 * m, at + -(-m // 8)).reshape(m, 5)
    return key.view("<u8").ravel(), np.repeat(node, count), np.repeat(size, count).astype(np.int64), inner


def star_pairs(k: np.ndarray, node: np.ndarray, size: np.ndarray, inner: np.ndarray, percent: int) -> np.ndarray:
    """Distinct (hub, node) of the groups of a bucket: nodes that share a shingle, split
    where the next size is out of reach; a group needs an inner member, since the
    smaller set of a linked pair has the shared shingle in its shorter prefix."""
    order = np.lexsort((node, size, k))
    k, node, size, inner = k[order], node[order], size[order], inner[order]
    keep = np.ones(len(k), bool)
    keep[1:] = (k[1:] != k[:-1]) | (node[1:] != node[:-1])
    k, node, size, inner = k[keep], node[keep], size[keep], inner[keep]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (100 * size[:-1] < percent * size[1:])
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(k)))
    good = (count > 1) & np.logical_or.reduceat(inner, start) if len(start) else np.zeros(0, bool)
    hub = np.minimum.reduceat(node, start) if len(start) else node
    use = np.repeat(good, count)
    pair = np.stack([np.repeat(hub, count)[use], node[use]], 1)
    return np.unique(pair, axis=0) if len(pair) else pair


def star_rows(docs: DataFrame, order, buckets: int, n: int, percent: int) -> DataFrame:
    """(hub, node) of all groups."""

    def deal(batches):
        seen: set[int] = set()
        held, count = [], 0

        def blobs():
            return pack_postings(*(np.concatenate(x) for x in zip(*held, strict=True)), buckets)

        for batch in batches:
            for _, data, off in slices(batch, "text"):
                k, o, size, node = ordered_sets(data, off, n, order.value)
                first = np.cumsum(size) - size
                prefix = size - (-(-percent * size // 100)) + 1
                # a larger partner needs an overlap of 2t / (1 + t) of this set at least
                short = size - (-(-2 * percent * size // (100 + percent))) + 1
                fresh = np.zeros(len(size), bool)
                for i, x in enumerate(node.tolist()):
                    if x not in seen:
                        seen.add(x)
                        fresh[i] = True
                place = np.arange(len(k)) - first[o]
                use = (place < prefix[o]) & fresh[o]
                held.append((k[use], node[o[use]], size[o[use]], place[use] < short[o[use]]))
                count += int(use.sum())
                if count >= FLUSH_TOKENS:
                    yield blobs()
                    held, count = [], 0
        if count:
            yield blobs()

    def stars(table: pa.Table) -> pa.Table:
        found = [unpack_postings(x.as_buffer()) for x in table.column("postings")]
        pair = star_pairs(*(np.concatenate(x) for x in zip(*found, strict=True)), percent)
        return pa.table({"hub": pair[:, 0], "node": pair[:, 1]})

    dealt = docs.select("text").mapInArrow(deal, "bucket long, postings binary")
    return dealt.groupBy("bucket").applyInArrow(stars, "hub long, node long").distinct()


def in_blocks(stars: DataFrame, nodes: DataFrame) -> DataFrame:
    """(hub, node, block, blocks): groups in blocks of about BLOCK nodes, sizes and bitmaps joined."""
    total = stars.count()
    groups = stars.groupBy("hub").agg(F.count("*").alias("members"))
    sized = join_hot(stars.withColumn("at", F.concat_ws("/", "hub", "node")), groups, "hub", "members", total, "at")
    blocks = F.ceil(F.col("g.members") / F.lit(BLOCK)).cast("long")
    sized = sized.select("hub", "node", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).alias("block"))
    most = nodes.select(F.col("node").alias("n_node"), "size", "bitmap")
    return sized.join(most, F.col("node") == F.col("n_node")).drop("n_node")


def _dealt(df: DataFrame, rows: int) -> DataFrame:
    tasks = max(1, -(-rows // (10 * BLOCK)))
    return df.withColumn("task", F.pmod(F.xxhash64("hub", "block"), F.lit(tasks)))


PAIRS = "a long, b long, part long"  # part: the block a pair comes from; it bounds what one probe meets in a task


def once(pairs: DataFrame) -> DataFrame:
    """Each pair with one of its blocks."""
    return pairs.groupBy("a", "b").agg(F.min("part").alias("part"))


def pair_table(pairs: list[np.ndarray], part: list[int]) -> pa.Table:
    """Ordered pairs of each block as a table."""
    p = np.sort(np.concatenate([np.zeros((0, 2), np.int64), *pairs]), axis=1)
    of = np.repeat(np.array(part, np.int64), [len(x) for x in pairs])
    return pa.table({"a": p[:, 0], "b": p[:, 1], "part": of})


def first_pairs(members: DataFrame, rows: int, percent: int) -> DataFrame:
    """For each node of a group: its hub and the nearest fellows of the block, as far as
    they may link (distinct unordered pairs)."""
    hubs = members.filter("hub = node AND blocks > 1").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = _dealt(members.filter("NOT (hub = node AND blocks > 1)").unionByName(hubs), rows)

    def run(table: pa.Table) -> pa.Table:
        hub, block, node, size = (table.column(c).to_numpy() for c in ("hub", "block", "node", "size"))
        order = np.lexsort((node != hub, block, hub))  # the hub leads its block
        hub, block, node, size = hub[order], block[order], node[order], size[order]
        maps = Maps(table.column("bitmap").take(pa.array(order)).to_pylist())
        start = np.flatnonzero(np.concatenate([[True], (hub[1:] != hub[:-1]) | (block[1:] != block[:-1])]))
        pairs, part = [], []
        for s, e in zip(start.tolist(), np.append(start[1:], len(hub)).tolist(), strict=True):
            rest = np.arange(s + 1, e)
            ok = rest[may_link(size[rest], size[s], maps.distance(s, rest), percent)]
            found = [np.stack([np.full(len(ok), node[s]), node[ok]], 1)]
            for i in rest if len(rest) > 1 else ():
                fit = rest[(rest != i) & (required(size[rest], size[i], percent) <= np.minimum(size[rest], size[i]))]
                if len(fit):
                    d = maps.distance(i, fit)
                    can = may_link(size[fit], size[i], d, percent)
                    fit = fit[can][np.argsort(d[can], kind="stable")[:NEAR]]
                    found.append(np.stack([np.full(len(fit), node[i]), node[fit]], 1))
            pairs.append(np.concatenate(found))
            part.append(int(hub[s]) ^ int(block[s]))
        return pair_table(pairs, part)

    return once(dealt.groupBy("task").applyInArrow(run, PAIRS))


def cross_pairs(members: DataFrame, labels: DataFrame, rows: int, percent: int) -> DataFrame:
    """All pairs of a group's nodes in different components that may link.  Nodes outside
    the group's largest component go to every block, the others to their own."""
    own = members.join(labels.select(F.col("node").alias("l_node"), "component"), F.col("node") == F.col("l_node"), "left")
    own, _ = store(own.withColumn("component", F.coalesce("component", "node")).drop("l_node"), "labelled")
    sizes = own.groupBy("hub", "component").agg(F.count("*").alias("k"))
    # the largest component of each group, and whether there is another
    main = sizes.groupBy(F.col("hub").alias("m_hub")).agg(F.max(F.struct("k", "component")).alias("m"), F.count("*").alias("parts")).filter("parts > 1")
    split = own.join(main, F.col("hub") == F.col("m_hub"))
    split, _ = store(split.select("hub", "node", "block", "blocks", "size", "bitmap", "component", (F.col("component") != F.col("m.component")).alias("minor")), "split")
    copies = (split.filter("minor AND blocks > 1").withColumn("home", F.col("block"))
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).filter("block <> home").drop("home"))
    dealt = _dealt(split.withColumn("guest", F.lit(False)).unionByName(copies.withColumn("guest", F.lit(True))), rows)

    def run(table: pa.Table) -> pa.Table:
        hub, block, node, size, comp = (table.column(c).to_numpy() for c in ("hub", "block", "node", "size", "component"))
        minor, guest = (table.column(c).to_numpy() for c in ("minor", "guest"))
        order = np.lexsort((block, hub))
        hub, block, node, size, comp, minor, guest = (x[order] for x in (hub, block, node, size, comp, minor, guest))
        maps = Maps(table.column("bitmap").take(pa.array(order)).to_pylist())
        start = np.flatnonzero(np.concatenate([[True], (hub[1:] != hub[:-1]) | (block[1:] != block[:-1])]))
        pairs, part = [], []
        for s, e in zip(start.tolist(), np.append(start[1:], len(hub)).tolist(), strict=True):
            home = np.flatnonzero(~guest[s:e]) + s
            found = [np.zeros((0, 2), np.int64)]
            for i in np.flatnonzero(minor[s:e]) + s:
                fit = home[(comp[home] != comp[i]) & (required(size[home], size[i], percent) <= np.minimum(size[home], size[i]))]
                if len(fit):
                    fit = fit[may_link(size[fit], size[i], maps.distance(i, fit), percent)]
                    found.append(np.stack([np.full(len(fit), node[i]), node[fit]], 1))
            pairs.append(np.concatenate(found))
            part.append(int(hub[s]) ^ int(block[s]))
        return pair_table(pairs, part)

    return once(dealt.groupBy("task").applyInArrow(run, PAIRS))


def candidate_sets(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, known: DataFrame | None, order, n: int) -> DataFrame:
    """(x, keys): ordered sets of all nodes in ``pairs``, those of ``known`` included."""
    wanted = pairs.select(F.col("a").alias("x")).union(pairs.select(F.col("b").alias("x"))).distinct()
    if known is not None:
        wanted = wanted.join(known.select("x"), "x", "left_anti")
    texts = wanted.join(nodes.select("node", "text_hash"), F.col("x") == F.col("node")).select("x", "text_hash")
    texts, _ = store(texts, "wanted")
    if known is not None and not texts.limit(1).count():
        return known
    bloom = Bloom(texts, "text_hash")  # tells by a text's hash whether its set is worth computing

    def sets(batches):
        seen: set[int] = set()
        for batch in batches:
            for _, data, off in slices(batch, "text"):
                pick = np.flatnonzero(bloom.may_contain(text_hashes(data, off)))
                if not len(pick):
                    continue
                size = off[pick + 1] - off[pick]
                end = np.cumsum(size)
                few = data[np.repeat(off[pick] - (end - size), size) + np.arange(int(end[-1]))]
                k, _, count, node = ordered_sets(few, np.concatenate([[0], end]), n, order.value)
                first = np.cumsum(count) - count
                new = [i for i, x in enumerate(node.tolist()) if count[i] and x not in seen and not seen.add(x)]
                yield pa.RecordBatch.from_arrays([pa.array(node[new]), pa.array([k[first[i]:first[i] + count[i]].tobytes() for i in new], pa.binary())], names=["x", "keys"])

    found = docs.select("text").mapInArrow(sets, "x long, keys binary").join(texts.select("x"), "x", "left_semi").dropDuplicates(["x"])
    found, _ = store(found, "candidates")
    return found if known is None else known.unionByName(found)


def verify(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by prefix trees of the candidates of each probe a."""
    # a probe meets the candidates of one block in a task; each part gets the probe's set
    total = pairs.count()
    below = pairs.join(found, F.col("b") == F.col("x")).select("a", "part", "b", "keys")
    probes = pairs.select("a", "part").distinct().join(found, F.col("a") == F.col("x")).select("a", "part", F.lit(None).cast("long").alias("b"), "keys")
    tasks = max(1, -(-total // 2_000))
    rows = below.unionByName(probes).withColumn("task", F.pmod(F.xxhash64("a", "part"), F.lit(tasks)))

    def run(table: pa.Table) -> pa.Table:
        a, part_, b, keys = (table.column(c).to_pylist() for c in ("a", "part", "b", "keys"))
        probes_, lists = {}, {}
        for x, p, y, k in zip(a, part_, b, keys, strict=True):
            s = np.frombuffer(k, np.uint64)
            if y is None:
                probes_[x, p] = s
            else:
                lists.setdefault((x, p), []).append((y, s))
        left, right = [], []
        for (x, p), items in lists.items():
            for (y, _), i in zip(items, tree_overlaps(probes_[x, p], [s for _, s in items], percent), strict=True):
                if i >= 0:
                    left.append(x)
                    right.append(y)
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    links, _ = store(rows.groupBy("task").applyInArrow(run, "a long, b long"), "links")
    return links


def joined_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: only components that a link touches are merged."""
    name = labels.select(F.col("node").alias("n"), "component")
    ends = (links.join(name, F.col("a") == F.col("n"), "left").withColumn("a", F.coalesce("component", "a")).drop("n", "component")
            .join(name, F.col("b") == F.col("n"), "left").withColumn("b", F.coalesce("component", "b")).select("a", "b"))
    merged, _ = store(components(ends).select(F.col("node").alias("old"), F.col("component").alias("new")), "merged")
    moved = labels.join(merged, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component"))
    # nodes that had no label: those of merged that aren't a node of labels
    return moved.unionByName(merged.join(labels.select(F.col("node").alias("old")), "old", "left_anti").select(F.col("old").alias("node"), F.col("new").alias("component")))


def cluster(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """(row, id, tie, n_shingles, component_id, n_copies, kept) for every row of ``docs``.
    ``row`` holds for this read of ``docs`` only; (id, tie), tie a hash of the text, finds
    a row in the next one.  ``kept`` marks one row of each component, and all empty sets."""
    spark: SparkSession = docs.sparkSession
    source = _source(docs, id_col, text_col)
    rows, nodes, hot = describe(source, n)
    order = spark.sparkContext.broadcast(Order(hot))  # HOT entries at most
    tokens = rows.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-int(tokens) * (100 - percent) // 100 // BUCKET_TOKENS))
    stars, _ = store(star_rows(source, order, buckets, n, percent), "stars")
    members, _ = store(in_blocks(stars, nodes), "members")
    count = members.count()
    pairs, _ = store(first_pairs(members, count, percent), "pairs")
    sets = candidate_sets(source, nodes, pairs, None, order, n)
    labels, _ = store(components(verify(pairs, sets, percent)), "labels")
    more, _ = store(cross_pairs(members, labels, count, percent).join(pairs, ["a", "b"], "left_anti"), "pairs")
    if more.limit(1).count():
        linked = verify(more, candidate_sets(source, nodes, more, sets, order, n), percent)
        labels, _ = store(joined_labels(labels, linked), "labels")
    # from nodes to documents: the least row of any node of the component
    named = nodes.join(labels.select(F.col("node").alias("l_node"), "component"), F.col("node") == F.col("l_node"), "left")
    named = named.select("node", "least", "copies", F.coalesce("component", "node").alias("component"))
    least = named.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("first"))
    named = named.join(least, F.col("component") == F.col("c")).select("node", "copies", F.col("first.id").alias("component_id"), F.col("first.row").alias("keep_row"))
    out = join_hot(rows, named, "node", "copies", rows.count(), "row")
    component = F.when(F.col("size") == 0, F.col("id")).otherwise(F.when(F.col("g.component_id") != NO_ID, F.col("g.component_id")))
    kept = (F.col("size") == 0) | F.col("row").eqNullSafe(F.col("g.keep_row"))
    return out.select("row", "id", "tie", F.col("size").alias("n_shingles"), component.alias("component_id"), F.coalesce("g.copies", F.lit(1)).cast("long").alias("n_copies"), kept.alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component one row stays, the
    first by id, a null id before all others, and text hash; of rows equal in both, any
    one.  Empty sets all stay."""
    judged, _ = store(cluster(docs, id_col, text_col).select(known_id(F.col("id")).alias("key"), "tie", "n_shingles", "kept"), "judged")
    text = F.col(text_col).cast("string")
    keys = [known_id(F.col(id_col)), F.xxhash64(text)]
    with_words = judged.filter("kept AND n_shingles > 0").select("key", "tie").distinct()
    # empty sets stay, every row of them; they have no words, so a text tells by itself
    blank = F.coalesce(~text.rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    return docs.filter(blank).unionByName(rows_with_keys(docs.filter(~blank), keys, with_words))
