"""Merkle manifest of a dataset by butterfly exchange (op 12).

Rows are leaves; per group they ascend by key, and every ``fanout``
consecutive nodes of a level have one parent, up to the group's root.  Group
roots, in order of group, are the leaves of one more tree of the same kind,
whose root stands for the dataset.  A leaf's proof are the siblings on its way
to the root.

1. Leaves are numbered in their group by a distributed ranking, and cut into
   partitions of fanout**BLOCK_LEVELS leaves, each kept as one packed row
   (a group that holds a third of all rows is many partitions).
2. A partition hashes its leaves to its subtree's root.
3. Butterfly: in round r, partitions stand in aligned groups of SWAP subtrees of
   SWAP**r partitions.  Each partition sends its subtree's root to the
   partitions at its place in the other subtrees, so that all of them hold the
   SWAP roots and hash the ancestors above them, each for itself.  After
   log(partitions) / log(SWAP) rounds every partition has its whole upper
   proof and the root; nothing has to be sent down again.  A subtree that has
   fewer partitions than its neighbours serves each of theirs in turn.
4. Proofs are checked where the leaves lie: a leaf as presented, which may differ
   from the one in the manifest, is folded with the siblings to a root.

Rounds move one narrow row per partition and subtree; each is written as a
table, so a lost executor repeats one round at most.

Defined results: null fields are part of the leaf ("-"); a null group comes
first, a null key first in its group; rows that repeat a key are ordered by
leaf; a group of one row has its leaf as root; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vachan.llm.common import drop, rank_within, store

FANOUT = 2
BLOCK_LEVELS = 10  # a partition has fanout**BLOCK_LEVELS leaves
SWAP_LEVELS = 4  # fanout**SWAP_LEVELS subtrees swap their roots in a round

STEPS = "array<struct<left:string,right:string>>"
_STEPS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def field(value: Column) -> Column:
    """``-`` for a null, else the value's UTF-8 byte count, a colon, the value."""
    v = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))


def leaf(*values: Column) -> Column:
    """SHA-256 (lowercase hex) of a row's fields."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(total: int, levels: int, fanout: int) -> int:
    """Nodes of a level that lies ``levels`` above one of ``total`` nodes (1 at least, if any)."""
    for _ in range(levels):
        total = -(-total // fanout)
    return total


def ancestors(nodes: list[str], total: int, levels: int, fanout: int) -> list[list[str]]:
    """The nodes and the levels above them, up to ``levels`` of them or to the top of
    the tree, which has ``total`` nodes beside and including these."""
    out = [nodes]
    for _ in range(levels):
        if total <= 1:
            break
        below = out[-1]
        out.append([digest(below[i:i + fanout]) for i in range(0, len(below), fanout)])
        total = -(-total // fanout)
    return out


def way(levels: list[list[str]], at: int, fanout: int) -> list[tuple[str, str]]:
    """Siblings (left, right) of node ``at`` and its ancestors below the last level."""
    out = []
    for nodes in levels[:-1]:
        a = at - at % fanout
        out.append(("".join(nodes[a:at]), "".join(nodes[at + 1:a + fanout])))
        at //= fanout
    return out


def fold(node: str, steps: Iterable[tuple[str, str]]) -> str:
    for left, right in steps:
        node = digest((left, node, right))
    return node


# ---------------------------------------------------------------- Spark stages

def partitions(ranked: DataFrame, item: str, fanout: int) -> tuple[DataFrame, str]:
    """(grp, block, items, leaves, shown, size): packed partitions of (grp, rank, item, leaf, shown)."""
    width = fanout ** BLOCK_LEVELS

    def pack(table: pa.Table) -> pa.Table:
        t = table.sort_by("rank").combine_chunks()
        n = t.num_rows

        def one(name):
            a = t.column(name).combine_chunks()
            a = a.chunk(0) if isinstance(a, pa.ChunkedArray) else a
            return pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), a)

        return pa.table({"grp": t.column("grp")[:1], "block": t.column("block")[:1], "items": one("item"), "leaves": one("leaf"), "shown": one("shown"), "size": pa.array([n], pa.int64())})

    d = ranked.withColumn("block", F.floor(F.col("rank") / width).cast("long"))
    packed = d.groupBy("grp", "block").applyInArrow(pack, f"grp string, block long, items array<{item}>, leaves array<string>, shown array<string>, size long")
    return store(packed, "merkle-partitions")


def butterfly(blocks: DataFrame, fanout: int) -> DataFrame:
    """(grp, block, node, steps): the group's root and the upper proof of every partition."""
    swap = fanout ** SWAP_LEVELS
    groups = blocks.groupBy("grp").agg(F.count("*").alias("parts"), F.sum("size").alias("total"))
    groups, groups_path = store(groups, "merkle-groups")

    def subtree(batches):
        for b in batches:
            node = [ancestors(x, t, BLOCK_LEVELS, fanout)[-1][0] for x, t in zip(b.column("leaves").to_pylist(), b.column("total").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("grp"), b.column("block"), b.column("parts"), b.column("total"), pa.array(node, pa.string()), pa.array([[]] * len(node), _STEPS)],
                                             names=["grp", "block", "parts", "total", "node", "steps"])

    schema = f"grp string, block long, parts long, total long, node string, steps {STEPS}"
    state, path = store(blocks.select("grp", "block", "leaves").join(groups, "grp").mapInArrow(subtree, schema), "merkle-round")
    most = groups.agg(F.max("parts")).first()[0] or 0
    span, level = 1, BLOCK_LEVELS
    while span < most:
        def climb(batches, level=level):
            for b in batches:
                nodes, steps = [], []
                for got, own, total, known in zip(*(b.column(c).to_pylist() for c in ("got", "own", "total", "steps")), strict=True):
                    levels = ancestors([g["node"] for g in got], height(total, level, fanout), SWAP_LEVELS, fanout)
                    more = way(levels, own % swap, fanout)
                    nodes.append(levels[-1][0])
                    steps.append([*((s["left"], s["right"]) for s in known), *more])
                made = pa.array([[{"left": a, "right": z} for a, z in s] for s in steps], _STEPS)
                yield pa.RecordBatch.from_arrays([b.column("grp"), b.column("block"), b.column("parts"), b.column("total"), pa.array(nodes, pa.string()), made],
                                                 names=["grp", "block", "parts", "total", "node", "steps"])

        def members(t, span=span):  # partitions of a subtree
            return F.least(F.lit(span), F.col("parts") - t * span)

        own = F.floor(F.col("block") / span).cast("long")
        place = F.col("block") - own * span
        last = F.floor((F.col("parts") - 1) / span).cast("long")
        group = own - own % swap
        targets = F.flatten(F.transform(F.sequence(group, F.least(group + swap - 1, last)), lambda t: F.when(
            place < members(t), F.sequence(t * span + place, t * span + members(t) - 1, members(own))).otherwise(F.array().cast("array<long>"))))
        sent = state.select("grp", "parts", "total", "node", own.alias("own"), F.col("block").alias("sender"), "steps", F.explode(targets).alias("block"))
        mine = F.col("sender") == F.col("block")
        received = sent.groupBy("grp", "block").agg(F.first("parts").alias("parts"), F.first("total").alias("total"), F.max(F.when(mine, F.col("own"))).alias("own"),
                                                    F.sort_array(F.collect_list(F.struct("own", "node"))).alias("got"), F.first(F.when(mine, F.col("steps")), ignorenulls=True).alias("steps"))
        before = path
        state, path = store(received.mapInArrow(climb, schema), "merkle-round")
        drop(blocks.sparkSession, before)
        span, level = span * swap, level + SWAP_LEVELS
    drop(blocks.sparkSession, groups_path)
    return state.select("grp", "block", "node", "steps")


def proofs(blocks: DataFrame, upper: DataFrame, item: str, fanout: int) -> DataFrame:
    """(grp, item, leaf, proof_sha256, folded, root, steps) of every leaf; ``upper`` has the
    ways on from the partitions: (grp, block, steps, root) and what else is to be kept."""
    schema = f"grp string, item {item}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, steps {STEPS}"
    with_steps = item == "string"

    def check(batches):
        for b in batches:
            for k in range(b.num_rows):  # one partition at a time
                row = b.slice(k, 1).to_pylist()[0]
                leaves, above = row["leaves"], [(s["left"], s["right"]) for s in row["steps"]]
                levels = ancestors(leaves, row["total"], BLOCK_LEVELS, fanout)
                rest = "".join(x for s in above for x in s).encode()
                hashes, folded, whole = [], [], []
                for i, (own, other) in enumerate(zip(leaves, row["shown"], strict=True)):
                    steps = way(levels, i, fanout)
                    h = hashlib.sha256("".join(x for s in steps for x in s).encode())
                    h.update(rest)
                    hashes.append(h.hexdigest())
                    folded.append(fold(fold(own if other is None else other, steps), above))
                    whole.append([{"left": a, "right": z} for a, z in [*steps, *above]] if with_steps else None)
                n = len(leaves)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["grp"]] * n, pa.string()), pa.array(row["items"], pa.string() if with_steps else pa.int64()), pa.array(leaves, pa.string()), pa.array([row["subroot"]] * n, pa.string()),
                     pa.array([row["root"]] * n, pa.string()), pa.array(hashes, pa.string()), pa.array(folded, pa.string()), pa.array(whole, _STEPS)],
                    names=["grp", "item", "leaf", "subroot", "root", "proof_sha256", "folded_root", "steps"])

    joined = blocks.join(upper, ["grp", "block"])
    return joined.select("grp", "items", "leaves", "shown", "size", "total", "steps", "subroot", "root").mapInArrow(check, schema)


def prove(docs: DataFrame, group: str, key: str, original: Column, presented: Column | None = None, fanout: int = FANOUT) -> DataFrame:
    """(item, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``.

    ``original`` is a row's leaf in the manifest, ``presented`` the leaf that is
    folded with the manifest's siblings (null: the same one); ``verified`` says
    whether that gives the manifest's root.
    """
    spark = docs.sparkSession
    # order and equality of groups as one string: null first, then bytewise
    grp = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    shown = F.lit(None).cast("string") if presented is None else presented
    rows, rows_path = store(docs.select(grp.alias("grp"), F.col(key).cast("long").alias("item"), original.alias("leaf"), shown.alias("shown")), "merkle-leaves")
    blocks, _ = partitions(rank_within(rows, "grp", ["item", "leaf", "shown"]), "long", fanout)
    drop(spark, rows_path)
    lower = butterfly(blocks, fanout)

    # the tree over the groups' roots
    roots = lower.filter("block = 0").select(F.lit("").alias("grp"), F.col("grp").alias("item"), F.col("node").alias("leaf"), F.lit(None).cast("string").alias("shown"))
    tops, _ = partitions(rank_within(roots, "grp", ["item"]), "string", fanout)
    count = tops.groupBy("grp").agg(F.sum("size").alias("total"))
    upper = butterfly(tops, fanout).select("grp", "block", "steps", F.col("node").alias("root"), F.col("node").alias("subroot")).join(count, "grp")
    top, _ = store(proofs(tops, upper, "string", fanout).select(F.col("item").alias("grp"), F.col("steps").alias("on"), "root"), "merkle-tops")

    total = blocks.groupBy("grp").agg(F.sum("size").alias("total"))
    above = lower.join(top, "grp").join(total, "grp").select("grp", "block", "total", F.concat("steps", "on").alias("steps"), F.col("node").alias("subroot"), "root")
    out = proofs(blocks, above, "long", fanout)
    return out.select("item", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
