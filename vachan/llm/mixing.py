"""Mixing sources to target weights by pivotal dependent rounding (op 6).

A source with target T and size S asks for T / S copies of each of its
documents: a whole part, and a fraction p that has to be rounded to 0 or 1.
Rounding is dependent: two fractional documents meet, and mass moves at random
from one to the other, measured in words, until one of them is integral, so
that the expected copies of each document and the source's words are both
kept.  One fractional document leaves each block.  Blocks hold a bounded
number of rows (a source with a third of all rows has many), and their
residuals meet block by block in a reduction tree until one is left per
source; of that last document the leading part is taken that its mass pays
for, so a source ends within one word of its target.

Random numbers are hashes of the ids, block numbers come from exact counts:
reruns on any number of machines agree.

Defined results: null text has size 0; a null source is a source of its own,
last in order; documents of size 0 take nothing; rows that repeat an id are
separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vachan.llm.common import known_id, modest_batches, NO_ID, slices, store, with_keys, words

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
BLOCK = 2_000  # rows of a leaf block, on average
FAN_IN = 64  # residuals that meet in one block of the tree

STATE = "row long, key long, source string, size long, p double, u double, node long, settled boolean"


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, docs, source_size) -> with ``target``.  Weights repeat over the sources
    in code point order (null last); what a capped source can't take is shared by weight
    among the rest, until none is above its cap.

    Water-filling in closed form: a source is capped when cap*size/weight is below
    the water level, so sources sorted by that ratio are capped in order; the level
    follows from running sums.  Only (sources) rows take part.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    everything = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    s = ranked.withColumn("w", w).withColumn("ratio", F.lit(cap) * F.col("source_size") / F.col("w"))
    by_ratio = everything.orderBy("ratio", "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = (s.withColumn("total", F.lit(share) * F.sum("source_size").over(everything))
         .withColumn("level", (F.col("total") - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("w").over(rest))
         .withColumn("open", (F.col("ratio") > F.col("level")).cast("int"))
         .withColumn("water", F.min(F.when(F.col("open") == 1, F.struct("ratio", "rank", "level"))).over(everything)["level"]))
    target = F.least(F.lit(cap) * F.col("source_size"), F.coalesce(F.col("w") * F.col("water"), F.lit(cap) * F.col("source_size")))
    return s.select("source", "docs", "source_size", target.alias("target"))


def settle(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pivotal rounding of one block: every row but one at most comes back integral.
    Large documents meet first, so that what is left over is a small one."""
    pdf = pdf.sort_values(["size", "key", "row"], ascending=[False, True, True], kind="stable")
    size, p, u = pdf["size"].to_numpy(float), pdf["p"].to_numpy(float).copy(), pdf["u"].to_numpy(float)
    carry = -1
    for i in range(len(p)):
        if p[i] <= 0.0 or p[i] >= 1.0:
            continue
        if carry < 0:
            carry = i
            continue
        a, b = carry, i
        # words that can move from b to a, and from a to b, before one is integral
        up = min((1.0 - p[a]) * size[a], p[b] * size[b])
        down = min(p[a] * size[a], (1.0 - p[b]) * size[b])
        move = up if u[b] * (up + down) < down else -down  # fair: the expected move is 0
        pa, pb = p[a] + move / size[a], p[b] - move / size[b]
        p[a] = 0.0 if pa < 1e-12 else 1.0 if pa > 1 - 1e-12 else pa
        p[b] = 0.0 if pb < 1e-12 else 1.0 if pb > 1 - 1e-12 else pb
        open_a, open_b = 0.0 < p[a] < 1.0, 0.0 < p[b] < 1.0
        carry = a if open_a else b if open_b else -1
    out = pdf.copy()
    out["p"] = p
    out["settled"] = (p <= 0.0) | (p >= 1.0)
    return out


def word_counts(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(row, id, key, tie, source, size): size is the number of words, tie a hash of the text."""
    d = modest_batches(docs).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"),
                    F.xxhash64(text_col).alias("tie"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    keep = ["row", "id", "key", "tie", "source"]

    def run(batches):
        for batch in batches:
            for rows, data, off in slices(batch, "text"):
                _, _, first = words(data, off)
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), pa.array(np.diff(first))], names=[*keep, "size"])

    return d.mapInArrow(run, "row long, id long, key long, tie long, source string, size long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 17, block: int = BLOCK) -> DataFrame:
    """(row, id, tie, source, size, source_size, target, whole, part, taken) for every row of
    ``docs``: ``whole`` copies of the document, then its first ``part`` words; taken
    counts the words of both.  ``row`` tells apart rows that repeat an id."""
    base, _ = store(word_counts(docs, id_col, text_col, source_col), "sizes")
    sizes, _ = store(targets(base.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size")), weights, share, cap), "targets")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    s = sizes.withColumn("copies", copies).withColumnRenamed("source", "s_source")
    # rows of equal id differ in nothing that counts but their order, so hashes leave out the row number
    draw = F.pmod(F.xxhash64("key", "size", F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    nodes = F.greatest(F.lit(1), F.ceil(F.col("docs") / F.lit(block)))
    joined = base.join(F.broadcast(s) if _bounded(sizes) else s, F.col("source").eqNullSafe(F.col("s_source")))
    start = joined.select("row", "key", "source", "size", (F.col("copies") - F.floor("copies")).alias("p"), draw.alias("u"),
                          F.pmod(F.xxhash64("key", F.lit(seed + 1)), nodes).cast("long").alias("node"))
    open_ = (F.col("size") > 0) & (F.col("p") > 0)
    most = sizes.agg(F.max(F.ceil(F.col("docs") / F.lit(block)))).first()[0] or 1
    done, level = [], start.filter(open_).withColumn("settled", F.lit(False))
    depth = 1 + math.ceil(math.log(max(1, most), FAN_IN))
    for k in range(depth):
        if k:
            level = (level.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("long"))
                     .withColumn("u", F.pmod(F.xxhash64("key", "size", F.lit(seed + 2 + k)), F.lit(1 << 52)) / F.lit(float(1 << 52))))
        level, _ = store(level.groupBy("source", "node").applyInPandas(settle, STATE), f"level{k}")
        done.append(level.filter("settled"))
        level = level.filter("NOT settled")
    rounded = level  # one row per source at most
    for d in done:
        rounded = rounded.unionByName(d)
    rounded = rounded.select(F.col("row").alias("r_row"), "p")
    out = joined.join(rounded, F.col("row") == F.col("r_row"), "left").withColumn("p", F.coalesce("p", F.lit(0.0)))
    whole = (F.floor("copies") + F.floor("p")).cast("long")
    part = F.round((F.col("p") - F.floor("p")) * F.col("size")).cast("long")
    return (out.withColumn("whole", F.when(F.col("size") > 0, whole).otherwise(F.lit(0).cast("long"))).withColumn("part", part)
            .select("row", "id", "tie", "source", "size", "source_size", "target", "whole", "part",
                    (F.col("whole") * F.col("size") + F.col("part")).alias("taken")))


def _bounded(sizes: DataFrame, limit: int = 100_000) -> bool:
    """Few enough sources to broadcast (a row is below 200 bytes); more are shuffle-joined."""
    return sizes.limit(limit + 1).count() <= limit


def expand(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 17) -> DataFrame:
    """The mix itself: each document as often as it is taken, whole, with the columns of
    ``docs``.  The one document of a source that is left with a part is taken once
    more by a fair draw (its share of words is the chance), so no text is cut.
    Only (id, copies) rows are joined."""
    draw = F.pmod(F.xxhash64(known_id(F.col("id")), "tie", F.lit(seed + 99)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    times = F.col("whole") + F.when(draw * F.col("size") < F.col("part"), F.lit(1)).otherwise(F.lit(0))
    m = mixed.select(known_id(F.col("id")).alias("key"), "tie", times.cast("int").alias("times")).filter("times > 0")
    # rows that repeat an id are told apart by text; equal rows share their copies in any order
    m = m.groupBy("key", "tie").agg(F.sort_array(F.collect_list("times"), asc=False).alias("shares"))
    rows = with_keys(docs, [known_id(F.col(id_col)), F.xxhash64(text_col)], ["key", "tie"]).join(m, ["key", "tie"])
    nth = F.row_number().over(Window.partitionBy("key", "tie").orderBy(F.lit(0)))  # rows lie together after the join
    rows = rows.select("whole", F.get("shares", nth - 1).alias("times")).filter("times > 0")
    return rows.select("whole", F.explode(F.array_repeat(F.lit(True), F.col("times"))).alias("copy")).select("whole.*")
