"""Tiers, systematic samples and speaker splits.

A window ``PARTITION BY tier`` would put every row of a tier into one task; a
tier can hold a third of a corpus.  ``with_group_index`` instead numbers rows
inside low-cardinality groups with a range shuffle and a small offset table:

1. range-partition on ``(group, order)`` and sort inside each partition;
2. ``monotonically_increasing_id`` gives each row its place in its partition;
3. a per-(partition, group) count/first-place table (at most partitions +
   groups - 1 rows: every partition holds a contiguous key range) turns that
   place into the index within the group via running sums;
4. the offset table is joined back on ``(partition, group)``; the optimizer
   picks the join from the table's measured size, and either way a hot group
   stays split over its partitions.

The ordering columns must be unique within a group.  Range bounds are drawn
from a sample seeded per execution, so partition numbers and places are
written once (a table under the checkpoint folder) before they are used
twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vachan.session import cut_lineage

TIER_ORDER = ["low", "medium", "high"]
SEVERITY = {"low": 1, "medium": 2, "high": 3}


def wer_tier(c) -> Column:
    """``<=0`` correct, ``<=15`` low, ``<=50`` medium, else high.

    NaN falls through every comparison and lands in ``high``; a NULL score (an
    utterance without a reference) has no tier, see ``scoring.score_rejects``.
    """
    def tier(x):
        return (F.when(x.isNull(), F.lit(None).cast("string")).when(F.isnan(x), F.lit("high")).when(x <= 0, F.lit("correct"))
                 .when(x <= 15, F.lit("low")).when(x <= 50, F.lit("medium")).otherwise(F.lit("high")))

    # the score is named once: Catalyst would work it out again for every mention
    return F.element_at(F.transform(F.array(F.col(c) if isinstance(c, str) else c), tier), 1)


def severity_rank(c) -> Column:
    """Tier to rank via a literal map (no join)."""
    m = F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])
    return F.element_at(m, F.col(c) if isinstance(c, str) else c)


def with_group_index(df: DataFrame, group_cols: list[str], order_cols: list[str], out: str = "i",
                     count_out: str | None = None, partitions: int | None = None,
                     materialize: bool = True) -> DataFrame:
    """Add ``out`` = 0-based position of each row inside its group by
    ``order_cols`` (and ``count_out`` = group size), without a per-group task.

    The range shuffle samples its input and the offset table re-reads it, so
    an expensive input is first written once to the checkpoint folder
    (``materialize``); every later pass reads that copy.
    """
    spark = df.sparkSession
    if materialize:
        df = cut_lineage(df)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, *order_cols]
    ranged = (df.repartitionByRange(n_parts, *keys).sortWithinPartitions(*keys)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__place", F.monotonically_increasing_id()))
    # Range bounds come from a sample seeded per execution, and the two
    # branches below would each run their own (column-pruned) exchange: the
    # partition numbers and places are therefore written once and read back,
    # so both branches — and any recomputation — see the same ids.
    ranged = cut_lineage(ranged)
    stats = (ranged.groupBy("__pid", *group_cols)
                   .agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__cnt")))
    w_prev = Window.partitionBy(*group_cols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*group_cols)
    stats = (stats.withColumn("__offset", F.coalesce(F.sum("__cnt").over(w_prev), F.lit(0)))
                  .withColumn("__gcount", F.sum("__cnt").over(w_all)))
    res = (ranged.join(stats, on=["__pid", *group_cols], how="inner")
                 .withColumn(out, F.col("__offset") + F.col("__place") - F.col("__first")))
    if count_out:
        res = res.withColumn(count_out, F.col("__gcount"))
    return res.drop("__pid", "__place", "__first", "__cnt", "__offset", "__gcount")


def interval_sample(df: DataFrame, n: int, order_cols: list[str], group_col: str = "tier",
                    materialize: bool = True) -> DataFrame:
    """Per group, rows at positions ``0, step, 2*step, ...`` (first ``n``),
    ``step = max(1, size div n)``; the order column is an explicit argument
    (the reference used file order)."""
    if n <= 0:
        raise ValueError("n must be positive")
    idx = with_group_index(df, [group_col], order_cols, "__i", "__c", materialize=materialize)
    step = F.greatest(F.lit(1), F.floor(F.col("__c") / n))
    return (idx.where(((F.col("__i") % step) == 0) & (F.floor(F.col("__i") / step) < n))
               .drop("__i", "__c"))


def tier_counts(scored: DataFrame, wer_col: str = "wer") -> DataFrame:
    """A3: rows per tier (partial aggregation before the shuffle).  Rows without a score
    are a group with no score to count; a filter before it would score twice."""
    return scored.groupBy(wer_tier(wer_col).alias("tier")).agg(F.count(wer_col).alias("n")).where(F.col("n") > 0)


def tier_report(scored: DataFrame, n_per_tier: int = 10, wer_col: str = "wer") -> DataFrame:
    """A3: per error tier the rows available and sampled, and all errors."""
    # the condition looks at the count too, so it stays above the aggregation and scores nothing again
    t = tier_counts(scored, wer_col).where(F.when(F.col("tier") == "correct", F.lit(0)).otherwise(F.col("n")) > 0)
    total = Window.partitionBy(F.lit(0))   # three rows at most
    return t.select("tier", F.col("n").alias("available"), F.least("n", F.lit(n_per_tier).cast("long")).alias("sampled"),
                    F.sum("n").over(total).alias("total_errors"))


def sample_errors(results: DataFrame, n_per_tier: int = 10, order_col: str = "idx",
                  wer_col: str = "wer") -> DataFrame:
    """05 chain: tier, drop correct, systematic sample per tier, order by
    ``order_col``, dense ``sample_id`` (F-sample columns)."""
    # Only (order, score, tier) is written, numbered and shuffled; the texts of the
    # few rows that are drawn come back by a join on the order column.  The cut
    # comes before the filter, which would otherwise compute the score twice.
    t = cut_lineage(results.select(order_col, wer_col, wer_tier(wer_col).alias("tier"))).where(F.col("tier") != "correct")
    s = interval_sample(t, n_per_tier, [order_col], materialize=False)
    s = s.withColumn("severity_rank", severity_rank("tier"))
    s = results.select(order_col, "reference", "hypothesis").join(s, order_col)
    # At most 3 * n_per_tier rows: one ordered window over them is bounded.
    w = Window.orderBy(order_col)
    return s.select(F.row_number().over(w).cast("int").alias("sample_id"), order_col, "tier",
                    "severity_rank", wer_col, "reference", "hypothesis")


def speaker_split(examples: DataFrame, user_col: str = "user_id", val_fraction: float = 0.10,
                  seed: int = 42) -> DataFrame:
    """Speaker-disjoint split of the distinct users.

    Users are ranked by ``md5(seed || '|' || user)`` (then user id); the first
    ``ceil(fraction * users)`` are validation, the rest train.  Returns
    ``(user, split)``, one row per user.
    """
    users = examples.select(user_col).distinct()
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.col(user_col).cast("string")))
    ranked = with_group_index(users.withColumn("__h", key), [], ["__h", user_col], "__r", "__n")
    n_val = F.ceil(F.col("__n") * F.lit(val_fraction))
    return ranked.select(user_col, F.when(F.col("__r") < n_val, F.lit("validation"))
                         .otherwise(F.lit("train")).alias("split"))


def assign_split(examples: DataFrame, splits: DataFrame, user_col: str = "user_id") -> DataFrame:
    """One equi-join adds ``split`` (train = semi join, validation = anti
    join of the train set).  AQE turns it into a broadcast join at run time
    when the user table is measured small; otherwise it stays a shuffle join."""
    return examples.join(splits, on=user_col, how="inner")
