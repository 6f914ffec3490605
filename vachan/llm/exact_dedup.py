"""Exact deduplication against a persistent digest index (op 8, native).

The index is a table with one row per distinct normalised text, bucketed and
sorted by its SHA-256.  A batch of documents is reduced to one row per digest
(partial aggregation: a text that a third of all rows repeat costs one row per
task), anti-joined with the index by a sort-merge join that reads the index
bucket by bucket without a shuffle, and what is new is appended.  Each
document then learns from the index which row stays.

Everything is DataFrame code; no text is shuffled, only (id, digest) rows.

Defined results: a null text counts as empty; a null id orders below every
other id; of rows that repeat id and text, one stays; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vachan.llm.common import join_hot, known_id, rows_with_keys, store

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(text) -> F.Column:
    """SHA-256 (lowercase hex) of the text with A-Z, and nothing else, lowered."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), 256)


def open_index(spark: SparkSession, table: str, buckets: int) -> DataFrame:
    """The index, created without rows if it isn't there yet."""
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {table} (digest STRING, keep_id BIGINT, keep_row BIGINT, copies BIGINT, batch STRING)
                  USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS""")
    return spark.table(table)


def dedup_batch(docs: DataFrame, table: str, batch: str, id_col: str = "doc_id", text_col: str = "text",
                buckets: int | None = None) -> DataFrame:
    """Deduplicate ``docs`` against the index ``table`` and append its new texts.

    Within a batch the largest id of a text stays; a text that an earlier batch
    brought is dropped in favour of that batch's row.  Returns (row, id,
    digest, keep_id, group_size, kept): one row per input row; group_size
    counts the batch's rows with that text.  The call runs the append at once.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, _ = store(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                                digest(F.col(text_col)).alias("digest")), "digests")
    total = rows.count()
    # written before the anti-join, which the optimizer would otherwise push below the aggregation, on all rows
    groups, _ = store(rows.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("last"), F.count("*").alias("group_size")), "groups")
    fresh = groups.join(open_index(spark, table, buckets).select("digest").hint("merge"), "digest", "left_anti")
    (fresh.select("digest", F.col("last.id").alias("keep_id"), F.col("last.row").alias("keep_row"),
                  F.col("group_size").alias("copies"), F.lit(batch).alias("batch"))
     .repartition(buckets, "digest")
     .write.mode("append").format("parquet").bucketBy(buckets, "digest").sortBy("digest").saveAsTable(table))

    known = spark.table(table).select("digest", "keep_id", F.when(F.col("batch") == batch, F.col("keep_row")).alias("keep_row"))
    resolved = groups.select("digest", "group_size").join(known.hint("merge"), "digest")
    out = join_hot(rows, resolved, "digest", "group_size", total, "row")
    return out.select("row", "id", "digest", F.col("g.keep_id").alias("keep_id"), F.col("g.group_size").alias("group_size"),
                      (F.col("row").eqNullSafe(F.col("g.keep_row"))).alias("kept"))


def keep_rows(docs: DataFrame, table: str, batch: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.  Ids may repeat:
    of rows equal in id and text one is kept."""
    judged, _ = store(dedup_batch(docs, table, batch, id_col, text_col).filter("kept").select(known_id(F.col("id")).alias("key"), "digest"), "kept")
    return rows_with_keys(docs, [known_id(F.col(id_col)), digest(F.col(text_col))], judged)
