"""Row-local operators on Structured Streaming.

Cleaning, canonicalisation, tokenising, code-switch tagging, number
normalisation and per-utterance WER are all row-local: the same Column
expressions run on a streaming DataFrame unchanged.  ``run_incremental``
processes the files that arrived since the last run (``availableNow``
trigger) and appends the result; the checkpoint folder keeps the progress,
so a restarted job neither loses nor repeats files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_incremental(spark: SparkSession, source: str, schema, transform: Callable[[DataFrame], DataFrame],
                    sink: str, checkpoint: str, fmt: str = "parquet", sink_fmt: str = "parquet",
                    max_files_per_trigger: int | None = None) -> None:
    """Apply ``transform`` to new files under ``source`` and append to ``sink``.

    A trigger's files may be few, and a file is read by one task or a few: their rows
    are dealt over the cores before ``transform``, which is where the work is."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = transform(reader.load(source).repartition(spark.sparkContext.defaultParallelism))
    q = (stream.writeStream.format(sink_fmt).outputMode("append")
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start(sink))
    q.awaitTermination()


def utterance_scores(df: DataFrame) -> DataFrame:
    """Example row-local transform: canonicalised text and WER before/after
    for a stream of ``(idx, reference, hypothesis)`` rows."""
    from vachan.operators.scoring import with_before_after

    return with_before_after(df)
