"""Recording manifest operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Folder id and recording id of a legacy asset URL: ``.../{folder}/{rec}_...``.
URL_IDS = r"/(\d+)/(\d+)_"
DEFAULT_BASE = "https://storage.example/upload"


def rewrite_urls(df: DataFrame, url_col: str = "rec_url_gcp", base: str = DEFAULT_BASE,
                 pattern: str = URL_IDS, suffixes=("audio.wav", "transcription.json"),
                 strict: bool = False) -> DataFrame:
    """``{base}/{folder}/{rec}_{suffix}`` from the first match of
    ``pattern`` (two groups).  A URL that does not match gets NULL URLs and a
    ``reject_reason``; ``strict=True`` fails the job instead (the original
    stopped the whole run)."""
    u = F.col(url_col)
    ok = u.rlike(pattern)
    folder, rec = F.regexp_extract(u, pattern, 1), F.regexp_extract(u, pattern, 2)
    names = ["audio_url", "transcript_url"] if len(suffixes) == 2 else [f"url_{i}" for i in range(len(suffixes))]
    for name, suffix in zip(names, suffixes):
        df = df.withColumn(name, F.when(ok, F.concat_ws("/", F.lit(base), folder,
                                                         F.concat(rec, F.lit("_" + suffix)))))
    reason = F.when(~ok | u.isNull(), F.lit("unparsable url"))
    if strict:
        reason = F.when(~ok | u.isNull(), F.raise_error(F.concat(F.lit("asset URL without folder and recording ids: "),
                                                                 F.coalesce(u, F.lit("NULL")))))
    return df.withColumn("reject_reason", reason)


def asset_paths(df: DataFrame, id_col: str = "recording_id", root: str = "") -> DataFrame:
    """Local asset paths ``audio/{id}.wav`` and ``transc/{id}.json``."""
    pre = (root.rstrip("/") + "/") if root else ""
    return (df.withColumn("audio_path", F.format_string(pre + "audio/%s.wav", F.col(id_col)))
              .withColumn("transcript_path", F.format_string(pre + "transc/%s.json", F.col(id_col))))


def manifest_totals(manifest: DataFrame, duration_col: str = "duration", user_col: str = "user_id") -> DataFrame:
    """A1: recordings, hours of audio (and distinct speakers) in one pass."""
    return manifest.agg(F.count(F.lit(1)).alias("recordings"),
                        (F.sum(duration_col) / 3600.0).alias("hours"),
                        F.countDistinct(user_col).alias("speakers"))


def split_counts(examples: DataFrame, split_col: str = "split", user_col: str = "user_id") -> DataFrame:
    """A2 + A4: rows and distinct speakers per split."""
    return examples.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.countDistinct(user_col).alias("n_users"))
