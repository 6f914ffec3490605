"""Training-set assembly from a manifest, sample arrays and
transcripts (SURVEY §2.11, §3.1), with rejects instead of skipped loops.

Plan: samples come in fixed-size blocks (``audio_blocks``), are scanned once and
written as mono blocks.  Everything else follows from narrow rows: transcripts
are packed into chunks in their own rows; manifest, chunk lists and sample
*headers* (rate, number of samples, peak) are joined, which already decides
rejects, chunks that are long enough, speakers and their split.  Samples take
part in one join, at the end: chunks, dealt to the blocks they touch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vachan.operators import audio as AU
from vachan.operators import audio_blocks as AB
from vachan.operators import chunking as CH
from vachan.operators import manifest as MF
from vachan.operators import sampling as SM
from vachan.session import cut_lineage


def sample_blocks(waves: DataFrame) -> DataFrame:
    """Mono blocks of recordings given as BLOCK_SCHEMA rows, or as whole rows (WAVE_SCHEMA)."""
    return AB.mono(waves if "block" in waves.columns else AB.to_blocks(waves))


# Why a recording may be left out.
REASONS = ("unparsable url", "missing audio", "sampling rate is not 16 kHz", "channels differ in length", "missing transcript",
           "not json", "not an object", "malformed word list", "null word text or time")


def plan_chunks(manifest: DataFrame, heads: DataFrame, transcripts: DataFrame,
                max_chunk_sec: float = 29.0, min_chunk_sec: float = 0.5, counters: Observation | None = None) -> DataFrame:
    """One narrow row per recording: ``recording_id, user_id, chunks, peak, reject_reason``;
    ``chunks`` are those with at least ``min_chunk_sec`` of samples.  Written once.

    ``heads`` are ``audio_blocks.headers``: no sample is read here.  ``counters`` takes
    the recordings, and those of each of REASONS (``reject_counts``), in the
    pass that writes the plan."""
    m = MF.rewrite_urls(manifest, "rec_url_gcp").select("recording_id", "user_id", F.col("reject_reason").alias("m_reason"))
    w = heads.select("recording_id", "sampling_rate", "n_samples", "peak", F.lit(True).alias("has_audio"))
    bad = CH.bad_words("words")
    packed = F.transform(CH.pack_words("words", max_chunk_sec, min_chunk_sec), lambda c, i: F.struct(
        i.alias("chunk_id"), c["text"].alias("text"), c["start"].alias("start"), c["end"].alias("end")))
    t = transcripts.select("recording_id", F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
                           .when(F.col("words").isNull(), F.lit("missing transcript"))
                           .when(bad, F.lit("null word text or time")).alias("t_reason"),
                           F.when(F.col("words").isNotNull() & ~bad, packed).alias("packed"), F.lit(True).alias("has_words"))
    j = m.join(w, "recording_id", "left").join(t, "recording_id", "left")
    reason = (F.when(F.col("m_reason").isNotNull(), F.col("m_reason"))
               .when(F.col("has_audio").isNull(), F.lit("missing audio"))
               .when(F.col("sampling_rate") != AU.TARGET_SR, F.lit("sampling rate is not 16 kHz"))
               .when(F.col("n_samples").isNull(), F.lit("channels differ in length"))
               .when(F.col("has_words").isNull(), F.lit("missing transcript")).otherwise(F.col("t_reason")))
    need = int(min_chunk_sec * AU.TARGET_SR)
    placed = F.transform("packed", lambda c: F.struct(c["chunk_id"].alias("chunk_id"), c["text"].alias("text"), c["start"].alias("start"), c["end"].alias("end"), *[
        x.alias(n) for x, n in zip(AB.sample_range(c["start"], c["end"], F.col("n_samples")), ("first", "stop"), strict=True)]))
    planned = j.select("recording_id", "user_id", "peak", reason.alias("reject_reason"), F.when(reason.isNull(), placed).alias("chunks"))
    if counters is not None:
        why = F.col("reject_reason")
        planned = planned.observe(counters, F.count("*").alias("recordings"), *[F.count_if(why == r).alias(r) for r in REASONS], F.count_if(why.isNotNull() & ~why.isin(*REASONS)).alias("other"))
    return cut_lineage(planned.select("recording_id", "user_id", F.filter("chunks", lambda c: c["stop"] - c["first"] >= need).alias("chunks"), "peak", "reject_reason"))


def reject_counts(spark: SparkSession, counters: Observation) -> DataFrame:
    """``reject_reason, n`` as observed while the plan was written (a dozen rows);
    recordings that were kept have a NULL reason."""
    seen = counters.get
    rejected = {r: seen[r] for r in (*REASONS, "other") if seen[r]}
    return spark.createDataFrame([(None, seen["recordings"] - sum(rejected.values())), *rejected.items()], "reject_reason string, n long")


def rejects_of(plan: DataFrame) -> DataFrame:
    """``recording_id, reject_reason``."""
    return plan.where(F.col("reject_reason").isNotNull()).select("recording_id", "reject_reason")


def with_audio(plan: DataFrame, mono: DataFrame, extra: tuple = (), size: int = AB.BLOCK) -> DataFrame:
    """An example per chunk of ``plan`` rows, its samples cut out of the blocks they lie in."""
    c = plan.where(F.size("chunks") > 0).select("recording_id", "user_id", "peak", *extra, F.explode("chunks").alias("c"))
    rest = F.struct("user_id", *extra, F.col("c.start").alias("chunk_start"), F.col("c.end").alias("chunk_end"), F.col("c.text").alias("sentence"))
    cut = AB.cut(mono, c.select("recording_id", F.col("c.chunk_id").alias("chunk_id"), F.col("c.first").alias("first"), F.col("c.stop").alias("end"), "peak", rest.alias("rest")), size)
    return cut.select("recording_id", "rest.user_id", "chunk_id", "rest.chunk_start", "rest.chunk_end", "rest.sentence",
                      F.struct("array", F.lit(AU.TARGET_SR).alias("sampling_rate")).alias("audio"), *[f"rest.{x}" for x in extra])


def build_examples(manifest: DataFrame, waves: DataFrame, transcripts: DataFrame,
                   max_chunk_sec: float = 29.0, min_chunk_sec: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """C4: ``(examples, rejects)``.

    examples: ``recording_id, user_id, chunk_id, chunk_start, chunk_end,
    sentence, audio STRUCT<array ARRAY<FLOAT>, sampling_rate INT>``;
    rejects: ``recording_id, reject_reason``.
    """
    mono = sample_blocks(waves)
    plan = plan_chunks(manifest, AB.headers(mono), transcripts, max_chunk_sec, min_chunk_sec)
    return with_audio(plan, mono), rejects_of(plan)


def build_dataset(manifest: DataFrame, waves: DataFrame, transcripts: DataFrame, max_chunk_sec: float = 29.0, min_chunk_sec: float = 0.5,
                  val_fraction: float = 0.10, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """C4 + C5: ``(examples with split, counts, rejects)``; split and counts come from the
    narrow plan, so the samples are read once and joined once."""
    mono = sample_blocks(waves)
    plan = plan_chunks(manifest, AB.headers(mono), transcripts, max_chunk_sec, min_chunk_sec)
    kept = plan.where(F.size("chunks") > 0)
    placed = SM.assign_split(kept, SM.speaker_split(kept, "user_id", val_fraction, seed), "user_id")
    counts = MF.split_counts(placed.select("user_id", "split", F.explode("chunks")))
    return with_audio(placed, mono, ("split",)), counts, rejects_of(plan)


def assemble(examples: DataFrame, val_fraction: float = 0.10, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Speaker-disjoint split of the examples (W7 + J4) and the per-split
    counts (A2 + A4).  Returns ``(examples with split, counts)``."""
    split = SM.speaker_split(examples, "user_id", val_fraction, seed)
    out = SM.assign_split(examples, split, "user_id")
    return out, MF.split_counts(out)
