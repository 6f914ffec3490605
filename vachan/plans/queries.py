"""Registered queries: one per operator group of SURVEY §2, over the driver
tables.  Each takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the oracle in ``oracle_sql.py``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vachan.functions import lexicon as L
from vachan.functions import text as TX
from vachan.operators import sampling as SM
from vachan.operators import scoring as SC
from vachan.plans import derived as D
from vachan.session import cut_lineage


def systems_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived D10 sheet melted to ``(segment_id, url, system,
    sys_ord, ref, hyp)`` token arrays (``sources.files.systems_long``)."""
    from vachan.sources.files import systems_long as melt

    return melt(D.systems_wide(spark, sf_dir), L.SYSTEMS)


def plain_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 per (segment, system)."""
    return SC.with_plain_wer(systems_long(spark, sf_dir), "ref", "hyp")


def q_corpus_wer(spark, sf_dir):
    s = plain_scores(spark, sf_dir)
    return (SC.corpus_wer(s).select(F.col("total_edits"), F.col("total_words"),
                                    F.round("wer", 6).alias("wer")))


def q_system_wer(spark, sf_dir):
    s = plain_scores(spark, sf_dir)
    return SC.corpus_wer(s, by=["system"]).select("system", "total_edits", "total_words",
                                                 F.round("wer", 6).alias("wer"))


def scored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SC.with_utterance_wer(D.results_table(spark, sf_dir)).drop("wer_reject")


def q_utterance_wer(spark, sf_dir):
    return scored_results(spark, sf_dir).select("idx", "reference", "hypothesis", "wer")


def q_tier_counts(spark, sf_dir):
    return SM.tier_counts(scored_results(spark, sf_dir))


def q_tier_sample(spark, sf_dir):
    return SM.sample_errors(scored_results(spark, sf_dir), n_per_tier=10, order_col="idx")


QUERIES = {
    "corpus_wer": q_corpus_wer,
    "system_wer": q_system_wer,
    "utterance_wer": q_utterance_wer,
    "tier_counts": q_tier_counts,
    "tier_sample": q_tier_sample,
}


# ── canonicalisation, cleaning, tagging, splits ─────────────────────────────

from vachan.functions import codeswitch as CS  # noqa: E402
from vachan.operators import manifest as MF  # noqa: E402

# Whole-token rewrite lexicon for the document query (frequent words of the
# driver's invented prose; the Devanagari lexicons find nothing there).
DOC_REWRITES = [("the", "THE"), ("and", "AND"), ("und", "UND"), ("la", "LA"), ("de", "DE")]


def before_after(spark, sf_dir):
    return SC.with_before_after(D.results_table(spark, sf_dir)).drop("wer_before_norm_reject",
                                                                       "wer_after_norm_reject")


def q_wer_before_after(spark, sf_dir):
    return before_after(spark, sf_dir).select("idx", "reference", "hypothesis", "wer_before_norm",
                                              "wer_after_norm", "wer_delta")


def q_norm_summary(spark, sf_dir):
    s = SC.before_after_summary(before_after(spark, sf_dir))
    return s.select(*[F.round(c, 6).alias(c) for c in s.columns])


def q_clean_text(spark, sf_dir):
    p = D.text_table(spark, sf_dir, "pages")
    return p.select("page_id", TX.clean_transcript("html").alias("cleaned"))


def q_digit_map(spark, sf_dir):
    d = D.text_table(spark, sf_dir, "documents").select("doc_id", TX.digits_to_ascii("text").alias("t"))
    return d.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").alias("n_chars"))


def q_token_rewrite(spark, sf_dir):
    d = D.text_table(spark, sf_dir, "documents").select(
        "doc_id", TX.rewrite_tokens("text", DOC_REWRITES, mode="coded").alias("t"))
    return d.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").alias("n_chars"))


def q_url_rewrite(spark, sf_dir):
    u = D.utterances(spark, sf_dir)
    return MF.rewrite_urls(u, "url", base="https://storage.example/upload").select(
        "segment_id", "url", "audio_url", "transcript_url", "reject_reason")


def q_speaker_split(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events")
    return SM.speaker_split(ev, "user_id", 0.10, 42)


def q_split_counts(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events").select("event_id", "user_id")
    split = SM.assign_split(ev, SM.speaker_split(ev, "user_id", 0.10, 42))
    return MF.split_counts(split)


def q_asset_paths(spark, sf_dir):
    """Local asset paths of every recording."""
    ev = D.table(spark, sf_dir, "events").select(F.col("event_id").alias("recording_id"))
    return MF.asset_paths(ev, root="cache")


def q_sql_normalise(spark, sf_dir):
    """V4: the canonicaliser by its SQL name."""
    TX.register_normalise(spark, "normalise")
    return D.hindi_results(spark, sf_dir).select("idx", F.md5(F.expr("normalise(reference)")).alias("plain_md5"))


def q_manifest_totals(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events")
    m = ev.select(F.col("event_id").alias("recording_id"), "user_id", F.col("value").alias("duration"))
    t = MF.manifest_totals(m)
    return t.select("recordings", F.round("hours", 6).alias("hours"), "speakers")


def q_code_switch(spark, sf_dir):
    d = D.text_table(spark, sf_dir, "documents").select("doc_id", CS.tag_english("text").alias("x"))
    return d.select("doc_id", F.md5("x.text").alias("tagged_md5"), F.size("x.words").alias("n_en_words"),
                    F.md5(F.array_join("x.words", "|")).alias("en_words_md5"))


def hindi_before_after(spark, sf_dir):
    return SC.with_before_after(D.hindi_results(spark, sf_dir), convert_number_words=True)


def q_hindi_canonical(spark, sf_dir):
    """F5-F9 on text where every rule acts; NULL as empty and as the word nan."""
    h = D.hindi_results(spark, sf_dir).select(
        "idx", "reference", TX.canonicalise("reference").alias("plain"), TX.canonicalise("reference", True).alias("numbers"),
        TX.canonicalise("reference", null_as="nan").alias("nan"))
    return h.select("idx", F.md5("plain").alias("plain_md5"), F.md5("numbers").alias("numbers_md5"), F.md5("nan").alias("nan_md5"),
                    (F.coalesce("reference", F.lit("")) != F.col("plain")).alias("changed"))


def q_hindi_before_after(spark, sf_dir):
    return hindi_before_after(spark, sf_dir).select("idx", "wer_before_norm", "wer_after_norm", "wer_delta")


def q_hindi_norm_summary(spark, sf_dir):
    s = SC.before_after_summary(hindi_before_after(spark, sf_dir))
    return s.select(*[F.round(c, 6).alias(c) for c in s.columns])


def q_hindi_preview(spark, sf_dir):
    """T4: a fixed number of rows for the eye; the limit is the feature."""
    # the score decides which rows are shown, so it is written once, not worked out again by a pushed filter
    scored = cut_lineage(hindi_before_after(spark, sf_dir))
    return SC.preview(scored.where(F.col("wer_delta").isNotNull())).select("idx", "wer_before_norm", "wer_after_norm")


def q_scoring_rejects(spark, sf_dir):
    """Utterances without a reference: a reject row instead of a score."""
    return SC.score_rejects(SC.with_utterance_wer(D.hindi_results(spark, sf_dir))).select("idx", "wer", "reject_reason")


def q_tier_report(spark, sf_dir):
    return SM.tier_report(SC.with_utterance_wer(D.hindi_results(spark, sf_dir)), 10)


def q_nfc_tokens(spark, sf_dir):
    h = D.hindi_results(spark, sf_dir).select("idx", TX.tokenise("hypothesis").alias("t"))
    return h.select("idx", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


QUERIES.update({
    "hindi_canonical": q_hindi_canonical,
    "hindi_before_after": q_hindi_before_after,
    "hindi_norm_summary": q_hindi_norm_summary,
    "hindi_preview": q_hindi_preview,
    "scoring_rejects": q_scoring_rejects,
    "tier_report": q_tier_report,
    "nfc_tokens": q_nfc_tokens,
    "wer_before_after": q_wer_before_after,
    "norm_summary": q_norm_summary,
    "clean_text": q_clean_text,
    "digit_map": q_digit_map,
    "token_rewrite": q_token_rewrite,
    "url_rewrite": q_url_rewrite,
    "speaker_split": q_speaker_split,
    "split_counts": q_split_counts,
    "asset_paths": q_asset_paths,
    "sql_normalise": q_sql_normalise,
    "manifest_totals": q_manifest_totals,
    "code_switch": q_code_switch,
})


# ── multi-system lattice evaluation ─────────────────────────────────────────

from vachan.operators import lattice as LT  # noqa: E402


DETAIL = ["segment_id", "url", "ref", "systems", "hyps"]


def reports(spark, sf_dir, keep: list[str], mode: str = "coded"):
    """Alignment, bins and scores of every segment in one narrow stage."""
    return LT.segment_reports(LT.wide_segments(D.systems_wide(spark, sf_dir)), 3, mode, keep)


def lattice_detail(spark, sf_dir, mode: str = "coded"):
    return LT.detail_rows(reports(spark, sf_dir, DETAIL, mode))


def q_align_ops(spark, sf_dir):
    r = reports(spark, sf_dir, ["segment_id", "systems"])
    return r.select("segment_id", "systems", F.explode("scores").alias("s")).select(
        "segment_id", F.element_at("systems", F.col("s.sys_ord")).alias("system"), "s.subs", "s.dels", "s.ins", "s.hits")


def q_lattice_bins(spark, sf_dir):
    lat = reports(spark, sf_dir, ["segment_id"])
    shown = F.transform("bins", lambda b: F.concat(F.array_join(b["tokens"], "/"),
                                                    F.when(b["optional"], F.lit("|" + LT.EPS)).otherwise(F.lit(""))))
    return lat.select("segment_id", F.size("bins").alias("n_bins"),
                      F.size(F.filter("bins", lambda b: b["optional"])).alias("n_optional"),
                      F.array_join(shown, " ").alias("bins"))


def q_lattice_system_wer(spark, sf_dir):
    s = LT.system_summary(lattice_detail(spark, sf_dir))
    return s.select("system", "plain_edits", "plain_n", "lattice_edits", "lattice_n",
                    F.round("plain_wer", 6).alias("plain_wer"), F.round("lattice_wer", 6).alias("lattice_wer"),
                    F.round("delta", 6).alias("delta"), "verdict")


def _detail_cols(df):
    return df.select("segment_id", "url", "system", F.array_join("ref", " ").alias("ref"),
                     F.array_join("hyp", " ").alias("hyp"), "plain_wer", "lattice_wer", "delta")


def q_lattice_detail(spark, sf_dir):
    return _detail_cols(lattice_detail(spark, sf_dir))


def q_lattice_top(spark, sf_dir):
    return _detail_cols(LT.top_improved(lattice_detail(spark, sf_dir), 15, -0.10))


def q_lattice_unchanged(spark, sf_dir):
    return _detail_cols(LT.unchanged_perfect(lattice_detail(spark, sf_dir), 5))


def q_suspected_ref_errors(spark, sf_dir):
    r = reports(spark, sf_dir, ["segment_id"])
    return r.select("segment_id", F.explode("suspects").alias("s")).select("segment_id", "s.*")


def q_lattice_documented(spark, sf_dir):
    """Documented mode: the lattice never scores worse than the plain reference."""
    d = lattice_detail(spark, sf_dir, "documented")
    return d.groupBy("system").agg(F.sum("edits").alias("plain_edits"), F.sum("n").alias("plain_n"), F.sum("lattice_edits").alias("lattice_edits"),
                                   F.sum("lattice_n").alias("lattice_n"), F.count_if(F.col("lattice_edits") > F.col("edits")).alias("n_worse"))


def q_lattice_inspect(spark, sf_dir):
    r = reports(spark, sf_dir, ["segment_id", "ref"])
    return LT.zip_bins(r).select("segment_id", "bin_idx", "ref_tok", F.array_join("full_bin", "/").alias("full_bin"), "variants")


def q_second_segment(spark, sf_dir):
    """T5: the bins of the second segment of the sheet, for display (F21: prefixes)."""
    sheet = D.systems_wide(spark, sf_dir, LT.nth_segment(D.utterances(spark, sf_dir), 2))
    r = LT.segment_reports(LT.wide_segments(sheet), 3, "coded", ["segment_id", "ref"])
    rows = LT.zip_bins(r).select("segment_id", "bin_idx", "ref_tok", F.array_join("full_bin", "/").alias("full_bin"), "variants")
    return rows.withColumn("ref_tok", TX.display_prefix("ref_tok", 3))


def q_align_sql(spark, sf_dir):
    """V5: the alignment by its SQL name, in a lateral join."""
    LT.register_align_udtf(spark)
    return spark.sql("SELECT segment_id, system, count_if(a.op = 'sub') AS subs, count_if(a.op = 'del') AS dels, count_if(a.op = 'ins') AS ins, "
                     "count_if(a.op = 'match') AS hits FROM {pairs}, LATERAL align_words(ref, hyp) a GROUP BY segment_id, system",
                     pairs=systems_long(spark, sf_dir).where(F.size("ref") > 0))


QUERIES.update({
    "align_sql": q_align_sql,
    "second_segment": q_second_segment,
    "align_ops": q_align_ops,
    "lattice_bins": q_lattice_bins,
    "lattice_system_wer": q_lattice_system_wer,
    "lattice_detail": q_lattice_detail,
    "lattice_top": q_lattice_top,
    "lattice_unchanged": q_lattice_unchanged,
    "suspected_ref_errors": q_suspected_ref_errors,
    "lattice_inspect": q_lattice_inspect,
    "lattice_documented": q_lattice_documented,
})


# ── chunking ────────────────────────────────────────────────────────────────

from vachan.operators import chunking as CH  # noqa: E402
from vachan.operators import packing as PK  # noqa: E402

# Events as timed words: one user's events are one recording; the word is
# the event type and id (error events are blank words), start = epoch
# seconds, end = start + value.  Chunks hold at most a day, at least 1 s.
CHUNK_MAX, CHUNK_MIN = 86400.0, 1.0


def event_word_rows(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events")
    # Epoch seconds of a TIMESTAMP_NTZ, independent of the session time zone.
    start = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)") / 1e6
    return ev.select("user_id", "ts", "event_id",
                     F.when(F.col("event_type") == "error", F.lit(""))
                      .otherwise(F.concat_ws("-", "event_type", F.col("event_id").cast("string"))).alias("word"),
                     start.alias("start"), (start + F.col("value")).alias("end"))


def q_pack_chunks(spark, sf_dir):
    """C1 over every user's events: the distributed packer (a user holding a
    third of all events is split over many tasks); same result as folding
    each user's word array (``chunking.chunk_recordings``)."""
    ch = PK.pack_rows(event_word_rows(spark, sf_dir), "user_id", ["ts", "event_id"], CHUNK_MAX, CHUNK_MIN)
    return ch.select("user_id", "chunk_id", "text", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


def q_chunk_counts(spark, sf_dir):
    """Kept chunks per recording."""
    return CH.chunks_per_recording(q_pack_chunks(spark, sf_dir), ("user_id",))


QUERIES.update({"pack_chunks": q_pack_chunks, "chunk_counts": q_chunk_counts})


# ── transcript JSON documents ───────────────────────────────────────────────

from vachan.sources import transcripts as TS  # noqa: E402


def event_documents(spark, sf_dir):
    """One JSON transcript document per event, in all three schemas (and a
    few malformed ones), built by rule from the event columns."""
    ev = D.table(spark, sf_dir, "events")
    k, typ, uid = F.col("event_id"), F.col("event_type"), F.col("user_id").cast("string")
    s = ((k * 7) % 1000).cast("string")
    e = ((k * 7) % 1000 + k % 5).cast("string")
    e1 = ((k * 7) % 1000 + k % 5 + 1).cast("string")
    s_or_null = F.when(typ == "error", F.lit("null")).otherwise(s)
    d0 = F.concat(F.lit('{"words":[{"word":"'), typ, F.lit('","start":'), s_or_null, F.lit(',"end":'), e,
                  F.lit('},{"word":"u'), uid, F.lit('","start":'), e, F.lit(',"end":'), e1, F.lit("}]}"))
    d1 = F.concat(F.lit('{"words":[{"text":"'), typ, F.lit('","start_time":'), s, F.lit(',"end_time":'), e, F.lit("}]}"))
    d2 = F.concat(F.lit('{"segments":[{"words":[{"word":"'), typ, F.lit('","start":'), s, F.lit(',"end":'), e,
                  F.lit('}]},{"words":[{"text":"u'), uid, F.lit('","start":'), e, F.lit(',"end":'), e1,
                  F.lit('}]},{"other":1}]}'))
    d3 = (F.when(typ == "view", F.lit('{"k":1}')).when(typ == "click", F.lit("not json"))
           .otherwise(F.concat(F.lit('{"transcript":"'), typ, F.lit('","duration":'), s, F.lit("}"))))
    doc = F.when(k % 4 == 0, d0).when(k % 4 == 1, d1).when(k % 4 == 2, d2).otherwise(d3)
    return ev.select(k.alias("recording_id"), doc.alias("raw"))


def q_json_words(spark, sf_dir):
    p = event_documents(spark, sf_dir).select("recording_id", TS.parse_transcript("raw").alias("t"))
    shown = F.transform("t.words", lambda w: F.concat_ws("@", w["word"], w["start"].cast("bigint").cast("string"),
                                                         w["end"].cast("bigint").cast("string")))
    return p.select("recording_id", F.size("t.words").alias("n_words"),
                    F.array_join(shown, "|").alias("words"), F.col("t.reject_reason").alias("reject_reason"))


QUERIES.update({"json_words": q_json_words})


# ── sample arrays ───────────────────────────────────────────────────────────

from vachan.operators import audio as AU  # noqa: E402
from vachan.operators import audio_blocks as AB  # noqa: E402


def embedding_waves(spark, sf_dir):
    """``embeddings`` as two-channel recordings: the two halves of a vector."""
    e = D.table(spark, sf_dir, "embeddings")
    half = (F.size("embedding") / 2).cast("int")
    chans = F.array(F.slice("embedding", 1, half), F.slice("embedding", half + 1, half))
    return e.select("vec_id", "label", chans.alias("channels"))


def _micro(arr):
    return F.array_join(F.transform(arr, lambda v: F.round(v.cast("double") * 1e6).cast("bigint").cast("string")), ",")


# A vector is 32 samples a channel: blocks of 13 make every recording several rows.
WAVE_BLOCK = 13


def embedding_blocks(spark, sf_dir):
    w = embedding_waves(spark, sf_dir).select(F.col("vec_id").alias("recording_id"), F.lit(16000).alias("sampling_rate"), "channels")
    return AB.mono(AB.to_blocks(w, WAVE_BLOCK))


def q_wave_condition(spark, sf_dir):
    """C2 on blocks: one row per block, none per recording."""
    mono = embedding_blocks(spark, sf_dir)
    x = AB.condition(mono, AB.headers(mono))
    return x.select(F.col("recording_id").alias("vec_id"), "block", F.size("samples").alias("n_samples"), _micro("samples").alias("samples_e6"))


def q_wave_slice(spark, sf_dir):
    """C3 on blocks: a chunk's samples from the blocks that it touches."""
    mono = embedding_blocks(spark, sf_dir)
    e = D.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("recording_id"), "label")
    start = (F.col("recording_id") % 7) / 16000.0
    first, end = AB.sample_range(start, start + (F.lit(20) + F.col("label")) / 16000.0, F.col("n_samples"))
    chunks = e.join(AB.headers(mono), "recording_id").select("recording_id", F.lit(0).alias("chunk_id"), first.alias("first"), end.alias("end"), "peak", F.struct("label").alias("rest"))
    s = AU.keep_min_samples(AB.cut(mono, chunks, WAVE_BLOCK), "array", 0.001)
    return s.select(F.col("recording_id").alias("vec_id"), F.size("array").alias("n_samples"), _micro("array").alias("samples_e6"))


QUERIES.update({"wave_condition": q_wave_condition, "wave_slice": q_wave_slice})


# ── number words and code-switching on Devanagari text ──────────────────────

from vachan.functions import numbers as NW  # noqa: E402

# Devanagari stand-ins: every conversation token becomes one of these words,
# chosen by its length, and every fifth-length token carries a comma, so the
# derived text has number runs, idioms, loanwords and punctuation.
DEVANAGARI_WORDS = ["दो", "तीन", "सौ", "हज़ार", "लोग", "चार", "सात", "आठ", "साल", "एक", "पचास", "लाख",
                    "जॉब", "course", "है", "पाँच", "छह"]


def devanagari_text(spark, sf_dir):
    u = D.utterances(spark, sf_dir)
    lex = F.array(*[F.lit(w) for w in DEVANAGARI_WORDS])
    toks = TX.ws_tokens("Human")
    mapped = F.transform(toks, lambda t: F.concat(
        F.element_at(lex, (F.length(t) % len(DEVANAGARI_WORDS)) + 1),
        F.when(F.length(t) % 5 == 0, F.lit(",")).otherwise(F.lit(""))))
    return u.select("segment_id", F.array_join(mapped, " ").alias("raw_asr"))


def q_number_words(spark, sf_dir):
    x = devanagari_text(spark, sf_dir).select("segment_id", NW.normalize_numbers("raw_asr").alias("x"))
    shown = F.transform("x.changes", lambda c: F.concat_ws("=>", c["original"], c["replacement"],
                                                            c["position"].cast("string")))
    return x.select("segment_id", F.md5("x.text").alias("text_md5"), F.size("x.changes").alias("n_changes"),
                    F.array_join(shown, "|").alias("changes"))


def q_asr_cleanup(spark, sf_dir):
    x = devanagari_text(spark, sf_dir).select("segment_id", NW.asr_cleanup("raw_asr").alias("x"))
    return x.select("segment_id", F.md5("x.after_num_norm").alias("num_md5"),
                    F.md5("x.after_en_tagging").alias("tagged_md5"),
                    F.size("x.num_changes").alias("n_changes"), F.size("x.en_words").alias("n_en_words"))


QUERIES.update({"number_words": q_number_words, "asr_cleanup": q_asr_cleanup})


# ── training-set assembly ───────────────────────────────────────────────────

from vachan.plans import dataset as DSB  # noqa: E402


def embedding_recordings(spark, sf_dir):
    """Manifest, sample arrays and word timings derived from ``embeddings``:
    every vector is a two-channel 16 kHz recording of its length, spoken by
    speaker ``label``; its words are the vector id and its label, splitting
    the recording in two halves."""
    e = D.table(spark, sf_dir, "embeddings")
    dur = (F.size("embedding") / 2) / 16000.0
    manifest = e.select(F.col("vec_id").alias("recording_id"), F.col("label").cast("long").alias("user_id"),
                        F.format_string("https://h/c/hq/hi/%d/%d_audio.wav", F.col("label"), F.col("vec_id"))
                         .alias("rec_url_gcp"), dur.alias("duration"))
    waves = embedding_waves(spark, sf_dir).select(F.col("vec_id").alias("recording_id"),
                                                  F.lit(16000).alias("sampling_rate"), "channels")
    words = e.select(F.col("vec_id").alias("recording_id"), F.array(
        F.struct(F.concat(F.lit("शब्द"), F.col("vec_id").cast("string")).alias("word"), F.lit(0.0).alias("start"),
                 (dur / 2).alias("end")),
        F.struct(F.col("label").cast("string").alias("word"), (dur / 2).alias("start"), dur.alias("end"))
    ).alias("words"), F.lit(None).cast("string").alias("reject_reason"))
    return manifest, waves, words


def q_dataset_build(spark, sf_dir):
    manifest, waves, words = embedding_recordings(spark, sf_dir)
    out, _, _ = DSB.build_dataset(manifest, waves, words, max_chunk_sec=0.001, min_chunk_sec=0.0005)
    return out.select("recording_id", "user_id", "chunk_id", "split", "sentence",
                      F.size("audio.array").alias("n_samples"))


def q_dataset_rejects(spark, sf_dir):
    """S11 of the assembly, over inputs with faults of every kind by rule."""
    manifest, waves, words = faulty_recordings(spark, sf_dir)
    return DSB.rejects_of(DSB.plan_chunks(manifest, AB.headers(DSB.sample_blocks(waves)), words, 0.001, 0.0005))


def q_dataset_round_trip(spark, sf_dir):
    """The dataset written by split, and its validation part read back."""
    from vachan.session import ensure_checkpoint_dir
    from vachan.sources import files as FS

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/datasets/{uuid.uuid4().hex}"
    FS.write_split_dataset(q_dataset_build(spark, sf_dir), path, mode="error")
    return FS.read_split(spark, path, "validation").select("recording_id", "chunk_id", "sentence")


QUERIES.update({"dataset_build": q_dataset_build, "dataset_rejects": q_dataset_rejects, "dataset_round_trip": q_dataset_round_trip})


# ── files: sheets, CSV exchange, transcripts and assets, streams ────────────

from pyspark.sql import Observation  # noqa: E402

from vachan.session import ensure_checkpoint_dir  # noqa: E402
from vachan.sources import files as FS  # noqa: E402
from vachan.streaming.incremental import run_incremental, utterance_scores  # noqa: E402


def scratch(spark, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/exchange/{name}-{uuid.uuid4().hex}"


def q_sheet_rows(spark, sf_dir):
    """The sheet written in several files and read by position: row numbers run on
    from file to file, whatever the splits."""
    path = scratch(spark, "sheet")
    wide = D.systems_wide(spark, sf_dir).withColumn("Human", F.array_join(TX.tokenise("Human"), " "))
    FS.write_csv(wide.repartitionByRange(5, "segment_id").sortWithinPartitions("segment_id").drop("segment_id"), path, mode="error")
    sheet = FS.read_systems_sheet(spark, path)
    return sheet.select(F.col("segment_id").alias("sheet_row"), TX.url_basename("url").alias("file"), F.md5("Human").alias("ref_md5"), F.md5(F.col("`Model l`")).alias("hyp_md5"))


def q_results_exchange(spark, sf_dir):
    """S2 + S8: results through CSV, with quotes, line ends, white space at the ends, empty
    fields and values of the wrong type by rule."""
    path, k = scratch(spark, "results"), F.col("segment_id")
    ref = F.when(k % 7 == 0, F.concat(F.lit('say "'), F.col("Human"), F.lit('", ok'))).when(k % 7 == 1, F.concat(F.lit("two\nlines "), F.col("Human"), F.lit(" "))).when(k % 7 == 2, F.lit(""))
    out = D.utterances(spark, sf_dir).select(F.when(k % 11 == 0, F.concat(F.lit("n"), k.cast("string"))).otherwise(k.cast("string")).alias("idx"),
                                             ref.otherwise(F.col("Human")).alias("reference"), F.translate("Human", "aeiou", "eioua").alias("hypothesis"),
                                             F.when(k % 13 == 0, F.lit("n/a")).otherwise((k % 400 / 4).cast("string")).alias("wer"))
    FS.write_csv(out, path, mode="error")
    r = FS.read_results(spark, path, multi_line=True, with_rejects=True)
    return r.select("idx", F.md5(F.coalesce("reference", F.lit(""))).alias("reference_md5"), F.md5("hypothesis").alias("hypothesis_md5"), "wer", "reject_reason")


def q_manifest_exchange(spark, sf_dir):
    """S1 + S8: a manifest through CSV, with values that are not of their column's type."""
    path, k = scratch(spark, "manifest"), F.col("event_id")
    m = D.table(spark, sf_dir, "events").select(
        k.cast("string").alias("recording_id"), F.when(k % 10 == 0, F.lit("someone")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.format_string("https://h/c/hq/hi/%d/%d_audio.wav", "user_id", k).alias("rec_url_gcp"), F.when(k % 15 == 0, F.lit("long, very")).otherwise((k % 90 / 4).cast("string")).alias("duration"), F.lit("x").alias("more"))
    FS.write_csv(m, path, mode="error")
    return FS.read_manifest(spark, path).select("recording_id", "user_id", "duration", "reject_reason")


def q_asset_scan(spark, sf_dir):
    """S3 + S5 + S7: transcripts and audio as files, one a recording (a conversation: a
    segment per turn, over several lines), written by rule, found by scanning their
    folders and paired by the id in their paths."""
    root, k = scratch(spark, "assets"), F.col("recording_id")
    word = F.format_string('{"words":[{"word":"%s%d","start":%d,"end":%d}]}', "role", F.length("text"), "turn", F.col("turn") + 1)
    c = D.table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("recording_id")).agg(F.sort_array(F.collect_list(F.struct("turn", word.alias("w")))).alias("t"))
    doc = F.when(k % 6 == 0, F.lit("no json")).otherwise(F.concat(F.lit('{"segments":['), F.array_join("t.w", ",\n"), F.lit("]}")))
    for name, rows in (("transc", c.where(k % 4 != 1).select("recording_id", doc.alias("value"))), ("audio", c.where(k % 5 != 2).select("recording_id", F.repeat(F.lit("."), F.size("t")).alias("value")))):
        rows.repartition(max(8, 2 * spark.sparkContext.defaultParallelism), "recording_id").write.mode("error").partitionBy("recording_id").text(f"{root}/{name}")
    by_folder = r"recording_id=([0-9]+)/"
    audio = FS.read_assets(spark, f"{root}/audio", by_folder, "*.txt")
    return FS.pair_assets(audio, TS.read_transcripts(spark, f"{root}/transc", by_folder, "*.txt")).select(
        "recording_id", "length", F.size("words").alias("n_words"), F.array_join("words.word", " ").alias("words"), "reject_reason")


def faulty_recordings(spark, sf_dir):
    """Inputs of the assembly with faults of every kind by rule."""
    manifest, waves, words = embedding_recordings(spark, sf_dir)
    k = F.col("recording_id")
    manifest = manifest.withColumn("rec_url_gcp", F.when(k % 11 == 0, F.lit("no-ids-here")).otherwise(F.col("rec_url_gcp")))
    waves = waves.where(k % 13 != 0).withColumn("sampling_rate", F.when(k % 17 == 0, F.lit(8000)).otherwise(F.col("sampling_rate")))
    broken = F.transform("words", lambda w: w.withField("word", F.lit(None).cast("string")))
    words = words.where(k % 29 != 0).withColumn("words", F.when(k % 19 == 0, broken).otherwise(F.col("words")))
    return manifest, waves, words.withColumn("reject_reason", F.when(k % 23 == 0, F.lit("not json")).otherwise(F.col("reject_reason")))


def q_reject_counts(spark, sf_dir):
    """Rejects by reason, counted by the pass that writes the plan."""
    manifest, waves, words = faulty_recordings(spark, sf_dir)
    counters = Observation("rejects")
    DSB.plan_chunks(manifest, AB.headers(DSB.sample_blocks(waves)), words, 0.001, 0.0005, counters)
    return DSB.reject_counts(spark, counters)


def q_incremental_scores(spark, sf_dir):
    """SURVEY 2.14: E4 as a stream over files that arrive a few at a time; the sink holds
    what a batch over all of them gives."""
    root = scratch(spark, "stream")
    D.results_table(spark, sf_dir).repartition(6, "idx").write.mode("error").parquet(f"{root}/in")
    schema = "idx long, reference string, hypothesis string"
    run_incremental(spark, f"{root}/in", schema, utterance_scores, f"{root}/out", f"{root}/progress", max_files_per_trigger=2)
    return spark.read.parquet(f"{root}/out").select("idx", "wer_before_norm", "wer_after_norm", "wer_delta")


def q_script_flags(spark, sf_dir):
    """Script of a text, of mixed ones too, and the file that a URL ends in."""
    u, d = D.utterances(spark, sf_dir), F.lit("नमस्ते दुनिया ")
    k = F.col("segment_id")
    text = F.when(k % 3 == 0, F.concat(d, "Human")).when(k % 3 == 1, F.concat(F.repeat(d, 40), "Human")).otherwise(F.col("Human"))
    return u.select("segment_id", text.alias("t"), "url").select("segment_id", TX.is_roman_script("t").alias("roman"), TX.has_devanagari("t").alias("devanagari"), TX.url_basename("url").alias("file"))


def q_lattice_sparse(spark, sf_dir):
    """A sheet in which some references are empty; those segments are left out."""
    u = D.utterances(spark, sf_dir)
    wide = D.systems_wide(spark, sf_dir, u).withColumn("Human", F.when(F.col("segment_id") % 17 == 0, F.lit(" , ")).otherwise(F.col("Human")))
    r = LT.segment_reports(LT.wide_segments(wide), 3, "coded", ["segment_id", "systems"])
    return r.select("segment_id", "systems", F.explode("scores").alias("s")).select(
        "segment_id", F.element_at("systems", F.col("s.sys_ord")).alias("system"), "s.subs", "s.dels", "s.ins", "s.hits")


QUERIES.update({"sheet_rows": q_sheet_rows, "results_exchange": q_results_exchange, "manifest_exchange": q_manifest_exchange, "asset_scan": q_asset_scan, "reject_counts": q_reject_counts,
                "incremental_scores": q_incremental_scores, "script_flags": q_script_flags, "lattice_sparse": q_lattice_sparse})
