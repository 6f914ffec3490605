"""Greedy duration packing of timed words into chunks.

Each chunk boundary depends on where the previous chunk started, so this is
a fold, not a lag/sum window: ``aggregate`` over the recording's word array
(kept in input order) with state ``(chunks, words, start, end)``.  Rules:

* a word whose stripped text is empty is skipped;
* a non-empty chunk is flushed before a word whose end lies more than
  ``max_dur`` after the chunk start (strict ``>``); a single long word still
  forms its own chunk;
* a flushed chunk is kept if ``last end - first start >= min_dur`` and its
  space-joined (untrimmed) words are not blank; its text is then cleaned.

The fold runs inside one row (one recording), so a recording's words are
one array: recordings are bounded by their audio length.  A NULL word text
or time makes the recording a reject, as a failed parse would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vachan.functions import text as TX

CHUNK_TYPE = "array<struct<text:string,start:double,end:double>>"


def _blank(c: Column) -> Column:
    return F.regexp_replace(c, "^" + TX.WS + "+|" + TX.WS + "+$", "") == ""


def pack_words(words, max_dur: float = 29.0, min_dur: float = 0.5, clean: bool = True) -> Column:
    """``array<struct<word,start,end>>`` to ``array<struct<text,start,end>>``."""
    w_arr = TX._col(words)
    empty_chunks = F.array().cast(CHUNK_TYPE)
    init = F.struct(empty_chunks.alias("chunks"), F.array().cast("array<string>").alias("cur"),
                    F.lit(None).cast("double").alias("cs"), F.lit(None).cast("double").alias("ce"))

    def keep(acc_cur, cs, ce) -> Column:
        return (F.size(acc_cur) > 0) & ((ce - cs) >= F.lit(min_dur)) & ~_blank(F.array_join(acc_cur, " "))

    def chunk(acc_cur, cs, ce) -> Column:
        return F.array(F.struct(F.array_join(acc_cur, " ").alias("text"), cs.alias("start"), ce.alias("end")))

    def step(acc, w):
        cs = F.coalesce(acc["cs"], w["start"])
        flush = (F.size(acc["cur"]) > 0) & ((w["end"] - cs) > F.lit(max_dur))
        chunks = F.when(flush & keep(acc["cur"], cs, acc["ce"]),
                        F.concat(acc["chunks"], chunk(acc["cur"], cs, acc["ce"]))).otherwise(acc["chunks"])
        nxt = F.struct(chunks.alias("chunks"),
                       F.when(flush, F.array(w["word"])).otherwise(F.concat(acc["cur"], F.array(w["word"]))).alias("cur"),
                       F.when(flush, w["start"]).otherwise(cs).alias("cs"),
                       w["end"].alias("ce"))
        return F.when(_blank(w["word"]), acc).otherwise(nxt)

    def finish(acc):
        return F.when(keep(acc["cur"], acc["cs"], acc["ce"]),
                      F.concat(acc["chunks"], chunk(acc["cur"], acc["cs"], acc["ce"]))).otherwise(acc["chunks"])

    packed = F.aggregate(w_arr, init, step, finish)
    if clean:
        packed = F.transform(packed, lambda c: F.struct(TX.clean_transcript(c["text"]).alias("text"),
                                                        c["start"].alias("start"), c["end"].alias("end")))
    return packed


def bad_words(words) -> Column:
    """True when a word has a NULL text or time (the recording is rejected)."""
    return F.exists(TX._col(words), lambda w: w["word"].isNull() | w["start"].isNull() | w["end"].isNull())


def chunk_recordings(df: DataFrame, words_col: str = "words", key_cols=("recording_id",),
                     max_dur: float = 29.0, min_dur: float = 0.5) -> DataFrame:
    """C1 + R3: one row per kept chunk ``(*keys, chunk_id, text, start, end)``.
    Recordings with malformed words produce no chunks (see ``chunk_rejects``)."""
    ok = df.where(~bad_words(words_col))
    packed = ok.select(*key_cols, F.posexplode(pack_words(words_col, max_dur, min_dur)).alias("chunk_id", "c"))
    return packed.select(*key_cols, "chunk_id", "c.text", "c.start", "c.end")


def chunk_rejects(df: DataFrame, words_col: str = "words", key_cols=("recording_id",)) -> DataFrame:
    """Recordings whose words cannot be packed, with a reason."""
    return df.where(bad_words(words_col)).select(*key_cols, F.lit("null word text or time").alias("reject_reason"))


def words_from_rows(rows: DataFrame, key_cols, order_cols, word: str = "word", start: str = "start",
                    end: str = "end") -> DataFrame:
    """Timed-word rows to one ordered word array per recording (D2).  The
    sort key travels inside the struct and is dropped after ``array_sort``."""
    s = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order_cols)],
                 F.col(word).alias("word"), F.col(start).alias("start"), F.col(end).alias("end"))
    g = rows.groupBy(*key_cols).agg(F.array_sort(F.collect_list(s)).alias("__w"))
    return g.select(*key_cols, F.transform("__w", lambda x: F.struct(x["word"].alias("word"),
                                                                      x["start"].alias("start"),
                                                                      x["end"].alias("end"))).alias("words"))


def chunks_per_recording(chunks: DataFrame, key_cols=("recording_id",)) -> DataFrame:
    """Kept chunks per recording (partial aggregation)."""
    return chunks.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n_chunks"))
