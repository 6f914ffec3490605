"""Word error scoring.

Edit distance runs on Spark's built-in ``levenshtein``: the distinct words of
one (reference, hypothesis) pair are numbered, every word becomes one
supplementary-plane code point (a pair with more than 1,048,576 distinct words
stops the job with an error: there is no code point left for it), and the two code strings are compared character by
character in the JVM.  The numbering array is bound once per row as a lambda
variable (``transform(array(dict), d -> ...)``): Catalyst cannot inline a
lambda variable, so the array is never rebuilt per word even when a filter
on the score is pushed below the projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vachan.functions import text as TX

_CODE_BASE = 0x10000  # first supplementary code point; avoids surrogates
_CODES = 0x10FFFF - _CODE_BASE  # array positions start at 1


def _coded(arr: Column, dictionary: Column) -> Column:
    hexes = F.transform(arr, lambda w: F.lpad(F.hex(F.array_position(dictionary, w) + F.lit(_CODE_BASE)), 8, "0"))
    return F.decode(F.unhex(F.array_join(hexes, "")), "UTF-32")


def edit_distance(ref, hyp) -> Column:
    """Word-level Levenshtein distance of two token arrays."""
    r, h = TX._col(ref), TX._col(hyp)
    per_row = F.transform(F.array(F.array_distinct(F.concat(r, h))),
                          lambda d: F.when(F.size(d) <= _CODES, F.levenshtein(_coded(r, d), _coded(h, d)))
                          .otherwise(F.raise_error(F.lit("edit_distance: over 1,048,575 distinct words in a pair")).cast("int")))
    return F.element_at(per_row, 1)


def with_edit_distance(df: DataFrame, ref: str, hyp: str, out: str = "edits") -> DataFrame:
    """E1 as a column ``out``."""
    return df.withColumn(out, edit_distance(ref, hyp))


def with_plain_wer(df: DataFrame, ref: str, hyp: str, prefix: str = "") -> DataFrame:
    """``{prefix}edits``, ``{prefix}n`` and ``{prefix}wer`` (4 dp, 0.0 if n = 0).

    An empty reference scores wer 0.0 with edits = hypothesis length, n = 0.
    """
    e, n, w = f"{prefix}edits", f"{prefix}n", f"{prefix}wer"
    df = with_edit_distance(df, ref, hyp, e)
    return (df.withColumn(n, F.size(ref))
              .withColumn(w, F.when(F.col(n) > 0, F.round(F.col(e) / F.col(n), 4)).otherwise(F.lit(0.0))))


def jiwer_words(c) -> Column:
    """Words as the default WER transform gives them: runs of two or more
    whitespace characters become one space, ends are stripped, then the text is
    split on single spaces (a lone tab stays inside its word)."""
    x = F.regexp_replace(F.coalesce(TX._col(c), F.lit("")), TX.WS + "{2,}", " ")
    x = F.regexp_replace(x, "^" + TX.WS + "+|" + TX.WS + "+$", "")
    return F.filter(F.split(x, " "), lambda t: t != "")


def with_utterance_wer(df: DataFrame, reference: str = "reference", hypothesis: str = "hypothesis",
                       out: str = "wer", keep_counts: bool = False) -> DataFrame:
    """Per-utterance WER in percent, 2 dp, no normalisation.

    An empty reference has no defined WER: ``out`` is NULL and
    ``{out}_reject`` says why.
    """
    r, h, e, n = f"__r_{out}", f"__h_{out}", f"{out}_edits", f"{out}_n"
    df = df.withColumn(r, jiwer_words(reference)).withColumn(h, jiwer_words(hypothesis))
    df = with_edit_distance(df, r, h, e).withColumn(n, F.size(r))
    df = (df.withColumn(out, F.when(F.col(n) > 0, F.round(F.col(e) * 100.0 / F.col(n), 2)))
            .withColumn(f"{out}_reject", F.when(F.col(n) == 0, F.lit("empty reference"))))
    df = df.drop(r, h)
    return df if keep_counts else df.drop(e, n)


def score_rejects(scored: DataFrame, out: str = "wer") -> DataFrame:
    """Rows of ``with_utterance_wer`` without a score, and why."""
    return scored.where(F.col(f"{out}_reject").isNotNull()).withColumnRenamed(f"{out}_reject", "reject_reason")


def corpus_wer(df: DataFrame, edits: str = "edits", n: str = "n", by: list[str] | None = None) -> DataFrame:
    """Micro-averaged WER = sum(edits) / sum(n) (one partial+final hash agg)."""
    aggs = [F.sum(edits).alias("total_edits"), F.sum(n).alias("total_words")]
    g = df.groupBy(*by) if by else df
    out = g.agg(*aggs)
    return out.withColumn("wer", F.when(F.col("total_words") > 0,
                                        F.col("total_edits") / F.col("total_words")).otherwise(F.lit(0.0)))


def with_before_after(df: DataFrame, reference: str = "reference", hypothesis: str = "hypothesis",
                      convert_number_words: bool = False, mode: str = "coded",
                      null_as: str = "empty") -> DataFrame:
    """WER before and after canonicalisation, each rounded to 2 dp, and the
    rounded difference (before - after)."""
    fill = "" if null_as == "empty" else "nan"
    df = (df.withColumn("__ref_raw", F.coalesce(F.col(reference), F.lit(fill)))
            .withColumn("__hyp_raw", F.coalesce(F.col(hypothesis), F.lit(fill)))
            .withColumn("__ref_norm", TX.canonicalise("__ref_raw", convert_number_words, mode, null_as))
            .withColumn("__hyp_norm", TX.canonicalise("__hyp_raw", convert_number_words, mode, null_as)))
    df = with_utterance_wer(df, "__ref_raw", "__hyp_raw", "wer_before_norm")
    df = with_utterance_wer(df, "__ref_norm", "__hyp_norm", "wer_after_norm")
    return (df.withColumn("wer_delta", F.round(F.col("wer_before_norm") - F.col("wer_after_norm"), 2))
              .drop("__ref_raw", "__hyp_raw", "__ref_norm", "__hyp_norm"))


def before_after_summary(scored: DataFrame) -> DataFrame:
    """Macro means of the rounded per-row scores and their difference."""
    return (scored.agg(F.avg("wer_before_norm").alias("avg_wer_before"),
                       F.avg("wer_after_norm").alias("avg_wer_after"))
                  .withColumn("reduction_pp", F.col("avg_wer_before") - F.col("avg_wer_after")))


def preview(scored: DataFrame, order_col: str = "idx", n: int = 10) -> DataFrame:
    """T4: the first ``n`` rows in ``order_col`` order (TakeOrdered; the limit
    is the feature)."""
    return scored.select("reference", "hypothesis", "wer_before_norm", "wer_after_norm", order_col) \
                 .orderBy(order_col).limit(n)
