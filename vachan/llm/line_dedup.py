"""Removal of lines that many documents share (op 13, native).

1. Texts are split at \\n and exploded to lines with their positions.  A line's
   key is the line stripped of ASCII white space with A-Z, and nothing else,
   lowered; keys below ``min_chars`` code points take no part.
2. Keys are hashed (MD5, 128 bits), and distinct documents are counted per hash:
   partial counts per task, then per (hash, document), then per hash, so a
   line that a third of all documents share reaches the last step as one row
   per task.
3. Hashes held by at least ``min_docs`` documents go back to the lines.  Those of
   a large share of all (hash, document) pairs, fewer than 10,000 by their
   definition, are broadcast; the others meet in a shuffle join.
4. Positions to drop are gathered per document, and each text is put together
   again by position from the stretches of lines between them.

Everything is DataFrame code.  Lines travel as narrow (id, text hash, position,
key hash) rows; texts are shuffled once, to meet their positions.

Defined results: a null or empty text is one empty line; documents are told
apart by id, so rows that repeat an id count as one document, and lines stay
in all rows of the largest id that holds them; null ids count as one document
below all others; a text that loses every line becomes empty; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vachan.llm.common import NO_ID, drop, join_hot, store

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\f\r"
MIN_CHARS = 20
MIN_DOCS = 3


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def key_of(line: Column) -> Column:
    """The line without white space at its ends, A-Z lowered."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, mark, text): ``key`` stands for a null id too, ``mark`` tells texts of one id apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    return d.select("id", F.coalesce("id", F.lit(NO_ID)).alias("key"), F.unhex(F.md5("text")).alias("mark"), "text")


def shared_lines(texts: DataFrame, min_chars: int, min_docs: int) -> tuple[DataFrame, DataFrame, str]:
    """(lines that may be dropped, (hash, docs, keep) of shared ones, the latter's path)."""
    each = texts.select("key", "mark", F.posexplode(lines_of(F.col("text"))).alias("position", "line"))
    each = each.select("key", "mark", "position", key_of(F.col("line")).alias("line")).filter(F.length("line") >= min_chars)
    each = each.select("key", "mark", "position", F.md5("line").alias("hash"))
    shared = each.groupBy("hash").agg(F.countDistinct("key").alias("docs"), F.max("key").alias("keep")).filter(F.col("docs") >= min_docs)
    shared, path = store(shared, "shared-lines")
    return each, shared, path


def without(lines: Column, gone: Column) -> Column:
    """``lines`` without those at the sorted positions ``gone``: the stretches between them."""
    def stretch(k):
        first = F.when(k == 0, F.lit(0)).otherwise(F.get(gone, k - 1) + 1)
        end = F.when(k == F.size(gone), F.size(lines)).otherwise(F.get(gone, k))
        return F.slice(lines, first + 1, end - first)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), stretch))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, n_lines, n_dropped, kept) for every row of ``docs``; ``kept`` is the text that is left."""
    texts = texts_of(docs, id_col, text_col)
    each, shared, path = shared_lines(texts, min_chars, min_docs)
    total = shared.agg(F.sum("docs")).first()[0]
    if not total:
        drop(docs.sparkSession, path)
        return texts.select("id", F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.col("text").alias("kept"))
    judged = join_hot(each, shared, "hash", "docs", total, "mark").filter(F.col("g.keep") != F.col("key"))
    gone = judged.groupBy("key", "mark").agg(F.sort_array(F.collect_set("position")).alias("gone"))
    joined = texts.join(gone, ["key", "mark"], "left")
    # the array of lines is made once and named, then used
    named = F.transform(F.array(lines_of(F.col("text"))), lambda lines: F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(without(lines, F.col("gone")), "\n")).alias("kept")))
    out = joined.select("id", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), named[0].alias("x"))
    return out.select("id", "x.n_lines", F.greatest(F.col("n_dropped"), F.lit(0).cast("long")).alias("n_dropped"), "x.kept")
