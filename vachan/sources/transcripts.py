"""Transcript JSON documents to timed-word arrays.

Each document is one string (``read.text(path, wholetext=True)``) parsed to a
VARIANT.  Schema priority is by key **presence**: ``words`` > ``segments`` >
``transcript``/``text``.  Word text is the first present of ``word``,
``text`` (else ``""``); times are the first present of ``start`` /
``start_time`` (``end`` / ``end_time``) in the top-level schema, only
``start`` / ``end`` inside segments, else 0.  The text schema yields one word
spanning ``[0, duration or 30]``.  A document with none of the keys has no
words (not an error).  A present key holding JSON null, a word or segment that
is not an object, a word text that is not a string or a time that is not a
number makes the document a reject, as do non-JSON text and non-object JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_TYPE = "array<struct<word:string,start:double,end:double>>"


# what a word object may hold; an absent key is NULL, a JSON null is a variant
_TIMED = "struct<`word`: variant, `text`: variant, `start`: variant, `start_time`: variant, `end`: variant, `end_time`: variant>"
_HEAD = "struct<`transcript`: variant, `text`: variant, `duration`: variant>"


def _string(x: Column) -> Column:
    return F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))


def _number(x: Column) -> Column:
    return F.try_variant_get(x, "$", "double")


def _first(item: Column, keys, getter, default) -> Column:
    """The first present key of a struct of variants, read by ``getter``."""
    x = F.coalesce(*[item[k] for k in keys])
    return F.when(x.isNull(), default).otherwise(getter(x))


def _word(w: Column, start_keys, end_keys) -> Column:
    """A timed word; NULL for an item that was no object."""
    return F.when(w.isNotNull(), F.struct(_first(w, ["word", "text"], _string, F.lit("")).alias("word"),
                                          _first(w, start_keys, _number, F.lit(0.0)).alias("start"),
                                          _first(w, end_keys, _number, F.lit(0.0)).alias("end")))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(F.struct(value.alias("x"))), lambda p: body(p["x"])), 1)


def parse_transcript(raw) -> Column:
    """``struct<words WORD_TYPE, reject_reason STRING>`` of one JSON document.

    The document is parsed once: the VARIANT is bound as a lambda variable and
    every schema branch reads it.  A list of words is taken out by one typed get
    (items that are no objects come out NULL), not key by key."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    return _let(F.try_parse_json(raw), _resolve)


def _resolve(v: Column) -> Column:
    def has(key):
        return F.variant_get(v, f"$.{key}", "variant").isNotNull()

    def listed(key, item, body):
        """``body`` of the list at ``key``; a present key that holds no list gives NULL words."""
        return lambda rest: _let(F.try_variant_get(v, f"$.{key}", f"array<{item}>"), lambda xs: F.when(xs.isNotNull() | has(key), body(xs)).otherwise(rest))

    def timed(xs):
        return F.transform(xs, lambda w: _word(w, ["start", "start_time"], ["end", "end_time"]))

    def in_segments(segs):
        lists = F.transform(segs, lambda s: F.when(s.isNull(), F.lit(None)).when(s["words"].isNull(), F.array().cast(f"array<{_TIMED}>"))
                            .otherwise(F.try_variant_get(s["words"], "$", f"array<{_TIMED}>")))
        # flatten gives NULL where a segment is no object or holds no list
        return F.transform(F.flatten(lists), lambda w: _word(w, ["start"], ["end"]))

    def whole(head):
        text = _first(head, ["transcript", "text"], _string, F.lit(""))
        one = F.struct(text.alias("word"), F.lit(0.0).alias("start"), _first(head, ["duration"], _number, F.lit(30.0)).alias("end"))
        return F.when(head["transcript"].isNotNull() | head["text"].isNotNull(), F.array(one)).otherwise(F.array().cast(WORD_TYPE))

    is_object = F.try_variant_get(v, "$", _HEAD).isNotNull()
    words = listed("words", _TIMED, timed)(listed("segments", "struct<`words`: variant>", in_segments)(_let(F.try_variant_get(v, "$", _HEAD), whole)))

    def checked(ws):
        reason = (F.when(v.isNull(), F.lit("not json")).when(~is_object, F.lit("not an object"))
                   .when(ws.isNull() | F.exists(ws, lambda w: w.isNull()), F.lit("malformed word list"))
                   .when(F.exists(ws, lambda w: w["word"].isNull() | w["start"].isNull() | w["end"].isNull()), F.lit("null word text or time")))
        return _let(reason, lambda r: F.struct(F.when(r.isNull(), ws).alias("words"), r.alias("reject_reason")))

    # the resolved word list is bound once (it feeds the checks and the output)
    return _let(words, checked)


def read_transcripts(spark: SparkSession, path: str, id_pattern: str = r"([^/]+)\.json$", names: str | None = None) -> DataFrame:
    """S3 + S7: one row per JSON file, ``recording_id`` from the file name,
    ``words`` and ``reject_reason`` from ``parse_transcript``.  With ``names``, ``path`` is
    a folder, and the files so named anywhere below it are taken."""
    from vachan.sources.files import scan_options

    raw = spark.read.options(**scan_options(names)).text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
    rid = F.regexp_extract("path", id_pattern, 1)
    return raw.select(F.coalesce(rid.try_cast("long"), F.lit(None).cast("long")).alias("recording_id"), "path",
                      parse_transcript("raw").alias("t")).select("recording_id", "path", "t.words", "t.reject_reason")
