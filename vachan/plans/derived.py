"""Inputs derived from the driver tables (FIXTURES §4, SURVEY §7.3).

The driver tables hold no speech data, so the query inputs are derived from
them by fixed rules that both Spark and the DuckDB oracle apply:

* utterance: one ``conversations`` row, ``segment_id = conv_id*100 + turn``,
  reference = the **whole** text (no token cap);
* six systems ``m = 1..6`` built from the reference tokens, 1-based position
  ``p``: drop the token if ``(5k+3p+7m) % 13 = 0``; else systems 4-6 replace
  it by ``'y'`` if ``(k+p) % 23 = 0`` (a substitution three systems agree
  on), else replace it by ``'x' || (k+p+m) % 3`` if ``(7k+13p+5m) % 11 = 0``;
  systems 3-5 insert ``'um'`` after ``p`` if ``(k+p) % 19 = 0``; system 2 is
  the reference.

All of it is row-local (higher-order functions over the token array), so the
derivation adds no shuffle and grows linearly with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vachan.functions import lexicon as L
from vachan.functions import text as TX
from vachan.session import input_partitions, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table feeding CPU-heavy row work, spread over the cores if it is
    one small file (no-op for a many-file input)."""
    return input_partitions(table(spark, sf_dir, name))


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``segment_id, url, Human`` from ``conversations`` (D10 key columns)."""
    c = text_table(spark, sf_dir, "conversations")
    seg = F.col("conv_id") * 100 + F.col("turn")
    return c.select(seg.alias("segment_id"),
                    F.format_string("seg/%d/%d_audio.wav", F.col("conv_id"), seg).alias("url"),
                    F.col("text").alias("Human"))


def system_tokens(ref: Column, k: Column, m: int) -> Column:
    """Token array of system ``m`` derived from reference tokens ``ref``."""
    if m == 2:
        return ref

    def at(t, i):
        p = i + 1
        sub = F.when(((7 * k + 13 * p + 5 * m) % 11) == 0,
                     F.concat(F.lit("x"), ((k + p + m) % 3).cast("string"))).otherwise(t)
        if m in (4, 5, 6):
            sub = F.when(((k + p) % 23) == 0, F.lit("y")).otherwise(sub)
        kept = F.when(((5 * k + 3 * p + 7 * m) % 13) == 0, F.array().cast("array<string>")).otherwise(F.array(sub))
        if m in (3, 4, 5):
            return F.concat(kept, F.when(((k + p) % 19) == 0, F.array(F.lit("um"))).otherwise(
                F.array().cast("array<string>")))
        return kept

    return F.flatten(F.transform(ref, at))


def systems_wide(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """D10 sheet: ``segment_id, url, Human, Model H .. Model n`` (texts), of all utterances
    or of ``rows`` of them."""
    u = (utterances(spark, sf_dir) if rows is None else rows).withColumn("__ref", TX.tokenise("Human"))
    cols = [F.array_join(system_tokens(F.col("__ref"), F.col("segment_id"), m), " ").alias(name)
            for m, name in enumerate(L.SYSTEMS, start=1)]
    return u.select("segment_id", "url", "Human", *cols)


def results_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 results: ``idx, reference, hypothesis`` with hypothesis = system 3
    (``Model k``), or the reversed reference where ``segment_id % 10 = 0``
    (so that every WER tier is populated)."""
    u = utterances(spark, sf_dir).withColumn("__ref", TX.tokenise("Human"))
    k = F.col("segment_id")
    hyp = F.when(k % 10 == 0, F.reverse("__ref")).otherwise(system_tokens(F.col("__ref"), k, 3))
    return u.select(k.alias("idx"), F.array_join("__ref", " ").alias("reference"),
                    F.array_join(hyp, " ").alias("hypothesis"))


# Forms on which every canonicaliser rule acts, and what a second recogniser writes
# for them: list variants and their canonical words, Devanagari digits, a variant
# inside a longer word (a vowel sign follows it), decomposed letters.
def _forms() -> list[tuple[str, str]]:
    lists = [L.ORDINAL_REWRITES[i] for i in (0, 1, 3)] + [L.SCHWA_REWRITES[i] for i in (0, 7, 8, 22)] + [L.NUMBER_WORD_REWRITES[i] for i in (0, 5, 9, -1)]
    inside = L.SCHWA_REWRITES[0][0] + "\u0940"
    return [*lists, ("१२", "12"), ("२०२४", "2024"), (inside, inside), ("घर", "घर"), ("e\u0301tude", "\u00e9tude"), ("क\u093cलम", "कलम")]


FORMS = _forms()


def hindi_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``idx, reference, hypothesis``: every token becomes one of FORMS by length and
    position; every third one is canonical in the hypothesis.  Some references
    are empty or NULL."""
    u = utterances(spark, sf_dir)
    k = F.col("segment_id")
    ref, hyp = (F.array(*[F.lit(x[i]) for x in FORMS]) for i in (0, 1))
    toks = TX.ws_tokens("Human")

    def form(lex, t, i):
        return F.element_at(lex, ((F.length(t) + i + 1) % len(FORMS) + 1).cast("int"))

    reference = F.array_join(F.transform(toks, lambda t, i: form(ref, t, i)), " ")
    hypothesis = F.array_join(F.transform(toks, lambda t, i: F.when((k + i + 1) % 3 == 0, form(hyp, t, i)).otherwise(form(ref, t, i))), " ")
    return u.select(k.alias("idx"), F.when(k % 29 == 0, F.lit("")).when(k % 31 == 0, F.lit(None)).otherwise(reference).alias("reference"),
                    hypothesis.alias("hypothesis"))


# ── SQL text of the same derivations, for the DuckDB oracles ─────────────────

def sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_tokenise(expr: str) -> str:
    """F12 in DuckDB: NFC, punctuation to spaces, whitespace split."""
    return (f"list_filter(string_split_regex(regexp_replace(nfc_normalize(coalesce({expr}, '')), "
            f"{sql_lit(TX.SCORING_PUNCT)}, ' ', 'g'), {sql_lit(TX.WS + '+')}), lambda t: t <> '')")


def sql_system_tokens(ref: str, k: str, m: str) -> str:
    return (f"CASE WHEN {m} = 2 THEN {ref} ELSE flatten(list_transform({ref}, lambda t, p: "
            f"(CASE WHEN (5*{k}+3*p+7*{m}) % 13 = 0 THEN []::VARCHAR[] "
            f"ELSE [CASE WHEN {m} IN (4,5,6) AND (({k})+p) % 23 = 0 THEN 'y' "
            f"WHEN (7*{k}+13*p+5*{m}) % 11 = 0 THEN 'x' || ((({k})+p+{m}) % 3)::VARCHAR ELSE t END] END)"
            f" || (CASE WHEN {m} IN (3,4,5) AND (({k})+p) % 19 = 0 THEN ['um'] ELSE []::VARCHAR[] END))) END")


SQL_UTT = (f"SELECT conv_id*100+turn AS segment_id, "
           f"printf('seg/%d/%d_audio.wav', conv_id, conv_id*100+turn) AS url, text AS Human, "
           f"{sql_tokenise('text')} AS ref FROM conversations")

SQL_SYSTEMS = ("SELECT segment_id, url, ref, m, "
               "[" + ", ".join(sql_lit(n) for n in L.SYSTEMS) + "][m] AS system, "
               + sql_system_tokens("ref", "segment_id", "m") + " AS hyp "
               "FROM (SELECT *, unnest(range(1, 7)) AS m FROM utt)")

SQL_RESULTS = ("SELECT segment_id AS idx, array_to_string(ref, ' ') AS reference, "
               "array_to_string(CASE WHEN segment_id % 10 = 0 THEN list_reverse(ref) ELSE "
               + sql_system_tokens("ref", "segment_id", "3") + " END, ' ') AS hypothesis FROM utt")


def _sql_forms(i: int) -> str:
    return "[" + ", ".join(sql_lit(x[i]) for x in FORMS) + f"][(length(t) + p) % {len(FORMS)} + 1]"


SQL_HINDI = (f"SELECT segment_id AS idx, CASE WHEN segment_id % 29 = 0 THEN '' WHEN segment_id % 31 = 0 THEN NULL ELSE "
             f"array_to_string(list_transform(toks, lambda t, p: {_sql_forms(0)}), ' ') END AS reference, "
             f"array_to_string(list_transform(toks, lambda t, p: CASE WHEN (segment_id + p) % 3 = 0 THEN {_sql_forms(1)} ELSE {_sql_forms(0)} END), ' ') AS hypothesis "
             f"FROM (SELECT segment_id, regexp_extract_all(coalesce(Human, ''), {sql_lit(TX.NON_WS + '+')}, 0) AS toks FROM utt)")
