"""Registered queries of the training-data operators.  Each applies its operator,
with production parameters, to its whole table; contract columns are derived
from the operator's output here."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vachan.llm import exact_dedup, html_extract, line_dedup, merkle, mixing, ngram_join, packing, period_runs, pii, quality, suffix_dedup, token_files, warc
from vachan.llm.common import scratch_path, store


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return p.withColumnRenamed("id", "doc_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = quality.score(table(spark, sf_dir, "documents"))
    return s.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "distance2")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "sequences")
    token_files.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, folder).withColumnRenamed("id", "doc_id")


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = html_extract.extract_pages(table(spark, sf_dir, "pages"))
    return t.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pii.find(table(spark, sf_dir, "documents"))
    return p.select(F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(table(spark, sf_dir, "documents"))
    return m.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = ngram_join.cluster(table(spark, sf_dir, "documents"))
    return c.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = f"llm_digest_index_{uuid.uuid4().hex}"
    d, _ = store(exact_dedup.dedup_batch(table(spark, sf_dir, "documents"), index, "batch-0"), "op8")
    spark.sql(f"DROP TABLE {index}")  # no later run reads this one's index
    return d.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return d.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's repetition: in every tenth document (by checksum of its id) the
    words from a on repeat the p words that stand there."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op11_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = period_runs.find(table(spark, sf_dir, "documents"), rewrite=planted)
    line = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    d = found.select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(line, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return d.select("doc_id", "n_runs", (-F.col("b.start")).alias("start"), F.col("b.length").alias("length"), (-F.col("b.period")).alias("period"),
                    F.floor(1000 * F.col("b.length") / -F.col("b.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    doc_id, source, lang, n_chars, text = (F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    tampered = merkle.leaf(doc_id, source, lang, n_chars.cast("decimal(20,0)") + 1, text)
    proved = merkle.prove(docs, "lang", "doc_id", merkle.leaf(doc_id, source, lang, n_chars, text), F.when(F.crc32(doc_id.cast("string")) % 7 == 0, tampered))
    return proved.withColumnRenamed("item", "doc_id")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return d.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_token_files": op3_token_files,
    "op4_html_extract": op4_html_extract,
    "op5_pii": op5_pii,
    "op6_mixing": op6_mixing,
    "op7_ngram_join": op7_ngram_join,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_warc": op9_warc,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_period_runs": op11_period_runs,
    "op12_merkle": op12_merkle,
    "op13_line_dedup": op13_line_dedup,
}
