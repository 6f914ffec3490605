"""File sources and sinks.

Schemas are declared, never inferred: a manifest of a million rows is read
with one pass and no sampling job.  CSV is RFC 4180 in both directions: a quote
inside a quoted field is doubled (not escaped by a backslash), as Python's
``csv`` and pandas read and write it.  A field that holds a line end needs
``multi_line=True``, which makes each file one task; Parquet is the bulk form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vachan.functions import lexicon as L
from vachan.session import cut_lineage

MANIFEST_SCHEMA = T.StructType([
    T.StructField("recording_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("rec_url_gcp", T.StringType()), T.StructField("duration", T.DoubleType())])

# white space at the ends of a field belongs to it, in both directions
CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

WAVE_SCHEMA = "recording_id long, sampling_rate int, channels array<array<float>>"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with the D1 columns (other columns are ignored).  A value that
    isn't of its column's type becomes NULL, named in ``reject_reason``."""
    raw = spark.read.options(**CSV).csv(path)
    missing = [f.name for f in MANIFEST_SCHEMA.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"manifest lacks columns {missing}")
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in MANIFEST_SCHEMA.fields}
    bad = F.concat_ws(", ", *[F.when(F.col(c).isNotNull() & t.isNull(), F.lit(c)) for c, t in typed.items()],
                      F.when(F.col("recording_id").isNull(), F.lit("recording_id")))
    return raw.select(*[t.alias(c) for c, t in typed.items()], F.when(bad != "", F.concat(F.lit("bad "), bad)).alias("reject_reason"))


RESULT_TYPES = {"idx": "int", "sample_id": "int", "severity_rank": "int"}


def read_results(spark: SparkSession, path: str, multi_line: bool = False, with_rejects: bool = False) -> DataFrame:
    """Per-utterance results CSV; ``reference`` and ``hypothesis`` are
    required, ``idx``/``wer`` are typed when present.  A value that isn't of its
    type becomes NULL; ``with_rejects`` names such columns in ``reject_reason``."""
    raw = spark.read.options(**CSV, multiLine=multi_line).csv(path)
    if "reference" not in raw.columns or "hypothesis" not in raw.columns:
        raise ValueError("results table must have 'reference' and 'hypothesis' columns")
    types = {c: RESULT_TYPES.get(c) or ("double" if c.startswith("wer") else None) for c in raw.columns}
    cols = [F.col(c).try_cast(t).alias(c) if t else F.col(c) for c, t in types.items()]
    if with_rejects:
        bad = F.concat_ws(", ", *[F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in types.items() if t])
        cols.append(F.when(bad != "", F.concat(F.lit("bad "), bad)).alias("reject_reason"))
    return raw.select(*cols)


def number_rows(df: DataFrame, out: str = "row") -> DataFrame:
    """Add the 0-based number that each row has in its files, taken in order of path.

    ``df`` is read from files.  A file may be read in many blocks, which tasks take
    in any order; within a block rows come in file order.  Each row is written
    once with its block and its place there; the rows before a block are a sum over
    the blocks before it in its file and over the files before that, so the
    numbers don't depend on how the files were split.
    """
    rows = cut_lineage(df.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__block"),
                                 F.monotonically_increasing_id().alias("__place")))
    blocks = rows.groupBy("__path", "__block").agg(F.min("__place").alias("__first"), F.count("*").alias("__n"))
    files = blocks.groupBy("__path").agg(F.sum("__n").alias("__n"))
    # one row per file here, and per block of a file there: their number is that of splits, not of rows
    files = files.select("__path", F.coalesce(F.sum("__n").over(Window.orderBy("__path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__files"))
    blocks = blocks.select("__path", "__block", "__first", F.coalesce(F.sum("__n").over(Window.partitionBy("__path").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__blocks"))
    placed = rows.join(blocks.join(files, "__path"), ["__path", "__block"])
    return placed.withColumn(out, F.col("__files") + F.col("__blocks") + F.col("__place") - F.col("__first")).drop("__path", "__block", "__place", "__first", "__blocks", "__files")


def read_systems_sheet(spark: SparkSession, path: str, fmt: str = "csv", systems=None, multi_line: bool = False) -> DataFrame:
    """The multi-system sheet read by **position** (url, reference, one
    column per system); empty or missing cells become ``''``.  ``segment_id`` is
    the row's number in the sheet (``number_rows``)."""
    systems = systems or L.SYSTEMS
    reader = spark.read.options(**CSV, multiLine=multi_line) if fmt == "csv" else spark.read
    raw = reader.format(fmt).load(path)
    names = ["url", "Human", *systems]
    cols = raw.columns[:len(names)]
    df = number_rows(raw, "__row").select("__row", *[F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(cols, names)])
    return df.select(*[F.col("url")] + [F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names[1:]], F.col("__row").alias("segment_id"))


def systems_long(sheet: DataFrame, systems=None) -> DataFrame:
    """R1 + F12 on a sheet: ``(segment_id, url, system, sys_ord, ref, hyp)``."""
    from vachan.functions import text as TX

    systems = systems or L.SYSTEMS
    order = F.create_map(*[F.lit(x) for i, s in enumerate(systems, start=1) for x in (s, i)])
    wide = sheet.withColumn("ref", TX.tokenise("Human"))
    long = wide.unpivot(["segment_id", "url", "ref"], list(systems), "system", "hyp_text")
    return long.select("segment_id", "url", "system", F.element_at(order, F.col("system")).alias("sys_ord"),
                       "ref", TX.tokenise("hyp_text").alias("hyp"))


def read_eval_set(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S5 (re-aimed): an evaluation table ``(idx, reference, hypothesis)``;
    model inference is out of scope, hypotheses arrive as data."""
    df = (spark.read.options(**CSV) if fmt == "csv" else spark.read).format(fmt).load(path)
    return df.select(F.col("idx").try_cast("int").alias("idx"), "reference", "hypothesis")


def read_waves(spark: SparkSession, path: str) -> DataFrame:
    """Sample-array recordings (``WAVE_SCHEMA``), e.g. Parquet written by an
    upstream decoder."""
    return spark.read.schema(WAVE_SCHEMA).parquet(path)


def scan_options(names: str | None) -> dict:
    """Reader options to take every file of that name (a glob) below a folder.  Folders are
    listed by tasks; a glob in the path is expanded on the driver, folder by folder."""
    return {"recursiveFileLookup": True, "pathGlobFilter": names} if names else {}


def read_assets(spark: SparkSession, pattern: str, id_pattern: str = r"([0-9]+)\.[A-Za-z0-9]+$", names: str | None = None) -> DataFrame:
    """Files matched by ``pattern`` as ``(recording_id, path, length)``,
    the id taken from the file name (``{rec_id}.wav``); contents are not
    loaded here (``binaryFile`` reads lazily per selected column).  With ``names``,
    ``pattern`` is a folder, and the files so named anywhere below it are taken."""
    df = spark.read.format("binaryFile").options(**scan_options(names)).load(pattern).select("path", "length")
    return df.select(F.regexp_extract("path", id_pattern, 1).try_cast("long").alias("recording_id"), "path", "length")


def pair_assets(audio: DataFrame, transcripts: DataFrame) -> DataFrame:
    """S7 + S11: the two halves of each recording by the id in their file names:
    ``recording_id, length, words, reject_reason``; a half without the other, or a file
    whose name holds no id, is a reject."""
    a = audio.select("recording_id", "length", F.lit(True).alias("__a"))
    t = transcripts.select("recording_id", "words", F.col("reject_reason").alias("__why"), F.lit(True).alias("__t"))
    j = a.join(t, "recording_id", "full_outer")
    reason = (F.when(F.col("recording_id").isNull(), F.lit("file name without an id")).when(F.col("__a").isNull(), F.lit("missing audio"))
               .when(F.col("__t").isNull(), F.lit("missing transcript")).otherwise(F.col("__why")))
    return j.select("recording_id", "length", F.when(reason.isNull(), F.col("words")).alias("words"), reason.alias("reject_reason"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV, no index column."""
    df.write.mode(mode).options(**CSV).csv(path)


def write_split_dataset(examples: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Examples partitioned by ``split`` (train / validation)."""
    examples.write.mode(mode).partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Read back; a ``split`` filter prunes the other partition folders."""
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df
