"""Session helpers.

Nothing here hard-codes a cluster: the builder only fills settings that are
not already set, and the checkpoint folder is read from the session
(``spark.checkpoint.dir``) so that a cluster's shared folder is used as is.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # ArrayType/StructType results of Arrow UDFs stay in Arrow batches.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
}


def get_spark(app: str = "vachan", master: str | None = None, shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Local or cluster session with the defaults above (existing settings win)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = os.environ.get("VACHAN_DRIVER_MEMORY", "16g")
        if shuffle_partitions:  # local tables are single files: deal them over the cores
            conf["spark.vachan.input.partitions"] = str(shuffle_partitions)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def workers_find_package() -> bool:
    """Whether Python workers import this package by themselves: it is installed, or its
    folder is on the PYTHONPATH that they inherit."""
    import site

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    inherited = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    return root in inherited or root in [os.path.abspath(p) for p in [*site.getsitepackages(), site.getusersitepackages()]]


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (``addPyFile`` of a zip), once a session, unless
    they find it by themselves; workers import the kernels by module name."""
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_vachan_shipped", False) or workers_find_package():
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="vachan-pkg-"), "vachan.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    sc._vachan_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    unchanged.  A local scratch folder is only chosen in local mode (tests).
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="vachan-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a Parquet table under the session's checkpoint
    folder and read it back.

    A reliable ``checkpoint()`` runs its input twice (a count, then the file
    write) unless it is cached; a written table costs one pass, survives
    executor loss (shared folder, no local state) and gives the optimizer real
    file statistics for the plans that read it.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tables/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def input_partitions(df: DataFrame) -> DataFrame:
    """Deal a small single-file input over as many tasks as the session asks for in
    ``spark.vachan.input.partitions``; without that setting (on a cluster, where inputs
    have many splits) nothing is shuffled."""
    n = df.sparkSession.conf.get("spark.vachan.input.partitions", None)
    return df.repartition(int(n)) if n else df
