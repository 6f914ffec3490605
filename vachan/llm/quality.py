"""Quality rules by robust multivariate outliers (op 2).

Each document becomes a vector of transformed statistics.  Per language and
source the minimum-covariance-determinant estimate of its centre and scatter
is found by concentration steps: take the three quarters of the rows that lie
nearest by Mahalanobis distance, estimate again from those, repeat until the
determinant no longer falls.  Two deterministic starts are carried along and the
one with the smaller determinant wins.  A document is rejected when its squared distance exceeds a
chi-square quantile.

A step is two aggregations of narrow rows: a histogram of distances per group
(the nearest three quarters are a cut in it) and the moments of the rows below
the cut.  Both pre-aggregate in the tasks, so a hot source costs no more than
a small one; estimates stay a table with one row per group, and groups that
have settled take no part in further steps.  Every step that counts lowers the log
determinant by SETTLED at least, and the floors bound it below, so steps end.  Statistics
that are constant in clean text (symbols, repeated lines) have no scatter, so
each coordinate has a noise floor that is added to the diagonal.  Floors are
small against the range of their coordinate, and shares go through a logit, so
that a document far out in one statistic alone is rejected.

Defined results: null text has no words and fails the base rules; null
language or source is a group of its own; groups below MIN_ROWS rows are
pooled; rows that repeat an id are judged each; an empty table gives an empty
result; other columns pass through ``keep_clean`` unchanged.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vachan.llm.common import modest_batches, store
from vachan.llm.text_stats import STATS, stat_batches

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# coordinate: (transform of the statistics, noise floor of its standard deviation)
FLOORS = {"x0": 0.05, "x1": 0.10, "x2": 0.50, "x3": 0.50}
NEAR_ZERO = 0.05  # added to a share and to its rest before the logit
X = list(FLOORS)
P = len(X)
GRID = 1024.0  # coordinates are rounded to 1/1024, which keeps their sums exact
SUPPORT = 0.75
SETTLED = 1e-4  # a step that lowers the log determinant by less is the last
MIN_ROWS = 60
TAIL = 1e-3
BINS = 32.0  # histogram bins per doubling of the squared distance
MAX_BROADCAST_GROUPS = 100_000  # an estimate is below 300 bytes


def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function, by the series of the incomplete gamma."""
    a, h = k / 2.0, x / 2.0
    if h <= 0:
        return 0.0
    term = total = 1.0 / a
    n = a
    while term > total * 1e-16:
        n += 1.0
        term *= h / n
        total += term
    return min(1.0, total * math.exp(-h + a * math.log(h) - math.lgamma(a)))


def chi2_quantile(q: float, k: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < q else (lo, mid)
    return hi


CUTOFF = chi2_quantile(1 - TAIL, P)
#: scatter of the nearest SUPPORT of normal data, made consistent
CONSISTENCY = SUPPORT / chi2_cdf(chi2_quantile(SUPPORT, P), P + 2)


def stat(name: str) -> str:
    return f"__stat_{name}"


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the word statistics as columns ``__stat_*`` (no shuffle)."""
    names = modest_batches(docs).columns
    schema = T.StructType([*docs.schema.fields, *(T.StructField(stat(s), T.LongType()) for s in STATS)])

    def run(batches):
        for out in stat_batches(batches, names, text_col):
            yield out.rename_columns([*names, *map(stat, STATS)])

    return docs.mapInArrow(run, schema)


def base_failed() -> F.Column:
    n = F.col(stat("n_words"))
    return (n < MIN_WORDS) | (100 * F.col(stat("n_repeat_words")) > MAX_REPEAT_PERCENT * n)


def logit(share: F.Column) -> F.Column:
    return F.log((share + NEAR_ZERO) / (1 + NEAR_ZERO - share))


def coordinates() -> list[F.Column]:
    """x0 log mean word length, x1 log symbols per word, x2 logit of the repeated
    lines' share, x3 logit of the repeated words' share."""
    n = F.greatest(F.col(stat("n_words")), F.lit(1))
    lines = F.greatest(F.col(stat("n_lines")), F.lit(1))
    raw = (F.log(F.greatest(F.col(stat("word_chars")), F.lit(1)) / n), F.log1p(10 * F.col(stat("n_symbols")) / n),
           logit(F.col(stat("n_dup_lines")) / lines), logit(F.col(stat("n_repeat_words")) / n))
    return [(F.round(x * GRID) / GRID).alias(name) for name, x in zip(X, raw, strict=True)]


def moments(prefix: str = "") -> list[F.Column]:
    x = [F.col(prefix + c) for c in X]
    return ([F.count("*").alias("n")] + [F.sum(x[i]).alias(f"s{i}") for i in range(P)]
            + [F.sum(x[i] * x[j]).alias(f"s{i}{j}") for i in range(P) for j in range(i, P)])


ESTIMATE = ("g string, start int, n long, logdet double, " + ", ".join(f"m{i} double" for i in range(P)) + ", "
            + ", ".join(f"p{i}{j} double" for i in range(P) for j in range(i, P)))


def estimates(scale: float):
    """mapInPandas body: moments -> centre, inverse scatter and log determinant."""
    floor = np.diag(np.array([FLOORS[x] for x in X]) ** 2)

    def run(frames):
        for f in frames:
            n = f["n"].to_numpy(float)
            m = np.stack([f[f"s{i}"].to_numpy(float) for i in range(P)], 1) / n[:, None]
            c = np.empty((len(f), P, P))
            for i in range(P):
                for j in range(i, P):
                    c[:, i, j] = c[:, j, i] = f[f"s{i}{j}"].to_numpy(float) / n - m[:, i] * m[:, j]
            c = scale * c + floor
            inv = np.linalg.inv(c) if len(f) else c
            out = {"g": f["g"], "start": f["start"].astype("int32"), "n": f["n"], "logdet": np.linalg.slogdet(c)[1] if len(f) else n}
            out |= {f"m{i}": m[:, i] for i in range(P)} | {f"p{i}{j}": inv[:, i, j] for i in range(P) for j in range(i, P)}
            yield pd.DataFrame(out)

    return run


def distance() -> F.Column:
    """Squared Mahalanobis distance of x to the joined estimate."""
    d = [F.col(X[i]) - F.col(f"m{i}") for i in range(P)]
    total = F.lit(0.0)
    for i in range(P):
        for j in range(i, P):
            total = total + (1 if i == j else 2) * F.col(f"p{i}{j}") * d[i] * d[j]
    return total


def group_key() -> F.Column:
    """Language and source as one string; a null is told from every text."""
    return F.to_json(F.array(F.col("lang"), F.col("source")))


def small(est: DataFrame) -> DataFrame:
    """Broadcast hint for a table of estimates, behind a check of its size."""
    return F.broadcast(est) if est.limit(MAX_BROADCAST_GROUPS + 1).count() <= MAX_BROADCAST_GROUPS else est


def fit(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Estimates from narrow rows (lang, source, x0..): (key -> g) and one row per g."""
    keyed = rows.select(group_key().alias("key"), *X)
    counts = keyed.groupBy("key").agg(F.count("*").alias("n"))
    groups, _ = store(counts.select("key", F.when(F.col("n") < MIN_ROWS, F.lit("pooled")).otherwise(F.col("key")).alias("g")), "groups")
    data, _ = store(keyed.join(small(groups), "key").select("g", *X), "vectors")

    # starts: (0) medians and quartile ranges, (1) moments of winsorised coordinates
    at = F.array(*[F.lit(q) for q in (0.05, 0.25, 0.5, 0.75, 0.95)])
    quant, _ = store(data.groupBy("g").agg(F.count("*").alias("n"), *[F.percentile(x, at).alias(f"q_{x}") for x in X]), "quantiles")

    def sigma(i):
        return (F.get(f"q_{X[i]}", 3) - F.get(f"q_{X[i]}", 1)) / 1.349

    mid = [F.get(f"q_{x}", 2) for x in X]
    first = quant.select("g", F.lit(0).alias("start"), "n", *[(mid[i] * F.col("n")).alias(f"s{i}") for i in range(P)],
                         *[((mid[i] * mid[j] + (F.pow(sigma(i), 2) if i == j else F.lit(0.0))) * F.col("n")).alias(f"s{i}{j}")
                           for i in range(P) for j in range(i, P)])
    bounded = data.join(small(quant.drop("n")), "g").select(
        "g", *[F.greatest(F.least(F.col(x), F.get(f"q_{x}", 4)), F.get(f"q_{x}", 0)).alias(x) for x in X])
    second = bounded.groupBy("g").agg(*moments()).withColumn("start", F.lit(1))
    est = first.unionByName(second).mapInPandas(estimates(1.0), ESTIMATE)
    # a start's own determinant is not one of a concentrated subset
    est, _ = store(est.withColumn("logdet", F.lit(math.inf)).withColumn("moving", F.lit(True)), "estimate")

    sizes = quant.select("g", F.ceil(F.col("n") * SUPPORT).alias("h"))
    values = [c for c in est.columns if c not in ("g", "start", "moving")]
    while not est.filter("moving").isEmpty():
        bin_ = F.floor(F.log2(F.col("d2") + 1e-6) * BINS)
        moving = est.filter("moving").drop("n", "logdet", "moving")
        near = data.join(small(moving), "g").withColumn("d2", distance()).select("g", "start", *X, bin_.alias("bin"))
        hist = near.groupBy("g", "start", "bin").agg(F.count("*").alias("k"))
        upto = F.sum("k").over(Window.partitionBy("g", "start").orderBy("bin"))
        cut = (hist.withColumn("upto", upto).join(small(sizes), "g").filter(F.col("upto") >= F.col("h"))
               .groupBy("g", "start").agg(F.min("bin").alias("cut")))
        cut, _ = store(cut, "cut")
        inner = near.join(small(cut), ["g", "start"]).filter(F.col("bin") <= F.col("cut"))
        step = inner.groupBy("g", "start").agg(*moments()).mapInPandas(estimates(CONSISTENCY), ESTIMATE)
        step = step.select("g", "start", F.struct(*values).alias("new"))
        better = F.coalesce(F.col("new.logdet") < F.col("logdet") - SETTLED, F.lit(False))
        est, _ = store(est.join(step, ["g", "start"], "left").select(
            "g", "start", *[F.when(better, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in values], better.alias("moving")), "estimate")
    best = est.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("logdet", "start"))).filter("r = 1").drop("r", "n", "logdet", "start", "moving")
    return groups, best


def judge(stats: DataFrame, extra: list[str]) -> DataFrame:
    """Rows with ``__stat_*``, lang and source -> with ``base_failed``, ``distance2`` and
    ``kept``; ``extra`` names the columns to pass on."""
    narrow = stats.select("lang", "source", base_failed().alias("failed"), *coordinates())
    groups, best = fit(narrow.filter("NOT failed").drop("failed"))
    model, _ = store(groups.join(best, "g").select(F.col("key").alias("m_key"), *[c for c in best.columns if c != "g"]), "model")
    rows = stats.select(*extra, group_key().alias("m_group"), base_failed().alias("base_failed"), *coordinates())
    rows = rows.join(small(model), F.col("m_group") == F.col("m_key"), "left")
    # a group all of whose rows failed has no estimate, and no row to judge
    rows = rows.withColumn("distance2", F.when(~F.col("base_failed"), distance()))
    return rows.select(*extra, "base_failed", "distance2", (~F.col("base_failed") & (F.coalesce("distance2", F.lit(0.0)) <= CUTOFF)).alias("kept"))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document: id, the statistics, base_failed, distance2, kept."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"),
                    F.col(source_col).cast("string").alias("source"))
    stats, _ = store(with_stats(d).drop("text"), "stats")
    names = [stat(s) for s in STATS]
    return judge(stats, ["id", *names]).withColumnsRenamed(dict(zip(names, STATS, strict=True)))


def keep_clean(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns.  Estimates are fitted on
    narrow rows and broadcast back, so no text is shuffled; the statistics are
    computed in both passes over the text instead."""
    cols = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row")
    d = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"),
                    F.col(source_col).cast("string").alias("source"))
    stats, _ = store(with_stats(d).drop("text"), "stats")
    narrow = stats.select("lang", "source", base_failed().alias("failed"), *coordinates())
    groups, best = fit(narrow.filter("NOT failed").drop("failed"))
    model, _ = store(groups.join(best, "g").select(F.col("key").alias("m_key"), *[c for c in best.columns if c != "g"]), "model")
    again = with_stats(docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"),
                                   F.col(source_col).cast("string").alias("source"), whole))
    rows = again.filter(~base_failed()).select("__row", group_key().alias("m_group"), *coordinates())
    rows = rows.join(small(model), F.col("m_group") == F.col("m_key"), "left").filter(F.coalesce(distance(), F.lit(0.0)) <= CUTOFF)
    return rows.select("__row.*")
