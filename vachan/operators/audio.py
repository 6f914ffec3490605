"""Sample-array conditioning and slicing.

Input contract: 16 kHz float sample arrays per channel (decoding and
resampling are out of scope; other rates are rejected).  All work is
higher-order functions over array columns: no Python, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TARGET_SR = 16_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` as a lambda
    variable (an outer expression used inside a lambda would be evaluated
    again for every element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def downmix(channels) -> Column:
    """Mean over channels per sample (a single channel passes through)."""
    def mix(ch):
        n = F.size(F.element_at(ch, 1))
        mixed = F.transform(F.sequence(F.lit(0), n - 1),
                            lambda i: F.aggregate(ch, F.lit(0.0), lambda acc, c: acc + c[i]) / F.size(ch))
        return (F.when(F.size(ch) == 1, F.transform(F.element_at(ch, 1), lambda x: x.cast("double")))
                 .when(n > 0, mixed).otherwise(F.array().cast("array<double>")))
    return let(_col(channels), mix)


def peak_normalise(samples) -> Column:
    """Divide by the largest absolute sample when it is positive."""
    def norm(x):
        return let(F.array_max(F.transform(x, lambda v: F.abs(v))),
                   lambda peak: F.when(peak > 0, F.transform(x, lambda v: v / peak)).otherwise(x))
    return let(_col(samples), norm)


def condition(channels) -> Column:
    """Mono downmix then peak normalisation."""
    return peak_normalise(downmix(channels))


def slice_length(start_sec, end_sec, n_samples, rate: int = TARGET_SR) -> Column:
    """Number of samples that ``slice_seconds`` gives, without the samples."""
    s, e = ((_col(t) * rate).cast("int") for t in (start_sec, end_sec))
    return F.when(s >= n_samples, F.lit(0)).otherwise(F.greatest(F.lit(0), F.least(e, n_samples) - s))


def slice_seconds(samples, start_sec, end_sec, rate: int = TARGET_SR) -> Column:
    """``samples[int(start*rate):int(end*rate)]`` (truncation toward
    zero, end clamped to the length)."""
    s = (_col(start_sec) * rate).cast("int")
    e = (_col(end_sec) * rate).cast("int")

    def cut(x):
        length = F.greatest(F.lit(0), F.least(e, F.size(x)) - s)
        return F.when(s >= F.size(x), F.array().cast("array<double>")).otherwise(F.slice(x, s + 1, length))
    return let(_col(samples), cut)


def keep_min_samples(df: DataFrame, samples: str, min_sec: float, rate: int = TARGET_SR) -> DataFrame:
    """P5: keep slices with at least ``int(min_sec*rate)`` samples."""
    return df.where(F.size(samples) >= int(min_sec * rate))
