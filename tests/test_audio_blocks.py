"""Block-wise audio against numpy on whole recordings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vachan.operators import audio_blocks as AB


def recordings(seed=3):
    rnd = np.random.default_rng(seed)
    out = {i: rnd.normal(size=(1 + i % 3, n)).astype(np.float32) for i, n in enumerate([0, 1, 9, 10, 11, 99, 100, 257])}
    out[20] = np.zeros((2, 31), np.float32)
    out[21] = np.array([[0.5, np.nan, 2.0] * 11], np.float32)
    return out


def conditioned(x):
    m = x[0] if len(x) == 1 else np.add.reduce(x, axis=0, dtype=np.float32) / np.float32(len(x))
    peak = np.max(np.abs(m)) if len(m) else np.float32(0)
    return m / peak if peak > 0 else m


def frame(spark, recs):
    rows = [(i, 16000, [c.tolist() for c in x]) for i, x in recs.items()]
    return spark.createDataFrame(rows, "recording_id long, sampling_rate int, channels array<array<float>>").repartition(3)


@pytest.mark.parametrize("size", [1, 7, 10, 1000])
def test_blocks_give_whole_recordings(spark, size):
    recs = recordings()
    mono = AB.mono(AB.to_blocks(frame(spark, recs), size))
    assert mono.agg(F.max("n")).first()[0] <= size
    heads = AB.headers(mono)
    for r in heads.collect():
        x = recs[r.recording_id]
        assert r.n_samples == x.shape[1] and r.blocks == max(1, -(-x.shape[1] // size))
    got = {}
    for r in sorted(AB.condition(mono, heads).collect()):
        got.setdefault(r.recording_id, []).extend(r.samples)
    for i, x in recs.items():
        assert np.array_equal(np.array(got[i], np.float32), conditioned(x), equal_nan=True), i


@pytest.mark.parametrize("size", [3, 10, 64])
def test_chunks_are_cut_across_blocks(spark, monkeypatch, size):
    monkeypatch.setattr(AB, "SPAN", 2)
    recs, rnd = recordings(), np.random.default_rng(1)
    mono = AB.mono(AB.to_blocks(frame(spark, recs), size))
    asked = [(i, k, float(a), float(a + n)) for i in recs for k, (a, n) in enumerate(zip(rnd.integers(0, 260, 6), rnd.integers(0, 120, 6), strict=True))]
    c = spark.createDataFrame(asked, "recording_id long, chunk_id int, a double, z double").join(AB.headers(mono), "recording_id")
    first, end = AB.sample_range(F.col("a") / 16000, F.col("z") / 16000, F.col("n_samples"))
    got = {(r.recording_id, r.chunk_id): r for r in AB.cut(mono, c.select("recording_id", "chunk_id", first.alias("first"), end.alias("end"), "peak", F.struct("a", "z").alias("rest")), size).collect()}
    for i, k, a, z in asked:
        want = conditioned(recs[i])[int(a / 16000 * 16000):int(z / 16000 * 16000)]
        if len(want):
            r = got.pop((i, k))
            assert np.array_equal(np.array(r.array, np.float32), want, equal_nan=True) and (r.rest.a, r.rest.z) == (a, z)
    assert not got


def test_no_row_holds_a_recording(spark):
    rows = [(1, 16000, [[0.5] * 100_000, [0.25] * 100_000])]
    w = spark.createDataFrame(rows, "recording_id long, sampling_rate int, channels array<array<float>>")
    mono = AB.mono(AB.to_blocks(w))
    assert mono.agg(F.max(F.size("samples"))).first()[0] == AB.BLOCK and mono.count() == 7
    plan = AB.headers(mono)._jdf.queryExecution().executedPlan().toString()
    assert "peak:float>" in plan.split("ReadSchema")[1]  # headers read narrow columns only


def test_odd_recordings(spark):
    rows = [(1, 16000, [[1.0, 2.0], [3.0]]), (2, 16000, None), (3, 16000, []), (4, 16000, [None]), (5, 8000, [[None, -4.0]]), (6, 16000, [[1.0], [2.0] * 9])]
    w = spark.createDataFrame(rows, "recording_id long, sampling_rate int, channels array<array<float>>")
    heads = {r.recording_id: r for r in AB.headers(AB.mono(AB.to_blocks(w, 4))).collect()}
    assert sorted(heads) == [1, 3, 4, 5, 6]
    assert [heads[i].n_samples for i in (1, 3, 4, 5, 6)] == [None, 0, 0, 2, None]
