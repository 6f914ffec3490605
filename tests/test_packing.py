import random

import pytest

from vachan.operators import chunking as CH
from vachan.operators import packing as PK


def test_distributed_packing_matches_fold(spark):
    rnd = random.Random(5)
    rows = []
    for rec in range(6):
        t = 0.0
        n = rnd.choice([1, 5, 40, 400])
        for i in range(n):
            gap = rnd.choice([0.0, 0.2, 1.0, 3.0, 12.0])
            dur = rnd.choice([0.1, 0.5, 2.0, 9.0, 35.0])
            word = rnd.choice(["क", "ख", "  ", "ग"])
            rows.append((rec, i, word, t + gap, t + gap + dur))
            t = t + gap + rnd.choice([0.0, dur])
    df = spark.createDataFrame(rows, "rec long, i long, word string, start double, end double")
    words = CH.words_from_rows(df, ["rec"], ["i"])
    want = sorted(tuple(r) for r in CH.chunk_recordings(words, "words", ("rec",), 10.0, 0.5).collect())
    got = sorted(tuple(r) for r in PK.pack_rows(df, "rec", ["i"], 10.0, 0.5, partitions=13).collect())
    assert got == want and len(want) > 20


def test_hot_recording_uniform_spacing(spark):
    # one recording over many partitions; evenly spaced words never let two
    # greedy chains meet, so every piece's entry state must be exact
    rows = [(1, i, "क", i * 1.0, i * 1.0 + 0.8) for i in range(3000)] + \
           [(2, i, "ख", i * 0.5, i * 0.5 + 0.4) for i in range(50)]
    df = spark.createDataFrame(rows, "rec long, i long, word string, start double, end double")
    words = CH.words_from_rows(df, ["rec"], ["i"])
    want = sorted(tuple(r) for r in CH.chunk_recordings(words, "words", ("rec",), 29.0, 0.5).collect())
    got = sorted(tuple(r) for r in PK.pack_rows(df, "rec", ["i"], 29.0, 0.5, partitions=16).collect())
    assert len(want) == 104 + 1  # 29-word chunks, then the short recording
    assert got == want


@pytest.mark.parametrize("partitions", [1, 4, 16, 64])
def test_decimal_grid_for_every_partition_count(spark, monkeypatch, partitions):
    # times on a 0.01 s grid: end - start > 29 and end > start + 29 differ on many of them
    monkeypatch.setattr(PK, "FAN_IN", 3)
    rows = [(f"r{k}", i, "क", (2.01 if k == 0 else 7.37) + i, (2.01 if k == 0 else 7.37) + i + 1.0) for k, n in ((0, 3000), (1, 700)) for i in range(n)]
    df = spark.createDataFrame(rows, "rec string, i long, word string, start double, end double")
    words = CH.words_from_rows(df, ["rec"], ["i"])
    want = sorted(tuple(r) for r in CH.chunk_recordings(words, "words", ("rec",), 29.0, 0.5).collect())
    got = sorted(tuple(r) for r in PK.pack_rows(df, "rec", ["i"], 29.0, 0.5, partitions=partitions).collect())
    assert got == want


def test_pieces_shorter_than_a_chunk(spark, monkeypatch):
    # dense words: a chunk spans many pieces, and entry states pass through the tree
    monkeypatch.setattr(PK, "FAN_IN", 2)
    rnd = random.Random(8)
    rows, t = [], 0.0
    for i in range(2500):
        t += rnd.choice([0.01, 0.03, 0.5])
        rows.append((7, i, "क", round(t, 2), round(t + rnd.choice([0.1, 3.0, 40.0]), 2)))
    df = spark.createDataFrame(rows, "rec long, i long, word string, start double, end double")
    words = CH.words_from_rows(df, ["rec"], ["i"])
    want = sorted(tuple(r) for r in CH.chunk_recordings(words, "words", ("rec",), 90.0, 0.5).collect())
    got = sorted(tuple(r) for r in PK.pack_rows(df, "rec", ["i"], 90.0, 0.5, partitions=24).collect())
    assert got == want


def test_composed_summaries_equal_walking():
    rnd = random.Random(4)
    for _ in range(200):
        n, times, t = rnd.randrange(4, 30), [], 0.0
        for _ in range(n):
            t += rnd.choice([0.0, 0.01, 0.37, 2.01])
            times.append((t, t + rnd.choice([0.0, 0.5, 1.0, 6.5])))
        first = rnd.randrange(1, n - 1)
        cuts = sorted({first, *(rnd.randrange(first, n) for _ in range(3)), n})
        before = max(s for s, _ in times[:first])
        import numpy as np

        parts = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            s, e = (np.array([x[k] for x in times[a:b]]) for k in (0, 1))
            parts.append(PK.piece_summary(s, e, [(0, i, times[i][0]) for i in range(a, b)], max(s for s, _ in times[:a]), 3.0))
        whole = PK.compose(parts, before, 3.0)
        for s0 in [x for x, _ in times[:first]]:
            state = (9, 9, s0)
            for i in range(first, n):
                if times[i][1] - state[2] > 3.0:
                    state = (0, i, times[i][0])
            assert PK.advance((9, 9, s0), whole, 3.0) == state
