import random

from pyspark.sql import functions as F

from vachan.operators import scoring as SC


def brute_distance(a, b):
    prev = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        cur = [i] + [0] * len(b)
        for j in range(1, len(b) + 1):
            cur[j] = min(prev[j - 1] + (a[i - 1] != b[j - 1]), prev[j] + 1, cur[j - 1] + 1)
        prev = cur
    return prev[-1]


def test_edit_distance_matches_brute_force(spark):
    rnd = random.Random(7)
    vocab = ["a", "b", "c", "dé", "ज़", "x y", ""]
    rows = []
    for _ in range(200):
        r = [rnd.choice(vocab) for _ in range(rnd.randint(0, 12))]
        h = [rnd.choice(vocab) for _ in range(rnd.randint(0, 12))]
        rows.append((r, h))
    df = spark.createDataFrame(rows, "r array<string>, h array<string>")
    got = SC.with_edit_distance(df, "r", "h").collect()
    for row in got:
        assert row["edits"] == brute_distance(row["r"], row["h"])


def test_many_distinct_words(spark):
    # far more distinct words than any single-byte or BMP-sized alphabet
    r = [f"w{i}" for i in range(3000)]
    h = [f"w{i}" for i in range(1, 3000)] + ["new"]
    df = spark.createDataFrame([(r, h)], "r array<string>, h array<string>")
    assert SC.with_edit_distance(df, "r", "h").first()["edits"] == 2


def test_plain_wer_empty_reference(spark):
    df = spark.createDataFrame([([], ["a", "b"]), (["a", "b", "c"], ["a", "c"])], "ref array<string>, hyp array<string>")
    rows = SC.with_plain_wer(df, "ref", "hyp").collect()
    assert (rows[0]["wer"], rows[0]["edits"], rows[0]["n"]) == (0.0, 2, 0)
    assert (rows[1]["wer"], rows[1]["edits"], rows[1]["n"]) == (0.3333, 1, 3)


def test_report_segment_wer_shapes(spark):
    # 2 of 6 words wrong -> 0.3333; 3 of 7 -> 0.4286 (shape of the published segment rows)
    df = spark.createDataFrame([("a b c d e f".split(), "a B c D e f".split()),
                                ("a b c d e f g".split(), "a b X Y Z f g".split())],
                               "ref array<string>, hyp array<string>")
    assert [r["wer"] for r in SC.with_plain_wer(df, "ref", "hyp").collect()] == [0.3333, 0.4286]


def test_utterance_wer_and_reject(spark):
    df = spark.createDataFrame([(1, "a b  c", "a x c"), (2, "   ", "a"), (3, "a\tb c", "a b c")],
                               "idx int, reference string, hypothesis string")
    rows = {r["idx"]: r for r in SC.with_utterance_wer(df).collect()}
    assert rows[1]["wer"] == 33.33
    assert rows[2]["wer"] is None and rows[2]["wer_reject"] == "empty reference"
    # a lone tab does not split words
    assert rows[3]["wer"] == 100.0


def test_before_after(spark):
    df = spark.createDataFrame([(1, "मुझे करना है", "मुझे करन है"), (2, "१ २", "1 2")],
                               "idx int, reference string, hypothesis string")
    out = {r["idx"]: r for r in SC.with_before_after(df).collect()}
    assert out[2]["wer_before_norm"] == 100.0 and out[2]["wer_after_norm"] == 0.0 and out[2]["wer_delta"] == 100.0
    # coded mode turns करना into करनाा on the reference side, so after > 0
    assert out[1]["wer_before_norm"] == 33.33
    summ = SC.before_after_summary(SC.with_before_after(df)).first()
    assert round(summ["avg_wer_before"], 3) == round((33.33 + 100.0) / 2, 3)
    assert F is not None
