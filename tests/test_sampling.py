import math

from pyspark.sql import functions as F

from vachan.operators import sampling as SM


def test_tier_edges(spark):
    vals = [-1.0, 0.0, 0.01, 15.0, 15.01, 50.0, 50.01, float("nan"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, wer double")
    got = [r["t"] for r in df.orderBy("i").select(SM.wer_tier("wer").alias("t")).collect()]
    assert got == ["correct", "correct", "low", "low", "medium", "medium", "high", "high", None]


def test_interval_sample_sizes(spark):
    rows = []
    sizes = {"a": 0, "b": 3, "c": 10, "d": 19, "e": 25}
    for g, n in sizes.items():
        rows += [(g, g + f"{i:03d}", i) for i in range(n)]
    rows.append(("z", "z000", 0))  # keep the DataFrame non-empty for group "a"
    df = spark.createDataFrame(rows, "tier string, key string, pos int")
    s = SM.interval_sample(df, 10, ["key"]).collect()
    by = {}
    for r in s:
        by.setdefault(r["tier"], []).append(r["pos"])
    assert len(by.get("b", [])) == 3 and len(by["c"]) == 10 and len(by["d"]) == 10 and len(by["e"]) == 10
    assert sorted(by["e"]) == list(range(0, 20, 2))
    assert sorted(by["d"]) == list(range(10))


def test_group_index_spans_partitions(spark):
    # one hot group spread over many range partitions still numbers 0..n-1
    df = spark.range(5000).select(F.lit("hot").alias("g"), (F.col("id") * 7 % 5000).alias("k"))
    idx = SM.with_group_index(df, ["g"], ["k"], "i", "c", partitions=16)
    rows = idx.select("k", "i", "c").collect()
    assert all(r["i"] == r["k"] for r in rows) and all(r["c"] == 5000 for r in rows)


def test_sample_errors_columns_and_ids(spark):
    rows = [(i, f"r{i}", f"h{i}", float(i % 70)) for i in range(200)]
    df = spark.createDataFrame(rows, "idx int, reference string, hypothesis string, wer double")
    out = SM.sample_errors(df, 10).collect()
    assert [r["sample_id"] for r in out] == list(range(1, len(out) + 1))
    assert [r["idx"] for r in out] == sorted(r["idx"] for r in out)
    assert {r["tier"] for r in out} <= {"low", "medium", "high"}
    assert all(r["severity_rank"] == SM.SEVERITY[r["tier"]] for r in out)


def test_speaker_split_disjoint(spark):
    df = spark.createDataFrame([(u % 37, i) for i, u in enumerate(range(500))], "user_id int, row int")
    split = SM.speaker_split(df)
    counts = {r["split"]: r["n"] for r in split.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert counts["validation"] == math.ceil(0.1 * 37) and counts["train"] == 37 - math.ceil(0.1 * 37)
    joined = SM.assign_split(df, split)
    per_user = joined.groupBy("user_id").agg(F.countDistinct("split").alias("k")).collect()
    assert all(r["k"] == 1 for r in per_user)


def test_group_index_many_groups(spark):
    df = spark.range(600).select((F.col("id") % 7).alias("g"), F.col("id").alias("k"))
    rows = SM.with_group_index(df, ["g"], ["k"], "i", "c", partitions=8).collect()
    for r in rows:
        assert r["i"] == r["k"] // 7 and r["c"] == len(range(r["g"], 600, 7))


def test_unscored_rows_are_rejects_not_errors(spark):
    from vachan.operators import scoring as SC

    df = spark.createDataFrame([(1, "", "x y"), (2, None, "x"), (3, "a b", "a c"), (4, " ", "")], "idx int, reference string, hypothesis string")
    scored = SC.with_utterance_wer(df)
    assert [r["idx"] for r in SM.sample_errors(scored, 10).collect()] == [3]
    assert [tuple(r) for r in SM.tier_report(scored, 10).collect()] == [("medium", 1, 1, 1)]
    assert {r["idx"]: r["reject_reason"] for r in SC.score_rejects(scored).collect()} == dict.fromkeys((1, 2, 4), "empty reference")
