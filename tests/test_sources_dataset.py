import json
import os

from pyspark.sql import functions as F

from vachan.plans import dataset as DS
from vachan.sources import files as FS
from vachan.sources import transcripts as TS
from vachan.streaming.incremental import run_incremental, utterance_scores


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_transcript_schemas(spark, tmpdir_path):
    docs = {
        1: {"words": [{"word": "क", "start": 0, "end": 1}, {"text": "ख", "start_time": "1.5", "end_time": 2}]},
        2: {"segments": [{"words": [{"word": "ग", "start": 2, "end": 3}]}, {"other": 1},
                         {"words": [{"text": "घ", "start_time": 9, "end": 4}]}]},
        3: {"transcript": "पूरा पाठ"},
        4: {"text": "x", "duration": 12},
        5: {"nothing": True},
        6: {"words": [{"word": None, "start": 0, "end": 1}]},
    }
    for k, d in docs.items():
        write(f"{tmpdir_path}/transc/{k}.json", json.dumps(d, ensure_ascii=False))
    write(f"{tmpdir_path}/transc/7.json", "not json")
    rows = {r["recording_id"]: r for r in TS.read_transcripts(spark, f"{tmpdir_path}/transc/*.json").collect()}
    assert [tuple(w) for w in rows[1]["words"]] == [("क", 0.0, 1.0), ("ख", 1.5, 2.0)]
    # start_time is not accepted inside segments
    assert [tuple(w) for w in rows[2]["words"]] == [("ग", 2.0, 3.0), ("घ", 0.0, 4.0)]
    assert [tuple(w) for w in rows[3]["words"]] == [("पूरा पाठ", 0.0, 30.0)]
    assert [tuple(w) for w in rows[4]["words"]] == [("x", 0.0, 12.0)]
    assert rows[5]["words"] == [] and rows[5]["reject_reason"] is None
    assert rows[6]["reject_reason"] == "null word text or time"
    assert rows[7]["reject_reason"] == "not json"


def test_manifest_results_csv_roundtrip(spark, tmpdir_path):
    write(f"{tmpdir_path}/m.csv", "recording_id,user_id,rec_url_gcp,duration,extra\n"
          "11,7,https://h/x/hq/hi/123/11_audio.wav,40.5,a\n12,8,https://h/bad,3,b\n")
    m = FS.read_manifest(spark, f"{tmpdir_path}/m.csv")
    assert m.columns == ["recording_id", "user_id", "rec_url_gcp", "duration", "reject_reason"]
    assert m.agg(F.sum("duration")).first()[0] == 43.5
    df = spark.createDataFrame([(1, "a, \"b\"", "a b", 50.0)], "idx int, reference string, hypothesis string, wer double")
    FS.write_csv(df, f"{tmpdir_path}/res")
    back = FS.read_results(spark, f"{tmpdir_path}/res")
    assert tuple(back.first()) == (1, "a, \"b\"", "a b", 50.0)


def test_split_dataset_roundtrip(spark, tmpdir_path):
    ex = spark.createDataFrame([(i % 9, f"s{i}") for i in range(40)], "user_id long, sentence string")
    out, counts = DS.assemble(ex)
    FS.write_split_dataset(out, f"{tmpdir_path}/ds")
    val = FS.read_split(spark, f"{tmpdir_path}/ds", "validation")
    assert val.count() == counts.where("split = 'validation'").first()["n_rows"]


def test_build_examples(spark):
    manifest = spark.createDataFrame(
        [(1, 7, "https://h/c/hq/hi/55/1_audio.wav", 3.0), (2, 8, "https://h/c/hq/hi/55/2_audio.wav", 3.0),
         (3, 9, "no-ids-here", 1.0), (4, 9, "https://h/c/hq/hi/55/4_audio.wav", 1.0)],
        "recording_id long, user_id long, rec_url_gcp string, duration double")
    sr = 16000
    wave = [float((i % 100) - 50) for i in range(3 * sr)]
    waves = spark.createDataFrame([(1, sr, [wave, wave]), (2, 8000, [wave]), (3, sr, [wave])], FS.WAVE_SCHEMA)
    words = [("क", 0.0, 1.0), ("ख", 1.0, 2.5), ("ग", 2.5, 2.9)]
    trans = spark.createDataFrame([(1, words, None), (2, words, None), (4, words, None)],
                                  "recording_id long, words array<struct<word:string,start:double,end:double>>, "
                                  "reject_reason string")
    ex, rej = DS.build_examples(manifest, waves, trans, max_chunk_sec=2.0, min_chunk_sec=0.5)
    rows = ex.orderBy("chunk_id").collect()
    assert [(r["chunk_start"], r["chunk_end"], r["sentence"]) for r in rows] == [(0.0, 1.0, "क"), (1.0, 2.9, "ख ग")]
    assert len(rows[0]["audio"]["array"]) == sr and len(rows[1]["audio"]["array"]) == int(2.9 * sr) - sr
    assert max(abs(x) for x in rows[0]["audio"]["array"]) == 1.0
    reasons = {r["recording_id"]: r["reject_reason"] for r in rej.collect()}
    assert reasons == {2: "sampling rate is not 16 kHz", 3: "unparsable url", 4: "missing audio"}


def test_streaming_equals_batch(spark, tmpdir_path):
    rows = [(i, f"मुझे करन है {i}", f"मुझे करना है {i % 3}") for i in range(30)]
    src = f"{tmpdir_path}/in"
    schema = "idx int, reference string, hypothesis string"
    spark.createDataFrame(rows[:15], schema).write.parquet(f"{src}/part1")
    run_incremental(spark, f"{src}/*", schema, utterance_scores, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt")
    spark.createDataFrame(rows[15:], schema).write.parquet(f"{src}/part2")
    run_incremental(spark, f"{src}/*", schema, utterance_scores, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt")
    streamed = sorted(tuple(r) for r in spark.read.parquet(f"{tmpdir_path}/out").collect())
    batch = sorted(tuple(r) for r in utterance_scores(spark.createDataFrame(rows, schema)).collect())
    assert streamed == batch and len(streamed) == 30


def test_stream_deals_rows_of_a_single_file(spark, tmpdir_path):
    """One small file a trigger: its rows are worked on by all cores, not by the task that reads it."""
    from pyspark.sql import functions as F

    spark.range(0, 400, 1, 1).write.parquet(f"{tmpdir_path}/in")
    run_incremental(spark, f"{tmpdir_path}/in", "id long", lambda d: d.withColumn("task", F.spark_partition_id()), f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", max_files_per_trigger=2)
    rows = spark.read.parquet(f"{tmpdir_path}/out").collect()
    assert sorted(r["id"] for r in rows) == list(range(400))
    assert len({r["task"] for r in rows}) == spark.sparkContext.defaultParallelism > 1


def test_files_below_a_folder_by_name(spark, tmpdir_path):
    """Scanned by folder, whatever its depth; other names and empty folders give nothing."""
    for path in ("a/recording_id=1/x.txt", "a/b/recording_id=2/y.txt", "a/recording_id=3/x.json", "a/_SUCCESS"):
        write(f"{tmpdir_path}/{path}", '{"transcript":"one\ntwo"}')
    os.makedirs(f"{tmpdir_path}/none")
    by = r"recording_id=([0-9]+)/"
    assert sorted((r["recording_id"], r["length"]) for r in FS.read_assets(spark, f"{tmpdir_path}/a", by, "*.txt").collect()) == [(1, 24), (2, 24)]
    assert sorted(r["recording_id"] for r in TS.read_transcripts(spark, f"{tmpdir_path}/a", by, "*.txt").collect()) == [1, 2]
    assert FS.read_assets(spark, f"{tmpdir_path}/none", by, "*.txt").count() == TS.read_transcripts(spark, f"{tmpdir_path}/none", by, "*.txt").count() == 0


def test_systems_sheet_by_position(spark, tmpdir_path):
    from vachan.operators import lattice as LT

    header = "link,reference,A,B,C,D,E,F\n"
    rows = ["https://h/x/ch_1.wav,a b c,a b c,a x c,a b c,,a b c d,a b c\n",
            "https://h/x/ch_2.wav,,p q,p q,p q,p q,p q,p q\n"]
    write(f"{tmpdir_path}/sheet.csv", header + "".join(rows))
    sheet = FS.read_systems_sheet(spark, f"{tmpdir_path}/sheet.csv")
    assert sheet.columns[:3] == ["url", "Human", "Model H"]
    long = FS.systems_long(sheet)
    empty = {r["system"]: r["hyp"] for r in long.collect() if r["url"].endswith("ch_1.wav")}
    assert empty["Model l"] == []  # an empty cell is the empty string
    detail = {r["system"]: r for r in LT.evaluate(long).collect()}
    # the segment with an empty reference is dropped; six systems remain
    assert len(detail) == 6 and detail["Model i"]["edits"] == 1 and detail["Model l"]["edits"] == 3


def test_read_assets_pairs_ids(spark, tmpdir_path):
    for rid in (11, 12):
        write(f"{tmpdir_path}/audio/{rid}.wav", "RIFF")
    write(f"{tmpdir_path}/transc/11.json", "{}")
    audio = FS.read_assets(spark, f"{tmpdir_path}/audio/*.wav")
    trans = FS.read_assets(spark, f"{tmpdir_path}/transc/*.json")
    paired = audio.join(trans.withColumnRenamed("path", "t_path").drop("length"), "recording_id", "left")
    got = {r["recording_id"]: r["t_path"] is not None for r in paired.collect()}
    assert got == {11: True, 12: False}


def test_error_paths(spark, tmpdir_path):
    import pytest

    from vachan.operators import manifest as MF

    write(f"{tmpdir_path}/bad.csv", "idx,text\n1,a\n")
    with pytest.raises(ValueError):
        FS.read_results(spark, f"{tmpdir_path}/bad.csv")
    m = spark.createDataFrame([(1, "no-ids")], "recording_id long, rec_url_gcp string")
    assert MF.rewrite_urls(m).first()["reject_reason"] == "unparsable url"
    with pytest.raises(Exception):
        MF.rewrite_urls(m, strict=True).collect()


def test_csv_dialect_of_python(spark, tmpdir_path):
    import csv
    import glob

    rows = [(1, 'he said "hi", ok', 'x "y", z', 1.0), (2, "plain", "a, b", 2.5), (3, 'ends with "', "back\\slash", 0.0), (4, "two\nlines", "ok", 3.0)]
    path = f"{tmpdir_path}/py/results.csv"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([("idx", "reference", "hypothesis", "wer"), *rows])
    assert sorted(tuple(r) for r in FS.read_results(spark, path, multi_line=True).collect()) == rows
    # and back: what Spark writes, Python's csv reads
    df = spark.createDataFrame(rows[:3], "idx int, reference string, hypothesis string, wer double").coalesce(1)
    FS.write_csv(df, f"{tmpdir_path}/sp")
    with open(glob.glob(f"{tmpdir_path}/sp/part-*.csv")[0], newline="", encoding="utf-8") as f:
        back = list(csv.reader(f))
    assert back[0] == ["idx", "reference", "hypothesis", "wer"]
    assert [(int(a), b, c, float(d)) for a, b, c, d in back[1:]] == rows[:3]


def test_quoted_cells_keep_their_column(spark, tmpdir_path):
    import csv

    path = f"{tmpdir_path}/sheet/s.csv"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([["link", "reference", *"ABCDEF"], ["u", 'a "b", c', *[f'm{i} "q", r' for i in range(6)]]])
    r = FS.read_systems_sheet(spark, path).first()
    assert r["Human"] == 'a "b", c' and r["Model n"] == 'm5 "q", r'


def test_bad_manifest_values_have_a_reason(spark, tmpdir_path):
    write(f"{tmpdir_path}/bad/m.csv", "recording_id,user_id,rec_url_gcp,duration\n11,7,u,4.5\nx,7,u,long\n,8,u,1\n")
    rows = {r["duration"]: r["reject_reason"] for r in FS.read_manifest(spark, f"{tmpdir_path}/bad/m.csv").collect()}
    assert rows == {4.5: None, None: "bad recording_id, duration", 1.0: "bad recording_id"}


def test_words_and_segments_must_be_objects(spark):
    docs = ['{"words":["a","b"]}', '{"segments":["x"]}', '{"segments":[{"words":["x"]}]}', '{"segments":[{"words":5}]}', '{"words":5}', "[1]", "5", '{"words":[]}', '{"segments":[{}]}']
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, raw string").select("i", TS.parse_transcript("raw").alias("t")).orderBy("i").collect()
    assert [r["t"]["reject_reason"] for r in rows] == ["malformed word list"] * 5 + ["not an object"] * 2 + [None, None]
    assert rows[7]["t"]["words"] == [] and rows[8]["t"]["words"] == []


def test_dataset_split_needs_no_audio(spark):
    manifest = spark.createDataFrame([(i, i % 5, f"https://h/c/hq/hi/55/{i}_audio.wav", 1.0) for i in range(20)],
                                     "recording_id long, user_id long, rec_url_gcp string, duration double")
    waves = spark.createDataFrame([(i, 16000, [[0.5] * (16000 if i % 4 else 100)]) for i in range(20)], FS.WAVE_SCHEMA)
    trans = spark.createDataFrame([(i, [("क", 0.0, 0.9)], None) for i in range(20)],
                                  "recording_id long, words array<struct<word:string,start:double,end:double>>, reject_reason string")
    out, counts, rejects = DS.build_dataset(manifest, waves, trans)
    rows = out.collect()
    assert sorted(r["recording_id"] for r in rows) == [i for i in range(20) if i % 4] and rejects.count() == 0
    want = {}
    for r in rows:
        want.setdefault(r["split"], []).append(r["user_id"])
    assert {r["split"]: (r["n_rows"], r["n_users"]) for r in counts.collect()} == {k: (len(v), len(set(v))) for k, v in want.items()}
    assert "channels" not in counts._jdf.queryExecution().optimizedPlan().toString()


def test_sql_name_of_the_canonicaliser(spark):
    from vachan.functions import text as TX
    from vachan.plans import derived as D

    TX.register_normalise(spark, "normalise_t")
    df = spark.createDataFrame([(" ".join(x[0] for x in D.FORMS),), ("plain $1 \\ text",), (None,)], "x string")
    for r in df.select(F.expr("normalise_t(x)").alias("a"), TX.canonicalise("x").alias("b")).collect():
        assert r["a"] == r["b"]


def test_eval_set_and_waves(spark, tmpdir_path):
    import csv

    path = f"{tmpdir_path}/eval/e.csv"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([("idx", "reference", "hypothesis", "more"), (1, 'a "b", c', "d", 2)])
    assert [tuple(r) for r in FS.read_eval_set(spark, path, "csv").collect()] == [(1, 'a "b", c', "d")]
    spark.createDataFrame([(1, 16000, [[0.5, 1.0]])], FS.WAVE_SCHEMA).write.parquet(f"{tmpdir_path}/waves")
    assert [tuple(r) for r in FS.read_waves(spark, f"{tmpdir_path}/waves").collect()] == [(1, 16000, [[0.5, 1.0]])]


def test_asset_paths_and_chunk_counts(spark):
    from vachan.operators import chunking as CH
    from vachan.operators import manifest as MF

    df = spark.createDataFrame([(7, 0), (7, 1), (8, 0)], "recording_id long, chunk_id int")
    assert {r["recording_id"]: r["n_chunks"] for r in CH.chunks_per_recording(df).collect()} == {7: 2, 8: 1}
    r = MF.asset_paths(df.limit(1), root="cache").first()
    assert (r["audio_path"], r["transcript_path"]) == ("cache/audio/7.wav", "cache/transc/7.json")
