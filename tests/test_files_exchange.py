"""Sheet row numbers, CSV exchange, assets in pairs, reject counters, shipping."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from vachan.plans import dataset as DS
from vachan.sources import files as FS
from vachan.sources import transcripts as TS


def sheet(folder, sizes):
    os.makedirs(folder)
    k = 0
    for f, n in enumerate(sizes):
        with open(f"{folder}/part-{f:03}.csv", "w", encoding="utf-8") as out:
            out.write("link,reference,A,B,C,D,E,F\n")
            for _ in range(n):
                out.write(f"https://h/{k}_audio.wav,word{k}," + ",".join(["x" * (k % 50)] * 6) + "\n")
                k += 1
    return k


@pytest.mark.parametrize("split", ["1g", "200b", "1500b"])
def test_row_numbers_do_not_depend_on_splits(spark, tmpdir_path, split):
    n = sheet(f"{tmpdir_path}/sheet", [40, 0, 1, 93, 17])
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = sorted((r["segment_id"], r["Human"]) for r in FS.read_systems_sheet(spark, f"{tmpdir_path}/sheet").collect())
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert got == [(k, f"word{k}") for k in range(n)]


def test_row_numbers_of_parquet_and_of_nothing(spark, tmpdir_path):
    d = spark.range(100, numPartitions=4).select(F.col("id").cast("string").alias("u"), F.col("id").cast("string").alias("t"), *[F.lit("h").alias(f"s{i}") for i in range(6)])
    d.write.parquet(f"{tmpdir_path}/p")
    got = FS.read_systems_sheet(spark, f"{tmpdir_path}/p", "parquet").collect()
    assert sorted((r["segment_id"], int(r["Human"])) for r in got) == [(k, k) for k in range(100)]
    d.limit(0).write.parquet(f"{tmpdir_path}/none")
    assert FS.read_systems_sheet(spark, f"{tmpdir_path}/none", "parquet").count() == 0


def test_results_come_back_as_they_were(spark, tmpdir_path):
    texts = ['say "x", y', "two\nlines", "  spaces at the ends  ", "back\\slash \\\"", "", "'", ",", "\t", "डेढ़", '"']
    rows = [(str(i) if i % 4 else f"n{i}", t, t[::-1], "1.5" if i % 3 else "n/a") for i, t in enumerate(texts)]
    FS.write_csv(spark.createDataFrame(rows, "idx string, reference string, hypothesis string, wer string").coalesce(1), f"{tmpdir_path}/r")
    got = FS.read_results(spark, f"{tmpdir_path}/r", multi_line=True, with_rejects=True).collect()
    assert [r["reference"] or "" for r in got] == texts
    want = ["bad " + ", ".join(([] if i % 4 else ["idx"]) + ([] if i % 3 else ["wer"])) for i in range(len(rows))]
    assert [r["reject_reason"] for r in got] == [w if w != "bad " else None for w in want]
    assert FS.read_results(spark, f"{tmpdir_path}/r", multi_line=True).columns == ["idx", "reference", "hypothesis", "wer"]


def test_pairs_of_assets(spark, tmpdir_path):
    def write(path, text):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)

    doc = '{"words":[{"word":"a","start":0,"end":1},\n\n{"word":"b","start":1,"end":2}]}\n'
    for rid in (1, 2, 4):
        write(f"{tmpdir_path}/audio/{rid}.wav", "RIFF")
    write(f"{tmpdir_path}/audio/noise.wav", "R")
    for rid, text in ((1, doc), (3, doc), (4, "{")):
        write(f"{tmpdir_path}/transc/{rid}.json", text)
    got = FS.pair_assets(FS.read_assets(spark, f"{tmpdir_path}/audio/*.wav"), TS.read_transcripts(spark, f"{tmpdir_path}/transc/*.json")).collect()
    by = {r["recording_id"]: r for r in got}
    assert len(got) == 5 and {k: r["reject_reason"] for k, r in by.items()} == {
        1: None, 2: "missing transcript", 3: "missing audio", 4: "not json", None: "file name without an id"}
    # the whole file is one document, over several lines
    assert [w["word"] for w in by[1]["words"]] == ["a", "b"] and by[1]["length"] == 4


def test_rejects_are_counted_by_the_pass_that_plans(spark):
    from vachan.operators import audio_blocks as AB

    manifest = spark.createDataFrame([(i, 1, f"https://h/c/hq/hi/55/{i}_audio.wav" if i else "x", 1.0) for i in range(8)], "recording_id long, user_id long, rec_url_gcp string, duration double")
    waves = spark.createDataFrame([(i, 8000 if i == 2 else 16000, [[0.5] * 16000, [0.5] * (15000 if i == 3 else 16000)]) for i in range(8) if i != 1], FS.WAVE_SCHEMA)
    trans = spark.createDataFrame([(i, [("क", 0.0, 0.9)], "odd" if i == 5 else None) for i in range(8) if i != 4], "recording_id long, words array<struct<word:string,start:double,end:double>>, reject_reason string")
    counters = Observation("c")
    plan = DS.plan_chunks(manifest, AB.headers(DS.sample_blocks(waves)), trans, counters=counters)
    got = {r["reject_reason"]: r["n"] for r in DS.reject_counts(spark, counters).collect()}
    assert got == {None: 2, "unparsable url": 1, "missing audio": 1, "sampling rate is not 16 kHz": 1, "channels differ in length": 1, "missing transcript": 1, "other": 1}
    assert {r["reject_reason"]: r["count"] for r in plan.groupBy("reject_reason").count().collect()} == {**{k: v for k, v in got.items() if k != "other"}, "odd": 1}


def test_package_is_shipped_where_workers_lack_it(spark, monkeypatch):
    from vachan import session

    root = os.path.dirname(os.path.dirname(os.path.abspath(session.__file__)))
    monkeypatch.setenv("PYTHONPATH", root)
    assert session.workers_find_package()
    monkeypatch.setenv("PYTHONPATH", "/nowhere")
    assert not session.workers_find_package()
    monkeypatch.setattr(spark.sparkContext, "_vachan_shipped", False, raising=False)
    session.ship_package(spark)
    assert spark.sparkContext._vachan_shipped and any("vachan.zip" in f for f in spark.sparkContext.listFiles)


def test_workers_import_the_package_from_any_folder(tmpdir_path):
    """A session of its own in another folder, without PYTHONPATH."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(FS.__file__)))
    code = f"import sys; sys.path.insert(0, {os.path.dirname(root)!r})\nfrom vachan.session import get_spark\nfrom vachan.plans.queries import QUERIES\ns = get_spark('x', 'local[2]', 2)\nprint('rows', QUERIES['lattice_system_wer'](s, '/root/testdata/sf0.001').count())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmpdir_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 6" in done.stdout, done.stderr[-2000:]
