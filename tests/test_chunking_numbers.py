from pyspark.sql import functions as F

from vachan.functions import codeswitch as CS
from vachan.functions import numbers as NW
from vachan.operators import chunking as CH

WORDS = "recording_id long, words array<struct<word:string,start:double,end:double>>"


def chunks(spark, words, max_dur=29.0, min_dur=0.5):
    df = spark.createDataFrame([(1, words)], WORDS)
    return [(r["chunk_id"], r["start"], r["end"]) for r in
            CH.chunk_recordings(df, max_dur=max_dur, min_dur=min_dur).orderBy("chunk_id").collect()]


def test_pack_rules(spark):
    w = [("क", 0.0, 10.0), ("ख", 10.0, 25.0), ("ग", 25.0, 31.0), ("घ", 31.0, 40.0)]
    assert chunks(spark, w) == [(0, 0.0, 25.0), (1, 25.0, 40.0)]
    # a single long word is one chunk
    assert chunks(spark, [("क", 0.0, 40.0)]) == [(0, 0.0, 40.0)]
    # a 0.3 s chunk is dropped, a blank word skipped
    assert chunks(spark, [("क", 0.0, 0.3)]) == []
    assert chunks(spark, [("क", 0.0, 1.0), ("  ", 1.0, 50.0), ("ख", 1.0, 2.0)]) == [(0, 0.0, 2.0)]


def test_pack_text_is_cleaned(spark):
    df = spark.createDataFrame([(1, [("<b>नमस्ते</b>", 0.0, 1.0), ("hello", 1.0, 2.0), ("दुनिया", 2.0, 3.0)])], WORDS)
    assert CH.chunk_recordings(df).first()["text"] == "नमस्ते दुनिया"


def test_pack_rejects_null_time(spark):
    df = spark.createDataFrame([(1, [("क", None, 1.0)])], WORDS)
    assert CH.chunk_recordings(df).count() == 0
    assert CH.chunk_rejects(df).first()["reject_reason"] == "null word text or time"


def run_numbers(spark, text):
    r = spark.createDataFrame([(text,)], "t string").select(NW.normalize_numbers("t").alias("x")).first()["x"]
    return r["text"], [tuple(c) for c in r["changes"]]


def test_number_goldens(spark):
    assert run_numbers(spark, "मेरी सैलरी तीन लाख पचास हज़ार रुपये सालाना है")[0] == "मेरी सैलरी 350000 रुपये सालाना है"
    t, ch = run_numbers(spark, "मेरा इंटरव्यू दो बजे है और मुझे पाँच सौ रुपये टैक्सी के देने होंगे")
    assert [c[1] for c in ch] == ["2", "500"] and [c[2] for c in ch] == [2, 7]
    assert run_numbers(spark, "कंपनी में एक हज़ार दो सौ पचास लोग काम करते हैं")[1][0][1] == "1250"
    assert [c[1] for c in run_numbers(spark, "यह प्रोजेक्ट तीन महीने में पूरा होगा और बजट पचास लाख है")[1]] == ["3", "5000000"]
    assert run_numbers(spark, "तीन सौ")[0] == "300"


def test_number_guards(spark):
    for s in ["उसने मुझसे दो-चार बातें कीं और चला गया", "उसने सात आठ साल पहले यह काम शुरू किया था", "दो तीन लोग"]:
        assert run_numbers(spark, s) == (s, [])
    # a phrase ending in a vowel sign never matches before a space: the guard misses
    assert run_numbers(spark, "एक दो लोग") == ("3 लोग", [("एक दो", "3", 0)])
    assert run_numbers(spark, "सौ")[0] == "100"
    assert run_numbers(spark, "दो, तीन")[0] == "5"
    assert run_numbers(spark, "") == ("", [])


def test_code_switch(spark):
    df = spark.createDataFrame([("मेरा इंटरव्यू बहुत अच्छा गया और मुझे जॉब मिल गई",), ("x ok. \"job\" -",)], "t string")
    out = [r["x"] for r in df.select(CS.tag_english("t").alias("x")).collect()]
    assert out[0]["text"] == "मेरा [EN]इंटरव्यू[/EN] बहुत अच्छा गया और मुझे [EN]जॉब[/EN] मिल गई"
    assert out[1]["text"] == "[EN]x[/EN] [EN]ok.[/EN] \"[EN]job[/EN]\" -"
    assert out[1]["words"] == ["x", "ok.", "job"]


def test_combined_golden(spark):
    df = spark.createDataFrame([("ये course online है और इसमें तीन सौ रुपये की fees है",)], "t string")
    x = df.select(NW.asr_cleanup("t").alias("x")).first()["x"]
    assert x["after_en_tagging"] == "ये [EN]course[/EN] [EN]online[/EN] है और इसमें 300 रुपये की [EN]fees[/EN] है"
    assert x["en_words"] == ["course", "online", "fees"]
    assert F is not None


def test_contains_idiom(spark):
    df = spark.createDataFrame([("सात आठ साल",), ("एक दो लोग",), ("कुछ नहीं",)], "t string")
    assert [r[0] for r in df.select(NW.contains_idiom("t")).collect()] == [True, False, False]


def test_nfc_option(spark):
    # precomposed U+095B (ज़) misses the lexicon's ज + nukta unless NFC runs first
    text = "एक हज़ार"
    df = spark.createDataFrame([(text,)], "t string")
    raw = df.select(NW.normalize_numbers("t").alias("x")).first()["x"]["text"]
    nfc = df.select(NW.normalize_numbers("t", normalise_unicode=True).alias("x")).first()["x"]["text"]
    assert raw == "1 " + text.split(" ")[1] and nfc == "1000"


def test_noncharacters_pass_through(spark):
    from vachan.functions import numbers as NW

    texts = ["a \ufdd3 b", "\ufdd0दो\ufdd0 तीन सौ", "दो \ufdd1 \ufdd2 तीन", "\ufdd0\ufdd0 सौ", "\ufdd0\ufdd0-\ufdd0\ufdd0\ufdd0 दो"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", NW.normalize_numbers("t").alias("x")).orderBy("i")
    assert [r["x"]["text"] for r in df.collect()] == ["a \ufdd3 b", "\ufdd0दो\ufdd0 300", "2 \ufdd1 \ufdd2 3", "\ufdd0\ufdd0 100", "\ufdd0\ufdd0-\ufdd0\ufdd0\ufdd0 2"]
