from pyspark.sql import functions as F

from vachan.functions import text as TX


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first()["y"]


def test_strip_markup_and_clean(spark):
    assert one(spark, TX.strip_markup("x"), "a<b>c") == "ac"
    assert one(spark, TX.clean_transcript("x"), "  <s>नमस्ते</s> hello, दुनिया!  ") == "नमस्ते दुनिया!"
    assert one(spark, TX.clean_transcript("x"), None) == ""
    # digits and the danda survive, Latin letters do not
    assert one(spark, TX.clean_transcript("x"), "abc 12 ।") == "12 ।"


def test_digits(spark):
    assert one(spark, TX.digits_to_ascii("x"), "१२३ ४५") == "123 45"


def test_canonicalise_coded_and_token_modes(spark):
    # whole-token rewrite; in coded mode a vowel sign is not a word character
    assert one(spark, TX.canonicalise("x"), "करन") == "करना"
    assert one(spark, TX.canonicalise("x"), "करना") == "करनाा"
    assert one(spark, TX.canonicalise("x", mode="token"), "करना") == "करना"
    assert one(spark, TX.canonicalise("x"), "  1st   class ") == "पहली class"
    assert one(spark, TX.canonicalise("x", convert_number_words=True), "दो लोग") == "2 लोग"
    assert one(spark, TX.canonicalise("x"), None) == ""
    assert one(spark, TX.canonicalise("x", null_as="nan"), None) == "nan"
    # adjacent matches sharing one separator are both rewritten
    assert one(spark, TX.canonicalise("x"), "करन करन") == "करना करना"


def test_tokenise(spark):
    assert one(spark, TX.tokenise("x"), "क्या, होता—है? (हाँ)") == ["क्या", "होता", "है", "हाँ"]
    assert one(spark, TX.tokenise("x"), None) == []
    # NFC: e + combining acute composes
    assert one(spark, TX.tokenise("x"), "café") == ["café"]
    # en dash and curly quotes are not in the strip set
    assert one(spark, TX.tokenise("x"), "a–b") == ["a–b"]


def test_latin_tests(spark):
    assert one(spark, TX.has_latin("x"), "नमस्ते") is False
    assert one(spark, TX.has_latin("x"), "नमसx") is True
    assert one(spark, TX.has_latin("x"), "ª") is False  # feminine ordinal is not named LATIN
    assert one(spark, TX.is_roman_script("x"), "ab क") is False  # exactly half
    assert one(spark, TX.is_roman_script("x"), "abc क") is True
    assert one(spark, TX.has_devanagari("x"), "abc") is False


def test_whitespace_unicode(spark):
    assert one(spark, TX.collapse_ws("x"), "a  b\x1c c") == "a b c"
    assert one(spark, TX.ws_tokens("x"), " a　b  c ") == ["a", "b", "c"]


def test_url_basename(spark):
    assert one(spark, TX.url_basename("x"), "https://h/a/b/ch_487624.wav") == "ch_487624.wav"


def test_shell_split(spark):
    df = spark.createDataFrame([("\"job\"",), ("ok.",), ("-",), ("।हाँ!",)], "x string")
    rows = df.select(TX.token_prefix("x").alias("p"), TX.token_core("x").alias("c"),
                     TX.token_suffix("x").alias("s")).collect()
    assert [tuple(r) for r in rows] == [('"', "job", '"'), ("", "ok.", ""), ("-", "", ""), ("।", "हाँ", "!")]
    assert F is not None


def test_nfc_of_a_batch_names_its_input_once(spark):
    """Texts that normalisation touches, others and NULL in one batch."""
    rows = [(0, "e\u0301tude"), (1, "caf\u00e9"), (2, None), (3, ""), (4, "=\u0338"), (5, "\u0958")] * 300
    d = spark.createDataFrame(rows, "k int, x string").coalesce(1).select("k", TX.nfc(F.reverse(F.reverse("x"))).alias("y"))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("reverse(reverse(") == 1
    assert {(r["k"], r["y"]) for r in d.collect()} == {(0, "\u00e9tude"), (1, "caf\u00e9"), (2, None), (3, ""), (4, "\u2260"), (5, "\u0915\u093c")}


def test_rewrites_of_a_batch_longer_than_a_piece(spark):
    n = 2 * TX.PIECE + 7
    d = spark.range(n).coalesce(1).select("id", F.when(F.col("id") % 5 > 0, F.concat(F.lit("ab "), F.col("id").cast("string"))).alias("x"))
    got = d.select("id", TX.ordered_rewrites("x", [("ab", "z")]).alias("y")).collect()
    assert {r["id"]: r["y"] for r in got} == {k: f"z {k}" if k % 5 else None for k in range(n)}
