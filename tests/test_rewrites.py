"""Ordered rewriting token by token against the chain of whole-text rewrites."""

import random
import unicodedata

import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from vachan.functions import lexicon as L
from vachan.functions import text as TX


def chain(text, pairs, mode):
    w = TX.WORD if mode == "coded" else TX.WORD_WITH_MARKS
    for v, c in pairs:
        text = regex.sub(f"(?<!{w}){regex.escape(v)}(?!{w})", lambda _, c=c: c, text)
    return text


LISTS = [[("a b", "c"), ("c", "a"), ("b", "a b"), ("aa", "b c"), ("c d a", "x")], [("ab", "a"), ("a", "b b"), ("b b b", "c")], []]


@settings(max_examples=300, deadline=None)
@given(st.text("abcd .-ी", max_size=25), st.sampled_from(LISTS), st.sampled_from(["coded", "token"]))
def test_tokens_give_the_chain(text, pairs, mode):
    assert TX.OrderedRewrites(pairs, mode)(text) == chain(text, pairs, mode)


def test_lexicons_give_the_chain():
    rnd = random.Random(2)
    pairs = [*L.ORDINAL_REWRITES, *L.NUMBER_WORD_REWRITES, *L.SCHWA_REWRITES]
    parts = [x for p in pairs for x in p] + ["शुरू", "करन", "घर", "१", ",", "ी"]
    rewrite = TX.OrderedRewrites(pairs)
    rewrite.REMEMBER = 50
    for _ in range(400):
        text = "".join(rnd.choice(parts) + rnd.choice([" ", " ", " ", ""]) for _ in range(rnd.randrange(12)))
        assert rewrite(text) == chain(text, pairs, "coded")


def test_chain_in_the_jvm_names_its_input_once(spark):
    d = spark.createDataFrame([("the the and",), (None,)], "x string")
    twice = d.select(TX.rewrite_tokens(TX.rewrite_tokens("x", [("the", "and"), ("and", "or")]), [("or", "of")]).alias("y"))
    assert [r.y for r in twice.collect()] == ["of of of", None]
    plan = d.select(TX.canonicalise("x", True).alias("y"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_nfc_touches_nothing_below():
    for cp in range(0x300):
        c = chr(cp)
        assert unicodedata.normalize("NFC", c) == c and not unicodedata.combining(c)
        assert unicodedata.normalize("NFC", "e" + c) == "e" + c


def test_nfc_by_quick_check(spark):
    texts = ["plain", "é", "é", "क़", "क़", "가", "", None, "ạ̇", "ạ̇"]
    got = spark.createDataFrame([(t,) for t in texts], "x string").select(TX.nfc("x").alias("y")).collect()
    assert [r.y for r in got] == [t and unicodedata.normalize("NFC", t) for t in texts]


def test_remembered_tokens_are_bounded_by_characters():
    """Long tokens: what is remembered stays under the bound, the results stay whole."""
    pairs = [("ab", "x"), ("x", "yz")]
    rewrite = TX.OrderedRewrites(pairs)
    rewrite.REMEMBER_CHARS = 5000
    for k in range(200):
        long = f"{k}" + "q" * 300
        assert rewrite(f"ab {long} x") == f"yz {long} yz"
        assert sum(len(f) for forms in rewrite.known.values() for f in forms) <= 5000
    assert rewrite("q" * 9000 + " ab") == "q" * 9000 + " yz"
