"""Spoken number words to digits, with idiom guards.

Built from Spark built-ins only, in one row:

1. tokens = maximal non-whitespace runs of the text (F13);
2. a token is a number word when, after stripping trailing ``, । ! ?`` (F14),
   it is a key of the number lexicon (J3: a literal map);
3. protected tokens (J5): every idiom phrase is matched over the raw text with
   a Python-style ``\\b`` boundary; each match is overwritten in a copy of the
   text by a same-shaped marker string (whitespace kept), so the copy
   tokenises exactly like the text and a token is protected when its copy
   differs.  Phrases are matched independently, as separate searches;
4. runs (W4): a piece starts at every token that does not continue a run of
   number words, so every piece is a maximal run or a single other token,
   a slice of the token array (no character of the text is special);
5. a run touching a protected token stays as it is; otherwise it becomes the
   digits of the N1 fold (units/tens add, ``सौ`` multiplies the current
   group, multipliers >= 1000 close a group) and its other tokens vanish;
6. the text is rejoined with single spaces; every conversion is recorded as
   ``(original, replacement, position)`` with the token index of the run.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vachan.functions import lexicon as L
from vachan.functions import text as TX

MARK = "﷐"     # not in any idiom, so a marked token always differs

CHANGE_TYPE = "array<struct<original:string,replacement:string,position:int>>"


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs for x in kv])


def boundary_pattern(phrase: str) -> str:
    """``\\b phrase \\b`` with Python's Unicode word boundary, spelled with
    look-around (Java's ``\\b`` disagrees on combining marks)."""
    w = TX.WORD
    b = f"(?:(?<={w})(?!{w})|(?<!{w})(?={w}))"
    return b + TX.java_quote(phrase) + b


def _mask(phrase: str) -> str:
    return "".join(ch if ch.isspace() else MARK for ch in phrase)


# Exact integers of any size as little-endian base-10^9 limb arrays (the fold
# multiplies by powers of ten and adds small values; Python's int never
# overflows, so neither may this).
LIMB = 1_000_000_000
_LIMBS = "array<long>"


def _limbs(v: Column) -> Column:
    return F.array(v.cast("long"))


def _carry_fold(x: Column, per_limb) -> Column:
    """Fold limbs low to high with a carry; ``per_limb(limb, carry)`` gives
    the raw limb value; the final carry becomes more limbs."""
    init = F.struct(F.array().cast(_LIMBS).alias("out"), F.lit(0).cast("long").alias("carry"))

    def step(acc, limb):
        v = per_limb(limb, acc["carry"])
        return F.struct(F.concat(acc["out"], F.array(v % LIMB)).alias("out"), F.floor(v / LIMB).cast("long").alias("carry"))

    def finish(acc):
        # a carry is below 10^9 * 10^7 / 10^9 + 1, so at most one extra limb of it
        return F.when(acc["carry"] > 0, F.concat(acc["out"], F.array(acc["carry"] % LIMB),
                                                 F.when(acc["carry"] >= LIMB, F.array(F.floor(acc["carry"] / LIMB).cast("long")))
                                                  .otherwise(F.array().cast(_LIMBS))))\
                .otherwise(acc["out"])

    return F.aggregate(x, init, step, finish)


def _mul_small(x: Column, m: Column) -> Column:
    return _carry_fold(x, lambda limb, carry: limb * m + carry)


def _add(x: Column, y: Column) -> Column:
    n = F.greatest(F.size(x), F.size(y))
    idx = F.sequence(F.lit(1), n)
    summed = F.transform(idx, lambda i: F.coalesce(F.try_element_at(x, i), F.lit(0).cast("long"))
                         + F.coalesce(F.try_element_at(y, i), F.lit(0).cast("long")))
    return _carry_fold(summed, lambda limb, carry: limb + carry)


def _positive(x: Column) -> Column:
    return F.exists(x, lambda l: l > 0)


def _to_string(x: Column) -> Column:
    hi = F.reverse(x)
    body = F.array_join(F.transform(F.slice(hi, 2, F.greatest(F.size(hi) - 1, F.lit(0))),
                                    lambda l: F.lpad(l.cast("string"), 9, "0")), "")
    s = F.concat(F.element_at(hi, 1).cast("string"), body)
    return F.coalesce(F.regexp_extract(s, "^0*([0-9]+?)$", 1), F.lit("0"))


def _words_to_long(words: Column, add: Column, mul: Column) -> Column:
    """N1 in 64-bit arithmetic; NULL as soon as a step would overflow."""
    init = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("current"))

    def step(acc, w):
        a = F.try_element_at(add, w).cast("long")
        m = F.try_element_at(mul, w).cast("long")
        base = F.when(acc["current"] > 0, acc["current"]).otherwise(F.lit(1).cast("long"))
        bm = F.try_multiply(base, m)
        return (F.when(acc.isNull(), acc)
                 .when(a.isNotNull(), F.struct(acc["total"].alias("total"), F.try_add(acc["current"], a).alias("current")))
                 .when(m >= 1000, F.when(bm.isNull() | F.try_add(acc["total"], bm).isNull(), F.lit(None))
                       .otherwise(F.struct(F.try_add(acc["total"], bm).alias("total"), F.lit(0).cast("long").alias("current"))))
                 .when(m.isNotNull(), F.when(bm.isNull(), F.lit(None))
                       .otherwise(F.struct(acc["total"].alias("total"), bm.alias("current"))))
                 .otherwise(acc))

    return F.aggregate(words, init, step, lambda acc: F.try_add(acc["total"], acc["current"]))


def words_to_int(words: Column, additive=None, multipliers=None) -> Column:
    """N1 over an array of lexicon keys, exact at any size; decimal string.

    64-bit arithmetic first; only a run whose value overflows it is folded
    again with limb arithmetic."""
    add_m = _map(L.ADDITIVE_VALUES.items() if additive is None else additive.items())
    mul_m = _map(L.MULTIPLIER_VALUES.items() if multipliers is None else multipliers.items())
    return F.coalesce(_words_to_long(words, add_m, mul_m).cast("string"),
                      _words_to_int_exact(words, additive, multipliers))


def _words_to_int_exact(words: Column, additive=None, multipliers=None) -> Column:
    """N1 with limb arithmetic (any size)."""
    add = _map(L.ADDITIVE_VALUES.items() if additive is None else additive.items())
    mul = _map(L.MULTIPLIER_VALUES.items() if multipliers is None else multipliers.items())
    zero = F.array(F.lit(0).cast("long"))
    init = F.struct(zero.alias("total"), zero.alias("current"))

    def step(acc, w):
        a = F.try_element_at(add, w).cast("long")
        m = F.try_element_at(mul, w).cast("long")
        base = F.when(_positive(acc["current"]), acc["current"]).otherwise(F.array(F.lit(1).cast("long")))
        return (F.when(a.isNotNull(), F.struct(acc["total"].alias("total"), _add(acc["current"], _limbs(a)).alias("current")))
                 .when(m >= 1000, F.struct(_add(acc["total"], _mul_small(base, m)).alias("total"),
                                           zero.alias("current")))
                 .when(m.isNotNull(), F.struct(acc["total"].alias("total"), _mul_small(base, m).alias("current")))
                 .otherwise(acc))

    return F.aggregate(words, init, step, lambda acc: _to_string(_add(acc["total"], acc["current"])))


def normalize_numbers(c, idioms=None, additive=None, multipliers=None, normalise_unicode: bool = False) -> Column:
    """``struct<text STRING, changes CHANGE_TYPE>``.  ``normalise_unicode``
    applies NFC first (off by default: raw code points are looked up)."""
    text = F.coalesce(TX._col(c), F.lit(""))
    if normalise_unicode:
        text = TX.nfc(text)
    phrases = L.IDIOM_PHRASES if idioms is None else idioms
    add = L.ADDITIVE_VALUES if additive is None else additive
    mul = L.MULTIPLIER_VALUES if multipliers is None else multipliers
    numbers = _map({**add, **mul}.items())

    masks = F.array(*[F.when(text.contains(p), TX.ws_tokens(F.regexp_replace(text, boundary_pattern(p), _mask(p))))
                      for p in phrases]) if phrases else F.array().cast("array<array<string>>")

    def per_text(toks, masked):
        n = F.size(toks)
        idx = F.sequence(F.lit(0), n - 1)
        keys = F.transform(toks, lambda t: TX.strip_trailing_punct(t))
        flags = F.struct(keys.alias("keys"), F.transform(keys, lambda k: F.try_element_at(numbers, k).isNotNull()).alias("num"),
                         F.transform(idx, lambda k: F.exists(masked, lambda mt: mt.isNotNull() & (mt[k] != toks[k]))).alias("kept"))
        return F.when(n == 0, F.struct(F.lit("").alias("text"), F.array().cast(CHANGE_TYPE).alias("changes"))) \
                .otherwise(_let(flags, lambda f: per_piece(toks, n, idx, f)))

    def per_piece(toks, n, idx, f):
        starts = F.filter(idx, lambda k: ~(f["num"][k] & F.coalesce(F.get(f["num"], k - 1), F.lit(False))))

        def cut(st):
            ends = F.concat(F.slice(st, 2, F.greatest(F.size(st) - 1, F.lit(0))), F.array(n))
            return F.transform(F.arrays_zip(st.alias("a"), ends.alias("b")), piece)

        def piece(x):
            at, size = x["a"], x["b"] - x["a"]
            raw = F.slice(toks, at + 1, size)
            convert = f["num"][at] & ~F.exists(F.slice(f["kept"], at + 1, size), lambda p: p)

            def converted(value):
                return F.struct(F.array(value).alias("out"),
                                F.struct(F.array_join(raw, " ").alias("original"), value.alias("replacement"),
                                         at.cast("int").alias("position")).alias("change"))

            kept = F.struct(raw.alias("out"), F.lit(None).cast(
                "struct<original:string,replacement:string,position:int>").alias("change"))
            return F.when(convert, _let(words_to_int(F.slice(f["keys"], at + 1, size), add, mul), converted)).otherwise(kept)

        def assemble(parts):
            return F.struct(F.array_join(F.flatten(F.transform(parts, lambda x: x["out"])), " ").alias("text"),
                            F.filter(F.transform(parts, lambda x: x["change"]),
                                     lambda ch: ch.isNotNull()).alias("changes"))

        # the per-piece results are bound once and read twice
        return _let(_let(starts, cut), assemble)

    return _let(F.struct(TX.ws_tokens(text).alias("t"), masks.alias("m")), lambda s: per_text(s["t"], s["m"]))


def asr_cleanup(c, idioms=None, loanwords=None) -> Column:
    """X1 then X2 on X1's text: ``struct<after_num_norm, after_en_tagging,
    num_changes, en_words>``."""
    from vachan.functions.codeswitch import tag_english

    def body(x):
        tagged = tag_english(x["text"], loanwords)
        return F.struct(x["text"].alias("after_num_norm"), tagged["text"].alias("after_en_tagging"),
                        x["changes"].alias("num_changes"), tagged["words"].alias("en_words"))

    return _let(normalize_numbers(c, idioms), body)


def contains_idiom(c, idioms=None) -> Column:
    """the text holds any guarded phrase (Python-style word boundaries)."""
    phrases = L.IDIOM_PHRASES if idioms is None else idioms
    x = TX._col(c)
    return F.coalesce(F.array_max(F.array(*[x.rlike(boundary_pattern(p)) for p in phrases])), F.lit(False))
