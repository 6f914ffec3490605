"""English-word detection and ``[EN]..[/EN]`` tagging.

Row-local: one ``transform`` over the whitespace tokens of a text.  A token's
shell (leading/trailing ``। , ! ? " ' -``) stays outside the tag.  The core is
English when it holds any Latin-script character or is in the loanword
lexicon (a literal array, broadcast with the plan; no join).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vachan.functions import lexicon as L
from vachan.functions import text as TX


def tag_english(c, loanwords=None) -> Column:
    """``struct<text STRING, words ARRAY<STRING>>``: tagged text (tokens
    rejoined with single spaces) and the detected English cores in order."""
    lex = list(L.LOANWORDS if loanwords is None else loanwords)   # isin: a hash set, not a scan per token
    toks = TX.ws_tokens(c)

    def decided(t, x):
        # x = struct(core, eng): computed once per token, read twice
        return F.struct(
            F.when(x["eng"], F.concat(TX.token_prefix(t), F.lit("[EN]"), x["core"], F.lit("[/EN]"), TX.token_suffix(t)))
             .otherwise(t).alias("out"),
            F.when(x["eng"], x["core"]).alias("word"))

    def one(t):
        core = TX.token_core(t)

        def with_core(c):
            return F.struct(c.alias("core"), (TX.has_latin(c) | c.isin(lex)).alias("eng"))

        x = F.element_at(F.transform(F.array(core), with_core), 1)
        return F.element_at(F.transform(F.array(x), lambda y: decided(t, y)), 1)

    def assemble(parts):
        return F.struct(F.array_join(F.transform(parts, lambda p: p["out"]), " ").alias("text"),
                        F.filter(F.transform(parts, lambda p: p["word"]), lambda w: w.isNotNull()).alias("words"))

    # the per-token results are bound once and read twice
    return F.element_at(F.transform(F.array(F.transform(toks, one)), assemble), 1)
