"""Column functions for transcript text.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen; the only Python hop is Unicode NFC (``nfc``),
which Spark has no built-in for.

Regular-expression classes are written so that the same literal works in
Java's regex engine (Spark) and in RE2 (DuckDB oracles): ``\\x{...}`` escapes
and ``\\p{..}`` classes only, no look-around in anything an oracle must copy.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vachan.functions import lexicon as L

# Unicode whitespace as Python's str.isspace()/re \s define it.  Java's plain
# \s is ASCII-only, so the class is spelled out.
WS = r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\p{Z}]"
NON_WS = r"[^\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\p{Z}]"
# Python's \w for str: letters, digits/numerics and underscore (no marks).
WORD = r"[\p{L}\p{N}_]"
# Python's \w plus combining marks: a whole-token boundary for Indic text.
WORD_WITH_MARKS = r"[\p{L}\p{N}\p{M}_]"

# texts of an Arrow batch that are taken as Python strings at once
PIECE = 512

MARKUP = r"<[^>]+>"
# Anything outside Devanagari, ASCII digits, space, ? ! danda and hyphen.
NOT_SCRIPT = r"[^\x{0900}-\x{097F}0-9 ?!\x{0964}\-]+"


def _class_of(chars: str) -> str:
    out = []
    for c in chars:
        out.append("\\" + c if c in "\\[]^-" else c)
    return "[" + "".join(out) + "]"


SCORING_PUNCT = _class_of(L.SCORING_PUNCTUATION)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ── F1-F4: transcript cleaning ──────────────────────────────────────────────

def strip_markup(c) -> Column:
    """delete ``<...>`` tags without inserting a space."""
    return F.regexp_replace(_col(c), MARKUP, "")


def keep_script(c) -> Column:
    """runs of characters outside the Devanagari whitelist become one space."""
    return F.regexp_replace(_col(c), NOT_SCRIPT, " ")


def collapse_ws(c) -> Column:
    """Unicode whitespace runs become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(_col(c), WS + "+", " "))


def clean_transcript(c) -> Column:
    """F4 = F1, F2, F3; a NULL input gives the empty string."""
    return F.coalesce(collapse_ws(keep_script(strip_markup(_col(c)))), F.lit(""))


# ── F5-F9: canonicalisation ─────────────────────────────────────────────────

def digits_to_ascii(c) -> Column:
    """Devanagari digits to ASCII digits, character by character."""
    return F.translate(_col(c), L.DEVANAGARI_DIGITS, L.ASCII_DIGITS)


def token_pattern(variant: str, mode: str = "coded") -> str:
    """Whole-token pattern for a literal: not flanked by a word character.

    ``coded`` uses Python's ``\\w`` (no combining marks, so a rewrite can fire
    inside a word that continues with a vowel sign); ``token`` also treats
    combining marks as word characters.
    """
    w = WORD if mode == "coded" else WORD_WITH_MARKS
    return f"(?<!{w})" + java_quote(variant) + f"(?!{w})"


def java_quote(s: str) -> str:
    """Literal Java regex for ``s`` (``\\Q..\\E`` with embedded ``\\E`` split)."""
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _java_literal_replacement(s: str) -> str:
    return s.replace("\\", "\\\\").replace("$", "\\$")


def rewrite_tokens(c, pairs, mode: str = "coded") -> Column:
    """Apply ``(variant, canonical)`` rewrites one after another, in the JVM.

    Each step rewrites every whole-token occurrence in one left-to-right pass,
    like a single ``re.sub``.  The input is named once (bound as a lambda variable),
    so nested lists add up instead of multiplying.
    """
    def chain(x):
        out = x
        for variant, canon in pairs:
            out = F.regexp_replace(out, token_pattern(variant, mode), _java_literal_replacement(canon))
        # one search for any variant decides whether the chain has anything to do: a
        # rewrite can only make a later one match if some variant was there before
        return F.when(x.rlike("|".join(java_quote(v) for v, _ in pairs)), out).otherwise(x)

    return F.element_at(F.transform(F.array(_col(c)), chain), 1) if pairs else _col(c)


class OrderedRewrites:
    """A list of whole-token rewrites, applied in its order, token by token.

    A rewrite is flanked by characters that are no word characters, so a space
    bounds what it can see: a text is the rewrites of its tokens, except where a
    variant with a space might reach over one.  Tokens whose forms (all that the
    list makes of them on the way) end and begin like the two sides of such a
    space are taken together, so the result is that of the whole text.  One
    automaton of all variants finds the tokens that have any; each distinct token
    is rewritten once and remembered (up to ``REMEMBER`` tokens of ``REMEMBER_CHARS``
    characters together).
    """

    REMEMBER, REMEMBER_CHARS = 200_000, 4_000_000

    def __init__(self, pairs, mode: str = "coded"):
        self.pairs, self.mode = [tuple(p) for p in pairs], mode
        self.known: dict[str, tuple[str, ...]] = {}
        self.held = 0
        self.find = None

    def __getstate__(self):
        return {"pairs": self.pairs, "mode": self.mode, "known": {}, "held": 0, "find": None}

    def _compile(self) -> None:
        import regex

        w = WORD if self.mode == "coded" else WORD_WITH_MARKS
        self.steps = [(regex.compile(f"(?<!{w}){regex.escape(v)}(?!{w})"), c) for v, c in self.pairs]
        self.find = regex.compile("|".join(regex.escape(v) for v, _ in sorted(self.pairs, key=lambda p: -len(p[0])))).search
        split = [v.split(" ") for v, _ in self.pairs if " " in v]
        self.gaps = sorted({(p[k], p[k + 1]) for p in split for k in range(len(p) - 1)})
        self.edges = tuple({x for g in self.gaps for x in g})

    def forms(self, token: str) -> tuple[str, ...]:
        """The token, and what it is after each rewrite that changes it."""
        out = self.known.get(token)
        if out is None:
            out = (token,)
            if self.find(token):
                for pattern, canon in self.steps:
                    new = pattern.sub(lambda _, canon=canon: canon, out[-1])
                    if new != out[-1]:
                        out += (new,)
            size = sum(map(len, out))
            if len(self.known) >= self.REMEMBER or self.held + size > self.REMEMBER_CHARS:
                self.known.clear()
                self.held = 0
            if size <= self.REMEMBER_CHARS:
                self.known[token] = out
                self.held += size
        return out

    def _reaches(self, left: tuple[str, ...], right: tuple[str, ...]) -> bool:
        return any(any(f.endswith(a) for f in left) and any(f.startswith(b) for f in right) for a, b in self.gaps)

    def __call__(self, text: str) -> str:
        if self.find is None:
            self._compile()
        if not self.pairs:
            return text
        out, held = [], None
        for token in text.split(" "):
            here = self.forms(token)
            if held is not None and self.gaps and self._reaches(held, here):
                held = self.forms(f"{held[0]} {token}")
            else:
                if held is not None:
                    out.append(held[-1])
                held = here
        out.append(held[-1])
        return " ".join(out)


def ordered_rewrites(c, pairs, mode: str = "coded") -> Column:
    """``OrderedRewrites`` as a column function, over Arrow batches."""
    rewrite = OrderedRewrites(pairs, mode)

    @F.arrow_udf(T.StringType())
    def rewrites(s: pa.Array) -> pa.Array:
        # a piece at a time: only its texts are Python strings at once
        parts = [pa.array([None if x is None else rewrite(x) for x in s.slice(i, PIECE).to_pylist()], pa.string()) for i in range(0, len(s), PIECE)]
        return pa.concat_arrays(parts) if parts else s

    return rewrites(_col(c))


def canonicalise(c, convert_number_words: bool = False, mode: str = "coded",
                 null_as: str = "empty", ordinals=None, numerals=None, schwa=None,
                 normalise_unicode: bool = False) -> Column:
    """whitespace, digits, ordinals, [number words], schwa variants, trim.

    The lists are one ordered list for ``ordered_rewrites``.  ``null_as='empty'``
    maps NULL to ``''``; ``'nan'`` maps it to the word ``nan`` (what a string cast
    of a missing spreadsheet cell yields).  ``normalise_unicode=True`` applies NFC
    first, so precomposed nukta letters (U+0958..U+095F) meet the lexicons'
    letter + nukta form; off by default, as the original looked up raw code
    points.
    """
    x = _col(c)
    x = F.coalesce(x, F.lit("" if null_as == "empty" else "nan"))
    if normalise_unicode:
        x = nfc(x)
    x = digits_to_ascii(collapse_ws(x))
    pairs = list(L.ORDINAL_REWRITES if ordinals is None else ordinals)
    if convert_number_words:
        pairs += L.NUMBER_WORD_REWRITES if numerals is None else numerals
    pairs += L.SCHWA_REWRITES if schwa is None else schwa
    return F.trim(ordered_rewrites(x, pairs, mode))


# ── F10-F13: scoring tokens ─────────────────────────────────────────────────

# The first character that normalisation can touch or that can compose with one before
# it is U+0300; a text without any from there on is its own NFC.
NFC_TOUCHES = r"[^\x{0000}-\x{02FF}]"


@F.arrow_udf(T.StringType())
def _nfc(s: pa.Array) -> pa.Array:
    touched = pc.fill_null(pc.match_substring_regex(s, NFC_TOUCHES), False)
    if not touched.true_count:
        return s
    new = pa.array([unicodedata.normalize("NFC", x) for x in s.filter(touched).to_pylist()], s.type)
    return pc.replace_with_mask(s, touched, new)


def nfc(c) -> Column:
    """Unicode NFC (no Spark built-in; over Arrow batches).  Only texts that
    normalisation could touch become Python strings.  The input is named once: Spark
    repeats an expression in front of a Python function wherever it is named."""
    return _nfc(_col(c))


def strip_scoring_punct(c) -> Column:
    """each scoring punctuation mark becomes a space."""
    return F.regexp_replace(_col(c), SCORING_PUNCT, " ")


def split_ws(c) -> Column:
    """Whitespace tokens of a string (empty strings removed)."""
    return F.filter(F.split(_col(c), WS + "+"), lambda t: t != "")


def tokenise(c, normalise_unicode: bool = True) -> Column:
    """NFC, punctuation to spaces, whitespace split; NULL gives ``[]``."""
    x = F.coalesce(_col(c), F.lit(""))
    if normalise_unicode:
        x = nfc(x)
    return split_ws(strip_scoring_punct(x))


def ws_tokens(c) -> Column:
    """maximal non-whitespace runs, as ``re.findall(r'\\S+')`` gives them."""
    return F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit(NON_WS + "+"), 0)


# ── F14-F22: token shells, scripts, display ─────────────────────────────────

TRAILING_NUMBER_PUNCT = r"[,\x{0964}!?]+$"
SHELL = "[\\x{0964},!?\"'\\-]"


def strip_trailing_punct(c) -> Column:
    """drop trailing ``, । ! ?`` (lookup key of a number word)."""
    return F.regexp_replace(_col(c), TRAILING_NUMBER_PUNCT, "")


def token_prefix(c) -> Column:
    """leading shell characters of a token."""
    return F.regexp_extract(_col(c), f"^{SHELL}*", 0)


def token_core(c) -> Column:
    """token without its leading and trailing shell characters."""
    return F.regexp_replace(F.regexp_replace(_col(c), f"^{SHELL}+", ""), f"{SHELL}+$", "")


def token_suffix(c) -> Column:
    """trailing shell characters after the core."""
    rest = F.regexp_replace(_col(c), f"^{SHELL}+", "")
    return F.regexp_extract(rest, f"{SHELL}*$", 0)


@lru_cache(maxsize=1)
def latin_class() -> str:
    """Character class of every code point whose Unicode name starts with LATIN.

    Built from a rule (the Unicode character database), not a list.
    """
    ranges: list[list[int]] = []
    for cp in range(0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        if unicodedata.name(chr(cp), "").startswith("LATIN"):
            if ranges and ranges[-1][1] == cp - 1:
                ranges[-1][1] = cp
            else:
                ranges.append([cp, cp])
    parts = []
    for a, b in ranges:
        parts.append(f"\\x{{{a:04X}}}" if a == b else f"\\x{{{a:04X}}}-\\x{{{b:04X}}}")
    return "[" + "".join(parts) + "]"


def has_latin(c) -> Column:
    """the value holds at least one Latin-script character."""
    return _col(c).rlike(latin_class())


def latin_ratio(c) -> Column:
    """F16 helper: share of Latin-script characters (NULL for the empty string)."""
    x = _col(c)
    n = F.length(x)
    return F.when(n > 0, F.length(F.regexp_replace(x, "[^" + latin_class()[1:], "")) / n)


def is_roman_script(c) -> Column:
    """F16: more than half the characters are Latin-script."""
    return F.coalesce(latin_ratio(c) > 0.5, F.lit(False))


def has_devanagari(c) -> Column:
    """any character in U+0900..U+097F."""
    return _col(c).rlike(r"[\x{0900}-\x{097F}]")


def url_basename(c) -> Column:
    """last ``/`` piece of a URL."""
    return F.element_at(F.split(_col(c), "/"), -1)


def display_prefix(c, n: int = 80) -> Column:
    """the first ``n`` characters (report display)."""
    return F.substring(_col(c), 1, n)


def register_normalise(spark, name: str = "normalise") -> None:
    """V4: F9 (with its defaults) under a SQL name, as a SQL function of built-ins."""
    def quoted(t: str) -> str:
        return "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"

    x = f"translate(trim(regexp_replace(coalesce(s, ''), {quoted(WS + '+')}, ' ')), {quoted(L.DEVANAGARI_DIGITS)}, {quoted(L.ASCII_DIGITS)})"
    for variant, canon in [*L.ORDINAL_REWRITES, *L.SCHWA_REWRITES]:
        x = f"regexp_replace({x}, {quoted(token_pattern(variant))}, {quoted(_java_literal_replacement(canon))})"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS STRING RETURN trim({x})")
