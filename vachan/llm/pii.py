"""Personal data, plain and disguised, with spans in the source text (op 5).

Plain identifiers (email, ip, card, phone) are found in the text itself.  For
disguised ones the text goes through a chain of transducers: look-alike
characters become the ASCII ones they imitate and invisible ones vanish; "at"
and "dot" in brackets, or in the shape name at host dot tld, become @ and a
dot, spaced dots of its name included ("dot", or a word that its host uses
too); runs of spelled digits become digits.  Each transducer keeps, for every
character that it writes, the source span it stands for, so identifiers found
in the normalised text map back to the source exactly.  A span found this way
is added unless a plain one of its kind covers it; one that extends a plain
span stands beside it.

All work is row-local and linear in the text; a text without a trigger for a
transducer skips the chain, which could not change it.

Defined results: null and empty texts have no spans; ids are passed through,
repeated or null; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vachan.llm.common import modest_batches

KINDS = ("email", "ip", "card", "phone")
ORDER = {k: i for i, k in enumerate(KINDS)}

Span = tuple[int, int, str]

# ---------------------------------------------------------------- plain identifiers

NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[Span]:
    """Leftmost matches of name@host.  A name is the run of its characters before an @,
    so the search goes from @ to @ and stays linear."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        end = at + 1
        if m := HOST.match(text, at + 1):
            start = at
            while start > done and text[start - 1] in NAME:
                start -= 1
            if start < at:
                out.append((start, m.end(), "email"))
                done = end = m.end()
        at = text.find("@", end)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def plain(text: str) -> list[Span]:
    """Identifiers as written, by start and kind."""
    out = emails(text) if "@" in text else []
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(map(small, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() > 13:
            digits = NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], ORDER[s[2]]))


# ---------------------------------------------------------------- transducers

class Mapped:
    """A text and, per character, the source span [start, end) it stands for; ``new``
    marks characters that a transducer wrote."""

    def __init__(self, text: str, start: list[int], end: list[int], new: list[bool]):
        self.text, self.start, self.end, self.new = text, start, end, new

    @classmethod
    def of(cls, text: str) -> Mapped:
        n = len(text)
        return cls(text, list(range(n)), list(range(1, n + 1)), [False] * n)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Replace ascending, disjoint spans; each new character stands for the whole span."""
        text, start, end, new, at = [], [], [], [], 0
        for a, b, put in edits:
            text += [self.text[at:a], put]
            start += self.start[at:a] + [self.start[a]] * len(put)
            end += self.end[at:a] + [self.end[b - 1]] * len(put)
            new += self.new[at:a] + [True] * len(put)
            at = b
        text.append(self.text[at:])
        return Mapped("".join(text), start + self.start[at:], end + self.end[at:], new + self.new[at:])


# Letters of other scripts that look like a Latin letter, and signs.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ո": "n",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "ı": "i", "ɡ": "g", "ⅼ": "l",
    "。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", " ": " ", " ": " ", " ": " ",
}
INVISIBLE = "­​‌‍⁠﻿"
# End of fixed values.


def _imitations() -> dict[str, str]:
    """Compatibility forms of one ASCII character and decimal digits of any script."""
    out = {}
    for code in [*range(0xA0, 0x3100), *range(0xA620, 0xAC00), *range(0xFE50, 0xFFE0), *range(0x1D400, 0x1D800), *range(0x1FBF0, 0x1FBFA)]:
        c = chr(code)
        plain_ = unicodedata.normalize("NFKC", c)
        if unicodedata.category(c) == "Nd":
            out[c] = str(unicodedata.decimal(c))
        elif len(plain_) == 1 and 32 < ord(plain_) < 127 and unicodedata.category(c) not in ("No", "Lm") and c not in "ªº":
            out[c] = plain_
    return out


IMITATION = {**_imitations(), **LOOKALIKES, **dict.fromkeys(INVISIBLE, "")}
ODD = re.compile("[" + "".join(map(re.escape, sorted(IMITATION))) + "]")
ODD_LATIN = [c for c in IMITATION if ord(c) < 256]


def odd(text: str) -> bool:
    """Whether ODD occurs in the text (faster than searching for it)."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return not IMITATION.keys().isdisjoint(set(text))
    return any(c in text for c in ODD_LATIN)


def fold(m: Mapped) -> Mapped:
    """Look-alike characters."""
    return m.rewrite([(x.start(), x.end(), IMITATION[x[0]]) for x in ODD.finditer(m.text)])


# Words for @, the dot and digits.
AT = "at|arroba|chez|bei"
DOT = "dot|punto|punkt|point"
DIGITS = (
    "zero one two three four five six seven eight nine".split(),
    "null eins zwei drei vier fünf sechs sieben acht neun".split(),
    "zéro un deux trois quatre cinq six sept huit neuf".split(),
    "cero uno dos tres cuatro cinco seis siete ocho nueve".split(),
)
TLD = "com|org|net|edu|gov|info|biz|io|co|me|app|dev|eu|uk|de|fr|es|it|nl|ch|at|be|pt|us|ca|au|in|jp|br|ru|pl"
# End of fixed values.

SEP = r"[ \t]{0,3}"
BRACKETED = re.compile(rf"{SEP}[\[({{<]{SEP}(?:(?P<at>{AT}|@)|(?P<dot>{DOT}|\.)){SEP}[\])}}>]{SEP}", re.I)
NAMED = re.compile(rf"(?<=[A-Za-z0-9])[ \t]+(?P<at>{AT})[ \t]+(?=(?:[A-Za-z0-9-]+[ \t]+(?:{DOT})[ \t]+){{1,6}}(?:{TLD})\b)", re.I)
DOTTED = re.compile(rf"(?<=@)[A-Za-z0-9-]+(?:(?:\.|[ \t]+(?:{DOT})[ \t]+)[A-Za-z0-9-]+)+", re.I)
SPACED_DOT = re.compile(rf"[ \t]+(?:{DOT})[ \t]+", re.I)
MIN_SPELLED = 7
MIN_PARTS = 4  # spelled digits of an address of three dots, which may be fewer


def local_dots(text: str, at: int, least: int, words: set[str]) -> list[tuple[int, int, str]]:
    """Edits of the spaced dots (one of ``words``) in the name that ends before ``at``."""
    out, end = [], at
    while True:
        start = end
        while start > least and text[start - 1] in NAME:
            start -= 1
        right = start
        while right > least and text[right - 1] in " \t":
            right -= 1
        left = right
        while left > least and text[left - 1].isalpha():
            left -= 1
        end = left
        while end > least and text[end - 1] in " \t":
            end -= 1
        if not (end < left < right < start < at and text[left:right].lower() in words and end > least
                and text[start].isalnum() and text[end - 1] in NAME and text[end - 1].isalnum()):
            return out[::-1]
        out.append((end, start, "."))


def unveil(m: Mapped) -> Mapped:
    """At and dot disguises."""
    m = m.rewrite([(x.start(), x.end(), "@" if x["at"] else ".") for x in BRACKETED.finditer(m.text)])
    m = m.rewrite([(x.start(), x.end(), "@") for x in NAMED.finditer(m.text)])
    edits, done = [], 0
    for host in DOTTED.finditer(m.text):
        dots = list(SPACED_DOT.finditer(m.text, host.start(), host.end()))
        edits += local_dots(m.text, host.start() - 1, done, {"dot", *(x[0].strip().lower() for x in dots)})
        edits += [(x.start(), x.end(), ".") for x in dots]
        done = host.end()
    return m.rewrite(edits)


def _spelled(words: list[str]) -> tuple[re.Pattern, re.Pattern, dict[str, str]]:
    value = {w: str(i) for i, w in enumerate(words)}
    if words[0] == "zero":
        value["oh"] = "0"
    one = "(?:" + "|".join(sorted(value, key=len, reverse=True)) + "|[0-9])"
    run = re.compile(rf"(?:\bplus[ -]+|\+[ ]?)?\b{one}(?:(?:[ ]*[,.-]?[ ]*|[ ]+(?:{DOT})[ ]+)\b{one}\b){{{MIN_PARTS - 1},}}", re.I)
    part = re.compile(rf"plus|\+|\.|{DOT}|{'|'.join(sorted(value, key=len, reverse=True))}|[0-9]", re.I)
    return run, part, value


SPELLED = [_spelled(w) for w in DIGITS]


def _tree(words: list[str]) -> str:
    """Alternation that is decided by the first letter."""
    first: dict[str, list[str]] = {}
    for w in sorted(set(words), key=len, reverse=True):
        first.setdefault(w[0], []).append(w[1:])
    return "(?:" + "|".join(f"{k}(?:{'|'.join(v)})" for k, v in sorted(first.items())) + ")"


#: in lower-cased text: two spelled digits in a row, without which there is no run
PAIR = re.compile(rf"\b{_tree([w for d in DIGITS for w in d])}\b(?:[ ,.-]+|[ ]+(?:{DOT})[ ]+)\b{_tree([w for d in DIGITS for w in d])}\b")


def count_digits(m: Mapped) -> Mapped:
    """Runs of spelled digits, with plus before and dots between, as digits."""
    for run, part, value in SPELLED:
        edits = []
        for r in run.finditer(m.text):
            # a full stop is a dot only if it was a disguised one
            found = [p[0].lower() for p in part.finditer(r[0]) if p[0] != "." or m.new[r.start() + p.start()]]
            digits = sum(p in value or p.isdigit() for p in found)
            if sum(p in value for p in found) * 2 < digits:
                continue  # mostly digits already
            put = "".join("+" if p in ("plus", "+") else value.get(p, p if p.isdigit() else ".") for p in found)
            if digits < MIN_SPELLED and not any(k == "ip" for _, _, k in plain(put)):
                continue
            edits.append((r.start(), r.end(), put))
        m = m.rewrite(edits)
    return m


HINT = re.compile(rf"[\[({{<]{SEP}(?:{AT}|@|{DOT}|\.){SEP}[\])}}>]|[ \t](?:{DOT})[ \t]")
CHAIN: tuple[tuple[Callable[[str], bool], Callable[[Mapped], Mapped]], ...] = (
    (odd, fold),
    (lambda t: HINT.search(t.lower()) is not None, unveil),
    (lambda t: PAIR.search(t.lower()) is not None, count_digits),
)


def disguised(text: str, known: list[Span]) -> list[Span]:
    """Spans that only the normalised text shows, in source offsets."""
    m = None
    for applies, step in CHAIN:
        if applies(text if m is None else m.text):
            m = step(Mapped.of(text) if m is None else m)
    if m is None or m.text == text:
        return []
    found = plain(m.text)
    # a spelled run of a phone's length is one, with or without its plus
    taken = [(a, b) for a, b, _ in found]
    for d in re.finditer(r"[0-9]+", m.text):
        if 10 <= d.end() - d.start() <= 15 and all(m.new[d.start():d.end()]) and m.end[d.end() - 1] - m.start[d.start()] > 2 * len(d[0]) \
                and not any(a < d.end() and d.start() < b for a, b in taken):
            found.append((d.start(), d.end(), "phone"))
    out = []
    # plain spans of one kind are disjoint: only the last that starts no later can cover another
    starts = {kind: [a for a, _, k in known if k == kind] for kind in KINDS}
    ends = {kind: [b for _, b, k in known if k == kind] for kind in KINDS}
    for a, b, kind in found:
        if any(m.new[a:b]) or m.end[b - 1] - m.start[a] != b - a:
            s, e = m.start[a], m.end[b - 1]
            i = bisect_right(starts[kind], s)
            if not i or ends[kind][i - 1] < e:
                out.append((s, e, kind))
    return out


def spell(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """(plain spans, all spans), each by start and kind; code point offsets."""
    base = plain(text)
    more = disguised(text, base)
    return base, sorted(base + more, key=lambda s: (s[0], ORDER[s[2]])) if more else base


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base, spans): counts of plain identifiers,
    plain spans and all spans as kind:start:end lists."""

    def run(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for t in b.column("text"):
                base, both = scan(t.as_py() or "")
                kinds = [k for _, _, k in base]
                for c, v in zip(cols, [*(kinds.count(k) for k in KINDS), spell(base), spell(both)], strict=True):
                    c.append(v)
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                                             names=["id", "n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    d = modest_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, "id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets; spans that
    overlap are one."""
    out, at = [], 0
    for a, b, kind in sorted(spans, key=lambda s: (s[0], -s[1], ORDER[s[2]])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])

