"""Rows that meet every awkward case, and brute-force results."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

# extra columns whose names operators use inside
EXTRA = "row long, key string, size int, node string, g int, digest string, class string, shard int, kind string, part string, id string, length int, n_words int"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA


def prose(rnd: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(2 + (i * 7) % 6)) + ("\n" if rnd.random() < 0.05 else "") for i in (rnd.randrange(vocabulary) for _ in range(n)))


def documents(seed: int = 5, n: int = 60) -> list[tuple]:
    """(doc_id, text, lang, source, ...): copies, near copies, nulls, empty and long texts, repeated rows."""
    rnd = random.Random(seed)
    texts = [prose(rnd, rnd.choice([3, 20, 60, 150, 400])) for _ in range(n)]
    texts += [t.upper() for t in texts[:5]] + texts[:8]
    for t in texts[10:20]:
        w = t.split(" ")
        for _ in range(max(1, len(w) // 60)):
            w[rnd.randrange(len(w))] = "zz"
        texts.append(" ".join(w))
    texts += ["", None, " \n\t ", "one", "one two three four", "One Two Three Four", "a " * 3000, "é ü 日本 " * 40, "x" * 5000, "same passage " * 30 + texts[3], "same passage " * 30 + texts[4],
              "#*$ %&| <> " * 40, "word, with $$$ and ### in it &&& all *** the %%% time " * 9, prose(rnd, 9000, 5000)]
    rows = [(i * 3, t, rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "b", "b", None])) for i, t in enumerate(texts)]
    rows += [rows[1], rows[1], (rows[2][0], "another text under a used id", "en", "a"), (None, texts[0], "en", "a"), (None, None, None, None), (None, prose(rnd, 80), "en", "b")]
    rnd.shuffle(rows)
    return [(i, t, la, s, len(t or ""), k, "k", 1, "n", 2, "d", "c", 3, "x", "p", "i", 4, 5) for k, (i, t, la, s) in enumerate(rows)]


def order(i):
    return -(1 << 63) if i is None else i


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None, n: int = 5) -> frozenset:
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def components(rows: list[tuple], percent: int = 80) -> list[tuple]:
    """(id, n_shingles, component id) by comparing every pair that shares a shingle."""
    sets = [shingles(t) for _, t in rows]
    inverted = defaultdict(list)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in inverted[x])
        for j, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
        for x in s:
            inverted[x].append(i)
    least = {}
    for i, (id_, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, (1 << 63)), order(id_))
    return [(id_, len(sets[i]), None if least[find(i)] == order(None) else least[find(i)]) for i, (id_, _) in enumerate(rows)]


def stats(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    t = text or ""
    w = words(t)
    windows = Counter(zip(w, w[1:], w[2:]))
    hit = {j for i in range(len(w) - 2) if windows[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit)


def repeats(rows: list[tuple], length: int = 100) -> Counter:
    """Multiset of (id, n_bytes, n_removed, n_spans, sha of the rest); rows of one id
    may be taken in either order, so their results are compared as a multiset."""
    seen, out = set(), Counter()
    for id_, text in sorted(rows, key=lambda r: order(r[0])):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        rest = bytes(c for c, f in zip(b, gone, strict=True) if not f)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[id_, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()] += 1
    return out
