"""Periodic runs of words by online dyadic square catching (op 11).

A run is a maximal stretch of words with smallest period q that is at least
``times`` periods (and ``least`` words) long.

Per level the words are cut into blocks of B = 1, 2, 4, .. words.  The catcher of a
completed block looks for it among the suffixes that the following words
complete: a word at distance d = B .. 2B - 1 after the block's own place ends
one comparison of hashes, and each place has one catcher a level, that of the
block before it.  A hit is a square's beginning; hits of consecutive blocks at
the same distance are caught together, and what they cover is extended word
by word to both sides until a word differs: squares merge into the run with
period d.  A stretch inside a run of a lower level repeats that run's period and
is left out.  A run of four periods holds two consecutive blocks of its level,
so single hits need no look; one of three periods may hold a single one.

All documents of a slice are handled at once as one array, each closed by a word
of its own; documents too short for a level leave it.  Work is O(words x
levels).  Hashes choose, words decide: runs are compared word by word, and a
document in which two words share a hash is worked again on numbered words.

Defined results: a null or empty text has no words, no runs and an empty
collapsed text; a null id changes nothing; rows that repeat an id are worked
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vachan.llm.common import Spans, mix, modest_batches, slices, words

LEAST = 6
TIMES = 4

RUNS = "array<struct<start:long,length:long,period:long>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def contained(start: np.ndarray, end: np.ndarray, runs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether each [start, end) lies inside one of the runs (their starts ascending,
    with the greatest end so far)."""
    first, reach = runs
    if not len(first):
        return np.zeros(len(start), bool)
    k = np.searchsorted(first, start, "right") - 1
    return (k >= 0) & (reach[np.maximum(k, 0)] >= end)


def stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of each run of True."""
    edge = np.diff(np.concatenate([[0], equal.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def catch(word: np.ndarray, off: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, ordered; ``word`` holds a number of
    each word, documents lie at ``off``; ``times`` is 3 at least."""
    count = np.diff(off)
    docs = len(count)
    # documents one after another, each with a closing word that occurs nowhere else
    begin = off[:-1] + np.arange(docs)
    flat = np.empty(len(word) + docs, np.uint64)
    closing = np.zeros(len(flat), bool)
    closing[off[1:] + np.arange(docs)] = True
    flat[~closing] = word
    flat[closing] = mix(np.arange(docs, dtype=np.uint64) + np.uint64(0xA0761D6478BD642F))
    place, owner = np.arange(len(flat)), np.repeat(np.arange(docs), count + 1)
    code, size = flat.copy(), 1
    known = np.zeros((0, 2), np.int64)  # places of all squares merged so far
    out: list[tuple[int, int, int, int]] = []
    while True:
        stay = count >= max(least, times * size)
        if not stay.any():
            break
        if not stay[owner].all():  # short documents leave
            keep = stay[owner]
            code, flat, place, owner = code[keep[:len(code)]], flat[keep], place[keep], owner[keep]
        m = len(code)
        # place i against the last completed block before it: distance size + i % size
        block = np.repeat(code[::size], size)[:max(0, m - size)]
        hit = code[size:] == block
        both = hit.copy() if times < 4 else np.zeros(len(hit), bool)
        if times >= 4 and len(hit) > size:
            pair = hit[:-size] & hit[size:]
            both[:-size] |= pair
            both[size:] |= pair
        at = np.flatnonzero(both)
        if len(at):
            shift, number = at % size, at // size
            order = np.lexsort((number, shift))
            shift, number = shift[order], number[order]
            new = np.ones(len(at), bool)
            new[1:] = (shift[1:] != shift[:-1]) | (number[1:] != number[:-1] + 1)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(at)) - 1
            x, y, d = number[first] * size, (number[last] + 1) * size, shift[first] + size
            by = np.argsort(known[:, 0], kind="stable")
            runs = known[by, 0], np.maximum.accumulate(known[by, 1]) if len(by) else by
            todo = ~contained(place[x], place[x] + (y - x) + d, runs)
            fresh = []
            for a, z, p in zip(x[todo].tolist(), y[todo].tolist(), d[todo].tolist(), strict=True):
                lo, hi = max(0, a - size), min(z + size, len(flat) - p)
                s, e = stretches(flat[lo:hi] == flat[lo + p:hi + p])
                for u, v in zip((s + lo).tolist(), (e + lo).tolist(), strict=True):
                    if v - u >= 2 * size and v > a and u < z:
                        fresh.append((int(place[u]), int(place[u]) + v - u + p))
                        if v - u + p >= max(least, times * p):
                            out.append((int(owner[u]), int(place[u]), v - u + p, p))
            if fresh:
                known = np.concatenate([known, np.array(fresh, np.int64)])
        if m <= size:
            break
        code = code[:-size] * np.uint64(0x9FB21C651E98DF25) + code[size:]
        code ^= code >> np.uint64(29)
        code *= np.uint64(0xD6E8FEB86659FD93)
        size *= 2
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    found = np.array(sorted(set(out), key=lambda r: (r[0], r[1], r[3])), np.int64)
    doc, start, length, period = found.T
    return doc, start - begin[doc], length, period


def exact(text: list[bytes], least: int, times: int) -> list[tuple[int, int, int]]:
    """Runs of one document on numbered words."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in text], np.uint64)
    _, start, length, period = catch(mix(ids + np.uint64(1)), np.array([0, len(ids)]), least, times)
    return list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))


def collapse(text: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, joined by spaces: of each run its first period stays."""
    gone = np.zeros(len(text) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    covered = np.cumsum(gone)[:-1] > 0
    return b" ".join(w for w, g in zip(text, covered.tolist(), strict=True) if not g)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES,
         rewrite: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed) for every row of ``docs``: runs ordered by start, then
    period; ``collapsed`` is the text with each run cut to its first period.

    ``rewrite(id, n)`` may give, for a document of n words, the numbers of the words to
    be read instead of 0 .. n - 1 (None: as they stand).
    """
    def run(batches):
        for batch in batches:
            for rows, data, off in slices(batch, "text"):
                start, end, first = words(data, off)
                code = Spans(data).hash(start, end)
                ids = rows.column("id").to_pylist()
                read = [rewrite(i, int(n)) if rewrite else None for i, n in zip(ids, np.diff(first), strict=True)]
                for k, r in enumerate(read):
                    if r is not None:
                        code[first[k]:first[k + 1]] = code[first[k]:first[k + 1]][r]
                doc, s, n, p = catch(code, first, least, times)
                cut = np.searchsorted(doc, np.arange(len(ids) + 1))
                raw = data.tobytes()
                runs, left = [], []
                for k, r in enumerate(read):
                    text = raw[off[k]:off[k + 1]].split()
                    if r is not None:
                        text = [text[j] for j in r.tolist()]
                    own = list(zip(*(x[cut[k]:cut[k + 1]].tolist() for x in (s, n, p)), strict=True))
                    if any(text[a:a + length - q] != text[a + q:a + length] for a, length, q in own):
                        own = exact(text, least, times)
                    runs.append([{"start": a, "length": length, "period": q} for a, length, q in own])
                    left.append(collapse(text, own) if own else b" ".join(text))
                yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(np.diff(first), pa.int64()), pa.array(runs, _RUNS), pa.array(left, pa.binary()).cast(pa.string())],
                                                 names=["id", "n_words", "runs", "collapsed"])

    d = modest_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, f"id long, n_words long, runs {RUNS}, collapsed string")
