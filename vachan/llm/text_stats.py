"""Per-document word statistics, computed on whole Arrow batches with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from vachan.llm.common import SPACE, Spans, mix, per_row, slices, words

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeats(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(occurs more than once, has an equal before it) for each entry, in order."""
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key) + 1, bool)
    k = key[order]
    same[1:-1] = k[1:] == k[:-1]
    later, many = np.empty(len(key), bool), np.empty(len(key), bool)
    later[order] = same[:-1]
    many[order] = same[:-1] | same[1:]
    return many, later


def stats(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """STATS of each document of a flat buffer; all of them are int64."""
    n = len(off) - 1
    start, end, first = words(data, off)
    count = np.diff(first)
    out = {"n_words": count}
    out["word_chars"] = per_row(((data & 0xC0) != 0x80) & ~SPACE[data], off)
    out["n_symbols"] = per_row(SYMBOL[data], off)
    spans = Spans(data)
    # lines: cut at \n and at the ends of documents
    cuts = np.union1d(np.flatnonzero(data == 10) + 1, off)
    line_start = cuts[:-1][cuts[:-1] < len(data)]
    line_end = cuts[1:][:len(line_start)]
    doc = np.searchsorted(off, line_start, "right") - 1
    stop = line_end - (data[line_end - 1] == 10)
    seen = np.zeros(len(data) + 1, np.int64)
    seen[start + 1] = 1
    np.cumsum(seen, out=seen)
    filled = seen[stop] > seen[line_start]
    line_start, stop, doc = line_start[filled], stop[filled], doc[filled]
    out["n_lines"] = np.bincount(doc, minlength=n)
    salt = mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    _, later = repeats(mix(spans.hash(line_start, stop) ^ salt[doc]))
    out["n_dup_lines"] = np.bincount(doc[later], minlength=n)
    # windows of three words within a document
    out["n_repeat_words"] = np.zeros(n, np.int64)
    if len(start) >= 3:
        h = spans.hash(start, end)
        owner = np.repeat(np.arange(n), count)
        inside = owner[2:] == owner[:-2]
        w = mix(mix(h[:-2] ^ salt[owner[:-2]]) * np.uint64(3) + h[1:-1])
        w = mix(w * np.uint64(5) + h[2:])
        at = np.flatnonzero(inside)
        many, _ = repeats(w[at])
        hit = np.zeros(len(start) + 2, bool)
        at = at[many]
        hit[at] = hit[at + 1] = hit[at + 2] = True
        out["n_repeat_words"] = np.bincount(owner[hit[:len(start)]], minlength=n)
    return {k: v.astype(np.int64) for k, v in out.items()}


def stat_batches(batches, keep: list[str], text_col: str):
    """mapInArrow body: the columns ``keep``, then STATS."""
    for batch in batches:
        for rows, data, off in slices(batch, text_col):
            s = stats(data, off)
            yield pa.RecordBatch.from_arrays([rows.column(c) for c in keep] + [pa.array(s[k]) for k in STATS], names=[*keep, *STATS])
