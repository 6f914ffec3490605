"""E5/E7/E8 kernels: many word alignments at once, in memory linear in the words.

Tokens are numbered by their order, and pairs of similar length are laid side by
side in padded arrays: a row of the dynamic program is a few whole-array steps
for all of them, and so is a step of the way back.

Ties prefer diagonal, then deletion, then insertion, followed from the end.
Directions are kept for a band of rows only.  If the rows of a batch don't fit
(``BAND_BYTES``), the distances at the bands' edges are kept instead, and each
band's directions are worked out again when the way back gets there, in bands
of bands where needed: memory is a few rows of distances per depth, however
long the texts are.
"""

from __future__ import annotations

import numpy as np

DIAGONAL, DELETION, INSERTION, NONE = 0, 1, 2, 255
BAND_BYTES = 8 << 20
EDGES = 32  # distance rows kept per depth


def _distance_type(words: int) -> type:
    return np.int16 if words < 30_000 else np.int32


def _lowest_so_far(x: np.ndarray) -> np.ndarray:
    """Running minimum down the first axis, in whole-array steps of 1, 2, 4, ...;
    ``np.minimum.accumulate`` along that axis goes entry by entry.  ``x`` is overwritten."""
    other, step = np.empty_like(x), 1
    while step < len(x):
        other[:step] = x[:step]
        np.minimum(x[step:], x[:-step], out=other[step:])
        x, other, step = other, x, 2 * step
    return x


def _rows(ref: np.ndarray, hyp: np.ndarray, above: np.ndarray, lo: int, hi: int, steps: np.ndarray | None, edges: list | None, each: int) -> np.ndarray:
    """Distances of row ``hi`` from those of row ``lo``; fills ``steps`` with directions, or
    ``edges`` with every ``each``-th row.  A row is (hypothesis words + 1, pairs)."""
    ar = np.arange(len(above), dtype=above.dtype)[:, None]
    for i in range(lo, hi):
        if edges is not None and (i - lo) % each == 0:
            edges.append(above)
        both = above[:-1] + (hyp != ref[i])
        drop = above[1:] + above.dtype.type(1)
        here = np.empty_like(above)
        here[0] = i + 1
        np.minimum(both, drop, out=here[1:])
        here -= ar
        here = _lowest_so_far(here)
        here += ar
        if steps is not None:
            now = here[1:]
            off = now != both
            steps[i - lo, 0] = DELETION
            steps[i - lo, 1:] = off
            steps[i - lo, 1:] += off & (now != drop)
        above = here
    return above


def _back(ref, hyp, above, lo, hi, r, h, out) -> None:
    """Follow every pair that stands in rows lo + 1 .. hi back to row ``lo``; ``r`` and ``h``
    are moved, steps are appended to ``out``."""
    width = int(h.max(initial=0))  # nothing lies to the right of where a pair stands
    hyp, above = hyp[:width], above[:width + 1]
    n = len(r)
    if hi - lo > 1 and (hi - lo) * n * (width + 1) > BAND_BYTES:
        bands = min(EDGES, -(-(hi - lo) * n * (width + 1) // BAND_BYTES), hi - lo)
        each = -(-(hi - lo) // bands)
        edges: list[np.ndarray] = []
        _rows(ref, hyp, above, lo, lo + (hi - lo - 1) // each * each + 1, None, edges, each)
        for b in range(len(edges) - 1, -1, -1):
            _back(ref, hyp, edges.pop(), lo + b * each, min(hi, lo + (b + 1) * each), r, h, out)
        return
    steps = np.empty((hi - lo, width + 1, n), np.uint8)
    _rows(ref, hyp, above, lo, hi, steps, None, 0)
    while True:
        own = np.flatnonzero(r > lo)
        if not len(own):
            return
        c = steps[r[own] - lo - 1, h[own], own]
        step = np.full(n, NONE, np.uint8)
        step[own] = c
        out.append(step)
        r[own] -= c != INSERTION
        h[own] -= c != DELETION


def align(ref: np.ndarray, hyp: np.ndarray, rlen: np.ndarray, hlen: np.ndarray) -> np.ndarray:
    """Steps of each pair in order, one row a pair, with NONE between them.

    ``ref`` and ``hyp`` hold token numbers, one row a pair, padded with values that
    match nothing.
    """
    n, words = len(ref), ref.shape[1] + hyp.shape[1]
    r, h, out = rlen.astype(np.int64), hlen.astype(np.int64), []
    if n and ref.shape[1]:
        # pairs side by side: a step of the program runs along memory
        above = np.repeat(np.arange(hyp.shape[1] + 1, dtype=_distance_type(words))[:, None], n, axis=1)
        _back(np.ascontiguousarray(ref.T), np.ascontiguousarray(hyp.T), above, 0, ref.shape[1], r, h, out)
    for k in range(int(h.max(initial=0))):  # what is left of the hypothesis stands before the reference
        out.append(np.where(h > k, INSERTION, NONE).astype(np.uint8))
    return np.ascontiguousarray(np.array(out[::-1], np.uint8).reshape(len(out), n).T)


def padded(flat: np.ndarray, off: np.ndarray, rows: np.ndarray, fill: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequences ``rows`` of a flat array as one array, and their lengths."""
    size = off[rows + 1] - off[rows]
    out = np.full((len(rows), int(size.max(initial=0))), fill, np.int32)
    inside = np.arange(out.shape[1]) < size[:, None]
    at = np.repeat(off[rows], size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[inside] = flat[at]
    return out, size


def batches(rlen: np.ndarray, hmax: np.ndarray, pairs: np.ndarray, limit: int = BAND_BYTES):
    """Numbers of segments of similar size that fit in one band together (one at least)."""
    order = np.lexsort((hmax, rlen))
    a = 0
    while a < len(order):
        b, wide, most = a, 0, 0
        while b < len(order):
            s = order[b]
            wide, most = max(wide, int(hmax[s])), most + int(pairs[s])
            if b > a and (int(rlen[s]) + 1) * (wide + 1) * most > limit:
                break
            b += 1
        yield order[a:b]
        a = b


def lattice(tokens: np.ndarray, empty: np.ndarray, free: np.ndarray, count: np.ndarray, owner: np.ndarray, hyp: np.ndarray, hlen: np.ndarray) -> np.ndarray:
    """Least edits of each hypothesis against its segment's bins.

    ``tokens`` (segments, bins, most tokens) padded with -3, ``empty`` whether a bin may be
    skipped before any word at no cost, ``free`` whether anywhere, ``count`` bins
    per segment, ``owner`` the segment of each hypothesis.
    """
    width = hyp.shape[1]
    kind = _distance_type(width + tokens.shape[1])
    ar = np.arange(width + 1, dtype=kind)[:, None]
    prev = np.repeat(ar, len(hyp), axis=1)
    out = np.zeros(len(hyp), np.int64)
    rows, said = np.arange(len(hyp)), np.ascontiguousarray(hyp.T)
    for i in range(tokens.shape[1]):
        t = np.empty_like(prev)
        t[0] = prev[0] + ~empty[owner, i]
        if width:
            miss = said != tokens[owner, i, 0]
            for w in range(1, tokens.shape[2]):
                more = tokens[:, i, w]
                if (more < 0).all():
                    break
                miss &= said != more[owner]
            np.minimum(prev[:-1] + miss, prev[1:] + ~free[owner, i], out=t[1:])
        t -= ar
        t = _lowest_so_far(t)
        t += ar
        prev = t
        done = count[owner] == i + 1
        out[done] = prev[hlen[done], rows[done]]
    return out
