"""Exact token ids of whole texts, with the work of a repeated word done once.

Both vocabularies split a text at white space before anything else, so a text
may be cut before a run of white space that follows another character (and
after a lone line end) without changing any id.  Both then part letters, digits
and other characters, so a text may also be cut between an ASCII letter or
digit and one of STOPS, which no special token and no contraction contains.
The pieces of a slice of documents are dictionary-encoded by Arrow; only
distinct pieces that this worker has not met go through the tokenizers
library, and ids are put together again by whole-array gathers.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vachan.llm.common import SPACE

CACHE_PIECES = 1_500_000  # pieces that a worker remembers; above, it starts anew
TOKEN_SLICE = 8 << 20  # bytes of text per call; longer slices repeat more words
GROUP = 100  # new pieces per call of the library

STOPS = np.zeros(256, bool)
STOPS[list(b'.,;:!?)"]')] = True
WORD = np.zeros(256, bool)
WORD[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True

_ENCODERS: dict[str, "Encoder"] = {}


def spaces(data: np.ndarray) -> np.ndarray:
    """Bytes of white space characters, those beyond ASCII included."""
    gap = SPACE[data]
    if len(data) < 2:
        return gap
    a, b = data[:-1], data[1:]
    two = np.flatnonzero((a == 0xC2) & ((b == 0x85) | (b == 0xA0)))
    gap[two] = gap[two + 1] = True
    lead = np.flatnonzero((data[:-2] == 0xE1) | (data[:-2] == 0xE2) | (data[:-2] == 0xE3)) if len(data) > 2 else two[:0]
    code = (data[lead].astype(np.int64) & 15) << 12 | (data[lead + 1].astype(np.int64) & 63) << 6 | (data[lead + 2].astype(np.int64) & 63) if len(lead) else lead
    wide = lead[np.isin(code, [0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])]
    gap[wide] = gap[wide + 1] = gap[wide + 2] = True
    return gap


def cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Ends of pieces (and the first start): where a text may be cut, and the documents' ends."""
    n = len(data)
    at = np.zeros(n + 1, bool)
    at[off] = True
    at[1:n] |= STOPS[data[1:]] & WORD[data[:-1]]
    if n > 2:
        plain, gap = SPACE[data], spaces(data)
        at[1:n] |= plain[1:] & ~gap[:-1]
        lone = plain[1:-1] & (data[1:-1] != 32) & ~gap[:-2] & ~gap[2:]
        at[2:n] |= lone
    return np.flatnonzero(at)


class Encoder:
    """Encodes slices of documents; keeps the ids of pieces it has met."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.path, self.single = path, None
        # a special token is a wall: what stands on its sides is encoded on its own
        self.walled = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self.walled.get_added_tokens_decoder().items() if t.special}
        self.names = list(special)
        self.wall, self.wall_id = next(iter(special.items()), ("", -1))
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.binary())  # pieces in the order of their slots
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1, np.int64)
        self.used = 0

    def learn(self, pieces: pa.Array) -> np.ndarray:
        """Encode new pieces, many of them in one call with walls between; return their slots."""
        text = pieces.cast(pa.string())
        odd = np.full(len(text), not self.wall)
        for name in self.names:
            odd |= pc.match_substring(text, name).to_numpy(zero_copy_only=False)
        order = np.argsort(odd, kind="stable")
        plain, special = (text.take(pa.array(np.flatnonzero(x))).to_pylist() for x in (~odd, odd))
        slots = np.empty(len(text), np.int64)
        slots[order] = len(self.known) + np.arange(len(text))
        self.known = pa.concat_arrays([self.known, pieces.take(pa.array(order))])
        joined = [self.wall.join(plain[i:i + GROUP]) + self.wall for i in range(0, len(plain), GROUP)]
        found = [np.array(e.ids, np.uint32) for e in self.walled.encode_batch_fast(joined, add_special_tokens=False)]
        if found:
            ids = np.concatenate(found)
            walls = np.flatnonzero(ids == self.wall_id)
            self.append(np.diff(walls, prepend=-1) - 1, np.delete(ids, walls))
        if special:
            if self.single is None:
                from tokenizers import Tokenizer

                self.single = Tokenizer.from_file(self.path)
                self.single.encode_special_tokens = True  # their strings in a text are ordinary text
            single = [e.ids for e in self.single.encode_batch_fast(special, add_special_tokens=False)]
            lens = np.fromiter(map(len, single), np.int64, len(single))
            self.append(lens, np.fromiter((i for x in single for i in x), np.uint32, int(lens.sum())))
        return slots

    def append(self, lens: np.ndarray, new: np.ndarray) -> None:
        while self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(new)] = new
        self.start = np.concatenate([self.start, self.used + np.cumsum(lens)])
        self.used += len(new)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a slice, one after another, and their offsets."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        if len(self.known) > CACHE_PIECES:
            self.clear()
        at = cuts(data, off)
        pieces = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        slots = pc.index_in(pieces.dictionary, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = self.learn(pieces.dictionary.take(pa.array(new)))
        slots = slots[pieces.indices.to_numpy()]
        begin = self.start[slots]
        lens = self.start[slots + 1] - begin
        end = np.cumsum(lens)
        ids = self.flat[np.repeat(begin - (end - lens), lens) + np.arange(end[-1])]
        return ids, np.concatenate([[0], end])[np.searchsorted(at, off)]


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def largest_id(path: str) -> int:
    """Largest id of a vocabulary, added tokens included."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values())
