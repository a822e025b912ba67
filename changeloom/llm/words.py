"""Words of a batch of texts as 64-bit numbers, for code inside tasks.

All texts of a batch are laid one after the other and cut at separator bytes. A word's number takes in its
length and then its bytes, eight at a time, each time mixed (a step that no sum or polynomial undoes); words of
more than ``LONG`` bytes are hashed by BLAKE2. Equal words have equal numbers; two different words have equal
ones with a chance of about 2**-64, whatever their pattern. Where that isn't enough, callers compare the bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: blank, tab, line feed, vertical tab, form feed, carriage return
BLANK = tuple(b"\x20\x09\x0a\x0b\x0c\x0d")
#: every ASCII character but 0-9 and a-z (texts are lower-cased before)
NOT_ALNUM = tuple(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122))
#: bytes from which on a word is hashed on its own
LONG = 64
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ROOT = 0x9E3779B97F4A7C15
#: keeps the first k of eight bytes
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (one-to-one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words in order; ``doc`` is the place of a word's text in the batch."""

    data: bytes
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    number: np.ndarray
    first: np.ndarray  # of each text: its first word; one entry more than texts

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]]


def _numbers(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Number of each word data[start:end]."""
    at = np.ndarray((len(data),), "<u8", data + bytes(8), strides=(1,))
    length = end - start
    number = mix(mix(length.astype(np.uint64) + np.uint64(_ROOT)) ^ (at[start] & _MASK[np.minimum(length, 8)]))
    more = np.flatnonzero((length > 8) & (length <= LONG))
    for begin in range(8, LONG, 8):
        more = more[length[more] > begin]
        if not len(more):
            break
        block = at[start[more] + begin] & _MASK[np.minimum(length[more] - begin, 8)]
        number[more] = mix((number[more] ^ block) + np.uint64(_ROOT))
    for i in np.flatnonzero(length > LONG).tolist():
        number[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]], digest_size=8).digest(), "little")
    return number


class WordReader:
    """Turns lists of texts into :class:`Words`; make one for each task."""

    def __init__(self, separators: Sequence[int] = BLANK, lower: bool = False):
        self.is_word = np.ones(256, bool)
        self.is_word[list(separators)] = False
        self.lower = LOWER if lower else None
        if lower:
            self.is_word[65:91] = True

    def __call__(self, texts: Sequence[str | None]) -> Words:
        encoded = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        data = b"\n".join(encoded) + b"\n"
        raw = np.frombuffer(data, np.uint8)
        inside = self.is_word[raw]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.concatenate(([0], edge))
        start, end = edge[0::2], edge[1::2]
        number = _numbers(data.translate(self.lower) if self.lower else data, start, end)
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        begins = np.concatenate(([0], np.cumsum(lengths + 1)))
        first = np.searchsorted(start, begins)
        doc = np.repeat(np.arange(len(texts)), np.diff(first))
        return Words(data, doc, start, end, number, first)


def grams(number: np.ndarray, n: int) -> np.ndarray:
    """Number of each run of n words; entry i is the run that starts at word i."""
    size = max(0, len(number) - n + 1)
    out = np.full(size, n, np.uint64)
    for j in range(n):
        out = mix((out ^ number[j : j + size]) + np.uint64(_ROOT))
    return out


def portions(column: pa.Array, size: int = 1 << 18) -> Iterator[tuple[slice, list[str | None]]]:
    """Consecutive texts of about so many bytes, at least one at a time, and their place in the column."""
    begin = total = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        total += n
        if total >= size or i + 1 == len(column):
            yield slice(begin, i + 1), column.slice(begin, i + 1 - begin).to_pylist()
            begin, total = i + 1, 0
