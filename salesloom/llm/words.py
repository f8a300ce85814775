"""Words of many texts at once, as numpy arrays over one Arrow buffer.

A batch of texts is one byte buffer; words are found by looking bytes up in a table, and hashed
with one running polynomial sum, so that no Python object exists per word. Both word rules of
this package are decided by ASCII bytes alone, which never occur inside a longer UTF-8 sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256, dtype=np.uint8)
_SPACES = np.isin(_BYTES, [0x20, *range(0x09, 0x0E)])
#: Bytes of words that spaces part: [^\x20\x09-\x0D]+
SPACED = ~_SPACES
#: Bytes of words of letters and digits: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z.
LETTERS = (
    (_BYTES >= 0x80)
    | ((_BYTES >= ord("0")) & (_BYTES <= ord("9")))
    | ((_BYTES >= ord("a")) & (_BYTES <= ord("z")))
    | ((_BYTES >= ord("A")) & (_BYTES <= ord("Z")))
)
_LOWER = np.where((_BYTES >= ord("A")) & (_BYTES <= ord("Z")), _BYTES + 32, _BYTES).astype(np.uint8)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BLOCK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


_POWERS = (_powers(_BASE, _BLOCK), _powers(_BASE_INVERSE, _BLOCK))


def _hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; equal bytes give equal hashes wherever they stand."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _BLOCK, side="right")))
        a, n = int(start[i]), int(end[j - 1] - start[i])
        up, down = _POWERS if n <= _BLOCK else (_powers(_BASE, n), _powers(_BASE_INVERSE, n))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data[a : a + n].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        out[i:j] = (sums[end[i:j] - a] - sums[start[i:j] - a]) * down[start[i:j] - a]
        i = j
    return mix(out + (end - start).astype(np.uint64) * _STEP)


@dataclass
class Words:
    """The words of consecutive texts: hash and byte span of each, and their number per text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Place of each text's first word."""
        return np.cumsum(self.counts) - self.counts

    @property
    def owner(self) -> np.ndarray:
        """Text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k consecutive words, and which of them lie within one text."""
        n = max(0, len(self.hashes) - k + 1)
        total = self.hashes[:n].copy()
        for j in range(1, k):
            total *= _STEP
            total += self.hashes[j : j + n]
        inside = np.zeros(len(self.hashes), bool)
        left = np.repeat(self.first + self.counts, self.counts) - np.arange(len(self.hashes))
        inside[left >= k] = True
        return mix(total + np.uint64(k)), inside[:n]

    def text(self, i: int, j: int) -> str:
        """The words from i to before j, joined by a space."""
        return b" ".join(
            self.data[a:b].tobytes() for a, b in zip(self.start[i:j].tolist(), self.end[i:j].tolist(), strict=True)
        ).decode("utf-8", "replace")


def find_words(texts: pa.Array, inside: np.ndarray, lower: bool) -> Words:
    """Words of the texts. NULL has none; `inside` is SPACED or LETTERS; `lower` turns A-Z into a-z."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    word = inside[data]
    before, after = np.zeros_like(word), np.zeros_like(word)
    before[1:], after[:-1] = word[:-1], word[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    start = np.flatnonzero(word & ~before)
    end = np.flatnonzero(word & ~after) + 1
    counts = np.diff(np.searchsorted(start, offsets))
    return Words(data, start, end, _hash_words(data, start, end), counts)


def slices(batch: pa.RecordBatch | pa.Table, column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most `most_bytes` of text (a longer text is a piece by itself)."""
    if isinstance(batch, pa.Table):
        for part in batch.to_batches():
            yield from slices(part, column, most_bytes)
        return
    if not batch.num_rows:
        return
    texts = batch.column(column).cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + most_bytes, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j
