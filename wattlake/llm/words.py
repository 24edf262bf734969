"""Hashes of all words of a batch of texts, without a Python step per word.

A word is a run of bytes other than white space (or other than what a given table
marks as separating). Its hash sums a random 64-bit number per byte times a power per
position; sums over a prefix of some bytes give every word of them with two look-ups. The
hash does not depend on where a word stands, so long texts are hashed piece by piece, and
take less than sixteen bytes of memory for each of their own.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
WHITE = np.zeros(256, dtype=bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes of texts handled at a time; one longer text is handled alone.
CHUNK_BYTES = 1 << 20

_powers: list[np.ndarray] = []


def scramble(x: np.ndarray) -> np.ndarray:
    """A fixed bijection on 64 bits with well mixed bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        tables = []
        for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[:] = tables
    return _powers


def _word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, piece: int = CHUNK_BYTES) -> np.ndarray:
    """Hash of each word; whole words of ``piece`` bytes are summed at a time."""
    hashes, word = np.empty(len(begins), dtype=np.uint64), 0
    while word < len(begins):
        low = begins[word]
        after = max(int(np.searchsorted(ends, low + piece, side="right")), word + 1)
        size = int(ends[after - 1] - low)
        if size > piece:
            hashes[word] = _long_word(data[low : low + size], piece)
        else:
            up, down = _power_tables(size + 1)
            sums = np.zeros(size + 1, dtype=np.uint64)
            np.cumsum(_BYTES[data[low : low + size]] * up[:size], out=sums[1:])
            start = begins[word:after] - low
            hashes[word:after] = (sums[ends[word:after] - low] - sums[start]) * down[start]
        word = after
    return scramble(hashes)


def _long_word(data: np.ndarray, piece: int) -> np.uint64:
    """Sum of a word longer than a piece."""
    up, total = _power_tables(piece + 1)[0], 0
    for low in range(0, len(data), piece):
        part = data[low : low + piece]
        total += int((_BYTES[part] * up[: len(part)]).sum()) * pow(_MULTIPLIER, low, 1 << 64)
    return np.uint64(total % (1 << 64))


class Words:
    """Words of some texts: hashes, byte positions, and where each text begins."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool, separators: np.ndarray):
        if lower:
            data = _LOWER[data]
        self.data, self.offsets = data, offsets
        inside = ~separators[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        begins[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
        self.begins, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.hashes = _word_hashes(data, self.begins, self.ends)
        #: The words of text i are those from first[i] to first[i + 1].
        self.first = np.searchsorted(self.begins, offsets)

    def word(self, i: int) -> bytes:
        return self.data[self.begins[i] : self.ends[i]].tobytes()


def chunks(
    texts: pa.Array, lower: bool = False, separators: np.ndarray = WHITE, most: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, Words]]:
    """(from, to, words) for consecutive texts of a column, ``most`` bytes or one longer text
    at a time; a null text has no words."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, raw_offsets, raw = texts.buffers()
    offsets = np.frombuffer(raw_offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1
        end = min(max(end, begin + 1), len(texts))
        low, high = offsets[begin], offsets[end]
        yield begin, end, Words(data[low:high], offsets[begin : end + 1] - low, lower, separators)
        begin = end


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words, as many as begin at a word with k - 1 after it."""
    n = max(0, len(hashes) - k + 1)
    total = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        total = total * np.uint64(_MULTIPLIER) + hashes[j : j + n]
    return scramble(total)


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles; fewer words make one shingle, none make none."""
    if not len(hashes):
        return hashes
    return np.unique(grams(hashes, min(k, len(hashes))))
