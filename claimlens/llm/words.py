"""Words, lines and n-grams of Arrow string columns, hashed with numpy.

A batch of texts is one byte buffer plus offsets, so a whole batch is cut and
hashed by array operations. Words are maximal runs of bytes other than space
and 0x09-0x0D; these bytes never occur inside a multi-byte UTF-8 character.
Hashes have 64 bits and depend on the content alone.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
# texts are worked through in pieces of about this many bytes (one text at least)
PIECE_BYTES = 2 << 20

# odd multipliers with P % 4 == 3, so that P - 1 has a single factor 2
BYTE_BASE = 0x9E3779B97F4A7C17 | 3
WORD_BASE = 0xC2B2AE3D27D4EB4F | 3

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError, TypeError):
    _trim = None


def release() -> None:
    """Give freed memory back to the system; workers live on between tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64)."""
    x = x + U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, int(n - 1).bit_length())
            self.up, self.down = self._run(self.base, size), self._run(self.inverse, size)
        return self.up[:n], self.down[:n]

    @staticmethod
    def _run(base: int, size: int) -> np.ndarray:
        out = np.ones(size, U64)
        filled = 1
        while filled < size:
            step = U64(pow(base, filled, 1 << 64))
            out[filled : 2 * filled] = out[:filled] * step
            filled *= 2
        return out


_byte_powers, _word_powers = Powers(BYTE_BASE), Powers(WORD_BASE)


def spans(values: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash; see ``span_hash``."""
    up, down = powers.upto(len(values) + 1)
    prefix = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[:-1], out=prefix[1:])
    return prefix, down


def span_hash(prefix: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end], wherever it stands."""
    inner = (prefix[end] - prefix[start]) * down[start]
    return mix(inner ^ ((end - start).astype(U64) * U64(0xD6E8FEB86659FD93)))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as the empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``flat`` with A-Z in lower case."""
    data, offsets = flat(texts)
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5), offsets


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of ``column`` each."""
    if not batch.num_rows:
        return
    _, offsets = flat(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


class Texts:
    """The words of some texts: ``hash`` of each, ``first`` word of each text (n + 1 entries)."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        data, offsets = lowered(texts) if lower else flat(texts)
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1
        space = SPACE[data]
        self.space = space
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.ones(len(data), bool)
        before[1:] = space[:-1]
        after = np.ones(len(data), bool)
        after[:-1] = space[1:]
        word = ~space
        self.start = np.flatnonzero(word & (before | edge[:-1]))
        self.end = np.flatnonzero(word & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.n_words = np.diff(self.first)
        self._prefix, self._down = spans(BYTE_VALUE[data], _byte_powers)
        self.hash = span_hash(self._prefix, self._down, self.start, self.end)

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte spans."""
        return span_hash(self._prefix, self._down, start, end)

    def owner(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(self.n), self.n_words)

    def code_points(self) -> np.ndarray:
        return per_text((self.data & 0xC0) != 0x80, self.offsets)

    def spaces(self) -> np.ndarray:
        return per_text(self.space, self.offsets)

    def grams(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of all runs of ``length`` words inside one text."""
        return grams(self.hash, self.first, length)

    def shingles(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of the word n-grams; a shorter text with a word is one gram of its own."""
        at, value = self.grams(length)
        owner = self.owner()[at] if len(at) else np.zeros(0, np.int64)
        short = np.flatnonzero((self.n_words > 0) & (self.n_words < length))
        if len(short):
            prefix, down = spans(self.hash, _word_powers)
            own = span_hash(prefix, down, self.first[short], self.first[short + 1])
            owner, value = np.concatenate([owner, short]), np.concatenate([value, own])
        return owner, value


def grams(hashes: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every run of ``length`` values that stays inside one text."""
    total = len(hashes)
    if total < length:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    ok = np.ones(total, bool)
    for back in range(1, length):
        last = first[1:] - back
        ok[last[last >= first[:-1]]] = False
    start = np.flatnonzero(ok)
    prefix, down = spans(hashes, _word_powers)
    return start, span_hash(prefix, down, start, start + length)


def run_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of every run values[start:end], from all its values."""
    prefix, down = spans(values, _word_powers)
    return span_hash(prefix, down, start, end)


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    running = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=running[1:])
    return np.diff(running[offsets])


def repeats(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Copies of (owner, value) among the entries, which stand in order.

    Returns two flags per entry, "occurs twice or more" and "has occurred before",
    then the first entry and the size of each group of copies.
    """
    key = value ^ mix(owner.astype(U64))
    ranked = np.sort(key)
    shared = ranked[1:][ranked[1:] == ranked[:-1]]
    twice = np.zeros(len(key), bool)
    if not len(shared):
        return twice, twice.copy(), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # few keys are shared as a rule: a bit table drops most of the others
    table = np.zeros(1 << 16, bool)
    table[shared >> U64(48)] = True
    some = np.flatnonzero(table[key >> U64(48)])
    some = some[np.argsort(key[some], kind="stable")]
    ranked = key[some]
    same = np.zeros(len(some), bool)
    same[1:] = ranked[1:] == ranked[:-1]
    later = np.zeros(len(key), bool)
    later[some] = same
    head = np.flatnonzero(~same)
    size = np.diff(np.append(head, len(some)))
    twice[some[same]] = True
    twice[some[head[size > 1]]] = True
    return twice, later, some[head[size > 1]], size[size > 1]
