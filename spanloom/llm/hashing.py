"""Words and shingles of many texts at once, as 64-bit hashes, with numpy over the bytes of an Arrow column.

A word's hash is a sum of its bytes, each times a fixed pseudo-random odd number of its place, then mixed. No Python
string is made. Texts are taken in blocks of about `BLOCK_BYTES`, so working memory follows the block (or the longest
single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
SHINGLE_WORDS = 5
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def places(n: int, seed: int = 1) -> np.ndarray:
    """n fixed odd numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


def _plain_table() -> np.ndarray:
    """Byte to byte: A-Z to a-z, the white space \\x20 \\x09-\\x0D to 0, all else (a NUL too) to itself plus one."""
    table = np.arange(1, 257, dtype=np.uint16)
    table[ord("A") : ord("Z") + 1] += 32
    table[[0x20, *range(0x09, 0x0E)]] = 0
    return table


def _letter_table() -> np.ndarray:
    """As the plain table, but all ASCII except letters separates words."""
    table = _plain_table()
    letters = np.zeros(256, bool)
    letters[ord("a") : ord("z") + 1] = letters[ord("A") : ord("Z") + 1] = letters[128:] = True
    return np.where(letters, table, 0).astype(np.uint16)


def _letter_digit_table() -> np.ndarray:
    """As the letter table, but digits belong to words."""
    table = _letter_table()
    digits = slice(ord("0"), ord("9") + 1)
    table[digits] = _plain_table()[digits]
    return table


PLAIN = _plain_table()
LETTERS = _letter_table()
LETTERS_DIGITS = _letter_digit_table()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes; a longer text has a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last
        first = last


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = PLAIN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of consecutive texts, the n + 1 word offsets of the texts, and the words' start and end bytes."""
    base = int(offsets[0])
    part = table[data[base : int(offsets[-1])]]
    at = offsets - base
    inside = part > 0
    if not inside.any():
        none = np.zeros(0, np.int64)
        return np.zeros(0, _U), np.zeros(len(offsets), np.int64), none, none
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    heads = at[:-1][at[:-1] < len(part)]
    start[heads] = inside[heads]
    starts = np.flatnonzero(start)
    kept = np.flatnonzero(inside)
    firsts = np.searchsorted(kept, starts)
    lengths = np.diff(np.append(firsts, len(kept)))
    place = np.arange(len(kept)) - np.repeat(firsts, lengths)
    with np.errstate(over="ignore"):
        hashed = mix(np.add.reduceat(part[kept].astype(_U) * places(int(lengths.max()))[place], firsts))
    return hashed, np.searchsorted(starts, at), starts + base, starts + lengths + base


def beginnings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: int, table: np.ndarray = PLAIN) -> np.ndarray:
    """Hashes of the first `letters` code points, or all, of the words that lie from `starts` to before `ends`."""
    total, begun, inside = np.zeros(len(starts), _U), np.zeros(len(starts), np.int64), np.ones(len(starts), bool)
    factor = places(4 * letters)
    with np.errstate(over="ignore"):
        for k in range(4 * letters):
            byte = data[np.minimum(starts + k, len(data) - 1)]
            begun += (byte & 0xC0) != 0x80
            inside &= (starts + k < ends) & (begun <= letters)
            if not inside.any():
                break
            total += np.where(inside, table[byte].astype(_U) * factor[k], _U(0))
        return mix(total)


def ngrams(hashed: np.ndarray, n: int, seed: int = 2) -> np.ndarray:
    """The hash of the n words from each place on; empty if there are fewer."""
    if len(hashed) < n:
        return np.zeros(0, _U)
    factor = places(n, seed)
    last = len(hashed) - n + 1
    with np.errstate(over="ignore"):
        total = np.full(last, n, _U)
        for k in range(n):
            total += hashed[k : k + last] * factor[k]
        return mix(total)


def shingle_sets(column: pa.Array, n: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """Per text, its distinct n-word shingles in ascending order; fewer words count as one shingle, none as none."""
    data, offsets = text_bytes(column)
    for first, last in blocks(offsets):
        hashed, at, _, _ = words(data, offsets[first : last + 1])
        whole = ngrams(hashed, n)
        for a, b in zip(at[:-1], at[1:], strict=True):
            if b - a >= n:
                yield np.unique(whole[a : b - n + 1])
            else:
                yield ngrams(hashed[a:b], b - a) if b > a else np.zeros(0, _U)
