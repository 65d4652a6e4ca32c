"""Words of Arrow text columns as 64-bit hashes, computed with numpy over the UTF-8 bytes.

A word is a maximal run of bytes other than space and ``\\t \\n \\v \\f \\r`` (the pattern ``[^\\x20\\x09-\\x0D]+``).
The hash is a polynomial over per-byte random values modulo 2**64, read off two prefix sums per word and then
mixed, so a batch costs a few vector passes whatever its number of words.  Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19  # texts are hashed about half a megabyte at a time; a longer text is a chunk of its own

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_PUNCTUATED = _SPACE.copy()
_PUNCTUATED[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
#: Everything but ASCII letters and digits and the bytes of other characters separates.
TERM_BREAKS = np.zeros(256, dtype=bool)
TERM_BREAKS[[b for b in range(128) if not chr(b).isalnum()]] = True
_BASE = 0x9E3779B97F4A7C13 | 3
_COMBINE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class _Powers:
    """B**i and B**-i modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            up = np.full(size, _BASE, dtype=np.uint64)
            down = np.full(size, pow(_BASE, -1, 2**64), dtype=np.uint64)
            up[0] = down[0] = 1
            up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
            if size > 8 * CHUNK_BYTES:  # a very long text: not kept for the rest of the task
                return up, down
            self.up, self.down = up, down
        return self.up, self.down


_POWERS = _Powers()
powers = _POWERS.upto


@dataclass
class Words:
    """The words of consecutive rows: row ``first + i`` owns words ``offsets[i]:offsets[i + 1]``."""

    first: int
    hashes: np.ndarray  # uint64, one per word
    starts: np.ndarray  # byte offset of each word in the chunk
    ends: np.ndarray
    offsets: np.ndarray  # int64, rows + 1
    data: np.ndarray  # the chunk's bytes
    rows: np.ndarray  # byte offset of each row in the chunk, rows + 1

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word windows that stay inside a row, and the offsets of each row's windows."""
        counts = np.maximum(np.diff(self.offsets) - (n - 1), 0)
        offsets = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(offsets[-1]) + np.repeat(self.offsets[:-1] - offsets[:-1], counts)
        return window_hashes(self.hashes, at, n), offsets


def window_hashes(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """One hash for each n-word window starting at the given word positions."""
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        out += hashes[at + k] * _COMBINE[k % 64]
        if k % 64 == 63:
            out = mix(out)
    return mix(out)


def row_chunks(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``chunk_bytes``: (first row, bytes, row offsets into them)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if len(texts) == 0:
        return
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + chunk_bytes, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(texts: pa.Array, fold: bool = True, punctuation: bool = True, chunk_bytes: int = CHUNK_BYTES, separates: np.ndarray | None = None) -> Iterator[Words]:
    """The words of every row; with ``fold`` A-Z hash as a-z, without ``punctuation`` ASCII punctuation ends words too.

    ``separates`` gives for each byte whether it ends words, in place of these two sets.
    """
    table = _FOLDED if fold else _BYTE
    if separates is None:
        separates = _SPACE if punctuation else _PUNCTUATED
    for first, data, rows in row_chunks(texts, chunk_bytes):
        n = len(data)
        inside = np.zeros(n + 2, dtype=bool)
        np.logical_not(separates[data], out=inside[1 : n + 1])
        begins = inside[1 : n + 1] & ~inside[:n]
        stops = inside[1 : n + 1] & ~inside[2:]
        edge = rows[1:-1]
        edge = edge[(edge > 0) & (edge < n)]  # a word never runs over the end of its row
        begins[edge] = inside[edge + 1]
        stops[edge - 1] = inside[edge]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        up, down = _POWERS.upto(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(table[data] * up[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        yield Words(first, hashes, starts, ends, np.searchsorted(starts, rows), data, rows)


def shingle_sets(chunk: Words, n: int) -> Iterator[np.ndarray]:
    """Each row's distinct n-word shingles, sorted; with fewer words the whole sequence as one; empty without words."""
    hashes, offsets = chunk.windows(n)
    for i in range(len(chunk)):
        own = hashes[offsets[i] : offsets[i + 1]]
        if len(own):
            yield np.unique(own)
            continue
        a, b = chunk.offsets[i], chunk.offsets[i + 1]
        if b > a:
            yield window_hashes(chunk.hashes, np.array([a]), int(b - a)) + np.uint64(b - a)
        else:
            yield own
