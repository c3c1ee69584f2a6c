"""Small helpers for tasks that work on whole texts as UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The characters that separate words: space and U+0009 to U+000D. ``bytes.split()`` uses the same six.
SEPARATORS = b" \t\n\x0b\x0c\r"

IS_SEPARATOR = np.zeros(256, dtype=bool)
IS_SEPARATOR[list(SEPARATORS)] = True

#: One 64-bit number per byte value, and an odd base, for hashes of byte ranges. Any random numbers do.
_RANDOM = np.random.default_rng(20240229)
BYTE_CODES = _RANDOM.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts of an Arrow column as bytes; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def sub_batches(batch: pa.RecordBatch, text: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about ``size`` bytes together, so that few become Python objects at a time."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(lengths + 1) - lengths - 1) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def slices(texts: list[bytes], size: int) -> Iterator[tuple[int, int]]:
    """Cut a list of texts into runs ``[first, last)`` of about ``size`` bytes; no text is cut."""
    first, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text) + 1
        if total >= size:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64; the longest so far is kept up to four million."""
    known = _POWERS.get(int(base))
    if known is not None and len(known) >= n:
        return known[:n]
    out = np.full(max(n, 1 << 19), base, dtype=np.uint64)
    out[0] = 1
    out = np.multiply.accumulate(out, dtype=np.uint64)
    if len(out) <= 1 << 22:
        _POWERS[int(base)] = out
    return out[:n]


class RangeHashes:
    """64-bit hashes of byte ranges of one buffer; equal ranges have equal hashes wherever they lie.

    Powers modulo 2**64 are fast, but some regular strings of 512 bytes and more share a hash. Where equality
    decides a result, use ``PrimeRangeHashes``.
    """

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODES[data] * powers(len(data), BASE), dtype=np.uint64, out=self.sums[1:])
        self.undo = powers(len(data) + 1, BASE_INVERSE)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.undo[starts])


#: A prime whose products fit 64 bits, and two bases; two remainders make up a hash.
PRIME = 2**31 - 1
PRIME_BASES = (1_103_515_249, 1_812_433_253)
_PRIME_CODES = tuple((BYTE_CODES >> np.uint64(low)) % np.uint64(PRIME) for low in (0, 32))
_PRIME_POWERS: dict[int, np.ndarray] = {}


def _folded(x: np.ndarray) -> np.ndarray:
    """A smaller number with the same remainder by ``PRIME``."""
    return (x & np.uint64(PRIME)) + (x >> np.uint64(31))


def _remainder(x: np.ndarray) -> np.ndarray:
    x = _folded(_folded(x))
    return np.where(x >= PRIME, x - np.uint64(PRIME), x)


def prime_powers(n: int, base: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo ``PRIME``; the longest so far is kept up to four million."""
    known = _PRIME_POWERS.get(base)
    if known is not None and len(known) >= n:
        return known[:n]
    out = np.ones(max(n, 1 << 19), dtype=np.uint64)
    done = 1
    while done < len(out):
        more = min(done, len(out) - done)
        out[done : done + more] = _remainder(out[:more] * np.uint64(pow(base, done, PRIME)))
        done += more
    if len(out) <= 1 << 22:
        _PRIME_POWERS[base] = out
    return out[:n]


class PrimeRangeHashes:
    """As ``RangeHashes``, by two polynomials modulo a prime: no two ranges are known to share a hash, however regular they are."""

    def __init__(self, data: np.ndarray):
        self.sums, self.undo = [], []
        for base, codes in zip(PRIME_BASES, _PRIME_CODES):
            sums = np.zeros(len(data) + 1, dtype=np.uint64)
            # Below 2**32 each, so that four thousand million of them fit.
            np.cumsum(_folded(codes[data] * prime_powers(len(data), base)), dtype=np.uint64, out=sums[1:])
            self.sums.append(sums)
            self.undo.append(prime_powers(len(data) + 1, pow(base, -1, PRIME)))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        high, low = (_remainder(_remainder(s[ends] - s[starts]) * u[starts]) for s, u in zip(self.sums, self.undo))
        return mixed((high << np.uint64(32)) | low)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class WordRuns:
    """Word borders of several texts at once.

    The texts are joined by line feeds; ``starts`` and ``ends`` are places in that buffer, ``doc`` says which
    text a word is in and ``firsts`` where each text begins.
    """

    def __init__(self, texts: list[bytes], separators: np.ndarray = IS_SEPARATOR):
        self.joined = b"\n".join(texts)
        self.data = np.frombuffer(self.joined, dtype=np.uint8)
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.lengths = lengths
        self.firsts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if len(texts) else np.zeros(0, np.int64)
        inside = np.zeros(len(self.data) + 2, dtype=np.int8)
        np.logical_not(separators[self.data], out=inside[1:-1].view(bool))
        steps = np.diff(inside)
        self.starts = np.flatnonzero(steps == 1)
        self.ends = np.flatnonzero(steps == -1)
        self.doc = np.searchsorted(self.firsts, self.starts, side="right") - 1
        self.words = np.bincount(self.doc, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text have their flag set."""
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[self.firsts + self.lengths] - sums[self.firsts]
