"""Vectorised text helpers shared by the operators that run numpy in tasks.

A text column arrives as Arrow batches. The helpers look at the UTF-8 bytes of
many texts at once, so that no operator loops over characters or words in
Python. Null texts are read as empty ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words are runs of bytes outside ``[\x20\x09-\x0D]``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes of text that one vectorised step handles; a longer text is its own step.
STEP_BYTES = 2 << 20
#: Rows of one step, so that a row number fits 16 bits.
STEP_ROWS = 60_000
#: Bytes in which the spans begin that are hashed at a time. The tables of powers have twice as many entries,
#: and every worker keeps them, so they must stay small.
DIGEST_BYTES = 1 << 18

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _GOLD)
_BASE = 0x5851F42D4C957F2D
_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, ``n`` or more."""
    have = next(iter(_POWERS.values()), None)
    if have is None or len(have[0]) < n:
        size = max(n, 2 * DIGEST_BYTES + 1)

        def run(b):
            a = np.full(size, b, np.uint64)
            a[0] = 1
            return np.multiply.accumulate(a)
        with np.errstate(over="ignore"):
            have = run(np.uint64(_BASE)), run(np.uint64(_INV))
        if size <= 2 * STEP_BYTES:  # what one very long text needs isn't kept
            _POWERS.clear()
            _POWERS[size] = have
    return have


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for many spans, by prefix sums. For hashed features and filters only:
    arithmetic modulo 2**64 makes some regular texts collide whatever the base; what stands for a text or a word
    takes :func:`word_digests`."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _GOLD)


def large(column: pa.Array) -> pa.LargeStringArray:
    """A text column without nulls and with 64-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def bytes_of(column: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offset at which each begins (and the end)."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0]: at[-1]], at - at[0]


def steps(column: pa.LargeStringArray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes and STEP_ROWS rows (one row at least)."""
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(at, at[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), lo + STEP_ROWS, len(column))
        yield lo, hi
        lo = hi


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = np.zeros(n + 2, bool)
    word[1:-1] = ~SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    cut = cut[:n]
    starts = np.flatnonzero(word[1:-1] & (~word[:-2] | cut))
    last = np.zeros(n, bool)
    last[:-1] = cut[1:]
    ends = np.flatnonzero(word[1:-1] & (~word[2:] | last)) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes; much data is taken in blocks, so that memory stays small."""
    if len(data) <= 2 * DIGEST_BYTES:
        return span_hash(_BYTE[data], starts, ends)
    out = np.empty(len(starts), np.uint64)
    order = np.argsort(starts, kind="stable")
    cuts = np.searchsorted(starts[order], np.arange(0, len(data) + 1 + DIGEST_BYTES, DIGEST_BYTES))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if hi > lo:
            own = order[lo:hi]
            a, b = int(starts[own[0]]), int(ends[own].max())
            out[own] = span_hash(_BYTE[data[a:b]], starts[own] - a, ends[own] - a)
    return out


#: A prime modulus under which different spans rarely share a digest, and a base drawn once at random.
PRIME = (1 << 61) - 1
_ROOT = 0x0B5C1D9E3F7A2468 % PRIME
_P, _M30, _M31 = np.uint64(PRIME), np.uint64((1 << 30) - 1), np.uint64((1 << 31) - 1)
_S1, _S30, _S31, _S61 = np.uint64(1), np.uint64(30), np.uint64(31), np.uint64(61)
#: Bytes whose weighted sums stay within 64 bits.
_SUM_BYTES = 1 << 23


def _fold(x: np.ndarray) -> np.ndarray:
    x = (x >> _S61) + (x & _P)
    return np.where(x >= _P, x - _P, x)


def mulmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo PRIME of numbers below it."""
    au, ad, bu, bd = a >> _S31, a & _M31, b >> _S31, b & _M31
    mid = ad * bu + au * bd
    return _fold((au * bu << _S1) + (mid >> _S30) + ((mid & _M30) << _S31) + ad * bd)


def _prime_powers(root: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, mulmod(out, np.uint64(pow(root, len(out), PRIME)))])
    return out[:n]


_PRIME_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _two_powers() -> tuple[np.ndarray, np.ndarray]:
    """2 * DIGEST_BYTES powers of the base and of its inverse modulo PRIME."""
    if not _PRIME_POWERS:
        _PRIME_POWERS.append((_prime_powers(_ROOT, 2 * DIGEST_BYTES), _prime_powers(pow(_ROOT, -1, PRIME), 2 * DIGEST_BYTES)))
    return _PRIME_POWERS[0]


def _weighed(data: np.ndarray, up: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of at most _SUM_BYTES bytes weighted by the lower and upper bits of their powers."""
    part = data.astype(np.uint64) + _S1
    out = np.zeros((2, len(data) + 1), np.uint64)
    np.cumsum(part * (up[: len(data)] & _M31), out=out[0, 1:])
    np.cumsum(part * (up[: len(data)] >> _S31), out=out[1, 1:])
    return out[0], out[1]


def _joined(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return _fold(_fold(low) + mulmod(_fold(high), np.uint64(1 << 31)))


def _span_sums(data: np.ndarray, up: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Sum modulo PRIME of each span's bytes, byte i weighted by the i-th power; data longer than the table of
    powers is summed in parts, each one multiplied by the power at which it begins."""
    size = min(_SUM_BYTES, len(up))
    if len(data) <= size:
        low, high = _weighed(data, up)
        return _joined(low[e] - low[s], high[e] - high[s])
    total = np.zeros(len(data) + 1, np.uint64)
    for lo in range(0, len(data), size):
        part = data[lo: lo + size]
        sums = mulmod(_joined(*_weighed(part, up))[1:], np.uint64(pow(_ROOT, lo, PRIME)))
        total[lo + 1: lo + 1 + len(part)] = _fold(sums + total[lo])
    return _fold(total[e] + _P - total[s])


def word_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Digest of each span of bytes by which equal spans are known: a polynomial modulo the prime 2**61 - 1, so two
    given different spans of n bytes share one for n of 2**61 bases at most. Data is taken in blocks."""
    out = np.empty(len(starts), np.uint64)
    order = np.argsort(starts, kind="stable")
    cuts = np.searchsorted(starts[order], np.arange(0, len(data) + 1 + DIGEST_BYTES, DIGEST_BYTES))
    up, down = _two_powers()
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if hi > lo:
            own = order[lo:hi]
            a, b = int(starts[own[0]]), int(ends[own].max())
            s, e = starts[own] - a, ends[own] - a
            sums = _span_sums(data[a:b], up, s, e)
            out[own] = mix(mulmod(sums, down[s]) + (e - s).astype(np.uint64) * _GOLD)
    return out


def squash(a: np.ndarray) -> bytes:
    """Numbers as bytes of equal weight side by side, compressed."""
    return bytes(pa.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes(), "zstd")) if len(a) else b""


def spread(blob: bytes, n: int, kind: str) -> np.ndarray:
    """The ``n`` numbers of :func:`squash`."""
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(pa.decompress(blob, n * width, "zstd"), np.uint8) if n else np.zeros(0, np.uint8)
    return np.ascontiguousarray(flat.reshape(width, n).T).reshape(-1).view(kind)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start+1, … of every span, one span after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - first, lengths)
