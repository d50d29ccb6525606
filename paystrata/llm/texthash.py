"""Hashes of byte strings and of word shingles, in numpy.

A prefix sum of ``code[byte] * base**position`` modulo 2^64 gives the hash of any
substring as a difference times an inverse power, so all substrings of one length
cost a few passes over the array. Codes and bases are fixed random numbers, and
results are mixed at the end. There are texts, easily written down, that such sums do not
tell apart whatever the base: they may choose buckets, but never settle that two strings
are equal. ``digests`` (BLAKE2) does that, and words have hashes without such sums.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

U64 = np.uint64
_random = np.random.Generator(np.random.PCG64(20240229))
CODE = _random.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = int(_random.integers(2**62, 2**63, dtype=np.uint64)) | 5
INVERSE = pow(BASE, -1, 2**64)
SHINGLE_CODES = _random.integers(1, 2**63, 64, dtype=np.uint64) * U64(2) + U64(1)

# Powers that a worker keeps per base; longer tables are made anew for a long text.
KEPT_POWERS = 1 << 20

_powers: dict[int, np.ndarray] = {}


def powers(base: int, size: int) -> np.ndarray:
    """base**0 .. base**(size-1) modulo 2^64."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        factors = np.full(max(size, 1 << 16), base, dtype=np.uint64)
        factors[0] = 1
        known = np.cumprod(factors)
        if len(known) <= KEPT_POWERS:
            _powers[base] = known
    return known[:size]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums before each position of the last axis, and after the last one."""
    terms = CODE[data] * powers(BASE, data.shape[-1])
    sums = np.zeros(data.shape[:-1] + (data.shape[-1] + 1,), dtype=np.uint64)
    np.cumsum(terms, axis=-1, out=sums[..., 1:])
    return sums


def substring_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end]; the lengths are part of them."""
    raw = (sums[end] - sums[start]) * powers(INVERSE, len(sums))[start]
    return mix(raw + (end - start).astype(np.uint64) * SHINGLE_CODES[63])


# White space of ASCII, and A-Z lowered.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# separators where punctuation does not count: all of ASCII but letters and digits
_PUNCT = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def chunks(texts: list[bytes], most: int = 1 << 20):
    """Ranges of texts with at most ``most`` bytes together, or one longer text."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) + 1 > most:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if size:
        yield begin, len(texts)


def digests(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits of BLAKE2 of each data[start:end]."""
    parts = [
        blake2b(data[a:z], digest_size=8).digest() for a, z in zip(start.tolist(), end.tolist())
    ]
    return np.frombuffer(b"".join(parts), dtype=np.uint64)


SHORT = 16  # bytes up to which a word is hashed as the two numbers that it is
_KEPT_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)
_FIRST, _SECOND, _LENGTH = (_random.integers(1, 2**63, 3, dtype=np.uint64) * U64(2) + U64(1))


def _eight_bytes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes from each start on as one number, at most eight and ``length`` of them."""
    windows = np.lib.stride_tricks.sliding_window_view(data, 8)
    found = np.ascontiguousarray(windows[start]).view("<u8").ravel()
    return found & _KEPT_BYTES[np.clip(length, 0, 8)]


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each data[start:end]: of the bytes themselves for a short one."""
    length = end - start
    padded = np.concatenate((data, np.zeros(SHORT + 8, dtype=np.uint8)))
    first = _eight_bytes(padded, start, length)
    second = _eight_bytes(padded, start + 8, length - 8)
    found = mix(mix(mix(first + _FIRST) ^ (second * _SECOND)) + length.astype(np.uint64) * _LENGTH)
    long = np.flatnonzero(length > SHORT)
    if len(long):
        found[long] = mix(digests(data.tobytes(), start[long], end[long]))
    return found


def word_places(
    texts: list[bytes], punctuation_splits: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' lowered bytes, where words start and end in them, and each text's first word.

    The last array has one entry more than there are texts.
    """
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
    space = (_PUNCT if punctuation_splits else _SPACE)[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    return data, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    texts: list[bytes], punctuation_splits: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every lowered word of the texts in order, and where each text's words begin.

    The second array has one entry more than there are texts.
    """
    data, starts, ends, begins = word_places(texts, punctuation_splits)
    return run_hashes(data, starts, ends), begins


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; of all words if there are fewer, none of none."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    total = np.full(count, size, dtype=np.uint64)
    for k in range(size):
        total += words[k : k + count] * SHINGLE_CODES[k]
    return mix(total)
