"""Word and shingle hashes of many texts at once, in NumPy.

Words are runs without space, tab, line feed, vertical tab, form feed and carriage return; A-Z are
lower-cased. Hashes have 64 bits and are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Bytes of text hashed at once: bounds the size of the temporary arrays.
CHUNK_BYTES = 1_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BYTES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.ones(count, dtype=np.uint64)
        out[1:] = np.uint64(base)
        return np.cumprod(out, dtype=np.uint64)


_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: list[np.ndarray] = []  # filled in each process


def word_hashes(texts: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each text its words' hashes and their byte offsets (start, end) in UTF-8."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass")
        if held and size + len(raw) > CHUNK_BYTES:
            yield from _hashed(held)
            held, size = [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield from _hashed(held)


def _hashed(raws: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    joined = np.frombuffer(b"\n".join(raws) + b"\n", dtype=np.uint8)
    blank = _SPACE[joined]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], blank)).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    with np.errstate(over="ignore"):
        if not _POWERS:
            _POWERS.extend((_powers(_BASE, CHUNK_BYTES + 1), _powers(_INVERSE, CHUNK_BYTES + 1)))
        up, down = _POWERS
        if len(joined) < len(up):
            up = up[: len(joined)]
        else:  # a single text longer than a chunk
            up, down = _powers(_BASE, len(joined)), _powers(_INVERSE, len(joined) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[_FOLD[joined]] * up, dtype=np.uint64)))
        words = mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)
    bounds = np.cumsum([len(raw) + 1 for raw in raws])
    cuts = np.searchsorted(starts, bounds)
    low, begin = 0, 0
    for cut, bound in zip(cuts, bounds, strict=True):
        yield words[low:cut], starts[low:cut] - begin, ends[low:cut] - begin
        low, begin = cut, bound


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of fewer words, the whole sequence as one run."""
    n = len(words)
    if not n:
        return words
    span = min(width, n)
    with np.errstate(over="ignore"):
        out = np.zeros(n - span + 1, dtype=np.uint64)
        for j in range(span):
            out = out * np.uint64(_BASE) + words[j : n - span + 1 + j]
        return mixed(out + np.uint64(span))


def shingle_sets(texts: Sequence[str], width: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles."""
    for words, _, _ in word_hashes(texts):
        yield np.unique(window_hashes(words, width))


def sequence_class(words: np.ndarray) -> int:
    """A number that texts of the same words in the same order share (64 bits, signed)."""
    with np.errstate(over="ignore"):
        at = mixed(np.arange(1, len(words) + 1, dtype=np.uint64)) | np.uint64(1)
        both = np.array([(words * at).sum(dtype=np.uint64) + np.uint64(len(words))], dtype=np.uint64)
    return int(mixed(both).view(np.int64)[0])


def set_class(hashes: np.ndarray) -> int:
    """A number that equal sets share (64 bits, signed)."""
    with np.errstate(over="ignore"):
        both = np.array([hashes.sum(dtype=np.uint64) * _ODD + np.bitwise_xor.reduce(hashes) + np.uint64(len(hashes))], dtype=np.uint64)
    return int(mixed(both).view(np.int64)[0])
