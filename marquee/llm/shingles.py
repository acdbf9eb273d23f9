"""Hashes of word shingles of whole texts, in numpy."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np

SHINGLE = 5
_space = np.zeros(256, bool)
_space[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_MIX = [np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
#: One odd multiplier for each word of a shingle.
_PLACE = np.array(
    [pow(0xD1342543DE82EF95, i + 1, 1 << 64) | 1 for i in range(64)], dtype=np.uint64
)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse, modulo 2^64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(33))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word."""
    space = _space[data]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edge[0::2], edge[1::2]
    up, down = _powers(1 << max(16, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Per text the sorted different hashes of its shingles.

    Words stand between bytes 0x20 and 0x09 to 0x0D, A-Z lower-cased.  A text of fewer words
    has its whole sequence as one shingle, one without words none.
    """
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        # A few hundred kilobytes at a time stay in the cache.
        end, total = at, 0
        while end < len(texts) and (end == at or total + len(texts[end]) < 400_000):
            total += len(texts[end]) + 1
            end += 1
        out += _some_sets([t.lower() for t in texts[at:end]], size)
        at = end
    return out


def _some_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    starts, words = _word_hashes(np.frombuffer(b"\n".join(texts) + b"\n", np.uint8))
    ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(starts, ends)
    if len(words) >= size:
        n = len(words) - size + 1
        h = words[:n] * _PLACE[0]
        for i in range(1, size):
            h = h + words[i : i + n] * _PLACE[i]
        h = mix(h)
    out, first = [], 0
    for last in upto.tolist():
        n = last - first
        if n >= size:
            out.append(np.unique(h[first : last - size + 1]))
        elif n:
            whole = (words[first:last] * _PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(mix(np.array([whole])))
        else:
            out.append(np.empty(0, np.uint64))
        first = last
    return out


def text_key(text: bytes) -> int:
    """A 64-bit key of the text's word sequence: equal for texts that have equal shingles."""
    words = b" ".join(text.lower().split())
    return int.from_bytes(hashlib.blake2b(words, digest_size=8).digest(), "little", signed=True)
