"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
KEPT_WORDS = 100_000

_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so that multiplying by it loses nothing
_word_hashes: dict[bytes, int] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole number, without collisions."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, size: int = WORDS) -> np.ndarray:
    """Distinct shingles of ``size`` words of the whole text, lower-cased (A-Z) and cut at ASCII white
    space; a text of fewer words, but not none, is one shingle. Sorted."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = _word_hashes
    if len(known) > KEPT_WORDS:
        known.clear()
    try:
        hashes = [known[w] for w in words]
    except KeyError:
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        hashes = [known[w] for w in words]
    one = np.array(hashes, np.uint64)
    size = min(size, len(one))
    n = len(one) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total = mixed(total * _STEP + one[k : k + n])
    return np.unique(total)


def forget() -> None:
    """Frees the words kept; tasks call it at their end, since their worker lives on."""
    _word_hashes.clear()


def set_digest(shingles: np.ndarray) -> bytes:
    """A 128-bit hash of a set: equal for equal sets."""
    return xxhash.xxh3_128_digest(shingles.tobytes())
