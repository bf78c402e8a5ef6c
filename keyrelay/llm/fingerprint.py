"""64-bit SimHash of a text's word shingles (pure numpy/bytes helper, used inside Spark tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

#: The digest of a shingle: XXH64 over UTF-8 with this seed.
SEED = 42
#: Shingles whose bits are summed at once: bounds the memory a very long text takes.
STEP = 1 << 15


def simhash(text: bytes | None, size: int = 4) -> int:
    """Fingerprint of ``text`` (UTF-8): a bit is 1 if more than half of the shingle digests have it.

    Words are the runs between ASCII white space after lower-casing A-Z; shingles are ``size`` words joined by a
    space, repeats included. A text of fewer words is one shingle; a text of none (or None) has fingerprint 0.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[size - 1:].tolist()
    first = [0, *(ends[:-size] + 1).tolist()]
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(first)
    for at in range(0, n, STEP):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(first[at:at + STEP], last[at:at + STEP])], "<u8")
        ones += bit_sums(h)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def bit_sums(h: np.ndarray) -> np.ndarray:
    """How many of the 64-bit values have each bit."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
