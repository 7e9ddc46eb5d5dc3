"""Words [^\x20\x09-\x0D]+ of byte texts as 64-bit hashes, and hashes of runs of words, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True
WEIGHT = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WEIGHT[IS_SPACE] = 0
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """A hash of the pair (a, b) of hashes."""
    x = a * STEP + b
    x ^= x >> np.uint64(32)
    x *= MIX
    x ^= x >> np.uint64(29)
    return x


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word."""
    b = np.frombuffer(data, np.uint8)
    space = IS_SPACE[b]
    start = ~space
    start[1:] &= space[:-1]
    first = np.flatnonzero(start)
    if not len(first):
        return np.empty(0, np.uint64), first
    b, start, at = b[first[0]:], start[first[0]:], (first - first[0]).astype(np.int32)
    place = np.arange(len(b), dtype=np.int32) - at[np.cumsum(start, dtype=np.int32) - 1]
    powers = np.multiply.accumulate(np.full(int(place.max()) + 1, STEP, np.uint64))
    return mixed(np.add.reduceat(WEIGHT[b] * powers[place], at), MIX), first


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each word on: runs of 1, 2, 4, ... words, the last two overlapping."""
    out, have = words, 1
    while have < length:
        step = min(have, length - have)
        out = mixed(out[:max(0, len(out) - step)], out[step:])
        have += step
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:max(0, len(out) - step)], out[step:])
        have += step
    return out


def parts(text: bytes, overlap: int, limit: int) -> Iterator[tuple[int, bytes]]:
    """A text in parts of about ``limit`` bytes, cut between words: (number of the part's first word,
    bytes). Each part starts ``overlap`` words before the end of the one before."""
    word, at = 0, 0
    while len(text) - at > limit:
        end = at + limit
        while end < len(text) and not IS_SPACE[text[end]]:
            end += 1
        part = text[at:end]
        yield word, part
        if end == len(text):
            return
        tail = part.rsplit(None, overlap) if overlap else [part]
        if len(tail) <= overlap:  # hardly any space: let the next part hold all of it
            limit *= 2
            continue
        word += len(part.split()) - overlap
        at += len(tail[0])
    yield word, text[at:]
