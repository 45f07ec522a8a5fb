"""Sets of word shingles as sorted 64-bit hashes, and their parity sketches."""

from __future__ import annotations

import numpy as np

from docferry.llm.common import mix64
from docferry.llm.words import running_hashes

WIDTH = 5
GROUP_BYTES = 1 << 18  # of texts that are hashed at once
# Odd multipliers, one for each word of a shingle and one for a short text.
_MUL = mix64(np.arange(1, WIDTH + 3, dtype=np.uint64)) | np.uint64(1)

#: Sizes below this make level 0, each further level doubles it.
LEVEL_SIZE = 144
#: Blocks of level 0; a level has twice as many as the one below.
LEVEL_BLOCKS = 64
#: Keys beyond those that the largest difference can spoil, as a share of the
#: level's largest size; partners share at least so many keys.
MARGIN = 0.06
SKETCH_BITS = 8  # bits of the dense sketch for each block


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Distinct shingles of each text (sorted hashes). With fewer than ``width``
    words the whole sequence is one, without words there is none."""
    out, at = [], 0
    while at < len(texts):
        end, held = at + 1, len(texts[at])
        while end < len(texts) and held + len(texts[end]) <= GROUP_BYTES:
            held += len(texts[end])
            end += 1
        out += _sets(texts[at:end], width)
        at = end
    return out


def _sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    w, bounds = running_hashes(texts)
    n = max(0, len(w) - width + 1)  # those across two texts are left out below
    h = w[:n] * _MUL[0]
    for j in range(1, width):
        h += w[j:n + j] * _MUL[j]
    h = mix64(h)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            s = np.sort(h[a:b - width + 1])
            new = np.empty(len(s), bool)
            new[0] = True
            np.not_equal(s[1:], s[:-1], out=new[1:])
            out.append(s[new])
        elif b > a:
            tail = np.full(1, b - a, np.uint64) * _MUL[width + 1]
            out.append(mix64((w[a:b] * _MUL[:b - a]).sum(dtype=np.uint64, keepdims=True) + tail))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The set of one text."""
    return shingle_sets([text], width)[0]


def set_digests(sets: list[np.ndarray]) -> list[int | None]:
    """64-bit number (signed) of each set; None for an empty one."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out: list[int | None] = [None] * len(sets)
    at = np.flatnonzero(sizes)
    if len(at):
        every, first = np.concatenate(sets), (np.cumsum(sizes) - sizes)[at]
        found = np.bitwise_xor.reduceat(mix64(every + np.uint64(0x51ED270B)), first) ^ mix64(np.add.reduceat(every, first))
        for i, x in zip(at.tolist(), found.view(np.int64).tolist(), strict=True):
            out[i] = x
    return out


def set_digest(s: np.ndarray) -> int:
    """64-bit number of a set that isn't empty (signed)."""
    return set_digests([s])[0]


def largest_difference(a: int, b: int) -> int:
    """Largest symmetric difference of sets of these sizes whose Jaccard
    similarity is 0.75 or more: 100 i >= 75 (a + b - i) means a + b - 2 i <= (a + b) / 7."""
    return (a + b) // 7


def levels(size: int) -> list[tuple[int, int]]:
    """Levels in which a set of this size takes part, with the largest
    difference to any partner there: its own level, whose partners are at most
    4/3 its size, and the one below if partners there are large enough."""
    level, top = 0, LEVEL_SIZE
    while size >= top:
        level, top = level + 1, top * 2
    out = [(level, largest_difference(size, 4 * size // 3))]
    if level and 3 * size <= 4 * (top // 2 - 1):
        out.append((level - 1, largest_difference(size, top // 2 - 1)))
    return out


def scrambled(s: np.ndarray) -> np.ndarray:
    """Hashes as block keys sum them up, the same in every level."""
    return mix64(s ^ np.uint64(0xA5A5))


def block_keys(s: np.ndarray, level: int, spoilt: int, mixed: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """Keys of a set in a level, and how many of them a partner shares at least.

    The set's hashes fall into the level's blocks; a block's sketch is the XOR
    of its hashes, so a difference of d elements changes d blocks at most (the
    number of unequal blocks is a lower bound of the symmetric difference).
    Among any ``spoilt`` + x filled blocks, x are thus equal in every partner. The
    first of these in key order are kept, as many as that and the margin. A set
    with too few filled blocks for that also gives its empty ones. ``mixed``:
    ``scrambled(s)``, if it is at hand.
    """
    blocks = LEVEL_BLOCKS << level
    at = s >> np.uint64(64 - int(blocks).bit_length() + 1)
    new = np.empty(len(s), bool)
    new[0] = True
    np.not_equal(at[1:], at[:-1], out=new[1:])
    first = np.flatnonzero(new)
    number = at[first] + np.uint64(level << 48)
    mixed = scrambled(s) if mixed is None else mixed
    keys = np.sort(mix64(np.bitwise_xor.reduceat(mixed, first) + number * _MUL[0]))
    margin = max(1, int(MARGIN * (LEVEL_SIZE << level)))
    if len(keys) > spoilt:
        return keys[:spoilt + margin], min(margin, len(keys) - spoilt)
    empty = np.setdiff1d(np.arange(blocks), at.astype(np.int64))
    extra = mix64((empty.astype(np.uint64) + np.uint64((level << 48) + (1 << 40))) * _MUL[1])
    return np.sort(np.concatenate([keys, extra])), 1


def sketch(s: np.ndarray, level: int) -> np.ndarray:
    """Parity sketch as 64-bit words: bit i is the parity of the elements that
    hash to i. The Hamming distance of two sketches is at most the symmetric
    difference of their sets; the sketch of the level below is the XOR of the
    two halves."""
    bits = (LEVEL_BLOCKS << level) * SKETCH_BITS
    parity = np.bincount((mix64(s ^ np.uint64(0x5BD1)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)
