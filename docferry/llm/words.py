"""Words of texts as 64-bit hashes, for the operators that count words.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return (``[^\\x20\\x09-\\x0D]+``) of the UTF-8 text with A-Z in
lower case. Each distinct word is hashed once and kept in a bounded cache.

Where only the hashes of running words are wanted, ``running_hashes`` gives
them from the bytes of many texts at once, without a cache; its hashes are
others than those of ``WordHashes``.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import xxhash

from docferry.llm.common import mix64, sole

LONG_WORD = 256  # longer words are hashed one by one
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 0x20
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))[_LOWER]  # a number for each byte, A-Z as a-z
_PLACE = mix64(np.arange(1 << 20, (1 << 20) + LONG_WORD, dtype=np.uint64)) | np.uint64(1)


class WordHashes(dict):
    def __init__(self, cache_words: int = 500_000) -> None:
        super().__init__()
        self._limit = cache_words

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self._limit:  # the older half has the frequent words
            kept = list(islice(self.items(), self._limit // 2))
            self.clear()
            self.update(kept)
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_HASHES = WordHashes()


def word_hashes() -> WordHashes:
    """One cache for each worker process, kept between tasks."""
    return sole(_HASHES)


def words(text: bytes) -> list[bytes]:
    return text.lower().split()


def running_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after another, and where in them
    each text begins (with the end of the last one)."""
    joined = b" ".join([*texts, b""])
    raw = np.frombuffer(joined, np.uint8)
    filled = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(filled, prepend=False))  # every text ends with a space
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    bounds = np.searchsorted(starts, begins)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    long = np.flatnonzero(sizes > LONG_WORD)
    if len(long):
        np.minimum(place, LONG_WORD - 1, out=place)
    hashes = mix64(np.add.reduceat(_BYTE[raw[filled]] * _PLACE[place], first))
    for i in long:
        hashes[i] = xxhash.xxh3_64_intdigest(joined[starts[i]:starts[i] + sizes[i]].lower())
    return hashes, bounds
