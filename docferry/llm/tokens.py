"""Exact, cached encoding of whole texts with a tokenizers file.

A text is cut where the tokenizer itself always cuts, each distinct chunk is
encoded once by the library, and a document's ids are the joined bytes of its
chunks. Texts in which a cut could change the ids go to the library whole, so
the ids are those of ``Tokenizer.encode`` on the whole text in every case.

* word-end vocabularies (lower case, white space dropped): chunks are the runs
  between ASCII white space, with A-Z in lower case;
* byte-level vocabularies (a word carries the space before it): chunks are
  ``white space + word``. A token never crosses from a non-space to a space,
  and the look-ahead for trailing space stays inside the chunk. Texts with
  other Unicode white space go to the library whole.

Texts that hold a special token's string go whole, too.
"""

from __future__ import annotations

import os
import re
import struct
from itertools import islice

from docferry.llm.common import sole


def _byte_chars() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself
    where it is printable, else the next free one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in own else next(free)) for b in range(256)]


_BYTE_CHARS = _byte_chars()

CACHE_CHUNKS = 1_200_000
WORD_RUNS = "word_runs"
SPACED_RUNS = "spaced_runs"

# One run of Latin letters (already composed, one lower-case form each) with a
# space or a line end before it and common marks behind it: tokenizer words cut
# at places where every vocabulary of these two kinds cuts.
_PLAIN = re.compile("([ \n]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
_SPACED = re.compile(rb"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+")
# UTF-8 of the white space that is not in the class above.
_OTHER_SPACE = re.compile(
    rb"[\x0b\x0c\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e"
    rb"|\xe2\x80[\x80-\x8b\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file on this machine. Called inside the
    task, as executors may keep the package elsewhere than the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder(dict):
    """Encode texts (UTF-8 bytes) to little-endian unsigned 32-bit ids. The
    mapping itself is the cache: chunk -> bytes of its ids.

    ``cache_chunks`` bounds the memory: a full cache keeps its older half, in
    which the frequent chunks are.
    """

    def __init__(self, path: str, cuts: str, cache_chunks: int = CACHE_CHUNKS) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._model = self._tok.model
        self._special = [t.content.encode() for t in self._tok.get_added_tokens_decoder().values()]
        self._spaced = cuts == SPACED_RUNS
        self._limit = cache_chunks

    def encode(self, text: bytes) -> bytes:
        cased = text if self._spaced else text.lower()
        if any(s in cased for s in self._special) or self._spaced and _OTHER_SPACE.search(cased):
            return self._library(text)
        if len(self) > self._limit:
            kept = list(islice(self.items(), self._limit // 2))
            self.clear()
            self.update(kept)
        chunks = _SPACED.findall(cased) if self._spaced else cased.split()
        return b"".join(map(self.__getitem__, chunks))

    def __missing__(self, chunk: bytes) -> bytes:
        plain = _PLAIN.fullmatch(chunk.decode("utf-8", "replace"))
        if plain is None or plain[1] and not self._spaced:
            ids = self._library(chunk)
        else:
            lead, word, marks = plain.groups()
            if lead == "\n" or marks:
                first = (lead if lead == " " else "") + word
                ids = (self[b"\n"] if lead == "\n" else b"") + self[first.encode()] \
                    + (self[marks.encode()] if marks else b"")
            else:
                ids = self._word(lead + (word if self._spaced else word.lower()))
        self[chunk] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of one tokenizer word: straight to the library's BPE model."""
        mapped = "".join([_BYTE_CHARS[b] for b in word.encode()])
        return _packed([t.id for t in self._model.tokenize(mapped)])

    def _library(self, text: bytes) -> bytes:
        found = self._tok.encode(text.decode("utf-8", "replace"), add_special_tokens=False)
        return _packed(found.ids)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def encoder(path_or_name: str, cuts: str, cache_chunks: int = CACHE_CHUNKS) -> ChunkEncoder:
    """One encoder for each worker process, file and size, kept between tasks."""
    key = (path_or_name, cuts, cache_chunks)
    if key not in _ENCODERS:
        path = path_or_name if os.path.sep in path_or_name else vocabulary(path_or_name)
        _ENCODERS[key] = ChunkEncoder(path, cuts, cache_chunks)
    return sole(_ENCODERS[key])
