"""Token ids of whole texts by the tokenizers library, with a bounded memory of word parts.

A byte-pair tokenizer works on pre-tokens, so the ids of a text are those of its chunks in
order, as long as no pre-token crosses a chunk's border.  Chunks repeat, so their ids are
remembered.  A chunk that is not known is taken as its word and the punctuation after it,
which repeat more often.  Texts in which a border might not be safe are encoded whole.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from functools import cache

REMEMBERED = 1_400_000
LONGEST = 40  # characters of a chunk that is remembered

# A chunk is white space and the run of other characters after it.
_LEADING = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
# White space that is neither space nor line feed, and separators some libraries call space.
_ODD = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_ODD_ASCII = [c for c in _ODD if c.isascii()]
# After a letter or digit each of these begins a pre-token.
_TAIL = string.punctuation.replace("'", "")


def _bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class Encoder:
    """ids(text) as little-endian unsigned 32-bit bytes.

    Memory has two ages of half the bound each: when the young one is full it becomes the
    old one, and what is used again moves over, so frequent chunks stay.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        # Spark runs a worker per core: threads of the library's own would only spin.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.remembered = remembered
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # White space is dropped by the word tokenizer: its chunks need none.
        ids = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in (" a", "a", "A")]
        self.spaceless = ids[0] == ids[1]
        self.caseless = ids[1] == ids[2]

    def _whole(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _parts(self, chunk: str) -> list[str]:
        word = chunk.rstrip(_TAIL)
        parts = [word, chunk[len(word) :]] if len(word) < len(chunk) and word[-1:].isalnum() else [chunk]
        return [p.lower() if p.isascii() else p for p in parts] if self.caseless else parts

    def _learn(self, chunks: list[str]) -> list[str]:
        """Take all these chunks into the young memory; those that are too long to stay there."""
        if len(self.young) > self.remembered // 2:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        parts: dict[str, list[str]] = {}
        for c in set(chunks).difference(young):
            if c in old:
                young[c] = old[c]
            else:
                parts[c] = self._parts(c)
        missing = []
        for p in {p for found in parts.values() for p in found}.difference(young):
            if p in old:
                young[p] = old[p]
            else:
                missing.append(p)
        if missing:
            encoded = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
            young.update(zip(missing, [_bytes(e.ids) for e in encoded]))
        for c, found in parts.items():
            if found[0] != c:
                young[c] = b"".join([young[p] for p in found])
        return [c for c in {*parts, *missing} if len(c) > LONGEST]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(c in text for c in (_ODD_ASCII if text.isascii() else _ODD)):
            return self._whole(text)
        chunks = text.split() if self.spaceless else _LEADING.findall(text)
        try:
            return b"".join(map(self.young.__getitem__, chunks))
        except KeyError:
            pass
        long = self._learn(chunks)
        ids = b"".join(map(self.young.__getitem__, chunks))
        for c in long:
            del self.young[c]
        return ids


@cache
def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One for each Python worker, so that its memory outlives a task."""
    return Encoder(path, remembered)


def vocabulary(name: str) -> str:
    """Where the public tokenizer file of this name lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
