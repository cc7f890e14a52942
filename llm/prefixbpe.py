"""Byte-level BPE by prefix dynamic programming, and decoding.

For every prefix of a piece's bytes there is exactly one token that its encoding can end
with: the one that ends there and whose border with the encoding of what lies before it no
earlier merge would have crossed.  A table of these last tokens is the encoding of every
prefix at once.  So bytes can be appended without looking back, and after an edit the table
is recomputed from the edit on only until it agrees with the old one over the length of the
longest token.

Texts are split by the vocabulary's pattern first, and every piece is encoded by itself.  A
piece never holds white space after other characters, so a text falls into chunks (white
space, then other characters) that are split alone; short chunks recur and are remembered.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tokens import vocabulary

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
REMEMBERED = 700_000  # chunks of each of two ages
PAIRS = 400_000
LONGEST = 48  # characters of a chunk that is remembered
NEVER = 1 << 60

# White space as the pattern's \s means it (the Unicode property).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


def _ranges(points: list[int]) -> str:
    """Code points as the inside of a character class."""
    at = np.array(points)
    cuts = np.flatnonzero(np.diff(at) > 1) + 1
    return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in np.split(at, cuts))


def splitter(pattern: str) -> regex.Pattern:
    """The pattern with the character classes of the tiktoken library.

    The two libraries follow different versions of Unicode, so tiktoken is asked which
    characters are in each class, and the few that differ are taken out or put in.
    """
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind in sorted(set(regex.findall(r"\\p\{\w+\}", pattern))):
        asked = tiktoken.Encoding(kind, pat_str=kind, mergeable_ranks=single, special_tokens={})
        theirs = set(bytes(asked.encode_ordinary(every)).decode())
        ours = set(regex.findall(kind, every))
        whole = kind
        for found, sign in ((ours - theirs, "--"), (theirs - ours, "||")):
            if found:
                whole = f"[{whole}{sign}[{_ranges(sorted(map(ord, found)))}]]"
        pattern = pattern.replace(kind, whole)
    return regex.compile(pattern, regex.V1)


class Vocabulary:
    """Tokens by rank, what each was merged from, and which can stand side by side."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick

        self.ranks = ranks
        self.split = splitter(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(self.lengths.values())
        # All tokens that end at a place, longest first; bytes stand as the characters of their number.
        self.ending = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.ending.add_word(token.decode("latin-1"), (len(token), rank))
        self.ending.make_automaton()
        self._parts: dict[int, tuple[int, ...] | None] = {}
        self._fits: dict[tuple[int, int], bool] = {}

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def parts(self, token: int) -> tuple[int, ...] | None:
        """The two tokens whose merge made this one (none for a byte); None if merging never makes it."""
        if token not in self._parts:
            now = [bytes([b]) for b in self.tokens[token]]
            while len(now) > 2:
                rank, i = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(now, now[1:])))
                if rank == NEVER:
                    break
                now[i : i + 2] = [now[i] + now[i + 1]]
            self._parts[token] = tuple(self.ranks[x] for x in now) if len(now) <= 2 else None
        return self._parts[token]

    def made(self, token: int) -> int:
        """When merging makes this token: its rank; single bytes are there from the start."""
        return token if self.lengths[token] > 1 else -1

    def extend(self, last: list[int], data: bytes, stop: int) -> None:
        """Add the last tokens of the prefixes of ``data`` up to ``stop`` bytes: one of those that end there fits."""
        known, fits = self._fits.get, self.fits
        place, begin = len(last) - 1, max(len(last) - self.longest, 0)
        for end, (n, token) in self.ending.iter(data.decode("latin-1"), begin, stop):
            if end == place:  # else the token that fits there is known, or has just been found
                pair = last[end + 1 - n], token
                good = known(pair)
                if fits(*pair) if good is None else good:
                    last.append(token)
                    place += 1

    def fits(self, left: int, right: int) -> bool:
        """Whether both tokens, side by side, are the encoding of their bytes.

        The later of the two is taken apart again and again.  If the parts that touch then
        would have merged before the merge that is undone (an equal one counts as before
        if it lies further left), the border would have been crossed.
        """
        pair, limit = (left, right), NEVER
        if len(self._fits) >= PAIRS:
            self._fits.clear()
        if left < 0 or self.parts(right) is None:  # nothing before it, or a token that no merge makes
            self._fits[pair] = self.parts(right) is not None
            return self._fits[pair]
        while True:
            if self.ranks.get(self.tokens[left] + self.tokens[right], NEVER) < limit:
                good = False
                break
            a, b = self.made(left), self.made(right)
            if a < 0 and b < 0:
                good = True
                break
            if a > b:
                limit, left = a, self.parts(left)[1]
            else:
                limit, right = b + 1, self.parts(right)[0]
        self._fits[pair] = good
        return good


class Prefixes:
    """``last[i]``: the last token of the encoding of the first ``i`` bytes."""

    def __init__(self, words: Vocabulary, data: bytes = b""):
        self.words, self.data, self.last = words, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Encode further bytes; what is known stays as it is."""
        self.data += more
        self.words.extend(self.last, self.data, len(self.data))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` for the bytes from ``start`` to ``end``; the number of prefixes computed anew."""
        data = self.data[:start] + new + self.data[end:]
        old, moved = self.last, len(data) - len(self.data)
        last, agreed = old[: start + 1], 0
        while len(last) <= len(data) and agreed < self.words.longest:
            at = len(last)
            self.words.extend(last, data, at)
            # Only prefixes that end after the edit have an old counterpart.
            agreed = agreed + 1 if at > start + len(new) and last[at] == old[at - moved] else 0
        computed = len(last) - start - 1
        self.data, self.last = data, last + old[len(last) - moved :]
        return computed

    def become(self, data: bytes) -> int:
        """Change the bytes into others that mostly agree; the number of prefixes computed anew."""
        same = len(os.path.commonprefix((self.data, data)))
        most = min(len(self.data), len(data)) - same
        tail = len(os.path.commonprefix((self.data[::-1][:most], data[::-1][:most])))
        return self.replace(same, len(self.data) - tail, data[same : len(data) - tail])

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes (all): from the last token backwards."""
        last, lengths, at = self.last, self.words.lengths, len(self.data) if end is None else end
        found = []
        while at:
            token = last[at]
            found.append(token)
            at -= lengths[token]
        found.reverse()
        return found


class Encoder(dict):
    """Chunk to ids (little-endian unsigned 32 bits); a missing chunk is encoded when asked for."""

    def __init__(self, words: Vocabulary, remembered: int = REMEMBERED):
        self.words, self.remembered = words, remembered
        self.older: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.chunk(chunk)
        if len(chunk) <= LONGEST:
            if len(self) >= self.remembered:
                # Chunks that were not asked for in this age are forgotten with the next.
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def chunk(self, chunk: str) -> bytes:
        words, found = self.words, []
        for piece in words.split.findall(chunk):
            data = piece.encode()
            whole = words.ranks.get(data)
            if whole is None:
                found += Prefixes(words, data).ids()
            else:
                found.append(whole)
        return struct.pack(f"<{len(found)}I", *found)

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, CHUNK.findall(text))) if text else b""


class EncodedText:
    """A text with the prefix tables of its pieces, for appends and edits."""

    def __init__(self, words: Vocabulary, text: str = ""):
        self.words, self.text = words, text
        self.chunks = [self._tables(c, []) for c in CHUNK.findall(text)]
        self.ends = [m.end() for m in CHUNK.finditer(text)]
        self.computed = 0

    def _tables(self, chunk: str, known: list[Prefixes]) -> list[Prefixes]:
        """Tables of a chunk's pieces; known ones are changed into them, in order."""
        tables = []
        for piece, table in zip(self.words.split.findall(chunk), known + [None] * len(chunk)):
            data = piece.encode()
            if table is None:
                table = Prefixes(self.words, data)
            else:
                self.computed += table.become(data)
            tables.append(table)
        return tables

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` for the characters from ``start`` to ``end`` and encode what changes."""
        # Borders between chunks stay if the characters on both sides do.
        ends = np.array(self.ends, dtype=np.int64)
        first = int(np.searchsorted(ends, start - 1, "right")) if start else 0
        after = int(np.searchsorted(ends, end, "right"))
        begin = self.ends[first - 1] if first else 0
        stop = self.ends[after] if after < len(self.ends) else len(self.text)
        part = self.text[begin:start] + new + self.text[end:stop]
        self.computed = 0
        old = self.chunks[first : after + 1]
        fresh = [(m.end(), m.group()) for m in CHUNK.finditer(part)]
        made = [self._tables(c, k) for (_, c), k in zip(fresh, old + [[]] * len(fresh))]
        moved = len(part) - (stop - begin)
        self.text = self.text[:begin] + part + self.text[stop:]
        self.chunks[first : after + 1] = made
        self.ends[first:] = [begin + e for e, _ in fresh] + [e + moved for e in self.ends[after + 1 :]]

    def ids(self) -> list[int]:
        found = []
        for chunk in self.chunks:
            for table in chunk:
                whole = self.words.ranks.get(table.data)
                found += table.ids() if whole is None else [whole]
        return found


@cache
def words_of(path: str, pattern: str) -> Vocabulary:
    return Vocabulary.read(path, pattern)


@cache
def encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker, so that its memory outlives a task."""
    return Encoder(words_of(path, pattern))


class Decoder:
    """Ids (little-endian unsigned 32 bits) to the bytes of their tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.tokens = {int(rank): base64.b64decode(token) for token, rank in (x.split() for x in lines if x.strip())}

    def decode(self, ids: bytes | None) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


@cache
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encoded(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32 bits) for every row of ``docs`` (doc_id, text).

    ``path`` is a file of ranks, ``pattern`` splits texts; the ids are those that the tiktoken
    library gives.  A null text counts as empty; empty texts have no ids.  Rows stay
    apart, also those of one doc_id or none.  Other columns are ignored.  Texts are split
    into Arrow batches by Spark and encoded one by one, whole; the time is linear in their length.
    """
    path, pattern = path or vocabulary(VOCABULARY), pattern or _pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern).encode
        for batch in batches:
            ids = pa.array([encode(text.as_py()) for text in batch.column(1)], pa.large_binary())
            for at, n in _slices(ids):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), ids.slice(at, n).cast(pa.binary())], names=["doc_id", "ids"]
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary")


def decoded(ids: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids, bytes (binary) for every row of ``ids`` (doc_id, ids); null ids count as none."""
    path = path or vocabulary(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = decoder(path).decode
        for batch in batches:
            found = pa.array([decode(ids.as_py()) for ids in batch.column(1)], pa.large_binary())
            for at, n in _slices(found):
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, n) for c in batch.columns), found.slice(at, n).cast(pa.binary())],
                    names=["doc_id", "ids", "bytes"],
                )

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, bytes binary")


def _slices(values: pa.LargeBinaryArray, most: int = 32 << 20) -> Iterator[tuple[int, int]]:
    """(start, rows) of parts of some ``most`` bytes each, as batches go to the JVM whole."""
    ends = np.frombuffer(values.buffers()[1], "<i8")[values.offset : values.offset + len(values) + 1]
    at = 0
    while at < len(values):
        n = max(int(np.searchsorted(ends, ends[at] + most, "right")) - 1 - at, 1)
        yield at, min(n, len(values) - at)
        at += n


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes and decodes every row, as ``encoded`` and ``decoded``.

    Both happen in one pass, so that neither ids nor bytes leave the task.
    """
    path, pattern = path or vocabulary(VOCABULARY), pattern or _pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, decode = encoder(path, pattern).encode, decoder(path).decode
        for batch in batches:
            counts, ids_digests, digests = [], [], []
            for text in batch.column(1):
                ids = encode(text.as_py())
                counts.append(len(ids) // 4)
                ids_digests.append(hashlib.sha256(ids).hexdigest())
                digests.append(hashlib.sha256(decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(digests, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
