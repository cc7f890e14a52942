"""Best-fit packing of tokenised documents into sequences.

Tasks pack their share by bounded-space online best-fit: a fixed number of bins is open,
filed by free space; a bitset over free spaces finds the tightest bin that a piece fits
in.  When a new bin would be one too many, the fullest open bin closes.  Pieces arrive in
blocks, longest first within a block, in an order that a hash of their document deals.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.shared import written
from llm.tokens import encoder, vocabulary

VOCABULARY = "word_bpe_49k.json"
END = 1
LENGTH = 4096
OPEN_BINS = 8192
ARRIVALS = 32_768  # pieces in a block
PIECES_PER_TASK = 400_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class OpenBins:
    """Open bins by free space, with the bitset that finds the best fit."""

    def __init__(self, length: int, limit: int):
        self.length, self.limit = length, limit
        self.by_space: list[list[int]] = [[] for _ in range(length + 1)]
        self.bits = 0  # bit f is set if a bin with f free places is open
        self.open = 0
        self.made = 0

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        found = bins.pop()
        if not bins:
            self.bits &= ~(1 << space)
        self.open -= 1
        return found

    def put(self, size: int) -> tuple[int, int]:
        """(bin, place in it) for a piece of ``size`` tokens."""
        fitting = self.bits >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(space)
        else:
            if self.open >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest
            space, bin_ = self.length, self.made
            self.made += 1
        left = space - size
        if left:  # a full bin is closed
            self.by_space[left].append(bin_)
            self.bits |= 1 << left
            self.open += 1
        return bin_, self.length - space


def pieces(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): tokenised documents, longer ones cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of_text = encoder(path)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids_of_text.encode(text.as_py()) + end
                for n, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    rows.append((doc_id, n, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECE)


def _pack(batches: Iterator[pa.RecordBatch], length: int, limit: int, arrivals: int) -> Iterator[pa.RecordBatch]:
    bins = OpenBins(length, limit)
    base = TaskContext.get().partitionId() << 40

    def packed(table: pa.Table) -> Iterator[pa.RecordBatch]:
        sizes = np.asarray(table.column("length"))
        order = np.argsort(-sizes, kind="stable")
        found = [bins.put(s) for s in sizes[order].tolist()]
        sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
        sequence[order] = [base + f[0] for f in found]
        offset[order] = [f[1] for f in found]
        done = table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
        yield from done.combine_chunks().to_batches()

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= arrivals:
            yield from packed(pa.Table.from_batches(held))
            held = []
    if held:
        yield from packed(pa.Table.from_batches(held))


def packed(
    docs: DataFrame,
    path: str | None = None,
    length: int = LENGTH,
    open_bins: int = OPEN_BINS,
    arrivals: int = ARRIVALS,
    pieces_per_task: int = PIECES_PER_TASK,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece.

    Every document, null and empty texts too, ends with id 1.  Only documents longer than
    ``length`` are cut, into whole pieces; the last may be shorter.  Repeated rows and rows
    without doc_id are packed like others.  Sequence ids are unique numbers without
    meaning.  ``path``: the tokenizer's file.
    """
    cut = written(pieces(docs, path or vocabulary(VOCABULARY), length), "pieces")
    # One task packs this many pieces, so that what stays open at its end is a small share.
    tasks = max(1, -(-cut.count() // pieces_per_task))
    dealt: list[Column] = [F.xxhash64("doc_id", "piece", "length", "ids_crc32")]
    ordered = cut.repartition(tasks, *dealt).sortWithinPartitions(*dealt, "doc_id", "piece", "ids_crc32")
    return ordered.mapInArrow(
        lambda batches: _pack(batches, length, open_bins, arrivals), f"{PIECE}, sequence_id long, offset long"
    )
