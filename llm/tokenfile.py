"""Token files: flat unsigned integers with 64-bit document offsets, memory-mapped.

A file set is one folder.  Each part has ``<name>.ids`` (the token ids of its documents one
after the other, unsigned 16 or 32 bits, little-endian), ``<name>.off`` (64-bit places
where documents begin in the part, one more than documents) and ``<name>.doc`` (64-bit
document ids; the smallest number stands for null).  Parts follow each other in doc_id
order; a part's base, the ids before it, is a prefix sum over the parts' lengths.  The
parts table names the files that count, so remains of lost tasks are never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.shared import shared_folder, written
from llm.tokens import encoder, vocabulary

VOCABULARY = "byte_bpe_50k.json"
END = 2
NO_DOC = np.iinfo(np.int64).min
PARTS = "part int, name string, docs long, ids long"
KINDS = {2: "<u2", 4: "<u4"}
BUFFER = 8 << 20


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder.removeprefix('file:')}")


def write(docs: DataFrame, folder: str, path: str, width: int) -> DataFrame:
    """Encode ``docs`` into ``folder`` in doc_id order; the parts table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of_text = encoder(path)
        kind, end = KINDS[width], np.array([END], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}"
        files, root = _place(folder)
        files.create_dir(root, recursive=True)
        offsets, ids_of = [0], []
        with files.open_output_stream(f"{root}/{name}.ids", buffer_size=BUFFER) as out:
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = np.frombuffer(ids_of_text.encode(text.as_py()) + end, "<u4")
                    out.write(ids.astype(kind).tobytes())
                    offsets.append(offsets[-1] + len(ids))
                    ids_of.append(NO_DOC if doc_id is None else doc_id)
        for suffix, values in (("off", offsets), ("doc", ids_of)):
            with files.open_output_stream(f"{root}/{name}.{suffix}") as out:
                out.write(np.array(values, "<i8").tobytes())
        if ids_of:
            columns = ([part], [name], [len(ids_of)], [offsets[-1]])
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "name", "docs", "ids"]
            )

    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    )
    # Written at once: the files are made once, and lost tasks leave no part that counts.
    return written(ordered.mapInArrow(run, PARTS), "parts")


def read(parts: DataFrame, folder: str, width: int) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files."""
    ahead = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # One row per part file.
    based = parts.withColumn("base", F.coalesce(F.sum("ids").over(ahead), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _place(folder)
        local = isinstance(files, pafs.LocalFileSystem)
        for batch in batches:
            for row in batch.to_pylist():
                stem = f"{root}/{row['name']}"
                offsets, ids_of = (_numbers(files, f"{stem}.{s}") for s in ("off", "doc"))
                source = pa.memory_map(f"{stem}.ids") if local else files.open_input_file(f"{stem}.ids")
                with source:
                    for i in range(0, len(ids_of), 4096):
                        ends = offsets[i : i + 4097]
                        crcs = []
                        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                            source.seek(a * width)
                            ids = np.frombuffer(source.read_buffer((b - a) * width), KINDS[width])
                            crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        docs = ids_of[i : i + 4096]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(docs, mask=docs == NO_DOC),
                                pa.array(row["base"] + ends[:-1]),
                                pa.array(np.diff(ends)),
                                pa.array(crcs, pa.int64()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    # A number of its own: the rows are few and small, but each stands for a whole file.
    spread = based.repartition(min(max(parts.count(), 1), 10_000), "part", "name")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _numbers(files: pafs.FileSystem, path: str) -> np.ndarray:
    with files.open_input_file(path) as source:
        return np.frombuffer(source.read(), "<i8").astype(np.int64)


def round_trip(docs: DataFrame, folder: str | None = None, path: str | None = None) -> DataFrame:
    """Write ``docs`` as token files and read every document back.

    doc_id, start, n_tokens, ids_crc32 for every row.  Documents stand in doc_id order (null
    first, ties by a hash of the text); every one ends with id 2, null and empty texts hold
    only that.  Other columns are ignored.  ``folder``: where the files go, by default below
    the shared folder.  Any file system that Arrow can reach will do; local and mounted
    ones are memory-mapped.  16-bit ids are used if the vocabulary allows.
    """
    path = path or vocabulary(VOCABULARY)
    folder = folder or shared_folder(docs.sparkSession, "tokens")
    width = 2 if encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else 4
    return read(write(docs, folder, path, width), folder, width)
