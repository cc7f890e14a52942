"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most four bits share a variant that is at most two bits
away from either.  So every fingerprint stands for all of its variants within two bits, and
fingerprints that share a variant are linked: sharing one proves four bits or fewer, so a
collision is its own verification.

A fingerprint has 2,081 variants.  They are shuffled by their top bits (their cell): one
row goes to each cell that holds some of the variants, with the bits flipped so far and the
number of flips left, and the rest of the variants is enumerated where it is compared.
Cells are cut again by further bits, as often as needed for a fixed number of variants in
memory.  Variants of a cell that several fingerprints share give links to the smallest of
them, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.components import connected
from llm.shared import written

SHINGLE = 4
SEED = 42
RADIUS = 2  # half of the four bits
PREFIX_BITS = 12
VARIANTS_IN_MEMORY = 4_000_000
BITS = 64


def fingerprint(text: str | None) -> int:
    """64 bits over word shingles: a bit is set if it is set in more than half of the hashes."""
    return _fingerprint((text or "").encode("utf-8", "replace"))


def _fingerprint(raw: bytes) -> int:
    words = raw.lower().split()  # on bytes: A-Z only, and the six ASCII white space characters
    if not words:
        return 0
    if len(words) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        starts = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
        at = starts.tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(at, at[SHINGLE:])]
    bits = np.zeros(BITS, np.int64)
    array = np.array(hashes, dtype=">u8")
    for i in range(0, len(array), 1 << 16):
        part = array[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(array)).tobytes(), "big")


def fingerprints(docs: DataFrame, **carried: Column) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long.  A null text counts as empty.

    ``carried``: whole numbers that go along, by name.
    """
    names = list(carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            fps = np.fromiter(
                (_fingerprint(t.as_py() or b"") for t in texts), np.uint64, len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], names=["doc_id", "fp", *names]
            )

    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), *[c.cast("long").alias(n) for n, c in carried.items()]
    ).mapInArrow(run, ", ".join(["doc_id long, fp long", *[f"{n} long" for n in names]]))


@cache
def _masks(low: int, high: int, flips: int) -> np.ndarray:
    """All ways to flip up to ``flips`` of the bits low..high-1."""
    found = [0]
    for k in range(1, flips + 1):
        found += [sum(1 << b for b in pick) for pick in combinations(range(low, high), k)]
    return np.array(found, dtype=np.uint64)


def _cells(batches: Iterator[pa.RecordBatch], prefix: int) -> Iterator[pa.RecordBatch]:
    """One row for every cell that a fingerprint's variants lie in."""
    masks = _masks(BITS - prefix, BITS, RADIUS)
    left = RADIUS - np.bitwise_count(masks).astype(np.int8)
    shift = np.uint64(BITS - prefix)
    for batch in batches:
        fps = np.asarray(batch.column(0)).view(np.uint64)
        for i in range(0, len(fps), 4096):
            part = fps[i : i + 4096]
            cell = ((part[:, None] ^ masks[None, :]) >> shift).astype(np.int64).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cell),
                    pa.array(np.repeat(part.view(np.int64), len(masks))),
                    pa.array(np.tile(left, len(part))),
                ],
                names=["cell", "fp", "left"],
            )


def _links_in_cell(fps: np.ndarray, low: np.ndarray, left: np.ndarray, free: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (smallest, other) among fingerprints that share a variant of one cell.

    ``low``: the fingerprints' lower ``free`` bits, the only ones that still vary in the
    cell.  ``left``: how many of them may still be flipped.  A cell with too many variants
    is cut by its highest free bit.
    """
    sizes = np.array([1, 1 + free, 1 + free + free * (free - 1) // 2])[left]
    if sizes.sum() > VARIANTS_IN_MEMORY and free > 8 and len(fps) > 1:
        bit = np.uint64(1 << (free - 1))
        rest = bit - np.uint64(1)
        for side in (np.uint64(0), bit):
            same = (low & bit) == side
            flip = ~same & (left > 0)
            yield from _links_in_cell(
                np.concatenate([fps[same], fps[flip]]),
                np.concatenate([low[same], low[flip]]) & rest,
                np.concatenate([left[same], left[flip] - 1]),
                free - 1,
            )
        return
    variants, owners = [], []
    for flips in range(RADIUS + 1):
        at = np.flatnonzero(left == flips)
        if len(at):
            masks = _masks(0, free, flips)
            variants.append((low[at][:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(at, len(masks)))
    if not variants:
        return
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    # Few variants are shared: find their values first, then sort only those rows.
    ordered = np.sort(variant)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return
    spot = np.minimum(np.searchsorted(twice, variant), len(twice) - 1)
    hit = np.flatnonzero(twice[spot] == variant)
    value, fp = spot[hit], fps[owner[hit]]
    order = np.lexsort((fp.view(np.int64), value))
    value, fp = value[order], fp[order]
    first = np.r_[True, value[1:] != value[:-1]]
    smallest = fp[np.flatnonzero(first)[np.cumsum(first) - 1]]
    pairs = np.unique(np.stack([smallest, fp], axis=1)[smallest != fp], axis=0)
    if len(pairs):
        yield pairs[:, 0].copy(), pairs[:, 1].copy()


def _collide(batches: Iterator[pa.RecordBatch], prefix: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell; a cell is complete when the next one begins."""
    free = BITS - prefix
    rest = np.uint64((1 << free) - 1)

    def links(cell_rows: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        fps = np.concatenate([r[0] for r in cell_rows])
        left = np.concatenate([r[1] for r in cell_rows])
        if len(fps) < 2:
            return
        for a, b in _links_in_cell(fps, fps & rest, left.astype(np.int64), free):
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

    open_cell, held = None, []
    for batch in batches:
        cells = np.asarray(batch.column(0))
        fps = np.asarray(batch.column(1)).view(np.uint64)
        left = np.asarray(batch.column(2))
        cuts = np.r_[0, np.flatnonzero(cells[1:] != cells[:-1]) + 1, len(cells)]
        for i, j in zip(cuts[:-1], cuts[1:]):
            if j == i:
                continue
            if cells[i] != open_cell and held:
                yield from links(held)
                held = []
            open_cell = cells[i]
            held.append((fps[i:j], left[i:j]))
    if held:
        yield from links(held)


def fingerprint_links(fps: DataFrame, prefix_bits: int = PREFIX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``), enough to connect all within four bits."""
    cells = fps.select("fp").mapInArrow(
        lambda batches: _cells(batches, prefix_bits), "cell long, fp long, left byte"
    )
    dealt = cells.repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(lambda batches: _collide(batches, prefix_bits), "a long, b long")


def near_duplicates(docs: DataFrame, prefix_bits: int = PREFIX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Fingerprints of four-word shingles (A-Z lower-cased, repeats included) link at four or
    fewer differing bits; component_id is the smallest doc_id reachable.  Null and empty
    texts have the fingerprint zero and link like any other.  Rows whose doc_id is null
    are kept and link, but never name a component unless all of it is null.  Repeated rows
    are kept.  Other columns are ignored.
    """
    named = written(fingerprints(docs), "simhash")
    labelled = _labelled(named, prefix_bits)
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = written(labelled.join(least, "component").select("fp", "component_id"), "simhash")
    return named.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _labelled(named: DataFrame, prefix_bits: int) -> DataFrame:
    """(fp, least, component) for every fingerprint: its smallest doc_id and its group."""
    own = written(named.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash")
    links = written(fingerprint_links(own, prefix_bits), "simhash")
    groups = connected(links).withColumnRenamed("node", "fp")
    return own.join(groups, "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )


def keep_one(docs: DataFrame, prefix_bits: int = PREFIX_BITS) -> DataFrame:
    """The columns of ``docs``, one row of each group of near duplicates: its smallest doc_id.

    Rows are told apart by doc_id and text: of texts of one doc_id that are no near duplicates
    each stays.  Of near duplicates with one doc_id the smallest fingerprint stays, of
    rows that repeat doc_id and text the one that a hash of all columns puts first.  Rows without a doc_id stay.
    """
    mark = F.xxhash64("text")
    named = written(fingerprints(docs, mark=mark).where("doc_id is not null"), "simhash")
    groups = written(_labelled(named, prefix_bits).select("fp", "component"), "simhash")
    first = named.join(groups, "fp").groupBy("component").agg(F.min(F.struct("doc_id", "fp", "mark")).alias("r"))
    chosen = written(first.select(F.col("r.doc_id").alias("_keep_doc"), F.col("r.mark").alias("_keep_mark")), "simhash")
    marked = docs.where("doc_id is not null").withColumn("_keep_mark", mark)
    found = marked.join(chosen.withColumnRenamed("_keep_mark", "_keep_m"), (F.col("doc_id") == F.col("_keep_doc")) & (F.col("_keep_mark") == F.col("_keep_m")), "left_semi")
    place = F.row_number().over(Window.partitionBy("doc_id", "_keep_mark").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])))
    once = found.withColumn("_keep_place", place).where("_keep_place = 1")
    return once.select(docs.columns).unionByName(docs.where("doc_id is null"))
