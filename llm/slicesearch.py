"""Ranked lexical search by bit-sliced Bloom signatures.

Documents of about as many different terms share blocks.  A document is a column of a
block's bit matrix, a signature position is a row (a slice): the bitmap of the documents
that have a term with this position.  The slices of a term, joined by "and", hold every
document that has the term and a few that have not.  Terms that occur several times are
entered again for each of a few counts reached, so the slices bound occurrences too.

Weighted sums of slices are upper bounds of all scores of a block.  The documents of highest
bound are scored exactly; the tenth best of them is a score that the result cannot fall
short of.  Every document whose bound does not lie below it is then scored exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.shared import written

TOP = 10
LEVELS = (1, 2, 3, 4, 6, 8, 16)  # occurrences that are entered
HASHES = 6
BITS = 16  # positions for each entry of the fullest document of a block
BLOCK_BITS = 1 << 23
MOST_DOCS, LEAST_DOCS = 4096, 8
FREQUENCIES = 300_000  # terms that a task counts before it hands them on
QUERY_TERMS = 1 << 16  # terms of the items that are searched for at once
NO_DOC = np.iinfo(np.int64).max  # stands for null, and comes last like null

# ASCII letters are lower-cased, other ASCII characters but digits part terms; all else belongs to terms.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)
INDEX = "width int, docs array<long>, marks array<long>, lengths array<long>, slices binary, term binary, df long"
# Rows of a megabyte: row groups must not wait for the usual number of them.
FILES = {"parquet.block.size": str(32 << 20), "parquet.page.size.row.check.min": "2"}


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def entries(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """64-bit entries of a document: one for each term and count that it reaches."""
    return np.concatenate([_mixed(hashes[counts >= n] if n > 1 else hashes, i) for i, n in enumerate(LEVELS)])


def _mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (hashes + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def places(found: np.ndarray, width: int) -> np.ndarray:
    """Signature positions of entries, a row of ``HASHES`` for each."""
    steps = (found >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        at = found[:, None] + np.arange(HASHES, dtype=np.uint64) * steps[:, None]
    return (at & np.uint64(width - 1)).astype(np.int64)


def hashed(terms) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64)


class Block:
    """Documents that wait until their block is full."""

    def __init__(self, width: int):
        self.width = width
        self.room = max(min(MOST_DOCS, BLOCK_BITS // width), LEAST_DOCS)
        self.docs: list[tuple[int, int, int]] = []
        self.found: list[np.ndarray] = []

    def add(self, doc: int, mark: int, length: int, found: np.ndarray) -> bool:
        self.docs.append((doc, mark, length))
        self.found.append(found)
        return len(self.docs) == self.room

    def row(self) -> dict:
        bits = np.zeros((self.width, -(-len(self.docs) // 8) * 8), bool)
        for i, found in enumerate(self.found):
            bits[places(found, self.width).ravel(), i] = True
        docs, marks, lengths = (list(c) for c in zip(*self.docs))
        return {
            "width": self.width, "docs": docs, "marks": marks, "lengths": lengths,
            "slices": np.packbits(bits, axis=1).tobytes(), "term": None, "df": None,
        }


def index(docs: DataFrame) -> DataFrame:
    """Blocks (``slices`` is set) and document frequencies (``term`` is set), written to the shared folder.

    A frequency is a task's count; several rows of a term add up.  Documents without terms
    are in no block.  ``mark`` is a hash of the text, which tells rows of one doc_id apart.
    """
    shape = pa.schema([
        ("width", pa.int32()), *((c, pa.list_(pa.int64())) for c in ("docs", "marks", "lengths")),
        ("slices", pa.binary()), ("term", pa.binary()), ("df", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequencies: Counter[bytes] = Counter()
        blocks: dict[int, Block] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            rows = iter(frequencies.items())
            while part := list(islice(rows, 50_000)):
                none = pa.nulls(len(part))
                columns = [none.cast(f.type) for f in list(shape)[:5]] + [pa.array([t for t, _ in part], pa.binary()), pa.array([n for _, n in part], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=shape)
            frequencies.clear()

        for batch in batches:
            for doc, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                terms = terms_of(text.as_py())
                if not terms:
                    continue
                counts = Counter(terms)
                frequencies.update(counts.keys())
                found = entries(hashed(counts), np.fromiter(counts.values(), np.int64))
                width = BITS << max(int(len(found) - 1).bit_length(), 6)
                block = blocks.setdefault(width, Block(width))
                if block.add(NO_DOC if doc is None else doc, mark, len(terms), found):
                    yield pa.RecordBatch.from_pylist([block.row()], shape)
                    del blocks[width]
                if len(frequencies) > FREQUENCIES:
                    yield from counted()
        for block in blocks.values():
            yield pa.RecordBatch.from_pylist([block.row()], shape)
        yield from counted()

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.col("text").cast("string").cast("binary"))
    return written(rows.mapInArrow(run, INDEX), "slices", **FILES)


class Items:
    """The items that are searched for at once: their terms and weights."""

    def __init__(self, rows: list[tuple[int | None, bytes, int]], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.terms = sorted({t for _, t, _ in rows})
        number = {t: i for i, t in enumerate(self.terms)}
        by_item: dict[int | None, list[tuple[int, int]]] = {}
        for item, term, weight in rows:
            by_item.setdefault(item, []).append((number[term], weight))
        self.ids = list(by_item)
        self.weights = [dict((self.terms[t], w) for t, w in found) for found in by_item.values()]
        self.places = [np.array([t for t, _ in found]) for found in by_item.values()]
        self.factors = [np.array([w for _, w in found], np.float64) for found in by_item.values()]

    def gain(self, count, length):
        """What a weight is multiplied with, for whole numbers or arrays of them."""
        spread = 10 + (90 * length * self.n_docs) // self.n_terms
        return (1_000_000_000 * count) // (1000 * count + 8 * spread)

    def score(self, item: int, counts: Counter, length: int) -> int:
        weights = self.weights[item]
        return sum(w * self.gain(counts[t], length) for t, w in weights.items() if t in counts)

    def bounds(self, width: int, lengths: np.ndarray, slices: bytes) -> Iterator[tuple[int, np.ndarray]]:
        """(item, upper bounds of the block's documents) for all items."""
        bits = np.frombuffer(slices, np.uint8).reshape(width, -1)
        hashes = hashed(self.terms)
        # What the next count entered adds at most, as the slices of counts are nested.
        most = [np.minimum(n - 1, lengths) for n in LEVELS[1:]] + [lengths]
        gains = [self.gain(m, lengths) for m in most]
        steps = [gains[0], *(b - a for a, b in zip(gains, gains[1:]))]
        whole = np.zeros((len(self.ids), len(lengths)), np.float64)
        live = np.arange(len(hashes))
        above = None
        for level, step in enumerate(steps):
            have = np.bitwise_and.reduce(bits[places(_mixed(hashes[live], level), width)], axis=1)
            if above is not None:
                have &= above
            some = have.any(axis=1)
            live, above = live[some], have[some]
            if not len(live):
                break
            row_of = np.full(len(hashes), -1)
            row_of[live] = np.arange(len(live))
            flags = np.unpackbits(above, axis=1, count=len(lengths))
            for i, (terms, factors) in enumerate(zip(self.places, self.factors)):
                rows = row_of[terms]
                held = rows >= 0
                if held.any():
                    # Whole numbers below 2^53: the sums are exact.
                    whole[i] += (factors[held] @ flags[rows[held]].astype(np.float64)) * step
        yield from enumerate(whole)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for row in range(batch.num_rows):
            width, docs, marks, lengths, slices = (batch.column(i)[row] for i in range(5))
            yield width.as_py(), *(np.asarray(c.values) for c in (docs, marks, lengths)), slices.as_py()


PAIR = pa.schema([("item", pa.int32()), ("doc", pa.int64()), ("mark", pa.int64()), ("bound", pa.int64())])
PAIRS = "item int, doc long, mark long, bound long"


def _pairs(item: int, docs, marks, bounds) -> pa.RecordBatch:
    items = np.full(len(docs), item, np.int32)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((items, docs, marks, bounds.astype(np.int64)), PAIR)], schema=PAIR)


def seeds(blocks: DataFrame, items: Items, top: int) -> DataFrame:
    """The ``top`` documents of highest bound of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple | None] = [None] * len(items.ids)
        for width, docs, marks, lengths, slices in _blocks(batches):
            for item, bounds in items.bounds(width, lengths, slices):
                kept = best[item]
                full = kept is not None and len(kept[2]) == top
                at = np.flatnonzero(bounds > (kept[2].min() if full else 0))
                if len(at):
                    found = docs[at], marks[at], bounds[at]
                    if kept is not None:
                        found = tuple(np.concatenate(c) for c in zip(kept, found))
                    order = np.lexsort((found[0], -found[2]))[:top]
                    best[item] = tuple(c[order] for c in found)
        for item, kept in enumerate(best):
            if kept is not None:
                yield _pairs(item, *kept)

    first = W.partitionBy("item").orderBy(F.col("bound").desc(), "doc", "mark")
    found = blocks.mapInArrow(run, PAIRS).withColumn("nth", F.row_number().over(first))
    return found.where(F.col("nth") <= top).drop("nth")


def not_excluded(blocks: DataFrame, items: Items, least: dict[int, tuple[int, int]]) -> DataFrame:
    """All documents that the bounds do not exclude: (score, doc_id) of the last sure place by item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for width, docs, marks, lengths, slices in _blocks(batches):
            for item, bounds in items.bounds(width, lengths, slices):
                score, doc = least.get(item, (0, -1))
                # Of equal scores the smaller doc_id comes first.
                keep = (bounds > score) | ((bounds == score) & (docs <= doc) & (bounds > 0))
                if keep.any():
                    yield _pairs(item, docs[keep], marks[keep], bounds[keep])

    return blocks.mapInArrow(run, PAIRS)


def scored(docs: DataFrame, pairs: DataFrame, items: Items) -> DataFrame:
    """(item, doc, score) of pairs, from the whole texts."""
    # At most one entry for each item that is searched for at once.
    wanted = written(pairs.groupBy("doc", "mark").agg(F.collect_set("item").alias("items")), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc, text, asked in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                terms = terms_of(text.as_py())
                counts = Counter(terms)
                found += [(i, doc, items.score(i, counts, len(terms))) for i in asked]
            columns = list(zip(*found)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], names=["item", "doc", "score"]
            )

    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_DOC))).alias("doc"), F.xxhash64("text").alias("mark"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    return texts.join(wanted, ["doc", "mark"]).select("doc", "text", "items").mapInArrow(run, "item int, doc long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents of highest score above 0 of every item: item_id, rank, doc_id, score.

    ``docs`` has doc_id, text; ``items`` has item_id, text; other columns are ignored.  Null
    and empty texts have no terms.  Rows of one item_id (null too) are one item with the terms
    of all; every row of ``docs`` is a document, also repeated ones.  Equal scores are
    ranked by doc_id, null last.  Items without a document above 0, and all items if there are no documents, have no rows.

    Items are searched for in groups of some 65,536 terms, so what is sent to tasks is bounded.
    """
    spark = docs.sparkSession
    answer = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    known = index(docs)
    blocks = known.where("slices IS NOT NULL").select("width", "docs", "marks", "lengths", "slices")
    totals = known.where("slices IS NOT NULL").agg(
        F.sum(F.size("docs")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))
    ).first()
    if not totals[0]:
        return answer
    n_docs, n_terms = map(int, totals)
    weights = written(_weights(items, known, n_docs), "weights")
    groups = -(-weights.count() // QUERY_TERMS)
    for group in range(groups):
        rows = weights.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == group).collect()
        if not rows:
            continue
        found = Items([(r["item_id"], bytes(r["term"]), r["weight"]) for r in rows], n_docs, n_terms)
        first = W.partitionBy("item").orderBy(F.col("score").desc(), "doc")
        sure = scored(docs, seeds(blocks, found, top), found).withColumn("nth", F.row_number().over(first))
        # One row for each item of the group.
        least = {r["item"]: (r["score"], r["doc"]) for r in sure.where(F.col("nth") == top).collect()}
        whole = scored(docs, not_excluded(blocks, found, least), found).where("score > 0")
        ids = spark.createDataFrame(
            list(enumerate(found.ids)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", T.LongType())])
        )
        answer = answer.unionByName(
            whole.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top).join(ids, "item")
            .select("item_id", "rank", F.nullif("doc", F.lit(int(NO_DOC))).alias("doc_id"), "score")
        )
    return answer


def _weights(items: DataFrame, known: DataFrame, n_docs: int) -> DataFrame:
    """(item_id, term, weight) of the terms that some document has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, t) for i, text in zip(batch.column(0).to_pylist(), batch.column(1)) for t in set(terms_of(text.as_py()))]
            columns = list(zip(*found)) or [[]] * 2
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary())], names=["item_id", "term"])

    asked = written(
        items.select(F.col("item_id").cast("long"), F.col("text").cast("string").cast("binary"))
        .mapInArrow(run, "item_id long, term binary").distinct(), "terms",
    )
    counts = known.where("term IS NOT NULL").select("term", "df").join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))
    ratio = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    return asked.join(counts, "term").select("item_id", "term", F.floor(1000 * F.log(ratio)).cast("long").alias("weight"))


PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def sql() -> str:
    """The same ranking in SQL, from an inverted index of all terms."""
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    terms = f"unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{PATTERN}'))"
    return f"""WITH numbered AS (SELECT row_number() OVER () AS k, doc_id, text FROM documents),
        held AS (SELECT k, doc_id, {terms} AS term FROM numbered),
        tf AS (SELECT k, doc_id, term, COUNT(*) AS tf FROM held GROUP BY ALL),
        sized AS (SELECT k, CAST(SUM(tf) AS BIGINT) AS n FROM tf GROUP BY k),
        totals AS (SELECT COUNT(*) AS nn, CAST(SUM(n) AS BIGINT) AS ll FROM sized),
        df AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term),
        asked AS (SELECT DISTINCT item_id, {terms} AS term FROM benchmark),
        weighed AS (SELECT item_id, term, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
            FROM asked JOIN df USING (term), totals),
        scores AS (SELECT item_id, k, doc_id,
            CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll)))) AS BIGINT) AS score
            FROM weighed JOIN tf USING (term) JOIN sized USING (k), totals GROUP BY ALL)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER
            (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= {TOP}"""
