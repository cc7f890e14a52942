"""Mixing sources to target weights, in DataFrame operations only.

Every source's words form one stream, cut into blocks of fixed length.  The mix is a row of
slots, one block each, dealt out to output shards.  A source owns as many slots as its
target needs; which shard a slot goes to is drawn at random, so a shard's counts by source
are multinomial draws under the condition that the corpus totals come out as targeted
(free draws would miss the target of a small source by their own spread).  A source's slots
are numbered, and a number goes through a pseudorandom permutation of the source's block
numbers: once, again with another permutation when all blocks are used up, and so on.
Slots and blocks meet in a join by (source, block).

Streams are laid out by buckets of documents: bucket totals give the buckets' bases, and a
running sum orders the documents inside a bucket, so no task holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.shared import row_key, written

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
BLOCK = 128  # words
SHARD = 4096  # slots, about
BUCKETS = 4096  # for each source
ROUNDS = 24
SEED = 20240229
WHITE = "\t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    plain = F.translate(text, WHITE, " " * len(WHITE))
    return F.coalesce(F.size(F.filter(F.split(plain, " ", -1), lambda w: w != "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """(source, source_size, target) for (source, source_size).

    Sources in code point order, null last, weigh ``weights`` in turn.  All sizes are
    shared by weight; a share above ``most`` times its source is cut to that and the rest
    is shared again.  In order of size for weight, the cut sources come first: the first
    source whose share of what the ones before it left is not above its limit ends them.
    One row per source goes through one task here.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    weighed = sizes.withColumn("weight", weight).withColumn("limit", most * F.col("source_size").cast("double"))
    by_limit = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    every = W.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(by_limit.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_limit.rowsBetween(0, W.unboundedFollowing))
    level = weighed.withColumn("level", left / open_weight)
    fits = F.col("level") <= F.col("limit") / F.col("weight")
    # The level falls no more once a source fits; all later sources share at the first fit.
    final = F.min(F.when(fits, F.struct(F.col("limit") / F.col("weight"), F.col("level")))).over(every)["level"]
    return level.withColumn("final", final).select(
        "source", "source_size",
        F.coalesce(F.least("limit", F.col("final") * F.col("weight")), F.col("limit")).alias("target"),
    )


def permuted(number: Column, size: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0..size-1 for any size: the swap-or-not shuffle.

    Each round pairs x with (k - x) mod size and swaps the pair if a hash of its larger
    member says so (Hoang, Morris and Rogaway, 2012).
    """

    def swap(x: Column, r: Column) -> Column:
        k = F.pmod(F.xxhash64(F.lit(SEED), r, *key), size)
        other = F.pmod(k - x, size)
        coin = F.xxhash64(F.lit(SEED + 1), r, F.greatest(x, other), *key)
        return F.when(coin.bitwiseAND(F.lit(1)) == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), number.cast("long"), swap)


def laid_out(docs: DataFrame, block: int = BLOCK, weights: tuple[int, ...] = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """(documents with their place in their source's stream, sources with target and blocks).

    Documents: doc_id, source, k1, k2, size, start; sources: source, source_size, target,
    blocks, slots.
    """
    sized = written(
        docs.select("doc_id", "source", *row_key("doc_id", "source", "text"), word_count(F.col("text")).alias("size"))
        .withColumn("bucket", F.pmod("k1", F.lit(BUCKETS))),
        "sizes",
    )
    buckets = written(sized.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "buckets")
    ahead = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = buckets.select("source", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("base"))
    inside = W.partitionBy("source", "bucket").orderBy("k1", "k2").rowsBetween(W.unboundedPreceding, -1)
    running = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = running.alias("d").join(
        bases.alias("b"),
        F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.bucket") == F.col("b.bucket")),
    ).select("doc_id", "d.source", "k1", "k2", "size", (F.col("base") + F.col("inside")).alias("start"))
    totals = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    sources = targets(totals, weights).withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block)).cast("long"))
    # Of the last block only a part is filled: slots for the target at the mean fill.
    fill = F.col("source_size") / F.greatest("blocks", F.lit(1))
    slots = F.when(F.col("source_size") > 0, F.least(F.round(F.col("target") / fill), MOST_TIMES * F.col("blocks"))).otherwise(0)
    return written(placed, "placed"), written(sources.withColumn("slots", slots.cast("long")), "sources")


def drawn(sources: DataFrame, shard: int = SHARD) -> DataFrame:
    """(source, block, epoch, shard): every slot of the mix and the block it takes."""
    pieces = sources.where("slots > 0").select(
        "source", "blocks", "slots", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / 10_000))).alias("piece")
    )
    # A number of its own: so few bytes would be put into one task.
    count = sources.agg(F.sum(F.ceil(F.col("slots") / 10_000))).first()[0] or 1
    slots = pieces.repartition(min(int(count), 10_000), "source", "piece").select(
        "source", "blocks", "slots",
        F.explode(F.sequence(F.col("piece") * 10_000, F.least(F.col("piece") * 10_000 + 9_999, F.col("slots") - 1))).alias("slot"),
    )
    total = sources.agg(F.greatest(F.ceil(F.sum("slots") / shard), F.lit(1)).alias("shards"))
    epoch = F.floor(F.col("slot") / F.col("blocks"))
    return slots.join(F.broadcast(total)).select(
        "source",
        permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.col("source"), epoch).alias("block"),
        epoch.alias("epoch"),
        F.pmod(F.xxhash64(F.lit(SEED + 2), "source", "slot"), F.col("shards")).alias("shard"),
    )


def _spans(placed: DataFrame, block: int) -> DataFrame:
    """Documents by the blocks they lie in, with the words that a block holds of each."""
    first = F.floor(F.col("start") / block)
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    spread = placed.where("size > 0").select("*", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("start"), F.col("block") * block)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    return spread.withColumn("words", end - begin).withColumn("skip", begin - F.col("start"))


def mix(docs: DataFrame, block: int = BLOCK, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``.

    ``taken`` counts the words of the row that the mix takes, repeats included; no row
    gives more than three times its size.  Sources may be null (a source of its own, last
    in order); null and empty texts have size 0 and give nothing; rows that repeat are
    laid out one after the other.  The same rows give the same mix in any order.
    """
    placed, sources = laid_out(docs, block, weights)
    times = drawn(sources).groupBy("source", "block").agg(F.count("*").alias("times"))
    # A place in a source's stream belongs to one document only.
    taken = (
        _spans(placed, block).select("source", "block", "start", "words").alias("d")
        .join(times.hint("merge").alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")) & (F.col("d.block") == F.col("t.block")))
        .groupBy("d.source", "start").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    )
    joined = placed.alias("p").join(
        taken.hint("merge").alias("t"),
        F.col("p.source").eqNullSafe(F.col("t.source")) & (F.col("p.start") == F.col("t.start")) & (F.col("p.size") > 0),
        "left",
    ).select("p.doc_id", "p.source", "p.size", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    return joined.alias("j").join(sources.alias("s"), F.col("j.source").eqNullSafe(F.col("s.source"))).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def mixed_documents(docs: DataFrame, block: int = BLOCK, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix as documents: the columns of ``docs``, a row for each document and pass.

    A pass goes through a source's blocks once; its row of a document holds the words of
    the blocks that the pass takes, in order, with their white space.  A document whose
    words are all taken keeps its text as it is.  Documents without words have nothing to
    weigh and pass through once.  n_chars, if there, counts the new text.
    """
    placed, sources = laid_out(docs, block, weights)
    picks = drawn(sources).select("source", "block", "epoch").distinct()
    spans = (
        _spans(placed, block).select("source", "k1", "k2", "size", "block", "start", "skip", "words").alias("d")
        .join(picks.hint("merge").alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")) & (F.col("d.block") == F.col("t.block")))
        .groupBy("k1", "k2", "size", "start", "epoch")
        .agg(F.sort_array(F.collect_list(F.struct("skip", "words"))).alias("spans"), F.sum("words").alias("got"))
    )
    # Rows that repeat lie at several places; copy c of a row takes the c-th place.
    copies = placed.select("k1", "k2", "start", "size", F.row_number().over(W.partitionBy("k1", "k2").orderBy("start")).alias("copy"))
    passes = spans.join(copies.select("k1", "k2", "start", "copy"), ["k1", "k2", "start"]).select(
        "k1", "k2", "copy", F.when(F.col("got") < F.col("size"), F.col("spans")).alias("spans"), F.lit(True).alias("taken"), "size"
    )
    none = copies.where("size = 0").select(
        "k1", "k2", "copy", F.lit(None).cast(passes.schema["spans"].dataType).alias("spans"), F.lit(True).alias("taken"), "size"
    )
    keys = row_key("doc_id", "source", "text")
    # One row of each set of equal keys carries the text; its copies differ only in other columns.
    whole = docs.select(F.struct("*").alias("row"), keys[0].alias("k1"), keys[1].alias("k2"))
    whole = whole.withColumn("copy", F.row_number().over(W.partitionBy("k1", "k2").orderBy(F.xxhash64("row"))))
    joined = whole.join(passes.unionByName(none), ["k1", "k2", "copy"])
    # Words with the white space after them; white space before the first stays with it.
    words = F.regexp_extract_all("row.text", F.lit("(^[ \\t-\\r]*[^ \\t-\\r]+[ \\t-\\r]*|[^ \\t-\\r]+[ \\t-\\r]*)"), 1)
    part = F.array_join(
        F.flatten(F.transform("spans", lambda s: F.slice(F.col("words"), (s["skip"] + 1).cast("int"), s["words"].cast("int")))), ""
    )
    rebuilt = joined.withColumn("words", F.when(F.col("spans").isNotNull(), words)).withColumn(
        "text", F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(part)
    )
    columns = {c: F.col(f"row.`{c}`").alias(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("spans").isNull(), F.col("row.n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return rebuilt.select(*columns.values())
