"""Prefix trie of conversations, built as a burst trie.

Conversations lie in containers under trie heads: a container holds what its conversations
say after the head.  All start in the root's container.  A container with too many turns is
bursted by next turn id: heads are made of the turns that follow, counted over all its
conversations at once, and each conversation moves on to the container of its new head.  A
container that comes from k bursts is bursted by as many turns as lie above it at once, so
the number of rounds is the logarithm of the depth at which many conversations still agree.
Containers that are left are small: each is sorted by its turn ids and swept into nodes.

A node is known by a key, the running exclusive-or of 128-bit hashes of (turn, place).  Heads
get the sums over their subtrees by doubling: in round k every head adds what the heads
2^k below it have summed up so far.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.shared import written

CONTAINER = 4096  # turns in a container that is swept
BLOCK = 1 << 16  # turns of one conversation that one task sums up
CHUNK_BYTES = 1 << 16  # text of ids that is hashed at once
MOST_SHARED = 8  # turns that a conversation takes from another at most
NONE = hashlib.sha256(b"").hexdigest()

MEMBERS = "g1 long, g2 long, conv_id long, pos long, t1 long, t2 long, k1 long, k2 long, size long"
NODES = (
    "k1 long, k2 long, up1 long, up2 long, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, top boolean"
)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, rank from 1, t1, t2, size) of every turn: order in its conversation, id, bytes of text.

    Turns are put in order by one range sort over all conversations, so that a very long one
    is dealt over many tasks; places in a conversation come from counts by task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # 128 bits of the role's length, the role and the text.
    digest = F.md5(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)).cast("binary"))
    half = [F.conv(F.substring(digest, a, 16), 16, -10).cast("long") for a in (1, 17)]
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2")]
    slim = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        half[0].alias("t1"), half[1].alias("t2"), F.octet_length(text).cast("long").alias("size"),
    )
    placed = written(
        slim.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv_id", "t1", "t2", "size", F.monotonically_increasing_id().alias("at")), "turns",
    ).withColumn("part", F.shiftright("at", 33))
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    parts = parts.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)) + 1 - F.col("first"))
    return placed.join(parts.select("conv_id", "part", "shift"), ["conv_id", "part"]).select(
        "conv_id", (F.col("at") + F.col("shift")).alias("rank"), "t1", "t2", "size"
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of the rebuilt conversations.

    The first h turns come from conversation c - c % 5 (h is crc32 of c's digits, modulo 9),
    the rest from c itself, after its first h.
    """
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    own = lengths.select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).alias("h"),
    )
    bases = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("m"))
    # At most five conversations have one base.
    plan = written(
        own.join(bases, "base", "left").withColumn("shared", F.least("h", F.coalesce("m", F.lit(0))))
        .withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "plans",
    )
    taken = turns.where(F.col("rank") <= MOST_SHARED).withColumnRenamed("conv_id", "base").join(
        plan.select("conv_id", "base", "shared"), "base"
    ).where("rank <= shared").select("conv_id", F.col("rank").alias("pos"), "t1", "t2", "size")
    rest = turns.join(plan.select("conv_id", "h", "shared"), "conv_id").where("rank > h").select(
        "conv_id", (F.col("rank") - F.col("h") + F.col("shared")).alias("pos"), "t1", "t2", "size"
    )
    return taken.unionByName(rest), plan.select("conv_id", "length")


def with_keys(turns: DataFrame) -> DataFrame:
    """Every turn with the key (k1, k2) of the node that it leads to and of the one above (up1, up2)."""
    hashed = turns.withColumns(
        {"block": F.floor((F.col("pos") - 1) / BLOCK), "x1": F.xxhash64("pos", "t1", "t2"), "x2": F.xxhash64("t2", F.lit(7), "t1", "pos")}
    )
    inside = W.partitionBy("conv_id", "block").orderBy("pos")
    summed = hashed.withColumns({f"s{i}": F.bit_xor(f"x{i}").over(inside) for i in "12"})
    # One row for each block of 65,536 turns.
    blocks = hashed.groupBy("conv_id", "block").agg(*[F.bit_xor(f"x{i}").alias(f"b{i}") for i in "12"])
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    ahead = blocks.select("conv_id", "block", *[F.coalesce(F.bit_xor(f"b{i}").over(before), F.lit(0)).alias(f"a{i}") for i in "12"])
    return summed.join(ahead, ["conv_id", "block"]).select(
        "conv_id", "pos", "t1", "t2", "size",
        *[F.col(f"s{i}").bitwiseXOR(F.col(f"a{i}")).alias(f"k{i}") for i in "12"],
        *[F.col(f"s{i}").bitwiseXOR(F.col(f"a{i}")).bitwiseXOR(F.col(f"x{i}")).alias(f"up{i}") for i in "12"],
    )


def burst(turns: DataFrame, lengths: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(heads, containers): counted nodes, and (conv_id, g1, g2, above) of conversations in small containers.

    A container is known by its head's key (g1, g2), which lies ``above`` turns deep.
    """
    zero = F.lit(0).cast("long")
    heads = [lengths.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("long").alias("up1"), F.lit(None).cast("long").alias("up2"),
        "conv_id", zero.alias("depth"), "n_convs", zero.alias("size"),
    )]
    containers = []
    depth = 0
    # Conversations that say more than their head, by container.
    loose = written(lengths.where("length > 0").select("conv_id", "length", zero.alias("g1"), zero.alias("g2")), "loose")
    while True:
        sizes = loose.groupBy("g1", "g2").agg(F.sum(F.col("length") - depth).alias("turns"))
        marked = written(loose.join(sizes, ["g1", "g2"]), "loose")
        containers.append(marked.where(F.col("turns") <= limit).select("conv_id", "g1", "g2", F.lit(depth).cast("long").alias("above")))
        large = marked.where(F.col("turns") > limit).select("conv_id", "length")
        if large.isEmpty():
            break
        below = max(2 * depth, 1)
        followed = turns.where((F.col("pos") > depth) & (F.col("pos") <= below)).join(large, "conv_id")
        heads.append(written(
            followed.groupBy("k1", "k2").agg(
                F.first("up1").alias("up1"), F.first("up2").alias("up2"), F.min("conv_id").alias("conv_id"),
                F.first("pos").alias("depth"), F.count("*").alias("n_convs"), F.first("size").alias("size"),
            ), "heads",
        ))
        loose = written(
            turns.where(F.col("pos") == below).join(large.where(F.col("length") > below), "conv_id")
            .select("conv_id", "length", F.col("k1").alias("g1"), F.col("k2").alias("g2")), "loose",
        )
        depth = below
    return _united(heads), _united(containers)


def _united(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def swept(turns: DataFrame, containers: DataFrame) -> DataFrame:
    """The nodes of all containers, with the sums over their subtrees; ``top`` marks those right below a head."""
    members = turns.join(containers, "conv_id").where("pos > above").select(
        "g1", "g2", "conv_id", "pos", "t1", "t2", "k1", "k2", "size"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            kept = rows if kept is None else pa.concat_tables([kept, rows])
            # The last container may go on in the next batch.
            g1, g2 = (kept.column(i).to_numpy() for i in (0, 1))
            cuts = np.flatnonzero((g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1])) + 1
            if len(cuts):
                yield from _sweep_all(kept.slice(0, cuts[-1]))
                kept = kept.slice(cuts[-1])
        if kept is not None and len(kept):
            yield from _sweep_all(kept)

    return members.repartition("g1", "g2").sortWithinPartitions("g1", "g2", "conv_id", "pos").mapInArrow(run, NODES)


def _sweep_all(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Sort and sweep every container of ``rows``, which lie by container, conversation and place."""
    g1, g2, conv, pos, t1, t2, k1, k2, size = (c.to_numpy() for c in rows.columns)
    news = np.flatnonzero(np.r_[True, (g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1]) | (conv[1:] != conv[:-1])])
    ends = np.r_[news[1:], len(g1)]
    turns = list(zip(t1.tolist(), t2.tolist()))
    found: list[tuple] = []
    at = 0
    while at < len(news):
        head, stop = (g1[news[at]], g2[news[at]]), at
        while stop < len(news) and (g1[news[stop]], g2[news[stop]]) == head:
            stop += 1
        suffixes = sorted((turns[a:b], int(conv[a]), int(a)) for a, b in zip(news[at:stop], ends[at:stop]))
        found += _sweep(suffixes, (int(head[0]), int(head[1])), pos, k1, k2, size)
        at = stop
    kinds = [pa.int64()] * 11 + [pa.bool_()]
    names = [c.split()[0] for c in NODES.split(", ")]
    for i in range(0, len(found), 10_000):
        columns = zip(*found[i : i + 10_000])
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _sweep(suffixes: list[tuple], head: tuple[int, int], pos, k1, k2, size) -> list[tuple]:
    """Nodes of one container from its sorted suffixes (turn ids, conversation, first row).

    Open nodes lie on a stack: [row, smallest conversation, members, children, leaves, saved].
    """
    found, stack, before = [], [], []

    def close() -> None:
        row, least, members, children, leaves, saved = stack.pop()
        leaves = leaves or 1
        saved += (members - 1) * int(size[row])
        above = stack[-1] if stack else None
        up = (int(k1[above[0]]), int(k2[above[0]])) if above else head
        # The parent's smallest conversation is known when the parent closes: put in below.
        found.append([int(k1[row]), int(k2[row]), *up, least, int(pos[row]), None, members, children, leaves, saved, above is None])
        if above:
            above[1] = min(above[1], least)
            above[3] += 1
            above[4] += leaves
            above[5] += saved

    for turns, conversation, first in suffixes:
        same = 0
        for a, b in zip(before, turns):
            if a != b:
                break
            same += 1
        while len(stack) > same:
            close()
        for i in range(len(stack), len(turns)):
            stack.append([first + i, conversation, 0, 0, 0, 0])
        for node in stack:
            node[1] = min(node[1], conversation)
            node[2] += 1
        before = turns
    while stack:
        close()
    least_of = {(n[0], n[1]): n[4] for n in found}
    for n in found:
        n[6] = least_of.get((n[2], n[3]))
    return [tuple(n) for n in found]


def summed(heads: DataFrame, tops: DataFrame) -> DataFrame:
    """Heads with children, and with leaves and savings over their subtrees."""
    below = heads.where("depth > 0").select("up1", "up2", F.lit(0).alias("n_leaves"), F.lit(0).alias("saved_tokens")).unionByName(
        tops.select("up1", "up2", "n_leaves", "saved_tokens")
    ).groupBy(F.col("up1").alias("k1"), F.col("up2").alias("k2")).agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    now = written(
        heads.join(below, ["k1", "k2"], "left").select(
            "k1", "k2", "up1", "up2", "conv_id", "depth", "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("size") + F.coalesce("saved", F.lit(0))).alias("saved_tokens"),
            F.col("up1").alias("far1"), F.col("up2").alias("far2"),
        ), "sums",
    )
    parents = now.select(F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    deepest = now.agg(F.max("depth")).first()[0] or 0
    step = 1
    while step <= deepest:
        # (far1, far2) is the head that lies ``step`` turns above.
        more = now.where(F.col("depth") >= step).groupBy(F.col("far1").alias("k1"), F.col("far2").alias("k2")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
        )
        up = now.where(F.col("depth") >= step).select(
            F.col("k1").alias("far1"), F.col("k2").alias("far2"), F.col("far1").alias("next1"), F.col("far2").alias("next2")
        )
        # Only heads deep enough for the next round look further up.
        jumps = now.where(F.col("depth") >= 2 * step).select("k1", "k2", "far1", "far2").join(up, ["far1", "far2"]).select("k1", "k2", "next1", "next2")
        now = written(
            now.join(more, ["k1", "k2"], "left").join(jumps, ["k1", "k2"], "left").select(
                "k1", "k2", "up1", "up2", "conv_id", "depth", "n_convs", "n_children",
                (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
                F.col("next1").alias("far1"), F.col("next2").alias("far2"),
            ), "sums",
        )
        step *= 2
    return now.join(parents, ["up1", "up2"], "left").drop("far1", "far2")


def ends(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of nodes at which conversations end.

    Ids are sorted by node over all tasks, which first join them into long chunks; the digest
    of a node reads its chunks one after the other.
    """
    zero = F.lit(0).cast("long")
    last = turns.join(lengths, [turns["conv_id"] == lengths["conv_id"], turns["pos"] == lengths["length"]]).select(
        "k1", "k2", turns["conv_id"]
    ).unionByName(lengths.where("length = 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, kept, n = None, [], 0

        def out() -> pa.RecordBatch:
            columns = ([node[0]], [node[1]], [kept[0]], [",".join(map(str, kept))])
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k1", "k2", "first", "ids"])

        for batch in batches:
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node or n > CHUNK_BYTES:
                    if kept:
                        yield out()
                    node, kept, n = key, [], 0
                kept.append(conv)
                n += 20
        if kept:
            yield out()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None

        def out(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["k1", "k2", "ends_sha256"])

        for batch in batches:
            found = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
                if key == node:
                    sha.update(b",")
                else:
                    if node is not None:
                        found.append((*node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256()
                sha.update(ids.encode())
            if found:
                yield out(found)
        if node is not None:
            yield out([(*node, sha.hexdigest())])

    order = ["k1", "k2", "conv_id"]
    texts = last.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(chunks, "k1 long, k2 long, first long, ids string")
    return written(texts, "ends").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(
        digests, "k1 long, k2 long, ends_sha256 string"
    )


def trie(conversations: DataFrame, container: int = CONTAINER) -> DataFrame:
    """The nodes of the trie of rebuilt conversations.

    ``conversations`` has conv_id, turn, role, text; other columns are ignored.  Returns
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.  Turns are ordered by turn (null first), equal ones by a hash of
    role and text, and all of them count, repeated rows too; null role or text is empty; rows without conv_id
    belong to no conversation.  No conversations give no nodes.  ``container``: turns in a
    container that is swept; the result does not depend on it.
    """
    turns, lengths = rebuilt(turn_rows(conversations))
    turns = written(with_keys(turns), "paths")
    heads, containers = burst(turns, lengths, container)
    containers = written(containers, "containers")
    nodes = written(swept(turns, containers), "nodes")
    upper = written(summed(heads, nodes.where("top")), "upper")
    heads_of = upper.select(F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv_id").alias("head_conv_id"))
    lower = nodes.where("top").drop("parent_conv_id").join(heads_of, ["up1", "up2"]).withColumnRenamed("head_conv_id", "parent_conv_id")
    columns = ["k1", "k2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    every = _united([part.select(*columns) for part in (upper, lower, nodes.where("not top"))])
    return every.join(ends(turns, lengths), ["k1", "k2"], "left").select(
        *columns[2:], F.coalesce("ends_sha256", F.lit(NONE)).alias("ends_sha256")
    )


def sql() -> str:
    """The same nodes in SQL: every prefix of every rebuilt conversation as a list, grouped."""
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT)), lambda c, b:
        list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
        CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""
    return f"""WITH own AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
            ORDER BY turn NULLS FIRST) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        planned AS (SELECT *, {crc} % {MOST_SHARED + 1} AS h FROM own),
        paths AS (SELECT p.conv_id, list_concat(coalesce(b.turns, [])[1:h], p.turns[h + 1:]) AS path
            FROM planned p LEFT JOIN own b ON b.conv_id = p.conv_id - p.conv_id % 5),
        steps AS (SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM paths),
        nodes AS (SELECT path[1:depth] AS node, depth, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs,
            coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = len(path)), '') AS ended
            FROM steps GROUP BY ALL),
        born AS (SELECT node[1:depth - 1] AS node, COUNT(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
        valued AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
            CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(node[depth].t) ELSE 0 END AS own_saved
            FROM nodes n LEFT JOIN born USING (node)),
        spread AS (SELECT node[1:unnest(range(depth + 1))] AS node, (n_children = 0)::INT AS leaf, own_saved FROM valued),
        sums AS (SELECT node, SUM(leaf) AS n_leaves, SUM(own_saved) AS saved_tokens FROM spread GROUP BY node)
        SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
        CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(v.ended) AS ends_sha256
        FROM valued v JOIN sums USING (node) LEFT JOIN nodes u ON v.depth > 0 AND u.node = v.node[1:v.depth - 1]"""
