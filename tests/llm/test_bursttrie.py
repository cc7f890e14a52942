"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest

from llm import bursttrie

SHAPE = "conv_id long, turn long, role string, text string, depth string"


def brute_force(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members, children = {}, {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved, found = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) or 1
        own_saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own_saved + sum(saved[b] for b in below)
        ended = ",".join(map(str, sorted(c for c in members[node] if paths[c] == node)))
        found.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(below),
                      leaves[node], saved[node], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(found, key=str)


def same(spark, rows, container):
    got = bursttrie.trie(spark.createDataFrame(rows, SHAPE), container)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(rows)


def dealt(seed, convs, longest):
    deal = random.Random(seed)
    rows = []
    for c in deal.sample(range(convs * 2), convs):
        for turn in range(deal.randrange(1, longest)):
            rows.append((c, turn, deal.choice(["user", "bot", None]), deal.choice(["a", "é", "", None]), "clash"))
    deal.shuffle(rows)
    return rows


@pytest.mark.parametrize("container", [1, 40, 4096])
def test_random_conversations(spark, container):
    same(spark, dealt(1, 120, 14), container)


def test_copies_long_conversations_and_odd_rows(spark):
    rows = [(c, t, "user", f"turn {t}", None) for c in range(0, 400, 5) for t in range(3)]  # a hot group of copies
    rows += [(1000 + c, t, "user", "x" * (t % 7), None) for c in (0, 5, 10) for t in range(70)]  # long ones that agree
    rows += [(2000, 0, "user", "y" * 200_000, None), (2003, None, "user", "null turn", None), (2003, 4, None, None, None)]
    rows += [(None, 0, "user", "no conversation", None), (3001, 0, "user", "turnless after its first turns are taken", None)]
    # Text that moves between role and text is another turn.
    rows += [(4000, 0, "ab", "c", None), (4005, 0, "a", "bc", None), (4010, 0, "a", "bc", None)]
    same(spark, rows, 64)


def test_repeated_rows_and_ties_count(spark):
    rows = [(0, 1, "user", "same", None)] * 3 + [(5, 1, "user", "same", None)] * 3
    same(spark, rows, 4096)
    tied = [(0, 1, "user", t, None) for t in "abc"]
    made = [bursttrie.trie(spark.createDataFrame(r, SHAPE)).orderBy("depth").collect() for r in (tied, tied[::-1])]
    assert made[0] == made[1] and len(made[0]) == 4


def test_empty(spark):
    assert bursttrie.trie(spark.createDataFrame([], SHAPE)).count() == 0
    assert bursttrie.trie(spark.createDataFrame([(None, 1, "user", "x", None)], SHAPE)).count() == 0


def test_long_conversations_are_summed_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(bursttrie, "BLOCK", 4)
    monkeypatch.setattr(bursttrie, "CHUNK_BYTES", 30)
    same(spark, dealt(2, 60, 30), 50)
