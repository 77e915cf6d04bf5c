"""The prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from newsledger.llm import common, prefix_trie
from newsledger.llm.prefix_trie import Slots

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, mark, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        rest = abs(c) % 100
        turns = tuple(own.get(c - rest if c >= 0 else c + rest, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    out = {}
    for node in sorted(members, key=len, reverse=True):
        below = [out[k] for k in children[node]]
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        joined = ",".join(map(str, sorted(ends.get(node, []))))
        out[node] = [min(members[node]), len(node),
                     min(members[node[:-1]]) if node else None, len(members[node]),
                     len(below), sum(b[5] for b in below) or 1,
                     saved + sum(b[6] for b in below),
                     hashlib.sha256(joined.encode()).hexdigest()]
    return sorted(map(tuple, out.values()), key=str)


def made(spark, rows, **sizes):
    got = prefix_trie.trie(spark.createDataFrame(rows, TURNS).repartition(3), **sizes)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                           "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, got.collect()), key=str)


def random_rows(rng, convs, longest):
    words = ["", "a", "é", "bb", "ccc", "日本"]
    rows = []
    for c in rng.sample(range(-250, 450), convs) + [0, 100, 200]:
        for turn in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["u", "s", None]),
                         rng.choice(words[:rng.randint(1, 6)] + [None])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    common.prepare(spark)
    rows = random_rows(random.Random(seed), 60, 9)
    assert made(spark, rows) == brute(rows)


def test_blocks_shards_and_pieces(spark):
    """Conversations over many blocks, shards of a few rows, ids in pieces of two."""
    rows = random_rows(random.Random(3), 40, 23)
    assert made(spark, rows, block=4, shard_rows=30, piece_ids=2) == brute(rows)


def test_hot_conversation_and_copies(spark):
    rows = [(7, None, "u", "same")] * 2500 + [(7, i, "u", f"t{i}") for i in range(1500)]
    rows += [(c, 0, "u", "hello") for c in range(300, 700)] + [(7, 3, "u", "t3")] * 2
    assert made(spark, rows, block=512, shard_rows=1000) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "u", "x"), (1, None, None, None), (2, 0, "", ""), (2, 0, "", ""),
            (3, 0, "u", "long " * 50_000), (-5, 1, "a", "b"), (5, -1, "a", "b"), (0, 2, "u", "x")]
    assert made(spark, rows) == brute(rows)
    assert made(spark, []) == []
    wide = spark.createDataFrame([(1, 1, "r", "t", 5, "d")],
                                 TURNS + ", depth int, d1 string")
    assert prefix_trie.trie(wide).count() == len(brute([(1, 1, "r", "t")]))


def test_slots_are_minimal_and_know_their_digests():
    rng = np.random.default_rng(0)
    d1, d2 = rng.integers(-2**63, 2**63 - 1, (2, 5000))
    d1[:10] = d1[0]
    d2[10:20] = d2[10]
    slots = Slots(np.concatenate([d1, d1]), np.concatenate([d2, d2]))
    assert sorted(slots(d1, d2)) == list(range(5000))
    assert (slots(d1 + 1, d2) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie._verified(np.array([0, 0]), 1, np.array([1, 2]))
