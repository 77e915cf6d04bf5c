"""Exact and SimHash deduplication against plain Python."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from newsledger.llm import common, components, exact_dedup, simhash
from tests.llm.conftest import ODD

SMALL = "/root/testdata/sf0.001"


def lower(text):
    return (text or "").encode().lower().decode()


def test_exact_odd_rows(make_docs):
    docs = make_docs(ODD)
    got = exact_dedup.assign(docs).collect()
    groups = defaultdict(list)
    for doc_id, text in ODD:
        groups[lower(text)].append(doc_id)
    want = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        seen = set()
        for i in ids:
            first = i == keep and i not in seen
            seen.add(i)
            want[i, keep, len(ids), first, hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(map(tuple, got)) == want


def test_exact_collisions_are_told_apart(make_docs):
    docs = make_docs([(i, f"text {i % 7}") for i in range(40)])
    weak = exact_dedup.assign(docs, digest=lambda t: F.substring(F.md5(t), 1, 1))
    assert sorted(map(tuple, weak.collect())) == sorted(
        map(tuple, exact_dedup.assign(docs).collect()))
    assert weak.where("kept").count() == 7


def test_exact_rows_that_stay(make_docs):
    docs = make_docs(ODD)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(lower(r["text"]) for r in kept.collect()) == sorted({lower(t) for _, t in ODD})


def test_empty_tables(make_docs):
    docs = make_docs([])
    assert exact_dedup.assign(docs).count() == 0
    assert exact_dedup.deduplicate(docs).count() == 0
    assert simhash.group_fingerprints(docs).count() == 0
    assert simhash.deduplicate(docs).count() == 0


def plain_print(text, words=3):
    parts = (text or "").encode().lower().split()
    shingles = [b" ".join(parts[i:i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles] if parts else []
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def plain_groups(prints, radius):
    ids = list(range(len(prints)))
    forest = common.Forest(len(prints))
    for i in ids:
        for j in ids[:i]:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                list(forest.link(np.array([i]), np.array([j])))
    return [forest.find(i) for i in ids]


def test_fingerprints_and_groups(spark, make_docs):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet")
            .select("doc_id", "text").collect()] + [(1000 + i, t) for i, (_, t) in
                                                    enumerate(ODD)]
    rows.append((5000, rows[0][1] + " x"))
    got = {r[0]: r for r in simhash.group_fingerprints(make_docs(rows)).collect()}
    prints = [plain_print(t) for _, t in rows]
    roots = plain_groups(prints, 2)
    low = {}
    for (doc_id, _), root in zip(rows, roots):
        low[root] = min(low.get(root, doc_id), doc_id)
    for (doc_id, _), fp, root in zip(rows, prints, roots):
        assert got[doc_id]["fingerprint"] == f"{fp:016x}"
        assert got[doc_id]["component_id"] == low[root]


def test_odd_rows_and_null_ids(make_docs):
    got = simhash.group_fingerprints(make_docs(ODD)).collect()
    assert len(got) == len(ODD)
    blank = [r for r in got if r["fingerprint"] == "0" * 16]
    assert len(blank) == 6 and {r["component_id"] for r in blank} == {1}


@pytest.mark.parametrize("bits,radius,limit", [(64, 2, 1000), (64, 9, 1000), (256, 40, 1000),
                                               (64, 2, 15), (64, 9, 40)])
def test_tree_loses_no_pair(spark, bits, radius, limit):
    rng = random.Random(bits + radius)
    prints = []
    for _ in range(150):
        base = rng.getrandbits(bits)
        prints.append(base)
        for _ in range(rng.randrange(6)):  # chains of small steps
            for _ in range(rng.randrange(radius + 2)):
                base ^= 1 << rng.randrange(bits)
            prints.append(base)
    prints = sorted(set(prints))
    frame = spark.createDataFrame([(p.to_bytes(bits // 8, "little"),) for p in prints],
                                  "fp binary")
    links = simhash.link_fingerprints(frame, radius, bits, sample=200, shard_rows=20,
                                      limit=limit)
    roots = {r["node"]: r["root"] for r in components.components(links).collect()}
    want = plain_groups(prints, radius)
    keys = [roots.get(p.to_bytes(bits // 8, "little"), p.to_bytes(bits // 8, "little"))
            for p in prints]
    assert len(set(zip(map(bytes, keys), want))) == len(set(want)) == len(set(map(bytes, keys)))


def test_components_of_long_chains(spark):
    rng = random.Random(1)
    chain = list(range(300))
    rng.shuffle(chain)
    links = list(zip(chain, chain[1:])) + [(1000, 1001), (1001, 1000), (7, 7), (2000, 2000)]
    got = {r["node"]: r["root"] for r in components.components(
        spark.createDataFrame(links, "x long, y long")).collect()}
    assert got == {**{i: 0 for i in range(300)}, 1000: 1000, 1001: 1000}


def variants():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for g in range(25):
        base = [rng.choice(words) for _ in range(rng.randrange(4, 300))]
        for _ in range(rng.randrange(1, 9)):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 25)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    return rows


def jaccard_groups(rows, words=5, similarity=0.8):
    sets = [set(simhash.shingle_hashes(t, words).tolist()) or {0} for _, t in rows]
    forest = common.Forest(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9:
                list(forest.link(np.array([i]), np.array([j])))
    return [forest.find(i) for i in range(len(rows))]


@pytest.mark.parametrize("block,limit", [(2000, 1000), (3, 2)])
def test_near_groups_are_exact(make_docs, block, limit):
    rows = variants()
    groups = {bytes(r["node"]): bytes(r["root"]) for r in
              simhash.near_groups(make_docs(rows), block_docs=block, limit=limit).collect()}
    keys = [hashlib.md5(t.encode()).digest() for _, t in rows]
    mine = [groups.get(k, k) for k in keys]
    want = jaccard_groups(rows)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_dense_shards_are_connected():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**64, (6, 4), np.uint64)
    rows = np.repeat(base, 400, 0)
    for _ in range(12):
        rows[np.arange(len(rows)), rng.integers(0, 4, len(rows))] ^= (
            np.uint64(1) << rng.integers(0, 64, len(rows)).astype(np.uint64))
    rng.shuffle(rows)
    plain, quick = common.Forest(len(rows)), common.Forest(len(rows))
    for i, j in simhash.close_pairs(rows, rows, 18):
        list(plain.link(i, j))
    for i, j in simhash.linked_pairs(rows, len(rows), 18):
        list(quick.link(i, j))
    assert np.array_equal(plain.roots(), quick.roots())


def test_rare_shingles_meet():
    rng = np.random.default_rng(6)
    counts = rng.integers(0, 9, simhash.COUNTERS)
    for _ in range(300):
        pool = rng.integers(0, 2**64, rng.integers(2, 60), np.uint64)
        a, b = (np.unique(pool[rng.random(len(pool)) < 0.93]) for _ in range(2))
        if len(np.intersect1d(a, b)) >= 0.8 * max(1, len(np.union1d(a, b))):
            assert len(np.intersect1d(*(simhash.rare_shingles(x, 0.8, counts)
                                        for x in (a, b))))


def test_near_rows_that_stay(make_docs):
    rows = variants() + [(None, None), (None, None), (9000, ""), (9001, " "), (9002, "solo"),
                         (9002, "solo")]
    docs = make_docs(rows)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    low = {}
    for (doc_id, text), root in zip(rows, jaccard_groups(rows)):
        low[root] = min(low.get(root, 10**9), 10**9 if doc_id is None else doc_id)
    assert sorted(ids) == sorted(low.values())


def short_pairs(words, n, seed=8):
    """Texts of so many words, each with the same text and one more word: Jaccard 0.8 or more."""
    rng = random.Random(seed)
    for i in range(n):
        text = [f"w{rng.randrange(10**6)}" for _ in range(words)]
        yield " ".join(text), " ".join([*text, f"v{i}"])


def test_short_near_copies_are_found(make_docs):
    def far(pair):
        a, b = (np.frombuffer(simhash.majority(np.unique(simhash.shingle_hashes(t, 5)), 4),
                              np.uint64) for t in pair)
        return int(np.bitwise_count(a ^ b).sum())
    pairs = [p for words in (8, 9, 15) for p in short_pairs(words, 2000)]
    assert simhash.bit_difference(4, 0, 1) == pytest.approx(0.1875)
    assert max(map(far, pairs)) <= simhash.radius_for(0.8, 256)
    apart = sorted(pairs, key=far)[-12:]
    assert far(apart[0]) > 62  # a radius by many shingles loses these
    rows = [(i, t) for i, t in enumerate(itertools.chain(*apart))]
    assert sorted(r["doc_id"] for r in simhash.deduplicate(make_docs(rows)).collect()) == [
        *range(0, 24, 2)]


def test_small_sets_differ_most():
    worst = max(simhash.bit_difference(u - d, a, d - a) for u in range(41, 90)
                for d in range(1, u // 5 + 1) for a in range(d // 2 + 1))
    assert worst < simhash.bit_difference(4, 0, 1)
