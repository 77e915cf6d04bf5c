"""SimHash fingerprints and near-duplicate links through vantage-point trees.

Fingerprints. Words are cut at ASCII white space after lower-casing A-Z; each run of k words,
joined by single spaces, hashes to 64 bits (XXH64, seed 42); a fingerprint bit is set where
more than half of the hashes have it. Longer fingerprints mix each hash further.

Links. A vantage-point tree cuts the fingerprints into shards by Hamming distance: at each
node those within the threshold of the vantage point go left, the rest right. A fingerprint
lives in one shard and also visits every shard that its search ball overlaps (triangle
bound), of those only shards behind its own, since the reverse visit would find the same
pairs. Inside a shard the same pruning goes on with local vantage points until small blocks
are compared bit by bit. The tree is fitted on a bounded sample; every fingerprint is
routed, so no pair within the radius is lost. A shard reports a spanning forest of its
links, never all pairs of a group. A shard of more than ``CHUNK_PRINTS`` fingerprints is cut
into chunks, and each pair of chunks is searched by a task of its own.

Pairs as far apart as a Jaccard similarity of 0.8 leaves them are beyond the triangle bound
of one tree over the corpus. There ``near_groups`` cuts shards by rare shingles that such
pairs provably share, and the vantage points prune inside them.

Defined results: null text is empty text; without words the fingerprint is zero, linked like
any other; fewer than k words are one shingle. Null ids stay and take part; equal rows get
equal results. Empty tables give empty results.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from newsledger.llm.common import Forest, by_group, full_text, one_per_key, tasks, without
from newsledger.llm.components import components
from newsledger.session import materialize

SEED = 42
#: Fingerprints the shard tree is fitted on, at most.
SAMPLE = 16_384
#: Fingerprints that live in one shard, about.
SHARD_ROWS = 8_000
#: Fingerprints of one shard that a task holds at once.
CHUNK_PRINTS = 250_000
#: Counters of shingles, by the leading bits of their hash: they order shingles by rarity.
COUNTERS = 1 << 16
#: Documents of one candidate group that one task compares with each other.
BLOCK_DOCS = 2_000
#: Share of pairs at a similarity that their radius may leave out, at most.
MISSED = 1e-12
#: Sets of so many shingles together have their bit differences worked out exactly.
SMALL_UNION = 40
#: Below this size a set of fingerprints is compared directly.
DIRECT = 1_024


# ---- fingerprints

def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words, in order, repeats included."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    line = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[s:e], SEED) for s, e in
                     zip(starts.tolist(), ends[words - 1:].tolist())], np.uint64)


def _mixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """A further 64 bits of each hash (SplitMix64 finaliser)."""
    z = hashes + np.uint64(lane * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def majority(hashes: np.ndarray, lanes: int = 1) -> bytes:
    """The bits set in over half of the hashes, big-endian, 8 bytes a lane."""
    n = len(hashes)
    if not n:
        return bytes(8 * lanes)
    out = b""
    for lane in range(lanes):
        words = hashes if not lane else _mixed(hashes, lane)
        counts = np.zeros(64, np.int64)
        for at in range(0, n, 65_280):
            part = words[at:at + 65_280].astype(">u8")
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
            # 255 rows at most fit a byte; byte sums are quick, their totals are exact
            sums = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8)
            counts += sums.sum(0, dtype=np.int64)
        out += np.packbits(2 * counts > n).tobytes()
    return out


def fingerprint(words: int, bits: int = 64):
    """Column function: text to a binary fingerprint of ``bits`` bits."""
    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([majority(shingle_hashes(t, words), bits // 64) for t in texts],
                         dtype=object)
    return run


def shingle_counts(texts: DataFrame, words: int) -> np.ndarray:
    """How many texts have shingles of each counter, over all rows of ``texts`` (text)."""
    def count(batches):
        held = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found = np.unique(shingle_hashes(text, words)) >> np.uint64(48)
                held += np.bincount(found.astype(np.int64), minlength=COUNTERS)
        at = np.nonzero(held)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])],
                                         ["at", "n"])

    out = np.zeros(COUNTERS, np.int64)
    for row in (texts.select("text").mapInArrow(count, "at int, n long")
                .groupBy("at").agg(F.sum("n").alias("n")).collect()):  # COUNTERS rows at most
        out[row["at"]] = row["n"]
    return out


def rare_shingles(hashes: np.ndarray, similarity: float, counts: np.ndarray) -> np.ndarray:
    """The rarest of a set's shingles, so many that two sets of at least this Jaccard
    similarity share one of them: n - ceil(similarity * n) + 1, in one order for all sets.

    A set without shingles is that of the one hash 0.
    """
    if not len(hashes):
        return np.zeros(1, np.uint64)
    keep = len(hashes) - math.ceil(similarity * len(hashes) - 1e-9) + 1
    rank = counts[(hashes >> np.uint64(48)).astype(np.int64)]
    return hashes[np.lexsort((hashes, rank))[:keep]]


def sketch(words: int, bits: int, similarity: float, counts: np.ndarray):
    """Column function: fingerprint of the distinct shingles, and the rarest of them, packed."""
    @F.pandas_udf("fp binary, rare binary")
    def run(texts: pd.Series) -> pd.DataFrame:
        made = [np.unique(shingle_hashes(t, words)) for t in texts]
        return pd.DataFrame({"fp": [majority(h, bits // 64) for h in made],
                             "rare": [rare_shingles(h, similarity, counts).tobytes()
                                      for h in made]})
    return run


def shingle_set(words: int):
    """Column function: the distinct shingle hashes, sorted and packed."""
    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingle_hashes(t, words)).tobytes() for t in texts],
                         dtype=object)
    return run


# ---- vantage-point trees

def unpack(prints: Iterable[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(prints), np.uint64).reshape(-1, width)


def distances(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.bitwise_count(rows ^ point).sum(-1, dtype=np.int32)


class Tree:
    """Shards of fingerprints by distance to vantage points, with overlap for a radius."""

    def __init__(self, sample: np.ndarray, shards: int, radius: int):
        self.radius, self.nodes, self.leaves = radius, [], 0
        depth = max(0, math.ceil(math.log2(max(1, shards))))
        self.root = self._grow(sample, depth)

    def _grow(self, rows: np.ndarray, depth: int) -> int:
        """Node number, or the complement of a shard number."""
        if depth and len(rows) >= 8:
            point = rows[len(rows) // 2]
            d = distances(rows, point)
            cut = int(np.median(d))
            left, right = rows[d <= cut], rows[d > cut]
            if len(left) and len(right):
                at = len(self.nodes)
                self.nodes.append(None)
                self.nodes[at] = (point, cut, self._grow(left, depth - 1),
                                  self._grow(right, depth - 1))
                return at
        self.leaves += 1
        return ~(self.leaves - 1)

    def route(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, rows that live there, rows of other shards whose ball reaches it)."""
        home = np.arange(len(rows))
        stack = [(self.root, home, home[:0])]
        while stack:
            at, own, guests = stack.pop()
            if not len(own) and not len(guests):
                continue
            if at < 0:
                yield ~at, own, guests
                continue
            point, cut, left, right = self.nodes[at]
            d, g = distances(rows[own], point), distances(rows[guests], point)
            r = self.radius
            stack.append((left, own[d <= cut], np.concatenate(
                [own[(d > cut) & (d <= cut + r)], guests[g <= cut + r]])))
            stack.append((right, own[d > cut], np.concatenate(
                [own[(d <= cut) & (d > cut - r)], guests[g > cut - r]])))


def close_pairs(own: np.ndarray, others: np.ndarray, radius: int
                ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (own, other) within ``radius``, pruned by local vantage points."""
    stack = [(np.arange(len(own)), np.arange(len(others)))]
    while stack:
        a, b = stack.pop()
        if not len(a) or not len(b):
            continue
        if len(a) > DIRECT:
            point = own[a[len(a) // 2]]
            d, g = distances(own[a], point), distances(others[b], point)
            cut = int(np.median(d))
            near, far = a[d <= cut], a[d > cut]
            b_near, b_far = b[g <= cut + radius], b[g > cut - radius]
            visits = len(near) * len(b_near) + len(far) * len(b_far)
            if len(far) and visits < 0.95 * len(a) * len(b):
                stack += [(near, b_near), (far, b_far)]
                continue
        step = max(1, 2_000_000 // len(a))
        rows = own[a]
        for at in range(0, len(b), step):
            part = b[at:at + step]
            d = np.bitwise_count(rows[None, :, 0] ^ others[part][:, None, 0])
            if own.shape[1] == 1:
                j, i = np.nonzero(d <= radius)
            else:  # one lane at least has its share of the radius or less; all lanes decide
                near = d <= radius // own.shape[1]
                for lane in range(1, own.shape[1]):
                    d = np.bitwise_count(rows[None, :, lane] ^ others[part][:, None, lane])
                    near |= d <= radius // own.shape[1]
                j, i = np.nonzero(near)
                keep = distances(rows[i], others[part[j]]) <= radius
                j, i = j[keep], i[keep]
            if len(i):
                yield a[i], part[j]


def linked_pairs(rows: np.ndarray, own: int, radius: int
                 ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs that connect all rows within ``radius`` of one of the first ``own`` rows.

    Rows within the radius of one vantage point are connected through it and need no
    comparison with each other, so a dense group costs about its size.
    """
    mine, guests = np.arange(own), np.arange(own, len(rows))
    while len(mine) > DIRECT:
        d = distances(rows[mine], rows[mine[0]])
        ball, rest = mine[d <= radius], mine[d > radius]
        if len(ball) < len(mine) // 8:
            break
        yield np.full(len(ball), mine[0]), ball
        others = np.concatenate([rest, guests])
        for i, j in close_pairs(rows[ball], rows[others], radius):
            yield ball[i], others[j]
        mine = rest
    others = np.concatenate([mine, guests])
    for i, j in close_pairs(rows[mine], rows[others], radius):
        yield mine[i], others[j]


def _links(own: list[bytes], guests: list[bytes], width: int, radius: int
           ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of the links of one shard, as fingerprints."""
    home = unpack(own, width)
    rows = np.concatenate([home, unpack(guests, width)])
    forest = Forest(len(rows))
    for i, j in linked_pairs(rows, len(home), radius):
        strict = i != j
        links = list(forest.link(i[strict], j[strict]))
        if links:
            x, y = (np.array(c) for c in zip(*links))
            yield rows[x], rows[y]


FOUND = "a binary, b binary, shard long, home boolean, fps binary"


def _shard_links(batches, width: int, radius: int, limit: int | None):
    """From rows (shard, home, packed fingerprints) sorted by shard, home ones first: links
    (a, b) of each shard. A shard of more than ``limit`` fingerprints comes out again instead,
    in chunks of about that many."""
    types = (pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.binary())
    names = ["a", "b", "shard", "home", "fps"]
    out: list[tuple] = []
    shard, held, size, large = None, {True: [], False: []}, 0, False

    def chunk():
        for home, parts in held.items():
            if parts:
                out.append((None, None, shard, home, b"".join(parts)))
            parts.clear()

    def close():
        if large:
            chunk()
        elif held[True] and size > 1:
            for a, b in _links(held[True], held[False], width, radius):
                out.extend((x.tobytes(), y.tobytes(), None, None, None) for x, y in zip(a, b))
        held[True].clear()
        held[False].clear()

    def flush():
        made = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        out.clear()
        return made

    for batch in batches:
        # Rows that are alone in their shard with one fingerprint link nothing.
        shards = batch.column("shard").to_numpy(zero_copy_only=False)
        if not len(shards):
            continue
        apart = np.ones(len(shards) + 1, bool)
        apart[1:-1] = shards[1:] != shards[:-1]
        apart[0], apart[-1] = shards[0] != shard, False
        lengths = pa.compute.binary_length(batch.column("fps")).to_numpy(zero_copy_only=False)
        keep = ~(apart[:-1] & apart[1:] & (lengths == 8 * width))
        for s, home, fps in zip(*(c.to_pylist() for c in batch.filter(pa.array(keep)).columns)):
            if s != shard:
                close()
                shard, size, large = s, 0, False
            elif limit and size > 0 and (size + len(fps) // (8 * width)) > limit:
                chunk()
                size, large = 0, True
            held[home].append(fps)
            size += len(fps) // (8 * width)
            if len(out) >= 2_000 or large and out:
                yield flush()
    close()
    if out:
        yield flush()


def _search(dealt: DataFrame, width: int, radius: int, limit: int) -> DataFrame:
    """Links (a, b) from dealt rows (shard, home, fps), large shards in pairs of chunks."""
    count = tasks(dealt.sparkSession)

    def run(rows: DataFrame, most: int | None) -> DataFrame:
        return (rows.repartition(count, "shard").sortWithinPartitions("shard", F.desc("home"))
                .mapInArrow(lambda batches: _shard_links(batches, width, radius, most), FOUND))

    found = materialize(run(dealt, limit))
    links = found.where("a is not null").select("a", "b")
    chunks = found.where("shard is not null").select("shard", "home", "fps")
    if chunks.isEmpty():
        return links
    # Home chunks 0 .. H-1, then guests up to T-1: home chunk i meets every chunk from i on.
    listed = (chunks.select("shard", "home", F.xxhash64("fps").alias("mark"))
              .withColumn("no", F.row_number().over(
                  Window.partitionBy("shard").orderBy(F.desc("home"), "mark")) - 1))
    totals = listed.groupBy("shard").agg(F.count("*").cast("int").alias("t"),
                                         F.sum(F.col("home").cast("int")).cast("int").alias("h"))
    numbered = materialize(listed.join(totals, "shard").where("h > 0").distinct())
    low = F.sequence(F.lit(0), F.least(F.col("no"), F.col("h") - 1))
    high = F.when(F.col("home"), F.sequence(F.col("no"), F.col("t") - 1)).otherwise(
        F.array().cast("array<int>"))
    meets = F.array_distinct(F.concat(
        F.transform(low, lambda i: F.struct(i.alias("i"), F.col("no").alias("j"))),
        F.transform(high, lambda j: F.struct(F.col("no").alias("i"), j.alias("j")))))
    blocks = (chunks.withColumn("mark", F.xxhash64("fps"))
              .join(numbered, ["shard", "home", "mark"])
              .select("shard", "no", "fps", F.explode(meets).alias("m"))
              .select(F.xxhash64("shard", "m.i", "m.j").alias("shard"),
                      (F.col("no") == F.col("m.i")).alias("home"), "fps"))
    return links.unionByName(run(blocks, None).select("a", "b"))


def link_fingerprints(prints: DataFrame, radius: int, bits: int = 64, sample: int = SAMPLE,
                      shard_rows: int = SHARD_ROWS, limit: int = CHUNK_PRINTS) -> DataFrame:
    """Links (a, b) of different fingerprints within ``radius`` bits: the same components
    as all pairs, as a forest a shard. ``prints`` has a distinct binary column ``fp``."""
    width = bits // 64
    total = prints.count()
    # A hash thins the fingerprints before the exact bound: few leave each task.
    share = int((1 << 20) * min(1.0, 1.2 * sample / max(1, total))) + 1
    thin = prints.select("fp").where(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < share)
    fitted = [bytes(r[0]) for r in
              thin.orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()]
    tree = Tree(unpack(fitted, width), total // shard_rows + 1, radius)

    def deal(batches):
        for batch in batches:
            rows = unpack(batch.column("fp").to_pylist(), width)
            homes = np.zeros(len(rows), np.int64)
            routed = list(tree.route(rows))
            for leaf, own, _ in routed:
                homes[own] = leaf
            out = []
            for leaf, own, guests in routed:
                later = guests[homes[guests] < leaf]
                out += [(leaf, home, rows[part].tobytes())
                        for home, part in ((True, own), (False, later)) if len(part)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()),
                 pa.array([o[1] for o in out], pa.bool_()),
                 pa.array([o[2] for o in out], pa.binary())], ["shard", "home", "fps"])

    dealt = prints.select("fp").mapInArrow(deal, "shard long, home boolean, fps binary")
    return _search(dealt, width, radius, limit)


def _by_rare_shingle(batches, width: int, at_once: int = 200_000):
    """One row a rare shingle of a batch, with the fingerprints of the texts that have it."""
    for batch in batches:
        prints, start = batch.column("fp").to_pylist(), 0
        sets = [np.frombuffer(r, np.uint64) for r in batch.column("rare").to_pylist()]
        ends = np.cumsum([len(r) for r in sets])
        while start < len(sets):
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + at_once, "right")))
            part = sets[start:stop]
            rare = np.concatenate(part)
            order = np.argsort(rare, kind="stable")
            rows = unpack(prints[start:stop], width)
            flat = rows[np.repeat(np.arange(len(part)), [len(r) for r in part])[order]]
            names, first = np.unique(rare[order], return_index=True)
            offsets = np.append(first, len(rare)).astype(np.int32) * np.int32(8 * width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), pa.array(np.ones(len(names), bool)),
                 pa.Array.from_buffers(pa.binary(), len(names),
                                       [None, pa.py_buffer(offsets), pa.py_buffer(flat)])],
                ["shard", "home", "fps"])
            start = stop


def link_by_rare_shingles(prints: DataFrame, radius: int, bits: int,
                          limit: int = CHUNK_PRINTS) -> DataFrame:
    """Links (a, b) of fingerprints within ``radius`` bits whose texts share a rare shingle.

    ``prints`` has the binary columns ``fp`` and ``rare`` (packed shingle hashes). Each rare
    shingle is a shard; most hold one text and end there.
    """
    width = bits // 64
    dealt = prints.select("fp", "rare").mapInArrow(
        lambda batches: _by_rare_shingle(batches, width),
        "shard long, home boolean, fps binary")
    return _search(dealt, width, radius, limit)


# ---- operators

def group_fingerprints(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id.

    Documents link where their 64-bit fingerprints differ in at most ``radius`` bits;
    component_id is the smallest doc_id that links reach.
    """
    prints = materialize(docs.select(docs["doc_id"],
                                     fingerprint(words)(docs["text"]).alias("fp")))
    # One row a fingerprint: copies combine before they are shuffled.
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    linked = components(link_fingerprints(distinct, radius))
    rooted = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    known = rooted.select("fp", "root").join(lowest, "root").select("fp", "component_id")
    return prints.join(known, "fp").select(
        "doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def bit_difference(shared: int, left: int, right: int) -> float:
    """Chance that one bit of the fingerprints differs between two sets of shingles with
    ``shared`` members in common and ``left`` and ``right`` of their own, ties counting as 0."""
    def tails(n: int, total: int) -> np.ndarray:
        """For each count of set bits among the shared: chance that ``n`` more win a majority."""
        chances = [math.comb(n, k) / 2**n for k in range(n + 1)]
        return np.array([sum(c for k, c in enumerate(chances) if 2 * (x + k) > total)
                         for x in range(shared + 1)])

    weights = np.array([math.comb(shared, x) / 2**shared for x in range(shared + 1)])
    a, b = tails(left, shared + left), tails(right, shared + right)
    return float((weights * (a * (1 - b) + b * (1 - a))).sum())


@functools.cache
def radius_for(similarity: float, bits: int, missed: float = MISSED) -> int:
    """Bits within which pairs of at least this Jaccard similarity fall, but for a share of
    ``missed`` of the pairs whose sets are the least favourable.

    Large sets of like size with Jaccard J have cosine 2J / (1 + J), and a bit differs with
    probability acos(cosine) / pi. Small sets differ more often, because few shingles decide a
    majority: all sets of up to ``SMALL_UNION`` shingles together are worked out exactly, and
    the largest chance holds for all pairs.
    """
    p = math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
    for union in range(1, SMALL_UNION + 1):
        for shared in range(math.ceil(similarity * union - 1e-9), union):
            p = max([p] + [bit_difference(shared, left, union - shared - left)
                           for left in range((union - shared) // 2 + 1)])
    tail, radius = 0.0, bits
    while radius:
        tail += math.comb(bits, radius) * p**radius * (1 - p)**(bits - radius)
        if tail > missed:
            break
        radius -= 1
    return radius


def _verified_links(batches, similarity: float):
    """Forest of the pairs in each block whose Jaccard similarity reaches the threshold."""
    for table in by_group(batches, "block"):
        keys = table.column("key").to_pylist()
        sets = [np.frombuffer(s, np.uint64) if s else np.zeros(1, np.uint64)
                for s in table.column("shingles").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        mark = np.zeros(codes.max() + 1, np.int32)
        forest, out = Forest(len(sets)), []
        for i in range(len(sets) - 1):
            own = codes[starts[i]:ends[i]]
            mark[own] = 1
            both = np.add.reduceat(mark[codes[ends[i]:]], starts[i + 1:] - ends[i])
            mark[own] = 0
            union = sizes[i] + sizes[i + 1:] - both
            hit = np.nonzero(both >= similarity * union - 1e-9)[0] + i + 1
            if len(hit):
                out += forest.link(np.full(len(hit), i), hit)
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[x] for x, _ in out], pa.binary()),
                 pa.array([keys[y] for _, y in out], pa.binary())], ["a", "b"])


def near_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, bits: int = 256,
                block_docs: int = BLOCK_DOCS, limit: int = CHUNK_PRINTS) -> DataFrame:
    """(key, root) of every text in a group of near duplicates; key is the MD5 of the text.

    A link is a Jaccard similarity of at least ``similarity`` between the sets of
    ``words``-word shingles, proven on the sets themselves. Candidates share one of their rare
    shingles, which all such pairs do, and have fingerprints within
    ``radius_for(similarity, bits)``, which leaves out at most ``MISSED`` of the pairs at any
    size of the sets. Shingles are ordered by how common they are in all
    texts, so a passage that many texts share makes no large shard where texts have
    anything else. Candidate groups are verified in blocks of about ``block_docs`` texts, each
    pair of blocks in a task of its own, so no group has to fit one task.
    """
    spark = docs.sparkSession
    key = F.unhex(F.md5(full_text(docs["text"])))
    counts = shingle_counts(docs.select(docs["text"].alias("text")), words)
    prints = materialize(docs.select(
        key.alias("key"), sketch(words, bits, similarity, counts)(docs["text"]).alias("s"))
        .select("key", "s.fp", "s.rare"))
    near = components(link_by_rare_shingles(prints.select("fp", "rare").distinct(),
                                            radius_for(similarity, bits), bits, limit))
    # Texts with equal fingerprints are candidates as well.
    by_print = (prints.select("key", "fp").distinct()
                .join(near, F.col("fp") == F.col("node"), "left")
                .select("key", F.coalesce("root", "fp").alias("group")))
    by_print = materialize(by_print)
    sizes = by_print.groupBy("group").agg(F.count("*").alias("n")).where("n > 1")
    members = by_print.join(sizes, "group")
    blocks = F.ceil(F.col("n") / block_docs).cast("int")
    mine = F.pmod(F.xxhash64("key"), blocks).cast("int")
    texts = docs.select(key.alias("key"), full_text(docs["text"]).alias("text"))
    sets = (texts.join(members.select("key", "group", blocks.alias("nb"), mine.alias("own")),
                       "key")
            .select("key", "group", "nb", "own", shingle_set(words)(F.col("text"))
                    .alias("shingles")))
    pairs = sets.select(
        "key", "shingles", F.explode(F.transform(
            F.sequence(F.lit(0), F.col("nb") - 1),
            lambda other: F.xxhash64("group", F.least("own", other),
                                     F.greatest("own", other)))).alias("block"))
    links = (pairs.repartition(tasks(spark), "block").sortWithinPartitions("block")
             .mapInArrow(lambda batches: _verified_links(batches, similarity),
                         "a binary, b binary"))
    return components(links)


def deduplicate(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group, all columns.

    The smallest doc_id of a group stays (a null id only if no other is there); equal texts
    are one group. Of rows that repeat both id and text, the largest by all columns stays.
    """
    key = F.unhex(F.md5(full_text(docs["text"])))
    groups = near_groups(docs, words, similarity)
    ids = materialize(docs.select(docs["doc_id"].alias("__id"), key.alias("__key")))
    rooted = (ids.join(groups, ids["__key"] == groups["node"], "left")
              .select("__id", "__key", F.coalesce("root", "__key").alias("__root")))
    first = rooted.groupBy("__root").agg(
        F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"),
                       F.col("__key").alias("key"))).alias("__first"))
    judged = rooted.join(first, "__root").select(
        "__id", "__key", (F.col("__id").eqNullSafe(F.col("__first.id"))
                          & (F.col("__key") == F.col("__first.key"))).alias("__stays"))
    judged = materialize(judged)
    keyed = {"__id": docs["doc_id"], "__key": key}
    losers = judged.where("not __stays").select("__id", "__key").distinct()
    repeated = (judged.where("__stays").groupBy("__id", "__key").count().where("count > 1")
                .select("__id", "__key"))
    return one_per_key(without(docs, losers, keyed), keyed, repeated)
