"""The trie of conversation prefixes.

Every conversation c is rebuilt: the first h = crc32(c) % 6 turns of conversation c - c % 100,
then its own turns after the first h. A node is a distinct sequence of the first d turns of
rebuilt conversations; the root (d = 0) has no turn and all conversations as members.

1. A prefix digest is the exclusive or of hashes of (depth, SHA-256 of role and text), 2 x 64
   bits. It is associative, so a long conversation is digested in blocks of depths with one
   summary row a block.
2. Shards of rows enumerate their distinct digests and give them slots by a minimal perfect
   hash; a slot keeps its digest, so a foreign one is recognised. Counts are scattered into flat
   arrays by slot. Spark adds up the shards' nodes, and verifies that equal digests have equal
   parents and equal last turns, hence by induction equal sequences; a collision fails the run.
3. What a node adds to the sums of its ancestors (one leaf, saved code points) lies with its
   smallest member, which passes through all of them. Shards of (conversation, block) scatter
   these values into their slots and add them up through the parents' slots, deepest first. The
   last row of a block starts with what later blocks of its conversation hold. Spark adds up the
   shards' sums of each node. So neither a subtree nor a conversation has to fit one task.
4. Ids of conversations that end at a node are joined in pieces where they lie, in order of id;
   one pass over a node's pieces hashes them.

Defined results: turns follow their number, null first, equal numbers by the SHA-256 of role and
text; repeated rows are turns one by one. Null role or text is empty. Rows without a conv_id
belong to no conversation and are left out. A conversation may end up without turns and is then
a member of the root alone. Empty tables give empty results, without a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from newsledger.llm.common import tasks
from newsledger.session import materialize

#: Conversations that borrow from one, and the first turns that can be borrowed.
FAMILY, BORROWED = 100, 5
#: Depths in a block, rows in a shard, ids in a piece.
BLOCK, SHARD_ROWS, PIECE_IDS = 1024, 200_000, 4096
NODE = ("depth", "d1", "d2")
_EMPTY = hashlib.sha256(b"").hexdigest()

ORACLE = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(
           length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS r
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id AS c, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                                             lambda x: CAST(ascii(x) AS BIGINT))),
    lambda a, b: list_reduce(list_concat([xor(a, b)], CAST(range(8) AS BIGINT[])),
      lambda e, i: xor(e >> 1, CASE WHEN e & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT conv_id AS base, count(*) AS size FROM t GROUP BY conv_id),
s AS (
  SELECT c, r AS d, role, text FROM c JOIN t ON t.conv_id = c.base AND r <= h
  UNION ALL
  SELECT c, least(h, coalesce(size, 0)) + r - h, role, text
  FROM c LEFT JOIN b USING (base) JOIN t ON t.conv_id = c.c AND r > h),
l AS (
  SELECT c.c, coalesce(list({'role': role, 'text': text} ORDER BY d) FILTER (d IS NOT NULL),
                       []) AS turns
  FROM c LEFT JOIN s ON s.c = c.c GROUP BY c.c),
p AS (
  SELECT c, d, turns[1:d] AS key, len(turns) AS size,
         CASE WHEN d > 0 THEN length(turns[d].text) ELSE 0 END AS n
  FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM l)),
n AS (
  SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (size = d), ''))
           AS ends
  FROM p GROUP BY key, d),
k AS (SELECT key[1:d - 1] AS key, d - 1 AS d, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1, 2),
v AS (
  SELECT p.key, p.d, sum((u.n_convs - 1) * u.n) AS saved,
         count(*) FILTER (k.kids IS NULL) AS leaves
  FROM n u LEFT JOIN k ON k.d = u.d AND k.key = u.key JOIN p ON p.c = u.conv_id AND p.d <= u.d
  GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, m.conv_id AS parent_conv_id, n.n_convs,
       coalesce(kids, 0) AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       n.ends AS ends_sha256
FROM n JOIN v ON v.d = n.d AND v.key = n.key LEFT JOIN k ON k.d = n.d AND k.key = n.key
LEFT JOIN n m ON m.d = n.d - 1 AND m.key = n.key[1:n.d - 1]
"""


# ---- slots

class Slots:
    """A minimal perfect hash of distinct digests.

    Each level hashes what is left into twice as many places; digests alone in theirs are
    settled, and the number of settled places before one is its slot. Slots keep their digests,
    so the answer for a digest outside the set is -1.
    """

    def __init__(self, d1: np.ndarray, d2: np.ndarray):
        both = np.unique(np.stack([d1, d2], axis=1).view([("a", d1.dtype), ("b", d2.dtype)]))
        first, second = both["a"].copy(), both["b"].copy()
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, settled = np.arange(len(both)), 0
        while len(left):
            places = self._places(first[left], second[left], len(self.levels), 2 * len(left) + 1)
            crowd = np.bincount(places, minlength=2 * len(left) + 1)
            alone = crowd == 1
            self.levels.append((alone, settled + np.cumsum(alone) - 1))
            settled += int(alone.sum())
            left = left[crowd[places] > 1]
        self.size = settled
        self.d1, self.d2 = np.empty_like(first), np.empty_like(second)
        slots = self._look_up(first, second)
        self.d1[slots], self.d2[slots] = first, second

    @staticmethod
    def _places(d1: np.ndarray, d2: np.ndarray, level: int, size: int) -> np.ndarray:
        odd = np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) & (2 ** 64 - 1))
        mixed = d1.view(np.uint64) + d2.view(np.uint64) * odd
        mixed = (mixed ^ (mixed >> np.uint64(29))) * odd
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def _look_up(self, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(d1), -1, np.int64), np.arange(len(d1))
        for level, (alone, slots) in enumerate(self.levels):
            places = self._places(d1[open_], d2[open_], level, len(alone))
            hit = alone[places]
            out[open_[hit]] = slots[places[hit]]
            open_ = open_[~hit]
        return out

    def __call__(self, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        out = self._look_up(d1, d2)
        known = out >= 0
        known[known] = (self.d1[out[known]] == d1[known]) & (self.d2[out[known]] == d2[known])
        return np.where(known, out, -1)


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy().astype(np.int64) for n in names]


def _verified(slots: np.ndarray, size: int, values: np.ndarray) -> np.ndarray:
    """One value for each slot; all rows of the slot must have it."""
    held = np.zeros((size, *values.shape[1:]), values.dtype)
    held[slots] = values
    if not np.array_equal(held[slots], values):
        raise ValueError("two prefixes have one digest")
    return held


def _shards(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield pa.Table.from_batches(held)
            held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


def _nodes(batches: Iterable[pa.RecordBatch], rows: int):
    """The nodes of each shard with their members counted."""
    for table in _shards(batches, rows):
        conv, depth, d1, d2, p1, p2, length = _numbers(
            table, "conv_id", "depth", "d1", "d2", "p1", "p2", "len")
        slots = Slots(d1, d2)
        at, size = slots(d1, d2), slots.size
        turn = np.frombuffer(b"".join(table.column("turn").to_pylist()), np.int64).reshape(-1, 4)
        same = _verified(at, size, np.column_stack([depth, p1, p2, length, turn]))
        least = np.full(size, np.iinfo(np.int64).max)
        np.minimum.at(least, at, conv)
        turns = [row.tobytes() for row in np.ascontiguousarray(same[:, 4:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(same[:, 0].copy()), pa.array(slots.d1), pa.array(slots.d2),
             pa.array(same[:, 1].copy()), pa.array(same[:, 2].copy()), pa.array(turns, pa.binary()),
             pa.array(same[:, 3].copy()), pa.array(np.bincount(at, minlength=size)),
             pa.array(least)],
            [*NODE, "p1", "p2", "turn", "len", "n_convs", "conv_id"])


def _units(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Shards of about ``rows`` rows that hold whole blocks of conversations, from rows in order
    of conversation and block."""
    rest: list[pa.RecordBatch] = []
    for table in _shards(batches, rows):
        table = pa.Table.from_batches([*rest, *table.to_batches()])
        conv, block = _numbers(table, "conv_id", "block")
        cut = len(conv) - 1
        while cut and conv[cut - 1] == conv[-1] and block[cut - 1] == block[-1]:
            cut -= 1
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut).to_batches()
    if rest:
        yield pa.Table.from_batches(rest)


def _subtrees(batches: Iterable[pa.RecordBatch], block: int, rows: int):
    """Sums over the subtrees of each shard's nodes, within their block of depths."""
    for table in _units(batches, rows):
        depth, d1, d2, p1, p2, leaf, saved = _numbers(
            table, "depth", "d1", "d2", "p1", "p2", "leaf", "saved")
        slots = Slots(d1, d2)
        at, size = slots(d1, d2), slots.size
        above = np.where(depth % block == 0, -1, slots(p1, p2))
        parent, level = _verified(at, size, above), _verified(at, size, depth)
        leaves, sums = np.zeros(size, np.int64), np.zeros(size, np.int64)
        np.add.at(leaves, at, leaf)
        np.add.at(sums, at, saved)
        order = np.argsort(-level, kind="stable")
        edges = np.flatnonzero(np.diff(level[order])) + 1
        for group in np.split(order, edges):  # one depth at a time, the deepest first
            group = group[parent[group] >= 0]
            np.add.at(leaves, parent[group], leaves[group])
            np.add.at(sums, parent[group], sums[group])
        some = np.flatnonzero((leaves > 0) | (sums > 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[some]) for x in (level, slots.d1, slots.d2, leaves, sums)],
            [*NODE, "n_leaves", "saved_tokens"])


def _pieces(batches: Iterable[pa.RecordBatch], piece: int):
    """Ids that end at a node, comma-joined in pieces, from rows in order of id."""
    held: dict[tuple, list[int]] = {}
    count = 0

    def out(keys: list[tuple]) -> pa.RecordBatch:
        rows = [(*key, ids[0], ",".join(map(str, ids))) for key in keys
                for ids in [held.pop(key)]]
        columns = list(zip(*rows)) or [[]] * 5
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.string())],
            [*NODE, "first", "ids"])

    for batch in batches:
        full = []
        for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id"))):
            ids = held.setdefault(tuple(key), [])
            ids.append(conv)
            count += 1
            if len(ids) == piece:
                full.append(tuple(key))
                count -= piece
                yield out(full)
                full = []
        if count > SHARD_ROWS:
            yield out(list(held))
            count = 0
    yield out(list(held))


def _ends(batches: Iterable[pa.RecordBatch]):
    """The hash of each node's ids, from its pieces in order."""
    last, running = None, None
    for batch in batches:
        done = []
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if key != last:
                if last:
                    done.append((*last, running.hexdigest()))
                last, running = key, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        if done:
            yield _hashed(done)
    if last:
        yield _hashed([(*last, running.hexdigest())])


def _hashed(rows: list[tuple]) -> pa.RecordBatch:
    *keys, hashes = zip(*rows)
    return pa.RecordBatch.from_arrays([*[pa.array(k, pa.int64()) for k in keys],
                                       pa.array(hashes, pa.string())], [*NODE, "ends_sha256"])


# ---- rebuilding

def borrowed_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes over: unsigned crc32 of its number, modulo 6."""
    return F.crc32(conv_id.cast("string")) % (BORROWED + 1)


def _ranked(turns: DataFrame) -> DataFrame:
    """(conv_id, rank from 1, turn digest, len): the original turns in order.

    Equal rows travel as one with their count; a conversation is ranked slice by slice, slices
    being the tasks of a sort over the whole table, with one summary row a slice.
    """
    role, text = (F.coalesce(turns[c], F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text),
                            256))
    rows = (turns.where(turns["conv_id"].isNotNull())
            .select(turns["conv_id"].cast("long").alias("conv_id"),
                    turns["turn"].cast("long").alias("number"), digest.alias("turn"),
                    F.char_length(text).cast("long").alias("len"))
            .groupBy("conv_id", "number", "turn", "len").agg(F.count("*").alias("n")))
    rows = materialize(rows.repartitionByRange(tasks(turns.sparkSession), "conv_id", "number",
                                               "turn")
                       .withColumn("slice", F.spark_partition_id()))
    inside = (Window.partitionBy("conv_id", "slice").orderBy("number", "turn")
              .rowsBetween(Window.unboundedPreceding, -1))
    earlier = (Window.partitionBy("conv_id").orderBy("slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    before = (rows.groupBy("conv_id", "slice").agg(F.sum("n").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n"))
    placed = (rows.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
              .join(before, ["conv_id", "slice"])
              .withColumn("start", F.col("before") + F.col("inside")))
    # copies become turns of their own, a thousand a row first
    chunk = placed.withColumn("chunk", F.explode(F.expr(f"sequence(0, (n - 1) div {BLOCK})")))
    return chunk.withColumn("copy", F.explode(F.expr(
        f"sequence(chunk * {BLOCK}, least(n, (chunk + 1) * {BLOCK}) - 1)"))).select(
        "conv_id", (F.col("start") + F.col("copy") + 1).alias("rank"), "turn", "len")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length), and rows (conv_id, depth, turn, len, last) of the rebuilt
    ones, with a row of depth 0 for each."""
    ranked = materialize(_ranked(turns))
    own_h = borrowed_turns(F.col("conv_id"))
    heads = (ranked.where((F.col("conv_id") % FAMILY == 0) & (F.col("rank") <= BORROWED))
             .withColumnRenamed("conv_id", "base"))
    counts = heads.groupBy("base").agg(F.count("*").alias("held"))
    convs = (ranked.groupBy("conv_id").agg(F.count("*").alias("size")).withColumn("h", own_h)
             .withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
             .join(counts, "base", "left")
             .withColumn("taken", F.least("h", F.coalesce("held", F.lit(0))))
             .withColumn("length", F.col("taken") + F.greatest(F.col("size") - F.col("h"),
                                                               F.lit(0))))
    convs = materialize(convs.select("conv_id", "base", "h", "taken", "length"))
    taken = (convs.join(heads, "base").where(F.col("rank") <= F.col("h"))
             .select("conv_id", F.col("rank").alias("depth"), "turn", "len", "length"))
    own = (ranked.where(F.col("rank") > own_h).join(convs, "conv_id")
           .select("conv_id", (F.col("taken") + F.col("rank") - F.col("h")).alias("depth"),
                   "turn", "len", "length"))
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"),
                        F.unhex(F.lit("0" * 64)).alias("turn"),
                        F.lit(0).cast("long").alias("len"), "length")
    rows = root.unionByName(taken).unionByName(own).withColumn(
        "last", F.col("depth") == F.col("length")).drop("length")
    return convs.select("conv_id", "length"), rows


def digest(rows: DataFrame, deep: bool, block: int) -> DataFrame:
    """Add digests d1, d2 of each row's prefix and p1, p2 of its parent's."""
    for i in (1, 2):
        rows = rows.withColumn(f"x{i}", F.when(F.col("depth") == 0, 0).otherwise(
            F.xxhash64(F.lit(i), "depth", "turn")))
    rows = rows.withColumn("block", F.expr(f"depth div {block}"))
    inside = (Window.partitionBy("conv_id", "block").orderBy("depth")
              .rowsBetween(Window.unboundedPreceding, 0))
    done = rows.withColumns({f"d{i}": F.bit_xor(f"x{i}").over(inside) for i in (1, 2)})
    if deep:
        earlier = (Window.partitionBy("conv_id").orderBy("block")
                   .rowsBetween(Window.unboundedPreceding, -1))
        carry = (rows.groupBy("conv_id", "block")
                 .agg(*[F.bit_xor(f"x{i}").alias(f"b{i}") for i in (1, 2)])
                 .select("conv_id", "block", *[F.coalesce(F.bit_xor(f"b{i}").over(earlier),
                                                          F.lit(0)).alias(f"c{i}")
                                               for i in (1, 2)]))
        done = done.join(carry, ["conv_id", "block"])
        done = done.withColumns({f"d{i}": F.col(f"d{i}").bitwiseXOR(F.col(f"c{i}"))
                                 for i in (1, 2)})
    return done.select("conv_id", "depth", "block", "turn", "len", "last", "d1", "d2",
                       *[F.col(f"d{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"p{i}")
                         for i in (1, 2)])


# ---- the trie

def _merged(parts: DataFrame) -> DataFrame:
    """The nodes of all shards; a digest of two different prefixes fails the run."""
    what = F.struct("p1", "p2", "turn", "len")
    merged = parts.groupBy(*NODE).agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.min(what).alias("a"), F.max(what).alias("b"))
    return merged.withColumn("a", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(
        F.raise_error(F.lit("two prefixes have one digest")))).select(
        *NODE, "a.p1", "a.p2", "a.len", "n_convs", "conv_id")


def _carried(values: DataFrame, convs: DataFrame, block: int) -> DataFrame:
    """``values`` plus, on the last row of each block, what later blocks of the conversation
    hold."""
    later = (Window.partitionBy("conv_id").orderBy(F.col("block").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    totals = (values.withColumn("block", F.expr(f"depth div {block}"))
              .groupBy("conv_id", "block").agg(F.sum("leaf").alias("leaf"),
                                               F.sum("saved").alias("saved")))
    blocks = convs.where(F.col("length") >= block).select(
        "conv_id", F.explode(F.expr(f"sequence(0, length div {block})")).alias("block"))
    carry = (blocks.join(totals, ["conv_id", "block"], "left")
             .select("conv_id", ((F.col("block") + 1) * block - 1).alias("depth"),
                     *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(c)
                       for c in ("leaf", "saved")])
             .where((F.col("leaf") > 0) | (F.col("saved") > 0)))
    return (values.unionByName(carry).groupBy("conv_id", "depth")
            .agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")))


def trie(turns: DataFrame, block: int = BLOCK, shard_rows: int = SHARD_ROWS,
         piece_ids: int = PIECE_IDS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    width = tasks(turns.sparkSession)
    convs, rebuilt = rebuild(turns)
    deep = not convs.where(F.col("length") >= block).isEmpty()
    rows = materialize(digest(rebuilt, deep, block))
    long = "long"
    nodes = materialize(_merged(
        rows.select("conv_id", *NODE, "p1", "p2", "turn", "len")
        .mapInArrow(lambda b: _nodes(b, shard_rows),
                    "depth long, d1 long, d2 long, p1 long, p2 long, turn binary, len long, "
                    "n_convs long, conv_id long")))
    children = (nodes.where(F.col("depth") > 0)
                .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"),
                         F.col("p2").alias("d2")).agg(F.count("*").alias("n_children")))
    nodes = materialize(nodes.join(children, list(NODE), "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))))

    values = nodes.select("conv_id", "depth", (F.col("n_children") == 0).cast(long).alias("leaf"),
                          ((F.col("n_convs") - 1) * F.col("len")).alias("saved"))
    values = values.where((F.col("leaf") > 0) | (F.col("saved") > 0))
    if deep:
        values = _carried(values, convs, block)
    sums = (rows.select("conv_id", "block", *NODE, "p1", "p2")
            .join(values, ["conv_id", "depth"], "left").fillna(0, ["leaf", "saved"])
            .repartition(width, "conv_id", "block").sortWithinPartitions("conv_id", "block")
            .mapInArrow(lambda b: _subtrees(b, block, shard_rows),
                        "depth long, d1 long, d2 long, n_leaves long, saved_tokens long"))
    ends = (rows.where("last").select(*NODE, "conv_id")
            .repartitionByRange(width, "conv_id").sortWithinPartitions("conv_id")
            .mapInArrow(lambda b: _pieces(b, piece_ids),
                        "depth long, d1 long, d2 long, first long, ids string")
            .repartition(width, *NODE).sortWithinPartitions(*NODE, "first")
            .mapInArrow(_ends, "depth long, d1 long, d2 long, ends_sha256 string"))
    # one aggregate puts a node's counts, sums and hash together
    parts = (nodes.select(*NODE, "p1", "p2", "conv_id", "n_convs", "n_children")
             .unionByName(sums, True).unionByName(ends, True))
    whole = parts.groupBy(*NODE).agg(
        *[F.max(c).alias(c) for c in ("p1", "p2", "conv_id", "n_convs", "n_children",
                                      "ends_sha256")],
        *[F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")])
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"),
                         F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return whole.join(above, ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))
