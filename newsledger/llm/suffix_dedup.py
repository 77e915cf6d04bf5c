"""Suffix-array deduplication: remove bytes of strings that occur earlier in the corpus.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document
with a smaller id, or earlier in the same one. No suffix array of the whole corpus is ever
needed, because equal strings can be brought together first:

1. Anchors. Each window of ``length`` bytes is named after the smallest hash among its
   substrings of 32 bytes. Equal windows have equal names, and neighbouring windows mostly
   share one, so a text falls into runs of about 35 windows of one name. Runs meet by name;
   a name seen once is settled, unless its run repeats inside, as in periodic text; runs are
   cut at ``RUN_WINDOWS``, so however long such a text is, its cuts are copies of a few. Runs
   that also agree in all their bytes (64-bit digest, within a name) are copies: the first
   stays, the others are removed whole.
2. Suffix order. Names with different runs are where copies begin and end. Their runs' bytes,
   one of each kind, are gathered by name, the windows are put in suffix order, ties by
   position, and the longest-previous-factor array follows from the previous and next smaller
   positions: a window goes if its value reaches ``length``. A name with very many windows is
   sorted by Spark window by window instead of in one task; there a window's previous smaller
   position is the entry before it, if the two are equal.
3. Cutting. Each document gets its removed windows and cuts their union out of its text.

Steps 1 and 2 read rows that Spark has sorted by name in a stream, so a string that a third
of all documents share never has to fit in memory.

Defined results: null text is empty. A null doc_id is larger than any other. Rows that repeat
an id and text are one document and get the same result; of different texts with one id, that
with the smaller hash is earlier. Texts shorter than ``length`` bytes lose nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from newsledger.llm.common import full_text, tasks
from newsledger.operators.skew import broadcast_if_small
from newsledger.session import materialize

LENGTH, GRAM = 100, 32
#: Windows of one name that a task puts in suffix order; Spark sorts larger names.
CROWDED = 500_000
#: Tasks that a window of a crowded name is dealt over.
SALTS = 64
#: Windows put in suffix order at once.
CHUNK = 100_000
#: Windows of a run: longer stretches of one name, as periodic text has, are cut there. A
#: multiple of each period up to 10, so that all cuts of such a text are copies.
RUN_WINDOWS = 2520
#: Windows of a text that are named at once.
BLOCK = 1 << 20
_RANDOM = np.random.Generator(np.random.PCG64(2024)).integers(0, 2**64, 256, np.uint64)
_FACTOR = 0x9E3779B97F4A7C15


# ---- step 1: runs of windows with one name

def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each substring of 32 bytes, by doubling."""
    h, power, size = _RANDOM[data], _FACTOR, 1
    while size < GRAM:
        h = h[:-size] * np.uint64(power) + h[size:]
        power, size = power * power % 2**64, size * 2
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_names(low: np.ndarray, length: int) -> np.ndarray:
    """The smallest of the substring hashes in every window of ``length`` bytes."""
    size, width = 1, length - GRAM + 1
    while 2 * size <= width:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    if size < width:
        low = np.minimum(low[:size - width], low[width - size:])
    return low


def runs(text: bytes, length: int) -> tuple:
    """(name, digest of all bytes, first window, window after the last, whether the run may
    repeat inside: its name is a substring hash that the text has more than once) of each run."""
    grams = gram_hashes(np.frombuffer(text, np.uint8))
    names = window_names(grams, length)
    cuts = np.nonzero(names[1:] != names[:-1])[0] + 1
    lo = np.concatenate([[0], cuts])
    hi = np.concatenate([cuts, [len(names)]])
    if (parts := -(-(hi - lo) // RUN_WINDOWS)).max() > 1:
        first = np.repeat(lo, parts)
        nth = np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts)
        lo = first + nth * RUN_WINDOWS
        hi = np.minimum(lo + RUN_WINDOWS, np.repeat(hi, parts))
    digest, reach = xxhash.xxh3_64_intdigest, length - 1
    marks = [digest(text[a:b]) for a, b in zip(lo.tolist(), (hi + reach).tolist())]
    ranked = np.sort(grams)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    own = np.isin(names[lo], twice) if len(twice) else np.zeros(len(lo), bool)
    return names[lo], np.array(marks, np.uint64), lo, hi, own


RUN = "name long, mark long, ord long, tie long, lo int, hi int, own boolean"
RUN_COLUMNS = [part.split()[0] for part in RUN.split(", ")]


def _run_rows(batches, length: int):
    for batch in batches:
        made = []
        for ord_, tie, text in zip(*(c.to_pylist() for c in batch)):
            data = text.encode("utf-8", "surrogatepass")
            for at in range(0, len(data) - length + 1, BLOCK):
                names, marks, lo, hi, own = runs(data[at:at + BLOCK + length - 1], length)
                n = len(names)
                made.append((names.view(np.int64), marks.view(np.int64),
                             np.full(n, ord_, np.int64), np.full(n, tie, np.int64),
                             (lo + at).astype(np.int32), (hi + at).astype(np.int32), own))
        if made:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in zip(*made)], RUN_COLUMNS)


def _repeated_runs(batches):
    """From sorted runs: copies, and as open the first of each kind where a name has several
    kinds or the run may repeat inside. Keeps two rows between batches."""
    columns = RUN_COLUMNS
    first = None      # the first row of the present kind
    pending = None    # the first row of a name with one kind so far
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        n = batch.num_rows
        same_name, same_kind = np.zeros(n, bool), np.zeros(n, bool)
        same_name[1:] = rows[0][1:] == rows[0][:-1]
        same_kind[1:] = same_name[1:] & (rows[1][1:] == rows[1][:-1])
        if first is not None:
            same_name[0] = rows[0][0] == first[0]
            same_kind[0] = same_name[0] and rows[1][0] == first[1]
        starts = np.nonzero(~same_kind)[0]
        # the first row of each row's kind: in this batch, or the one carried over
        of = np.maximum.accumulate(np.where(same_kind, -1, np.arange(n)))
        own = [np.where(of < 0, first[k] if first is not None else 0, rows[k][np.maximum(of, 0)])
               for k in (0, 1, 2, 3, 4)]
        copy = same_kind & ~((rows[2] == own[2]) & (rows[3] == own[3]) & (rows[4] == own[4]))
        # a kind that is not its name's first shows that the name has several
        later = ~same_kind & same_name
        opens = ~same_kind & ~same_name
        several = later.copy()
        lead = np.maximum.accumulate(np.where(opens, np.arange(n), -1))
        hit = np.unique(lead[later])
        several[hit[hit >= 0]] = True
        several |= ~same_kind & rows[6]
        out = [np.concatenate([r[copy], r[several]]) for r in rows]
        kind = np.concatenate([np.zeros(copy.sum(), bool), np.ones(several.sum(), bool)])
        if pending is not None and (hit == -1).any():
            out = [np.concatenate([o, [pending[k]]]).astype(o.dtype) for k, o in enumerate(out)]
            kind = np.concatenate([kind, [True]])
            pending = None
        if opens.any():
            last = int(np.nonzero(opens)[0][-1])
            pending = None if several[last] else [r[last] for r in rows]
        if len(starts):
            first = [r[starts[-1]] for r in rows]
        if len(kind):
            yield pa.RecordBatch.from_arrays([pa.array(o) for o in out] + [pa.array(kind)],
                                             columns + ["open"])


# ---- step 2: suffix order

def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """The place of the nearest smaller entry before each one, or -1, for values 0 to n - 1.

    All entries climb a tree of minima at once until a left neighbour holds a smaller value, and
    go down in it to the last such entry: two passes over the levels, whatever the order.
    """
    n = len(values)
    levels = [values]
    while len(levels[-1]) > 1:
        low = levels[-1]
        low = np.append(low, n) if len(low) % 2 else low
        levels.append(np.minimum(low[::2], low[1::2]))
    found, height = np.full(n, -1), np.full(n, -1)
    climbing = np.arange(n)
    for k, low in enumerate(levels):
        left = (climbing >> k) - 1
        hit = (left & 1) == 0
        hit[hit] = low[left[hit]] < values[climbing[hit]]
        found[climbing[hit]], height[climbing[hit]] = left[hit], k
        climbing = climbing[~hit]
    for k in range(len(levels) - 1, 0, -1):
        down = np.nonzero(height >= k)[0]
        right = 2 * found[down] + 1
        low = np.append(levels[k - 1], n)  # the last node of a level may have no right half
        found[down] = right - (low[right] >= values[down])
    return found


def _shared(chars: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of windows ``a`` and ``b``; 0 where ``b`` is -1."""
    out = np.zeros(len(a), np.int64)
    for at in range(0, len(a), 8192):
        own, other = a[at:at + 8192], b[at:at + 8192]
        differ = chars[own] != chars[other]
        out[at:at + 8192] = np.where(differ.any(1), differ.argmax(1), chars.shape[1])
    return np.where(b < 0, 0, out)


def previous_factors(windows: np.ndarray, length: int) -> np.ndarray:
    """Longest previous factor, up to ``length``, of windows given in order of position.

    Windows are sorted by content and, where equal, by position. In that order the nearest
    entry before or behind with a smaller position shares the longest prefix with any earlier
    window.
    """
    order = np.argsort(windows, kind="stable")
    chars = windows.view(np.uint8).reshape(len(windows), length)
    before, behind = nearest_smaller(order), nearest_smaller(order[::-1])[::-1]
    behind = np.where(behind < 0, -1, len(order) - 1 - behind)
    best = np.zeros(len(windows), np.int64)
    for near in (before, behind):
        shared = _shared(chars, order, np.where(near < 0, -1, order[near]))
        best[order] = np.maximum(best[order], shared)
    return best


def _piece_rows(batches, length: int):
    """The bytes of each open run, one row a run."""
    for batch in batches:
        out = []
        for ord_, tie, text, spans in zip(*(c.to_pylist() for c in batch)):
            data = text.encode("utf-8", "surrogatepass")
            out += [(s["name"], ord_, tie, s["lo"], data[s["lo"]:s["hi"] + length - 1], s["hot"])
                    for s in spans]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(),
                                                            pa.int32(), pa.binary(),
                                                            pa.bool_()))],
                ["name", "ord", "tie", "lo", "piece", "hot"])


def _windows(pieces: list[bytes], length: int) -> np.ndarray:
    """All windows of the pieces, in order."""
    views = [np.lib.stride_tricks.sliding_window_view(np.frombuffer(p, np.uint8), length)
             for p in pieces]
    return np.ascontiguousarray(np.concatenate(views)).view(f"S{length}").ravel()


def _settle(held: list[tuple], length: int) -> pa.RecordBatch | None:
    """Removed stretches of windows among pieces that arrive in order of name and position."""
    held.sort(key=lambda r: r[1:4])
    gone = previous_factors(_windows([r[4] for r in held], length), length) >= length
    at, out = 0, []
    for _, ord_, tie, lo, piece in held:
        n = len(piece) - length + 1
        edge = np.diff(np.concatenate([[0], gone[at:at + n], [0]]).astype(np.int8))
        out += [(ord_, tie, lo + int(a), lo + int(b))
                for a, b in zip(np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0])]
        at += n
    if not out:
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(),
                                                    pa.int32()))], ["ord", "tie", "lo", "hi"])


def _suffix_order(batches, length: int):
    """Pieces sorted by name, settled some names at a time."""
    held, windows, name = [], 0, None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns[:5])):
            if windows >= CHUNK and row[0] != name:
                if (made := _settle(held, length)) is not None:
                    yield made
                held, windows = [], 0
            held.append(row)
            windows += len(row[4]) - length + 1
            name = row[0]
    if held and (made := _settle(held, length)) is not None:
        yield made


def _split_windows(batches, length: int):
    for batch in batches:
        for _, ord_, tie, lo, piece in zip(*(c.to_pylist() for c in batch.columns[:5])):
            n = len(piece) - length + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([piece[i:i + length] for i in range(n)], pa.binary()),
                 pa.array(np.full(n, ord_, np.int64)), pa.array(np.full(n, tie, np.int64)),
                 pa.array(np.arange(lo, lo + n, dtype=np.int32))], ["window", "ord", "tie", "lo"])


SPLIT = "window binary, ord long, tie long, lo int"


def _mark_firsts(batches):
    """Rows sorted by window and position: which are the first of their window here."""
    last = None
    for batch in batches:
        windows = batch.column("window").to_pylist()
        first = [w != (windows[i - 1] if i else last) for i, w in enumerate(windows)]
        last = windows[-1] if windows else last
        kept = pa.array([w if f else None for w, f in zip(windows, first)], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [kept, *(batch.column(c) for c in ("ord", "tie", "lo")), pa.array(first, pa.bool_())],
            ["window", "ord", "tie", "lo", "first"])


def _after_first(split: DataFrame) -> DataFrame:
    """All windows but the first of each content.

    A window that very many documents hold is dealt over ``SALTS`` tasks by position. Each
    settles all it holds but its first; only these firsts meet in one place.
    """
    n = tasks(split.sparkSession)
    salt = F.pmod(F.xxhash64("ord", "tie", "lo"), F.lit(SALTS))
    order, kinds = ["window", "ord", "tie", "lo"], f"{SPLIT}, first boolean"
    dealt = materialize(split.repartition(n, "window", salt).sortWithinPartitions(*order)
                        .mapInArrow(_mark_firsts, kinds))
    met = (dealt.where("first").drop("first").repartition(n, "window")
           .sortWithinPartitions(*order).mapInArrow(_mark_firsts, kinds))
    return (dealt.where("not first").unionByName(met.where("not first"))
            .select("ord", "tie", "lo", (F.col("lo") + 1).alias("hi")))


# ---- step 3: cutting

def cut(text: bytes, spans: Iterable[dict] | None, length: int) -> tuple[int, int, bytes]:
    """(removed bytes, removed runs, what stays) for stretches of removed windows."""
    if spans is None:
        return 0, 0, text
    ranges = sorted((s["lo"], s["hi"] + length - 1) for s in spans)
    kept, removed, n, end = [], 0, 0, 0
    start, stop = ranges[0]
    for a, b in ranges[1:] + [(len(text) + 1, 0)]:
        if a <= stop:
            stop = max(stop, b)
            continue
        kept.append(text[end:start])
        removed, n, end = removed + stop - start, n + 1, stop
        start, stop = a, b
    kept.append(text[end:])
    return removed, n, b"".join(kept)


def cutter(length: int):
    """Column function: text and removed windows to counts, digest and remaining bytes' text."""
    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def run(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for text, own in zip(texts, spans):
            data = text.encode("utf-8", "surrogatepass")
            removed, n, kept = cut(data, own if own is not None and len(own) else None, length)
            rows.append((len(data), removed, n, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def remainder(length: int):
    """Column function: text and removed windows to the bytes that stay."""
    @F.pandas_udf("binary")
    def run(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut(t.encode("utf-8", "surrogatepass"),
                              s if s is not None and len(s) else None, length)[2]
                          for t, s in zip(texts, spans)], dtype=object)
    return run


# ---- operators

def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, ord, tie, text): ord and tie order the documents and name each one."""
    ord_ = F.coalesce(docs["doc_id"], F.lit(2**63 - 1)).cast("long")
    ids = docs.select(ord_.alias("ord")).groupBy("ord").count().where("count > 1")
    text = full_text(docs["text"])
    tie = F.lit(0).cast("long") if ids.isEmpty() else F.xxhash64(text)
    return docs.select(docs["doc_id"], ord_.alias("ord"), tie.alias("tie"), text.alias("text"))


def removed_windows(rows: DataFrame, length: int = LENGTH, crowded: int = CROWDED) -> DataFrame:
    """(ord, tie, lo, hi): stretches of windows that occur earlier, from (ord, tie, text)."""
    spark = rows.sparkSession
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    found = rows.select("ord", "tie", "text").mapInArrow(lambda b: _run_rows(b, length), RUN)
    repeated = materialize(found.repartition("name").sortWithinPartitions(*RUN_COLUMNS[:6])
                           .mapInArrow(_repeated_runs, f"{RUN}, open boolean"))
    open_ = repeated.where("open")
    large = (open_.groupBy("name").agg(F.sum(F.col("hi") - F.col("lo")).alias("windows"))
             .where(F.col("windows") > crowded).select("name", F.lit(True).alias("hot")))
    large = materialize(large)
    hot = not large.isEmpty()
    if hot:  # few names: each stands for ``crowded`` windows
        open_ = open_.join(broadcast_if_small(large), "name", "left")
    else:
        open_ = open_.withColumn("hot", F.lit(None).cast("boolean"))
    spans = open_.groupBy("ord", "tie").agg(F.collect_set(F.struct(
        "name", "lo", "hi", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("spans"))
    texts = rows.select("ord", "tie", "text")
    piece = "name long, ord long, tie long, lo int, piece binary, hot boolean"
    pieces = (texts.join(spans, ["ord", "tie"]).select("ord", "tie", "text", "spans")
              .mapInArrow(lambda b: _piece_rows(b, length), piece))
    pieces = materialize(pieces) if hot else pieces
    window = "ord long, tie long, lo int, hi int"
    settled = (pieces.where("not hot").repartition(tasks(spark), "name")
               .sortWithinPartitions("name")
               .mapInArrow(lambda b: _suffix_order(b, length), window))
    out = repeated.where("not open").select("ord", "tie", "lo", "hi").unionByName(settled)
    if hot:
        out = out.unionByName(_after_first(
            pieces.where("hot").mapInArrow(lambda b: _split_windows(b, length), SPLIT)))
    return out


def _with_spans(docs: DataFrame, length: int, crowded: int) -> DataFrame:
    rows = _keyed(docs)
    gone = materialize(removed_windows(rows, length, crowded).distinct()
                       .groupBy("ord", "tie")
                       .agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))
    return rows.join(gone, ["ord", "tie"], "left")


def remove_repeats(docs: DataFrame, length: int = LENGTH, crowded: int = CROWDED) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return _with_spans(docs, length, crowded).select(
        "doc_id", cutter(length)("text", "spans").alias("c")).select("doc_id", "c.*")


def kept_bytes(docs: DataFrame, length: int = LENGTH, crowded: int = CROWDED) -> DataFrame:
    """One row per document: doc_id and the bytes that stay."""
    return _with_spans(docs, length, crowded).select(
        "doc_id", remainder(length)("text", "spans").alias("kept"))
