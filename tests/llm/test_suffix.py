"""Suffix-array deduplication against a plain scan of all strings."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from newsledger.llm import suffix_dedup
from tests.llm.conftest import ODD

SMALL = "/root/testdata/sf0.001"


def brute(rows, length):
    """{(doc_id, text): result} by remembering the first place of every string."""
    first, out = set(), {}
    docs = sorted({(float("inf") if i is None else i, t or "") for i, t in rows})
    for doc_id, text in docs:
        data = text.encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            piece = data[at:at + length]
            if piece in first:
                gone[at:at + length] = b"\x01" * length
            first.add(piece)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (gone[i - 1] if i else 0) for i, g in enumerate(gone))
        out[doc_id, text] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def check(docs, rows, length, **options):
    want = brute(rows, length)
    got = sorted(map(tuple, suffix_dedup.remove_repeats(docs, length, **options).collect()),
                 key=str)
    assert got == sorted([(i, *want[float("inf") if i is None else i, t or ""])
                          for i, t in rows], key=str)
    return sum(r[2] for r in got)


def cases(seed):
    rng = random.Random(seed)
    alphabet = "ab é" if seed % 2 else "abcdefgh \n"
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(20, 400)))
                for _ in range(6)] + ["a" * 300, "xyz" * 90, "line of words\n" * 25]
    rows = []
    for i in range(80):
        parts = [rng.choice(passages) if rng.random() < 0.5 else
                 "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 120)))
                 for _ in range(rng.randrange(0, 6))]
        rows.append((rng.randrange(10_000) * 100 + i, "".join(parts)))
    return rows + [(rows[3][0] + 10**7, rows[3][1]), (rows[4][0] - 10**7, rows[4][1])]


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(make_docs, seed):
    rows = cases(seed)
    length = (100, 100, 40, 32)[seed]
    assert check(make_docs(rows), rows, length) > 1000


def test_crowded_names_give_the_same(make_docs):
    rows = cases(7)
    assert check(make_docs(rows), rows, 100, crowded=3) > 1000


def test_given_documents(spark, make_docs):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet")
            .select("doc_id", "text").collect()]
    check(make_docs(rows), rows, 100)


def test_odd_rows(make_docs):
    rows = [r for r in ODD if r[0] != 7 or "word" in r[1]] + [(None, "n" * 150)]
    assert check(make_docs(rows), rows, 100) > 0
    assert suffix_dedup.remove_repeats(make_docs([])).count() == 0
    clashing = [(1, "p" * 120), (1, "q" * 120), (2, "p" * 120)]
    got = suffix_dedup.kept_bytes(make_docs(clashing)).collect()
    # all windows of a periodic text but the first go, which leaves its first byte
    assert sorted(len(r["kept"]) for r in got) == [0, 1, 1]


def test_repeated_runs_in_batches():
    rng = random.Random(2)
    rows = sorted({(rng.randrange(6), rng.randrange(3), rng.randrange(5), 0, rng.randrange(9), 1,
                    False) for _ in range(200)}
                  | {(50 + i, 0, 1, 0, 0, 1, i % 2 == 0) for i in range(9)})

    def cut(size):
        kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.bool_()]
        batches = [pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows[i:i + size]], kinds[k]) for k in range(7)],
            suffix_dedup.RUN_COLUMNS)
            for i in range(0, len(rows), size)]
        return sorted(tuple(r.values()) for b in suffix_dedup._repeated_runs(batches)
                      for r in b.to_pylist())
    want = []
    for row in rows:
        kinds = {r[1] for r in rows if r[0] == row[0]}
        leads = [r for r in rows if r[:2] == row[:2]][0]
        if row != leads and row[2:5] != leads[2:5]:
            want.append((*row, False))
        elif row == leads and (len(kinds) > 1 or row[6]):
            want.append((*row, True))
    for size in (1, 2, 3, 7, 1000):
        assert cut(size) == sorted(want)


@pytest.mark.parametrize("seed", range(3))
def test_previous_factors(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice("ab") for _ in range(300)) * 2
    length = 12
    windows = np.array([text[i:i + length].encode() for i in range(len(text) - length + 1)],
                       f"S{length}")

    def shared(a, b):
        return next((k for k in range(length) if a[k] != b[k]), length)
    want = [max((shared(windows[i], windows[j]) for j in range(i)), default=0)
            for i in range(len(windows))]
    got = suffix_dedup.previous_factors(windows, length)
    assert got.tolist() == want


@pytest.mark.parametrize("n", [1, 2, 3, 8, 37, 200])
def test_nearest_smaller(n):
    rng = np.random.default_rng(n)
    for values in (rng.permutation(n), np.arange(n), np.arange(n)[::-1], np.roll(np.arange(n), 1)):
        want = [max((j for j in range(i) if values[j] < values[i]), default=-1) for i in range(n)]
        assert suffix_dedup.nearest_smaller(values).tolist() == want


def test_long_periodic_texts_are_cut_into_copies(make_docs, monkeypatch):
    """Runs and blocks far shorter than the texts; periods that divide a run and that do not."""
    assert max(hi - lo for _, _, lo, hi, _ in zip(*suffix_dedup.runs(b"ab" * 50_000, 100))
               ) == suffix_dedup.RUN_WINDOWS
    kinds = {mark for _, mark, *_ in zip(*suffix_dedup.runs(b"a" * 2520 * 40, 100))}
    assert len(kinds) <= 2
    rows = [(1, "a" * 30_000), (2, "xyzzyab" * 3000 + "end"), (3, "start" + "xyzzyab" * 3000),
            (4, "".join(f"line of words {i:04}\n" for i in range(1500))),
            (5, "thirteen sign" * 900), (6, "thirteen sign" * 700 + "a" * 5000)]
    assert check(make_docs(rows), rows, 100) > 80_000


def test_a_text_of_one_letter_needs_little_memory(spark):
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([0]), pa.array(["n" * 20_000_000])],
                                       ["ord", "tie", "text"])
    tracemalloc.start()
    rows = pa.Table.from_batches(suffix_dedup._run_rows([batch], 100)).to_pandas()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300_000_000 and rows["name"].nunique() == 1
    assert rows.groupby("mark").size().nlargest(1).iloc[0] > 0.9 * len(rows)
