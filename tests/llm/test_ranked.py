"""Ranked search against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from newsledger.llm import ranked_search
from newsledger.llm.ranked_search import terms
from tests.llm.conftest import BENCHMARK, ODD


def brute(docs, items, k=20):
    """The contract, row by row: sorted (item_id, rank, doc_id, score)."""
    held = [(i, Counter(ts), len(ts)) for i, t in docs if (ts := terms(t))]
    whole, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in items:
        rows = []
        for doc_id, counts, n in held:
            m, score = 100 - 25 + 25 * n * whole // length, 0
            for t in terms(text):
                if t in counts:
                    w = math.floor(1000 * math.log((2 * whole + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
            if score > 0:
                rows.append((-score, doc_id is None, doc_id or 0, doc_id, score))
        out += [(item_id, at, d, s) for at, (*_, d, s) in enumerate(sorted(rows, key=lambda r: r[:3])[:k], 1)]
    return sorted(out, key=str)


def corpus(rng, n, words=40):
    letters = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [(rng.choice([None, *range(n * 3)]) if i % 50 == 0 else i * 7 % 1000,
             " ".join(rng.choices(letters, weights, k=rng.choice([1, 2, 5, 5, 5, 5, 30]))))
            for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, make_docs, seed):
    rng = random.Random(seed)
    docs = corpus(rng, 300) + [(i, None) for i in range(5)]
    items = [(i, " ".join(rng.choices([f"w{j}" for j in range(50)], k=rng.randint(1, 12))))
             for i in range(12)] + [(3, "w1 w2 W2"), (3, "w1 w2 W2"), (90, None), (91, "zzz")]
    asked = spark.createDataFrame(items, BENCHMARK)
    got = ranked_search.rank(make_docs(docs), asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)
    cut = ranked_search.rank(make_docs(docs), asked, block_bytes=60)  # several blocks of items
    assert sorted(map(tuple, cut.collect()), key=str) == brute(docs, items)


def test_small_blocks_of_documents(spark, make_docs):
    rng = random.Random(5)
    docs, items = corpus(rng, 400), [(i, f"w{i} w{i + 1} w{30 - i} w3 w3") for i in range(8)]
    index = ranked_search.build(make_docs(docs), (t for _, x in items for t in terms(x)))
    for postings, cells in ((1, 1), (50, 10_000), (10_000, 40)):
        got = ranked_search.search(index, items, 5, postings, cells).collect()
        assert sorted(map(tuple, got), key=str) == brute(docs, items, 5)


def test_bounds_leave_strata_out():
    """A stratum whose bound is under the best is not read; one that ties is."""
    ids, m = list(range(30)), [100] * 10 + [200] * 10 + [300] * 10
    what = [np.array([0], np.int32).tobytes()] * 30
    tfs = [np.array([n], np.int32).tobytes() for n in [50] * 10 + [50] * 10 + [1] * 10]
    block = ranked_search.Strata(ids, m, what, tfs, 1)
    best = ranked_search.Best(5)
    assert block.visit(np.array([0]), np.array([7]), best) == 1
    assert best.ids.tolist() == [0, 1, 2, 3, 4]
    tied = ranked_search.Strata([-1, -2], [100, 100], what[:2], tfs[:2], 1)
    assert tied.visit(np.array([0]), np.array([7]), best) == 1
    assert best.ids.tolist() == [-2, -1, 0, 1, 2]


def test_odd_rows(spark, make_docs):
    items = [(1, "one other TEXT here"), (None, "é word"), (2, ""), (4, "日本語のテキスト nul")]
    asked = spark.createDataFrame(items, BENCHMARK)
    got = ranked_search.rank(make_docs(ODD), asked)
    assert sorted(map(tuple, got.collect()), key=str) == brute(ODD, items)
    assert ranked_search.rank(make_docs(ODD).limit(0), asked).count() == 0
    assert ranked_search.rank(make_docs(ODD), asked.limit(0)).count() == 0
