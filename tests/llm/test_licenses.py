"""Fuzzy license notices against brute force."""

import random
import re
import time

from newsledger.llm import common, license_scan
from newsledger.llm.license_scan import BASE, NOTICES, Finder, Notice, search
from tests.llm.conftest import ODD

FINDER = Finder([Notice.of(*n) for n in NOTICES])
SMALL = "/root/testdata/sf0.01"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def occurrences(line, notice):
    """All (start, end, edits) between word boundaries that keep the identifying words."""
    starts = [i + 1 for i, c in enumerate(line[:-1]) if c == " "]
    ends = [i for i, c in enumerate(line) if c == " " and i]
    out = []
    for s in starts:
        for e in ends:
            if abs(e - s - len(notice.phrase)) <= notice.edits and notice.exact <= set(
                    line[s:e].split()):
                edits = distance(line[s:e], notice.phrase)
                if edits <= notice.edits:
                    out.append((s, e, edits))
    return out


def edited(rng, phrase, edits):
    out = list(phrase)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcdefgh ")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rng.choice("xyz "))
    return "".join(out)


def test_spans_equal_brute_force():
    rng = random.Random(4)
    hits = 0
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 4)):
            phrase = rng.choice(NOTICES)[0]
            parts += [edited(rng, phrase, rng.randint(0, len(phrase) // 10 + 1)),
                      rng.choice(["mit", "the public", "license", "to be"])]
        line = f" {' '.join(' '.join(parts).split())} "
        got = FINDER.spans(line)
        for at, notice in enumerate(FINDER.notices):
            want = occurrences(line, notice)
            mine = [(s, e, k) for s, e, which, k in got if which == at]
            assert set(mine) <= set(want)
            for s, e, edits in want:
                hits += 1
                assert any(a < e and s < b and k <= edits for a, b, k in mine)
            assert all(b <= c for (_, b, _), (c, _, _) in zip(sorted(mine), sorted(mine)[1:]))
    assert hits > 200


def naive(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = {label: [i for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
              for p, label in BASE.items()}
    every = sorted(i for found in places.values() for i in found)
    return (len(words), len(every), every[0] if every else None, every[-1] if every else None,
            ",".join(sorted(k for k, v in places.items() if v)))


def base_rows(docs):
    return {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels): r
            for r in license_scan.scan(docs).collect()}


def test_base_places_over_the_table(spark):
    docs = common.read(spark, SMALL, "documents")
    got = base_rows(docs)
    want = {(r.doc_id, *naive(r.text)) for r in docs.collect()}
    assert set(got) == want
    for row in got.values():
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
        assert 0 <= row.score <= 1 and (row.score == 1) == (row.n_base > 0)


def test_odd_rows(spark, make_docs):
    texts = ODD + [(20, "MIT License MIT\nLICENSE; the Apache-License, GNU General Public License"),
                   (21, "under mit licence"), (22, "it license, permit license"),
                   (23, "Licensed under CC BY-NC 4.0."), (24, "\U00010400mit license mit license")]
    rows = [(i, t) for i, t in texts]
    docs = make_docs(rows)
    got = license_scan.scan(docs)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word",
                           "base_labels", "labels", "score", "spans"]
    found = sorted(got.collect(), key=str)
    want = sorted(((i, *naive(t)) for i, t in rows), key=str)
    assert sorted((tuple(r[:6]) for r in found), key=str) == want
    by = {r.doc_id: r for r in found if r.doc_id in (20, 21, 22, 23, 24)}
    assert by[20].n_base == 4 and by[20].labels == "apache,gpl,mit"
    assert (by[21].labels, by[21].base_labels, by[21].spans) == ("mit", "", "mit:6:17:1")
    assert by[22].labels == "" and by[22].score == 0
    assert by[23].labels == "cc-by-nc"
    assert by[24].spans == "mit:13:24:0" and by[24].n_base == 1
    assert license_scan.scan(docs.limit(0)).count() == 0


def test_spans_point_into_the_text():
    text = "É Foo — released under the   MíT or MIT  Licens, ok. Apache\nLICENSE"
    for label, start, end, edits in search(text, FINDER).spans:
        words = [w.lower() for w in license_scan.WORD.findall(text[start:end].lower())]
        phrases = [p for p, name, _ in NOTICES if name == label]
        assert min(distance(" ".join(words), p) for p in phrases) == edits
    assert {s[0] for s in search(text, FINDER).spans} == {"mit", "apache"}


def test_long_texts_take_linear_time():
    for text in ("license " * 100_000, "mit licens " * 50_000, "a" * 1_000_000):
        start = time.perf_counter()
        search(text, FINDER)
        assert time.perf_counter() - start < 30
