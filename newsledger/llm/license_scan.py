"""License scans: fuzzy search for short notices.

A text is reduced to its words, joined by single spaces. Every notice may occur there with up to
``edits`` insertions, deletions or substitutions. Cut into ``edits + 1`` pieces, any such
occurrence still holds one piece unchanged (pigeonhole), so one Aho-Corasick automaton over the
pieces of all notices locates every candidate. Around a piece found, a window that must hold the
whole occurrence is verified by the ``regex`` library's bounded-error matching, between word
boundaries; the best match there gives span and number of edits. The identifying words of a
notice must stand unchanged, since one edit makes another licence of them.

Of overlapping matches of one notice the one with fewer edits stands, then the earlier, so every
occurrence overlaps a span with at most as many edits. The three base phrases are notices as
well; their places (all of them, overlapping ones too) are the exact matches.

Defined results: null text is empty and has no word, place or span. Spans are code points of the
original text, ends exclusive. The score is 1 where a base phrase stands, else 1 less the share
of edits in the best match, 0 without any. Repeated rows get equal results; empty tables give
empty results.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from newsledger.llm.common import LOWER, UPPER

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWERED = str.maketrans(UPPER, LOWER)
#: Characters of a notice for each edit it may have.
CHARS_PER_EDIT = 10
#: Verified windows that a task remembers; a window is about as long as a notice.
REMEMBERED = 50_000

# --- fixed values: notices, their labels, and the words that must stand unchanged ----
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = [
    ("mit license", "mit", "mit"),
    ("apache license", "apache", "apache"),
    ("general public license", "gpl", ""),
    ("lesser general public license", "lgpl", "lesser"),
    ("affero general public license", "agpl", "affero"),
    ("mozilla public license", "mpl", "mozilla"),
    ("eclipse public license", "epl", "eclipse"),
    ("boost software license", "bsl", "boost"),
    ("bsd 2 clause license", "bsd", "bsd 2"),
    ("bsd 3 clause license", "bsd", "bsd 3"),
    ("redistribution and use in source and binary forms", "bsd", ""),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", ""),
    ("permission to use copy modify and or distribute this software", "isc", ""),
    ("this is free and unencumbered software released into the public domain",
     "unlicense", "public domain"),
    ("licensed under cc by 4 0", "cc-by", "cc by 4 0"),
    ("licensed under cc by sa 4 0", "cc-by-sa", "cc by sa 4 0"),
    ("licensed under cc by nc 4 0", "cc-by-nc", "cc by nc 4 0"),
    ("licensed under cc by nd 4 0", "cc-by-nd", "cc by nd 4 0"),
    ("creative commons attribution", "cc", "commons"),
    ("released under cc0", "cc0", "cc0"),
    ("all rights reserved", "proprietary", "all rights"),
]


@dataclass(frozen=True)
class Notice:
    phrase: str
    label: str
    exact: frozenset[str]
    edits: int

    @classmethod
    def of(cls, phrase: str, label: str, exact: str = "") -> Notice:
        return cls(phrase, label, frozenset(exact.split()), len(phrase) // CHARS_PER_EDIT)

    def pieces(self) -> list[tuple[int, str]]:
        """Offset and text of ``edits + 1`` pieces of nearly equal length."""
        n, cuts = len(self.phrase), self.edits + 1
        bounds = [i * n // cuts for i in range(cuts + 1)]
        return [(a, self.phrase[a:b]) for a, b in zip(bounds, bounds[1:])]


class Finder:
    """Spans of notices in a line of words; keeps what windows it has verified."""

    def __init__(self, notices: list[Notice]):
        self.notices = notices
        held: dict[str, list[tuple[int, int]]] = {}
        for at, notice in enumerate(notices):
            for offset, piece in notice.pieces():
                held.setdefault(piece, []).append((at, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, places in held.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()
        self.patterns = [
            regex.compile(rf"(?b)(?<= )(?:{regex.escape(n.phrase)}){{e<={n.edits}}}(?= )")
            for n in notices]
        self.verify = functools.lru_cache(REMEMBERED)(self._verify)

    def _verify(self, at: int, window: str) -> tuple[int, int, int] | None:
        """(start, end, edits) of the best match that keeps the identifying words."""
        pattern, exact = self.patterns[at], self.notices[at].exact
        m = pattern.search(window)
        if m and not exact <= set(m[0].split()):  # a worse match may keep them: try every word
            others = [pattern.match(window, i + 1) for i, c in enumerate(window) if c == " "]
            kept = [o for o in others if o and exact <= set(o[0].split())]
            m = min(kept, key=lambda o: (sum(o.fuzzy_counts), o.start()), default=None)
        return (m.start(), m.end(), sum(m.fuzzy_counts)) if m else None

    def spans(self, line: str) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits) in a line that begins and ends with a space."""
        windows = set()
        for last, (length, places) in self.seeds.iter(line):
            start = last - length + 1
            for at, offset in places:
                notice = self.notices[at]
                left = max(0, start - offset - notice.edits - 1)
                right = start - offset + len(notice.phrase) + notice.edits + 1
                windows.add((at, left, min(right, len(line))))
        found = {}
        for at, left, right in windows:
            match = self.verify(at, line[left:right])
            if match:
                found.setdefault(at, set()).add((match[2], left + match[0], left + match[1]))
        out = []
        for at, matches in found.items():
            kept: list[tuple[int, int]] = []  # disjoint, by start
            for edits, start, end in sorted(matches):
                place = bisect.bisect(kept, (start, end))
                before = kept[place - 1][1] if place else 0
                after = kept[place][0] if place < len(kept) else end
                if before <= start and end <= after:
                    kept.insert(place, (start, end))
                    out.append((start, end, at, edits))
        return sorted(out)


@dataclass(frozen=True)
class Found:
    """What one text holds; places count words, spans code points of the text."""
    words: int
    places: list[int]
    base_labels: list[str]
    labels: list[str]
    score: float
    spans: list[tuple[str, int, int, int]]


def search(text: str | None, finder: Finder) -> Found:
    lowered = (text or "").translate(_LOWERED)
    words = WORD.findall(lowered)
    line = f" {' '.join(words)} "
    spans = finder.spans(line) if words else []
    if not spans:
        return Found(len(words), [], [], [], 0.0, [])
    at, starts = 1, []  # where words begin in the line, and in the text
    for word in words:
        starts.append(at)
        at += len(word) + 1
    places, base, scores, out = [], set(), [], []
    origin = [m.span() for m in WORD.finditer(lowered)]
    for start, end, which, edits in spans:
        notice = finder.notices[which]
        first, last = bisect.bisect_left(starts, start), bisect.bisect_left(starts, end) - 1
        scores.append(1 - edits / len(notice.phrase))
        out.append((notice.label, origin[first][0], origin[last][1], edits))
        if not edits and notice.phrase in BASE:
            places.append(first)
            base.add(notice.label)
    labels = {label for label, *_ in out}
    return Found(len(words), places, sorted(base), sorted(labels),
                 1.0 if places else min(0.999, max(scores)), out)


def scanner(notices: list[Notice]):
    """Column function: text to the fields of the operator's rows."""
    @F.pandas_udf("n_words long, n_base long, first_word long, last_word long, "
                  "base_labels string, labels string, score double, spans string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        finder = Finder(notices)
        for texts in parts:
            rows = []
            for text in texts:
                f = search(text, finder)
                rows.append((f.words, len(f.places), min(f.places, default=None),
                             max(f.places, default=None), ",".join(f.base_labels),
                             ",".join(f.labels), f.score,
                             ",".join(f"{k}:{a}:{b}:{e}" for k, a, b, e in f.spans)))
            out = pd.DataFrame(rows, columns=["n_words", "n_base", "first_word", "last_word",
                                              "base_labels", "labels", "score", "spans"])
            for place in ("first_word", "last_word"):
                out[place] = out[place].astype("Int64")
            yield out
    return run


def scan(docs: DataFrame, notices: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, spans (label:start:end:edits, comma-joined)."""
    held = [Notice.of(*n) for n in (NOTICES if notices is None else notices)]
    return docs.select(docs["doc_id"], scanner(held)(docs["text"]).alias("s")).select(
        "doc_id", "s.*")
