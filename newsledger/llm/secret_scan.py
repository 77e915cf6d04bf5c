"""Secret scans: fixed patterns, and formats inferred from the credentials they find.

The patterns give the base spans. From the different credentials they find in all documents
(the first ``MAX_CREDENTIALS`` by hash) a probabilistic automaton is inferred: their prefix tree counts how often each
state is left by each character or ends, and states whose counts are statistically
compatible (Hoeffding bound, recursively for their successors) merge, nearest the root
first. Every candidate token of a text, a run of the characters and of the shortest length that
credentials have, is then scored by its likelihood in this automaton against its likelihood as
ordinary text (a character bigram model of the other tokens); a token that fits the format
better, by a margin per character, adds a span of kind ``format``. A run with dots at its ends
is also scored without them, and one that does not fit as a whole piece by piece between dots. Base spans stay as they are.

Defined results: null text is empty and has no span. Offsets count code points, ends are
exclusive. Without credentials nothing is inferred and no span is added. A
candidate that overlaps a base span adds nothing. Repeated rows get equal results.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from newsledger.llm.common import full_text, sampled
from newsledger.session import materialize

KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
#: What a candidate looks like: letters and shortest length of the credentials that teach.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
#: Gains of different tokens that a task remembers.
REMEMBERED = 500_000
#: Different credentials that teach, ordinary tokens that teach, and documents these come
#: from, at most. Credentials come from all documents.
MAX_CREDENTIALS, MAX_OTHERS, MAX_DOCS = 2_000, 20_000, 20_000
ALPHABET = 68
#: Share of chance that merging accepts, and bits per character by which a format must win.
ALPHA, MARGIN = 0.05, 0.5
_HEX_ONLY = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))
_HEX_RUN = b"\x01" * MIN_HEX


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the credential) of the fixed patterns, by start and kind.

    Quick tests of substrings come first; they only skip texts that cannot match.
    """
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "key" in low:
        out += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= MIN_ACCESS]
    if _HEX_RUN in text.encode("utf-8", "surrogatepass").translate(_HEX_ONLY):
        out += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# ---- grammar inference

class State:
    """How often a state was reached, was an end, and was left by each character."""
    __slots__ = ("total", "ends", "next", "left")

    def __init__(self):
        self.total, self.ends, self.next, self.left = 0, 0, {}, Counter()


def prefix_tree(samples: Iterable[str]) -> State:
    root = State()
    for sample in samples:
        state = root
        state.total += 1
        for char in sample:
            state.left[char] += 1
            state = state.next.setdefault(char, State())
            state.total += 1
        state.ends += 1
    return root


def _differ(a: int, n: int, b: int, m: int, alpha: float) -> bool:
    """Hoeffding's test that two shares come from different chances."""
    if not n or not m:
        return False
    bound = math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
    return abs(a / n - b / m) > bound


def compatible(x: State, y: State, alpha: float) -> bool:
    todo = [(x, y)]
    while todo:
        a, b = todo.pop()
        if _differ(a.ends, a.total, b.ends, b.total, alpha):
            return False
        for char in a.next.keys() | b.next.keys():
            if _differ(a.left[char], a.total, b.left[char], b.total, alpha):
                return False
            p, q = a.next.get(char), b.next.get(char)
            if p and q and p is not q:
                todo.append((p, q))
    return True


def _fold(into: State, tree: State) -> None:
    """Add the counts of a tree to a state and its successors."""
    todo = [(into, tree)]
    while todo:
        a, b = todo.pop()
        a.total += b.total
        a.ends += b.ends
        a.left.update(b.left)
        for char, q in b.next.items():
            if char in a.next:
                todo.append((a.next[char], q))
            else:
                a.next[char] = q


def infer(samples: list[str], alpha: float = ALPHA) -> State | None:
    """The merged automaton's start state, or None without samples."""
    if not samples:
        return None
    root = prefix_tree(sorted(samples))
    settled, at = [root], 0
    while at < len(settled):  # in the order they were settled, nearest the root first
        state = settled[at]
        at += 1
        for char in sorted(state.next):
            child = state.next[char]
            if any(child is s for s in settled):
                continue
            for other in settled:
                if compatible(other, child, alpha):
                    state.next[char] = other
                    _fold(other, child)
                    at = 0  # counts have changed: look again from the start
                    break
            else:
                settled.append(child)
            if at == 0:
                break
    return root


@dataclass
class Model:
    """Transitions (log2 chances) of the automaton, and the model of ordinary tokens."""
    moves: list[dict[str, tuple[int, float]]] = field(default_factory=list)
    stops: list[float] = field(default_factory=list)
    floors: list[float] = field(default_factory=list)
    plain: dict[str, float] = field(default_factory=dict)
    plain_floor: dict[str, float] = field(default_factory=dict)

    def gain(self, token: str) -> float:
        """Bits per character by which the format explains a token better."""
        state, fits, plain, last = 0, 0.0, 0.0, "^"
        for char in token:
            floor = self.floors[state]
            state, bits = self.moves[state].get(char, (0, floor))
            fits += bits
            pair = last + char
            plain += self.plain.get(pair, self.plain_floor.get(last, -math.log2(ALPHABET)))
            last = char
        plain += self.plain.get(last + "$", self.plain_floor.get(last, -math.log2(ALPHABET)))
        return (fits + self.stops[state] - plain) / len(token)


def build(credentials: list[str], others: Iterable[str]) -> Model | None:
    start = infer(credentials)
    if start is None:
        return None
    states, index = [start], {id(start): 0}
    for state in states:
        for child in state.next.values():
            if id(child) not in index:
                index[id(child)] = len(states)
                states.append(child)
    model = Model()
    for state in states:
        whole = state.total + 0.5 * (ALPHABET + 1) / ALPHABET
        model.moves.append({c: (index[id(child)], math.log2(state.left[c] / whole))
                            for c, child in state.next.items()})
        model.stops.append(math.log2((state.ends + 0.5 / ALPHABET) / whole))
        model.floors.append(math.log2(0.5 / ALPHABET / whole))
    pairs, firsts = Counter(), Counter()
    for token in others:
        line = f"^{token}$"
        pairs.update(line[i:i + 2] for i in range(len(line) - 1))
        firsts.update(line[:-1])
    for pair, n in pairs.items():
        model.plain[pair] = math.log2((n + 0.1) / (firsts[pair[0]] + 0.1 * ALPHABET))
    for char, n in firsts.items():
        model.plain_floor[char] = math.log2(0.1 / (n + 0.1 * ALPHABET))
    return model


# ---- operators

def _teach(batches, max_credentials: int):
    """Different credentials of the base spans of all documents, and other candidate tokens of
    the sampled ones. A task passes on at most ``max_credentials``, the first by hash."""
    found: dict[str, int] = {}
    for batch in batches:
        tokens = []
        for text, sampled in zip(batch.column("text").to_pylist(),
                                 batch.column("sampled").to_pylist()):
            spans = base_spans(text)
            for _, _, end, at in spans:
                found.setdefault(text[at:end], 0)
            if sampled:
                tokens += [m[0] for m in CANDIDATE.finditer(text)
                           if not any(s < m.end() and m.start() < e for _, s, e, _ in spans)]
        if len(found) > 4 * max_credentials:
            found = _first_by_hash(found, max_credentials)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens, pa.string()), pa.array([0] * len(tokens), pa.int32())],
            ["token", "label"])
    found = _first_by_hash(found, max_credentials)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.string()), pa.array([1] * len(found), pa.int32())],
        ["token", "label"])


def _first_by_hash(found: dict[str, int], bound: int) -> dict[str, int]:
    """The first tokens in the order of Spark's xxhash64, ties by the token."""
    def place(token: str) -> tuple[int, str]:
        h = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"), 42)
        return (h - (1 << 64) if h >> 63 else h), token
    return dict.fromkeys(sorted(found, key=place)[:bound], 0)


def learn(docs: DataFrame, max_docs: int = MAX_DOCS, max_credentials: int = MAX_CREDENTIALS,
          max_others: int = MAX_OTHERS) -> Model | None:
    """A model from the credentials of all documents, the first ``max_credentials`` different
    ones by hash, and from ordinary tokens of about ``max_docs`` documents."""
    total = docs.count()
    text = full_text(docs["text"])
    taught = materialize(
        docs.select(text.alias("text"))
        .withColumn("sampled", sampled(F.xxhash64("text"), max_docs, total))
        .mapInArrow(lambda b: _teach(b, max_credentials), "token string, label int").distinct())

    def some(label: int, bound: int) -> list[str]:
        held = taught.where(F.col("label") == label).select("token")
        return [r[0] for r in held.orderBy(F.xxhash64("token"), "token").limit(bound).collect()]
    return build(some(1, max_credentials), some(0, max_others))


def format_spans(text: str, gain) -> Iterator[tuple[int, int]]:
    """Candidates that fit the format: whole runs, with or without the dots at their ends,
    whichever fits better, else their pieces between dots."""
    for m in CANDIDATE.finditer(text):
        run, at, end = m[0], m.start(), m.end()
        fit, bare = gain(run), run.strip(".")
        if len(run) > len(bare) >= MIN_ASSIGN and gain(bare) >= fit:
            at += run.index(bare)
            run, fit, end = bare, gain(bare), at + len(bare)
        if fit >= MARGIN:
            yield at, end
        elif "." in run:
            for piece in run.split("."):
                if len(piece) >= MIN_ASSIGN and gain(piece) >= MARGIN:
                    yield at, at + len(piece)
                at += len(piece) + 1


def all_spans(text: str | None, model: Model | None, gain=None) -> tuple[list, list]:
    """Base spans, and base spans with those of inferred formats, by start and kind.

    ``gain`` may stand for ``model.gain`` with a memory.
    """
    text = text or ""
    base = [s[:3] for s in base_spans(text)]
    if model is None:
        return base, base
    added = [("format", a, b) for a, b in format_spans(text, gain or model.gain)
             if not any(s < b and a < e for _, s, e in base)]
    return base, sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _written(spans: list) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scanner(model: Model | None):
    """Column function: text to counts, digest and list of its spans."""
    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        gain = functools.lru_cache(REMEMBERED)(model.gain) if model else None
        for texts in parts:
            rows = []
            for text in texts:
                base, spans = all_spans(text, model, gain)
                kinds = Counter(k for k, *_ in base)
                rows.append((kinds["assign"], kinds["access"], kinds["hex"],
                             hashlib.sha256(_written(base).encode()).hexdigest(),
                             _written(spans)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256",
                                              "spans"])
    return run


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    model = learn(docs)
    return docs.select(docs["doc_id"], scanner(model)(docs["text"]).alias("s")).select(
        "doc_id", "s.*")
