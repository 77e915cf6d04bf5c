"""Toxicity, decontamination, mixing and the pipeline."""

import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsledger.llm import common, decontaminate, mixing, toxicity
from tests.llm.conftest import BENCHMARK, LABELS, ODD

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


def held_accuracy(spark, sf_dir):
    got = toxicity.score_documents(common.read(spark, sf_dir, "documents"),
                                   common.read(spark, sf_dir, "labels"))
    pairs = (got.where("held_out").join(common.read(spark, sf_dir, "labels"), "doc_id")
             .select("predicted", "toxic").collect())
    return [(r[0], r[1]) for r in pairs]


def test_toxicity_held_out(spark):
    pairs = held_accuracy(spark, MEDIUM)
    found = [p for p, t in pairs if t == 1]
    assert sum(p == t for p, t in pairs) / len(pairs) > 0.97
    assert sum(found) / len(found) > 0.85


def test_folding_and_matching():
    model = toxicity.Model({"idiot": 3.0, "mor*": 2.0}, frozenset({"village idiot"}))
    auto = model.automaton()

    def words(text):
        folded = toxicity.fold(text)
        return [folded[s:e] for s, e, _ in toxicity.matches(folded, model, auto)]
    assert words("You 1D10T, mоrоn!") == ["idiot", "mor"]  # digits, Cyrillic o
    assert words("idiots, the village idiot, tomorrow ｉｄｉｏｔ") == ["idiot"]
    assert toxicity.fold("Br@t @home") == "brat @home"
    assert toxicity.features("", model, auto) == (0.0, 0.0)
    long, short = ("idiot " + "fine " * 5000), "idiot fine"
    assert toxicity.features(long, model, auto)[1] < toxicity.features(short, model, auto)[1]


def test_rare_toxic_words_are_tested(spark, make_docs):
    rng, rows, labels = random.Random(9), [], []
    common = ["".join(rng.choices("bcdfghjklmnp", k=10)) for _ in range(5000)]
    for i in range(300):  # words and stems of long texts, over 20,000, in half of the toxic texts
        rows.append((i, " ".join(rng.sample(common, 2500)) + (" zyxvile" if i < 20 else "")))
        labels.append((i, 1, int(i < 100)))
    model = toxicity.learn(make_docs(rows), spark.createDataFrame(labels, LABELS))
    assert any(e.startswith("zyx") for e in model.weights)


def test_toxicity_odd_rows(spark, make_docs):
    docs = make_docs(ODD)
    none = spark.createDataFrame([], LABELS)
    got = toxicity.score_documents(docs, none).collect()
    assert len(got) == len(ODD) and {r["score"] for r in got} == {0.0}
    for r in got:
        want = zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 0
        assert r["held_out"] == want
    odd = spark.createDataFrame([(None, 1, 1), (4, 1, None), (5, 1, 1), (5, 0, 0)], LABELS)
    kept = toxicity.reject(docs, odd)
    assert kept.columns == docs.columns
    assert toxicity.reject(make_docs([]), odd).count() == 0


def sentence(rng, n):
    return [rng.choice(["the", "of", "in"] + [f"w{i}" for i in range(300)]) for _ in range(n)]


def leak_case():
    rng = random.Random(5)
    items = [(i, " ".join(sentence(rng, n))) for i, n in enumerate([40, 25, 13, 9, 5, 60])]
    items += [(None, "tiny"), (0, items[0][1]), (7, None)]
    docs = []
    for d in range(60):
        text = sentence(rng, rng.randrange(0, 200))
        if d % 3 == 0:
            words = items[d % 6][1].split()
            for _ in range(d % 5):  # substitutions
                words[rng.randrange(len(words))] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = words
        docs.append((d, " ".join(text).upper() if d % 2 else ", ".join(text)))
    return items, docs + [(None if i is None else 100 + i, t) for i, t in ODD]


def brute_leaks(items, docs, window=13, identity=0.8):
    out = set()
    for doc_id, text in docs:
        doc = re.findall(r"[^\W_]+", (text or "").lower())
        for item_id, question in items:
            item = re.findall(r"[^\W_]+", (question or "").lower())
            width = min(window, len(item))
            if width < 8:
                continue
            found = any(
                sum(a == b for a, b in zip(item[i:i + width], doc[j:j + width]))
                >= identity * width - 1e-9
                for i in range(len(item) - width + 1) for j in range(len(doc) - width + 1))
            if found:
                out.add((doc_id, item_id))
    return out


def test_leaks_against_brute_force(spark, make_docs):
    items, rows = leak_case()
    rows = [r for r in rows if len(r[1] or "") < 9000]
    docs, benchmark = make_docs(rows), spark.createDataFrame(items, BENCHMARK)
    near = decontaminate.find_leaks(docs, benchmark)
    far = decontaminate.find_leaks(docs, benchmark, broadcast_bytes=0)
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, far.collect()))
    got = {(r["doc_id"], r["item_id"]) for r in near.collect()}
    want = brute_leaks(items, rows)
    assert got == want and len(want) > 10
    kept = decontaminate.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    leaky = {d for d, _ in got}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(
        d for d, _ in rows if d not in leaky and d is not None)
    again = decontaminate.decontaminate(docs, benchmark, broadcast_bytes=0)
    assert again.count() == kept.count()


def test_short_items_and_scripts_without_spaces(spark, make_docs):
    capital = "What is the capital of France?"
    clauses = "今天的天气很好，我们一起去公园散步。晚上我们在家里看电影。"
    thai = "ประเทศไทยมีเมืองหลวงชื่อกรุงเทพมหานครและเป็นเมืองใหญ่"
    items = [(1, capital), (2, clauses), (3, "yes no maybe so then"), (4, "?!"), (5, thai),
             (6, "东京在哪里")]
    docs = make_docs([
        (1, f"Q: {capital.upper()} A: Paris. {capital}"), (2, "what is the capital of Spain france"),
        (3, f"前言。{clauses}结束"), (4, clauses[:9] + "其他完全不同的内容在这里"),
        (5, "oh yes, no, maybe: so; then!"), (6, f"ก ข {thai}"), (7, "问：东京在哪里？"),
        (8, clauses.replace("公园", "海边")), (9, "the capital of france is what")])
    benchmark = spark.createDataFrame(items, BENCHMARK)
    want = {(1, 1), (3, 2), (8, 2), (5, 3), (6, 5), (7, 6)}
    near = decontaminate.find_leaks(docs, benchmark)
    far = decontaminate.find_leaks(docs, benchmark, broadcast_bytes=0)
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, far.collect()))
    assert {(r["doc_id"], r["item_id"]) for r in near.collect()} == want
    first = near.where("doc_id = 1").first()
    assert (first["first_word"], first["end_word"], first["equal_words"]) == (1, 7, 6)
    for size in (0, 8_000_000):
        kept = decontaminate.decontaminate(docs, benchmark, broadcast_bytes=size)
        assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 9]


def test_seeds_miss_no_window():
    for width in range(decontaminate.MIN_WORDS, decontaminate.WINDOW + 1):
        for bad in itertools.combinations(range(width), int(width * 0.2 + 1e-9)):
            assert any(
                all(mark == "0" or at + i not in bad for i, mark in enumerate(seed))
                for seed in decontaminate.SEEDS for at in range(width - len(seed) + 1))


def test_leaks_empty(spark, make_docs):
    none = spark.createDataFrame([], BENCHMARK)
    assert decontaminate.find_leaks(make_docs(ODD), none).count() == 0
    assert decontaminate.decontaminate(make_docs(ODD), none).count() == len(ODD)
    some = spark.createDataFrame([(1, "a " * 20)], BENCHMARK)
    assert decontaminate.find_leaks(make_docs([]), some).count() == 0


def plain_targets(sizes, most=3):
    """The rule as told: share by weight, cut at the cap, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, total = dict.fromkeys(names, 0.0), float(sum(sizes.values()))
    full, rest = set(), total
    while rest > 1e-9 and len(full) < len(names):
        open_ = [s for s in names if s not in full]
        each = rest / sum(weight[s] for s in open_)
        rest = 0.0
        for s in open_:
            target[s] += each * weight[s]
            if target[s] >= most * sizes[s]:
                rest += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                full.add(s)
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}é"[:rng.randrange(2, 4)] + str(i): rng.choice([0, 1, 5, 1000, 90_000])
             for i in range(9)}
    sizes[None] = 70
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6)


def test_mix_rows(spark, make_docs):
    rows = [(i, "w " * (i % 40), "en", ["a", "b", "c", None][min(i % 9, 3)])
            for i in range(900)] + [(None, None, None, "a")]
    docs = make_docs(rows)
    plan = mixing.plan(docs).collect()
    assert len(plan) == len(rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in plan)
    assert sorted(map(tuple, mixing.plan(docs).collect()), key=str) == sorted(
        map(tuple, plan), key=str)
    for source in {r["source"] for r in plan}:
        own = [r for r in plan if r["source"] == source]
        assert sum(r["taken"] for r in own) == pytest.approx(own[0]["target"], rel=0.2)
        assert all(r["taken"] <= 3 * r["size"] for r in own)
    assert mixing.plan(make_docs([])).count() == mixing.mix(make_docs([])).count() == 0
    assert mixing.mix(make_docs(ODD)).columns == docs.columns


def test_pipeline(spark):
    docs = common.read(spark, SMALL, "documents")
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == docs.columns and out.count() > 0
    assert out.join(docs, "doc_id", "left_anti").count() == 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_take_odd_tables(spark, make_docs, stage):
    for rows in ([], ODD):
        docs = make_docs(rows)
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        assert out.count() <= 3 * len(rows)
