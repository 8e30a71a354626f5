import random
import re

import pytest

from recordloom.llm import decontamination as module
from recordloom.llm.decontamination import ItemAutomaton, decontaminate, scan_documents, words_of
from tests.llm.edges import EDGE_TEXTS, documents, empty


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(doc, items, width=10):
    w, hit, names = words(doc), set(), set()
    for name, text in items:
        v = words(text)
        k = min(width, len(v))
        windows = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if k else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i : i + k]) in windows:
                hit |= set(range(i, i + k))
                names.add("" if name is None else str(name))
    return len(w), len(hit), sorted(names)


def frames(spark, docs, items):
    return documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")


def random_case(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("a b c d e f é".split())
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 3, 4, 6, 9])))) for i in range(30)]
    items += [(3, "a repeated id"), (None, "no id at all"), (40, None), (41, "?!")]
    docs = [(i, " ".join(word() for _ in range(rng.randrange(40)))) for i in range(120)]
    return docs, items


def test_against_every_window(spark):
    docs, items = random_case(2)
    found = scan_documents(*frames(spark, docs, items), width=4).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found) == sorted(
        (i, *brute(t, items, 4)) for i, t in docs
    )


def test_many_shards_and_groups(spark, monkeypatch):
    docs, items = random_case(7)
    monkeypatch.setattr(module, "SHARD_WORDS", 5)
    monkeypatch.setattr(module, "GROUP_STATES", 1)
    monkeypatch.setattr(module, "build_automata", lambda i, w, f=module.build_automata: f(i.limit(8), w))
    items = items[:8]
    found = scan_documents(*frames(spark, docs, items), width=4).collect()
    assert sorted((r["doc_id"], r["n_hit"], r["items"]) for r in found) == sorted(
        (i, *brute(t, items, 4)[1:]) for i, t in docs
    )
    cleaned = decontaminate(*frames(spark, docs, items), width=4, coverage_limit=1.0).collect()
    assert all(brute(r["text"], items, 4)[1] == 0 for r in cleaned)


@pytest.mark.parametrize("limit", [0.2, 0.5, 1.0])
def test_the_limit_does_not_depend_on_groups(spark, monkeypatch, limit):
    own = [f"own{i}" for i in range(12)]
    first, second = [f"one{i}" for i in range(12)], [f"two{i}" for i in range(12)]
    inner = first[:6] + second[:6]
    docs = [
        (1, " ".join(first + second + own)), (2, " ".join(own + first + own)), (3, " ".join(own)), (4, None), (5, ""), (6, " ".join(first)),
        # cutting an item joins the halves of another one: both cuts count
        (7, " ".join(own + first[:6] + second + first[6:] + own)), (8, " ".join(first[:6] + second + first[6:] + own)),
        (9, " ".join(own * 3 + first + own)), (10, " ".join(own + inner)), (11, " ".join(second[:6] + inner + second[6:] + own * 2)),
    ]
    items = [(1, " ".join(first)), (2, " ".join(second)), (3, " ".join(inner)), (4, "own3 own4")]

    def run():
        source, benchmark = frames(spark, docs, items)
        return sorted(map(tuple, decontaminate(source, benchmark, coverage_limit=limit).select("doc_id", "text").collect()))

    def plain():
        out = []
        for i, text in docs:
            all_words = words(text or "")
            left, total, gone = all_words, len(all_words), 0
            while True:
                marks = [False] * len(left)
                for _, item in items:
                    w = words(item)
                    k = min(10, len(w))
                    for window in {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}:
                        for at in range(len(left) - k + 1):
                            if tuple(left[at : at + k]) == window:
                                marks[at : at + k] = [True] * k
                if not any(marks):
                    out.append((i, left))
                    break
                gone += sum(marks)
                if all(marks) or gone > limit * total:
                    break
                left = [x for x, m in zip(left, marks) if not m]
        return out

    whole = run()
    assert [(i, words(t or "")) for i, t in whole] == plain()
    monkeypatch.setattr(module, "SHARD_WORDS", 2)
    monkeypatch.setattr(module, "GROUP_STATES", 1)
    assert len(module.build_automata(frames(spark, docs, items)[1], 10).groups) > 2
    assert run() == whole


def test_edges(spark):
    items = [(1, "in several rows, with quite"), (2, LONG_ITEM)]
    found = scan_documents(*frames(spark, EDGE_TEXTS, items)).collect()
    assert sorted((repr(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in found) == sorted(
        (repr(i), *brute(t, items)) for i, t in EDGE_TEXTS
    )
    docs, benchmark = frames(spark, EDGE_TEXTS, items)
    assert scan_documents(empty(docs), benchmark).count() == 0
    assert {r["n_hit"] for r in scan_documents(docs, empty(benchmark)).collect()} == {0}
    assert decontaminate(docs, empty(benchmark)).count() == len(EDGE_TEXTS)


LONG_ITEM = "long words make a long text long words make a long text long"


def test_cutting_leaves_no_window_and_keeps_clean_documents(spark):
    filler = "plain filler words stand here and there, ".split()
    passage = "Seven wonders were named, but only one of them still stands today."
    docs = [
        (1, " ".join(filler * 6) + passage + " " + " ".join(filler * 6)),
        (2, " ".join(filler)),
        (3, passage),
        # cutting the inner passage joins the halves of an outer one
        (4, " ".join(filler * 9) + " Seven wonders were named, but " + passage + " only one of them still stands today. " + " ".join(filler * 9)),
    ]
    source, items = frames(spark, docs, [(1, passage)])
    kept = {r["doc_id"]: r for r in decontaminate(source, items).collect()}
    assert set(kept) == {1, 2, 4} and kept[2]["text"] == docs[1][1]
    assert all(brute(r["text"], [(1, passage)])[1] == 0 for r in kept.values())
    assert words(kept[1]["text"]) == words(" ".join(filler * 6 + filler * 6))
    assert kept[1]["label"] == "label"


def test_automaton_survives_bytes():
    automaton = ItemAutomaton.from_bytes(ItemAutomaton([("1", words_of("a b c")), ("2", words_of("b c d"))], 2).to_bytes())
    import numpy as np

    hit, names = np.zeros(4, bool), set()
    automaton.match([b"x", b"b", b"c", b"y"], hit, names)
    assert hit.tolist() == [False, True, True, False] and names == {"1", "2"}
