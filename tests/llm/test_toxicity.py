import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm.toxicity import DROP_COST, LOOK_COST, LOOKS_LIKE, REPEAT_COST, SEPARATOR_COST, TWICE_COST, WordFeatures, disguised, learn_letters, learn_toxicity, restore, score_toxicity
from tests.llm.edges import EDGE_TEXTS, documents, empty

CLEAN = "the garden was quiet and the people were walking along the river with their friends after lunch".split()
TOXIC = ["stupid", "idiot", "loser"]


def corpus():
    rng, rows, labels = random.Random(1), [], []
    for i in range(400):
        words = [rng.choice(CLEAN) for _ in range(30)]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(30)] = rng.choice(TOXIC)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    labels = labels + [(5, None), (None, 1), (0, 0)]
    return learn_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), learn_letters(docs))


def scores(spark, model, texts):
    found = score_toxicity(documents(spark, list(enumerate(texts))), model).collect()
    return [r["score"] for r in sorted(found, key=lambda r: r["doc_id"])]


def test_disguised_words_are_restored(model):
    cost = model.letters.cost.tolist()
    shown = ["i.d.i.o.t", "s t u p i d", "looooser", "$tup1d", "l0ser", "1diot", "plain", "st_u_pid", ""]
    assert [restore(t, cost) for t in shown] == ["idiot", "stupid", "loser", "stupid", "loser", "idiot", "plain", "stupid", ""]


def _paths(token, cost):
    """Cost of the best path to every word that a token may stand for, by trying all paths."""
    best = {}

    def walk(i, word, price):
        if i == len(token):
            codes = [0, 0, *[ord(c) - 96 for c in word], 0]
            price += sum(cost[a][b][c] for a, b, c in zip(codes, codes[1:], codes[2:]))
            best[word] = min(price, best.get(word, price))
            return
        char, before = token[i], token[i - 1 : i]
        again = REPEAT_COST if i > 1 and char == before == token[i - 2] else TWICE_COST
        if char.isalpha():
            walk(i + 1, word + char, price)
            if char == before:
                walk(i + 1, word, price + again)
        elif char in LOOKS_LIKE:
            for letter in LOOKS_LIKE[char]:
                walk(i + 1, word + letter, price + LOOK_COST)
            walk(i + 1, word, price + (again if char == before else DROP_COST))
        else:
            walk(i + 1, word, price + (SEPARATOR_COST if char in " .-_*" else DROP_COST))

    walk(0, "", 0.0)
    return best


def test_decoding_against_all_paths(model):
    cost, rng = model.letters.cost.tolist(), random.Random(8)
    tokens = {"".join(rng.choice("tsiloed1103$!._*#") * rng.choice((1, 1, 2, 3)) for _ in range(rng.randrange(1, 6))) for _ in range(800)}
    for token in sorted(tokens) + ["1d10t", "s.t.u.p.1.d", "l00o0ser", "$$tup!d"]:
        paths = _paths(token, cost)
        assert paths[restore(token, cost)] == pytest.approx(min(paths.values()), abs=1e-9), token


def test_scores(spark, model):
    plain = "the river was quiet"
    texts = [plain, plain + " you idiot", plain + " you 1d1ot", plain + " you i d i o t", plain + " LOOOOSER", None, ""]
    got = scores(spark, model, texts)
    assert all(s < 0.5 for s in (got[0], got[5], got[6])) and all(s >= 0.5 for s in got[1:5])
    assert got[0] == got[5] == got[6]


def test_scores_of_disguised_words(spark, model):
    plain = "the river was quiet"
    forms = "stuupid idiiot st_u_pid stu.pid STU--PID i__d__i__o__t l0s3r 1d10+ $tup!d! you.stu.pid".split()
    forms += ["i  d  i  o  t", "s - t - u - p - i - d", "l.o.s.e.r"]
    got = scores(spark, model, [f"{plain} {form}" for form in forms])
    assert [form for form, score in zip(forms, got) if score < 0.5] == []
    clean = ["the well-known river.The garden", "3.14 and 1.000", "a b", "all been seen", "now!! hello!", "| a | b |"]
    assert all(s < 0.5 for s in scores(spark, model, [f"{plain} {text}" for text in clean]))


def test_more_tokens_found():
    def found(text):
        text = text.encode()
        return sorted(text[s:e].decode() for _, s, e in disguised(np.frombuffer(text, np.uint8), np.array([0, len(text)])))

    assert found("stuupid a s s 455 sh!+ 2023 end. The") == ["455", "a s s", "sh!+", "stuupid"]
    assert found("x  y .. z") == ["x  y .. z"] and found("st_u_pid") == ["st_u", "st_u_pid", "u_pid"]
    assert found("") == found("one.") == found("as she is") == []
    # the last letter of a document and the first of the next are no double
    assert len(disguised(np.frombuffer(b"abba", np.uint8), np.array([0, 2, 4]))) == 0


def test_doubles_are_decided_as_by_decoding(model):
    cost, rng = model.letters.cost.tolist(), random.Random(3)
    tokens = {"".join(rng.choice("aeilnorst") * rng.choice((1, 1, 1, 2, 2, 3)) for _ in range(rng.randrange(1, 7))) for _ in range(1500)}
    tokens = sorted(t for t in tokens if any(x == y for x, y in zip(t, t[1:])))
    data = np.frombuffer("".join(tokens).encode(), np.uint8)  # each token is a document
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in tokens])))
    spans = disguised(data, bounds)
    open_ = WordFeatures(cost, {})._open(data, bounds, spans)
    assert len(spans) == len(tokens)
    for token, may_change in zip(tokens, open_):
        changed = restore(token, cost) != token
        triple = any(x == y == z for x, y, z in zip(token, token[1:], token[2:]))
        assert changed <= may_change and (triple or changed == may_change), token


def test_edges(spark, model):
    found = score_toxicity(documents(spark), model).collect()
    assert len(found) == len(EDGE_TEXTS) and all(0 <= r["score"] <= 1 for r in found)
    assert score_toxicity(empty(documents(spark)), model).count() == 0


def test_nothing_to_learn(spark):
    docs = documents(spark)
    none = learn_toxicity(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"), learn_letters(empty(docs)))
    assert {r["score"] for r in score_toxicity(docs, none).collect()} == {0.0}


def test_sample_is_bounded(spark):
    rows, labels = corpus()
    docs, table = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    small = learn_toxicity(docs, table, learn_letters(docs), sample_rows=10)
    assert len(small.features) == 0


def test_rows_of_a_repeated_id_are_bounded(spark, monkeypatch):
    from recordloom.llm import toxicity as module

    rows, labels = corpus()
    rows += [(1, f"{text} {i}") for i, text in rows] + [(2, rows[2][1])] * 300
    table, fitted = spark.createDataFrame(labels, "doc_id long, toxic int"), []
    fit, docs = module._fit, documents(spark, rows)
    monkeypatch.setattr(module, "_fit", lambda x, y, n: fitted.append((x, y, n)) or fit(x, y, n))
    learn_toxicity(docs, table, learn_letters(docs), sample_rows=400)
    x, _, n = fitted[0]
    assert len(x) <= 400 and n.sum() <= 400 * 1.3 + 301
    # all rows are within the bound: every one has its weight
    learn_toxicity(docs, table, learn_letters(docs), sample_rows=5000)
    x, _, n = fitted[1]
    assert n.sum() == len(rows) and len(x) <= len(set(rows))


def test_tokens_found():
    text = b"you 1d10t i d i o t loooser now!! a b ok AAA 123 x2"
    tokens = sorted(text[s:e] for _, s, e in disguised(np.frombuffer(text, np.uint8), np.array([0, len(text)])))
    assert tokens == [b"1d10t", b"AAA", b"i d i o t", b"loooser", b"x2"]


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    learned = learn_toxicity(docs, labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0), learn_letters(docs))
    out = labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    seen = score_toxicity(docs.join(out, "doc_id"), learned).join(out, "doc_id").toPandas()
    toxic, clean = seen[seen.toxic == 1].score.to_numpy(), seen[seen.toxic == 0].score.to_numpy()
    above = (toxic[:, None] > clean[None, :]).mean() + (toxic[:, None] == clean[None, :]).mean() / 2
    assert above > 0.93 and (clean < 0.5).mean() > 0.99
