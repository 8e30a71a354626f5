import time
import tracemalloc
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordloom.llm import char_model
from recordloom.llm.arrow_text import slices
from recordloom.llm.char_model import CLASSES, letter_classes, trigram_codes, trigram_counts
from recordloom.llm.language_mixture import PENALTY, LanguageModel, document_mixtures, gram_places, held_out, identify_languages, learn_languages
from tests.llm.edges import EDGE_TEXTS, documents, empty

ENGLISH = "the quick brown fox and the lazy dog were seen with their friends in the old town where they had been living"
GERMAN = "der schnelle braune Fuchs und der faule Hund wurden mit ihren Freunden in der alten Stadt gesehen und blieben dort"


@pytest.fixture(scope="module")
def model(spark):
    rows = [(ENGLISH, "en"), (GERMAN, "de"), (None, "en"), ("text without language", None)] * 3
    return learn_languages(spark.createDataFrame(rows, "text string, lang string"))


def test_counts_match_a_plain_count(spark):
    texts = [("a", "Abc, é!"), ("a", None), ("b", ""), ("b", "x"), ("a", "abc")]
    classes, want = letter_classes(), {}
    for kind, text in texts:
        row = [0, *classes[np.frombuffer((text or "").encode(), np.uint8)].tolist(), 0]
        for i in range(1, len(row) - 1):
            if row[i]:
                gram = (row[i - 1] * CLASSES + row[i]) * CLASSES + row[i + 1]
                want[kind, gram] = want.get((kind, gram), 0) + 1
    counted = trigram_counts(spark.createDataFrame(texts, "kind string, text string")).collect()
    assert {(r["kind"], r["gram"]): r["n"] for r in counted} == want


def kinds_and_texts(kinds):
    rows = [(f"k{i % kinds}", f"text {'abcdefghij'[i % 10]} of {i} and {'xyz'[i % 3]}é " * 40) for i in range(2400)]
    return [pa.RecordBatch.from_pydict({"kind": [k for k, _ in some], "text": [t for _, t in some]}) for some in (rows[:1000], rows[1000:])]


def test_counting_holds_what_occurs():
    """A task's memory follows the trigrams that it meets; a table of all possible ones took 15 MB a kind."""
    batches = kinds_and_texts(12)
    tracemalloc.start()
    count = sum(part.num_rows for part in char_model.count_batches(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count and peak < 60e6


def test_counts_handed_on_early_add_up(monkeypatch):
    def counted():
        total, rows = Counter(), 0
        for part in char_model.count_batches(iter(kinds_and_texts(3))):
            rows += part.num_rows
            for kind, gram, n in zip(*(column.to_pylist() for column in part.columns)):
                total[kind, gram] += n
        return total, rows

    whole, rows = counted()
    monkeypatch.setattr(char_model, "_WAITING", 1000)
    monkeypatch.setattr(char_model, "_HELD", 50)
    again, more = counted()
    assert again == whole and rows == len(whole) < more


def test_slices_are_small_and_whole():
    texts = ["word " * 2000, None, "", "x" * 600_000] * 60
    seen = []
    for low, high, data, bounds in slices(pa.array(texts)):
        assert len(data) <= 1 << 18 or high == low + 1
        seen += [data[a:b].tobytes().decode() for a, b in zip(bounds, bounds[1:])]
    assert seen == [text or "" for text in texts]


def test_predictions(spark, model):
    assert model.languages == ["de", "en"]
    rows = [(1, "where the friends of the dog were"), (2, "wo die Freunde der Stadt und der Hund"), (3, ENGLISH + ". " + GERMAN)]
    found = {r["doc_id"]: r for r in identify_languages(documents(spark, rows), model).collect()}
    assert (found[1]["lang_pred"], found[2]["lang_pred"]) == ("en", "de")
    assert found[1]["score"] > 0.8 and found[2]["score"] > 0.8
    shares = dict(part.split(":") for part in found[3]["mixture"].split(","))
    assert set(shares) == {"de", "en"} and 0.3 < float(shares["de"]) < 0.7


def test_edges(spark, model):
    found = identify_languages(documents(spark), model).collect()
    assert len(found) == len(EDGE_TEXTS)
    for row, (_, text) in zip(sorted(found, key=lambda r: repr(r["doc_id"])), sorted(EDGE_TEXTS, key=lambda r: repr(r[0]))):
        assert 0 <= row["score"] <= 1
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1, 2, 3, 10, 11))
    assert by_id[9]["lang_pred"] == "en"
    assert identify_languages(empty(documents(spark)), model).count() == 0


def test_nothing_learned(spark):
    bare = learn_languages(spark.createDataFrame([], "text string, lang string"))
    assert {r["lang_pred"] for r in identify_languages(documents(spark), bare).collect()} == {"und"}


def test_em_matches_a_plain_loop():
    rng = np.random.default_rng(2)
    grams = np.arange(CLASSES**2 + CLASSES, CLASSES**2 + CLASSES + 40)
    p = rng.dirichlet(np.ones(41), 3).T.astype(np.float32)
    model = LanguageModel(["a", "b", "c"], grams, p, np.ones((41, 3), bool))
    codes = np.concatenate([rng.choice(grams, 400, p=p[:40, 0] / p[:40, 0].sum()), rng.choice(grams, 400, p=p[:40, 2] / p[:40, 2].sum())])
    shares, known = document_mixtures(codes, np.zeros(800, np.int32), 1, model, gram_places(model))
    x, pi = p[codes - grams[0]][:, [0, 2]].astype(float), np.array([0.5, 0.5])
    for _ in range(400):
        pi = (x * pi / (x * pi).sum(axis=1, keepdims=True)).mean(axis=0)
    assert shares[0, 1] == 0 and abs(shares[0, 0] - pi[0]) < 0.05 and known[0].min() == 1


def _texts(rng, p, grams, mixed, length):
    drawn = [rng.choice(grams, max(1, round(length * share)), p=p[:-1, k] / p[:-1, k].sum()) for k, share in mixed]
    return np.concatenate(drawn)


def test_sets_against_all_subsets():
    """The set that is chosen against the best of all, by penalised likelihood."""
    rng = np.random.default_rng(5)
    grams = np.arange(CLASSES**2 + CLASSES, CLASSES**2 + CLASSES + 60)
    p = rng.dirichlet(np.full(61, 0.5), 5).T.astype(np.float32) + np.float32(1e-5)
    p /= p.sum(axis=0)
    model, same, worst = LanguageModel(list("abcde"), grams, p, np.ones((61, 5), bool)), 0, 0.0
    texts = []
    for i in range(60):
        few = rng.choice(5, 1 + i % 4, replace=False)
        texts.append(_texts(rng, p, grams, list(zip(few, rng.dirichlet(np.full(len(few), 3.0)))), rng.integers(5, 400)))
    doc = np.repeat(np.arange(60, dtype=np.int32), [len(t) for t in texts])
    shares, _ = document_mixtures(np.concatenate(texts), doc, 60, model, gram_places(model))

    def value(x, some):
        pi = np.full(len(some), 1 / len(some))
        for _ in range(500):
            pi = (x[:, some] * pi / (x[:, some] @ pi)[:, None]).mean(axis=0)
        return np.log(x[:, some] @ pi).sum() - (len(some) - 1) * PENALTY * np.log(len(x) + 1)

    for codes, found in zip(texts, shares):
        x = p[codes - grams[0]].astype(float)
        values = {some: value(x, list(some)) for n in range(1, 6) for some in combinations(range(5), n)}
        best, mine = max(values, key=values.get), tuple(np.flatnonzero(found))
        same += best == mine
        worst = max(worst, (values[best] - values[mine]) / np.log(len(x) + 1))
    assert same >= 57 and worst < PENALTY


def test_many_languages_cost_in_proportion():
    def seconds(n):
        rng = np.random.default_rng(n)
        grams = np.arange(CLASSES**2, CLASSES**2 + 3000)
        p = rng.dirichlet(np.full(3001, 0.1), n).T.astype(np.float32) + np.float32(1e-6)
        p /= p.sum(axis=0)
        model = LanguageModel([str(k) for k in range(n)], grams, p, np.ones((3001, n), bool))
        texts = [_texts(rng, p, grams, [(i % n, 0.6), ((i + 1) % n, 0.4)], 1500) for i in range(100)]
        doc, place = np.repeat(np.arange(100, dtype=np.int32), [len(t) for t in texts]), gram_places(model)
        start = time.perf_counter()
        shares, _ = document_mixtures(np.concatenate(texts), doc, 100, model, place)
        assert all(set(np.flatnonzero(row)) == {i % n, (i + 1) % n} for i, row in enumerate(shares))
        return time.perf_counter() - start

    # 25 times the languages; the rest is room for a busy machine
    assert min(seconds(100) for _ in range(2)) < 50 * max(seconds(4) for _ in range(3))


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = learn_languages(docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))
    found = identify_languages(docs, model).withColumn("out", held_out(F.col("doc_id"), 4, 2)).filter("out")
    right = found.join(docs.select("doc_id", "lang"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.98


def test_documents_do_not_mix():
    codes, doc = trigram_codes(np.frombuffer(b"abcd", np.uint8), np.array([0, 2, 2, 4]))
    a, b, c, d = letter_classes()[[97, 98, 99, 100]]
    pack = lambda x, y, z: (x * CLASSES + y) * CLASSES + z
    assert codes.tolist() == [pack(0, a, b), pack(a, b, 0), pack(0, c, d), pack(c, d, 0)] and doc.tolist() == [0, 0, 2, 2]
