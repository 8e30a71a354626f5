import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import quality_rules
from recordloom.llm.queries import op11_quality_rules
from recordloom.llm.quality_rules import QualityModel, judge_quality, learn_quality, read_texts
from tests.llm.edges import documents, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines, seen, again = text.split("\n"), set(), 0
    for line in lines:
        again += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(hit)


TEXTS = [
    None, "", " \t\n", "one", "a b c a b c", "a b c d a b", "a a a", "a a a a", "x\nx\n\n\n x\nx\r\n", "Grüße # *$ &|<> \U0001f600 ok %",
    "no break here", "a b\x1cc d\x85e", "same line\nother\nsame line\nsame line", "a b c\x0bd\x0ce\rf a b c", "ab c a bc ab c",
]


def test_measures_equal_a_plain_count(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    found = judge_quality(rows, QualityModel(np.zeros(quality_rules.BUCKETS), 0.0, 0.0)).orderBy("doc_id").collect()
    assert [tuple(r[m] for m in MEASURES) for r in found] == [plain(t) for t in TEXTS]
    assert all(r["base_failed"] and not r["kept"] and r["probability"] == 0.5 for r in found)


@pytest.mark.parametrize("size", [1, 7, 40])
def test_pieces_change_neither_measures_nor_grams(size, monkeypatch):
    texts = [*TEXTS, " ".join(TEXTS[3:]) * 3, "word" * 50, "z\n" * 30]

    def read():
        grams = Counter()

        def add(kind, low, rows, row, bucket):
            grams.update((kind, low + int(r), int(b)) for r, b in zip(row, bucket))

        measures = read_texts(texts, add)
        return {k: v.tolist() for k, v in measures.items()}, grams

    whole = read()
    monkeypatch.setattr(quality_rules, "PIECE_CHARS", size)
    assert read() == whole
    assert whole[0]["n_words"] == [plain(t)[0] for t in texts]


def test_base_rules_decide_first(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = spark.createDataFrame([(1, good), (2, "short text"), (3, "go on now " * 30), (4, " ".join(f"w{i}" for i in range(50)))], "doc_id long, text string")
    model = QualityModel(np.zeros(quality_rules.BUCKETS), 1.0, 0.1)
    found = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in judge_quality(rows, model).collect()}
    assert found == {1: (False, True), 2: (True, False), 3: (True, False), 4: (False, True)}


def test_held_out_rows_and_calibration(spark):
    path = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    test = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    model = learn_quality(docs, labels.filter(~test))
    found = judge_quality(docs.join(labels.filter(test), "doc_id", "left_semi"), model).join(labels, "doc_id").collect()
    right = np.mean([(r["probability"] >= 0.5) == (r["quality"] == 1) for r in found])
    kept_good = np.mean([r["kept"] for r in found if r["quality"] == 1 and not r["base_failed"]])
    caught = np.mean([not r["kept"] for r in found if r["quality"] == 0])
    off = abs(np.mean([r["probability"] for r in found]) - np.mean([r["quality"] for r in found]))
    print(right, kept_good, caught, off)
    assert right > 0.93 and kept_good > 0.97 and caught > 0.75 and off < 0.05


def test_the_fit_reaches_the_minimum(spark, monkeypatch):
    """Against plain gradient descent on the same penalised loss, over a dense matrix."""
    monkeypatch.setattr(quality_rules, "RIDGE", 0.05)
    monkeypatch.setattr(quality_rules, "ROUNDS", 60)
    rows = [(i, " ".join(["good", "fine", "text"][i % 3 :] + ["junk"] * (i % 4 == 0) + ["plain"])) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumn("text", F.concat("text", F.lit(" "), F.col("doc_id").cast("string")))
    labels = spark.createDataFrame([(i, int(i % 4 != 0 or i % 8 == 0)) for i in range(120)], "doc_id long, quality int")
    sample = quality_rules.labelled_sample(docs, labels).collect()
    x = np.zeros((len(sample), quality_rules.BUCKETS))
    for k, r in enumerate(sample):
        x[k, np.frombuffer(r["buckets"], np.int32)] = np.frombuffer(r["shares"], np.float32)
    used = ((x > 0).sum(axis=0) >= 3).nonzero()[0]
    x, y = x[:, used], np.array([r["label"] for r in sample])
    scale = np.zeros(quality_rules.BUCKETS)
    scale[used] = 1 / np.sqrt((x**2).mean(axis=0))
    frame = spark.createDataFrame(sample).repartition(2)
    weights, shift = quality_rules._fit(frame, scale, len(sample), 0.0)
    w, c, scaled = np.zeros(len(used)), 0.0, x * scale[used]
    for _ in range(20_000):
        gap = 1 / (1 + np.exp(-(scaled @ w + c))) - y
        w, c = w - 0.02 * (scaled.T @ gap / len(y) + 0.05 * w), c - 0.2 * gap.mean()
    loss = lambda w, c: np.logaddexp(0, np.where(y == 1, -1, 1) * (scaled @ w + c)).mean() + 0.025 * (w**2).sum()
    assert loss(weights[used] / scale[used], shift) < loss(w, c) + 1e-4


def test_calibration_follows_the_share_of_ones():
    rng = np.random.default_rng(4)
    margin = rng.normal(size=20_000) * 3
    label = (rng.random(20_000) < 1 / (1 + np.exp(-(0.5 * margin + 1)))).astype(float)
    slope, shift = quality_rules._calibrate(margin, label)
    assert abs(slope - 0.5) < 0.03 and abs(shift - 1) < 0.08
    assert quality_rules._calibrate(np.array([5.0]), np.array([1.0])) == (1.0, 0.0)


def test_edges_and_labels_of_one_kind(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(7, 1), (7, 1), (9, 1), (None, 0), (4, None), (5, 3)], "doc_id long, quality int")
    found = judge_quality(docs, learn_quality(docs, labels)).collect()
    assert len(found) == docs.count()
    assert len({r["probability"] for r in found}) == 1 and found[0]["probability"] > 0.5
    none = judge_quality(empty(docs), learn_quality(empty(docs), empty(labels)))
    assert none.collect() == []
    both = spark.createDataFrame([(7, 1), (7, 0), (9, 1), (6, 0)], "doc_id long, quality int")
    assert judge_quality(docs, learn_quality(docs, both)).count() == docs.count()


def test_query_covers_all_documents(spark):
    path = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    found = op11_quality_rules(spark, path).collect()
    assert {r["doc_id"]: tuple(r[m] for m in MEASURES) for r in found} == {i: plain(t) for i, t in docs.items()}
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in found)
