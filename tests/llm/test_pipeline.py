"""The pipeline against a brute-force version of each stage's decision on small, awkward documents."""

import random
from zlib import crc32

import corpus_pipeline
from tests.llm.edges import EDGE_TEXTS, documents
from tests.llm.test_decontamination import brute as benchmark_hits
from tests.llm.test_decontamination import words
from tests.llm.test_near_duplicates import brute as groups
from tests.llm.test_secrets import brute as secrets

PASSAGE = "Seven wonders were named in the old book, but only one of them still stands there today."


def corpus():
    rng = random.Random(6)
    vocabulary = "the garden was quiet and people were walking along river with their friends after lunch in town".split()
    rows = list(EDGE_TEXTS)
    for i in range(60):
        text = " ".join(rng.choice(vocabulary) for _ in range(60))
        rows.append((100 + i, text))
        if i % 6 == 0:
            rows.append((200 + i, text + " again"))
        if i % 7 == 0:
            rows.append((300 + i, text[: len(text) // 2] + " " + PASSAGE + " " + " ".join(rng.choice(vocabulary) for _ in range(60))))
        if i % 8 == 0:
            rows.append((400 + i, " ".join(rng.choice(vocabulary) for _ in range(60)) + ' token = "abcdefABCDEF0123"'))
    return rows


def test_stages(spark, tmp_path):
    rows = corpus()
    folder = str(tmp_path / "tables")
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    items = [(1, PASSAGE), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, [[(r["doc_id"], r["text"]) for r in docs.collect()]]
    for number, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, folder).write.parquet(path := f"{tmp_path}/{number}")
        docs = spark.read.parquet(path)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        seen.append([(r["doc_id"], r["text"]) for r in docs.collect()])
    start, named, single, clean, scanned, mixed = (sorted(x, key=repr) for x in seen)

    lettered = sorted(((i, t) for i, t in start if any(c.isalpha() for c in t or "")), key=repr)
    # the few learned texts here know little of the shortest ones
    assert set(named) <= set(lettered) and all(len(t.split()) < 6 for _, t in set(lettered) - set(named))
    kept = {i for i, _, _, keep in groups(named) if keep}
    assert {i for i, _ in single} == kept and len(set(single)) == len(single) < len(named)
    assert {i for i, _ in clean} == {i for i, _ in single}
    before = {i: t for i, t in single if i != 7}  # two texts have id 7
    for i, text in clean:
        if i == 7:
            continue
        n, hit, _ = benchmark_hits(before[i], items)
        assert benchmark_hits(text, items)[1] == 0 and len(words(text)) == n - hit
        assert hit or text == before[i]
    before = dict(clean)
    assert {i for i, _ in scanned} == set(before)
    for i, text in scanned:
        assert secrets(text) == "" and (i == 7 or secrets(before[i]) or text == before[i])
    assert set(mixed) <= set(scanned) and all(r["taken"] > 0 for r in docs.collect())
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())


def test_many_languages_in_one_document(spark):
    """Seven languages in equal parts: each explains a small share, all together explain everything."""
    rng = random.Random(2)
    letters, rows = "abcdefghijklmnopqrstu", []
    texts = [" ".join("".join(rng.choice(letters[3 * k : 3 * k + 3]) for _ in range(6)) for _ in range(80)) for k in range(7)]
    rows = [(k, text, f"l{k}") for k, text in enumerate(texts)] + [(100, " ".join(texts), None), (101, "vwxyz zyxwv " * 40, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.language_stage(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] >= 100) == [100]


def test_language_stage_learns_from_all_documents(spark):
    """A language whose only documents op1 would hold out is known to the stage."""
    rows = [(i, "the garden was quiet and people were walking " * 5, "en") for i in range(40) if crc32(b"%d" % i) % 4 != 2]
    held = [i for i in range(100, 200) if crc32(b"%d" % i) % 4 == 2][:2]
    rows += [(i, "xyzzy qwxq zyqx xqyz wqzx " * 5, "xx") for i in held]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.language_stage(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _, _ in rows)


def test_near_duplicates_from_80_percent(spark):
    """80 of 100 shingles are near copies for the stage, 79 are not."""
    rows = []
    for start, shared in ((10, 84), (20, 83)):
        words = [f"t{start}x{i}" for i in range(104)]
        rows += [(start, " ".join(words)), (start + 1, " ".join(words[:shared]))]
    kept = corpus_pipeline.near_duplicate_stage(spark, documents(spark, rows), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [10, 20, 21]


def test_equal_rows_that_differ_elsewhere(spark):
    """One of them stays, the same one in whatever order they come."""
    text = "several words that are long enough to have some shingles of five words"
    rows = [(1, text, "en", source, 5) for source in ("c", None, "a", "b", "a")] + [(2, text + " more", "en", "z", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for order in (rows, rows[::-1], sorted(rows, key=repr)):
        kept = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(order, schema).repartition(3), "")
        assert [tuple(r) for r in kept.collect()] == [(1, text, "en", "a", 5)]


def test_run_without_further_columns(spark, tmp_path):
    folder = str(tmp_path / "tables")
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("the garden was quiet and people were walking".split()) for _ in range(20))) for i in range(24)]
    documents(spark, [*rows, (99, None)], clashes=False).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "taken"]
    taken = {r["doc_id"]: r["taken"] for r in found.collect()}
    assert set(taken) <= {i for i, _ in rows} and abs(sum(taken.values()) - 1.5 * 20 * 24) <= 4


def test_empty_documents(spark, tmp_path):
    folder = str(tmp_path / "tables")
    documents(spark).filter("false").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
