import random
from itertools import combinations

import numpy as np

from recordloom.llm import near_duplicates as module
from recordloom.llm.near_duplicates import near_duplicates
from recordloom.llm.sketching import EMPTY, fast_sketches
from tests.llm.edges import EDGE_TEXTS, documents, empty


def shingles(text, width=5):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").split(" ")]
    words = [w for part in words for w in part.replace("\t", "\n").replace("\f", "\n").replace("\r", "\n").split("\n") if w]
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or {tuple(words)}


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            label[top(j)] = top(i)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        component = min(ids, default=None)
        out.append((doc, len(sets[i]), component, doc == component))
    return sorted(out, key=repr)


def run(spark, rows):
    found = near_duplicates(documents(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    return sorted(map(tuple, found), key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, groups, copies, edits):
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(30, 140))]
        rows += [edited(rng, words, rng.randrange(edits)) for _ in range(rng.randrange(1, copies))]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_empty(spark):
    assert near_duplicates(empty(documents(spark))).count() == 0


def test_against_all_pairs(spark):
    """Random near copies, awkward rows, a chain whose ends aren't linked, and pairs at the threshold."""
    rows = [(100 + i, t) for i, t in corpus(3, 25, 10, 6)] + EDGE_TEXTS
    chain = [f"chain{i}" for i in range(260)]
    rows += [(1000 + i, " ".join(chain[4 * i : 4 * i + 100])) for i in range(40)]
    for start, shared in ((2000, 89), (3000, 88)):
        words = [f"t{start}x{i}" for i in range(104)]
        rows += [(start, " ".join(words)), (start + 1, " ".join(words[:shared]))]
    found = run(spark, rows)
    assert found == brute(rows)
    component = {r[0]: r[2] for r in found}
    assert {component[1000 + i] for i in range(40)} == {1000}
    # 85 of 100 shingles are linked, 84 are not
    assert component[2001] == 2000 and component[3001] == 3001


def test_hot_group_in_small_blocks(spark, monkeypatch):
    """A large group of near copies that mostly aren't linked with the pivots, cut into many blocks."""
    monkeypatch.setattr(module, "BLOCK_MEMBERS", 16)
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(90)]
    rows = list(enumerate(edited(rng, base, rng.randrange(5)) for _ in range(120)))
    assert run(spark, rows) == brute(rows)


def test_sketches_are_filled_and_estimate_similarity():
    rng = np.random.default_rng(1)
    items = rng.integers(0, 1 << 63, 2000).astype(np.uint64)
    sets = [np.unique(items[:1000]), np.unique(items[250:1250]), items[:1], items[:3]]
    sketch = fast_sketches(sets, 96)
    assert (sketch != EMPTY).all()
    assert abs((sketch[0] == sketch[1]).mean() - 0.6) < 0.2
    assert (fast_sketches([np.zeros(0, np.uint64)], 8) == EMPTY).all()


def test_least_agreement_keeps_the_bound():
    for percent in (80, 85, 90, 95):
        least = module._least_agreement(percent / 100, 96) / 96
        kl = least * np.log(least * 100 / percent) + (1 - least) * np.log((1 - least) / (1 - percent / 100))
        assert least < percent / 100 and np.exp(-96 * kl) <= module.MISS


def test_bands_keep_pairs_at_the_threshold():
    for percent in (80, 84, 85, 95):
        assert (1 - (percent / 100) ** module.ROWS) ** module._bands(percent) <= 5e-8
        assert module._bands(percent) * module.ROWS <= 128


def test_threshold_of_80_against_all_pairs(spark):
    rows = [(100 + i, t) for i, t in corpus(4, 25, 10, 8)] + EDGE_TEXTS
    found = near_duplicates(documents(spark, rows), 80).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows, 80) != brute(rows)


def test_bits_never_lose_a_key(spark, monkeypatch):
    from pyspark.sql import functions as F

    from recordloom.llm import hash_bits as bits_module
    from tests.llm.edges import with_clashes

    rows = with_clashes(spark.range(3000).select(F.when(F.col("id") > 0, F.xxhash64("id")).alias("h"), "id"))
    keys = rows.filter("id % 7 = 0")
    for words in (1, 64, 1 << 18):
        monkeypatch.setattr(bits_module, "WORDS", words)
        maybe, sure = bits_module.split_by_bits(rows, F.col("h"), bits_module.hash_bits(keys, "h"))
        assert maybe.columns == sure.columns == rows.columns
        found = {r["id"] for r in maybe.select("id").collect()}
        assert {i for i in range(0, 3000, 7)} <= found and len(found) + sure.count() == 3000
    assert len(found) < 500
