import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from recordloom.llm import token_alignment
from recordloom.llm.queries import TOKENIZERS, op12_token_alignment
from recordloom.llm.token_alignment import align_tokens

BPE, PIECE = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
_BYTES = {**{c: c for c in [*range(33, 127), *range(161, 173), *range(174, 256)]}}
_BYTES |= {256 + i: b for i, b in enumerate(b for b in range(256) if b not in _BYTES)}


@pytest.fixture(scope="module")
def plain():
    """Whole texts through both tokenizers, ends added up from decoded bytes, counts in dictionaries."""
    a = Tokenizer.from_file(BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE)

    def tokens(text):
        if not text:
            return None
        want = (" " + text).encode()
        a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        a_raw = [bytes(_BYTES[ord(c)] for c in a.id_to_token(i)) for i in a_ids]
        b_raw = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in b_ids for p in [b.id_to_piece(i)]]
        if b"".join(a_raw) != want or b"".join(b_raw) != want:
            return None
        out = []
        for ids, raw in ((a_ids, a_raw), (b_ids, b_raw)):
            ends, at = [], 0
            for i, x in zip(ids, raw):
                at += len(x)
                ends.append((at, i))
            out.append(ends)
        return out

    def rows(docs):
        seen = [(doc_id, tokens(text)) for doc_id, text in docs]
        links, held = {}, Counter()
        for k, (_, found) in enumerate(seen):
            links[k] = [(x, y) for e, x in found[0] for f, y in found[1] if e == f] if found and len(found[0]) < 400 else _links(found)
            held.update(links[k])
        best = defaultdict(int)
        for (_, y), n in held.items():
            best[y] = max(best[y], n)
        out = []
        for k, (doc_id, found) in enumerate(seen):
            if not found:
                out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
                continue
            cuts = sorted({e for e, _ in found[0]} & {e for e, _ in found[1]})
            groups = [
                "|".join(",".join(str(i) for e, i in side if low < e <= high) for side in found) for low, high in zip([0, *cuts], cuts)
            ] if len(cuts) < 400 else _groups(found, cuts)
            out.append(
                (doc_id, len(found[0]), len(found[1]), len(cuts), len(links[k]), sum(held[p] == best[p[1]] for p in links[k]),
                 sum(held[p] for p in links[k]), hashlib.sha256(";".join(groups).encode()).hexdigest())
            )
        return out

    return rows


def _links(found):
    if not found:
        return []
    there = dict(found[1])
    return [(x, there[e]) for e, x in found[0] if e in there]


def _groups(found, cuts):
    out = []
    sides = [list(found[0]), list(found[1])]
    for cut in cuts:
        texts = []
        for side in sides:
            n = next(k for k, (e, _) in enumerate(side) if e == cut) + 1
            texts.append(",".join(str(i) for _, i in side[:n]))
            del side[:n]
        out.append("|".join(texts))
    return out


EDGES = [
    "", None, " ", "   ", "a", "The quick brown fox.", "é", "naïve  café\n\n x\t y ", "\U0001F9FF\U0001F468‍\U0001F469‍\U0001F467 ok",
    "日本語の文章と漢字。 한국어 문장", "Ünïcödé ßß \r\n\x0b\x0c end", "<|endoftext|> plain <s> </s> <unk> <0x41>", "a▁b", "▁", "x ▁y",
    " leading", "trailing  ", "tab\t tab", "\n \n  \n", "nul\x00 byte", "a b   c　d", "don't we'll I'm", "1234567890 12,345.67",
    "���", "é ö", "same same same", "same same same", "\u0085 x ​ y﻿ z", "\U000E0001   line", "𝔘𝔫𝔦 𝒸ℴ𝒹ℯ",
]


def _run(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return sorted(map(tuple, align_tokens(frame, BPE, PIECE).collect()), key=repr)


def test_edges_equal_whole_texts(spark, plain):
    docs = [(i if i != 5 else None, text) for i, text in enumerate(EDGES)]
    assert _run(spark, docs) == sorted(plain(docs), key=repr)


def test_random_texts_equal_whole_texts(spark, plain):
    rnd = random.Random(3)
    alphabet = [" ", "  ", "\n", "\t", "a", "the", "ing", "é", "ß", "漢", "\U0001F9FF", "'s", "7", "42", "!", "...", " ", "X", "Zz", "　", "_", "-", "́"]
    docs = [(i, "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 60)))) for i in range(400)]
    assert _run(spark, docs) == sorted(plain(docs), key=repr)


def test_rare_pairs_and_small_memo_change_nothing(spark, plain, monkeypatch):
    rnd = random.Random(5)
    docs = [(i, " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 9))) for _ in range(40))) for i in range(50)]
    monkeypatch.setattr(token_alignment, "HEAD_PAIRS", 7)
    assert _run(spark, docs) == sorted(plain(docs), key=repr)


def test_small_parts_and_memo(plain):
    from recordloom.llm.token_alignment import Aligner, _split

    with open(BPE, "rb") as a, open(PIECE, "rb") as b:
        aligner = Aligner(a.read(), b.read())
    text = "naïve  café \U0001F9FF the quick, brown fox's 12 " * 30

    def read():
        *counts, pairs, times = aligner.document(_split(text))
        return [*counts, pairs.tolist(), times.tolist()]

    whole = read()
    token_alignment_limits = token_alignment.PART_CHARS, token_alignment.MEMO_PARTS
    try:
        token_alignment.PART_CHARS, token_alignment.MEMO_PARTS = 17, 3
        aligner.memo.clear()
        assert read() == whole
        assert len(list(_split(text))) > 50
    finally:
        token_alignment.PART_CHARS, token_alignment.MEMO_PARTS = token_alignment_limits
    assert whole[0] == plain([(1, text)])[0][1]


def test_query_on_the_small_tables(spark, plain):
    path = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    assert sorted(map(tuple, op12_token_alignment(spark, path).collect())) == sorted(plain(docs))


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, row int, pair string, count int")
    assert align_tokens(empty, BPE, PIECE).collect() == []
    clash = spark.createDataFrame([(1, "a b", 3, "x", 4)], "doc_id long, text string, row int, pairs string, times int")
    assert align_tokens(clash, BPE, PIECE).first()["n_a"] == 2
