"""Alignment of two tokenizers' tokens by the bytes they cover.

A is a byte-level BPE of the ``tokenizers`` library and reads a space and the text; B is a byte-fallback BPE of
``sentencepiece`` and reads the text, to which it adds the space itself. The spans that the libraries report (character
offsets of A, the byte spans of B's proto, which has replaced the immutable one) are the coarse cuts. Where a cut lies inside a character (A's tokens share it,
B falls back to bytes) it is refined with the decoded bytes of the tokens. Cuts that both have close a group, and the two
tokens that end there are linked.

Neither tokenizer has a token across the border of a word character or printable ASCII sign and a space after it
(A's pattern starts a new token at white space, no piece of B has a space behind another character), so texts are cut
there and each distinct part is tokenized once, while it is in a memo of bounded size. A model of B with such pieces
is refused. Links are counted in Spark: partial counts per document, frequent pairs met through a broadcast table of at most
``HEAD_PAIRS`` rows, all others through a join.

Null and empty texts, and those whose joined token bytes are not a space and the text (a literal U+2581), have no tokens:
zeros and an empty digest. Special tokens' strings in a text are plain text. Repeated rows get a row each and their links
count as often; null ids stay. An empty table gives an empty result. Long texts are read in parts of ``PART_CHARS``, cut at such
borders; only a run without any is read whole. Of ``docs`` only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.session import stage

HEAD_PAIRS = 1 << 18
PART_CHARS = 1 << 20
MEMO_CHARS, MEMO_PARTS = 16 << 20, 1 << 18

# B reads a part behind its space and adds none to nothing, so a last single space stays with what is before it
_BORDER = re.compile(r"(?<=[\w!-~])(?= (?s:.))")
_SPACE = "▁"
#: Parts in one call of a tokenizer.
ROW_PARTS = 64
_LAST = re.compile(r"[\w!-~]\Z")
_COLUMNS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other bytes for U+0100 and up."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers, and what is known of the parts of texts seen lately."""

    def __init__(self, bpe: bytes, piece: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece)
        alphabet = _byte_of_char()
        self.a_bytes = [b""] * (max(self.a.get_vocab().values(), default=-1) + 1)
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(_SPACE in piece.lstrip(_SPACE) for piece in pieces):
            raise ValueError("a piece has a space behind another character, so texts can't be cut at spaces")
        self.is_byte = np.array([self.b.is_byte(i) for i in range(len(pieces))])
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if byte else p.replace(_SPACE, " ").encode() for p, byte in zip(pieces, self.is_byte)
        ]
        self.a_length = np.array([len(x) for x in self.a_bytes])
        self.b_length = np.array([len(x) for x in self.b_bytes])
        #: Each token's text in a group that goes on, and in one that ends.
        self.a_text = [[f"{i},", f"{i}|"] for i in range(len(self.a_bytes))]
        self.b_text = [[f"{i},", f"{i};"] for i in range(len(pieces))]
        #: Part -> (groups as text, tokens of A, tokens of B, linked pairs), or None if it can't be aligned. When ``memo`` is full
        #: it becomes ``older``, from which parts come back when they are met.
        self.memo: dict[str, tuple[str, int, int, tuple[int, ...]] | None] = {}
        self.older: dict[str, tuple[str, int, int, tuple[int, ...]] | None] = {}
        self.held = 0

    def parts(self, parts: Iterable[str]) -> None:
        """Align the parts that are not known yet. Those given stay known until the next call."""
        parts = set(parts)
        if self.held > MEMO_CHARS or len(self.memo) > MEMO_PARTS:
            self.memo, self.older, self.held = {}, self.memo, 0
        fresh = parts.difference(self.memo)
        known = {part for part in fresh if part in self.older}
        self.memo.update((part, self.older[part]) for part in known)
        self.held += sum(map(len, fresh))
        fresh = fresh.difference(known)
        # parts that may stand before another one are tokenized in rows of many
        alone = [part for part in fresh if not _LAST.search(part) or _SPACE in part]
        for some, step in ((list(fresh.difference(alone)), ROW_PARTS), (alone, 1)):
            for low in range(0, len(some), 4096):
                self._align(some[low : low + 4096], step)

    def _align(self, parts: list[str], step: int) -> None:
        data = [part.encode() for part in parts]
        part_first = np.cumsum([0, *map(len, data)])[:-1]
        first, rows = part_first[::step], ["".join(parts[low : low + step]) for low in range(0, len(parts), step)]
        joined = b"".join(data)
        flat = np.frombuffer(joined, np.uint8)

        encoded = self.a.encode_batch(rows, add_special_tokens=False)
        a_ids, a_part, a_fine = _decoded([x.ids for x in encoded], self.a_length, first)
        spans = np.fromiter(chain.from_iterable(chain.from_iterable(x.offsets for x in encoded)), np.int64).reshape(-1, 2)
        chars = np.append(np.flatnonzero((flat & 0xC0) != 0x80), len(flat))
        a_ends = chars[np.searchsorted(chars, first)[a_part] + spans[:, 1]]
        # a token that the next one of its part overlaps ends inside a character
        inside = np.zeros(len(a_ids), bool)
        inside[:-1] = (a_part[1:] == a_part[:-1]) & (spans[1:, 0] < spans[:-1, 1])
        a_ends = np.where(inside, a_fine, a_ends)

        protos = [proto.pieces for proto in self.b.encode([row[1:] for row in rows], return_type="proto", num_threads=1)]
        b_ids, b_part, b_fine = _decoded([[p.id for p in pieces] for pieces in protos], self.b_length, first)
        # the added space stands before all of B's spans; bytes of one character share a span
        b_ends = first[b_part] + 1 + np.fromiter((p.end for pieces in protos for p in pieces), np.int64, len(b_ids))
        b_ends = np.where(self.is_byte[b_ids], b_fine, b_ends)

        last = len(flat)
        bad = set(a_part[a_ends != a_fine].tolist()) | set(b_part[b_ends != b_fine].tolist())
        sides = [(a_ids.tolist(), a_part, self.a_bytes), (b_ids.tolist(), b_part, self.b_bytes)]
        if bad or any(b"".join(map(raw.__getitem__, ids)) != joined for ids, _, raw in sides):
            if step > 1:
                return self._align(parts, 1)
            for ids, part, raw in sides:
                stops = np.searchsorted(part, np.arange(len(parts) + 1)).tolist()
                bad |= {k for k in range(len(parts)) if b"".join(map(raw.__getitem__, ids[stops[k] : stops[k + 1]])) != data[k]}
        elif step > 1:
            a_part, b_part = (np.searchsorted(part_first, ends) - 1 for ends in (a_ends, b_ends))
        a_ends, b_ends = np.minimum(a_ends, last), np.minimum(b_ends, last)
        a_marks, b_marks = np.zeros(last + 1, bool), np.zeros(last + 1, bool)
        a_marks[a_ends] = b_marks[b_ends] = True
        a_cut, b_cut = b_marks[a_ends], a_marks[b_ends]
        # tokens in the order of the groups' text: by group, A before B
        order = np.argsort(np.concatenate((_group(a_cut) * 2, _group(b_cut) * 2 + 1)), kind="stable")
        texts = [self.a_text[i][cut] for i, cut in zip(sides[0][0], a_cut.tolist())]
        texts += [self.b_text[i][cut] for i, cut in zip(sides[1][0], b_cut.tolist())]
        texts = list(map(texts.__getitem__, order.tolist()))
        stops = np.arange(len(parts) + 1)
        a_stops, b_stops = np.searchsorted(a_part, stops), np.searchsorted(b_part, stops)
        linked = np.concatenate(([0], np.cumsum(a_cut)))[a_stops].tolist()
        a_stops, b_stops = a_stops.tolist(), b_stops.tolist()
        pairs = (a_ids[a_cut] << 32 | b_ids[b_cut]).tolist() if a_cut.sum() == b_cut.sum() else []
        for k, part in enumerate(parts):
            i, j, u, v = a_stops[k], a_stops[k + 1], b_stops[k], b_stops[k + 1]
            entry = ("".join(texts[i + u : j + v]), j - i, v - u, tuple(pairs[linked[k] : linked[k + 1]]))
            self.memo[part] = entry if k not in bad else None

    def document(self, split: Iterable[list[str]], known: bool = False) -> tuple | None:
        """``n_a, n_b, n_groups, n_links, groups_sha256, pairs, times``, or None for a text without tokens.

        ``known``: ``parts`` has just been called with all of them.
        """
        digest, n_a, n_b, pairs, before = hashlib.sha256(), 0, 0, [], ""
        for parts in split:
            if not known:
                self.parts(parts)
            entries = list(map(self.memo.__getitem__, parts))
            if None in entries:
                return None
            # each part's text ends with a semicolon; the last one is no separator
            digest.update((before + "".join(map(itemgetter(0), entries))[:-1]).encode())
            before = ";"
            n_a, n_b = n_a + sum(map(itemgetter(1), entries)), n_b + sum(map(itemgetter(2), entries))
            found = np.array(list(chain.from_iterable(map(itemgetter(3), entries))), np.int64)
            pairs.append(np.unique(found, return_counts=True))
        if not n_a:
            return None
        held, times = pairs[0]
        if len(pairs) > 1:
            held, place = np.unique(np.concatenate([p for p, _ in pairs]), return_inverse=True)
            times = np.bincount(place, np.concatenate([n for _, n in pairs])).astype(np.int64)
        # no token is empty, so exactly two tokens end at each cut: a group has one link
        n_links = int(times.sum())
        return n_a, n_b, n_links, n_links, digest.hexdigest(), held, times


def _group(cut: np.ndarray) -> np.ndarray:
    """The number of cuts before each token."""
    return np.cumsum(cut) - cut


def _decoded(ids: list[list[int]], lengths: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all parts in a row, their parts, and where their decoded bytes end."""
    count = np.array([len(x) for x in ids])
    flat = np.fromiter(chain.from_iterable(ids), np.int64, count.sum())
    part = np.repeat(np.arange(len(first)), count)
    ends = np.cumsum(lengths[flat])
    before = np.concatenate(([0], ends))[np.cumsum(count) - count]
    return flat, part, ends - before[part] + first[part]


def _split(text: str | None) -> Iterator[list[str]]:
    """Parts of a space and the text that start with a space, in lists of about ``PART_CHARS`` characters."""
    text, low = " " + text if text else "", 0
    while low < len(text):
        border = _BORDER.search(text, low + PART_CHARS) if low + PART_CHARS < len(text) else None
        high = border.start() if border else len(text)
        yield _BORDER.split(text[low:high])
        low = high


@lru_cache(maxsize=1)
def _aligner(bpe: bytes, piece: bytes) -> Aligner:
    return Aligner(bpe, piece)


def aligned_documents(docs: DataFrame, bpe: bytes, piece: bytes) -> DataFrame:
    """A row for each document: counts, the digest of its groups, its distinct linked pairs (``a << 32 | b``) and how often each."""
    shared = docs.sparkSession.sparkContext.broadcast((bpe, piece))
    names = [field.split()[0] for field in _COLUMNS.split(", ")]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shared.value)
        none = (0, 0, 0, 0, "", (), ())
        schema = pa.schema(
            [("doc_id", pa.int64()), *((n, pa.int64()) for n in names[1:5]), ("groups_sha256", pa.string()),
             *((n, pa.list_(pa.int64())) for n in names[6:])]
        )
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                # shorter texts are split at once, so that few calls meet what is new in them
                splits = [list(_split(t)) if len(t or "") < PART_CHARS // 64 else _split(t) for t in part.column("text").to_pylist()]
                short = [isinstance(split, list) for split in splits]
                aligner.parts(chain.from_iterable(parts for split, near in zip(splits, short) if near for parts in split))
                # longer texts may push what is known into the older half, so they come last
                rows = [aligner.document(split, True) or none if near else None for split, near in zip(splits, short)]
                rows = [row or aligner.document(split) or none for row, split in zip(rows, splits)]
                columns = [pa.array(x, schema.field(n + 1).type) for n, x in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *columns], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(align, _COLUMNS)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, count, best``: how many links hold a pair, and whether no pair of its B id is held by more."""
    counts = _links(aligned).groupBy("pair").agg(F.sum("times").alias("count"))
    counts = stage(counts, "pair-counts").withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return stage(counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "pair-counts")


def _links(aligned: DataFrame, *columns: str) -> DataFrame:
    return aligned.select(*columns, F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        *columns, F.col("link.pairs").alias("pair"), F.col("link.times").alias("times")
    )


def align_tokens(docs: DataFrame, bpe_path: str, piece_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each row of ``docs``.

    The vocabulary files are read on the driver and sent to the tasks, whose machines need not hold them.
    """
    with open(bpe_path, "rb") as a, open(piece_path, "rb") as b:
        aligned = aligned_documents(docs, a.read(), b.read())
    aligned = stage(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = pair_counts(aligned)
    # of a fixed number of rows, however many pairs there are
    head = stage(counts.orderBy(F.desc("count"), "pair").limit(HEAD_PAIRS), "pair-head")
    met = _links(aligned, "row").join(F.broadcast(head), "pair", "left")
    sums = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    ]
    frequent = met.groupBy("row").agg(*sums)
    if counts.count() > HEAD_PAIRS:
        rare = met.filter(F.col("count").isNull()).select("row", "pair", "times").join(counts, "pair").groupBy("row").agg(*sums)
        frequent = frequent.union(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name)
    return aligned.join(frequent, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )
