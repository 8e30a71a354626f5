"""Toxicity by a noisy channel: disguised words are restored by Viterbi decoding, then texts are scored.

A token of letters, digits and signs is a lattice: letters stay or, repeated, may fall away; signs and digits stand for the
letters they look like or fall away; separators between letters and pieces fall away. The path with the best sum of channel
costs and a letter-trigram model of the whole corpus is the restored word. Tokens with a single path
need no decoding; all others are decoded, see ``disguised``.

Scores come from the distinct words of a text, plain and restored: a word counts by its strongest feature, itself or its
first 4, 5 or 6 bytes, and a logistic regression judges sum, largest, number and rate of such words. Both are learned
from a bounded sample of labelled rows; features stay only where a likelihood-ratio test stands up to the number tried.

Null, empty and wordless texts have no evidence and get the score of none. Labels: a repeated id is toxic if any of
its rows is, null labels and ids teach nothing. Without labels of both kinds every score is 0. Repeated rows get equal scores. Only
``doc_id`` and ``text`` are read; ids serve to find labels, never to score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.arrow_text import byte_values, mix, slices, span_hashes, word_bounds
from recordloom.llm.char_model import CLASSES, letter_classes, trigram_counts

#: The classifier is fitted on at most about this many labelled rows, chosen by a hash of their ids, then of id and text;
#: equal rows stay or go together and count as often as they stand there.
SAMPLE_ROWS = 40_000
#: The letters that a digit or sign stands for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
#: Channel costs: a look-alike, the second and any further repetition that falls away, a separator, any other sign that
#: falls away. Letters cost what the trigram model says above its mean, so short words aren't favoured.
LOOK_COST, TWICE_COST, REPEAT_COST, SEPARATOR_COST, DROP_COST = 0.7, 4.0, 0.1, 0.1, 8.0
_PREFIXES = (0, 4, 5, 6)  # 0: the whole word
_SALTS = mix(np.arange(1, 5, dtype=np.uint64))
_LEAST_POSITIVE = 4
_JOINED = 6
#: Restored tokens that a task holds at most; beyond, it starts anew.
_MEMO = 200_000


def _byte_kinds() -> dict[str, np.ndarray]:
    kinds = {name: np.zeros(256, bool) for name in ("letter", "sign", "look", "gap")}
    kinds["letter"][97:123] = kinds["letter"][65:91] = kinds["letter"][128:] = True
    for sign in LOOKS_LIKE:
        kinds["sign"][ord(sign)] = kinds["look"][ord(sign)] = True
    kinds["sign"][48:58] = True
    for sign in " .-_*":
        kinds["gap"][ord(sign)] = True
    return kinds


@dataclass
class LetterModel:
    """``-log p(next class | two classes)`` less its mean; class 0 is the boundary."""

    cost: np.ndarray

    @classmethod
    def of_counts(cls, grams: np.ndarray, counts: np.ndarray) -> LetterModel:
        """Only classes 0 to 26 are told apart, the other bytes are one class: restored words are ASCII."""
        table = np.full((28, 28, 28), 0.05)
        first, rest = np.divmod(grams.astype(np.int64), CLASSES**2)
        middle, last = np.divmod(rest, CLASSES)
        np.add.at(table, (np.minimum(first, 27), np.minimum(middle, 27), np.minimum(last, 27)), counts)
        # words start like the middle letters of trigrams that follow a boundary
        table[:, 0, :] = table[0].sum(axis=1)[None, :]
        table[:, 0, 0] = 0.05
        cost = -np.log(table / table.sum(axis=2, keepdims=True))
        return cls(cost - (table * cost).sum() / table.sum())


def restore(token: str, cost: list) -> str:
    """The most likely plain word behind ``token`` (lower case), by Viterbi over its lattice."""
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    before = earlier = ""
    for char in token:
        again = REPEAT_COST if char == before == earlier else TWICE_COST
        if "a" <= char <= "z":
            edges = [(ord(char) - 96, 0.0)]
            if char == before:
                edges.append((-1, again))
        elif char in LOOKS_LIKE:
            edges = [(ord(c) - 96, LOOK_COST) for c in LOOKS_LIKE[char]] + [(-1, again if char == before else DROP_COST)]
        elif char in " .-_*":
            edges = [(-1, SEPARATOR_COST)]
        elif ord(char) >= 128:
            edges = [(27, 0.0)]
        else:
            edges = [(-1, DROP_COST)]
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (total, path) in states.items():
            for letter, price in edges:
                if letter < 0:
                    key, value, grown = (a, b), total + price, path
                else:
                    key, value, grown = (b, letter), total + price + cost[a][b][letter], (path, char if letter == 27 else chr(96 + letter))
                if key not in after or value < after[key][0]:
                    after[key] = (value, grown)
        states, earlier, before = after, before, char
    _, path = min((total + cost[a][b][0], path) for (a, b), (total, path) in states.items())
    letters = []
    while path:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


def _running(which: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(which)))


def disguised(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows ``document, start, end`` of the spans that may be disguised words: those with more than one path.

    These are tokens with a letter and a digit or sign, with a doubled letter, or of look-alikes only; three or more single
    characters with nothing but gap characters between them; and tokens joined by gap characters without a space: all of
    such a chain, and every two to ``_JOINED`` neighbours in it. Exclamation marks that end a token are read as punctuation
    and, where the token has other signs, also as letters. Longer pieces are not joined across spaces, which part
    ordinary short words.
    """
    kinds = _byte_kinds()
    inside = kinds["letter"][data] | kinds["sign"][data]
    starts, ends, doc = word_bounds(~inside, bounds)
    if not len(starts):
        return np.zeros((0, 3), np.int64)
    folded, places = letter_classes()[data], np.arange(1, len(data) + 1)
    double = np.zeros(len(data), bool)
    double[1:] = (folded[1:] > 0) & (folded[1:] < 27) & (folded[1:] == folded[:-1])

    # signs between tokens are not inside and count as zero
    body = np.maximum(np.maximum.reduceat(np.where(inside & (data != ord("!")), places, 0), starts), starts)
    letter, sign, look = (kinds[k][data] for k in ("letter", "sign", "look"))
    signs, letters, looks, all_ = map(_running, (sign, letter, look, inside))
    signs, pairs = signs[body] - signs[starts], _running(double)
    doubled = pairs[body] - pairs[np.minimum(starts + 1, body)]  # the byte before a start may be another document's
    alike = (body - starts > 1) & (looks[body] - looks[starts] == body - starts)
    mixed = (letters[body] > letters[starts]) & (signs > 0)
    odd = mixed | (doubled > 0) | alike
    ended = (mixed | alike) & (ends > body)
    found = [(doc[odd], starts[odd], body[odd]), (doc[ended], starts[ended], ends[ended])]

    # linked[i]: only gap characters part token i from the one before it; tight[i]: and no space
    linked, tight = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    others, spaces = _running(~kinds["gap"][data]), _running(data == ord(" "))
    linked[1:] = (doc[1:] == doc[:-1]) & (others[starts[1:]] == others[ends[:-1]])
    tight[1:] = linked[1:] & (spaces[starts[1:]] == spaces[ends[:-1]])
    single = ends - starts == 1
    alone = linked & single
    alone[1:] &= single[:-1]

    def runs(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last tokens of maximal runs."""
        edge = np.flatnonzero(np.diff(np.concatenate((links, [False])).astype(np.int8)))
        return edge[::2], edge[1::2]

    first, last = runs(alone)
    long_ = last - first >= 2
    joins = [(first[long_], last[long_])]
    if tight.any():
        joins.append(runs(tight))
        chained = np.cumsum(tight)
        for size in range(1, _JOINED):
            low = np.arange(len(starts) - size)
            joins.append((low := low[chained[low + size] - chained[low] == size], low + size))
        singles = np.concatenate(([0], np.cumsum(single)))
        joins[1:] = [(low[keep], high[keep]) for low, high in joins[1:] for keep in [singles[high + 1] - singles[low] < high + 1 - low]]
    for low, high in joins:
        begin, end = starts[low], ends[high]
        word = (letters[end] > letters[begin]) | (looks[end] - looks[begin] == all_[end] - all_[begin])
        found.append((doc[low][word], begin[word], end[word]))
    spans = np.concatenate([np.stack(part, axis=1) for part in found]).astype(np.int64)
    _, first = np.unique(spans[:, 1] * (len(data) + 1) + spans[:, 2], return_index=True)
    return spans[first]


class WordFeatures:
    """Hashed features of the words of a slice, plain ones and those that decoding restores."""

    def __init__(self, cost: list, memo: dict[bytes, bytes]) -> None:
        self.cost, self.memo, self.values = cost, memo, byte_values(lower=True)
        self.apart, self.table = ~_byte_kinds()["letter"], np.array(cost)

    def of(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents of all words, a row of feature hashes for each (column 0 is the word itself), the number of plain ones.

        Plain words come first; a restored word follows only where it differs from what stands there.
        """
        doc, hashes = self._of_words(data, bounds)
        plain, found = len(doc), disguised(data, bounds)
        found = found[self._open(data, bounds, found)]
        if len(found):
            _, first, same = np.unique(span_hashes(data, found[:, 1], found[:, 2], self.values), return_index=True, return_inverse=True)
            words = [self._restored(data[start:end].tobytes().lower()) + b" " for _, start, end in found[first].tolist()]
            edges = np.concatenate(([0], np.cumsum([len(w) for w in words])))
            place, more = self._of_words(np.frombuffer(b"".join(words), np.uint8), edges)
            row = np.full(len(words), -1)
            row[place] = np.arange(len(place))
            row = row[same]
            doc = np.concatenate((doc, found[row >= 0, 0]))
            hashes = np.concatenate((hashes, more[row[row >= 0]]))
        return doc, hashes, plain

    def _open(self, data: np.ndarray, bounds: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Spans that decoding may change.

        In a span of letters without triples each double is decided by its neighbours alone, as the best path would: one
        letter falls away if that costs less than the two trigrams that end and start with the double. Spans that
        keep all doubles are what they were.
        """
        classes, letter = np.minimum(letter_classes()[data], 27), _running(~self.apart[data])
        place = np.flatnonzero((classes[1:] == classes[:-1]) & (classes[1:] > 0) & (classes[1:] < 27)) + 1
        cut = np.zeros(len(data) + 1, bool)
        cut[bounds] = True
        before = np.where((place > 1) & ~cut[place - 1], classes[place - 2], 0)
        after = np.where(cut[place + 1], 0, classes[np.minimum(place + 1, len(data) - 1)])
        middle = classes[place]
        gain = np.zeros(len(data), bool)
        gain[place] = (
            TWICE_COST + self.table[before, middle, after] < self.table[before, middle, middle] + self.table[middle, middle, after]
        ) | (before == middle)
        gains, (start, end) = _running(gain), found[:, 1:].T
        return (letter[end] - letter[start] < end - start) | (gains[end] > gains[np.minimum(start + 1, end)])

    def _restored(self, token: bytes) -> bytes:
        """The restored word, nothing if that is the token."""
        if token not in self.memo:
            if len(self.memo) >= _MEMO:
                self.memo.clear()
            word = restore(token.decode(errors="replace"), self.cost).encode()
            self.memo[token] = b"" if word == token else word
        return self.memo[token]

    def _of_words(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, doc = word_bounds(self.apart[data], bounds)
        columns = [
            mix(span_hashes(data, starts, np.minimum(ends, starts + size) if size else ends, self.values) ^ salt)
            for size, salt in zip(_PREFIXES, _SALTS)
        ]
        return doc, np.stack(columns, axis=1) if len(starts) else np.zeros((0, len(_PREFIXES)), np.uint64)


def learn_letters(docs: DataFrame) -> LetterModel:
    counts = trigram_counts(docs.select(F.lit("").alias("kind"), "text")).toPandas()
    return LetterModel.of_counts(counts["gram"].to_numpy(), counts["n"].to_numpy())


@dataclass
class ToxicityModel:
    """Weights of word features, and of what a text shows of them (see ``_evidence``)."""

    features: np.ndarray
    weights: np.ndarray
    judgement: np.ndarray | None
    letters: LetterModel


def _feature_counts(rows: DataFrame, letters: LetterModel, wanted: np.ndarray | None) -> DataFrame:
    """``feature, n``: in how many texts each feature stands; only those ``wanted``, if given."""
    shared = rows.sparkSession.sparkContext.broadcast((letters.cost, wanted))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, only = shared.value
        maker = WordFeatures(cost.tolist(), {})
        for batch in batches:
            for _, _, data, bounds in slices(batch.column("text")):
                doc, hashes, _ = maker.of(data, bounds)
                flat, owner = hashes.ravel(), np.repeat(doc, hashes.shape[1])
                if only is not None:
                    held = np.isin(flat, only)
                    flat, owner = flat[held], owner[held]
                order = np.lexsort((owner, flat))
                flat, owner = flat[order], owner[order]
                fresh = np.ones(len(flat), bool)
                fresh[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
                feature, n = np.unique(flat[fresh], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(feature.view(np.int64)), pa.array(n, pa.int64())], ["feature", "n"])

    return rows.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _surprise(a: np.ndarray, n1: float, b: np.ndarray, n0: float) -> np.ndarray:
    """The likelihood-ratio statistic of counts ``a`` of ``n1`` against ``b`` of ``n0``."""
    rate = (a + b) / (n1 + n0)
    total = np.zeros(len(a))
    for seen, n in ((a, n1), (b, n0)):
        for part, share in ((seen, rate), (n - seen, 1 - rate)):
            part = np.maximum(part, 0)
            total += 2 * np.where(part > 0, part * np.log(np.maximum(part, 1e-12) / np.maximum(n * share, 1e-12)), 0)
    return total


def learn_toxicity(docs: DataFrame, labels: DataFrame, letters: LetterModel, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from ``labels`` (doc_id, toxic), at most about ``sample_rows`` of them and as many distinct rows of documents."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    total = known.count()
    share = min(1.0, sample_rows / max(1, total))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    # broadcast: the sample is bounded by sample_rows, two numbers a row
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    sizes = _sizes(rows)
    if sum(sizes.values()) > sample_rows:
        # ids that repeat bring more rows than labels; rows with equal id and text stay or go together
        part = math.ceil(sample_rows / sum(sizes.values()) * (1 << 20))
        rows = rows.filter(F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(1 << 20)) < part)
        sizes = _sizes(rows)
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), None, letters)
    toxic = _feature_counts(rows.filter("toxic = 1"), letters, None).filter(F.col("n") >= _LEAST_POSITIVE).toPandas()
    toxic = toxic.sort_values("feature")
    wanted = toxic["feature"].to_numpy().view(np.uint64)
    clean = _feature_counts(rows.filter("toxic = 0"), letters, wanted).toPandas().set_index("feature")["n"]
    a = toxic["n"].to_numpy().astype(float)
    b = toxic["feature"].map(clean).fillna(0).to_numpy().astype(float)
    weight = np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1))
    tried = max(2, len(wanted))
    keep = (_surprise(a, n1, b, n0) > 2 * math.log(tried) + 8) & (weight > math.log(n0 / n1 + 1))
    order = np.argsort(wanted[keep])
    model = ToxicityModel(wanted[keep][order], weight[keep][order], None, letters)
    model.judgement = _fit(*_fit_rows(rows, model))
    return model


def _sizes(rows: DataFrame) -> dict[int, int]:
    return {row["toxic"]: row["n"] for row in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}


def _fit_rows(rows: DataFrame, model: ToxicityModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct evidence, labels, and how many rows have them: equal rows reach the driver once."""
    seen = _evidence(rows.withColumn("label", F.col("toxic").cast("double")), model, "label", "label double")
    seen = seen.groupBy(*_EVIDENCE, "label").agg(F.count("*").alias("n")).toPandas()
    seen = seen.sort_values([*_EVIDENCE, "label"])  # sums in the fit don't depend on the order of tasks
    return seen[list(_EVIDENCE)].to_numpy(), seen["label"].to_numpy(), seen["n"].to_numpy().astype(float)


def _fit(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Ridge-regularised logistic regression by Newton steps, ``n`` times each row; the first number is the intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [1e-2] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (n * (p - y)) + ridge @ beta
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, slope)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


#: What a text shows: the sum and the largest of its words' weights, the logarithm of their number, and their number
#: among a hundred plain words.
_EVIDENCE = ("total", "largest", "words", "rate")


def _evidence(docs: DataFrame, model: ToxicityModel, key: str, key_type: str) -> DataFrame:
    """``key`` and the evidence of each row's text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.letters.cost))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights, cost = shared.value
        maker = WordFeatures(cost.tolist(), {})
        # most words miss this table of low bits and are done
        low_bits = np.uint64((1 << 20) - 1)
        maybe = np.zeros(1 << 20, bool)
        maybe[features & low_bits] = True
        for batch in batches:
            for low, high, data, bounds in slices(batch.column("text")):
                seen = np.zeros((4, high - low))
                if len(features):
                    doc, hashes, plain = maker.of(data, bounds)
                    count = np.maximum(np.bincount(doc[:plain], minlength=high - low), 1)
                    at = np.flatnonzero(maybe[hashes & low_bits].any(axis=1))
                    doc, hashes = doc[at], hashes[at]
                    place = np.minimum(np.searchsorted(features, hashes), len(features) - 1)
                    best = np.where(features[place] == hashes, weights[place], 0).max(axis=1, initial=0)
                    order = np.lexsort((hashes[:, 0], doc))
                    doc, word, best = doc[order], hashes[order, 0], best[order]
                    fresh = best > 0
                    fresh[1:] &= (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])
                    doc, best = doc[fresh], best[fresh]
                    np.add.at(seen[0], doc, best)
                    np.maximum.at(seen[1], doc, best)
                    found = np.bincount(doc, minlength=high - low)
                    seen[2], seen[3] = np.log1p(found), 100 * found / np.maximum(count, found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(low, high - low), *map(pa.array, seen)], [key, *_EVIDENCE]
                )

    columns = ", ".join(f"{name} double" for name in _EVIDENCE)
    return docs.select(key, "text").mapInArrow(gather, f"{key_type}, {columns}")


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score`` for each row of ``docs``."""
    seen = _evidence(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, "doc_id", "doc_id long")
    if model.judgement is None:
        return seen.select("doc_id", F.lit(0.0).alias("score"))
    logit = F.lit(float(model.judgement[0]))
    for name, weight in zip(_EVIDENCE, model.judgement[1:].tolist()):
        logit = logit + F.col(name) * F.lit(weight)
    return seen.select("doc_id", (1 / (1 + F.exp(-logit))).alias("score"))
