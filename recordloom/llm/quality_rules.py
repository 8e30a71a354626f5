"""Quality rules: plain measures of a text, and a calibrated logistic regression over hashed word and character n-grams.

The model learns from rows labelled 0 or 1. Words, word pairs and character n-grams of words (with one sign for the white space
around them) are hashed into ``BUCKETS`` buckets; a feature is the share of a kind's n-grams that fall into a bucket. The fit
is a full-batch L-BFGS whose gradients Spark adds up over a written sample; another part of the sample calibrates its margins
to probabilities. Texts are scored in Arrow batches and kept from ``KEEP_FROM`` on.

The sample is bounded: ``SAMPLE_ROWS`` different labelled texts, taken by hash, a fifth of them for the calibration. A text with
both labels counts once for each. Without labels of both kinds, the probability is the smoothed share of ones and no n-gram counts.

Null and empty texts have no words and zeros. Words and lines are those of the whole text. Repeated rows get equal results, null ids
stay. Empty tables give empty results. A text longer than ``PIECE_CHARS`` is read in pieces cut at white space, so memory follows
its number of words; a single longer word is read whole. Repeated windows are found by 64-bit hashes of words. Of ``docs`` only
``doc_id`` and ``text`` are read, of ``labels`` only ``doc_id`` and ``quality``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.arrow_text import mix, span_hashes, word_bounds
from recordloom.session import stage

BUCKETS = 1 << 17
SAMPLE_ROWS = 12_000
FIT_TASKS = 8
ROUNDS = 20
RIDGE = 1e-4
KEEP_FROM = 0.5
LEAST_WORDS, MOST_REPEATED = 50, 50
PIECE_CHARS = 1 << 18
CHAR_GRAMS = (3, 4)

_U64 = np.uint64
_SPACE = re.compile(r"[\t-\r ]")
_SPACES = np.array([9, 10, 11, 12, 13, 32])
_SYMBOLS = np.array([ord(c) for c in "#*$%&|<>"])
_KINDS = 2 + len(CHAR_GRAMS)


class Piece:
    """Code points of some texts, or of a part of one that begins and ends with white space where it was cut."""

    def __init__(self, texts: list[str]) -> None:
        points = "".join(texts).encode("utf-32-le", "surrogatepass")
        self.points = np.frombuffer(points, "<u4")
        self.bounds = np.cumsum([0, *map(len, texts)])
        self.space = np.isin(self.points, _SPACES)
        self.starts, self.ends, self.row = word_bounds(self.space, self.bounds)
        self.values = mix(np.where(self.space, 32, self.points).astype(_U64) + _U64(0x1B873593_85EBCA6B))
        self.words = span_hashes(np.arange(len(self.points)), self.starts, self.ends, self.values)

    def per_row(self, rows: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(rows, weights, len(self.bounds) - 1)

    def grams(self, before: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and buckets of the n-grams of each kind. ``before``: the word before a continued text, if any."""
        yield self.row, _bucket(self.words, 0)
        words = np.concatenate((before, self.words))
        row = np.concatenate((np.zeros(len(before), self.row.dtype), self.row))
        same = row[1:] == row[:-1]
        pairs = words[1:][same] * _U64(0x9E3779B97F4A7C15) + words[:-1][same]
        yield row[1:][same], _bucket(mix(pairs), 1)
        place = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        for kind, n in enumerate(CHAR_GRAMS, 2):
            last = max(len(self.points) - n + 1, 0)
            hashed = np.zeros(last, _U64)
            for k in range(n):
                hashed = hashed * _U64(0xD6E8FEB86659FD93) + self.values[k : k + last]
            # white space may only be the first or the last sign, and the gram lies inside one text
            inside = place[:last] == place[n - 1 :][:last]
            for k in range(1, n - 1):
                inside &= ~self.space[k : k + last]
            at = np.flatnonzero(inside)
            yield place[at], _bucket(mix(hashed[at]), kind)


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(hashes + _U64(kind)) >> _U64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def pieces(texts: list[str | None]) -> Iterator[tuple[int, int, Piece, bool]]:
    """``first row, last row + 1, piece, is a part`` for runs of short texts and for the parts of long ones."""
    low, held, size = 0, [], 0
    for row, text in enumerate(texts):
        text = text or ""
        if held and size + len(text) > PIECE_CHARS:
            yield low, row, Piece(held), False
            low, held, size = row, [], 0
        if len(text) <= PIECE_CHARS:
            held.append(text)
            size += len(text)
            continue
        start = 0
        while start is not None:
            # parts share the white space at which they are cut
            cut = _SPACE.search(text, start + PIECE_CHARS)
            yield row, row + 1, Piece([text[start : cut.end()] if cut else text[start:]]), True
            start = cut and cut.start()
        low = row + 1
    if held:
        yield low, len(texts), Piece(held), False


def repeated_words(words: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Per row, the words inside windows of three that its text has twice or more."""
    if len(words) < 3:
        return np.zeros(rows, np.int64)
    window = (words[:-2] * _U64(0x9E3779B97F4A7C15) + words[1:-1]) * _U64(0xC2B2AE3D27D4EB4F) + words[2:]
    window = mix(window)
    inside = row[:-2] == row[2:]
    at = np.flatnonzero(inside)
    order = at[np.lexsort((window[at], row[at]))]
    equal = (window[order][1:] == window[order][:-1]) & (row[order][1:] == row[order][:-1])
    again = np.zeros(len(order), bool)
    again[1:] |= equal
    again[:-1] |= equal
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[order[again] + k] = True
    return np.bincount(row[hit], minlength=rows)


def duplicate_lines(text: str | None) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def read_texts(texts: list[str | None], on_grams: Callable[[int, int, int, np.ndarray, np.ndarray], None]) -> dict[str, np.ndarray]:
    """The plain measures of all texts; ``on_grams`` gets ``kind, first row, rows, row, bucket`` of all n-grams."""
    n = len(texts)
    out = {name: np.zeros(n, np.int64) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    long_texts: dict[int, list[np.ndarray]] = {}
    for low, high, piece, is_part in pieces(texts):
        rows, part = high - low, slice(low, high)
        out["n_words"][part] += piece.per_row(piece.row)
        out["word_chars"][part] += piece.per_row(piece.row, piece.ends - piece.starts).astype(np.int64)
        symbols = np.flatnonzero(np.isin(piece.points, _SYMBOLS))
        out["n_symbols"][part] += piece.per_row(np.searchsorted(piece.bounds, symbols, "right") - 1)
        before = np.zeros(0, _U64)
        if is_part:
            read = long_texts.setdefault(low, [before])
            before = next((words[-1:] for words in reversed(read) if len(words)), before)
            read.append(piece.words)
        else:
            out["n_repeat_words"][part] = repeated_words(piece.words, piece.row, rows)
        for kind, (row, bucket) in enumerate(piece.grams(before)):
            on_grams(kind, low, rows, row, bucket)
    for row, words in long_texts.items():
        words = np.concatenate(words)
        out["n_repeat_words"][row] = repeated_words(words, np.zeros(len(words), np.int64), 1)[0]
    out["n_dup_lines"][:] = [duplicate_lines(text) for text in texts]
    return out


@dataclass
class QualityModel:
    """``weights`` of the buckets, and what turns a margin into a probability: ``1 / (1 + exp(-(slope * margin + shift)))``."""

    weights: np.ndarray
    slope: float
    shift: float

    def probabilities(self, texts: list[str | None]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        margin, measures = self.margins(texts)
        return _sigmoid(self.slope * margin + self.shift), measures

    def margins(self, texts: list[str | None]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        sums, counts = np.zeros((2, _KINDS, len(texts)))

        def add(kind: int, low: int, rows: int, row: np.ndarray, bucket: np.ndarray) -> None:
            sums[kind, low : low + rows] += np.bincount(row, self.weights[bucket], rows)
            counts[kind, low : low + rows] += np.bincount(row, minlength=rows)

        measures = read_texts(texts, add)
        return (sums / np.maximum(counts, 1)).sum(axis=0), measures


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and the shares of its n-grams in them, added over the kinds."""
    found: list[list[np.ndarray]] = [[] for _ in range(_KINDS)]
    read_texts([text], lambda kind, low, rows, row, bucket: found[kind].append(bucket))
    shares: list[tuple[np.ndarray, np.ndarray]] = []
    for parts in found:
        held, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int64), return_counts=True)
        shares.append((held, n / max(n.sum(), 1)))
    held, place = np.unique(np.concatenate([x for x, _ in shares]), return_inverse=True)
    return held, np.bincount(place, np.concatenate([n for _, n in shares]), len(held))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``label, fold, buckets, shares``: at most ``SAMPLE_ROWS`` different labelled texts, the same ones in every run."""
    known = labels.select(F.col("doc_id").alias("_label_id"), F.col("quality").cast("int").alias("_label"))
    known = known.filter(F.col("_label").isin(0, 1) & F.col("_label_id").isNotNull()).distinct()
    rows = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text"))
    seen = rows.join(known, rows["_id"] == known["_label_id"]).groupBy("_text", "_label").agg(F.min("_id").alias("_id"))
    ticket = F.xxhash64(F.lit("quality"), "_text", "_label")
    chosen = stage(seen.withColumn("_ticket", ticket).orderBy("_ticket", "_text").limit(SAMPLE_ROWS), "quality-sample")
    # no more rows than the sample, so it may be sent around
    found = docs.select("doc_id", "text").join(
        F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_text"))
    )
    found = found.select("text", "_text", "_label", "_ticket").dropDuplicates(["_text", "_label"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 100):
                part = batch.slice(low, 100)
                found = [features(text) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_label").cast(pa.int32()), part.column("_ticket").cast(pa.int64()),
                        pa.array([b.astype(np.int32).tobytes() for b, _ in found], pa.binary()),
                        pa.array([s.astype(np.float32).tobytes() for _, s in found], pa.binary()),
                    ],
                    ["label", "ticket", "buckets", "shares"],
                )

    read_rows = found.mapInArrow(read, "label int, ticket long, buckets binary, shares binary")
    # placed and sorted by hash, so that sums are added in one order in every run
    placed = read_rows.repartition(FIT_TASKS, "ticket").sortWithinPartitions("ticket", "label")
    fold = F.pmod(F.col("ticket"), F.lit(5)) == 0
    return stage(placed.select("label", fold.alias("calibrates"), "buckets", "shares"), "quality-features")


def _matrix(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Labels, and the entries of all rows: row, bucket, share."""
    labels, rows, buckets, shares, n = [], [], [], [], 0
    for batch in batches:
        labels.append(batch.column("label").to_numpy())
        for b, s in zip(batch.column("buckets").to_pylist(), batch.column("shares").to_pylist()):
            buckets.append(np.frombuffer(b, np.int32))
            shares.append(np.frombuffer(s, np.float32))
            rows.append(np.full(len(buckets[-1]), n, np.int32))
            n += 1
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return join(labels, np.int32), join(rows, np.int32), join(buckets, np.int32), join(shares, np.float32)


def _summed(sample: DataFrame, function: Callable[..., np.ndarray]) -> np.ndarray | None:
    """The sum of ``function(labels, rows, buckets, shares)``, an array of fixed size, over the sample.

    At most ``FIT_TASKS`` of these arrays meet on the driver.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, *entries = _matrix(batches)
        if len(labels):
            yield pa.RecordBatch.from_pydict({"sum": [function(labels, *entries).tobytes()]})

    parts = [np.frombuffer(row["sum"]) for row in sample.coalesce(FIT_TASKS).mapInArrow(partial, "sum binary").collect()]
    return np.sum(parts, axis=0) if parts else None


def learn_quality(docs: DataFrame, labels: DataFrame) -> QualityModel:
    sample = labelled_sample(docs, labels)
    fitted, held = sample.filter("NOT calibrates"), sample.filter("calibrates")
    counts = {row["label"]: row["n"] for row in fitted.groupBy("label").agg(F.count("*").alias("n")).collect()}
    zeros, ones = counts.get(0, 0), counts.get(1, 0)
    if not zeros or not ones:
        return QualityModel(np.zeros(BUCKETS), 0.0, math.log((ones + 1) / (zeros + 1)))
    squares = _summed(fitted, lambda labels, rows, buckets, shares: np.bincount(buckets, shares.astype(float) ** 2, BUCKETS))
    used = _summed(fitted, lambda labels, rows, buckets, shares: np.bincount(buckets, minlength=BUCKETS).astype(float))
    # features at one scale; buckets of fewer than three texts say nothing
    scale = np.where(used >= 3, 1 / np.sqrt(np.maximum(squares / (zeros + ones), 1e-30)), 0)
    weights, shift = _fit(fitted, scale, zeros + ones, math.log(ones / zeros))
    pairs = np.array(_margins(held, weights, shift), float).reshape(-1, 2)
    slope, offset = _calibrate(pairs[:, 0], pairs[:, 1])
    return QualityModel(weights, slope, slope * shift + offset)


def _fit(sample: DataFrame, scale: np.ndarray, n: int, shift: float) -> tuple[np.ndarray, float]:
    """Weights of the unscaled features and the constant, by L-BFGS on the ridge-penalised log loss."""
    context = sample.sparkSession.sparkContext

    def loss(point: np.ndarray) -> tuple[float, np.ndarray]:
        shared = context.broadcast((point[:-1] * scale, point[-1]))

        def gradient(labels, rows, buckets, shares):
            weights, constant = shared.value
            margin = np.bincount(rows, weights[buckets] * shares, len(labels)) + constant
            gap = _sigmoid(margin) - labels
            total = np.logaddexp(0, np.where(labels == 1, -margin, margin)).sum()
            return np.concatenate((np.bincount(buckets, gap[rows] * shares, BUCKETS), [gap.sum(), total]))

        found = _summed(sample, gradient)
        shared.unpersist()
        slope = np.append(found[:-2] * scale, found[-2]) / n
        slope[:-1] += RIDGE * point[:-1]
        return found[-1] / n + RIDGE / 2 * (point[:-1] ** 2).sum(), slope

    point = np.append(np.zeros(BUCKETS), shift)
    value, slope = loss(point)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(ROUNDS):
        direction = -_inverse_times(steps, slope)
        rate = 1.0 if steps else 1 / max(np.abs(slope).sum(), 1e-12)
        while True:
            there, value_there, slope_there = point + rate * direction, *loss(point + rate * direction)
            if value_there <= value + 1e-4 * rate * (slope @ direction) or rate < 1e-6:
                break
            rate /= 4
        moved, turned = there - point, slope_there - slope
        done = value - value_there < 1e-5 * max(value, 1e-3)
        if value_there < value:
            point, value, slope = there, value_there, slope_there
        if done:
            break
        if moved @ turned > 1e-18:
            steps = [*steps[-7:], (moved, turned)]
    return point[:-1] * scale, float(point[-1])


def _inverse_times(steps: list[tuple[np.ndarray, np.ndarray]], slope: np.ndarray) -> np.ndarray:
    """The slope times the inverse curvature that the last steps show."""
    out, used = slope.copy(), []
    for moved, turned in reversed(steps):
        share = (moved @ out) / (moved @ turned)
        used.append(share)
        out -= share * turned
    if steps:
        moved, turned = steps[-1]
        out *= (moved @ turned) / (turned @ turned)
    for (moved, turned), share in zip(steps, reversed(used)):
        out += moved * (share - (turned @ out) / (moved @ turned))
    return out


def _margins(sample: DataFrame, weights: np.ndarray, shift: float) -> list[tuple[float, int]]:
    """Margin and label of each row; of the calibration's share of the bounded sample."""
    shared = sample.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, rows, buckets, shares = _matrix(batches)
        margin = np.bincount(rows, shared.value[buckets] * shares, len(labels)) + shift
        yield pa.RecordBatch.from_pydict({"margin": margin, "label": labels})

    return [tuple(row) for row in sample.mapInArrow(score, "margin double, label int").collect()]


def _calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the margins of rows that the fit has not seen, with smoothed targets."""
    ones, zeros = (label == 1).sum(), (label == 0).sum()
    if not ones or not zeros:
        return 1.0, 0.0
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    scale = max(np.abs(margin).max(), 1e-9)
    x = np.stack([margin / scale, np.ones(len(margin))])
    point = np.array([scale, 0.0])
    for _ in range(50):
        p = _sigmoid(point @ x)
        slope = x @ (p - target) + 1e-6 * point
        curve = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        point -= step * min(1, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(point[0] / scale), float(point[1])


def judge_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id``, the plain measures, ``base_failed``, ``probability`` of label 1 and ``kept`` for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                probability, found = shared.value.probabilities(part.column("text").to_pylist())
                failed = (found["n_words"] < LEAST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"])
                columns = [found[name] for name in measures] + [failed, probability, ~failed & (probability >= KEEP_FROM)]
                names = [*measures, "base_failed", "probability", "kept"]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, columns)], ["doc_id", *names])

    schema = "doc_id long, " + ", ".join(f"{name} long" for name in measures) + ", base_failed boolean, probability double, kept boolean"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, schema)
