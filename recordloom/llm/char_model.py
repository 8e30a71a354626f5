"""Letter trigrams over whole corpora: counting in tasks, summed by Spark.

A trigram is a letter byte with its two neighbours. ASCII letters are folded, every byte from 0x80 on is a letter of
its own, and all other bytes are one boundary class, so there are at most ``CLASSES ** 3`` trigrams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.arrow_text import slices

CLASSES = 155
#: Trigrams that wait in a task to be counted, and counts that it holds; beyond, it hands them on.
_WAITING = 1_000_000
_HELD = 1_000_000


def letter_classes() -> np.ndarray:
    table = np.zeros(256, np.int32)
    table[97:123] = np.arange(1, 27)
    table[65:91] = np.arange(1, 27)
    table[128:] = np.arange(27, 155)
    return table


def trigram_codes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trigram of every letter and the document it is in; documents are apart by a boundary."""
    n = len(bounds) - 1
    padded = np.zeros(len(data) + n + 1, np.int32)
    doc = np.repeat(np.arange(n, dtype=np.int32), np.diff(bounds))
    padded[np.arange(1, len(data) + 1) + doc] = letter_classes()[data]
    middle = np.flatnonzero(padded)
    codes = (padded[middle - 1] * CLASSES + padded[middle]) * CLASSES + padded[middle + 1]
    starts = bounds[:-1] + np.arange(n) + 1
    return codes, (np.searchsorted(starts, middle, "right") - 1).astype(np.int32)


def _added(held: tuple[np.ndarray, np.ndarray] | None, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of ``held`` and of ``codes``, sorted, with their counts: as many as occur, not as many as there can be."""
    gram, n = np.unique(codes, return_counts=True)
    if held is None:
        return gram, n
    both, place = np.unique(np.concatenate((held[0], gram)), return_inverse=True)
    total = np.zeros(len(both), np.int64)
    np.add.at(total, place, np.concatenate((held[1], n)))
    return both, total


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``kind, gram, n`` of a task's rows; a trigram may come several times."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[str, list[np.ndarray]] = {}
    pending = 0

    def add() -> None:
        for name, codes in waiting.items():
            held[name] = _added(held.get(name), np.concatenate(codes))
        waiting.clear()

    def emit() -> Iterator[pa.RecordBatch]:
        for kind, (gram, n) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(gram), pa.string()), pa.array(gram, pa.int32()), pa.array(n, pa.int64())],
                ["kind", "gram", "n"],
            )
        held.clear()

    for batch in batches:
        kinds = batch.column("kind").to_pylist()
        for low, high, data, bounds in slices(batch.column("text")):
            codes, doc = trigram_codes(data, bounds)
            names = sorted(set(kinds[low:high]))
            number = np.array([names.index(k) for k in kinds[low:high]], np.int32)[doc]
            for i, name in enumerate(names):
                waiting.setdefault(name, []).append(codes[number == i])
            pending += len(codes)
            if pending > _WAITING:
                add()
                pending = 0
                if sum(len(gram) for gram, _ in held.values()) > _HELD:
                    yield from emit()
    add()
    yield from emit()


def trigram_counts(texts: DataFrame) -> DataFrame:
    """``kind, gram, n`` over all rows of ``texts`` (kind string, text string)."""
    counted = texts.select("kind", "text").mapInArrow(count_batches, "kind string, gram int, n long")
    return counted.groupBy("kind", "gram").agg(F.sum("n").alias("n"))
