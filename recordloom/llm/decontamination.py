"""Benchmark decontamination with generalised suffix automata over words.

Test items are cut into shards of bounded size; a task builds one automaton for each. They are written, and travel to the
document tasks in groups of bounded size, one group after the other. A document's words stream through an automaton that keeps the longest match
ending at each word. A match of ``width`` words or more is a window of some item; items of fewer words count
whole. ``scan_documents`` reports hits, ``decontaminate`` cuts hit spans out of texts and drops documents
that are mostly hits.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became a-z. Null and empty texts have no words; items
without words never occur. Repeated items count once per id, a null item id is written as an empty one. Repeated
documents get equal results.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.arrow_text import byte_values, slices, span_hashes, word_bounds
from recordloom.llm.secrets import fresh_name
from recordloom.session import stage

SHARD_WORDS = 50_000
#: A state takes some 400 bytes in a worker.
GROUP_STATES = 400_000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes, and which bytes separate words."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    separator = np.zeros(256, bool)
    separator[:48] = separator[58:65] = separator[91:97] = separator[123:128] = True
    return lower, separator


def words_of(text: str | None) -> list[bytes]:
    lower, separator = _tables()
    data = np.frombuffer((text or "").encode(), np.uint8)
    starts, ends, _ = word_bounds(separator[data], np.array([0, len(data)]))
    flat = lower[data].tobytes()
    return [flat[s:e] for s, e in zip(starts, ends)]


class ItemAutomaton:
    """The suffix automaton of all items of a shard, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], width: int) -> None:
        self.width = width
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for name, words in items]
        for _, words in coded:
            last = 0
            for word in words:
                last = self._extend(last, word)
        #: State of a window of ``width`` words -> names of items; state of a short item -> names.
        self.windows: dict[int, set[str]] = {}
        self.short: dict[int, set[str]] = {}
        for name, words in coded:
            state = 0
            for i, word in enumerate(words):
                state = self.step[state][word]
                if i + 1 >= width:
                    self.windows.setdefault(self._window(state), set()).add(name)
            if 0 < len(words) < width:
                self.short.setdefault(state, set()).add(name)
        self.least = min((min(len(w), width) for _, w in coded if w), default=1 << 60)
        #: The window state at or above each long state; the nearest short item strictly above each state.
        self.window_of = [self._window(s) if self.length[s] >= width else -1 for s in range(len(self.step))]
        self.above = [-1] * len(self.step)
        for s in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            up = self.link[s]
            self.above[s] = up if up in self.short else self.above[up]
        self.hashes = np.zeros(0, np.uint64)
        if self.vocabulary:
            text = b" ".join(self.vocabulary)
            ends = np.cumsum([len(w) + 1 for w in self.vocabulary]) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            self.hashes = np.sort(span_hashes(np.frombuffer(text, np.uint8), starts, ends, byte_values(lower=False)))

    def to_bytes(self) -> bytes:
        return pickle.dumps(vars(self))

    @classmethod
    def from_bytes(cls, data: bytes) -> ItemAutomaton:
        automaton = cls.__new__(cls)
        vars(automaton).update(pickle.loads(data))
        return automaton

    def _new(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        return len(self.step) - 1

    def _extend(self, last: int, word: int) -> int:
        known = self.step[last].get(word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        fresh = known is None
        state = self._new(self.length[last] + 1, 0, {}) if fresh else -1
        at = last
        while fresh and at >= 0 and word not in self.step[at]:
            self.step[at][word] = state
            at = self.link[at]
        if at < 0:
            return state
        target = self.step[at][word]
        if self.length[target] != self.length[at] + 1:
            copy = self._new(self.length[at] + 1, self.link[target], dict(self.step[target]))
            self.link[target] = copy
            while at >= 0 and self.step[at].get(word) == target:
                self.step[at][word] = copy
                at = self.link[at]
            target = copy
        if not fresh:
            return target
        self.link[state] = target
        return state

    def _window(self, state: int) -> int:
        while self.length[self.link[state]] >= self.width:
            state = self.link[state]
        return state

    def match(self, words: list[bytes], hit: np.ndarray, names: set[str]) -> None:
        """Mark the words inside occurrences of windows in ``hit`` and add the items' names."""
        state = matched = 0
        for i, word in enumerate(words):
            code = self.vocabulary.get(word)
            if code is None:
                state = matched = 0
                continue
            while state and code not in self.step[state]:
                state = self.link[state]
                matched = self.length[state]
            if code in self.step[state]:
                state = self.step[state][code]
                matched += 1
            if matched >= self.width:
                hit[i + 1 - self.width : i + 1] = True
                names |= self.windows[self.window_of[state]]
            short = state if state in self.short and matched == self.length[state] else self.above[state]
            while short > 0:
                hit[i + 1 - self.length[short] : i + 1] = True
                names |= self.short[short]
                short = self.above[short]


class DocumentWords:
    """The words of a slice of documents, with hashes to tell quickly which can occur in items."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        lower, separator = _tables()
        self.starts, self.ends, self.doc = word_bounds(separator[data], bounds)
        self.flat = lower[data]
        self.hashes = span_hashes(self.flat, self.starts, self.ends, byte_values(lower=False))
        self.text = self.flat.tobytes()
        self.hit = np.zeros(len(self.starts), bool)
        self.names: dict[int, set[str]] = {}
        self.first = np.searchsorted(self.doc, np.arange(len(bounds)))

    def match(self, automaton: ItemAutomaton) -> None:
        if not len(automaton.hashes) or not len(self.hashes):
            return
        at = np.minimum(np.searchsorted(automaton.hashes, self.hashes), len(automaton.hashes) - 1)
        known = automaton.hashes[at] == self.hashes
        # runs of words that all occur in items, inside one document, and long enough for a window
        change = np.concatenate(([True], (known[1:] != known[:-1]) | (self.doc[1:] != self.doc[:-1]), [True]))
        edge = np.flatnonzero(change)
        for low, high in zip(edge[:-1], edge[1:]):
            if known[low] and high - low >= automaton.least:
                words = [self.text[s:e] for s, e in zip(self.starts[low:high], self.ends[low:high])]
                names: set[str] = set()
                automaton.match(words, self.hit[low:high], names)
                if names:
                    self.names.setdefault(int(self.doc[low]), set()).update(names)


@dataclass(frozen=True)
class AutomatonStore:
    """The written automata and the groups in which they are used, each of a bounded number of states unless one shard has more."""

    rows: DataFrame
    groups: tuple[tuple[int, ...], ...]

    def share(self, group: tuple[int, ...]) -> Broadcast:
        """The automata of one group, sent to all tasks; the driver holds no others."""
        mine = self.rows.filter(F.col("shard").isin(list(group))).select("automaton").collect() if group else []
        return self.rows.sparkSession.sparkContext.broadcast([bytes(row["automaton"]) for row in mine])


def build_automata(items: DataFrame, width: int) -> AutomatonStore:
    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for frame in frames:
            for shard, name, text in zip(frame["shard"], frame["name"], frame["text"]):
                if words := words_of(text):
                    held.setdefault(shard, []).append((name, words))
        for shard in held:
            automaton = ItemAutomaton(held[shard], width)
            yield pd.DataFrame({"shard": [shard], "states": [len(automaton.step)], "automaton": [automaton.to_bytes()]})

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), "text")
    size = named.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    shards = max(1, math.ceil(size / 5 / SHARD_WORDS))
    dealt = named.withColumn("shard", F.pmod(F.xxhash64("name", "text"), F.lit(shards)).cast("int"))
    rows = stage(dealt.repartition(shards, "shard").mapInPandas(build, "shard int, states long, automaton binary"), "automata")
    groups: list[list[int]] = [[]]
    states = 0
    for row in rows.select("shard", "states").orderBy("shard").collect():
        if groups[-1] and states + row["states"] > GROUP_STATES:
            groups.append([])
            states = 0
        groups[-1].append(row["shard"])
        states += row["states"]
    return AutomatonStore(rows, tuple(map(tuple, groups)))


@dataclass(frozen=True)
class _Names:
    """Columns that scanning fills in; those without a name are left out."""

    hits: str
    items: str | None = None
    n_words: str | None = None
    n_hit: str | None = None


def _marked(rows: DataFrame, store: AutomatonStore, names: _Names) -> DataFrame:
    """``rows`` with the hits of all groups, one bit a word; each group reads what the ones before it have found."""
    for group in store.groups:
        shared = store.share(group)
        rows = rows.mapInArrow(_marker(shared, names), rows.schema)
        if len(store.groups) > 1:
            rows = stage(rows, "hits")
            shared.unpersist()
    return rows


def _marker(shared: Broadcast, names: _Names) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [ItemAutomaton.from_bytes(x) for x in shared.value]
        for batch in batches:
            for low, high, data, bounds in slices(batch.column("text")):
                part = batch.slice(low, high - low)
                words = DocumentWords(data, bounds)
                for automaton in automata:
                    words.match(automaton)
                hits, ones = [], []
                for i, old in enumerate(part.column(names.hits).to_pylist()):
                    hit = words.hit[words.first[i] : words.first[i + 1]]
                    if old is not None:
                        hit = hit | np.unpackbits(np.frombuffer(old, np.uint8), count=len(hit)).astype(bool)
                    hits.append(np.packbits(hit).tobytes())
                    ones.append(int(hit.sum()))
                made = {names.hits: hits}
                if names.items:
                    before = part.column(names.items).to_pylist()
                    made[names.items] = [sorted(words.names.get(i, set()) | set(x)) for i, x in enumerate(before)]
                    made |= {names.n_words: np.diff(words.first), names.n_hit: ones}
                arrays = [
                    pa.array(made[field.name], field.type) if field.name in made else part.column(i) for i, field in enumerate(part.schema)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=part.schema)

    return mark


def scan_documents(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` (sorted names) for each row of ``docs``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(None).cast("binary").alias("hits"),
        F.array().cast("array<string>").alias("items"), F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
    )
    found = _marked(rows, build_automata(items, width), _Names("hits", "items", "n_words", "n_hit"))
    return found.select("doc_id", "n_words", "n_hit", "items")


def decontaminate(
    docs: DataFrame, items: DataFrame, width: int = 10, coverage_limit: float = 0.5
) -> DataFrame:
    """``docs`` without hit spans: they are cut from ``text``; documents with a larger share of hit words are dropped.

    Hits of all items are put together before anything is cut. Cutting can join words to a new window, so cutting goes on until
    none is left. The share is that of all words cut or hit so far among the words that the text had at first, so it doesn't
    depend on how items fall into groups. All columns stay; only texts with hits change.
    """
    store = build_automata(items, width)
    if len(store.groups) == 1:
        return docs.mapInArrow(_cleaner(store.share(store.groups[0]), docs.columns.index("text"), coverage_limit), docs.schema)
    hits, total, gone, again = (fresh_name(docs, name) for name in ("_hits", "_total", "_gone", "_again"))
    nothing = F.lit(None).cast("long")
    rows = docs.withColumns({hits: F.lit(None).cast("binary"), total: nothing, gone: nothing, again: F.lit(False)})
    clean = []
    while True:
        marked = _marked(rows, store, _Names(hits))
        rows = stage(marked.mapInArrow(_cutter((hits, total, gone, again), coverage_limit), marked.schema), "decontaminated")
        clean.append(rows.filter(~F.col(again)).select(*docs.columns))
        rows = rows.filter(F.col(again))
        if rows.isEmpty():
            return reduce(DataFrame.union, clean)


def _cutter(names: tuple[str, str, str, str], coverage_limit: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts the marked words; ``again`` is true for texts that have changed and must be read once more."""
    hits, total, gone, again = names

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in (hits, total, gone)}
            bits, texts = columns[hits], batch.column("text")
            totals, cuts, changed = columns[total], columns[gone], [False] * batch.num_rows
            keep, new = np.ones(batch.num_rows, bool), {}
            for i, x in enumerate(bits):
                if not x or not any(x):
                    continue
                data = texts[i].as_py().encode()
                words = DocumentWords(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
                hit = np.unpackbits(np.frombuffer(x, np.uint8), count=len(words.starts)).astype(bool)
                totals[i], cuts[i] = totals[i] or len(hit), (cuts[i] or 0) + int(hit.sum())
                keep[i] = not hit.all() and cuts[i] <= coverage_limit * totals[i]
                changed[i], new[i] = True, _without(data, words, hit).decode()
            made = {hits: [None] * batch.num_rows, total: totals, gone: cuts, again: changed}
            if new:
                made["text"] = [new.get(i, text) for i, text in enumerate(texts.to_pylist())]
            arrays = [
                pa.array(made[field.name], field.type) if field.name in made else batch.column(i) for i, field in enumerate(batch.schema)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema).filter(pa.array(keep))

    return cut


def _without(data: bytes, words: DocumentWords, hit: np.ndarray) -> bytes:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    out, at = [], 0
    for low, high in zip(edge[::2], edge[1::2]):
        out.append(data[at : words.starts[low]])
        at = words.ends[high - 1]
    return b"".join([*out, data[at:]])


def _cleaner(shared: Broadcast, column: int, coverage_limit: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Marks and cuts in one go, where one group holds all automata."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [ItemAutomaton.from_bytes(x) for x in shared.value]
        for batch in batches:
            for low, high, data, bounds in slices(batch.column("text")):
                part = batch.slice(low, high - low)
                words = DocumentWords(data, bounds)
                for automaton in automata:
                    words.match(automaton)
                dirty = np.unique(words.doc[words.hit])
                if not len(dirty):
                    yield part
                    continue
                texts, keep = part.column(column).to_pylist(), np.ones(high - low, bool)
                for i in dirty:
                    texts[i] = _cleaned(texts[i], automata, coverage_limit)
                    keep[i] = texts[i] is not None
                arrays = list(part.columns)
                arrays[column] = pa.array(texts, part.schema.field(column).type)
                changed = pa.RecordBatch.from_arrays(arrays, schema=part.schema)
                yield changed.filter(pa.array(keep))

    return clean


def _cleaned(text: str, automata: list[ItemAutomaton], coverage_limit: float) -> str | None:
    data, total, gone = text.encode(), 0, 0
    while True:
        words = DocumentWords(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        for automaton in automata:
            words.match(automaton)
        total = total or len(words.hit)
        if not words.hit.any():
            return data.decode()
        gone += int(words.hit.sum())
        if words.hit.all() or gone > coverage_limit * total:
            return None
        data = _without(data, words, words.hit)
