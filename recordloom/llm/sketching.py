"""Word shingles of documents and their similarity sketches (numpy, inside tasks)."""

from __future__ import annotations

import hashlib

import numpy as np

from recordloom.llm.arrow_text import byte_values, mix, span_hashes, word_bounds

_U64 = np.uint64
#: space, tab, line feed, vertical tab, form feed, carriage return
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_PLACES = mix(np.arange(101, 133, dtype=_U64)) | _U64(1)
EMPTY = _U64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each document.

    A-Z count as a-z, words are runs without blanks; a document of fewer words than
    ``width`` is one shingle, one without words has none.
    """
    n = len(bounds) - 1
    starts, ends, doc = word_bounds(_BLANK[data], bounds)
    words = span_hashes(data, starts, ends, byte_values(lower=True))
    per_doc = np.bincount(doc, minlength=n)
    first = np.concatenate(([0], np.cumsum(per_doc)))
    sets: list[np.ndarray] = []
    places = _PLACES[:width]
    if len(words) >= width:
        rolled = np.zeros(len(words) - width + 1, _U64)
        for place in range(width):
            rolled += words[place : place + len(rolled)] * places[place]
        rolled = mix(rolled + _U64(width))
    for i in range(n):
        count = per_doc[i]
        if count >= width:
            sets.append(np.unique(rolled[first[i] : first[i + 1] - width + 1]))
        elif count:
            short = (words[first[i] : first[i + 1]] * places[:count]).sum(dtype=_U64) + _U64(count)
            sets.append(mix(np.array([short], _U64)))
        else:
            sets.append(np.zeros(0, _U64))
    return sets


def fast_sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """One row of ``size`` coordinates per set, by rounds of hashed bin placement.

    In round ``i < size`` every element goes to a hashed bin with a hashed value that orders
    after all values of earlier rounds; in round ``size + j`` every element goes to bin ``j``. A
    set stops after the first round that leaves none of its bins empty, so all coordinates
    are filled after ``2 * size`` rounds at the latest, and after about ``size * ln(size) /
    elements`` rounds as a rule. Two sets agree in a coordinate with a probability of their
    Jaccard similarity, and the share of agreeing coordinates keeps within Chernoff bounds of it.
    """
    lengths = np.array([len(s) for s in sets], np.int64)
    sketch = np.full((len(sets), size), EMPTY, _U64)
    flat = sketch.reshape(-1)
    owner = np.repeat(np.arange(len(sets)), lengths)
    values = np.concatenate(sets) if len(sets) else np.zeros(0, _U64)
    for turn in range(2 * size):
        if not len(owner):
            break
        hashed = mix(values + _U64((turn + 1) * 0xD1342543DE82EF95 & (1 << 64) - 1))
        if turn < size:
            bins = ((hashed & _U64(0xFFFFFFFF)) * _U64(size) >> _U64(32)).astype(np.int64)
        else:
            bins = np.full(len(owner), turn - size)
        ranked = (_U64(turn) << _U64(56)) | (mix(hashed) >> _U64(8))
        np.minimum.at(flat, owner * size + bins, ranked)
        open_ = (sketch == EMPTY).any(axis=1)[owner]
        owner, values = owner[open_], values[open_]
    return sketch


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each run of ``rows`` coordinates; the band's number is part of it."""
    bands = sketch.shape[1] // rows
    grouped = sketch.reshape(len(sketch), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=_U64) * _PLACES[-1], (len(sketch), bands)).copy()
    for row in range(rows):
        keys = mix(keys * _PLACES[row] + grouped[:, :, row])
    return keys


def set_digest(items: np.ndarray) -> bytes:
    """16 bytes that are equal for equal sets."""
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()
