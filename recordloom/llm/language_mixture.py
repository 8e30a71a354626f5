"""Language identification by mixtures: EM over letter trigrams, language sets by penalised likelihood.

Training counts the trigrams of each language over all labelled texts. Every document is then a mixture: EM
estimates which share of its trigrams each language made, and a language joins the set only if the gain in
log-likelihood pays for a penalty that grows with the document's logarithm. The prediction is the language of the
largest share; the score is that share times the share of trigrams the language knows.

A text that is null or has no letter is ``und`` with score 0, and so is every text where nothing was learned. Ties go to the
language that sorts first. Rows with a null language are predicted but not learned from, repeated rows count as often as
they stand there. The model has at most ``CLASSES ** 3`` numbers per language and is what tasks get broadcast. Only
``doc_id``, ``text`` and, to learn, ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.arrow_text import slices
from recordloom.llm.char_model import CLASSES, trigram_codes, trigram_counts

SMOOTHING = 0.5
#: What one more language must gain, in units of log(trigrams of the document).
PENALTY = 2.0
ROUNDS, TOLERANCE = 25, 1e-3
MODEL_BYTES = 1 << 30


@dataclass
class LanguageModel:
    languages: list[str]
    grams: np.ndarray
    #: One row per gram and one for unseen ones, one column per language.
    probability: np.ndarray
    seen: np.ndarray


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def learn_languages(labelled: DataFrame) -> LanguageModel:
    """Learn from ``text, lang``; rows where either is null are left out."""
    texts = labelled.select(F.col("lang").cast("string").alias("kind"), "text").dropna()
    counts = trigram_counts(texts).toPandas()
    languages = sorted(counts["kind"].unique())
    grams = np.unique(counts["gram"].to_numpy())
    if 8 * len(languages) * len(grams) > MODEL_BYTES:
        raise ValueError(f"{len(languages)} languages of {len(grams)} trigrams are too large a model to broadcast")
    table = np.zeros((len(grams) + 1, len(languages)))
    rows = np.searchsorted(grams, counts["gram"].to_numpy())
    table[rows, [languages.index(k) for k in counts["kind"]]] = counts["n"].to_numpy()
    smooth = table + SMOOTHING
    return LanguageModel(languages, grams, (smooth / smooth.sum(axis=0)).astype(np.float32), table > 0)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0)


def _mixture(p: np.ndarray, count: np.ndarray, starts: np.ndarray, lengths: np.ndarray, allowed: np.ndarray):
    """Shares and log-likelihood of each document over its allowed languages, by EM."""
    total = _sums(count, starts)
    shares = (allowed / allowed.sum(axis=1, keepdims=True)).astype(np.float32)
    moving = np.ones(len(shares), bool)  # each document stops by itself, whatever others are in its slice
    for _ in range(ROUNDS):
        weighted = p * np.repeat(shares, lengths, axis=0)
        weighted *= (count / weighted.sum(axis=1))[:, None]
        after = _sums(weighted, starts) / total[:, None]
        moved = np.abs(after - shares).max(axis=1)
        shares[moving] = after[moving]
        moving &= moved >= TOLERANCE
        if not moving.any():
            break
    level = (p * np.repeat(shares, lengths, axis=0)).sum(axis=1)
    return shares, _sums(count * np.log(np.maximum(level, 1e-30)), starts)


def gram_places(model: LanguageModel) -> np.ndarray:
    """The row of every possible trigram in the model's table."""
    place = np.full(CLASSES**3, len(model.grams), np.int32)
    place[model.grams] = np.arange(len(model.grams))
    return place


def document_mixtures(
    codes: np.ndarray, doc: np.ndarray, n: int, model: LanguageModel, place: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Language shares (documents by languages) and the share of known trigrams; zeros without trigrams."""
    shares = np.zeros((n, len(model.languages)), np.float32)
    known = np.zeros_like(shares)
    if not len(codes) or not len(model.languages):
        return shares, known
    width = len(model.grams) + 1
    keys = np.sort(doc.astype(np.int64) * width + place[codes])
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    count = np.diff(np.append(first, len(keys))).astype(np.float32)
    keys = keys[first]
    gram, owner = keys % width, keys // width
    here, starts, lengths = np.unique(owner, return_index=True, return_counts=True)
    p, total = model.probability[gram], _sums(count, starts)
    known[here] = _sums(model.seen[gram] * count[:, None], starts) / total[:, None]

    single = np.stack([_sums(count * np.log(p[:, k]), starts) for k in range(p.shape[1])], axis=1)
    chosen = np.zeros((len(here), p.shape[1]), np.float32)
    chosen[np.arange(len(here)), single.argmax(axis=1)] = 1
    best = single.max(axis=1)
    cost = PENALTY * np.log(total + 1)
    full, likelihood = _mixture(p, count, starts, lengths, np.ones_like(chosen))
    # no set does better than all languages together: most documents are settled here, the others once larger sets can't pay
    open_ = np.flatnonzero(likelihood - cost > best)
    order = np.argsort(-full, axis=1, kind="stable")
    for size in range(2, p.shape[1] + 1):
        open_ = open_[likelihood[open_] - (size - 1) * cost[open_] > best[open_]]
        if not len(open_):
            break
        pick, lens = np.concatenate([np.arange(starts[d], starts[d] + lengths[d]) for d in open_]), lengths[open_]
        few = order[open_, :size]
        # only the set's own languages are looked at
        held = p[pick[:, None], np.repeat(few, lens, axis=0)]
        at = np.concatenate(([0], np.cumsum(lens)[:-1]))
        part, gained = _mixture(held, count[pick], at, lens, np.ones(few.shape, np.float32))
        gained -= (size - 1) * cost[open_]
        better = gained > best[open_]
        won = open_[better]
        best[won], chosen[won] = gained[better], 0
        chosen[won[:, None], few[better]] = part[better]
    shares[here] = chosen
    return shares, known


def explained_shares(
    codes: np.ndarray, doc: np.ndarray, shares: np.ndarray, model: LanguageModel, place: np.ndarray
) -> np.ndarray:
    """The share of each document's trigrams that any language of its mixture knows."""
    total, held = np.zeros(len(shares)), np.zeros(len(shares))
    if len(codes) and len(model.languages):
        rows, mixed = place[codes], shares > 0
        hit = np.zeros(len(codes), bool)
        for k in range(len(model.languages)):
            hit |= model.seen[rows, k] & mixed[doc, k]
        total, held = np.bincount(doc, minlength=len(shares)), np.bincount(doc, hit, len(shares))
    return held / np.maximum(total, 1)


def identify_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, text_hash, lang_pred, score, mixture, explained`` for each row.

    Mixture is ``language:share`` by share, explained the share of trigrams that any of these languages knows.
    """
    # plain arrays: tasks need no installed copy of this package to read them
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.grams, model.probability, model.seen))
    columns = ["doc_id", "text_hash", "lang_pred", "score", "mixture", "explained"]

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel(*shared.value)
        place = gram_places(model)
        for batch in batches:
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            for low, high, data, bounds in slices(batch.column("text")):
                codes, doc = trigram_codes(data, bounds)
                shares, known = document_mixtures(codes, doc, high - low, model, place)
                explained = explained_shares(codes, doc, shares, model, place)
                langs, scores, mixtures = [], [], []
                for i in range(high - low):
                    if not letters[low + i] or not shares[i].any():
                        langs.append("und"), scores.append(0.0), mixtures.append("")
                        continue
                    order = np.argsort(-shares[i], kind="stable")
                    langs.append(model.languages[order[0]])
                    scores.append(min(1.0, float(shares[i, order[0]] * known[i, order[0]])))
                    mixtures.append(",".join(f"{model.languages[k]}:{shares[i, k]:.3f}" for k in order if shares[i, k] >= 5e-4))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), batch.column("text_hash").slice(low, high - low),
                     pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(mixtures, pa.string()),
                     pa.array(explained, pa.float64())],
                    columns,
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.regexp("text", F.lit(r"\p{L}")), F.lit(False)).alias("letters"),
    )
    return rows.mapInArrow(identify, "doc_id long, text_hash long, lang_pred string, score double, mixture string, explained double")
