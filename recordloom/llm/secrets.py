"""Secret scans over a trigram inverted index, with DataFrame functions only.

From every rule's regex follows a Boolean query over trigrams. The index holds postings for the trigrams
that the queries name, (trigram, text key), so its size follows the rules and not the alphabet; intersecting
the postings of a text gives the rules whose matches it may hold, and only those regexes
run on it. A rule without mandatory trigrams runs on every text. The text key is a 64-bit hash: should two texts
share one, both are candidates of either's rules, and verification stays exact.

Spans count code points, the end is exclusive. A null text is empty. Repeated rows give repeated results. Other columns
pass through ``find_secrets`` untouched, except one of the result's name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.trigram_queries import Query, trigram_query, trigrams
from recordloom.llm.hash_bits import hash_bits, split_by_bits
from recordloom.session import stage


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters are secrets.

    ``fast`` finds the same passing matches in one pass, where such a pattern exists.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    fast: str | None = None


#: Fixed patterns, in the order of their kinds; the first three are the base rules.
RULES = (
    Rule(
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]+", 0, 16, r"(?<![0-9a-f])[0-9a-f]{16,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
BASE_KINDS = ("assign", "access", "hex")
_WORD_BITS = 62
_SPAN = "struct<start:int,place:int,end:int>"


def _holds(query: Query, number: dict[str, int]) -> Column:
    """The query as a condition on the bit words of a text's trigrams."""
    if query is True:
        return F.lit(True)
    if isinstance(query, str):
        at = number[query]
        bit = F.lit(1 << at % _WORD_BITS).cast("long")
        return F.col(f"_s_bits{at // _WORD_BITS}").bitwiseAND(bit) != 0
    parts = [_holds(q, number) for q in query[1:]]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole & part if query[0] == "and" else whole | part
    return whole


def index_texts(docs: DataFrame, names: Sequence[str]) -> DataFrame:
    """Postings ``(trigram, text_key)`` of the named trigrams, each written sorted within its part."""
    lowered = docs.select(F.xxhash64("text").alias("text_key"), F.lower("text").alias("low"))
    held = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(names)])
    postings = lowered.select("text_key", F.explode(F.array_compact(held)).alias("trigram"))
    return stage(postings.select("trigram", "text_key").sortWithinPartitions("trigram", "text_key"), "postings")


def candidate_texts(postings: DataFrame, queries: dict[int, Query], names: Sequence[str]) -> DataFrame:
    """``(text_key, rules)``: a bit for each rule whose query the postings of a text satisfy."""
    number = {t: i for i, t in enumerate(names)}
    words = range((len(names) + _WORD_BITS - 1) // _WORD_BITS)
    bits = [
        F.bit_or(
            F.when((F.col("trigram") >= w * _WORD_BITS) & (F.col("trigram") < (w + 1) * _WORD_BITS),
                   F.expr(f"shiftleft(1L, trigram - {w * _WORD_BITS})")).otherwise(F.lit(0).cast("long"))
        ).alias(f"_s_bits{w}")
        for w in words
    ]
    met = postings.groupBy("text_key").agg(*bits)
    rules = F.lit(0).cast("long")
    for place, query in queries.items():
        rules = rules.bitwiseOR(F.when(_holds(query, number), F.lit(1 << place).cast("long")).otherwise(F.lit(0).cast("long")))
    return stage(met.select("text_key", rules.alias("rules")).filter("rules != 0"), "candidates")


def _spans(rule: Rule, place: int, text: str) -> Column:
    """The passing matches of a rule in column ``text``.

    Gaps and matches take turns in a text, so their lengths add up to the positions.
    """
    pattern = F.lit(rule.fast or rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, pattern.cast("string"), -1)
    parts = [matches.alias("m"), gaps.alias("g")]
    if rule.fast or not rule.least:
        parts.append(matches.alias("v"))
    else:
        parts.append(F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("v"))
    least = 0 if rule.fast else rule.least

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["g"])
        end = start + F.length(piece["m"])
        span = F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end"))
        passes = piece["m"].isNotNull() & (F.length(piece["v"]) >= least)
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(passes, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    empty = F.array().cast(f"array<{_SPAN}>")
    folded = F.aggregate(
        F.arrays_zip(*parts), F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda state: state["spans"]
    )
    return F.when(F.regexp(text, pattern), folded).otherwise(empty)


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, result: str = "secret_spans") -> DataFrame:
    """``docs`` with ``result``: ``(start, place, end)`` by start and rule, ``place`` counting rules from 0."""
    queries = {i: trigram_query(rule.pattern) for i, rule in enumerate(rules)}
    full = [i for i, query in queries.items() if query is True]
    queries = {i: query for i, query in queries.items() if query is not True}
    if len(rules) > _WORD_BITS:
        raise ValueError(f"at most {_WORD_BITS} rules in one scan")
    text, key, due_rules = (fresh_name(docs, name) for name in ("_text", "_key", "_rules"))
    rows = docs.withColumn(text, F.coalesce(F.col("text"), F.lit("")))
    if queries:
        names = sorted(set().union(*map(trigrams, queries.values())))
        found = candidate_texts(index_texts(docs, names), queries, names)
        found = found.select(F.col("text_key").alias(key), F.col("rules").alias(due_rules))
        # texts that can't be candidates aren't shuffled
        maybe, sure = split_by_bits(rows, F.xxhash64("text"), hash_bits(found, key))
        maybe = maybe.join(found.hint("shuffle_hash"), F.xxhash64("text") == F.col(key), "left").drop(key)
        rows = maybe.union(sure.withColumn(due_rules, F.lit(None).cast("long")))
    else:
        rows = rows.withColumn(due_rules, F.lit(None).cast("long"))
    empty = F.array().cast(f"array<{_SPAN}>")
    parts = []
    for i, rule in enumerate(rules):
        due = F.coalesce(F.col(due_rules), F.lit(0).cast("long")).bitwiseAND(F.lit(1 << i).cast("long")) != 0
        spans = _spans(rule, i, text)
        parts.append(spans if i in full else F.when(due, spans).otherwise(empty))
    return rows.withColumn(result, F.array_sort(F.concat(*parts))).drop(text, due_rules)


def fresh_name(docs: DataFrame, name: str) -> str:
    """``name``, longer by underscores if ``docs`` has such a column."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def span_text(spans: Column, rules: Sequence[Rule] = RULES) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["place"] + 1), s["start"], s["end"])), ","
    )


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each run of overlapping spans replaced by ``mark``."""

    def step(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        kept = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], kept, F.lit(mark))).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        spans, start, step, lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)
