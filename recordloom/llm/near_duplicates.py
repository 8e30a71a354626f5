"""Near duplicates: fast similarity sketches, banding, and exact verification on whole sets.

Documents with equal shingle sets form one class first, whatever their number. Classes that share
a band of their sketches are candidates. Each bucket checks its members against one pivot; what is
linked then forms components, and only members of *different* components of a bucket are compared
further, in blocks of bounded size that spread over tasks. So a bucket of near copies costs about
one comparison a member, no link between different texts is lost for it, and no task gets a bucket
whole. Every link is confirmed on the full sets.

Rows with null or blank text have no shingles and stay alone. A null ``doc_id`` never becomes a
component id while the component has another; a component of null ids keeps all its rows. Repeated
rows get the same result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.arrow_text import slices
from recordloom.llm.hash_bits import hash_bits, split_by_bits
from recordloom.llm.sketching import band_keys, fast_sketches, set_digest, shingle_sets
from recordloom.session import stage

#: 24 bands of 4 coordinates: a pair of similarity 0.85 shares none with a chance of 2e-8. Below 0.85 there are
#: 32 bands, which a pair of similarity 0.8 misses with 5e-8; ``fast_sketches`` orders at most 128 coordinates.
BANDS, WIDE_BANDS, ROWS = 24, 32, 4
#: Agreeing coordinates below this share rule a pair out: at a similarity of 0.85 the Chernoff bound
#: for so few of 96 is 2.3e-8; at 0.8 and more the bound is chosen anew by ``_least_agreement``.
MISS = 3e-8
BLOCK_MEMBERS = 256


def _bands(percent: int) -> int:
    return BANDS if percent >= 85 else WIDE_BANDS


def _least_agreement(similarity: float, size: int) -> int:
    """The most coordinates that may be asked for while a linked pair fails with at most ``MISS``."""
    for agree in range(int(size * similarity), 0, -1):
        p = agree / size
        bound = p * np.log(p / similarity) + (1 - p) * np.log((1 - p) / (1 - similarity)) if p < 1 else 0
        if np.exp(-size * bound) <= MISS and p < similarity:
            return agree
    return 0


def _linked(common: int, left: int, right: int, percent: int) -> bool:
    return 100 * common >= percent * (left + right - common)


def sketch_documents(docs: DataFrame, width: int = 5, bands: int = BANDS) -> DataFrame:
    """One row per document: id, text hash, shingle count, set digest, sketch bytes, band keys."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in slices(batch.column("text")):
                sets = shingle_sets(data, bounds, width)
                coordinates = fast_sketches(sets, bands * ROWS)
                keys = band_keys(coordinates, ROWS).view(np.int64)
                small = (coordinates & np.uint64(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        batch.column("text_hash").slice(low, high - low),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_digest(s) for s in sets], pa.binary()),
                        pa.array([row.tobytes() for row in small], pa.binary()),
                        pa.array(list(keys), pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_hash", "n", "node", "sketch", "keys"],
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return narrow.mapInArrow(
        sketch, "doc_id long, text_hash long, n long, node binary, sketch binary, keys array<long>"
    )


def _sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """The full shingle sets of candidate classes, computed from the text of one owner each."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in slices(batch.column("text")):
                items = [s.tobytes() for s in shingle_sets(data, bounds, width)]
                rest = [batch.column(c).slice(low, high - low) for c in ("node", "n", "sketch", "keys")]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(items, pa.binary())], ["node", "n", "sketch", "keys", "items"]
                )

    texts = docs.select(
        F.col("doc_id").cast("long").alias("owner_id"), F.xxhash64("text").alias("owner_text"), "text"
    )
    # most texts own no candidate class and are left where they are
    texts, _ = split_by_bits(texts, F.col("owner_text"), hash_bits(nodes, "text_hash"))
    # null-safe on the id: a null id may own a class
    owned = texts.join(
        nodes.hint("shuffle_hash"),
        (texts["owner_text"] == nodes["text_hash"]) & texts["owner_id"].eqNullSafe(nodes["doc_id"]),
    )
    columns = "node binary, n long, sketch binary, keys array<long>, items binary"
    return owned.select("node", "n", "sketch", "keys", "text").mapInArrow(shingle, columns).dropDuplicates(["node"])


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = [batch.column(c).to_pylist() for c in ("items_a", "items_b")]
            for row, (left, right) in enumerate(zip(*columns)):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if _linked(common, len(x), len(y), percent):
                    keep.append(row)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    side = lambda s: sets.select(F.col("node").alias(s), F.col("items").alias(f"items_{s}"))
    full = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "items_a", "items_b")
    return full.mapInArrow(confirm, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` of all linked nodes; equal labels mark a component.

    Smallest labels spread along the links, and each label then takes the label of the node it
    names, so chains shorten by half in a round. Every round is a written table.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct()
    edges = stage(both, "edges")
    labels = stage(
        edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select(
            "node", F.least("node", "near").alias("label"), F.lit(True).alias("moved")
        ),
        "labels",
    )
    while labels.filter("moved").limit(1).count():
        plain = labels.select("node", "label")
        heard = (
            edges.join(plain.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        )
        spread = plain.join(heard, "node").select("node", "label", F.least("label", "heard").alias("next"))
        named = plain.select(F.col("node").alias("next"), F.col("label").alias("jump"))
        labels = stage(
            spread.join(named, "next").select(
                "node", F.least("next", "jump").alias("after"), "label"
            ).select("node", F.col("after").alias("label"), (F.col("after") != F.col("label")).alias("moved")),
            "labels",
        )
    return labels.select("node", "label")


def _contested_links(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of a bucket that are in different components after the pivots.

    The largest component of a bucket and the rest are cut into blocks of about
    ``BLOCK_MEMBERS``; rest against rest and rest against the largest are compared, never the
    largest with itself.
    """
    least = _least_agreement(percent / 100, _bands(percent) * ROWS)

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        size = block["n"].to_numpy()
        sketch = np.stack([np.frombuffer(x, np.uint8) for x in block["sketch"]])
        keys = np.stack(block["keys"].to_list())
        items = [np.frombuffer(x, np.uint64) for x in block["items"]]
        names, label = np.unique(block["label"].to_numpy(), return_inverse=True)
        first, key = block["left"].to_numpy(), block["key"].iloc[0]
        same = bool(block["same"].iloc[0])
        node, found = block["node"].to_list(), []
        for i in np.flatnonzero(first):
            others = np.arange(i + 1, len(block)) if same else np.flatnonzero(~first)
            others = others[
                (label[others] != label[i])
                & (100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i]))
            ]
            others = others[(sketch[others] == sketch[i]).sum(axis=1) >= least]
            equal = keys[others] == keys[i]
            # a pair that shares several buckets is compared in the first one only
            others = others[keys[i][equal.argmax(axis=1)] == key]
            for j in others:
                if label[j] != label[i]:
                    common = len(np.intersect1d(items[i], items[j], assume_unique=True))
                    if _linked(common, len(items[i]), len(items[j]), percent):
                        found.append((node[i], node[j]))
                        label[label == label[j]] = label[i]
        return pd.DataFrame(found, columns=["a", "b"])

    known = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    known = stage(known.select("key", "node", "label"), "members")
    counted = known.groupBy("key", "label").agg(F.count("*").alias("c"))
    split = (
        counted.groupBy("key")
        .agg(F.sum("c").alias("all"), F.count("*").alias("parts"), F.max(F.struct("c", "label")).alias("main"))
        .filter("parts > 1 AND all > 2")
        .select(
            F.col("key"),
            F.col("main.label").alias("main"),
            F.ceil(F.col("main.c") / BLOCK_MEMBERS).cast("int").alias("main_blocks"),
            F.ceil((F.col("all") - F.col("main.c")) / BLOCK_MEMBERS).cast("int").alias("rest_blocks"),
        )
    )
    split = stage(split, "contested")
    rows = known.join(split, "key").withColumn("is_main", F.col("label") == F.col("main"))
    blocks = F.when(F.col("is_main"), F.col("main_blocks")).otherwise(F.col("rest_blocks"))
    rows = rows.withColumn("own", F.pmod(F.hash("node"), blocks))
    numbers = lambda count: F.sequence(F.lit(0), F.col(count) - 1)
    with_main = F.transform(
        numbers("main_blocks"),
        lambda j: F.struct(F.col("own").alias("i"), j.alias("j"), F.lit(False).alias("same"), F.lit(True).alias("left"), F.lit(True).alias("cross")),
    )
    with_rest = F.transform(
        numbers("rest_blocks"),
        lambda j: F.struct(
            F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j"),
            (F.col("own") == j).alias("same"), (F.col("own") <= j).alias("left"), F.lit(False).alias("cross"),
        ),
    )
    of_main = F.transform(
        numbers("rest_blocks"),
        lambda i: F.struct(i.alias("i"), F.col("own").alias("j"), F.lit(False).alias("same"), F.lit(False).alias("left"), F.lit(True).alias("cross")),
    )
    tasks = F.when(F.col("is_main"), of_main).otherwise(F.concat(with_main, with_rest))
    placed = rows.select("key", "node", "label", F.inline(tasks))
    full = placed.join(sets, "node")
    return full.groupBy("key", "cross", "i", "j").applyInPandas(compare, "a binary, b binary")


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = 5) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept`` for each row of ``docs``.

    Two documents are linked if ``100 * intersection >= percent * union`` of their sets.
    """
    if not 80 <= percent <= 100:
        raise ValueError("the bands are laid out for similarities of 80 percent and more")
    rows = stage(sketch_documents(docs, width, _bands(percent)), "sketches")
    classes = stage(
        rows.filter("n > 0").groupBy("node").agg(
            F.min("doc_id").alias("least_id"),
            F.min(F.struct("doc_id", "text_hash")).alias("owner"),
            F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("keys").alias("keys"),
        ),
        "classes",
    )
    banded = classes.select("node", "n", F.explode("keys").alias("key"))
    shared = stage(banded.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key"), "buckets")
    members = stage(banded.join(shared, "key"), "members")
    candidates = stage(members.select("node").distinct(), "candidates")
    nodes = candidates.join(classes, "node").select("node", "n", "sketch", "keys", "owner.doc_id", "owner.text_hash")
    sets = stage(_sets(docs, nodes, width), "sets")

    pivots = stage(
        members.groupBy("key").agg(F.min(F.struct(F.hash("node", "key").alias("h"), "node", "n")).alias("p")).select(
            "key", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n")
        ),
        "pivots",
    )
    pairs = (
        members.join(pivots, "key")
        .filter("node != pivot AND 100 * least(n, pivot_n) >= " f"{percent} * greatest(n, pivot_n)")
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        .distinct()
    )
    links = stage(_verify(stage(pairs, "pairs"), sets, percent), "links")
    first = components(links)
    more = stage(_contested_links(members, first, sets, percent), "links")
    labels = components(first.select(F.col("node").alias("a"), F.col("label").alias("b")).filter("a != b").union(more))

    named = stage(classes.select("node", "least_id").join(labels, "node", "left"), "named")
    least = named.filter("label IS NOT NULL").groupBy("label").agg(F.min("least_id").alias("of_label"))
    final = stage(
        named.join(stage(least, "least"), "label", "left").select(
            "node", F.when(F.col("label").isNull(), F.col("least_id")).otherwise(F.col("of_label")).alias("component_id")
        ),
        "components",
    )
    blank = rows.filter("n = 0").withColumn("component_id", F.col("doc_id"))
    worded = rows.filter("n > 0").join(final, "node")
    columns = ["doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id"]
    return blank.select(columns).union(worded.select(columns)).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
