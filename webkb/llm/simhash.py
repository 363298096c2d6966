"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius; two
fingerprints within the radius share a variant, and the fingerprints that
share a variant are within twice that half of each other. The variants are
shuffled, deduplicated and the colliding pairs verified by their bit distance.

Groups stay small whatever the data: equal fingerprints are one row before
anything is emitted, so a variant meets at most as many rows as its own ball
holds (65 for radius 2). Each row is linked to the smallest fingerprint of its
variant when the pair is within the radius, which joins exactly what all
pairs would: for an even radius every two rows of a variant are within it.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webkb.llm.common import cut, text_column, utf8
from webkb.llm.components import components

BITS = 64


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text (unsigned); a text without words has 0."""
    words = utf8(text).lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(len(words) - shingle + 1, 1)
    starts = [0]
    for w in words:
        starts.append(starts[-1] + len(w) + 1)
    span = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        top = min(n, at + (1 << 16))
        hashes = np.array([digest(joined[a:b - 1], seed) for a, b in
                           zip(starts[at:top], starts[at + span:top + span])], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in range(BITS) if 2 * counts[b] > n))


def fingerprint_column(shingle: int = 3, seed: int = 42):
    """The fingerprint as a signed long column of ``text``."""

    def signed(text: str | None) -> int:
        bits = fingerprint(text, shingle, seed)
        return bits - (1 << BITS) if bits >> (BITS - 1) else bits

    return text_column("long", lambda: signed)


def ball(half: int) -> list[int]:
    """Masks of at most ``half`` bits, as signed longs."""
    masks = [sum(1 << b for b in c) for k in range(half + 1) for c in combinations(range(BITS), k)]
    return [int(np.uint64(m).astype(np.int64)) for m in masks]


def links(fingerprints: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``(u, v)`` that join the distinct ``fp`` of ``fingerprints`` into
    the same groups as all pairs within ``radius`` bits would."""
    if radius % 2:
        raise ValueError("ball hashing from both ends needs an even radius")
    masks = F.array(*[F.lit(m) for m in ball(radius // 2)])
    variants = fingerprints.select("fp", F.explode(masks).alias("mask")).select(
        F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), "fp")
    least = F.min("fp").over(Window.partitionBy("variant"))
    pairs = variants.select("fp", least.alias("least")).filter("fp != least")
    return (pairs.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("least"))) <= radius)
            .select(F.col("fp").alias("u"), F.col("least").alias("v")).distinct())


def groups(prints: DataFrame, radius: int = 2) -> DataFrame:
    """``prints`` (doc_id, fp) to one row per distinct fingerprint:
    ``fp, component_id``, the smallest doc_id its links reach."""
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(firsts.select("fp"), radius), "simhash")
    nodes = firsts.join(roots, firsts.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = nodes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return nodes.join(ids, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id``, ``fingerprint``
    (16 hex digits) and ``component_id``.

    Two documents link if their fingerprints differ in at most ``radius``
    bits; ``component_id`` is the smallest doc_id reachable over links.
    A NULL or empty text, or one without words, has fingerprint zero and
    links like any other. Repeated rows stay, each with the same result; a
    NULL doc_id keeps its row and never is a component_id unless all ids of
    the component are NULL. An empty table gives an empty result; columns
    other than doc_id and text are not read.
    """
    prints = cut(docs.select("doc_id", fingerprint_column(shingle, seed).alias("fp")), "simhash-prints")
    found = cut(groups(prints, radius), "simhash-groups")
    return prints.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """The rows of ``docs``, all columns, less near-duplicates: of each group
    the row with the smallest doc_id stays (NULL after all others; among rows
    of that doc_id the one with the smallest content hash; of rows equal in
    every column, one)."""
    spare = "__fp", "__row"
    names = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select(*names, fingerprint_column(shingle, seed).alias(spare[0]),
                         F.xxhash64(*names).alias(spare[1]))
    prints = cut(marked.select("doc_id", F.col(spare[0]).alias("fp"), F.col(spare[1]).alias("row")), "simhash-prints")
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(firsts.select("fp"), radius), "simhash")
    rooted = prints.join(roots, prints.fp == roots.node, "left").select(
        "doc_id", "row", F.coalesce("root", "fp").alias("root"))
    # the smallest (id, row hash) of each group, NULL ids last, and how often it occurs
    counted = rooted.groupBy("root", "doc_id", "row").agg(F.count("*").alias("copies"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    keep = cut(counted.groupBy("root").agg(F.min(F.struct(order.alias("k"), "copies")).alias("m"))
               .select("root", F.col("m.k.doc_id").alias("keep_id"), F.col("m.k.row").alias("keep_row"),
                       F.col("m.copies").alias("copies")), "simhash-keep")
    lose = counted.join(keep.drop("copies"), "root").filter(
        ~(F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("row") == F.col("keep_row")))).select(
        F.col("doc_id").alias("__id"), F.col("row").alias("__hash"))
    same = marked["doc_id"].eqNullSafe(F.col("__id")) & (marked[spare[1]] == F.col("__hash"))
    kept = marked.join(lose, same, "left_anti")
    if not keep.filter("copies > 1").limit(1).count():
        return kept.select(*names)
    twice = keep.filter("copies > 1").select(F.col("keep_id").alias("__id"), F.col("keep_row").alias("__hash"))
    return kept.join(twice, same, "left_anti").select(*names).unionByName(
        kept.join(twice, same, "left_semi").select(*names).dropDuplicates())
