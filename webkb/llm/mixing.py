"""Mixing sources to target weights by capped water-filling.

Sources share a budget by weight; a source stops at ``max_epochs`` times its
own size, and the excess goes to the others in proportion to their weights
until none is above its stop. A document is then taken ``floor(epochs)`` times
whole and once more with the fractional part as its chance.

The fractional picks are drawn in salted groups of a source (about
``group_rows`` documents each, so a hot source is many groups). A group goes
through its documents from the longest to the shortest and lets each draw
make up for the draws before it: inclusion is seeded and random, yet the words
taken stay within a short document of the group's share.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webkb.llm.common import cut

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank``: 0, 1, ... by code point, NULL last.

    Ranked in parallel: rows are numbered within range partitions and the
    partitions' first numbers added; only one row per partition meets.
    """
    order = F.col("source").asc_nulls_last()
    local = cut(sources.repartitionByRange(order).sortWithinPartitions(order).select(
        "*", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")), "mix-sources")
    sizes = {r["part"]: r["n"] for r in local.groupBy("part").agg(F.count("*").alias("n")).collect()}
    first, offsets = 0, []
    for part in sorted(sizes):
        offsets.append((part, first))
        first += sizes[part]
    offset = local.sparkSession.createDataFrame(offsets, "part int, first long")
    return local.join(F.broadcast(offset), "part").withColumn("rank", F.col("first") + F.col("at")).drop(
        "part", "at", "first")


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """``sources`` (source_size, weight) with ``target``.

    The level is what one unit of weight receives. It only rises: each round
    clamps what the last level put above its stop and spreads the rest; two
    sums come to the driver per round.
    """
    stop = F.col("source_size") * F.lit(float(max_epochs))
    level, before = 0.0, None
    while level != before:
        above = stop < F.col("weight") * F.lit(level)
        clamped, weight = sources.agg(
            F.coalesce(F.sum(F.when(above, stop)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(above, 0).otherwise(F.col("weight"))), F.lit(0)).cast("double")).first()
        before, level = level, (budget - clamped) / weight if weight else float("inf")
        if not weight:
            break
    target = stop if level == float("inf") else F.least(F.col("weight") * F.lit(level), stop)
    return sources.withColumn("target", target.cast("double"))


def _pick(group: pd.DataFrame) -> pd.DataFrame:
    """``picked``, how many of the ``same`` equal documents of each row of one
    group are taken once more: seeded, and near the share."""
    group = group.sort_values(["size", "draw"], ascending=[False, True], kind="stable")
    picked, owed = [], 0.0
    for size, share, draw, same in zip(group["size"], group["share"], group["draw"], group["same"]):
        owed += share * size * same
        take = min(same, max(0, math.ceil(owed / size - draw))) if size > 0 else 0
        owed -= size * take
        picked.append(take)
    return group.assign(picked=np.array(picked, np.int64))[["doc_id", "row", "size", "source_size", "target",
                                                            "whole", "same", "picked"]]


def shares(docs: DataFrame, budget_share: float = 1.5, max_epochs: float = 2.0,
           weights: tuple[int, ...] = WEIGHTS, seed: int = 42, group_rows: int = 4096) -> DataFrame:
    """``docs`` (doc_id, row, source, size) to ``doc_id, row, size,
    source_size, target, copies``: how often the mix takes each document.

    A NULL source is a source of its own; sources without words have target 0.
    Draws depend on (doc_id, row, seed) alone, so reruns agree and equal rows
    are interchangeable: they are one row with a count while picks are drawn,
    however many there are. A NULL doc_id is an id like any other. An empty
    table gives an empty result.
    """
    sources = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = cut(ranked(sources).withColumn("weight", weight), "mix-ranked")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    filled = water_fill(sources, budget_share * total, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = cut(filled.select(
        F.col("source").alias("of"), "source_size", "target", F.floor(epochs).cast("long").alias("whole"),
        (epochs - F.floor(epochs)).alias("share"),
        F.greatest(F.lit(1), F.ceil(F.col("docs") / group_rows)).cast("long").alias("salts")), "mix-plan")
    bits = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("row"))
    distinct = docs.groupBy("doc_id", "row", "size", "source").agg(F.count("*").alias("same"))
    joined = distinct.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "row", "size", "same", "source", "source_size", "target", "whole", "share",
        F.pmod(bits, F.col("salts")).alias("salt"),
        (F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), F.col("doc_id"), F.col("row")), 11)
         / F.lit(float(1 << 53))).alias("draw"))
    picked = joined.groupBy("source", "salt").applyInPandas(
        _pick, "doc_id long, row long, size long, source_size long, target double, whole long, same long, picked long")
    # the first ``picked`` of the equal rows are taken once more
    every = picked.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("same"))))
    return every.withColumn("copies", F.col("whole") + (F.col("nth") <= F.col("picked")).cast("long")).drop(
        "whole", "same", "picked", "nth")


def mix(docs: DataFrame, **settings) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): ``doc_id, size,
    source_size, target, taken``; a NULL text has size 0."""
    narrow = cut(docs.select("doc_id", F.xxhash64("text").alias("row"), "source", n_words(F.col("text")).alias("size")),
                 "mix-sizes")
    return shares(narrow, **settings).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: ``docs``, all columns, each row as often as it is taken,
    with ``repetition`` 1, 2, ... Rows equal in every column are interchangeable."""
    names = [F.col(f"`{c}`") for c in docs.columns if c != "repetition"]
    marked = docs.select(*names, F.xxhash64(*names).alias("__row"))
    narrow = cut(marked.select("doc_id", F.col("__row").alias("row"), "source",
                               n_words(F.col("text")).alias("size")), "mix-sizes")
    taken = cut(shares(narrow, **settings).groupBy("doc_id", "row").agg(
        F.sum("copies").alias("__copies"), F.count("*").alias("__same"))
        .withColumnsRenamed({"doc_id": "__id", "row": "__hash"}), "mix-taken")
    rows = marked.join(taken, marked["doc_id"].eqNullSafe(taken["__id"]) & (marked["__row"] == taken["__hash"]))
    out = rows.filter("__same = 1")
    if taken.filter("__same > 1").limit(1).count():
        out = out.unionByName(rows.filter("__same > 1").dropDuplicates())
    return out.filter("__copies > 0").select(
        *names, F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))).alias("repetition"))
