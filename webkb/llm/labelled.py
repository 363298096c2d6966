"""Bounded sample of labelled rows that the learned operators are fitted on."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: int,
           most_bytes: int, seed: int = 42) -> tuple[pd.DataFrame, float]:
    """At most ``rows`` rows of each label among the labelled documents for
    which ``train`` (over doc_id) holds: ``text`` (bytes) and ``label`` 0/1, in
    a seeded order that does not depend on partitions; and the odds of label 1
    among all labelled rows to train on.

    Texts of at most ``most_bytes`` bytes come first. Only where a label has
    fewer than ``rows`` of them do longer texts follow, by their first
    ``most_bytes`` bytes, so no label that has documents is without a row.
    The ids are chosen on narrow columns; only the chosen texts,
    ``2 * rows * most_bytes`` bytes at most, come to the driver.
    """
    spark = docs.sparkSession
    known = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & train)
             .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
             .filter("label = other").select("doc_id", "label"))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    is_long = (F.octet_length(F.coalesce("text", F.lit(""))) > most_bytes).alias("long")
    there = known.join(docs.select("doc_id", is_long).groupBy("doc_id").agg(F.min("long").alias("long")), "doc_id")
    ids = [r for v in (0, 1) for r in
           there.filter(F.col("label") == v).orderBy("long", order, "doc_id").limit(rows).collect()]
    if not ids:
        return pd.DataFrame({"text": [], "label": []}), 1.0
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    odds = (counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5)
    chosen = spark.createDataFrame([(r["doc_id"], r["label"]) for r in ids], "doc_id long, label int")
    texts = (docs.select("doc_id", "text", is_long).join(F.broadcast(chosen), "doc_id")
             .select("doc_id", "label", "long", F.substring(F.encode("text", "UTF-8"), 1, most_bytes).alias("text"))
             .withColumn("order", order).withColumn("hash", F.xxhash64("text")))
    got = [r for v in (0, 1) for r in
           texts.filter(F.col("label") == v).orderBy("long", "order", "doc_id", "hash").limit(rows).collect()]
    return pd.DataFrame({"text": [bytes(r["text"] or b"") for r in got], "label": [r["label"] for r in got]}), odds
