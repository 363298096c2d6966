"""Order MinHash fingerprints, in DataFrame functions alone.

A text is the sequence of its ``K``-word k-mers. The t-th occurrence of a
k-mer is told apart from the others by its number t. Every numbered k-mer falls
by hash into one of ``SLOTS`` slots (one permutation, dealt to the slots); of
each slot the ``TUPLE`` k-mers with the smallest ranks are selected, put back
into text order and hashed together. Two texts agree in a slot only if they
share the same minimal k-mers in the same order, so the share of agreeing slots
falls with both substitutions and moves, as the edit distance grows.

Everything happens within a row: arrays of 64-bit numbers that pack hash and
position are sorted and cut into runs, so neither occurrence numbers nor
minima need a shuffle, and a long text costs O(n log n).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webkb.llm.common import SPACE

K = 3
SLOTS = 32  # five bits
TUPLE = 2
_POSITION = (1 << 32) - 1


def signature(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the signature of column ``text`` (not NULL), an
    array with one number per filled slot: slot in the top five bits, hash of
    the tuple below.

    Each step is a column of its own: within a lambda an expression would be
    evaluated per element.
    """
    at = lambda a, i: F.get(F.col(a), i)
    keep = [F.col(f"`{c}`") for c in rows.columns]
    words = F.transform(F.filter(F.split(F.col(text), SPACE), lambda w: w != ""), lambda w: F.xxhash64(w))
    rows = rows.select(*keep, words.alias("__words"))
    kmers = F.when(F.size("__words") > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("__words") - K, F.lit(0))),
        lambda i: F.xxhash64(*[at("__words", i + j) for j in range(K)]).bitwiseAND(~_POSITION)
        .bitwiseOR(i.cast("long"))))
    rows = rows.select(*keep, F.sort_array(F.coalesce(kmers, F.array().cast("array<long>"))).alias("__sorted"))
    # runs of equal k-mers, each in text order
    run = lambda x: F.shiftright(x, 32)
    starts = F.filter(F.transform("__sorted", lambda x, i: F.when(
        (i == 0) | (run(x) != run(at("__sorted", i - 1))), i).otherwise(-1)), lambda i: i >= 0)
    rows = rows.select(*keep, "__sorted", F.concat(starts, F.array(F.size("__sorted"))).alias("__starts"))
    numbered = F.flatten(F.transform(F.sequence(F.lit(0), F.size("__starts") - 2), lambda j: F.transform(
        F.slice("__sorted", at("__starts", j) + 1, at("__starts", j + 1) - at("__starts", j)),
        lambda x, t: F.shiftrightunsigned(F.shiftleft(F.xxhash64(run(x), t), 33), 1)
        .bitwiseOR(x.bitwiseAND(_POSITION)))))
    rows = rows.select(*keep, F.sort_array(F.when(F.size("__sorted") > 0, numbered).otherwise(
        F.array().cast("array<long>"))).alias("__ranked"))
    # slot: the top five bits of 63; the first TUPLE of each slot are its minima
    slot = lambda x: F.shiftright(x, 58)
    rows = rows.select(*keep, F.filter("__ranked", lambda x, i: (i < TUPLE) | (
        slot(x) != slot(at("__ranked", i - TUPLE)))).alias("__least"))
    firsts = F.filter(F.transform("__least", lambda x, i: F.when(
        (i == 0) | (slot(x) != slot(at("__least", i - 1))), i).otherwise(-1)), lambda i: i >= 0)
    rows = rows.select(*keep, "__least", F.concat(firsts, F.array(F.size("__least"))).alias("__firsts"))
    in_order = lambda j: F.transform(F.array_sort(F.transform(
        F.slice("__least", at("__firsts", j) + 1, at("__firsts", j + 1) - at("__firsts", j)),
        lambda x: F.struct(x.bitwiseAND(_POSITION).alias("place"), F.shiftright(x, 32).alias("kmer")))),
        lambda s: s["kmer"])
    tuples = F.transform(F.sequence(F.lit(0), F.size("__firsts") - 2), lambda j: F.shiftleft(
        slot(at("__least", at("__firsts", j))), 58).bitwiseOR(F.xxhash64(in_order(j)).bitwiseAND((1 << 58) - 1)))
    return rows.select(*keep, F.when(F.size("__least") > 0, tuples).otherwise(
        F.array().cast("array<long>")).alias(out))


def likeness(a: str, b: str) -> Column:
    """Share of agreeing slots among those that either text fills; 1 for two texts without words."""
    slots = lambda c: F.transform(c, lambda x: F.shiftright(x, 58))
    filled = F.size(F.array_union(slots(a), slots(b)))
    return F.when(filled == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / filled)


def printed(signature: str) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _ranged(docs: DataFrame, per_partition: int = 4) -> DataFrame:
    """``docs`` with ``range``, the number of the id range a row falls into,
    rising as the id falls (NULL ids: after the last), and ``hash`` of its
    text. Ranges hold about as many documents each, a few per shuffle
    partition so that they spread evenly; only their bounds come to the driver."""
    n = per_partition * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = 1 << max(n - 1, 1).bit_length()
    bounds = docs.agg(F.percentile_approx("doc_id", [i / steps for i in range(1, steps)], 10 * steps)).first()[0]
    rows = docs.withColumn("hash", F.xxhash64("text"))
    if not bounds:
        return rows.withColumn("range", F.lit(0))
    array = F.from_json(F.lit(str(bounds)), "array<bigint>")  # folded to a constant
    # binary search: how many bounds lie below the id
    below = F.aggregate(F.array(*[F.lit(steps >> i) for i in range(1, steps.bit_length())]), F.lit(0),
                        lambda low, step: F.when(F.get(array, low + step - 1) < F.col("doc_id"), low + step).otherwise(low))
    return rows.withColumn("range", F.when(F.col("doc_id").isNull(), steps).otherwise(steps - 1 - below))


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``signature``, ``next_text`` and
    ``next_signature`` of the next document in descending doc_id (NULL ids
    last, equal ids by the hash of their text; after the last the first).

    One shuffle by ranges of ids. The head of each range is found on narrow
    columns and handed to the range before it: a row per range."""
    ranged = _ranged(docs)
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("id"), "hash")
    heads = sorted((r["range"], r["h"]["id"], r["h"]["hash"]) for r in
                   ranged.groupBy("range").agg(F.min(key).alias("h")).collect()) if not docs.isEmpty() else []
    ranges = [h[0] for h in heads]
    handed = docs.sparkSession.createDataFrame(
        [(b, None if i is None else ~i, h) for b, (_, i, h) in zip(ranges[-1:] + ranges[:-1], heads)],
        "before int, head_id long, head_hash long")
    found = ranged.join(F.broadcast(handed), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("hash") == F.col("head_hash")))
    firsts = signature(found.groupBy("before").agg(F.min("text").alias("text")), "text", "signature").select(
        "before", F.struct("text", "signature").alias("first"))
    window = Window.partitionBy("range").orderBy(F.col("doc_id").desc_nulls_last(), "hash", "text")
    placed = signature(ranged, "text", "signature").withColumn(
        "after", F.lead(F.struct("text", "signature")).over(window))
    after = F.coalesce("after", "first")
    return placed.join(firsts, F.col("range") == F.col("before"), "left").select(
        "doc_id", "text", "signature", after["text"].alias("next_text"), after["signature"].alias("next_signature"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text is the text with its last floor(n_chars / 3) code points
    replaced by the first as many (or all) of the next document's. A NULL text
    is empty; texts without words have an empty fingerprint and are alike. The
    only row of a table is its own next. Repeated doc_ids are ordered by text;
    an empty table gives an empty result; other columns are not read.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    signed = with_next(texts)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    both = signature(signed.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"),
                                   "signature", "next_signature"), "edited", "edited_signature")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), printed("signature").alias("fingerprint"),
        printed("edited_signature").alias("edited_fingerprint"),
        likeness("signature", "edited_signature").alias("near_edited"),
        likeness("signature", "next_signature").alias("near_next"))
