"""Filter interaction audit: which filter removes what, in every order.

Each text is measured in one pass of a table-driven byte transducer. Its class
table names the kind of every UTF-8 byte, its transition table the state after
it (in a gap or in a word), and its output table what the byte counts for: a
code point, a capital, a symbol, the first byte of a word or the first after
one. The next state depends on the byte's class alone, so the pass runs over a
whole slice of texts as three table lookups. The word spans it finds go into
an open-addressed hash table in the same step; a slot's span is compared byte
by byte with the one that meets it, so a hash collision costs a probe and never
a word.

What a document fails is a set of filters. Documents are aggregated by it, so
that all orders of the filters are answered from at most 32 counts per part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webkb.llm.common import cut, slices

#: The filters, in the order of their bits: few words, repeated words, many capitals, symbols, an earlier copy.
FILTERS = "ABCDE"
SYMBOLS = b"#$%&*|"
#: Byte classes and states of the transducer.
SPACE, PLAIN, CAPITAL, SYMBOL, INNER = range(5)
GAP, WORD = range(2)
#: What a byte counts for.
STARTS, ENDS, POINT, UPPER, SIGN = 1, 2, 4, 8, 16
#: Words of more bytes than this are hashed and compared one by one.
LONG = 64
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.full(256, PLAIN, np.uint8)
    kind[[0x20, *range(0x09, 0x0E)]] = SPACE
    kind[ord("A"):ord("Z") + 1] = CAPITAL
    kind[list(SYMBOLS)] = SYMBOL
    kind[0x80:0xC0] = INNER  # a byte inside a code point
    after = np.full((2, 8), WORD, np.uint8)
    after[:, SPACE] = GAP
    out = np.zeros((2, 8), np.uint8)
    out[:, [SPACE, PLAIN, CAPITAL, SYMBOL]] |= POINT
    out[:, CAPITAL] |= UPPER
    out[:, SYMBOL] |= SIGN
    out[GAP, [PLAIN, CAPITAL, SYMBOL, INNER]] |= STARTS
    out[WORD, SPACE] |= ENDS
    return kind, after, out


CLASS, AFTER, OUTPUT = _tables()


def transduce(data: np.ndarray) -> np.ndarray:
    """The outputs of all bytes of ``data``, which starts in a gap."""
    kind = CLASS[data]
    # both rows of the transition table are equal: the state after a byte is known from the byte
    state = AFTER[GAP][kind]
    before = np.concatenate([[np.uint8(GAP)], state[:-1]])
    return OUTPUT.ravel()[before << 3 | kind]


class Spans:
    """Word spans of a buffer, hashed and compared in steps of eight bytes."""

    def __init__(self, data: bytes, start: np.ndarray, end: np.ndarray, doc: np.ndarray):
        self.data, self.start, self.size, self.doc = data, start, end - start, doc
        padded = np.frombuffer(data + bytes(8), np.uint8)
        self.eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
        self.head = self.step(np.arange(len(start)), 0)

    def step(self, at: np.ndarray, offset: int) -> np.ndarray:
        """The eight bytes of each span from ``offset`` on, zero beyond its end."""
        return self.eights[self.start[at] + offset] & _LOW_BYTES[np.minimum(self.size[at] - offset, 8)]

    def hashes(self) -> np.ndarray:
        mix = np.uint64(0x9E3779B97F4A7C15)
        out = (self.head ^ self.size.astype(np.uint64)) * mix
        for offset in range(8, LONG, 8):
            at = np.flatnonzero((self.size > offset) & (self.size <= LONG))
            if not len(at):
                break
            out[at] = (out[at] ^ (out[at] >> np.uint64(29)) ^ self.step(at, offset)) * mix
        for i in np.flatnonzero(self.size > LONG):
            out[i] = xxhash.xxh64_intdigest(self.data[self.start[i]:self.start[i] + self.size[i]])
        out = (out ^ (out >> np.uint64(32)) ^ self.doc.astype(np.uint64)) * mix
        return out ^ (out >> np.uint64(29))

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans are of the same document and equal in every byte."""
        out = (self.doc[a] == self.doc[b]) & (self.size[a] == self.size[b]) & (self.head[a] == self.head[b])
        for offset in range(8, LONG, 8):
            at = np.flatnonzero(out & (self.size[a] > offset) & (self.size[a] <= LONG))
            if not len(at):
                break
            out[at] = self.step(a[at], offset) == self.step(b[at], offset)
        for i in np.flatnonzero(out & (self.size[a] > LONG) & (a != b)):
            s, t, n = self.start[a[i]], self.start[b[i]], self.size[a[i]]
            out[i] = self.data[s:s + n] == self.data[t:t + n]
        return out

    def distinct(self) -> np.ndarray:
        """The spans that own a slot of the table: one per distinct word of a document."""
        n = len(self.start)
        bits = max(3, int(2 * n).bit_length())
        table = np.full(1 << bits, -1, np.int64)
        slot = (self.hashes() >> np.uint64(64 - bits)).astype(np.int64)
        left, owners = np.arange(n), []
        while len(left):
            here = slot[left]
            free = table[here] < 0
            table[here[free]] = left[free]  # of several, one stays
            owner = table[here]
            own = owner == left
            owners.append(left[own])
            left, owner = left[~own], owner[~own]
            left = left[~self.same(owner, left)]
            slot[left] = (slot[left] + 1) & ((1 << bits) - 1)
        return np.concatenate(owners) if owners else np.zeros(0, np.int64)


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Per text: ``words, distinct, capitals, points, symbols``."""
    # a separator after each text ends its last word
    data = b" ".join([*texts, b""])
    end = np.cumsum([len(t) + 1 for t in texts])
    out = transduce(np.frombuffer(data, np.uint8))

    def per_text(places: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(places, end), prepend=0)

    start = np.flatnonzero(out & STARTS)
    spans = Spans(data, start, np.flatnonzero(out & ENDS), np.searchsorted(end, start, "right"))
    found = spans.distinct()
    return {"words": per_text(start), "distinct": np.bincount(spans.doc[found], minlength=len(texts)),
            "capitals": per_text(np.flatnonzero(out & UPPER)), "points": per_text(np.flatnonzero(out & POINT)) - 1,
            "symbols": per_text(np.flatnonzero(out & SIGN))}


def measured(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): ``doc_id, source``,
    the counts of :func:`measure` and ``digest``, the text's SHA-256."""
    names = ["words", "distinct", "capitals", "points", "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            counts = measure(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), *(pa.array(counts[c], pa.int64()) for c in names),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                names=["doc_id", "source", *names, "digest"])

    return docs.select("doc_id", "source", "text").mapInArrow(
        run, "doc_id long, source string, " + ", ".join(f"{c} long" for c in names) + ", digest binary")


def own_failures() -> Column:
    """Bits of the filters a text fails by itself, from its counts."""
    fails = [F.col("words") < 200, 100 * F.col("distinct") < 50 * F.col("words"),
             100 * F.col("capitals") > 2 * F.col("points"), F.col("symbols") > 0]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def failure_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by what they fail: ``part, fails`` (bits of ``FILTERS``), and
    how many there are (``docs``), of quality 1 (``good``) and ``toxic``.

    Whether a document is a copy of an earlier one depends only on the smallest
    doc_id of its text, so rows are aggregated by text, part and labels before
    copies meet: a text that makes up a third of the corpus is a few rows.
    """
    rows = (measured(docs).select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "digest", own_failures().alias("fails"))
            .groupBy("doc_id", "part", "digest", "fails").agg(F.count("*").alias("n")))
    marks = labels.groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1)).alias("good"),
                                         F.max(F.when(F.col("toxic") == 1, 1)).alias("toxic"))
    marked = rows.join(marks, "doc_id", "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    # the smallest doc_id of a group and how many rows bear it; rows without one are never copies
    groups = marked.groupBy("digest", "part", "fails", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"))
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    firsts = F.col("unnamed") + F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(0)
    copy = F.lit(1 << FILTERS.index("E"))
    split = F.array(F.struct("fails", F.col("firsts").alias("n")),
                    F.struct((F.col("fails") + copy).alias("fails"), (F.col("n") - F.col("firsts")).alias("n")))
    return (groups.withColumn("firsts", firsts).select("part", "good", "toxic", F.explode(split).alias("s"))
            .groupBy("part", "s.fails").agg(
                F.sum("s.n").alias("docs"), F.sum(F.col("s.n") * F.col("good")).alias("good"),
                F.sum(F.col("s.n") * F.col("toxic")).alias("toxic")))


def interactions(sets: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``sets`` (part, fails, docs, good, toxic) to one row per part, order of
    ``filters`` and step, zeros included: see :func:`audit`.

    Sent to the sets is a table of fixed size: every order, step and set of
    failures (19,200 rows for five filters). A filter's removals, summed over
    all orders, count a document in those where it is the first of its
    failures: one in as many as it has failures.
    """
    orders = list(permutations(range(len(filters))))
    rows = [("".join(filters[i] for i in order), step + 1, fails, not fails & before, not fails & before and fails & here > 0,
             bool(fails & before and fails & here), fails == here, len(orders) // fails.bit_count() if fails & here else 0)
            for order in orders for step in range(len(order))
            for before, here in [(sum(1 << i for i in order[:step]), 1 << order[step])]
            for fails in range(1 << len(filters))]
    table = sets.sparkSession.createDataFrame(
        [(name, step, fails, int(clean and not gone), int(gone), int(late), int(alone), orders_first)
         for name, step, fails, clean, gone, late, alone, orders_first in rows],
        "filter_order string, step int, of int, stays int, goes int, late int, alone int, first_in int")
    total = lambda what, sign: F.sum(F.col(what) * F.col(sign)).cast("long")
    return sets.join(F.broadcast(table), F.col("fails") == F.col("of")).groupBy("part", "filter_order", "step").agg(
        total("docs", "stays").alias("kept"), total("docs", "goes").alias("removed"),
        total("docs", "late").alias("redundant"), total("docs", "alone").alias("unique_fails"),
        total("good", "goes").alias("good_lost"), total("toxic", "goes").alias("toxic_lost"),
        total("docs", "first_in").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per source of ``docs`` (doc_id, source, text), order of the five
    filters and step: ``part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``, counts of documents.

    A NULL text is the empty text: it fails A, and E if another empty text has
    a smaller doc_id. A NULL source is the part of the empty string. Rows
    without a doc_id are counted and are neither copies nor make others copies;
    rows that repeat a doc_id are counted each, and the smallest doc_id's rows
    of a text are all firsts. A document with several labels is good (toxic) if
    one of them says so. An empty table gives an empty result; other columns
    are not read. A task holds some thirty times its longest text.
    """
    return interactions(cut(failure_sets(docs, labels), "audit-sets"))
