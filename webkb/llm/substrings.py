"""Exact substring dedup with suffix automata of reference shards.

A window is ``window`` consecutive words of one document. A word goes if a
window that covers it also starts in a document with a smaller doc_id.

Streaming every document over the automaton of every shard of the corpus
would be quadratic. Both are therefore routed by content: each window belongs
to the smallest hash of its ``gram``-word grams (its anchor), so equal windows
have equal anchors, and only windows whose anchor occurs in two different
texts can repeat. Runs of consecutive windows with one anchor form a segment;
segments with the same anchor meet in one shard. The shard builds the suffix
automaton of its segments and streams them for matching statistics; windows
that reach the threshold learn the smallest doc_id that holds the same words.
Anchors only choose who meets: a hash collision costs work, never a result.

Hot groups: equal texts are one text with its smallest doc_id before any
segment is made, and equal segments are aggregated before the shuffle. An
anchor with more than ``hot`` segments, or with one of more than ``hot_words``
words (a long text of one repeated word is one segment),
is routed window by window (each window by its own hash), so its windows
spread over all shards and equal ones collapse map-side. A shard holds blocks
of at most ``block_words`` words plus one group of at most ``hot`` segments,
which have 84 words at most unless their text repeats itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webkb.llm.automaton import SuffixAutomaton
from webkb.llm.common import PIECE_BYTES, cut, drop_cut, slices, text_key, utf8

#: Rank of a NULL doc_id: after every other, and never smaller than itself.
LAST = (1 << 63) - 1
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Ids(dict):
    """Hash per word, kept for the words of a bounded number of texts."""

    most = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(29)
    x *= _B
    x ^= x >> np.uint64(32)
    return x


def _grams(hashes: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every run of ``gram`` words, by doubling."""
    done, now = 1, hashes
    while done < gram:
        step = min(done, gram - done)
        now = _mix(now[:-step] * _A + now[step:])
        done += step
    return now


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def _anchored(words: list[bytes], ids: _Ids, window: int, gram: int):
    """Runs of consecutive windows with one anchor: (anchors, starts, counts)."""
    hashes = np.fromiter(map(ids.__getitem__, words), np.uint64, len(words))
    anchors = _least(_grams(hashes, gram), window - gram + 1)
    edges = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
    starts = np.concatenate([[0], edges])
    return anchors[starts].view(np.int64), starts, np.diff(np.append(starts, len(anchors)))


def _segments(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``docs`` (t1, t2, text) to anchor, t1, t2, start, windows."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids()
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [[], [], [], [], []]
                for t1, t2, text in zip(*(part.column(c).to_pylist() for c in ("t1", "t2", "text"))):
                    words = utf8(text).split()
                    if len(words) >= window:
                        anchors, starts, counts = _anchored(words, ids, window, gram)
                        for column, value in zip(rows, (anchors, np.full(len(starts), t1), np.full(len(starts), t2),
                                                        starts, counts)):
                            column.append(value)
                if rows[0]:
                    kinds = np.int64, np.int64, np.int64, np.int32, np.int32
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c).astype(k)) for c, k in zip(rows, kinds)],
                        names=["anchor", "t1", "t2", "start", "windows"])

    # slices() takes the batches one at a time
    def run(batches):
        return step([b] for b in batches)

    return docs.select("t1", "t2", "text").mapInArrow(
        run, "anchor long, t1 long, t2 long, start int, windows int")


def _routed(texts: DataFrame, window: int) -> DataFrame:
    """Candidate texts (t1, t2, first, text, wanted) to their segments' words.

    ``wanted`` lists (start, windows, anchor, split). A split segment is sent
    window by window, each under its own hash.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["route", "segment", "t1", "t2", "first", "start", "words"]
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        for batch in batches:
            rows, held = [], 0

            def full():
                return pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

            for t1, t2, first, text, wanted in zip(*(batch.column(c).to_pylist() for c in
                                                     ("t1", "t2", "first", "text", "wanted"))):
                words = utf8(text).split()
                for s in wanted:
                    for start, count in ([(s["start"] + i, 1) for i in range(s["windows"])] if s["split"]
                                         else [(s["start"], s["windows"])]):
                        part = b" ".join(words[start:start + count + window - 1])
                        key = hashlib.md5(part, usedforsecurity=False).digest()
                        route = int.from_bytes(key[:8], "little", signed=True) if s["split"] else s["anchor"]
                        rows.append((route, key, t1, t2, first, start, part))
                        held += len(part)
                        if held > 4 << 20:
                            yield full()
                            rows, held = [], 0
            if rows:
                yield full()

    def run(batches):
        return step(part for batch in batches for part in slices([batch], "text"))

    return texts.mapInArrow(
        run, "route long, segment binary, t1 long, t2 long, first long, start int, words binary")


def _matched(segments: DataFrame, window: int, block_words: int) -> DataFrame:
    """Distinct segments (route, segment, words, first), sorted by route within
    their partition, to the first doc rank of each window, as runs."""

    def block(rows: list[tuple]) -> pa.RecordBatch:
        automaton = SuffixAutomaton()
        symbols: dict[bytes, int] = {}
        streams = [[symbols.setdefault(w, len(symbols)) for w in words.split(b" ")] for _, _, words, _ in rows]
        for stream, (_, _, _, first) in zip(streams, rows):
            automaton.add(stream, first)
        automaton.settle()
        out = []
        for stream, (route, segment, _, _) in zip(streams, rows):
            runs: list[dict] = []
            for i, rank in enumerate(automaton.first_ranks(stream, window)):
                if runs and runs[-1]["first"] == rank:
                    runs[-1]["windows"] += 1
                else:
                    runs.append({"at": i, "windows": 1, "first": rank})
            out.append((route, segment, runs))
        kind = pa.list_(pa.struct([("at", pa.int32()), ("windows", pa.int32()), ("first", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.binary(), kind))],
            names=["route", "segment", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("route", "segment", "words", "first"))):
                if held > block_words and row[0] != rows[-1][0]:
                    yield block(rows)
                    rows, held = [], 0
                rows.append(row)
                held += row[2].count(b" ") + 1
        if rows:
            yield block(rows)

    return segments.mapInArrow(
        run, "route long, segment binary, runs array<struct<at:int,windows:int,first:long>>")


def repeated(docs: DataFrame, window: int = 50, gram: int = 16, hot: int = 2048,
             block_words: int = 100_000, hot_words: int = 200_000) -> DataFrame:
    """``docs`` (rank, t1, t2, text) to one row per text: ``t1, t2``, its
    smallest rank ``first`` and ``spans``, the runs of windows (start,
    windows) of the text that also start in a document with a smaller rank
    than that (NULL: none).
    """
    found = cut(_segments(docs, window, gram), "substring-segments")
    shared = cut(found.groupBy("anchor").agg(
        F.min("t1").alias("lo"), F.max("t1").alias("hi"), F.count("*").alias("rows"),
        F.max(F.col("windows") + (window - 1)).alias("longest"))
        .filter("lo != hi").select("anchor", ((F.col("rows") > hot) | (F.col("longest") > hot_words)).alias("split")),
        "substring-anchors")
    firsts = cut(docs.groupBy("t1", "t2").agg(F.min("rank").alias("first")), "substring-firsts")
    wanted = cut(found.join(shared, "anchor").groupBy("t1", "t2").agg(
        F.collect_set(F.struct("start", "windows", "anchor", "split")).alias("wanted")).join(firsts, ["t1", "t2"]),
        "substring-wanted")
    drop_cut(found)
    # the one row of each candidate text that bears its smallest rank
    texts = docs.withColumnRenamed("rank", "first").join(wanted, ["t1", "t2", "first"])
    routed = cut(_routed(texts.select("t1", "t2", "first", "text", "wanted"), window), "substring-routed")
    distinct = routed.groupBy("route", "segment").agg(F.min("first").alias("first"), F.first("words").alias("words"))
    shards = distinct.repartition("route").sortWithinPartitions("route", "segment")
    matched = cut(_matched(shards, window, block_words), "substring-matched")
    spans = (routed.drop("words").join(matched, ["route", "segment"])
             .select("t1", "t2", "first", "start", F.explode("runs").alias("run"))
             .filter("run.first < first")
             .groupBy("t1", "t2").agg(F.collect_set(F.struct(
                 (F.col("start") + F.col("run.at")).alias("start"), F.col("run.windows").alias("windows"))).alias("spans")))
    out = cut(firsts.join(spans, ["t1", "t2"], "left"), "substring-found")
    for table in (shared, firsts, wanted, routed, matched):
        drop_cut(table)
    return out


def _marked(docs: DataFrame, window: int, gram: int, hot: int) -> DataFrame:
    """All columns of ``docs`` and ``__copy`` (the whole text is in a smaller
    document), ``__spans``; ``docs`` is scanned again, not checkpointed."""
    rank = F.coalesce(F.col("doc_id"), F.lit(LAST)).alias("rank")
    found = repeated(docs.select(rank, *text_key(), "text"), window, gram, hot).withColumnsRenamed(
        {c: f"__{c}" for c in ("t1", "t2", "first", "spans")})
    t1, t2 = text_key()
    return docs.withColumns({"__k1": t1, "__k2": t2, "__rank": rank}).join(
        found, (F.col("__k1") == F.col("__t1")) & (F.col("__k2") == F.col("__t2"))).withColumn(
        "__copy", F.col("__rank") > F.col("__first"))


def _kept(text: str | None, copy: bool, spans: list[dict] | None, window: int) -> tuple[int, list[bytes]]:
    words = utf8(text).split()
    if len(words) < window or not (copy or spans):
        return len(words), words
    if copy:
        return len(words), []
    gone = np.zeros(len(words) + 1, np.int64)
    for s in spans:
        gone[s["start"]] += 1
        gone[s["start"] + s["windows"] + window - 1] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return len(words), [w for w, k in zip(words, keep) if k]


def digest(docs: DataFrame, window: int = 50, gram: int = 16, hot: int = 2048) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, n_words,
    n_removed, kept_sha256`` (of the kept words joined by one space).

    A NULL text has no words. A document shorter than a window keeps all its
    words. A NULL doc_id ranks after every other, and repeated doc_ids do not
    make each other's words go. Repeats within one document stay: "also
    starts in a document with a smaller doc_id" never holds of itself.
    """
    marked = _marked(docs.select("doc_id", "text"), window, gram, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in slices([b], "text")):
            out = []
            for text, copy, spans in zip(*(batch.column(c).to_pylist() for c in ("text", "__copy", "__spans"))):
                n, words = _kept(text, copy, spans, window)
                out.append((n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return marked.select("doc_id", "text", "__copy", "__spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove(docs: DataFrame, window: int = 50, gram: int = 16, hot: int = 2048) -> DataFrame:
    """``docs``, same columns, with the repeated words taken out of ``text``.

    A text that loses words becomes its kept words joined by one space and
    ``n_chars`` (where the table has it) its new length; a text that loses all
    its words is dropped; every other row is unchanged. A NULL or empty text
    stays as it is; a NULL doc_id ranks after every other; rows that repeat a
    doc_id do not make each other's words go.
    """
    marked = _marked(docs, window, gram, hot)
    names = docs.columns

    @F.arrow_udf("string")
    def kept(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            batch = pa.RecordBatch.from_arrays(list(columns), names=["text", "copy", "spans"])
            for part in slices([batch], "text", PIECE_BYTES):
                out = []
                for text, copy, spans in zip(*(c.to_pylist() for c in part.columns)):
                    n, words = _kept(text, copy, spans, window)
                    out.append(text if len(words) == n else b" ".join(words).decode("utf-8", "surrogatepass"))
                yield pa.array(out, pa.string())

    text = F.when(F.col("__copy") | F.col("__spans").isNotNull(),
                  kept(F.col("text"), F.col("__copy"), F.col("__spans"))).otherwise(F.col("text"))
    out = marked.withColumn("__text", text).filter(
        (F.col("__text") != "") | F.col("__text").isNull() | (F.col("text") == ""))
    columns = {"text": F.col("__text").alias("text")}
    if "n_chars" in names:
        kind = dict(docs.dtypes)["n_chars"]
        columns["n_chars"] = F.when(F.col("__text") == F.col("text"), F.col("n_chars")).otherwise(
            F.coalesce(F.length("__text").cast(kind), F.col("n_chars"))).alias("n_chars")
    return out.select(*[columns.get(c, F.col(f"`{c}`")) for c in names])
