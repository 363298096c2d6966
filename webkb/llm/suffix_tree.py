"""Language-model scores from a probabilistic suffix tree over words.

The tree's root is the smoothed distribution of single tokens. A context (the
last one, two, ... words) seen ``least`` times may become a state, and is
retained if its next-token counts diverge from its parent's distribution by
more than the description length of what is stored for them. A state stores
the next tokens that differ significantly (discounted counts) and leaves the
rest of its mass to the parent's distribution, renormalised; so each state's
distribution sums to one. A token is scored by the longest suffix of the words
before it that is a state.

The model is a set of tables that grows with the corpus; no share of it
bounds what is kept. An n-gram is known by a 64-bit hash, made from those of
the n-gram without its last word (``ctx``, its context) and without its first
(``suf``, the same token one level up). Levels are counted one after the
other; an n-gram is counted if both parts may be in the table before, which a
bitmap of fixed size tells: a false yes costs a row and changes nothing.

Most n-grams occur once and are dropped by the minimum count. They are left
out before the count: a first pass sends four bytes of each hash, and only
n-grams whose bytes occur twice are counted by the second.

A token's log gain over the root is a sum over the n-grams that end at or
before it: ``rest`` for each retained context and a correction for each stored
token. So a text's gain is the sum of one value per n-gram in it, which is a
join of the texts' n-grams with the table of values. The values that are used
most are looked up in a table of fixed size before that join, so a hot context
adds no rows to it.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webkb.llm.common import cut, drop_cut, fold, slices, utf8

#: The end token; no word is empty.
END = b""


def tokens(text: str | None) -> list[bytes]:
    return [*utf8(text).lower().split(), END]


#: A bitmap has at most 64 << MAP_WORDS bits, the table of hot values at most 1 << HOT_SLOTS places.
MAP_WORDS = 21
HOT_SLOTS = 20
#: The last join takes the keys in so many shares, by their first bits.
FAR_BITS = 2
#: What a Python step holds, whatever the size of its partition: bytes of text and of sent keys, bytes of text in a
#: row of tokens (larger rows name a token less often), tokens whose n-grams are made at once, n-grams before they are
#: passed on, about so many keys of a slice (see ``_repeated``), keys mixed at once.
TEXT_BYTES = 1 << 20
CODED_BYTES = 1 << 21
STEP_TOKENS = 1 << 16
HELD_KEYS = 1 << 20
SLICE_KEYS = 1 << 19
MIXED_KEYS = 1 << 15
#: A hashed side of a join is held whole, a partition at a time, and never spilled: with more rows in one, both are sorted.
HASHED_ROWS = 1 << 20


def _mix(ctx: np.ndarray, suf: np.ndarray) -> np.ndarray:
    """What ``F.xxhash64(ctx, suf)`` gives for longs."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                                 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    out = np.empty(len(ctx), np.uint64)
    for i in range(0, len(ctx), MIXED_KEYS):
        h = out[i:i + MIXED_KEYS]
        h[:] = 42
        for part in (ctx, suf):
            h += p5 + np.uint64(8)
            h ^= turn(part[i:i + MIXED_KEYS].view(np.uint64) * p2, 31) * p1
            h[:] = turn(h, 27)
            h *= p1
            h += p4
            h ^= h >> np.uint64(33)
            h *= p2
            h ^= h >> np.uint64(29)
            h *= p3
            h ^= h >> np.uint64(32)
    return out.view(np.int64)


class _Keys(dict):
    """64-bit keys of words."""

    def of(self, words: np.ndarray) -> np.ndarray:
        return pd.util.hash_array(words, categorize=False).view(np.int64)

    def __missing__(self, word: bytes) -> int:
        return int(self.of(np.array([word], object))[0])


def _numbered(batch: pa.RecordBatch, keys: _Keys) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of a batch of texts in one row: the distinct ones, the number
    of each token among them, its key, where each text starts, and each
    token's place in its text."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(batch.column("text"), "")))
    # a blank at either end leaves an empty part; the empty token is the end of each text
    coded = pa.concat_arrays([parts.flatten(), pa.array([""], pa.string())]).dictionary_encode()
    distinct = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    codes = coded.indices.to_numpy()
    end, codes = codes[-1], codes[:-1]
    text = np.repeat(np.arange(batch.num_rows), parts.value_lengths().to_numpy())
    full = codes != end
    codes, text = codes[full], text[full]
    out = np.full(len(codes) + batch.num_rows, end, np.int64)
    out[np.arange(len(codes)) + text] = codes
    sizes = np.bincount(text, minlength=batch.num_rows) + 1
    first = np.cumsum(sizes) - sizes
    return distinct, out, keys.of(distinct)[out], first, np.arange(len(out)) - np.repeat(first, sizes)


def _bits(n: int) -> int:
    """The size of a bitmap for ``n`` keys: a cell in eight or sixteen is set, up to the largest size there is."""
    return min(6 + MAP_WORDS, max(12, int(8 * n).bit_length()))


def _bitmap(keys: DataFrame) -> Broadcast:
    """One bit for the first bits of each ``key``: at most ``1 << MAP_WORDS``
    rows come to the driver, and are sent to each executor once."""
    bits = _bits(keys.count())
    word = F.shiftrightunsigned("key", 64 - bits + 6).alias("word")
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - bits}) & 63 as int))")
    got = keys.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << bits - 6, np.uint64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(out)


def _maybe(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    top = keys.view(np.uint64) >> np.uint64(59 - len(bitmap).bit_length())
    return (bitmap[top >> np.uint64(6)] >> (top & np.uint64(63))) & np.uint64(1) > 0


def _vocabulary(docs: DataFrame) -> DataFrame:
    """Training tokens and how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = _Keys()
        for batch in slices(batches, "text", 2 * TEXT_BYTES):
            distinct, codes, *_ = _numbered(batch, keys)
            times = np.bincount(codes, minlength=len(distinct))
            found = times > 0
            yield pa.RecordBatch.from_arrays([pa.array(distinct[found], pa.binary()), pa.array(times[found], pa.int64())],
                                             names=["token", "n"])

    return docs.select("text").mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _coded(docs: DataFrame) -> DataFrame:
    """The texts of about ``CODED_BYTES`` in a row: ``keys`` of the distinct
    tokens, ``codes`` (the number of each token among them) and ``sizes`` of the
    texts, as bytes of 64- and 32-bit numbers: as arrays, a reader would hold all
    of a file's at once. The levels go over this, so words are found and hashed once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = _Keys()
        for batch in slices(batches, "text", CODED_BYTES):
            distinct, codes, _, first, _ = _numbered(batch, keys)
            row = keys.of(distinct), codes.astype("<i4"), np.diff(np.append(first, len(codes))).astype("<i4")
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in row], names=["keys", "codes", "sizes"])

    return docs.select("text").mapInArrow(run, "keys binary, codes binary, sizes binary")


def _tokens(batches: Iterator[pa.RecordBatch], lead: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The key and the place in its text of each token, of texts or of rows of
    :func:`_coded`: ``STEP_TOKENS`` at a time, led by the ``lead`` tokens before
    them, so that of n-grams one word longer each ends in one step."""
    hashed = _Keys()

    def rows() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            if "text" in batch.schema.names:
                for part in slices([batch], "text", TEXT_BYTES):
                    distinct, codes, _, _, place = _numbered(part, hashed)
                    yield hashed.of(distinct), codes, place
                continue
            for i in range(batch.num_rows):
                keys, codes, sizes = (np.frombuffer(batch.column(c)[i].as_buffer(), kind)
                                      for c, kind in (("keys", "<i8"), ("codes", "<i4"), ("sizes", "<i4")))
                first = np.cumsum(sizes, dtype=np.int32) - sizes
                yield keys, codes, np.arange(len(codes), dtype=np.int32) - np.repeat(first, sizes)

    for keys, codes, place in rows():
        for i in range(0, len(codes), STEP_TOKENS):
            step = slice(max(0, i - lead), i + STEP_TOKENS)
            yield keys[codes[step]], place[step]


def _parts(found: np.ndarray, place: np.ndarray, maps: list[Broadcast]) -> tuple[np.ndarray, np.ndarray]:
    """``ctx, suf`` of the n-grams, among tokens as of :func:`_tokens`, one word
    longer than those of the last of ``maps`` (bitmaps of the counted n-grams
    of 1, 2, ... words)."""
    length = len(maps) + 1
    # the places where an n-gram of the table may end, and its key
    ok, key = _maybe(maps[0].value, found), found
    for m in range(2, length + 1):
        at = np.flatnonzero(ok[1:] & ok[:-1] & (place[1:] >= m - 1)) + 1
        ctx, suf = key[at - 1], key[at]
        if m < length:
            longer = _mix(ctx, suf)
            at, longer = (x[_maybe(maps[m - 1].value, longer)] for x in (at, longer))
            ok, key = np.zeros(len(found), bool), np.zeros(len(found), np.int64)
            ok[at], key[at] = True, longer
    return ctx, suf


def _sent(batches: Iterator[pa.RecordBatch], maps: list[Broadcast], top: int, most: int) -> Iterator[pa.RecordBatch]:
    """``slice, once, more``: of the keys found in about ``most`` n-grams at a
    time (as in :func:`_parts`), the four bytes after the first ``top`` bits,
    apart by whether they were found twice."""
    held: list[np.ndarray] = []

    def full():
        key, n = np.unique(np.concatenate(held).view(np.uint64) >> np.uint64(32 - top), return_counts=True)
        held.clear()
        low, many = key.astype(np.uint32), n > 1
        at = np.flatnonzero(np.diff(key >> np.uint64(32), prepend=~np.uint64(0)))
        for i in range(0, len(at), 1024):
            starts, ends = at[i:i + 1024], np.append(at[i + 1:i + 1025], len(key))[:1024]
            rows = [(int(key[a]) >> 32, low[a:b][~many[a:b]].tobytes(), low[a:b][many[a:b]].tobytes())
                    for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
                names=["slice", "once", "more"])

    for found, place in _tokens(batches, len(maps)):
        held.append(_mix(*_parts(found, place, maps)))
        if sum(map(len, held)) > most:
            yield from full()
    if sum(map(len, held)):
        yield from full()


def _twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``slice, low``: of the rows of :func:`_sent`, sorted by slice, the bytes that were found twice."""
    now, once, more = None, [], []

    def found():
        low, n = np.unique(np.frombuffer(b"".join(once), np.uint32), return_counts=True)
        low = np.concatenate([low[n > 1], np.frombuffer(b"".join(more), np.uint32)])
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([low.tobytes()], pa.binary())],
                                          names=["slice", "low"])

    for batch in slices(batches, "once", TEXT_BYTES):
        for part, few, many in zip(*(batch.column(c).to_pylist() for c in ("slice", "once", "more"))):
            if part != now:
                if now is not None:
                    yield found()
                now, once, more = part, [], []
            once.append(few)
            more.append(many)
    if now is not None:
        yield found()


def _top(total: int) -> int:
    """By how many first bits the keys of ``total`` tokens are dealt to slices."""
    return min(MAP_WORDS - 5, max(8, int(total // SLICE_KEYS).bit_length()))


def _repeated(docs: DataFrame, maps: list[Broadcast], total: int = 0, most: int = HELD_KEYS) -> Broadcast:
    """A bitmap of the n-grams (as in :func:`_parts`) that may occur twice,
    of texts with ``total`` tokens.

    Keys are dealt to slices by their first bits, so many that a slice has
    about ``SLICE_KEYS`` keys at most; a task sends the next four bytes of the
    keys it has found, apart by whether it has found them twice. A slice's
    bytes that come twice set its part of the bitmap. An n-gram that occurs
    twice is never missed; the parts, of bounded size, come to the driver."""
    top = _top(total)
    sent = docs.mapInArrow(lambda b: _sent(b, maps, top, most), "slice int, once binary, more binary")
    got = cut(sent.repartition("slice").sortWithinPartitions("slice").mapInArrow(_twice, "slice int, low binary"), "tree-repeated")
    bits = _bits(got.agg(F.sum(F.octet_length("low") / 4)).first()[0] or 0)
    cells = max(64, 1 << max(0, bits - top))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "low", TEXT_BYTES):
            marked = []
            for low in batch.column("low").to_pylist():
                part = np.zeros(cells, bool)
                part[np.frombuffer(low, np.uint32) >> np.uint32(33 - cells.bit_length())] = True
                marked.append(np.packbits(part, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("slice"), pa.array(marked, pa.binary())], names=["slice", "bits"])

    out = np.zeros((1 << top, cells // 64), np.uint64)
    for row in got.mapInArrow(mark, "slice int, bits binary").collect():
        out[row["slice"]] = np.frombuffer(row["bits"], "<u8")
    drop_cut(got)
    return docs.sparkSession.sparkContext.broadcast(out.ravel())


def _counted(batches: Iterator[pa.RecordBatch], maps: list[Broadcast], wanted: Broadcast, most: int) -> Iterator[pa.RecordBatch]:
    """``ctx, suf, n`` of the n-grams (as in :func:`_parts`) that may be in
    ``wanted``, summed over about ``most`` of them at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def full():
        ctx, suf = (np.concatenate(x) for x in zip(*held))
        held.clear()
        key = _mix(ctx, suf)
        # as by np.unique, which makes more copies
        order = np.argsort(key)
        key = key[order]
        starts = np.flatnonzero(np.diff(key, prepend=~key[:1]))
        at, n = order[starts], np.diff(starts, append=len(key))
        del key, order, starts
        for i in range(0, len(at), 1 << 18):
            part = at[i:i + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(ctx[part]), pa.array(suf[part]), pa.array(n[i:i + (1 << 18)])],
                                             names=["ctx", "suf", "n"])

    for found, place in _tokens(batches, len(maps)):
        ctx, suf = _parts(found, place, maps)
        again = _maybe(wanted.value, _mix(ctx, suf))
        held.append((ctx[again], suf[again]))
        if sum(len(x) for x, _ in held) > most:
            yield from full()
    if held:
        yield from full()


def _dealt(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    """``slice, ctx, suf, n``: the rows of :func:`_counted`, which come by key, as one row a slice of keys."""
    for batch in batches:
        ctx, suf, n = (c.to_numpy() for c in batch.columns)
        part = (_mix(ctx, suf).view(np.uint64) >> np.uint64(64 - top)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, columns = part[order], (ctx[order], suf[order], n[order].astype(np.uint32))
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        ends = np.append(starts[1:], len(part))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[starts]), *(pa.array([x[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())
                                       for x in columns)], names=["slice", "ctx", "suf", "n"])


def _summed(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """``ctx, suf, n`` of the n-grams found ``least`` times in the rows of :func:`_dealt`, sorted by slice."""
    now, held = None, []

    def found():
        ctx, suf, n = (np.frombuffer(b"".join(x), kind) for x, kind in zip(zip(*held), (np.int64, np.int64, np.uint32)))
        key = _mix(ctx, suf)
        order = np.argsort(key)
        starts = np.flatnonzero(np.diff(key[order], prepend=~key[order[0]]))
        sums = np.add.reduceat(n[order].astype(np.int64), starts)
        at = order[starts[sums >= least]]
        return pa.RecordBatch.from_arrays([pa.array(ctx[at]), pa.array(suf[at]), pa.array(sums[sums >= least])],
                                          names=["ctx", "suf", "n"])

    for batch in slices(batches, "ctx", TEXT_BYTES):
        for part, *row in zip(*(batch.column(c).to_pylist() for c in ("slice", "ctx", "suf", "n"))):
            if part != now and held:
                yield found()
                held = []
            now = part
            held.append(row)
    if held:
        yield found()


def _ngrams(docs: DataFrame, maps: list[Broadcast], wanted: Broadcast, total: int = 0, least: int = 1,
            most: int = HELD_KEYS) -> DataFrame:
    """Counts ``ctx, suf, n``, of ``least`` at least, of the n-grams (as in
    :func:`_parts`) that may be in the bitmap ``wanted``, of texts with
    ``total`` tokens. A task sends its counts by slices of their keys (as in
    :func:`_repeated`), an n-gram's counts are summed in its slice."""
    top = _top(total)
    dealt = docs.mapInArrow(lambda b: _dealt(_counted(b, maps, wanted, most), top), "slice int, ctx binary, suf binary, n binary")
    return dealt.repartition("slice").sortWithinPartitions("slice").mapInArrow(
        lambda b: _summed(b, least), "ctx long, suf long, n long")


def _words(vocabulary: DataFrame) -> DataFrame:
    """``key, n`` of the tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = _Keys()
        for batch in batches:
            found = keys.of(batch.column("token").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(found), batch.column("n")], names=["key", "n"])

    return vocabulary.select("token", "n").mapInArrow(run, "key long, n long")


def model(docs: DataFrame, vocabulary: DataFrame, total: int, distinct: int, depth: int = 3, least: int = 2,
          discount: float = 0.5, parts: tuple[str, ...] = (), stored_only: bool = False) -> list[tuple[DataFrame, DataFrame]]:
    """Per level of the training texts ``docs`` (text): the counted n-grams
    ``key, n, p, adj`` (``p``: log probability at this level, ``adj``: NULL if
    not stored) with ``parts`` of ``ctx, suf``, and the retained contexts
    ``key, n, rest``. With ``stored_only`` the n-grams that are not stored are
    left out, and deleted when the next level is made."""
    cost = 0.5 * float(np.log(max(total, 2)))
    words = _words(vocabulary).filter(F.col("n") >= least)
    last = cut(words.withColumn("p", F.log((F.col("n") + 0.1) / (total + 0.1 * (distinct + 1)))), "tree-level")
    maps, levels = [], []
    coded = cut(_coded(docs), "tree-tokens")
    for number in range(depth):
        maps.append(_bitmap(last))
        wanted = _repeated(coded, maps, total) if least > 1 else docs.sparkSession.sparkContext.broadcast(~np.zeros(1, np.uint64))
        _release(docs)
        counted = cut(_ngrams(coded, maps, wanted, total, least), "tree-counted")
        if number == depth - 1:
            drop_cut(coded)
        _release(docs)
        # one join at a time, so that the shuffle files of one go before the next; hashed joins sort neither side,
        # and what is hashed is a partition of the level before
        rows = last.count()
        higher = cut(counted.join(_hashed(last.select(F.col("key").alias("suf"), F.col("p").alias("above")), rows), "suf"),
                     "tree-higher")
        drop_cut(counted)
        del counted
        _release(docs)
        tested = cut(higher.join(_hashed(last.select(F.col("key").alias("ctx"), F.col("n").alias("total")), rows), "ctx"),
                     "tree-tested")
        drop_cut(higher)
        del higher
        _release(docs)
        own, above = F.log((F.col("n") - discount) / F.col("total")), F.col("above")
        kept = F.col("n") * (own - above) > cost
        rest = F.log(F.greatest(1 - F.col("stored"), F.lit(1e-12))) - F.log(F.greatest(1 - F.col("covered"), F.lit(1e-12)))
        rests = cut(tested.filter(kept).groupBy("ctx", "total").agg(
            F.sum(F.exp(own)).alias("stored"), F.sum(F.exp(above)).alias("covered"), F.count("*").alias("tokens"),
            F.sum("n").alias("n"), F.sum(F.col("n") * (own - above)).alias("gain"))
            .withColumn("rest", rest)
            .filter(F.col("gain") + (F.col("total") - F.col("n")) * F.col("rest") > cost * (F.col("tokens") + 1))
            .select(F.col("ctx").alias("key"), F.col("total").alias("n"), "rest"), "tree-states")
        p = F.when(F.col("rest").isNull(), above).when(kept, own).otherwise(above + F.col("rest"))
        _release(docs)
        if stored_only:
            drop_cut(last)
        level = tested.join(_hashed(rests.select(F.col("key").alias("ctx"), "rest"), rests.count()), "ctx", "left").select(
            F.xxhash64("ctx", "suf").alias("key"), "n", p.alias("p"),
            F.when(kept, own - above - F.col("rest")).alias("adj"), *parts)
        stored = F.col("adj").isNotNull()
        if stored_only and number == depth - 1:
            levels.append((cut(level.filter(stored), "tree-stored"), rests))
        else:
            last = cut(level, "tree-level")
            levels.append((cut(last.filter(stored), "tree-stored") if stored_only else last, rests))
        drop_cut(tested)
        wanted.destroy()
        del tested, level
        _release(docs)
    for sent in maps:
        sent.destroy()
    return levels


def _hashed(table: DataFrame, rows: int) -> DataFrame:
    """``table``, of ``rows`` rows, as the side of a join that is hashed, if its partitions are small enough."""
    partitions = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table.hint("shuffle_hash" if rows <= HASHED_ROWS * partitions else "merge")


def _release(docs: DataFrame) -> None:
    """Let Spark delete the shuffle files of plans that nothing holds any more."""
    gc.collect()
    docs.sparkSession._jvm.System.gc()


def _values(levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``key, n, value``: what an n-gram adds to the log gain of a text that holds it."""
    parts = [part for level, rests in levels for part in (
        rests.select("key", "n", F.col("rest").alias("value")),
        level.filter(F.col("adj").isNotNull()).select("key", "n", F.col("adj").alias("value")))]
    return reduce(DataFrame.unionAll, parts).groupBy("key").agg(F.max("n").alias("n"), F.sum("value").alias("value"))


def _hot(values: DataFrame, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """``key, value`` of the values used most, by the first ``slots`` bits of
    their keys: about two for a place come to the driver, that used most has it."""
    use = F.floor(F.log2("n") * 16)
    enough, least = 0, None
    for row in sorted(values.groupBy(use.alias("use")).count().collect(), reverse=True):
        enough += row["count"]
        if enough > 2 << slots:
            break
        least = row["use"]
    keys, found = np.zeros(1 << slots, np.int64), np.zeros(1 << slots)
    if least is not None:
        got = values.filter(use >= least).toArrow()
        n, key, value = (got.column(c).to_numpy() for c in ("n", "key", "value"))
        order = np.argsort(n, kind="stable")
        at = (key.view(np.uint64) >> np.uint64(64 - slots))[order]
        keys[at], found[at] = key[order], value[order]
    return keys, found


def score_documents(docs: DataFrame, folds: int = 10, test_fold: int = 0, depth: int = 3, **settings) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score`` (log10).

    Learned from the rows whose fold is not the held-out one. A NULL text is
    the empty text, which is its end token alone; a NULL doc_id is in the fold
    of the empty string. Without training rows every token has the root
    probability of an unseen one. An empty table gives an empty result.
    """
    held = fold(F.col("doc_id"), folds) == test_fold
    train = docs.select("doc_id", "text").filter(~held)
    vocabulary = cut(_vocabulary(train), "tree-vocabulary")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    levels = model(train, vocabulary, total, distinct, depth=depth, stored_only=True, **settings)
    values = cut(_values(levels), "tree-values")
    for level, rests in levels:
        drop_cut(level)
        drop_cut(rests)
    del levels
    _release(docs)
    kept = values.count()
    slots = min(HOT_SLOTS, max(8, kept.bit_length()))
    hot_keys, hot_values = _hot(values, slots)
    known = _bitmap(values)
    norm = np.log10(total + 0.1 * (distinct + 1))
    # a fixed number of common tokens is scored in place, all others by the join
    found = vocabulary.filter(F.col("n") >= max(2, int(np.ceil(1e-6 * total)))).collect()
    common_base = {bytes(r["token"]): float(np.log10(r["n"] + 0.1) - norm) for r in found}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = _Keys()
        for batch in slices(batches, "text", TEXT_BYTES):
            distinct, words, key, starts, place = _numbered(batch, keys)
            base = np.fromiter(map(common_base.get, distinct.tolist(), repeat(np.nan)), float, len(distinct))[words]
            rare = np.isnan(base)
            per_text = lambda x: np.add.reduceat(x, starts)
            offsets = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            gain, text = np.zeros(len(words)), np.cumsum(place == 0) - 1
            far_key, far_text = [], []
            for m in range(1, depth + 2):
                at = np.flatnonzero(place >= m - 1)
                if m > 1:
                    longer = np.zeros(len(words), np.int64)
                    longer[at] = _mix(key[at - 1], key[at])
                    key = longer
                here = key[at]
                top = here.view(np.uint64) >> np.uint64(64 - slots)
                hit = hot_keys[top] == here
                gain[at[hit]] += hot_values[top[hit]]
                at = at[~hit & _maybe(known.value, here)]
                far_key.append(key[at])
                far_text.append(text[at])
            far_key, far_text = np.concatenate(far_key), np.concatenate(far_text)
            order = np.argsort(far_text, kind="stable")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(np.append(starts, len(words)))),
                 pa.array(per_text(np.where(rare, 0.0, base))), pa.array(per_text(gain) / np.log(10)),
                 pa.ListArray.from_arrays(offsets(per_text(rare.astype(np.int64))),
                                          pa.array(distinct[words[rare]], pa.binary())),
                 pa.ListArray.from_arrays(offsets(np.bincount(far_text, minlength=len(starts))), pa.array(far_key[order]))],
                names=["doc_id", "n_tokens", "common", "gain", "rare", "far"])

    scored = cut(docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, common double, gain double, rare array<binary>, far array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "tree-scored")
    # the files of the joins that made the hot values and the bitmap
    _release(docs)
    c = F.coalesce("n", F.lit(0))
    # one join at a time here as well
    rare = cut(scored.select("row", F.explode("rare").alias("token")).join(_hashed(vocabulary, distinct), "token", "left")
               .groupBy("row").agg(F.sum(F.log10(c + 0.1) - F.lit(float(norm))).alias("uncommon"),
                                   F.sum((c == 0).cast("long")).alias("unknown")), "tree-rare")
    _release(docs)
    # a share of the keys at a time: together, their shuffle files outweigh the table of scores
    share = F.shiftrightunsigned("key", 64 - FAR_BITS)
    sums = []
    for i in range(1 << FAR_BITS):
        sums.append(cut(scored.select("row", F.explode("far").alias("key")).filter(share == i).join(
            _hashed(values.filter(share == i).select("key", "value"), kept >> FAR_BITS), "key")
            .groupBy("row").agg((F.sum("value") / float(np.log(10))).alias("more")), "tree-far"))
        _release(docs)
    far = reduce(DataFrame.unionAll, sums).groupBy("row").agg(F.sum("more").alias("more"))
    zero = lambda name: F.coalesce(name, F.lit(0.0))
    base_score = F.col("common") + zero("uncommon")
    return scored.drop("rare", "far").join(rare, "row", "left").join(far, "row", "left").select(
        "doc_id", held.alias("held_out"), "n_tokens",
        (F.col("n_tokens") - F.coalesce("unknown", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        base_score.alias("base_score"), (base_score + F.col("gain") + zero("more")).alias("score"))
