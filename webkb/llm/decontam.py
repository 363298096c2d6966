"""Benchmark decontamination with spaced seeds, in DataFrame functions alone.

A mask names the places of a window of words that count; the others may hold
anything, so a substituted word spoils only the masks that look at it. The
masks are chosen so that every overlap that passes the verdict has a hit;
items too short for them have masks of their own length.
The words under each mask are hashed at every position of the training texts
and of the benchmark items and joined. A hit fixes how the two texts align
(a diagonal); around it the aligned words are compared one by one, and the
overlap counts if enough of them are equal.

Along an alignment only the first of consecutive windows that are equal word
by word is a hit, so texts of one repeated word give a hit per alignment and
mask, not one per pair of places.

What is broadcast are the benchmark's windows (hashes and places) and, once
each, the words of the items they are from. Both come in blocks of about
``block_windows`` windows by a count taken before; an item of more is a block
of its own or several, split by place. A larger benchmark takes more passes
over the documents instead of a larger broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webkb.llm.common import cut

#: The places of a window of ``SPAN`` words that each mask reads.
#: Any two places of 13 words in a row are spared by one of the first
#: ``LONG_MASKS`` masks at some window inside them, and any two places of 10, 11
#: or 12 words by one of all masks, so every stretch that passes the verdict
#: (80% equal) has a hit. Tests enumerate this.
SPAN = 10
MASKS = (
    (0, 1, 3, 4, 6, 8, 9),
    (0, 2, 4, 5, 6, 8, 9),
    (0, 1, 2, 3, 4, 7, 8),
    (0, 1, 4, 5, 6, 7, 8),
    (1, 2, 3, 5, 9),
    (2, 3, 6, 7, 8),
    (0, 1, 4, 7, 9),
    (5, 6, 7, 8, 9),
    (0, 2, 3, 4, 5),
)
LONG_MASKS = 4


def masks_for(need: int) -> list[tuple[int, tuple[int, ...]]]:
    """Windows of words (their length) and the places read in them that find
    every stretch of ``need`` words with at least 80% equal."""
    if need >= SPAN:
        return [(SPAN, mask) for mask in (MASKS[:LONG_MASKS] if need >= 13 else MASKS)]
    if need < 5:  # all words
        return [(need, tuple(range(need)))]
    return [(need, tuple(p for p in range(need) if p != out)) for out in range(need)]  # all but one


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text: runs of letters, digits and marks, lower case."""
    words = F.split(F.lower(text), "[^\\p{L}\\p{N}\\p{M}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def seeded(texts: DataFrame, masks: list[tuple[int, tuple[int, ...]]], length: Column | None = None) -> DataFrame:
    """``texts`` (..., words) with one row per window and mask: ``at``, ``seed``.

    ``length``: the words of the stretches to be found in a text, whose masks
    are the only ones used there; without it all masks are.

    The windows are generated beside the array they index: generators, hashes
    and the join that follows run as one compiled stage, so the array is not
    copied per window.
    """
    count = F.size("words") - min(span for span, _ in masks)
    windows = texts.withColumn("at", F.explode(F.when(count >= 0, F.sequence(F.lit(0), count))))
    seeds = []
    for m, (span, mask) in enumerate(masks):
        use = F.col("at") + span <= F.size("words")
        if length is not None:
            use &= length.isin([n for n in range(1, 14) if (span, mask) in masks_for(n)])
        seeds.append(F.when(use, F.xxhash64(F.lit(m), *[F.col("words")[F.col("at") + p] for p in mask])))
    return windows.withColumn("seed", F.explode(F.array(*seeds))).filter(F.col("seed").isNotNull())


def window_before(words: str, at: str) -> Column:
    """Hash of the ``SPAN`` words from the place before ``at`` on."""
    return F.xxhash64(*[F.get(words, F.col(at) + (p - 1)) for p in range(SPAN)])


def window_count(size: Column) -> Column:
    """Windows under all their masks of an item of ``size`` words."""
    def of(need: int) -> Column:
        return reduce(Column.__add__, [F.greatest(F.lit(0), size - (span - 1)) for span, _ in masks_for(need)])

    counts = F.when(size >= 13, of(13))
    for need in range(1, 13):
        counts = counts.when(size == need, of(need))
    return counts.cast("long")


def blocks_of(items: DataFrame, block_windows: int) -> tuple[list[tuple[Column, Column]], list]:
    """Conditions on items and on the places ``item_at`` of their windows, each
    of about ``block_windows`` windows at most, that cover ``items`` (key, item,
    windows) once; and the masks that the items need."""
    split = F.col("windows") > block_windows // 4
    length = F.least(F.size("item"), F.lit(13))
    small = items.groupBy(length, split).agg(F.sum("windows")).sort(F.desc(length)).collect()
    masks = []
    for need, _, _ in small:
        masks += [m for m in masks_for(need) if m not in masks]
    n = -(-sum(total for _, long, total in small if not long) // block_windows)
    blocks = [(~split & (F.pmod(F.col("key"), F.lit(n)) == b), F.lit(True)) for b in range(n)]
    # a block of such an item each, so their list is no longer than that of the passes
    for key, size, windows in items.filter(split).select("key", F.size("item"), "windows").sort("key").collect():
        step = -(-size // -(-windows // block_windows))
        blocks += [(F.col("key") == key, (F.col("item_at") >= low) & (F.col("item_at") < low + step))
                   for low in range(0, size, step)]
    return blocks, masks


def overlaps(docs: DataFrame, benchmark: DataFrame, least_words: int = 13, least_equal: float = 0.8,
             block_windows: int = 500_000) -> DataFrame:
    """Verified overlaps of ``docs`` (text and any key columns) with
    ``benchmark`` (item_id, text): the key columns with ``item_id,
    item_words, overlap_words, equal_words`` of the best alignment.

    Two texts overlap if along one alignment that has a hit a stretch of
    ``least_words`` words (of the whole item, where that is shorter) has at
    least ``least_equal`` of its words equal at the same places.

    Items and documents without words give no evidence and no row; a NULL text
    counts as empty, a NULL item_id is an item like any other. Repeated documents and
    items give the same rows as single ones. An empty table on either side gives
    an empty result. Very long texts and items are compared whole; a pair of
    texts that repeat a few words costs a probe per pair of equal windows, and a
    comparison per alignment.
    """
    keys = [c for c in docs.columns if c != "text"]
    if least_words < 13 or least_equal < 0.8:
        raise ValueError("the masks find stretches of at least 13 words, 80% equal")
    item = word_hashes(F.coalesce("text", F.lit("")))
    items = cut(benchmark.select("item_id", item.alias("item")).filter(F.size("item") >= 1).distinct()
                .withColumns({"key": F.xxhash64("item_id", "item"), "windows": window_count(F.size("item"))}),
                "decontam-items")
    blocks, masks = blocks_of(items, block_windows)
    blocks, masks = blocks or [(F.lit(False), F.lit(False))], masks or masks_for(13)
    words = docs.select(*[F.col(f"`{k}`") for k in keys], word_hashes(F.coalesce("text", F.lit(""))).alias("words"))
    every = reduce(DataFrame.unionByName, [
        _verified(_hits(words, items.filter(of), places, keys, masks), keys, least_words, least_equal)
        for of, places in blocks])
    best = F.max(F.struct("equal_words", "overlap_words", "item_words")).alias("best")
    return every.groupBy(*keys, "item_id").agg(best).select(
        *keys, "item_id", "best.item_words", "best.overlap_words", "best.equal_words")


def _hits(words: DataFrame, items: DataFrame, places: Column, keys: list[str],
          masks: list[tuple[int, tuple[int, ...]]]) -> DataFrame:
    """One row per hit: the item, and the words of the document aligned with
    it from item word ``first`` on."""
    need = F.least(F.size("words"), F.lit(13))
    windows = seeded(items.select("key", F.col("item").alias("words")), masks, need).withColumnRenamed("at", "item_at")
    before = F.when((F.col("item_at") >= 1) & (F.col("item_at") + (SPAN - 1) <= F.size("words")),
                    window_before("words", "item_at"))
    windows = windows.filter(places).select(F.col("seed").alias("item_seed"), "key", "item_at", before.alias("before"))
    texts = items.select(F.col("key").alias("item_key"), "item_id", "item")
    first_of_run = F.col("before").isNull() | (F.col("before") != window_before("words", "at"))
    shift = F.col("at") - F.col("item_at")
    first = F.greatest(F.lit(0), -shift)
    n = F.least(F.size("item"), F.size("words") - shift) - first
    return (seeded(words, masks)
            .join(F.broadcast(windows), (F.col("seed") == F.col("item_seed")) & first_of_run)
            .join(F.broadcast(texts), F.col("key") == F.col("item_key"))
            .select(*keys, "item_id", "item", first.alias("first"),
                    F.slice("words", first + shift + 1, n).alias("aligned")))


def _verified(hits: DataFrame, keys: list[str], least_words: int, least_equal: float) -> DataFrame:
    """Compare the aligned words of each hit; keep alignments with a stretch that holds."""
    n, item_words = F.size("aligned"), F.size("item")
    equal = F.zip_with(F.slice("item", F.col("first") + 1, n), F.col("aligned"),
                       lambda a, b: F.when(a == b, 1).otherwise(0))

    def slide(state: Column, i: Column) -> Column:
        gone = F.when(i >= F.col("need"), F.get("equal", (i - F.col("need")).cast("int"))).otherwise(0)
        here = state["sum"] + F.get("equal", i) - gone
        return F.struct(here.alias("sum"), F.when(i >= F.col("need") - 1, F.greatest(state["best"], here))
                        .otherwise(state["best"]).alias("best"))

    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("best"))
    stretch = F.when(n >= F.col("need"), F.aggregate(F.sequence(F.lit(0), n - 1), start, slide, lambda s: s["best"]))
    # a generator, as a filter would move into the join and take it out of compiled code
    compared = hits.withColumns({"equal": equal, "need": F.least(F.lit(least_words), item_words)}).withColumn("stretch", stretch)
    holds = F.col("stretch") >= F.col("need") * least_equal
    total = F.aggregate("equal", F.lit(0), lambda s, x: s + x)
    row = F.struct(item_words.alias("item_words"), n.alias("overlap_words"), total.alias("equal_words"))
    return compared.select(*keys, "item_id", F.explode(F.when(holds, F.array(row))).alias("row")).select(
        *keys, "item_id", "row.*")


def contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """Rows ``doc_id, item_id, item_words, overlap_words, equal_words`` of the
    documents that hold a benchmark passage; clean documents have no row."""
    return overlaps(docs.select("doc_id", "text"), benchmark.select("item_id", "text"), **settings)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, all columns, without a benchmark passage."""
    t1, t2 = (F.xxhash64(*c).alias(n) for n, c in
              (("__t1", (F.coalesce("text", F.lit("")),)), ("__t2", (F.lit(7), F.coalesce("text", F.lit(""))))))
    names = [F.col(f"`{c}`") for c in docs.columns]
    found = cut(overlaps(docs.select(t1, t2, "text"), benchmark.select("item_id", "text"), **settings)
                .select("__t1", "__t2").distinct(), "decontam-found")
    return docs.select(*names, t1, t2).join(found, ["__t1", "__t2"], "left_anti").select(*names)
