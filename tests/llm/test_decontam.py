import random
import re
from itertools import combinations

from webkb.llm import decontam as D

WORDS = re.compile(r"[^\W_]+")
SCHEMA = "doc_id long, text string, item_id long, words string, seed long"


def brute(docs, items, least=13, share=0.8, seeded=True):
    """Alignments with a stretch of ``least`` words (the whole item, if shorter) of which ``share`` are equal,
    that meets a window whose masked words are equal."""
    out = {}
    for d, text in docs:
        w = WORDS.findall((text or "").lower())
        for i, item in items:
            v = WORDS.findall((item or "").lower())
            if len(v) < D.SPAN:
                continue
            need = min(least, len(v))
            for shift in range(-len(v) + 1, len(w)):
                lo, hi = max(0, -shift), min(len(v), len(w) - shift)
                eq = [v[p] == w[p + shift] for p in range(lo, hi)]
                hits = [p - lo for p in range(lo, hi - D.SPAN + 1)
                        if any(all(eq[p - lo + m] for m in mask) for mask in D.MASKS)]
                good = any(sum(eq[a:a + need]) >= share * need for h in hits
                           for a in range(max(0, h - need + 1), min(len(eq) - need, h + D.SPAN - 1) + 1))
                if good:
                    row = (sum(eq), hi - lo, len(v))
                    out[(d, i)] = max(out.get((d, i), row), row)
    return sorted(((d, i, n, o, e) for (d, i), (e, o, n) in out.items()), key=str)


def found(df):
    return sorted([tuple(r) for r in df.select(
        "doc_id", "item_id", "item_words", "overlap_words", "equal_words").collect()], key=str)


def cases():
    rng = random.Random(6)
    word = lambda: rng.choice([f"w{i}" for i in range(300)])
    text = lambda n: [word() for _ in range(n)]
    items = [(i, " ".join(text(rng.randrange(8, 50)))) for i in range(12)] + [(None, " ".join(text(20))), (50, None), (51, ""),
             (52, "the " * 30), (3, " ".join(text(20)))]
    docs = [(None, None), (1, ""), (2, " ".join(text(11))), (3, "the " * 400), (4, items[3][1].upper()), (5, " ".join(text(3000)))]
    for n in range(80):
        i = items[rng.randrange(13)][1].split()
        for _ in range(n % 6):
            i[rng.randrange(len(i))] = "changed,"
        cut = rng.randrange(3) * 5
        docs.append((10 + n, " ".join(text(rng.randrange(40)) + i[cut:] + text(rng.randrange(40)))))
    return docs + [(10, docs[6][1]), (None, docs[7][1])], items


def frames(spark):
    docs, items = cases()
    return (docs, items, spark.createDataFrame([(d, t, 1, "x", 1) for d, t in docs], SCHEMA),
            spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string"))


def test_matches_brute_force(spark):
    docs, items, a, b = frames(spark)
    want = brute(docs, items)
    assert want and any(e < o for _, _, _, o, e in want)
    assert found(D.contaminated(a, b)) == want
    assert found(D.contaminated(a, b, block_windows=50)) == want


def test_drop(spark):
    docs, items, a, b = frames(spark)
    gone = {t for _, t in docs if brute([(0, t)], items)}
    got = D.drop_contaminated(a, b)
    assert got.columns == a.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == sorted(
        (str(d), str(t)) for d, t in docs if t not in gone)


def test_whole_table(spark):
    path = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/benchmark.parquet")
    rows = found(D.contaminated(docs, items))
    texts = {r.doc_id: " ".join(WORDS.findall(r.text.lower())) for r in docs.collect()}
    whole = {(d, r.item_id) for r in items.collect() for d, t in texts.items()
             if " ".join(WORDS.findall(r.text.lower())) in t}
    assert {r[:2] for r in rows if r[2] == r[4]} == whole


def test_empty(spark):
    _, _, a, b = frames(spark)
    assert D.contaminated(a.limit(0), b).count() == 0
    assert D.contaminated(a, b.limit(0)).count() == 0
    assert D.drop_contaminated(a, b.limit(0)).count() == a.count()


def test_native(spark):
    _, _, a, b = frames(spark)
    plan = D.contaminated(a, b)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_masks_find_every_stretch():
    """Every placement of the substitutions that the verdict allows leaves a mask whole."""
    for need in range(1, 14):
        allowed = max(k for k in range(need) if need - k >= 0.8 * need)
        for gone in combinations(range(need), allowed):
            assert any(not {at + p for p in mask} & set(gone)
                       for span, mask in D.masks_for(need) for at in range(need - span + 1)), (need, gone)


def brute_without_masks(docs, items, least=13, share=0.8):
    """The verdict alone: any alignment, any stretch."""
    out = {}
    for d, text in docs:
        w = WORDS.findall((text or "").lower())
        for i, item in items:
            v = WORDS.findall((item or "").lower())
            need = min(least, len(v))
            for shift in range(-len(v) + 1, len(w)) if v else ():
                lo, hi = max(0, -shift), min(len(v), len(w) - shift)
                eq = [v[p] == w[p + shift] for p in range(lo, hi)]
                if any(sum(eq[a:a + need]) >= share * need for a in range(len(eq) - need + 1)):
                    row = (sum(eq), hi - lo, len(v))
                    out[(d, i)] = max(out.get((d, i), row), row)
    return sorted(((d, i, n, o, e) for (d, i), (e, o, n) in out.items()), key=str)


def compare(spark, docs, items):
    want = brute_without_masks(docs, items)
    a = spark.createDataFrame([(d, t, 1, "x", 1) for d, t in docs], SCHEMA)
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    assert found(D.contaminated(a, b)) == want
    return want


def test_recall_of_long_items(spark):
    items = [(n, " ".join(f"i{n}x{p}" for p in range(n))) for n in (13, 15, 16, 20, 40)]
    docs = []
    for n, text in items:
        w = text.split()
        for gone in [(), (4, 9), *combinations(range(13), 2), tuple(range(4, n, 5)), *combinations(range(0, n, 2), 3)]:
            docs.append((len(docs), " ".join(["a", "b", *("x" if p in gone else u for p, u in enumerate(w)), "c"])))
    want = compare(spark, docs, items)
    assert len(want) > 5 * 80


def test_recall_of_short_items(spark):
    items = [(n, " ".join(f"i{n}x{p}" for p in range(n))) for n in range(13)] + [(None, "Two words")]
    docs = [(900, "two, WORDS"), (901, "two other words"), (902, None)]
    for n, text in items[:13]:
        w = text.split()
        for gone in [(), *((p,) for p in range(n)), *combinations(range(n), 2)]:
            docs.append((len(docs), " ".join(["a", *("x" if p in gone else u for p, u in enumerate(w)), "c"])))
    want = compare(spark, docs, items)
    assert {r[1] for r in want} == {*range(1, 13), None}


def test_repeated_words_give_a_hit_per_alignment(spark):
    item, n = "the " * 200, 20_000
    a = spark.createDataFrame([(1, "the " * n, 1, "x", 1), (2, "a the " * 3000, 1, "x", 1)], SCHEMA)
    b = spark.createDataFrame([(1, item, "x"), (2, "the a " * 100, "x")], "item_id long, text string, words string")
    assert found(D.contaminated(a, b)) == [(1, 1, 200, 200, 200), (2, 2, 200, 200, 200)]
    masks = D.masks_for(13)
    words = a.select("doc_id", D.word_hashes(D.F.col("text")).alias("words"))
    items = b.select("item_id", D.word_hashes(D.F.col("text")).alias("item")).withColumn("key", D.F.xxhash64("item"))
    hits = D._hits(words, items, D.F.lit(True), ["doc_id"], masks)
    assert hits.filter("doc_id = 1 and item_id = 1").count() <= len(masks) * (n + 200)


def test_long_item_is_split_by_place(spark):
    rng = random.Random(8)
    w = [f"w{rng.randrange(5000)}" for _ in range(20_000)]
    a = spark.createDataFrame([(1, " ".join(w[9000:9030]), 1, "x", 1), (2, " ".join(w), 1, "x", 1), (3, "w1 w2", 1, "x", 1),
                               (4, " ".join(f"v{i}" if i % 5 == 4 else x for i, x in enumerate(w[19_970:])), 1, "x", 1)], SCHEMA)
    b = spark.createDataFrame([(1, " ".join(w), "x"), (2, "", "x")], "item_id long, text string, words string")
    want = [(1, 1, 20_000, 30, 30), (2, 1, 20_000, 20_000, 20_000), (4, 1, 20_000, 30, 24)]
    assert found(D.contaminated(a, b)) == want
    assert found(D.contaminated(a, b, block_windows=30_000)) == want


def test_blocks_cover_each_window_once(spark):
    """No block holds much more than its bound, in windows and in words sent with them."""
    sizes = [5, 9, 12, 13, 40, 40, 41, 300, 2000]
    b = spark.createDataFrame([(i, " ".join(f"i{i}x{p}" for p in range(n))) for i, n in enumerate(sizes)],
                              "item_id long, text string")
    items = b.select("item_id", D.word_hashes(D.F.col("text")).alias("item")).withColumns(
        {"key": D.F.xxhash64("item_id", "item"), "windows": D.window_count(D.F.size("item"))})
    blocks, masks = D.blocks_of(items, 1000)
    need = D.F.least(D.F.size("words"), D.F.lit(13))
    every = []
    for of, places in blocks:
        part = items.filter(of)
        rows = [tuple(r) for r in D.seeded(part.select("key", D.F.col("item").alias("words")), masks, need)
                .withColumnRenamed("at", "item_at").filter(places).select("key", "item_at", "seed").collect()]
        assert len(rows) <= 2000
        every += rows
    assert len(every) == len(set(every)) == sum(r.windows for r in items.collect())
