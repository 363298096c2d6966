import random
import re

import xxhash
from pyspark.sql import types as T

from webkb.llm import simhash

SCHEMA = "doc_id long, text string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, f"{prints[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=str)


def found(df):
    return sorted([(r.doc_id, r.fingerprint, r.component_id) for r in df.collect()], key=str)


def cases():
    rng = random.Random(3)
    base = [rng.choice(["the", "Anb", "tion", "ér", "le", "wh", "x"]) for _ in range(300)]
    rows = [(None, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "one"), (5, "one two"), (6, "a b c"),
            (7, "a b c"), (7, "a b c"), (8, "w " * 5000), (None, "w " * 4000)]
    for i in range(60):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(300)] = "edit"
        rows.append((100 + i, " ".join(words)))
    return rows


def test_matches_brute_force(spark):
    rows = cases()
    assert found(simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_whole_table(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert found(simhash.near_duplicates(documents)) == brute(rows)


def test_ball_chain_of_links(spark):
    # 0 - 3 - 15 - 63: each within two bits of the next, the ends are not
    prints = spark.createDataFrame([(0,), (3,), (15,), (63,), (-1,)], "fp long")
    got = {(r.doc_id, r.component_id) for r in simhash.groups(
        prints.selectExpr("fp", "abs(fp) as doc_id"), 2).join(prints.selectExpr("fp", "abs(fp) as doc_id"), "fp")
        .select("doc_id", "component_id").collect()}
    assert got == {(0, 0), (3, 0), (15, 0), (63, 0), (1, 1)}


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0


def test_keep_one(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("fp", T.StringType()), T.StructField("root", T.LongType())])
    rows = [(d, t, "clash", 1) for d, t in cases()] + [(100, cases()[11][1], "clash", 1)]
    docs = spark.createDataFrame(rows, schema)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = {}
    for d, f, c in brute([(r[0], r[1]) for r in rows]):
        want.setdefault(c, (d, f))
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(want)
    assert {d for d, _ in got} == set(want)
