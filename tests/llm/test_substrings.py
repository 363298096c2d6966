import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from webkb.llm import substrings
from webkb.llm.automaton import SuffixAutomaton
from webkb.llm.common import text_key

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, first long, t1 string, n_chars long"


def brute(rows, window=50):
    """(doc_id, n_words, kept words) per row."""
    first = {}
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    rank = [d if d is not None else 1 << 63 for d, _ in rows]
    for r, (_, w) in zip(rank, split):
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, r), r)
    out = []
    for r, (d, w) in zip(rank, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < r:
                gone.update(range(i, i + window))
        out.append((d, len(w), [x for i, x in enumerate(w) if i not in gone]))
    return out


def expected(rows, window=50):
    return sorted(((d, n, n - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest())
                   for d, n, k in brute(rows, window)), key=str)


def found(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()], key=str)


def cases():
    rng = random.Random(5)
    word = lambda: rng.choice("ab cd é ef gh ij kl mn op qr st uv wx yz".split())
    text = lambda n: [word() for _ in range(n)]
    passage, long = text(60), text(400)
    rows = [(None, None), (1, ""), (2, " \n\t"), (3, " ".join(text(49))), (4, " ".join(long)), (4, " ".join(long)),
            (9, " ".join(long)), (None, " ".join(long)), (5, "x " * 300), (6, "x " * 120 + "y"), (7, "\x0b".join(long[100:149])),
            (8, "\n".join(long[100:150])), (10, " ".join(text(20) + long[50:200] + text(5) + long[120:300]))]
    for i in range(20, 45):
        rows.append((i, " ".join(text(rng.randrange(30)) + passage[rng.randrange(4):] + text(rng.randrange(80)))))
    return rows


@pytest.mark.parametrize("hot", [2048, 3])
def test_matches_brute_force(spark, hot):
    rows = cases()
    docs = spark.createDataFrame([(d, t, 1, "x", 0) for d, t in rows], SCHEMA).repartition(5)
    assert found(substrings.digest(docs, hot=hot)) == expected(rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected(rows)
    assert found(substrings.digest(docs)) == want
    assert any(r[2] for r in want)


def test_remove(spark):
    rows = cases()
    docs = spark.createDataFrame([(d, t, 7, "x", -1) for d, t in rows], SCHEMA)
    got = substrings.remove(docs)
    assert got.columns == docs.columns
    want = []
    for (d, t), (_, n, kept) in zip(rows, brute(rows)):
        if len(kept) == n:
            want.append((d, t, 7, "x", -1))
        elif kept:
            want.append((d, " ".join(kept), 7, "x", len(" ".join(kept))))
    assert sorted([tuple(r) for r in got.collect()], key=str) == sorted(want, key=str)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert substrings.digest(none).count() == 0
    assert substrings.remove(none).count() == 0


def test_automaton_first_ranks():
    rng = random.Random(1)
    for _ in range(60):
        seqs = [([rng.randrange(3) for _ in range(rng.randrange(1, 25))], rng.randrange(9)) for _ in range(6)]
        a = SuffixAutomaton()
        for s, r in seqs:
            a.add(s, r)
        a.settle()
        for s in [x for x, _ in seqs] + [[rng.randrange(4) for _ in range(20)]]:
            want = []
            for i in range(len(s) - 3):
                at = [r for t, r in seqs for j in range(len(t) - 3) if t[j:j + 4] == s[i:i + 4]]
                want.append(min(at) if at else None)
            assert a.first_ranks(s, 4) == want


def test_long_texts_of_one_repeated_word(spark):
    """Two texts of one word beyond the bound are routed window by window: one window in all."""
    rows = [(1, "same " * 3000), (2, "same " * 2500 + "end"), (3, "other " * 60), (4, "a b " * 1200), (5, "b a " * 1300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.n_removed for r in substrings.digest(docs).collect()}
    rank = docs.select(F.col("doc_id").alias("rank"), *text_key(), "text")
    split = {r.first: r.spans for r in substrings.repeated(rank, hot_words=500).collect()}
    whole = {r.first: r.spans for r in substrings.repeated(rank).collect()}
    covered = lambda spans: {i for s in spans or () for i in range(s.start, s.start + s.windows)}
    assert {d: covered(s) for d, s in split.items()} == {d: covered(s) for d, s in whole.items()}
    assert kept == {1: 0, 2: 2500, 3: 0, 4: 0, 5: 2600}
