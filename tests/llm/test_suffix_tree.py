import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tree_model import grow
from webkb.llm import suffix_tree as S

SCHEMA = "doc_id long, text string, score double, row long, n string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def toks(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [""]


def held(d):
    return zlib.crc32(str(d).encode() if d is not None else b"") % 10 == 0


def base(rows):
    counts = Counter(t for d, x in rows if not held(d) for t in toks(x))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, x in rows:
        ts = toks(x)
        out.append((d, held(d), len(ts), sum(counts[t] > 0 for t in ts), n,
                    sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)))
    return out


def corpus(n=400):
    rng = random.Random(2)
    follow = {w: rng.sample("red green blue black white one two three four".split(), 2) for w in
              "red green blue black white one two three four".split()}
    rows = [(None, None), (1, ""), (2, " \x0b\n"), (3, "É Red RED unseenword")]
    for i in range(10, 10 + n):
        w, out = "red", []
        for _ in range(rng.randrange(5, 60)):
            out.append(w if rng.random() < 0.9 else f"w{rng.randrange(4000)}")
            w = rng.choice(follow[w]) if w in follow else "one"
        rows.append((i, " ".join(out)))
    return rows + [(20, rows[20][1]), (20, rows[20][1])]


def check_base(df, rows):
    key = lambda r: (str(r[0]), r[2], r[5])
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in df), key=key)
    want = sorted(base(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)


def test_base_and_gain(spark):
    rows = corpus()
    got = S.score_documents(spark.createDataFrame([(d, t, 0.5, 1, "c") for d, t in rows], SCHEMA)).collect()
    check_base(got, rows)
    out = [r for r in got if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.2 * sum(r.n_tokens for r in out)


def test_distributions_sum_to_one(spark):
    rows = corpus()
    train = spark.createDataFrame(rows, "doc_id long, text string")
    vocabulary = S._vocabulary(train).cache()
    total, distinct = sum(r.n for r in vocabulary.collect()), vocabulary.count()
    counts = {bytes(r.token): r.n for r in vocabulary.collect()}
    tree = grow(train, vocabulary, total, distinct)
    assert len(tree.levels) == 3 and any((~np.isnan(lv.rest)).any() for lv in tree.levels[1:])
    names = list(counts) + [b"\x00new"]
    for context in ([], [b"red"], [b"one", b"two"], [b"red", b"green"], [b"zzz", b"blue"], [b"a", b"red", b"blue"]):
        p = 0.0
        for t in names:
            root = (counts.get(t, 0) + 0.1) / (total + 0.1 * (distinct + 1))
            p += root * math.exp(tree.gains(tree.ids([*context, t]))[-1])
        assert p == pytest.approx(1, abs=1e-9)


def test_longest_suffix(spark):
    """Brute force over the stored states: the longest retained suffix decides."""
    rows = corpus(200)
    train = spark.createDataFrame(rows, "doc_id long, text string")
    vocabulary = S._vocabulary(train).cache()
    total, distinct = sum(r.n for r in vocabulary.collect()), vocabulary.count()
    tree = grow(train, vocabulary, total, distinct)
    text = tree.ids(S.tokens(rows[30][1]))
    got = tree.gains(text)
    width = len(tree.symbols)
    for i in range(len(text)):
        want, above = 0.0, 0
        for level, (codes, states) in enumerate(tree.steps[:len(tree.levels)], 1):
            if i < level or text[i - level] < 0:
                break
            at = np.flatnonzero(codes == above * width + text[i - level])
            if not len(at):
                break
            above = int(states[at[0]])
            lv = tree.levels[level - 1]
            if not np.isnan(lv.rest[above]):
                hit = np.flatnonzero(lv.codes == above * width + text[i]) if text[i] >= 0 else []
                want = lv.gains[hit[0]] if len(hit) else want + lv.rest[above]
        assert got[i] == pytest.approx(want)


def test_empty_and_no_training(spark):
    assert S.score_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "a b"), (None, None)]
    check_base(S.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = S.score_documents(docs).collect()
    check_base(got, rows)
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_joined_values_are_the_tree(spark, monkeypatch):
    """The sum of the joined n-gram values is the tree's gain, also with few places for hot values."""
    rows = [r for r in corpus(150) if r[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = docs.filter(~(S.fold(docs.doc_id, 10) == 0))
    vocabulary = S._vocabulary(train).cache()
    tree = grow(train, vocabulary, sum(r.n for r in vocabulary.collect()), vocabulary.count())
    want = sorted((d, sum(tree.gains(tree.ids(S.tokens(x)))) / math.log(10)) for d, x in rows)
    assert any(g > 1 for _, g in want)
    for slots in (20, 3):
        monkeypatch.setattr(S, "HOT_SLOTS", slots)
        got = sorted((r.doc_id, r.score - r.base_score) for r in S.score_documents(docs).collect())
        assert [g[0] for g in got] == [w[0] for w in want]
        assert [g[1] for g in got] == pytest.approx([w[1] for w in want], abs=1e-6)


def test_rare_states_stay_in_a_large_corpus(spark):
    """A context seen 6 times is a state whatever the number of tokens."""
    rare = "quux corge grault garply"
    train = [d for d in range(100) if not held(d)]
    rows = [(d, rare + " end") for d in train[:6]] + [(d, "the " * 10_000) for d in train[6:80]]
    rows.append((next(d for d in range(100) if held(d)), rare))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r for r in S.score_documents(docs).collect() if r.held_out]
    assert len(got) == 1 and got[0].train_tokens > 700_000
    assert got[0].score > got[0].base_score + 9


def test_numbered_tokens_are_the_tokens():
    import pyarrow as pa

    texts = [None, "", " ", "a", "  A b\x0bC\x0c\rd\n\te  ", "É\x1cx \x85y", "word " * 50, "\x00 \x1f"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"]).slice(1)
    distinct, codes, key, first, place = S._numbered(batch, S._Keys())
    want = [S.tokens(t) for t in texts[1:]]
    assert [distinct[c] for c in codes] == [w for ws in want for w in ws]
    assert first.tolist() == [sum(map(len, want[:i])) for i in range(len(want))]
    assert place.tolist() == [i for ws in want for i in range(len(ws))]
    keys = S._Keys()
    assert key.tolist() == [keys[w] for ws in want for w in ws]


def test_no_repeated_ngram_is_left_out(spark):
    """All bigrams that occur twice, in one text or in two, are in the bitmap; of the others hardly any."""
    import random

    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(40))) for _ in range(120)] + ["x x x", "only here", "twice over", "twice over"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(6)
    every = spark.sparkContext.broadcast(~np.zeros(1 << S.MAP_WORDS, np.uint64))
    keys, counts = S._Keys(), {}
    for t in texts:
        words = S.tokens(t)
        for a, b in zip(words, words[1:]):
            k = int(S._mix(np.array([keys[a]]), np.array([keys[b]]))[0])
            counts[k] = counts.get(k, 0) + 1
    bitmap = S._repeated(docs, [every])
    found = dict(zip(counts, S._maybe(bitmap.value, np.array(list(counts))).tolist()))
    assert all(found[k] for k, n in counts.items() if n > 1)
    assert sum(found[k] for k, n in counts.items() if n == 1) <= 0.3 * len(counts)
    got = S._ngrams(docs, [every], bitmap).filter("n > 1").collect()
    assert sorted(r.n for r in got) == sorted(n for n in counts.values() if n > 1)


def test_python_steps_hold_a_bounded_part_of_a_partition():
    """What a step of a task holds does not follow the number of words of its partition."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa

    words = np.char.add("w", np.random.default_rng(4).integers(0, 400_000, 4_000_000).astype(str))
    texts = pa.array([" ".join(words[i:i + 400].tolist()) for i in range(0, len(words), 400)], pa.string())
    del words
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    every = SimpleNamespace(value=~np.zeros(1 << 10, np.uint64))
    for step, least in ((lambda: S._counted(iter([batch]), [every], every, S.HELD_KEYS), 3_900_000),
                        (lambda: S._sent(iter([batch]), [every], 8, S.HELD_KEYS), 3_900_000)):
        tracemalloc.start()
        n = 0
        for part in step():
            if "n" in part.schema.names:
                n += int(part.column("n").to_numpy().sum())
            else:
                n += sum(len(x) // 4 for c in ("once", "more") for x in part.column(c).to_pylist())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert n >= least and peak < 150 << 20, peak
    keys = S._Keys()
    assert keys.of(np.array([b"a", b"\xff\x00", b""], object)).tolist() == [keys[b"a"], keys[b"\xff\x00"], keys[b""]]
    assert not keys and len(keys.of(np.array([], object))) == 0


def test_slices_of_keys_follow_the_corpus(spark):
    """More tokens are dealt to more slices, which mark the same n-grams."""
    texts = [f"a{i} b{i} c{i % 50} d{i % 50}" for i in range(400)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    every = spark.sparkContext.broadcast(~np.zeros(1 << S.MAP_WORDS, np.uint64))
    maps = [S._repeated(docs, [every], total) for total in (0, 3_000 * S.SLICE_KEYS)]
    assert maps[1].value.size == 1 << 12 and maps[0].value.size == 256
    counted = [sorted(map(tuple, S._ngrams(docs, [every], m).filter("n > 1").collect())) for m in maps]
    assert counted[0] == counted[1] and len(counted[0]) == 100


def test_a_lean_model_has_the_stored_ngrams(spark):
    docs = spark.createDataFrame([(x,) for _, x in corpus()], "text string")
    vocabulary = S._vocabulary(docs).cache()
    total, distinct = vocabulary.selectExpr("sum(n)", "count(*)").first()
    full, lean = (S._values(S.model(docs, vocabulary, total, distinct, stored_only=lean)) for lean in (False, True))
    rows = [sorted((r.key, r.n, round(r.value, 9)) for r in v.collect()) for v in (full, lean)]
    assert rows[0] == rows[1] and len(rows[0]) > 10


def test_level_tables_go_once_their_values_are_written(spark):
    import os

    from webkb.session import shared_dir

    docs = spark.createDataFrame(corpus(60), "doc_id long, text string")
    before = set(os.listdir(shared_dir(spark)))
    assert S.score_documents(docs).count() == docs.count()
    left = {f[:-13] for f in set(os.listdir(shared_dir(spark))) - before}
    assert "tree-values" in left and not left & {"tree-stored", "tree-states", "tree-level", "tree-tested", "tree-counted"}


def test_one_join_at_a_time(spark, monkeypatch):
    """No table that a join has read is left when the next is written: scratch space is that of one join."""
    import os

    written, cut, dropped, drop_cut = [], S.cut, [], S.drop_cut
    live = lambda: {os.path.basename(p)[:-13] for p in written if p not in dropped}
    seen = {}

    def watched(df, name, *more):
        seen.setdefault(name, []).append(live())
        out = cut(df, name, *more)
        written.append(out.cut_path)
        return out

    monkeypatch.setattr(S, "cut", watched)
    monkeypatch.setattr(S, "drop_cut", lambda df: (dropped.append(df.cut_path), drop_cut(df)))
    docs = spark.createDataFrame(corpus(60), "doc_id long, text string")
    assert S.score_documents(docs).count() == docs.count()
    assert len(seen["tree-tested"]) == 3
    assert not any(x & {"tree-counted", "tree-repeated"} for x in seen["tree-tested"])
    assert not any(x & {"tree-higher", "tree-counted"} for x in seen["tree-states"])
    assert "tree-tokens" not in seen["tree-tested"][-1] and len(seen["tree-far"]) == 1 << S.FAR_BITS
    assert not any("tree-tested" in x or "tree-tokens" in x for x in seen["tree-values"])


def test_dealt_counts_are_exact(spark):
    """Counts that tasks send by slices, few at a time, add up to those of the texts and of their numbered tokens."""
    from collections import Counter

    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 40, rng.integers(0, 60))) for _ in range(150)] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    every = spark.sparkContext.broadcast(~np.zeros(1 << S.MAP_WORDS, np.uint64))
    keys = S._Keys()
    want = Counter((keys[a], keys[b]) for t in texts for a, b in zip(S.tokens(t), S.tokens(t)[1:]))
    for table in (docs, S._coded(docs)):
        for least in (1, 3):
            got = S._ngrams(table, [every], every, 3_000 * S.SLICE_KEYS, least, 200).collect()
            assert sorted((r.ctx, r.suf, r.n) for r in got) == sorted((*k, n) for k, n in want.items() if n >= least)


def test_steps_over_tokens_are_bounded_and_exact(monkeypatch):
    """N-grams are made some tokens at a time, of long texts too: each of them once, and little is held."""
    import tracemalloc
    from collections import Counter
    from types import SimpleNamespace

    import pyarrow as pa

    every = SimpleNamespace(value=~np.zeros(1 << 10, np.uint64))
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 30, n)) for n in (0, 1, 200, 3, 50)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    monkeypatch.setattr(S, "STEP_TOKENS", 7)
    monkeypatch.setattr(S, "MIXED_KEYS", 5)
    keys = S._Keys()
    for length in (2, 3, 4):
        want = Counter()
        for text in texts:
            found = np.array([keys[w] for w in S.tokens(text)])
            for _ in range(length - 2):
                found = S._mix(found[:-1], found[1:])
            want.update(zip(found[:-1].tolist(), found[1:].tolist()))
        got = Counter()
        for part in S._counted(iter([batch]), [every] * (length - 1), every, 20):
            for row in part.to_pylist():
                got[row["ctx"], row["suf"]] += row["n"]
        assert got == want
    monkeypatch.undo()
    codes = rng.integers(0, 50_000, 3_000_000).astype("<i4")
    row = keys.of(np.char.add("w", np.arange(50_000).astype(str)).astype(object)).tobytes(), codes.tobytes(), np.full(7500, 400, "<i4").tobytes()
    coded = pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in row], names=["keys", "codes", "sizes"])
    tracemalloc.start()
    assert sum(int(p.column("n").to_numpy().sum()) for p in S._counted(iter([coded]), [every] * 3, every, 1 << 16)) == 7500 * 397
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 << 20, peak  # all tokens of a row at once: some 300 MB


def test_a_join_is_hashed_only_if_its_partitions_are_small(spark):
    table = spark.range(100).selectExpr("id as key")
    most = S.HASHED_ROWS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    for rows, kind in ((most, "ShuffledHashJoin"), (most + 1, "SortMergeJoin")):
        joined = table.selectExpr("key + 1 as key").join(S._hashed(table, rows), "key")
        assert kind in joined._jdf.queryExecution().sparkPlan().toString()


def test_most_used_values_are_looked_up_in_place(spark):
    rows = [(int(k), int(n), float(k % 97)) for k, n in zip(np.random.default_rng(6).integers(-2**63, 2**63 - 1, 3000), range(2, 3002))]
    values = spark.createDataFrame(rows, "key long, n long, value double")
    for slots in (8, 12):
        keys, found = S._hot(values, slots)
        by_key = {k: v for k, _, v in rows}
        place = lambda k: (k % 2**64) >> (64 - slots)
        used = [(k, n) for k, n, _ in rows if keys[place(k)] == k]
        assert len(used) > 0.7 * min(len(keys), len(rows) / 2) and all(found[place(k)] == by_key[k] for k, _ in used)
        top = max(rows, key=lambda r: r[1])
        assert keys[place(top[0])] == top[0]
    assert not S._hot(values.limit(0), 8)[0].any()
