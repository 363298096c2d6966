import hashlib
import random
import re
import struct
from collections import Counter

import xxhash

from webkb.llm import order_minhash as O

SCHEMA = "doc_id long, text string, signature string, range long, place int"
WORD = re.compile("[^\x20\x09-\x0d]+")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def h64(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v if isinstance(v, bytes) else struct.pack("<q", v), seed)
    return seed


def h64_int(value, seed):
    return xxhash.xxh64_intdigest(struct.pack("<i", value), seed)


def brute_signature(text):
    words = [h64(w.encode()) for w in WORD.findall(text or "")]
    if not words:
        return {}
    kmers = [h64(*map(signed, words[i:i + O.K])) >> 32 for i in range(max(1, len(words) - O.K + 1))]
    seen, slots = Counter(), {}
    for place, k in enumerate(kmers):
        hi = k - (1 << 32) if k >> 31 else k
        u = h64_int(seen[k], xxhash.xxh64_intdigest(struct.pack("<q", hi), 42)) & ((1 << 31) - 1)
        seen[k] += 1
        slots.setdefault(u >> 26, []).append((u, place))
    out = {}
    for s, found in slots.items():
        least = sorted(sorted(found)[:O.TUPLE], key=lambda x: x[1])
        out[s] = h64(*[u for u, _ in least]) & ((1 << 58) - 1)
    return out


def show(sig):
    return "".join(f"{(s << 58 | h) & ((1 << 64) - 1):016x}" for s, h in sorted(sig.items()))


def like(a, b):
    slots = set(a) | set(b)
    return sum(a.get(s) == b.get(s) for s in slots) / len(slots) if slots else 1.0


def brute(rows):
    rows = [(d, t or "") for d, t in rows]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(h64(r[1].encode())), r[1].encode()))
    out = []
    for (d, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        k = len(t) // 3
        e = t[:len(t) - k] + nxt[:k]
        a, b, c = brute_signature(t), brute_signature(e), brute_signature(nxt)
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), show(a), show(b), like(a, b), like(a, c)))
    return sorted(out, key=str)


def found(df):
    return sorted([tuple(r) for r in df.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()],
        key=str)


def cases():
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("ab é cde f gh ij 日本 k".split()) for _ in range(n))
    rows = [(None, None), (None, "x y"), (1, ""), (2, " \n"), (3, "a"), (4, "a b"), (5, "a b c"), (6, "a b c"),
            (7, "same " * 3000), (9, text(4000)), (10, text(50)), (10, text(50)), (10, "a b c"), (10, "a b c")]
    return rows + [(100 + 7 * i, text(rng.randrange(1, 200))) for i in range(40)]


def test_matches_brute_force(spark):
    rows = cases()
    got = found(O.fingerprints(spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], SCHEMA).repartition(4)))
    assert got == brute(rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = found(O.fingerprints(docs))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(g[5] for g in got) > 3 * sum(g[6] for g in got)


def test_order_matters():
    words = [f"w{i}" for i in range(400)]
    moved = words[200:] + words[:200]
    a, b = brute_signature(" ".join(words)), brute_signature(" ".join(moved))
    assert like(a, b) < 0.8  # the same k-mers but two, in another order


def test_small_tables(spark):
    assert O.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
    for rows in ([(1, "a b c d e f g h i")], [(None, None)], [(None, "a b c d"), (None, "a b c d")]):
        assert found(O.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
