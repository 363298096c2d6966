import numpy as np
import pyarrow as pa

from webkb.llm import pivots

SCHEMA = "vec_id long, embedding array<float>, label int, node string"


def brute(rows, least=0.95):
    vectors = []
    for _, v in rows:
        ok = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        vectors.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = vectors[i], vectors[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= least - 1e-12:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if find(j) == find(i) and rows[j][0] is not None]
        least_id = min(ids) if ids else None
        out.append((vec_id, links[i], least_id, vec_id is not None and vec_id == least_id))
    return sorted(out, key=str)


def found(spark, rows, schema=SCHEMA, **settings):
    frame = spark.createDataFrame([(i, v, 0, "clash") for i, v in rows], schema)
    return sorted((tuple(r) for r in pivots.near_duplicates(frame, **settings).collect()), key=str)


def near(rng, base, noise):
    v = base + rng.normal(size=len(base)) * noise / len(base) ** 0.5
    return [float(np.float32(x)) for x in v]


def table(rng, dims=24):
    rows = []
    for size, noise in ((60, 0.1), (12, 0.12), (5, 0.15), (2, 0.1), (2, 0.2)):
        base = rng.normal(size=dims)
        base /= np.linalg.norm(base)
        rows += [near(rng, base, noise) for _ in range(size)]
    rows += [near(rng, rng.normal(size=dims), 0) for _ in range(150)]
    rows += [rows[0]] * 40 + [rows[100]] * 3
    ids = rng.permutation(len(rows)).tolist()
    return list(zip(ids, rows))


def test_all_links_where_every_pair_is_a_candidate(spark):
    """With as many shared pivots asked for as all pairs have, nothing is missed."""
    rows = table(np.random.default_rng(5))
    rows += [(1000, None), (1001, []), (1002, [0.0] * 24), (1003, [float("nan")] * 24), (1004, [float("inf")] + [1.0] * 23),
             (1005, [None] + [1.0] * 23), (None, rows[0][1]), (None, [1.0] + [0.0] * 23), (7, rows[3][1]), (1006, [1.0, 0.0]),
             (1007, [1.0, 0.0, 0.0]), (1008, [2.0, 0.0]), (1009, [3e38, 3e38]), (1010, [1e-38, 1e-38])]
    assert found(spark, rows, prefix=4096, shared=1, block=1 << 20) == brute(rows)


def test_default_index_finds_nearly_all_whatever_the_blocks(spark):
    rows = table(np.random.default_rng(6))
    want = brute(rows)
    got = found(spark, rows)
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert got == found(spark, rows, block=7)
    assert got == found(spark, rows, hot=10, block=16)


def test_recall_at_the_threshold(spark):
    """Pairs whose cosine is just above 0.95, the hardest there are."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        a, z = rng.normal(size=(2, 64))
        a /= np.linalg.norm(a)
        z -= (z @ a) * a
        z /= np.linalg.norm(z)
        c = 0.951
        rows += [(2 * i, a.tolist()), (2 * i + 1, (c * a + (1 - c * c) ** 0.5 * z).tolist())]
    got = found(spark, rows, "vec_id long, embedding array<double>, label int, node string")
    assert sum(r[1] for r in got) >= 0.9 * 800
    assert all(r[2] in (r[0], r[0] - 1) for r in got)


def test_chains_across_blocks_are_one_component(spark):
    """Vectors along an arc, each linked with its neighbours only."""
    angles = np.arange(0, 3.0, 0.15)
    rows = [(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(np.random.default_rng(8).permutation(angles))]
    got = found(spark, rows, "vec_id long, embedding array<double>, label int, node string", block=3, shared=1, prefix=4096)
    assert got == brute(rows)
    assert {r[2] for r in got} == {0}


def test_small_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(4, [1.0, 2.0])]) == [(4, 0, 4, True)]
    assert found(spark, [(4, None)]) == [(4, 0, 4, True)]
    assert found(spark, [(None, None), (2, [1.0]), (1, [5.0]), (3, [-1.0])]) == brute([(None, None), (2, [1.0]), (1, [5.0]), (3, [-1.0])])


def test_pivots_keep_their_distance():
    rng = np.random.default_rng(9)
    dense = rng.normal(size=16) + 0.05 * rng.normal(size=(500, 16))
    sample = pivots.unit(np.concatenate([dense, rng.normal(size=(500, 16))]))
    chosen = pivots.spread(sample, 200, 0.8)
    cos = chosen @ chosen.T - np.eye(len(chosen)) * 2
    assert cos.max() <= 0.8
    assert (chosen @ pivots.unit(dense)[0] > 0.9).sum() == 1


def test_shared_counts_choose_the_rows_of_a_list():
    near = [[0, 1, 2, 3], [0, 2, 1, 4], [5, 0, 1, 2], [6, 0, 7, 8], [0, 9, 10, 11]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0] * 5, pa.int32()), pa.array(range(5), pa.int64()), pa.array([n[0] == 0 for n in near]),
         pa.array(near, pa.list_(pa.int32()))], names=["pivot", "node", "home", "nearest"])

    class Frame:
        def mapInArrow(self, run, schema):  # noqa: N802
            return pa.Table.from_batches(list(run(iter([batch.slice(0, 2), batch.slice(2)]))))

    assert pivots._matched(Frame(), 3, 12).column("node").to_pylist() == [0, 1, 2]
